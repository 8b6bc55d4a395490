"""Data-quality checks on profile documents, or on flat dimensions of any length."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.operators.distribution import spread_join

OST_WITHOUT_SOURCE = "ost_without_source"
COLLAB_WITHOUT_SONGS = "collab_without_songs"
SHOWS_WITHOUT_SINGLES = "singing_shows_without_singles"
NO_INTERVIEWERS = "no_interviewers"
SHORT_ALBUM = "short_album"


def _singing_show():
    hit = F.lit(False)
    for word in V.SINGING_SHOW_WORDS:
        hit = hit | F.contains(F.lower("name"), F.lit(word))
    return hit


def document_issues(profiles: DataFrame) -> DataFrame:
    """(profile, check, n, total, names) of nested documents.

    A document is one row, so every check is an expression over its own lists: one pass,
    no join, no shuffle.
    """
    d = "discography"
    singing = " or ".join(f"contains(lower(s.name), '{w}')" for w in V.SINGING_SHOW_WORDS)
    empty = "cast(array() as array<string>)"
    checks = [
        (OST_WITHOUT_SOURCE, f"filter({d}.ost_singles, s -> coalesce(s.source, '') = '')",
         "x.name", f"size({d}.ost_singles)"),
        (COLLAB_WITHOUT_SONGS, f"filter({d}.collaborators, c -> size(coalesce(c.songs, {empty})) = 0)",
         "x.name", f"size({d}.collaborators)"),
        (SHOWS_WITHOUT_SINGLES,
         f"if(coalesce(size({d}.variety_show_singles), 0) > 0, null, "
         f"filter({d}.variety_shows, s -> {singing}))", "x.name", "null"),
        (NO_INTERVIEWERS,
         f"if(coalesce(size({d}.notable_interviewers), 0) > 0, null, array(artist.names.primary))",
         "x", "null"),
        (SHORT_ALBUM,
         f"filter({d}.solo_albums, a -> size(coalesce(a.tracks, {empty})) < {V.SHORT_ALBUM_TRACKS})",
         f"format_string('%s (%d tracks)', x.name, size(coalesce(x.tracks, {empty})))",
         f"size({d}.solo_albums)"),
    ]
    rows = ", ".join(
        f"struct('{check}' as check, transform({found}, x -> {name}) as names, "
        f"cast({total} as bigint) as total)" for check, found, name, total in checks
    )
    return profiles.selectExpr("profile", f"inline(array({rows}))").filter("size(names) > 0").select(
        "profile", "check", F.size("names").cast("bigint").alias("n"), "total", "names"
    )


def album_sizes(dims: dict[str, DataFrame]) -> DataFrame:
    counted = dims["tracks"].groupBy("profile", "album_pos").agg(F.count(F.lit(1)).alias("n_tracks"))
    albums = dims["albums"].withColumnRenamed("pos", "album_pos")
    return albums.join(counted, ["profile", "album_pos"], "left").fillna(0, ["n_tracks"])


def issue_rows(dims: dict[str, DataFrame]) -> DataFrame:
    """One row per offending entry: (profile, check, name).  Checks without their dimension are skipped."""
    found = []

    def add(check, rows):
        found.append(rows.select("profile", F.lit(check).alias("check"), F.col("name")))

    if "ost" in dims:
        add(OST_WITHOUT_SOURCE, dims["ost"].filter(F.coalesce("source", F.lit("")) == ""))
    if "collabs" in dims:
        add(COLLAB_WITHOUT_SONGS, dims["collabs"].filter("n_songs = 0"))
    if {"shows", "variety_singles"} <= dims.keys():
        singles = dims["variety_singles"].select("profile").distinct()
        add(
            SHOWS_WITHOUT_SINGLES,
            spread_join(
                dims["shows"].filter(_singing_show()), singles, ["profile"], ["name"], "left_anti"
            ),
        )
    if {"profiles", "interviewers"} <= dims.keys():
        asked = dims["interviewers"].select("profile").distinct()
        add(
            NO_INTERVIEWERS,
            dims["profiles"].join(asked, "profile", "left_anti").withColumn("name", F.col("primary")),
        )
    if {"albums", "tracks"} <= dims.keys():
        short = album_sizes(dims).filter(F.col("n_tracks") < V.SHORT_ALBUM_TRACKS)
        add(SHORT_ALBUM, short.withColumn("name", F.format_string(
            "%s (%d tracks)", "album", "n_tracks"
        )))
    return reduce(DataFrame.unionByName, found)


def profile_issues(dims: dict[str, DataFrame], names: bool = False) -> DataFrame:
    """Per profile and failed check: offending entries and, where it says something, the total.

    ``names`` adds the list of names; use it for profile documents, which are short.
    """
    measures = [F.count(F.lit(1)).alias("n")]
    if names:
        measures.append(F.array_sort(F.collect_list("name")).alias("names"))
    found = issue_rows(dims).groupBy("profile", "check").agg(*measures)
    totals = []
    for check, dim in (
        (OST_WITHOUT_SOURCE, "ost"), (COLLAB_WITHOUT_SONGS, "collabs"), (SHORT_ALBUM, "albums"),
    ):
        if dim in dims:
            totals.append(dims[dim].groupBy("profile").agg(F.count(F.lit(1)).alias("total")).select(
                "profile", F.lit(check).alias("check"), "total"
            ))
    if not totals:
        return found.withColumn("total", F.lit(None).cast("bigint"))
    return found.join(reduce(DataFrame.unionByName, totals), ["profile", "check"], "left")


def profile_stats(profiles: DataFrame) -> DataFrame:
    """Sizes of the lists of each profile document."""
    def size(path):
        return F.greatest(F.coalesce(F.size(path), F.lit(0)), F.lit(0))

    return profiles.select(
        "profile",
        size("discography.solo_albums").alias("n_albums"),
        size("discography.ost_singles").alias("n_ost"),
        size("discography.concerts").alias("n_concerts"),
        size("discography.collaborators").alias("n_collaborators"),
        size("categories").alias("n_categories"),
    )


# Parts that every document must have, and fields that every entry of a list must have.
REQUIRED = [
    "artist.names.primary", "artist.names.english", "artist.names.aliases", "artist.official_channels",
    "artist.labels", "discography.solo_albums", "discography.ost_singles", "discography.concerts",
    "discography.variety_shows", "discography.collaborators", "categories", "classification.priority",
]
REQUIRED_IN = {
    "artist.channels": ["platform", "id"],
    "discography.solo_albums": ["name", "year", "tracks"],
    "discography.ost_singles": ["name", "source", "year"],
    "discography.variety_show_singles": ["name", "source", "year"],
    "discography.concerts": ["name", "years"], "discography.group_concerts": ["name", "years"],
    "discography.variety_shows": ["name"], "discography.collaborators": ["name"],
    "categories": ["id", "key", "label"],
}
GROUP_PARTS = ["name", "aliases", "members", "member_names"]


def schema_problems(documents: DataFrame, key: str = "profile") -> DataFrame:
    """(key, problem) of typed documents (``parse_documents``), of those without a name too.

    A part counts as missing if it is absent or of another type; a document of which nothing
    could be read has that one problem.
    """
    def problem(condition, text):
        return F.when(condition, F.lit(text))

    unread = F.lit(True)
    for part in ("artist", "discography", "categories", "classification", "group"):
        unread = unread & F.col(part).isNull()
    found = [problem(F.col(p).isNull(), f"missing {p}") for p in REQUIRED]
    for path, fields in REQUIRED_IN.items():
        found += [
            problem(F.expr(f"coalesce(exists({path}, x -> x.{f} is null), false)"), f"missing {path}[].{f}")
            for f in fields
        ]
    found += [
        problem(F.col("group").isNotNull() & F.col("group")[f].isNull(), f"missing group.{f}") for f in GROUP_PARTS
    ]
    listed = F.when(unread, F.array(F.lit("unreadable document"))).otherwise(
        F.filter(F.array(*found), lambda m: m.isNotNull()))
    return documents.select(key, F.explode(listed).alias("problem"))
