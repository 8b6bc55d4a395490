"""Profile documents as dimensions (one row per entry) and as dictionaries (one row per profile)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.operators import distribution

DICTIONARY = "_p"


def _list(path: str, kind: str = "array<string>") -> Column:
    return F.coalesce(F.col(path), F.array().cast(kind))


def dims(profiles: DataFrame, *names: str) -> dict[str, DataFrame]:
    """Lists of the profile document as tables, with positions: the named ones, or all."""

    def explode(path, *extra):
        return profiles.select("profile", F.posexplode(path).alias("pos", "e")).select(
            "profile", "pos", *extra
        )

    def words(path, name):
        return explode(path, F.col("e").alias(name))

    def fields(path, *columns):
        return explode(path, *[F.col(f"e.{n}") for n in columns])

    def nested(path, owner, inner, name):
        outer = profiles.select("profile", F.posexplode(path).alias(owner + "_pos", "e"))
        return outer.select(
            "profile", owner + "_pos", F.col("e.name").alias(owner),
            F.posexplode(f"e.{inner}").alias("pos", name),
        )

    d = "discography."

    def heads():
        return profiles.select(
            "profile", F.col("artist.names.primary").alias("primary"),
            F.col("artist.names.english").alias("english"), F.col("group.name").alias("group_name"),
            F.get(_list("group.aliases"), F.lit(0)).alias("group_alias"),
        )

    def all_names():
        own = F.array("artist.names.primary", "artist.names.english")
        listed = F.posexplode(F.array_union(own, "artist.names.aliases"))
        return profiles.select("profile", listed.alias("pos", "name"))

    def group_names():
        listed = F.posexplode(F.concat(F.array("group.name"), _list("group.aliases")))
        grouped = profiles.filter(F.col("group").isNotNull())
        return grouped.select("profile", listed.alias("pos", "name"))

    def blacklist():
        kinds = {
            "western": "western_artist_blacklist", "chinese": "other_chinese_artist_blacklist",
            "wrong_context": "wrong_context_patterns",
        }
        parts = [
            words(d + path, "term").withColumn("kind", F.lit(kind)) for kind, path in kinds.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    tables = {
        "profiles": heads,
        "names": all_names,
        "aliases": lambda: words("artist.names.aliases", "alias"),
        "official_channels": lambda: words("artist.official_channels", "channel"),
        "labels": lambda: words("artist.labels", "label"),
        "channels": lambda: fields("artist.channels", "platform", "id", "name"),
        "group_names": group_names,
        "albums": lambda: explode(
            d + "solo_albums", F.col("e.name").alias("album"), F.col("e.year").alias("year")
        ),
        "tracks": lambda: nested(d + "solo_albums", "album", "tracks", "track"),
        "ost": lambda: fields(d + "ost_singles", "name", "source", "year"),
        "variety_singles": lambda: fields(d + "variety_show_singles", "name", "source", "year"),
        "concerts": lambda: explode(
            d + "concerts", F.col("e.name").alias("name"),
            F.get(_list("e.aliases"), F.lit(0)).alias("first_alias"),
        ),
        "concert_aliases": lambda: nested(d + "concerts", "concert", "aliases", "alias"),
        "concert_venues": lambda: nested(d + "concerts", "concert", "venues", "venue"),
        "group_concerts": lambda: fields(d + "group_concerts", "name"),
        "shows": lambda: fields(d + "variety_shows", "name", "network"),
        "collabs": lambda: explode(
            d + "collaborators", F.col("e.name").alias("name"),
            F.size(_list("e.songs")).alias("n_songs"),
        ),
        "collab_songs": lambda: nested(d + "collaborators", "collab", "songs", "song"),
        "collab_aliases": lambda: nested(d + "collaborators", "collab", "aliases", "alias"),
        "group_mvs": lambda: words(d + "group_mvs", "track"),
        "interviewers": lambda: words(d + "notable_interviewers", "name"),
        "interview_channels": lambda: words(d + "interview_channels", "name"),
        "blacklist": blacklist,
        "categories": lambda: fields(
            "categories", "id", "key", "label", "sub", "output_path", "description"
        ),
    }
    return {name: tables[name]() for name in names or tables}


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


_NONE = "cast(array() as array<string>)"


def _all(*lists: str) -> str:
    """SQL: distinct non-null elements of several lists, null lists skipped."""
    joined = ", ".join(f"coalesce({one}, {_NONE})" for one in lists)
    return f"array_distinct(filter(concat({joined}), v -> v is not null))"


def _folded(values: str) -> str:
    return f"array_distinct(transform({values}, v -> lower(v)))"


def _dictionaries(venues: list[str], media: list[str]) -> list[tuple[str, str]]:
    """Dictionary name and SQL, in dependency order; later ones may use earlier ones."""
    short = "c.name"
    for prefix in V.GROUP_CONCERT_PREFIXES:
        short = f"replace({short}, '{prefix}', '')"
    collab_names = f"transform(d.collaborators, c -> concat(array(c.name), coalesce(c.aliases, {_NONE})))"
    # Songs of a name: those of the last collaborator that has it.
    holders = "filter(d.collaborators, c -> c.name = n or coalesce(array_contains(c.aliases, n), false))"
    return [
        ("names", _all("array(artist.names.primary, artist.names.english)", "artist.names.aliases")),
        ("names_lc", _folded("names")),
        ("has_group", "group is not null"),
        ("group_lc", f"if(group is null, {_NONE}, {_folded(_all('array(group.name)', 'group.aliases'))})"),
        ("official", f"coalesce(artist.official_channels, {_NONE})"),
        ("labels", f"coalesce(artist.labels, {_NONE})"),
        ("tracks", _all("flatten(transform(d.solo_albums, a -> coalesce(a.tracks, " + _NONE + ")))")),
        ("tracks_lc", _folded("tracks")),
        # Every track with the sources under which it also is a single.
        ("solo", "transform(tracks, t -> struct(t as track, transform(filter(d.ost_singles, "
                 "o -> o.name = t and coalesce(o.source, '') <> ''), o -> o.source) as sources))"),
        ("ost", "transform(d.ost_singles, o -> struct(o.name as name, coalesce(o.source, '') as source, "
                "array_contains(tracks, o.name) as also_track))"),
        ("ost_names", _all("transform(d.ost_singles, o -> o.name)")),
        ("ost_names_lc", _folded("ost_names")),
        ("variety_singles", _all("transform(d.variety_show_singles, v -> v.name)")),
        ("concerts", _all(
            "flatten(transform(d.concerts, c -> concat(array(c.name), coalesce(c.aliases, " + _NONE + "))))",
            "transform(d.group_concerts, c -> c.name)",
        )),
        ("concerts_lc", _folded("concerts")),
        ("group_concerts_short", f"coalesce(transform(d.group_concerts, c -> {short}), {_NONE})"),
        ("shows", _all("transform(d.variety_shows, s -> s.name)")),
        ("shows_lc", _folded("shows")),
        ("networks", _all(
            "filter(transform(d.variety_shows, s -> s.network), n -> n <> '')",
            _sql_list(V.TV_NETWORKS),
        )),
        # A repeated name keeps its first place and its last list of songs.
        ("collabs", f"transform({_all(f'flatten({collab_names})')}, n -> struct(n as name, "
                    f"lower(n) as name_lc, coalesce(element_at({holders}, -1).songs, {_NONE}) as songs))"),
        ("collab_songs", _all("flatten(transform(collabs, c -> c.songs))")),
        ("group_mvs_lc", _folded(_all("d.group_mvs"))),
        ("wrong_context", _all(
            "transform(d.wrong_context_patterns, w -> lower(w))", _sql_list(V.WRONG_CONTEXT_DEFAULTS)
        )),
        ("western_lc", _folded(_all("d.western_artist_blacklist"))),
        ("chinese", _all("d.other_chinese_artist_blacklist")),
        ("venues", _sql_list(venues)),
        ("media", _sql_list(media)),
    ]


def wide(
    profiles: DataFrame, venues: list[str] | None = None, media: list[str] | None = None,
) -> DataFrame:
    """One row per profile: the dictionaries that rules and scores look things up in.

    A projection of the document itself: no explode, no shuffle.  ``venues`` and
    ``media`` replace the fixed lists.
    """
    named = profiles.select("profile", "artist", "group", F.col("discography").alias("d"))
    listed = _dictionaries(
        V.VENUES if venues is None else venues, V.INTERVIEW_MEDIA if media is None else media
    )
    later = {"solo", "ost", "collab_songs"}
    folded = [name for name, sql in listed if name.endswith("_lc") and sql == _folded(name[:-3])]
    second = [(n, sql) for n, sql in listed if n in later or n in folded]
    first = [(n, sql) for n, sql in listed if (n, sql) not in second]
    whole = named.selectExpr("*", *[f"{sql} as {n}" for n, sql in first]).selectExpr(
        "*", *[f"{sql} as {n}" for n, sql in second]
    )
    return whole.select("profile", F.struct(*[n for n, _ in listed]).alias(DICTIONARY))


def with_dictionary(items: DataFrame, profiles: DataFrame, **lists) -> DataFrame:
    """Items with the dictionaries of their profile in one struct column."""
    if DICTIONARY in items.columns:
        return items
    spread = [c for c in ("file_id", "ord", "url") if c in items.columns]
    return distribution.attach(items, wide(profiles, **lists), ["profile"], spread, "left")


def group_pattern(group_names: Column) -> Column:
    """Regex text for a group name that no ASCII letter touches; empty list gives null."""
    escaped = F.transform(group_names, lambda n: F.concat(
        F.lit("(?<![A-Za-z])"), F.regexp_replace(n, r"([^\p{L}\p{N}_])", r"\\$1"),
        F.lit("(?![A-Za-z])"),
    ))
    return F.when(F.size(group_names) > 0, F.concat(F.lit("(?iu)"), F.array_join(escaped, "|")))


def has_group_name(title: Column, group_names: Column) -> Column:
    return F.coalesce(F.rlike(title, group_pattern(group_names)), F.lit(False))
