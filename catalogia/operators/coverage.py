"""How much of a discography the catalogue covers.

A track is found if its lower-cased name is a substring of any lower-cased title.
Substring tests are no equi-join, so names and titles are made to meet in one:

* A short name is met whole: a title offers its distinct substrings of the lengths that short
  names of its profile have, so only true hits meet.
* A long name is met by a block: a title is cut into adjoining blocks of n characters and a
  name offers its n-character windows at the first n offsets.  Wherever a name of at
  least 2n - 1 characters stands in a title, it covers a whole block, which is one of
  those windows; the full name is verified afterwards.

``way='scan'`` tests each title against all names of its profile instead; no title is
shuffled, which suits a few names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia.functions import blank_to_null
from catalogia.functions.display import fixed
from catalogia.operators.distribution import attach

# Block lengths of long names; a name uses the longest n with 2n - 1 <= its length.
BLOCK_LENGTHS = [8, 16, 32]
# Shorter names are met whole, by the title's substrings of the lengths that its profile uses.
SHORT = 2 * BLOCK_LENGTHS[0] - 1


def _names(tracks: DataFrame, name: str) -> DataFrame:
    return tracks.select("profile", F.lower(name).alias("_name")).filter(
        F.col("_name").isNotNull()
    ).distinct()


def _titles(items: DataFrame) -> DataFrame:
    title = blank_to_null(F.lower("title"))
    return items.select("profile", title.alias("_title")).filter(F.col("_title").isNotNull())


def _found_by_scan(names: DataFrame, titles: DataFrame) -> DataFrame:
    listed = names.groupBy("profile").agg(F.collect_list("_name").alias("_names"))
    offered = attach(titles, listed, ["profile"], ["_title"], "inner")
    hit = F.filter("_names", lambda n: F.contains(F.col("_title"), n))
    return offered.select("profile", F.explode(hit).alias("_name")).distinct()


def _blocks() -> str:
    """SQL: distinct blocks of a title in the block lengths that its profile uses."""
    cut = ", ".join(
        f"if(array_contains(_lengths, {n}), "
        f"regexp_extract_all(_title, r'(?s).{{{n}}}', 0), cast(array() as array<string>))"
        for n in BLOCK_LENGTHS
    )
    return f"array_distinct(concat({cut}))"


def _found_short(names: DataFrame, titles: DataFrame) -> DataFrame:
    short = names.filter(F.length("_name") < SHORT)
    # At most one short list of lengths per profile.
    lengths = short.groupBy("profile").agg(F.collect_set(F.length("_name")).alias("_lengths"))
    offered = attach(titles, lengths, ["profile"], ["_title"], "inner")
    # A look-ahead yields the substring at every place in one pass over the title.
    cut = ", ".join(
        f"if(array_contains(_lengths, {n}), "
        f"regexp_extract_all(_title, r'(?s)(?=(.{{{n}}}))', 1), cast(array() as array<string>))"
        for n in range(1, SHORT)
    )
    pieces = F.expr(f"explode(array_distinct(concat(if(array_contains(_lengths, 0), array(''), array()), {cut})))")
    seen = offered.select("profile", pieces.alias("_name")).distinct()
    return seen.join(short, ["profile", "_name"])


def _found_by_gram(names: DataFrame, titles: DataFrame) -> DataFrame:
    length = F.lit(BLOCK_LENGTHS[0])
    for n in BLOCK_LENGTHS[1:]:
        length = F.when(F.length("_name") >= 2 * n - 1, n).otherwise(length)
    sized = names.filter(F.length("_name") >= SHORT).withColumn("_n", length)
    windows = F.expr(
        "explode(array_distinct(transform(sequence(1, _n), i -> substring(_name, i, _n))))"
    )
    keyed = sized.select("profile", "_name", windows.alias("_key"))
    lengths = sized.groupBy("profile").agg(F.collect_set("_n").alias("_lengths"))
    offered = attach(titles, lengths, ["profile"], ["_title"], "inner")
    blocks = offered.select("profile", "_title", F.expr(f"explode({_blocks()})").alias("_key"))
    # The few names of a block are brought to the titles that hold it; the title is at hand there.
    met = attach(blocks, keyed, ["profile", "_key"], ["_title"], "inner")
    found = met.filter(F.contains(F.col("_title"), F.col("_name"))).select("profile", "_name").distinct()
    return found.unionByName(_found_short(names, titles).select("profile", "_name"))


def track_found(
    tracks: DataFrame, items: DataFrame, name: str = "track", way: str = "gram",
) -> DataFrame:
    """``tracks`` plus ``found``."""
    names, titles = _names(tracks, name), _titles(items)
    hits = (_found_by_scan if way == "scan" else _found_by_gram)(names, titles)
    hits = hits.withColumn("_found", F.lit(True))
    joined = tracks.withColumn("_name", F.lower(name)).join(hits, ["profile", "_name"], "left")
    return joined.select(*tracks.columns, F.col("_found").isNotNull().alias("found"))


def album_coverage(found: DataFrame, lists: bool = False) -> DataFrame:
    """Totals per album from ``track_found`` rows; editions of one name and different years
    (column ``year``) or places (column ``album_pos``), where there are such columns, stay apart.

    ``lists`` adds the ordered found and missing tracks; an album of a profile document
    is short, so use it for those.
    """
    hit = F.col("found")
    by = ["profile", "album", *[c for c in ("album_pos", "year") if c in found.columns]]
    measures = [
        F.count(F.lit(1)).alias("total_tracks"), F.count_if(hit).alias("found_count"),
        F.count_if(~hit).alias("missing_count"),
    ]
    if not lists:
        return found.groupBy(*by).agg(*measures)
    grouped = found.groupBy(*by).agg(
        *measures, F.array_sort(F.collect_list(F.struct("pos", "track", "found"))).alias("_all")
    )
    return grouped.select(
        *by, "total_tracks", "found_count", "missing_count",
        F.transform(F.filter("_all", lambda t: t["found"]), lambda t: t.track).alias("found_tracks"),
        F.transform(F.filter("_all", lambda t: ~t["found"]), lambda t: t.track).alias(
            "missing_tracks"
        ),
    )


def single_coverage(singles: DataFrame, items: DataFrame, way: str = "gram") -> DataFrame:
    return track_found(singles, items, "name", way)


def coverage_summary(profiles: DataFrame, tracks: DataFrame, singles: DataFrame) -> DataFrame:
    """Totals and percents per profile, zero where a profile has none."""
    def totals(rows, prefix):
        return rows.groupBy("profile").agg(
            F.count(F.lit(1)).alias(f"{prefix}_total"), F.count_if("found").alias(f"{prefix}_found")
        )

    joined = (
        profiles.select("profile").distinct()
        .join(totals(tracks, "album_tracks"), "profile", "left")
        .join(totals(singles, "ost"), "profile", "left")
    )
    columns = [F.col("profile")]
    for prefix, percent in (("album_tracks", "album_coverage_pct"), ("ost", "ost_coverage_pct")):
        total = F.coalesce(f"{prefix}_total", F.lit(0))
        found = F.coalesce(f"{prefix}_found", F.lit(0))
        columns += [
            total.alias(f"{prefix}_total"), found.alias(f"{prefix}_found"),
            (total - found).alias(f"{prefix}_missing"),
            F.when(total > 0, fixed(found / total * 100, 1).cast("double")).otherwise(0.0).alias(percent),
        ]
    return joined.select(*columns)
