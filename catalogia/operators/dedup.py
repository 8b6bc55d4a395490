"""Duplicates within one collection file, across the catalogue and against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia.functions import (
    batch_key, blank_to_null, catalog_key, richness, tracker_key, video_id_simple,
)
from catalogia.operators.distribution import first_by, spread_join

_PLACE = ["file_id", "ord"]


def dedup_first(raw: DataFrame) -> DataFrame:
    """First hit per key inside a file; hits without a key are all kept.

    A hit without a key forms a group of its own, so such hits neither merge nor meet
    in one task.
    """
    keyed = raw.withColumn("_key", batch_key(F.col("url"), F.col("bvid"), F.col("source")))
    keyed = keyed.withColumn("_alone", F.when(F.col("_key").isNull(), F.col("ord")))
    by = ["profile", "file_id", "_key", "_alone"]
    return first_by(keyed, by, ["ord"]).drop("_key", "_alone")


def dup_key() -> Column:
    return catalog_key(F.col("url"), F.col("bvid"), F.col("source"))


def dedup_richest(items: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Richest item per key over all files of a profile; equal ones go to the earliest.

    Winners are chosen on keys, ranks and places alone; only then is the winner's row fetched
    by its place, which is unique, so no text is compared or aggregated.  ``original_file_id``
    says where the kept item came from, (``file_id``, ``ord``) is the place where the key was
    first seen.  ``columns`` limits what travels along.
    """
    wanted = [c for c in (columns or items.columns) if c not in
              ("profile", "file_id", "ord", "original_file_id")]
    rank = F.struct(richness().alias("r"), -F.col("file_id"), -F.col("ord"), *_PLACE)
    best = items.select("profile", dup_key().alias("_key"), rank.alias("_rank"), *_PLACE).groupBy(
        "profile", "_key"
    ).agg(F.max("_rank").alias("b"), F.min(F.struct(*_PLACE)).alias("first"))
    winners = best.select(
        F.col("profile").alias("_profile"), F.col("b.file_id").alias("_file"), F.col("b.ord").alias("_ord"),
        F.col("first.file_id").alias("_first_file"), F.col("first.ord").alias("_first_ord"),
    )
    place = (
        (F.col("profile") == F.col("_profile")) & (F.col("file_id") == F.col("_file"))
        & (F.col("ord") == F.col("_ord"))
    )
    rows = items.select("profile", *_PLACE, *[F.col(c).alias(f"_kept_{c}") for c in wanted])
    return rows.join(winners, place).select(
        "profile", F.col("_first_file").alias("file_id"), F.col("_first_ord").alias("ord"),
        F.col("file_id").alias("original_file_id"), *[F.col(f"_kept_{c}").alias(c) for c in wanted],
    )


def dup_count(items: DataFrame) -> DataFrame:
    """Items, distinct keys and removable duplicates per profile."""
    per_key = items.select("profile", dup_key().alias("_key")).groupBy("profile", "_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    return dup_totals(per_key)


def dup_totals(per_key: DataFrame) -> DataFrame:
    """The same from the number of items ``n`` of each key of a profile."""
    return per_key.groupBy("profile").agg(
        F.sum("n").alias("n_items"), F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.col("n") - 1).alias("n_removed"),
    )


def mark_duplicates(items: DataFrame) -> DataFrame:
    """Keep every row; ``duplicate`` is true from the second row of a key on.

    The first place of each key is a small aggregate.  It is joined back on key *and*
    place, so the rows of a hot key hash to different tasks.
    """
    lane = F.when(F.col("source").isin("youtube", "bilibili"), F.col("source")).otherwise("web")
    keyed = items.withColumns({
        "_lane": lane,
        "_key": tracker_key(F.col("url"), F.col("bvid"), F.col("source")),
    })
    firsts = (
        keyed.filter(F.col("_key").isNotNull()).groupBy("profile", "_lane", "_key")
        .agg(F.min(F.struct(*_PLACE)).alias("f"))
        .select("profile", "_lane", "_key", "f.*", F.lit(True).alias("_first"))
    )
    joined = keyed.join(firsts, ["profile", "_lane", "_key", *_PLACE], "left")
    return joined.select(
        *items.columns,
        (F.col("_key").isNotNull() & F.col("_first").isNull()).alias("duplicate"),
    )


def dedup_across_channels(uploads: DataFrame) -> DataFrame:
    """First upload per video id over all channels of a profile; uploads without id are dropped."""
    named = uploads.filter(blank_to_null(F.col("video_id")).isNotNull())
    return first_by(named, ["profile", "video_id"], _PLACE)


def flag_known(crawled: DataFrame, catalog: DataFrame) -> DataFrame:
    """Crawled uploads plus ``known``: is the video id already in the catalogue?"""
    ids = (
        catalog.select("profile", blank_to_null(video_id_simple(F.col("url"))).alias("_vid"))
        .filter(F.col("_vid").isNotNull()).distinct().withColumn("_known", F.lit(True))
    )
    keyed = crawled.withColumn("_vid", blank_to_null(F.col("video_id")))
    joined = spread_join(keyed, ids, ["profile", "_vid"], _PLACE)
    return joined.select(*crawled.columns, F.col("_known").isNotNull().alias("known"))


def split_new_known(crawled: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    flagged = flag_known(crawled, catalog)
    return (
        flagged.filter(~F.col("known")).drop("known"), flagged.filter("known").drop("known"),
    )
