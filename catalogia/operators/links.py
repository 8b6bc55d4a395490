"""Merging the results of an outside link check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.operators.distribution import ordered_index, spread_join


def _checkable() -> Column:
    return F.col("source").isin("bilibili", "google") & F.col("url").startswith("http")


def links_to_check(items: DataFrame, chunk: int = V.LINK_CHUNK) -> DataFrame:
    """Links that need a check, numbered in chunks per file in item order."""
    links = items.filter(_checkable()).select("profile", "file_id", "ord", "url")
    numbered = ordered_index(links, ["profile", "file_id"], [], "ord", "_n")
    return numbered.withColumn("chunk", F.floor(F.col("_n") / chunk)).drop("_n")


def link_verdict(url: Column, status: Column, note: Column | None = None) -> Column:
    """struct(valid, status, note) for a url and the status an outside probe saw."""
    trusted = F.contains(url, F.lit("youtube.com/watch")) | F.contains(url, F.lit("youtu.be/"))
    valid = F.coalesce(status.isin(V.VALID_STATUSES), F.lit(False))
    code = F.coalesce(status, F.lit(0)).cast("int")
    given = F.lit(None).cast("string") if note is None else note
    failed = F.coalesce(
        F.when(code == 0, given), F.concat(F.lit("HTTP "), code.cast("string"))
    )

    def verdict(ok, number, text):
        return F.struct(ok.alias("valid"), number.cast("int").alias("status"), text.alias("note"))

    return (
        F.when(
            ~F.coalesce(url.startswith("http"), F.lit(False)),
            verdict(F.lit(False), F.lit(0), F.lit("invalid URL format")),
        )
        .when(trusted, verdict(F.lit(True), F.lit(200), F.lit("YouTube API verified")))
        .otherwise(verdict(valid, code, F.when(valid, F.lit("")).otherwise(failed)))
    )


def apply_link_checks(items: DataFrame, checks: DataFrame) -> DataFrame:
    """Merge ``checks(url, status, note)`` into the items and drop dead links.

    A link that timed out (status 0) stays, unverified.  Several checks of one url:
    the last ``checked_at`` counts if that column is there; of equal ones, or without it, the
    greatest status.
    """
    order = F.struct(*[c for c in ("checked_at", "status", "note") if c in checks.columns])
    verdicts = (
        checks.withColumn("_v", link_verdict(F.col("url"), F.col("status"), F.col("note")))
        .groupBy("url").agg(F.max_by("_v", order).alias("_v"))
        .withColumnRenamed("url", "_url")
    )
    kept = [c for c in items.columns if c not in ("verified", "verify_status", "verify_note")]
    asked = items.withColumn("_url", F.when(_checkable(), F.col("url")))
    joined = spread_join(asked, verdicts, ["_url"], ["file_id", "ord"])
    checked = F.col("_v").isNotNull()
    return joined.filter(~checked | F.col("_v.valid") | (F.col("_v.status") == 0)).select(
        *kept,
        F.when(checked, F.col("_v.valid")).otherwise(True).alias("verified"),
        F.when(checked, F.col("_v.status")).otherwise(F.col("verify_status")).alias("verify_status"),
        F.when(checked, F.col("_v.note")).otherwise(F.col("verify_note")).alias("verify_note"),
    )


def verify_counts(items: DataFrame) -> DataFrame:
    verified = F.coalesce(F.col("verified"), F.lit(False))
    return items.groupBy("profile").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if(verified).alias("n_verified"),
        F.count_if(~verified).alias("n_unverified"),
    )
