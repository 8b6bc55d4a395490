"""Reports kept current: condensed rows that a change is added to and taken from.

All reports read a few columns of few distinct values.  The catalogue condensed to those, with the
number ``n`` of items of each combination, gives the same reports as the catalogue itself (their
``n``), and a change only has to be condensed in the same way, with signs, and summed onto it: rows
that did not change are not read again.  Counts are whole numbers, so any order of changes gives
the same.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalogia.operators.dedup import dup_key
from catalogia.sources.versioned import Catalogue


def reported() -> dict[str, Column]:
    """What the reports read of an item."""
    return {c: F.col(c) for c in ("original_file_id", "category", "classification_reason", "confidence")}


def duplicate_keys() -> dict[str, Column]:
    """What counting duplicates reads of an item: as many combinations as the catalogue has keys."""
    return {"_key": dup_key()}


def condensed(changes: DataFrame, by: dict[str, Column]) -> DataFrame:
    """profile, the columns ``by`` and ``n``, the sum of ``sign`` of the rows that agree in them."""
    return changes.select("profile", *[c.alias(name) for name, c in by.items()], F.col("sign").alias("n")).groupBy(
        "profile", *by).agg(F.sum("n").alias("n"))


def merged(state: DataFrame, change: DataFrame) -> DataFrame:
    """Both summed; combinations that no item has any more are gone.  Nulls are values like others."""
    keys = [c for c in state.columns if c != "n"]
    return state.unionByName(change).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")


def _stored_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose counts were written to the end."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/at=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(re.search(r"/at=(\d+)/", f.getPath().toString()).group(1)) for f in found or [])


def update(catalogue: Catalogue, path: str, by: dict[str, Column] | None = None) -> DataFrame:
    """The condensed catalogue of the last version, stored below ``path``.

    It comes from the counts of the last earlier version stored there and the rows that came or
    went since; without any, from all rows.  A run that failed leaves no counts that are taken for
    whole, and repeating one gives the same.  ``by`` must not change between calls on one path.
    """
    spark, now, by = catalogue.spark, catalogue.version(), by or reported()
    earlier = [v for v in _stored_versions(spark, path) if v <= now]
    since = earlier[-1] if earlier else 0
    if since < now or not earlier:
        change = condensed(catalogue.changes(since, now), by)
        state = merged(spark.read.parquet(f"{path}/at={since}"), change) if earlier else change
        state.write.mode("overwrite").parquet(f"{path}/at={now}")
    return spark.read.parquet(f"{path}/at={now}")
