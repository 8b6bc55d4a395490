"""Incremental collection: new raw files are folded into an item table as they arrive.

The same operators as in batch: the first hit per key inside a micro-batch, then the
split into known and new against the items stored by earlier micro-batches.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from catalogia.operators.dedup import dedup_first
from catalogia.operators.distribution import spread_join
from catalogia.functions import batch_key
from catalogia.schema import RAW_FILE
from catalogia.sources.files import PROFILE_IN_PATH, explode_raw


def raw_stream(
    spark: SparkSession, path: str, profile: str | None = None, max_files: int = 1000, names: str = "file_*.json",
    multi_line: bool = True,
) -> DataFrame:
    """Raw hits of files that appear under ``path``; without ``profile`` each file's path names it (data/<slug>/..)."""
    files = (
        spark.readStream.schema(RAW_FILE).option("multiLine", multi_line)
        .option("pathGlobFilter", names).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files).json(path)
    )
    place = F.regexp_extract(F.col("_metadata.file_path"), PROFILE_IN_PATH, 1)
    named = F.try_url_decode(place) if profile is None else F.lit(profile)
    return explode_raw(files.withColumn("profile", named))


def _keyed(items: DataFrame) -> DataFrame:
    return items.withColumn("_key", batch_key(F.col("url"), F.col("bvid"), F.col("source")))


def _stored_before(spark: SparkSession, table: str, batch_id: int, schema) -> DataFrame:
    """Items of earlier micro-batches; a repeated micro-batch does not meet its own rows."""
    try:
        stored = spark.read.parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Nothing was stored before the first micro-batch.
        return spark.createDataFrame([], schema)
    return stored.filter(F.col("batch_id") < batch_id)


def append_new(batch: DataFrame, batch_id: int, table: str) -> None:
    """Write the hits of one micro-batch that no earlier one holds.

    The micro-batch owns one partition and overwrites it, so a rerun after a failure
    gives the same table.
    """
    spark = batch.sparkSession
    unique = dedup_first(batch)
    seen = (
        _keyed(_stored_before(spark, table, batch_id, batch.schema))
        .select("profile", "file_id", "_key").dropna().distinct().withColumn("_seen", F.lit(True))
    )
    fresh = spread_join(_keyed(unique), seen, ["profile", "file_id", "_key"], ["ord"]).filter(
        F.col("_seen").isNull()
    )
    (
        fresh.drop("_seen", "_key").withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(table)
    )


def start_ingest(hits: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start folding ``hits`` into ``table``; by default takes what is there and stops."""
    return (
        hits.writeStream.foreachBatch(lambda batch, number: append_new(batch, number, table))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        .start()
    )
