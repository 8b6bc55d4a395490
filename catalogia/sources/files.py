"""Collections, catalogues, decisions and documents on storage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalogia import fixed_values as V
from catalogia.schema import CATALOG_FILE, DECISIONS_FILE, RAW_FILE

# Place of a hit inside its file: batch number, then position, in one sortable number.
_BATCH_SHIFT = 32


# Where a path names the profile that a file belongs to.
PROFILE_IN_PATH = r"/data/([^/]+)/"
_BROKEN = "_broken"


def _read_nested(spark: SparkSession, path: str, shape, profile, skip_unreadable: bool) -> DataFrame:
    """Nested JSON files named ``file_*.json`` below ``path``, of one profile or of the one in each path."""
    broken = T.StructType([*shape.fields, T.StructField(_BROKEN, T.StringType())])
    files = (
        spark.read.schema(broken).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN).option("pathGlobFilter", "file_*.json")
        .option("recursiveFileLookup", True).json(path)
    )
    place = F.col("_metadata.file_path")
    named = F.try_url_decode(F.regexp_extract(place, PROFILE_IN_PATH, 1)) if profile is None else F.lit(profile)
    files = files.withColumns({"profile": named, "_path": place})
    if skip_unreadable:
        return files.filter(F.col(_BROKEN).isNull())
    failed = F.raise_error(F.concat(F.lit("unreadable file "), F.col("_path")))
    return files.filter(F.when(F.col(_BROKEN).isNotNull(), failed.cast("boolean")).otherwise(True))


def unreadable_files(spark: SparkSession, path: str, shape=RAW_FILE) -> DataFrame:
    """(profile, path, reason) of the files below ``path`` that are no JSON of the given shape."""
    broken = T.StructType([*shape.fields, T.StructField(_BROKEN, T.StringType())])
    files = (
        spark.read.schema(broken).option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN).option("pathGlobFilter", "file_*.json")
        .option("recursiveFileLookup", True).json(path)
    )
    place = F.col("_metadata.file_path")
    return files.select(
        F.try_url_decode(F.regexp_extract(place, PROFILE_IN_PATH, 1)).alias("profile"), place.alias("path"),
        "file_id", _BROKEN,
    ).filter(F.col(_BROKEN).isNotNull()).select(
        "profile", "path",
        # Spark wants a column besides the broken text to be read; it is null in such a row.
        F.concat(F.lit("not valid JSON: "), F.substring(_BROKEN, 1, 100), F.coalesce(
            F.col("file_id").cast("string"), F.lit(""))).alias("reason"),
    )


def explode_raw(files: DataFrame) -> DataFrame:
    """Search batches to item rows.  ``ord`` keeps batch and result order."""
    batches = files.select(
        "profile", "file_id", F.posexplode("searches").alias("_batch", "_s")
    )
    hits = batches.select(
        "profile", "file_id", "_batch", F.col("_s.tool").alias("_tool"),
        F.col("_s.query").alias("_query"), F.posexplode("_s.results").alias("_pos", "_r"),
    )
    place = F.shiftleft(F.col("_batch").cast("bigint"), _BATCH_SHIFT) + F.col("_pos")
    return hits.select("profile", "file_id", place.alias("ord"), "_tool", "_query", "_r.*").drop(
        "source", "search_query"
    ).withColumnsRenamed({"_tool": "source", "_query": "search_query"})


def read_raw(
    spark: SparkSession, path: str, profile: str | None = None, skip_unreadable: bool = False,
) -> DataFrame:
    """Hits of all raw files below ``path``; without ``profile`` each file's path names it (data/<slug>/..).

    A file that is no JSON fails the read unless it is to be skipped; ``unreadable_files`` lists such.
    """
    return explode_raw(_read_nested(spark, path, RAW_FILE, profile, skip_unreadable))


def explode_catalog(files: DataFrame) -> DataFrame:
    """Catalogue files to item rows tagged with their file."""
    hits = files.select("profile", "file_id", F.posexplode("results").alias("_pos", "_r"))
    return hits.select(
        "profile", "file_id", F.col("_pos").cast("bigint").alias("ord"), "_r.*"
    ).withColumn("original_file_id", F.coalesce("original_file_id", "file_id"))


def read_catalog_files(
    spark: SparkSession, path: str, profile: str | None = None, skip_unreadable: bool = True,
) -> DataFrame:
    """Rows of all catalogue files below ``path``, like ``read_raw``; broken files are skipped by default."""
    return explode_catalog(_read_nested(spark, path, CATALOG_FILE, profile, skip_unreadable))


def write_catalog(
    items: DataFrame, path: str, fmt: str = "parquet", keep_unclassified: bool = True,
) -> None:
    """One partition per profile, rows of a category side by side; discards are the category ``discard``.

    The profiles that ``items`` holds are overwritten whole, so that a category that has become
    empty leaves no rows behind; other profiles stay.  The rebalance hint lets a large category
    fill several files and small ones share a task.  ``keep_unclassified=False`` drops rows that no
    rule and no label settled.
    """
    kept = items if keep_unclassified else items.filter(F.col("category") != V.UNCLASSIFIED)
    (
        kept.hint("rebalance", F.col("profile"), F.col("category"))
        .sortWithinPartitions("profile", "category").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("profile").format(fmt).save(path)
    )


def read_catalog(
    spark: SparkSession, path: str, profile: str | None = None, category: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Catalogue rows; the profile prunes partitions, the category prunes row groups."""
    items = spark.read.format(fmt).load(path)
    if profile is not None:
        items = items.filter(F.col("profile") == profile)
    return items if category is None else items.filter(F.col("category") == category)


def catalog_metadata(items: DataFrame, categories: DataFrame, processed_at: str) -> DataFrame:
    """Envelope of each category file: path, title, description, count."""
    counts = items.groupBy("profile", "category").agg(F.count(F.lit(1)).alias("n"))
    return categories.withColumn("category", F.col("key")).join(
        counts, ["profile", "category"], "left"
    ).select(
        "profile", "category", F.col("id").alias("file_id"), "output_path",
        F.col("label").alias("title"), "description", F.lit(processed_at).alias("processed_at"),
        F.coalesce("n", F.lit(0)).alias("total_results"),
    )


def append_discards(discards: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add discards to a catalogue; rows that are there already (same place and url) are not added again."""
    rows = discards.withColumn("category", F.lit(V.DISCARD))
    place = ["profile", "original_file_id", "file_id", "ord", "url"]
    try:
        known = rows.sparkSession.read.format(fmt).load(path).filter(F.col("category") == V.DISCARD)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in place]
        rows = rows.alias("n").join(known.select(*place).alias("k"), same, "left_anti")
    rows.hint("rebalance", F.col("profile")).write.mode("append").partitionBy("profile").format(fmt).save(path)


def explode_decisions(files: DataFrame) -> DataFrame:
    """Maps of url to action as rows (url, action, decided_at), after any other columns."""
    rest = [c for c in files.columns if c not in ("reviewed", "session_start")]
    return files.select(
        *rest, F.explode("reviewed").alias("url", "action"),
        F.col("session_start").try_cast("timestamp").alias("decided_at"),
    )


def read_decisions(spark: SparkSession, path: str, profile: str | None = None) -> DataFrame:
    """Review state files to rows (profile, url, action, decided_at); a path may name the profile."""
    files = spark.read.schema(DECISIONS_FILE).option("multiLine", True).json(path)
    place = F.regexp_extract(F.col("_metadata.file_path"), PROFILE_IN_PATH, 1)
    named = F.try_url_decode(place) if profile is None else F.lit(profile)
    return explode_decisions(files.withColumn("profile", named))


def write_decisions(decisions: DataFrame, path: str, mode: str = "append") -> None:
    decisions.select("profile", "url", "action", "decided_at").write.mode(mode).parquet(path)


def crawl_summary(flagged: DataFrame) -> DataFrame:
    """Totals of a crawl from ``flag_known`` rows."""
    return flagged.groupBy("profile").agg(
        F.count(F.lit(1)).alias("total_uploads"), F.count_if(~F.col("known")).alias("new_videos"),
        F.count_if(F.col("known")).alias("already_known"),
    )


def write_documents(lines: DataFrame, path: str) -> None:
    """Text files per profile and category whose names sort in reading order.

    Ranges of lines, not whole documents, are the unit of work.  Only the documents that
    ``lines`` holds are overwritten.
    """
    place = ["profile", "category", "section", "block", "file_id", "ord"]
    (
        lines.repartitionByRange(*place).sortWithinPartitions(*place)
        .select("profile", "category", "text").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("profile", "category").text(path)
    )
