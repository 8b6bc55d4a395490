"""Deep pages of a sorted catalogue: rows stored in ranges of their order, with the rank that each starts at.

A page reads the one or two ranges that hold it, however far down it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from catalogia.operators.browse import plays
from catalogia.operators.distribution import INDEX_ROWS
from catalogia.session import cut_lineage

_TIES = ["profile", "file_id", "ord"]
RANGE_ROWS = 100_000


def _order(sort: str, desc: bool) -> list:
    key = F.coalesce("published_at", F.lit("")) if sort == "date" else plays()
    return [F.desc(key) if desc else F.asc(key), *map(F.col, _TIES)]


def write_rank_index(
    items: DataFrame, path: str, sort: str = "plays", desc: bool = True, range_rows: int = RANGE_ROWS,
) -> None:
    """Store the rows in the order of ``browse.sort_items``, cut into ranges of ``range_rows``, or fewer.

    Tasks sort about ``INDEX_ROWS`` rows each and cut them into ranges: a partition per range would
    send the driver a sample of every one of them.
    """
    order, pieces = _order(sort, desc), max(1, -(-items.count() // INDEX_ROWS))
    cut = cut_lineage(items.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id()))
    # The last row of a piece may share its range with none of the next one.
    sizes = sorted((r["_piece"], r["n"]) for r in cut.groupBy("_piece").agg(F.count(F.lit(1)).alias("n")).collect())
    first, starts = 0, []
    for piece, n in sizes:
        starts += [F.lit(piece), F.lit(first)]
        first += -(-n // range_rows)
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(*order)) - 1
    before = F.element_at(F.create_map(*starts or [F.lit(0), F.lit(0)]), F.col("_piece"))
    ranged = cut.withColumn("_range", (before + F.floor(inside / range_rows)).cast("int")).drop("_piece")
    ranged.sortWithinPartitions("_range", *order).write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    # An empty catalogue has no ranges, but columns.
    items.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
    rows = _rows(items.sparkSession, path)
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).select(
        "_range", F.coalesce(before, F.lit(0)).alias("first"), "n", F.lit(sort).alias("sort"), F.lit(desc).alias("desc"))
    starts.write.mode("overwrite").parquet(f"{path}/ranges")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(columns.add("_range", T.IntegerType())).parquet(f"{path}/rows")


def read_page(spark: SparkSession, path: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit - 1`` of the order, with their ``rank`` from 0, sorted by it."""
    ranges = spark.read.parquet(f"{path}/ranges")
    head = ranges.select("sort", "desc").first()
    rows = _rows(spark, path)
    if head is None:
        return rows.drop("_range").withColumn("rank", F.lit(0).cast("bigint"))
    met = [(r["_range"], r["first"]) for r in ranges.filter(
        (F.col("first") < offset + limit) & (F.col("first") + F.col("n") > offset)).collect()]
    starts = F.create_map(*[F.lit(x) for pair in met or [(-1, 0)] for x in pair])
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*_order(head["sort"], head["desc"]))) - 1
    page = rows.filter(F.col("_range").isin([r for r, _ in met])).withColumn(
        "rank", (F.element_at(starts, F.col("_range")) + inside).cast("bigint"))
    return page.filter(F.col("rank").between(offset, offset + limit - 1)).drop("_range").orderBy("rank")
