"""How rows meet: size-checked broadcasts, spread joins, numbering without one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from catalogia.session import cut_lineage

# A dimension is broadcast only up to this many bytes of JSON text.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one numbering bucket.
INDEX_ROWS = 1_000_000
# Rows that one task expands into many.
SOURCE_ROWS = 20_000


def fits_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``dim`` with one distributed sum; only the total comes back."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16)
    return (dim.agg(size.alias("bytes")).first()["bytes"] or 0) <= max_bytes


def dealt(df: DataFrame, rows: int = SOURCE_ROWS) -> DataFrame:
    """``df`` dealt evenly over tasks of about ``rows`` rows.

    For rows that will become many: a small file arrives in one task, which would then sort all
    that is made of it.  The number of tasks follows from the number of rows, which is counted.
    """
    return df.repartition(max(1, -(-df.count() // rows)))


def first_by(df: DataFrame, by: list, order: list, n: int = 1, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per group.

    A bound on ``row_number`` lets Spark keep n rows per group and task *before* the
    shuffle, so a hot group never arrives whole in one task.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def spread_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: list[str], how: str = "left",
) -> DataFrame:
    """Join of a side whose keys may be missing or hot with one that has a row or few per key.

    Each side is read once.  Rows without a key match nothing: they are spread by their own identity
    (``spread``) instead of meeting in one task.  Hot keys are left to adaptive execution, which
    splits the large partitions of ``big`` and repeats the matching part of ``small``.
    """
    keyless = F.lit(False)
    for key in on:
        keyless = keyless | F.col(key).isNull()
    left = big.withColumn("_spread", F.when(keyless, F.xxhash64(*spread)).otherwise(0))
    return left.join(small.withColumn("_spread", F.lit(0).cast("bigint")), [*on, "_spread"], how).drop("_spread")


def attach(
    items: DataFrame, dim: DataFrame, on: list[str], spread: list[str], how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Give each item the row of a dimension: broadcast if measured small, else a spread join."""
    if fits_broadcast(dim, max_bytes):
        return items.join(F.broadcast(dim), on, how)
    return spread_join(items, dim, on, spread, how)


def ordered_index(
    df: DataFrame, by: list[str], lead: list[str], order: str, name: str = "index",
    pieces: int | None = None,
) -> DataFrame:
    """0-based dense number per group ``by`` in the order of (``lead``.., ``order``).

    A window over a whole group would sort a hot group in one task.  Here the rows are cut into
    ranges of (``by``.., ``lead``.., ``order``), about one per ``INDEX_ROWS`` rows, and kept with
    the number of their range; rows are numbered inside a range, and the counts of the ranges
    before it, one small row each, give the offset.  ``df`` is read to be counted and cut.
    """
    place = [*by, *lead, order]
    wanted = pieces or max(1, -(-df.count() // INDEX_ROWS))
    cut = cut_lineage(df.repartitionByRange(wanted, *place).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*lead, order)) - 1
    keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    keys.append(F.col("l._range") == F.col("r._range"))
    matched = cut.withColumn("_inside", inside).alias("l").join(offsets.alias("r"), keys, "left")
    return matched.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("r._offset") + F.col("l._inside")).alias(name),
    )
