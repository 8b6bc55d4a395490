"""Values and the bands that hold them: a range join for any number of bands, per profile or for all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia.operators import distribution
from catalogia.session import cut_lineage, stored

# Greatest power of two that a piece of a band may have for its length.
TOP_LEVEL = 62


def _level(length: Column) -> Column:
    """Least power of two that is not below a length."""
    return F.ceil(F.log2(F.greatest(length, F.lit(1)).cast("double"))).cast("int")


def join_bands(items: DataFrame, value: Column, bands: DataFrame, on: list[str]) -> DataFrame:
    """Each item with each band (``low`` <= value < ``high``) of its keys; whole numbers throughout.

    A band is put into cells as wide as the least power of two that is not below its length, so into
    two at most, whatever the spread of lengths; an item looks into one cell per width that occurs,
    64 at most.  Everything meets by equality.  Items without a value, and empty bands, match
    nothing.  Columns of ``bands`` other than the keys must not be among those of ``items``.
    """
    filled = bands.filter(F.col("low") < F.col("high")).withColumn("_level", _level(F.col("high") - F.col("low")))
    levels = sorted(r["_level"] for r in filled.select("_level").distinct().collect())
    width = F.expr("shiftleft(1L, _level)")
    cell_of = lambda x: F.floor(x / width.cast("decimal(20, 0)")).cast("bigint")
    placed = filled.withColumn("_cell", F.explode(F.sequence(cell_of(F.col("low")), cell_of(F.col("high") - 1))))
    asked = items.withColumn("_value", value.cast("bigint")).filter("_value is not null").withColumn(
        "_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))
    ).withColumn("_cell", cell_of(F.col("_value")))
    met = asked.join(placed, [*on, "_level", "_cell"])
    return met.filter((F.col("_value") >= F.col("low")) & (F.col("_value") < F.col("high"))).drop("_value", "_level", "_cell")


def merged_bands(items: DataFrame, value: Column, bands: DataFrame, on: list[str], **columns: Column) -> DataFrame:
    """Pieces (keys, ``low``, ``high``, ``columns``) that stand for all bands, as far as items may look into them.

    A band is cut into aligned pieces whose lengths are powers of two, about one per power below its
    length, and equal pieces are one row with ``columns``, aggregates over their bands.  A value is
    in a band if it is in one of its pieces, and then in one only, so counts, sums and extremes over
    the pieces that hold a value are those over the bands.  ``join_bands`` meets an item with at most
    one piece per length, however many bands hold it.  Pieces without an item are left out where
    the cells of the items fit a broadcast.
    """
    filled = bands.filter(F.col("low") < F.col("high")).withColumns(
        {"low": F.col("low").cast("bigint"), "high": F.col("high").cast("bigint")})
    top = F.least(_level(F.col("high") - F.col("low")), F.lit(TOP_LEVEL))
    cut = filled.withColumn("_k", F.explode(F.sequence(F.lit(0), top))).withColumns({
        "_from": F.expr("shiftright(low, _k) + if((low & (shiftleft(1L, _k) - 1)) <> 0, 1, 0)"),
        "_to": F.expr("shiftright(high, _k)"),
    }).filter("_from < _to")
    ends = F.expr("array(if(_from & 1 = 1, _from, null), if(_to & 1 = 1, _to - 1, null))")
    pieces = cut.withColumn("_piece", F.explode(ends)).filter("_piece is not null")
    most = filled.agg(F.max(top).alias("k")).first()["k"] or 0
    asked = items.select(*on, value.cast("bigint").alias("_value")).filter("_value is not null").distinct()
    cells = asked.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(most)))).select(
        F.xxhash64(*on, "_k", F.expr("shiftright(_value, _k)")).alias("_cell")).distinct()
    if distribution.fits_broadcast(cells):
        pieces = pieces.withColumn("_cell", F.xxhash64(*on, "_k", "_piece")).join(F.broadcast(cells), "_cell", "left_semi")
    merged = pieces.groupBy(*on, "_k", "_piece").agg(*[c.alias(name) for name, c in columns.items()])
    return stored(merged.select(
        *on, F.expr("shiftleft(_piece, _k)").alias("low"), F.expr("shiftleft(_piece + 1, _k)").alias("high"), *columns), "bands")


def banded_score(items: DataFrame, value: Column, bands: DataFrame, on: list[str], other: float) -> DataFrame:
    """Items plus ``band_score``: the greatest ``score`` of the bands that hold the value, else ``other``."""
    place = ["profile", "file_id", "ord"]
    kept = cut_lineage(items.withColumn("_v", value.cast("bigint")))
    held = merged_bands(kept, F.col("_v"), bands, on, score=F.max("score"))
    best = join_bands(kept.select(*dict.fromkeys([*place, *on]), "_v"), F.col("_v"), held, on).groupBy(*place).agg(
        F.max("score").alias("_best"))
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"b.{c}")) for c in place]
    joined = kept.alias("i").join(best.alias("b"), same, "left")
    return joined.select(*[F.col(f"i.{c}") for c in items.columns], F.coalesce("b._best", F.lit(other)).alias("band_score"))
