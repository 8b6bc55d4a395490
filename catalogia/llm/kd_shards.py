"""Sharding by a k-d tree: nodes are split at distributed weighted medians of their widest dimension.

Only the tree comes to the driver: one small record per node, so as many as there are leaves.
Points stay distributed; a median is found in rounds of bucket sums, each round narrowing the
bucket that holds it, first along the dimension and then along a tie value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from catalogia.llm.common import join_counted, numbered, stored
from catalogia.operators.distribution import attach, ordered_index, spread_join

BUCKETS = 1024


def ranked(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Add the place of a string among the distinct ones of its column; null is lowest.

    Distinct values are numbered by ranges and met again by a size-checked join.
    """
    values = rows.select(F.col(column).alias("_value"), F.lit(0).alias("_all")).filter("_value is not null").distinct()
    places = ordered_index(values, ["_all"], [], "_value", "_rank").select(
        F.col("_value").alias(column), F.col("_rank").cast("double").alias(name))
    return attach(rows, places, [column], ["doc_id", "same"], "left").withColumn(name, F.coalesce(name, F.lit(-1.0)))


def _narrow(points: DataFrame, nodes: list[dict], value: str, low: str, high: str) -> None:
    """One round: per node, shrink [low, high] of ``value`` to the bucket holding its target weight."""
    spark = points.sparkSession
    fields = ["node", "dim", "v0", "v1", "t0", "t1", "before", "target"]
    table = spark.createDataFrame(
        [tuple(n[f] for f in fields) for n in nodes],
        "node long, dim int, v0 double, v1 double, t0 double, t1 double, before double, target double",
    )
    here = points.join(F.broadcast(table), "node").withColumn("v", F.expr("element_at(coords, dim)"))
    here = here.filter("v between v0 and v1")
    if value == "tie":
        here = here.filter("tie between t0 and t1")
    step = F.floor((F.col(value) - F.col(low)) / (F.col(high) - F.col(low)) * BUCKETS)
    bucket = F.when(F.col(high) > F.col(low), F.least(step, F.lit(BUCKETS - 1))).otherwise(0)
    sums = here.groupBy("node", bucket.alias("bucket"), "before", "target").agg(
        F.sum("weight").alias("w"), F.min(value).alias("a"), F.max(value).alias("b")
    )
    upto = F.sum("w").over(
        Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        sums.withColumn("upto", F.col("before") + upto)
        .filter(F.col("upto") >= F.col("target"))
        .groupBy("node").agg(F.min(F.struct("bucket", "a", "b", "upto", "w")).alias("hit"))
    )
    by_node = {r["node"]: r["hit"] for r in found.collect()}
    for n in nodes:
        hit = by_node.get(n["node"])
        if hit is not None:
            n[low], n[high] = hit["a"], hit["b"]
            n["before"], n["upto"] = hit["upto"] - hit["w"], hit["upto"]


def kd_leaves(points: DataFrame, leaves: int) -> DataFrame:
    """Add ``leaf`` (0 .. leaves - 1) to points (``coords`` array<double>, ``tie`` double, ``weight``).

    ``tie`` in [0, 1) orders points of one value.  A node of an odd number of leaves is split in
    that proportion.  The widest dimension is that with the largest extent relative to the
    extent of all points; the first one wins a draw.  No points: no rows.  ``points`` is read
    several times per level: give a stored table.
    """
    spark = points.sparkSession
    current = points.withColumn("node", F.lit(1).cast("long"))
    tree, root = {1: (0, leaves)}, None
    dims = (points.select(F.max(F.size("coords")).alias("n")).first()["n"]) or 0
    while dims and any(n > 1 for _, n in tree.values()):
        open_nodes = [k for k, (_, n) in tree.items() if n > 1]
        listed = spark.createDataFrame([(k,) for k in open_nodes], "node long")
        stats = current.join(F.broadcast(listed), "node").groupBy("node").agg(
            F.sum("weight").cast("double").alias("weight"),
            *[F.min(F.col("coords")[d]).alias(f"a{d}") for d in range(dims)],
            *[F.max(F.col("coords")[d]).alias(f"b{d}") for d in range(dims)],
        ).collect()
        if root is None:
            root = [max(stats[0][f"b{d}"] - stats[0][f"a{d}"], 1e-300) for d in range(dims)]
        nodes = []
        for s in stats:
            wide = [(s[f"b{d}"] - s[f"a{d}"]) / root[d] for d in range(dims)]
            d, count = wide.index(max(wide)), tree[s["node"]][1]
            nodes.append({
                "node": s["node"], "dim": d + 1, "v0": s[f"a{d}"], "v1": s[f"b{d}"], "t0": 0.0,
                "t1": 1.0, "before": 0.0, "upto": s["weight"],
                "target": s["weight"] * (count // 2) / count,
            })
        # Each round leaves one bucket of a node's range, until that holds one value, then one tie.
        for value, low, high in (("v", "v0", "v1"), ("tie", "t0", "t1")):
            while any(n[low] < n[high] for n in nodes):
                _narrow(current, nodes, value, low, high)
        for n in nodes:  # the last point goes to the side that it unbalances less
            n["inclusive"] = n["upto"] - n["target"] <= n["target"] - n["before"]
        splits = spark.createDataFrame(
            [(n["node"], n["dim"], n["v0"], n["v1"], n["t0"], n["t1"], n["inclusive"]) for n in nodes],
            "node long, dim int, v0 double, v1 double, t0 double, t1 double, inclusive boolean",
        )
        value = F.expr("element_at(coords, dim)")
        left = (value < F.col("v0")) | ((value <= F.col("v1")) & F.when(
            F.col("inclusive"), F.col("tie") <= F.col("t1")).otherwise(F.col("tie") < F.col("t0")))
        current = current.join(F.broadcast(splits), "node", "left").withColumn(
            "node", F.when(F.col("dim").isNull(), F.col("node"))
            .otherwise(F.col("node") * 2 + F.when(left, 0).otherwise(1))
        ).select(*points.columns, "node")
        grown = {k: v for k, v in tree.items() if v[1] == 1}
        for k in open_nodes:
            first, n = tree[k]
            grown[2 * k], grown[2 * k + 1] = (first, n // 2), (first + n // 2, n - n // 2)
        tree = grown
    names = spark.createDataFrame([(k, f) for k, (f, _) in tree.items()], "node long, leaf int")
    return current.join(F.broadcast(names), "node").drop("node")


def shard_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, text_md5, shard, slot: documents dealt to shards of nearly equal bytes.

    Size is the text's UTF-8 bytes plus 1 (null: 1).  Documents with equal texts (null counts as
    empty) stay together.  ``shards`` fixes the number of leaves; otherwise splitting goes on
    until a leaf holds about ``target_bytes``.  Dimensions: size, source, language and first id
    of a group of equal texts.  ``slot`` numbers a shard's documents from 0 without gaps.  Repeated ids
    are rows of their own; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    has = set(docs.columns)
    rows = docs.select(
        # Tells rows apart that have everything else in common.
        F.rand(9).alias("_at"), "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("same"),
        *[(F.col(c) if c in has else F.lit(None)).cast("string").alias(c) for c in ("source", "lang")],
    )
    for c in ("source", "lang"):
        rows = ranked(rows, c, f"_{c}").drop(c)
    rows = stored(rows)
    coords = F.array(
        F.log(F.min("size").cast("double")), F.min("_source"), F.min("_lang"),
        F.coalesce(F.min("doc_id"), F.lit(0)).cast("double"),
    )
    groups = stored(rows.groupBy("same").agg(
        F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n"), coords.alias("coords")
    ).withColumn("tie", F.pmod(F.xxhash64("same"), F.lit(1 << 53)) / float(1 << 53)))
    if shards is None:
        total = groups.agg(F.sum("weight").alias("w")).first()["w"] or 0
        shards = max(1, -(-total // target_bytes))
    placed = stored(kd_leaves(groups, shards).select("same", "n", F.col("leaf").alias("shard")))
    dealt = stored(join_counted(rows, placed, ["same"], "_at")
                   .select("_at", "doc_id", "size", "text_crc32", F.col("same").alias("text_md5"), "shard"))
    return numbered(dealt, "shard", "_at", "slot").drop("_at")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents' rows below ``path``, one folder per shard.

    A row goes where its text was placed, so repeated and null ids and repeated rows are written
    as often as they occur; a null text goes with the empty ones.
    """
    dealt = placed.select(F.col("text_md5").alias("_md5"), "shard").distinct()
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.drop("shard").withColumn("_md5", F.unhex(F.md5(text)))
    spread_join(rows, dealt, ["_md5"], ["doc_id"], "inner").drop("_md5").write.partitionBy("shard").parquet(path)
