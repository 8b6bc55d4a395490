import random
import zlib
from collections import Counter

import pytest

from catalogia.llm.common import join_counted, numbered
from catalogia.llm.kd_shards import kd_leaves, ranked, shard_documents, write_shards
from helpers import awkward, documents, prose


def test_shards(spark):
    texts = [prose(i, 20 + i % 90) for i in range(600)] + awkward(300) + [prose(1, 21)] * 30
    rows = shard_documents(documents(spark, texts, clash=True), shards=6).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    sizes, slots, where = [0] * 6, [[] for _ in range(6)], {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where.setdefault(raw, set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    group = max(len((t or "").encode()) + 1 for t in texts) + 31 * 200
    assert max(sizes) - min(sizes) < group


def test_target_bytes_copies_and_empty(spark, tmp_path):
    docs = documents(spark, [prose(i, 50) for i in range(64)])
    placed = shard_documents(docs, target_bytes=3000)
    found = placed.groupBy("shard").sum("size").collect()
    assert 4 <= len(found) and max(r["sum(size)"] for r in found) < 4500
    write_shards(docs, placed, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 64
    same = shard_documents(documents(spark, ["x"] * 9 + [(3, "x"), (None, None)]), shards=4).collect()
    assert len(same) == 11 and len({r["shard"] for r in same if r["text_crc32"]}) == 1
    assert shard_documents(documents(spark, []), shards=8).count() == 0


def test_hot_keys_and_numbers(spark, monkeypatch):
    import catalogia.llm.common as common
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "CELL_ROWS", 7)
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(90)], "k long, id long")
    index = rows.groupBy("k").count().withColumnRenamed("count", "n")
    joined = join_counted(rows, index, ["k"], "id").collect()
    assert sorted(r["id"] for r in joined) == list(range(90))
    got = numbered(rows, "k", "id", "at").collect()
    by = {}
    for r in got:
        by.setdefault(r["k"], []).append(r["at"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def plain_leaves(points, leaves):
    """Leaf of each point (coords, tie, weight) by recursion over sorted lists."""
    dims = len(points[0][0])
    root = [max(max(p[0][d] for p in points) - min(p[0][d] for p in points), 1e-300) for d in range(dims)]

    def split(rows, first, n):
        if n == 1 or not rows:
            return {i: first for i in rows}
        wide = [(max(points[i][0][d] for i in rows) - min(points[i][0][d] for i in rows)) / root[d] for d in range(dims)]
        d = wide.index(max(wide))
        order = sorted(rows, key=lambda i: (points[i][0][d], points[i][1]))
        total = sum(points[i][2] for i in rows)
        target, upto = total * (n // 2) / n, 0.0
        for k, i in enumerate(order):
            before, upto = upto, upto + points[i][2]
            if upto >= target:
                break
        k += upto - target <= target - before
        return split(order[:k], first, n // 2) | split(order[k:], first + n // 2, n - n // 2)

    return split(list(range(len(points))), 0, leaves)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_a_plain_tree(spark, seed, monkeypatch):
    monkeypatch.setattr("catalogia.llm.kd_shards.BUCKETS", 4)
    r = random.Random(seed)
    points = [([r.choice([0.0, 1.0, 1e9, 1e9 + 1, r.random()]), float(r.randrange(4)), r.gauss(0, 1)], r.random(),
               r.randrange(1, 500)) for _ in range(300)]
    rows = [(i, *p) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, coords array<double>, tie double, weight long")
    got = {row["id"]: row["leaf"] for row in kd_leaves(df, 7).collect()}
    assert got == plain_leaves(points, 7)


def test_sources_with_equal_beginnings_are_told_apart(spark):
    df = spark.createDataFrame([(i, "x", f"source-long-{i % 4}" if i % 5 else None) for i in range(40)], "doc_id long, same string, source string")
    places = {r["source"]: r["at"] for r in ranked(df, "source", "at").collect()}
    assert places == {None: -1.0, **{f"source-long-{k}": float(k) for k in range(4)}}


def test_every_row_is_written_once(spark, tmp_path):
    texts = [(1, "one"), (1, "one"), (1, "two"), (None, "one"), (None, None), (None, ""), (2, None)] + [
        (5, prose(k, 30)) for k in range(20)]
    docs = documents(spark, texts, clash=True)
    placed = shard_documents(docs, shards=4)
    write_shards(docs, placed, str(tmp_path / "s"))
    written = spark.read.parquet(str(tmp_path / "s"))
    assert Counter((r["doc_id"], r["text"]) for r in written.collect()) == Counter(texts)
    of = {bytes(r["text_md5"]): r["shard"] for r in placed.collect()}
    import hashlib
    assert all(of[hashlib.md5((r["text"] or "").encode()).digest()] == r["shard"] for r in written.collect())


def test_many_copies_of_one_row(spark, monkeypatch):
    import catalogia.llm.common as common
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    monkeypatch.setattr(common, "CELL_ROWS", 100)
    rows = shard_documents(documents(spark, [(None, "copy")] * 3000 + [(7, "other")] * 50), shards=3).collect()
    assert len(rows) == 3050
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
