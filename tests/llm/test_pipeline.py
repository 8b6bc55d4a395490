from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest
from catalogia.llm import queries
from catalogia.llm.common import scratch
from helpers import awkward, documents, near, prose
from pyspark.sql import functions as F
from test_ngram_join import plain as components_of


def tables(spark, folder, texts, items, labels):
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, tmp_path):
    item, bad = prose(77, 30, 5000), "scum trash idiot"
    texts = awkward(200)
    texts += [f"{prose(200 + i, 30)} {bad} you {prose(300 + i, 30)}" for i in range(60)]
    texts += [prose(400 + i, 60) for i in range(60)]
    leak, private = len(texts), len(texts) + 1
    texts += [f"{prose(600, 40)} {item} {prose(601, 30)}", f"{prose(602, 60)} mail me.1@host.org now"]
    copies = list(range(len(texts), len(texts) + 6))
    texts += [near(prose(603, 120), k) for k in range(6)]
    labels = [(i, 1, int(bad in t)) for i, t in enumerate(texts) if t and i < leak]
    folder = tables(spark, tmp_path, texts, [(1, item)], labels)
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    first = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out, path = stage(spark, docs, folder), scratch(spark)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == first
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    clean = {r["doc_id"] for r in seen["toxicity"]}
    assert not [i for i in clean if texts[i] and bad in texts[i]] and set(range(leak, len(texts))) <= clean
    kept = sorted(r["doc_id"] for r in seen["near_duplicates"])
    ids = sorted(clean)
    assert kept == sorted(d for d, _, c in components_of(ids, [texts[i] for i in ids]) if d == c)
    assert len(set(copies) & set(kept)) == 1
    assert {r["doc_id"] for r in seen["decontamination"]} == set(kept) - {leak}
    hidden = {r["doc_id"]: r for r in seen["pii"]}
    assert "me.1@" not in hidden[private]["text"] and "@host.org" in hidden[private]["text"]
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in hidden.values())
    assert {r["doc_id"] for r in seen["packing"]} == set(hidden)
    assert corpus_pipeline.run(spark, folder).count() == len(seen["packing"])


def test_extra_and_null_rows(spark, tmp_path):
    texts = [(None, prose(1)), (None, None), (4, prose(2)), (4, prose(2)), (5, "")]
    folder = tables(spark, tmp_path, texts, [], [])
    docs = documents(spark, texts, clash=True).withColumn("component_id", F.lit(0))
    for _name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.count() == 5 and len(docs.columns) == len(set(docs.columns))


def test_one_document_of_each_component(spark):
    a, b, c, d = (prose(700 + k, 150, 5000) for k in range(4))
    texts = [(3, a), (9, near(a, 1)), (None, near(a, 2)), (None, a),
             (3, b), (2, near(b, 3)), (None, b),
             (None, c), (None, c), (None, c), (None, near(c, 4)),
             (5, d), (5, near(d, 5)), (None, ""), (None, ""), (None, None), (6, ""), (6, "")]
    docs = documents(spark, texts, clash=True)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got.pop((3, a)) == 1 and got.pop((2, near(b, 3))) == 1
    assert got.pop((None, "")) == 2 and got.pop((None, None)) == 1 and got.pop((6, "")) == 2
    assert sorted((str(doc), t in (c, near(c, 4)), n) for (doc, t), n in got.items()) == [("5", False, 1), ("None", True, 1)]


def test_empty_tables(spark, tmp_path):
    folder = tables(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_registered():
    names = [n for n in queries.QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(names)


def test_left_out_rows_are_listed_or_joined(spark, monkeypatch):
    base = [prose(800 + k, 120, 5000) for k in range(6)]
    texts = [(10 * k + j, near(t, j)) for k, t in enumerate(base) for j in range(4)] + [(None, base[0]), (7, ""), (None, None)]
    docs = documents(spark, texts)
    kept = {}
    for rows in (0, 1000):
        monkeypatch.setattr(corpus_pipeline, "LISTED_ROWS", rows)
        kept[rows] = Counter(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()))
    assert kept[0] == kept[1000] and sum(kept[0].values()) == 6 + 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_give_python_small_batches(spark, tmp_path, name):
    """What a worker holds of a batch is bounded, however long the texts are."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    folder = str(tmp_path)
    documents(spark, [(0, "few words here"), (1, "and others")]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of that kind")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    try:
        dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        long = spark.range(0, 300, 1, 1).selectExpr("repeat(cast(id % 10 as string), 100000) as text")
        sizes = [r["n"] for r in long.mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes], "rows": [b.num_rows]}) for b in batches),
            "n long, rows long").collect()]
        assert sum(sizes) > 30_000_000 and max(sizes) < 6_000_000
    finally:
        spark.conf.unset(setting)
