import zlib
from pathlib import Path

import pytest

from catalogia.llm.toxicity import FEATURES, Memo, features, fit_toxicity, score_toxicity
from helpers import awkward, documents

SF = "/root/testdata/sf0.01"


def test_features():
    memo = Memo({"scum": 4.0, "trash*": 3.0})
    f = dict(zip(FEATURES, features("You SCUM!! trashy", memo), strict=True))
    assert f["hits_rate"] == 2 / 3 and f["max_weight"] == 4.0 and f["near_second_person"] == 2 / 3
    hidden = dict(zip(FEATURES, features("such 5cum here", memo), strict=True))
    assert hidden["hidden_hits"] == 1 and hidden["obfuscated_rate"] > 0
    assert features(None, memo) == features(" ", memo) == [0.0] * len(FEATURES)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rows = score_toxicity(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    known = [r for r in rows if r["toxic"] is not None and r["held_out"]]
    pos, neg = ([r["score"] for r in known if r["toxic"] == t] for t in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert wins / (len(pos) * len(neg)) > 0.9


def test_without_both_classes(spark):
    docs = documents(spark, awkward(200), clash=True)
    for rows, want in (([], 0.0), ([(i, 1, 1) for i in range(10)], 1.0), ([(None, 1, 1), (3, 0, None)], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        scored = score_toxicity(docs, labels).collect()
        assert len(scored) == docs.count() and {r["score"] for r in scored} == {want}
        kept = fit_toxicity(docs, labels).drop_toxic(docs)
        assert kept.columns == docs.columns and kept.count() == (0 if want else docs.count())


def test_awkward_rows(spark):
    bad = [f"this is scum trash idiot number {i} and you know" for i in range(80)]
    good = [f"this is a calm line number {i} and we know" for i in range(80)]
    texts = [t for pair in zip(bad, good, strict=True) for t in pair] + awkward(200) + [(None, bad[0]), (0, good[0])]
    labels = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(160)] + [(4, 1, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = documents(spark, texts, clash=True)
    scored = score_toxicity(docs, labels).collect()
    assert len(scored) == len(texts)
    assert sum(r["predicted"] for r in scored if r["doc_id"] is not None and r["doc_id"] < 160) >= 70
    kept = fit_toxicity(docs, labels).drop_toxic(docs)
    assert kept.columns == docs.columns
    assert kept.filter("text is null").count() == sum(t is None for t in texts)
