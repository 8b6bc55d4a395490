from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalogia.llm.quality_divergence import js_distance, judge_quality
from helpers import awkward, documents, prose


def plain(text):
    text = text or ""
    words = text.encode().split()
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if grams[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(" \t\n\r\v\f"):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_measures(spark):
    texts = awkward(500) + ["a\nb\na\n \n \nb", "x | y <b> # $ 5% & *", "é é\u2003é", "l\r\nl\r\nl", "a b c a b c a"]
    rows = judge_quality(documents(spark, texts, clash=True)).collect()
    assert {r["doc_id"]: tuple(r)[1:7] for r in rows} == {i: plain(t) for i, t in enumerate(texts)}
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_verdict(spark):
    junk = " ".join(f"{w}%%%" if i % 2 else f"### {w.upper()} &&& $$$" for i, w in enumerate(prose(5, 200).split()))
    texts = [(i, f"{prose(i, 150)} the of and to a in is it") for i in range(40)] + [(99, junk), (100, None), (100, "x")]
    rows = {}
    for r in judge_quality(documents(spark, texts)).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert all(rows[i][0]["kept"] for i in range(40))
    assert not rows[99][0]["kept"] and not rows[99][0]["base_failed"]
    assert len(rows[100]) == 2
    assert judge_quality(documents(spark, [])).count() == 0


@pytest.mark.parametrize(("p", "q", "d"), [
    ([0.5, 0.5], [0.5, 0.5], 0.0), ([1.0, 0.0], [0.0, 1.0], 1.0), ([0.75, 0.25], [0.25, 0.75], 0.434421)])
def test_distance(spark, p, q, d):
    df = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
    assert df.select(js_distance(F.col("p"), F.col("q"))).first()[0] == pytest.approx(d, abs=1e-5)
