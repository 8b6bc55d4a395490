import json

import pytest
from pyspark.sql import functions as F

from catalogia.operators import labels, reports, review
from catalogia.operators.profiles import dims


@pytest.fixture
def catalog(make_items):
    return make_items(
        {"url": "high", "confidence": 0.95, "category": "personal_mv", "classification_reason": "a"},
        {"url": "med", "confidence": 0.55, "category": "concerts", "file_id": 4, "classification_reason": "b"},
        {"url": "low", "confidence": 0.3, "category": "personal_mv", "classification_reason": "b"},
        {"url": "tie", "confidence": 0.3, "category": "ost_singles", "file_id": 3, "classification_reason": "c"},
        {"url": "low", "confidence": 0.2, "category": "discard", "classification_reason": "d"},
        {"url": "open", "category": "unclassified"},
    )


def decisions(spark, *rows):
    named = [("star_lin", *r) if len(r) == 3 else r for r in rows]
    return spark.createDataFrame(named, "profile string, url string, action string, decided_at int")


def urls(df):
    return [r["url"] for r in df.collect()]


def test_review_queue(spark, catalog):
    assert urls(review.review_queue(catalog)) == ["low", "tie", "med"]
    assert urls(review.review_queue(catalog, threshold=0.5)) == ["low", "tie"]
    assert urls(review.review_queue(catalog, category="concerts")) == ["med"]
    done = decisions(spark, ("low", "skip", 1), ("high", "approve", 1))
    assert urls(review.review_queue(catalog, decisions=done)) == ["tie", "med"]


def test_latest_decision_counts(spark):
    d = decisions(spark, ("a", "reject", 1), ("a", "approve", 3), ("a", "skip", 2))
    assert review.latest_decisions(d).collect()[0]["action"] == "approve"


def test_apply_review(spark, catalog):
    d = decisions(spark, ("med", "approve", 1), ("low", "reject", 1), ("tie", "skip", 1))
    kept, discards = review.apply_review(catalog, d)
    got = {r["url"]: r for r in kept.collect()}
    assert set(got) == {"high", "med", "tie", "open"}
    assert got["med"]["confidence"] == 1.0 and got["med"]["confidence_signals"] == {"review_approved": 1.0}
    assert got["tie"]["confidence"] == 0.3 and got["high"]["confidence"] == 0.95
    assert sorted(r["classification_reason"] for r in discards.collect()) == ["d", "review_rejected"]
    untouched, before = review.apply_review(catalog, d.filter("false"))
    assert untouched.count() == 5 and before.count() == 1


def test_decisions_hold_for_their_profile_only(spark, make_items):
    rows = {"url": "u", "confidence": 0.3, "category": "concerts", "classification_reason": "a"}
    items = make_items({**rows, "profile": "one"}, {**rows, "profile": "two"})
    d = decisions(spark, ("one", "u", "reject", 1), ("two", "u", "skip", 1))
    kept, discards = review.apply_review(items, d)
    assert [r["profile"] for r in kept.collect()] == ["two"]
    assert [r["profile"] for r in discards.collect()] == ["one"]
    left = review.review_queue(items, decisions=d.filter("profile = 'one'")).collect()
    assert [r["profile"] for r in left] == ["two"]


def test_action_summary(spark, catalog):
    d = decisions(spark, ("low", "reject", 1), ("tie", "skip", 1))
    got = review.action_summary(review.review_queue(catalog), d).first()
    assert tuple(got)[1:] == (3, 0, 1, 1, 1)


def test_batches_and_prompts(make_items, profiles):
    items = make_items(*[
        {"category": "unclassified", "title": f"t{i}", "channel": "c" if i else None, "description": "d" * 300}
        for i in range(23)
    ], {"category": "concerts"})
    batches = labels.label_batches(items)
    assert sorted((r["batch_id"], r["index"], r["ord"]) for r in batches.collect()) == [
        (i // 20, i % 20, i) for i in range(23)]
    d = dims(profiles)
    got = labels.label_prompts(batches, d["categories"], d["profiles"]).orderBy("batch_id").collect()
    assert [r["n_items"] for r in got] == [20, 3]
    assert got[1]["message"].startswith("请对以下 3 条视频进行分类：\n\n[0] 标题: t20\n    频道: c\n    时长: N/A\n    简介: " + "d" * 200 + "\n\n[1]")
    assert "    频道: N/A" in got[0]["message"]
    assert got[0]["category_lines"].splitlines()[-1] == "- discard: 与林星河无关的内容"


def test_parse_responses(spark):
    one = json.dumps([{"index": 0, "category": "concerts", "reason": "r"}])
    raws = [
        one, json.dumps({"result": one}), json.dumps({"result": json.loads(one)}),
        json.dumps([{"content": [{"type": "thinking", "text": "x"}, {"type": "text", "text": one}]}]),
        json.dumps([{"type": "text", "text": one}]), json.dumps([{"content": one}]),
        json.dumps([{"result": one}]), json.dumps([one]), f"  {one}\n",
        "plain text", json.dumps({"a": 1}), json.dumps({"result": "no"}), "", json.dumps({"index": 0}), "[broken",
    ]
    df = spark.createDataFrame([("p", i, r) for i, r in enumerate(raws)], "profile string, batch_id int, raw string")
    got = labels.parse_label_responses(df).collect()
    assert sorted(r["batch_id"] for r in got) == list(range(9))
    assert {(r["index"], r["category"], r["reason"], r["pos"]) for r in got} == {(0, "concerts", "r", 0)}
    fence = spark.createDataFrame([("p", 0, f"```json\n{one}\n```")], "profile string, batch_id int, raw string")
    assert labels.parse_label_responses(fence).count() == 0
    assert labels.parse_label_responses(fence, fences=True).count() == 1


def test_apply_labels_and_finalise(spark, make_items, profiles):
    items = make_items(*[{"category": "unclassified", "title": str(i), "view_count": 5} for i in range(6)])
    batches = labels.label_batches(items)
    given = spark.createDataFrame(
        [("star_lin", 0, 0, 0, "concerts", "r"), ("star_lin", 0, 1, 1, "nonsense", "r"), ("star_lin", 0, 2, 2, "discard", None),
         ("star_lin", 0, 3, 3, "concerts", "first"), ("star_lin", 0, 4, 3, "variety", "last"), ("star_lin", 0, 5, None, "variety", "x"),
         ("star_lin", 0, 6, 5, None, "r")],
        "profile string, batch_id bigint, pos int, index int, category string, reason string")
    categories = dims(profiles)["categories"]
    labelled = labels.apply_labels(batches, given, categories)
    got = [(r["category"], r["classification_reason"]) for r in labelled.orderBy("ord").collect()]
    assert got == [("concerts", "llm_r"), ("unclassified", "llm_r"), ("discard", "llm_llm_fallback"),
                   ("variety", "llm_last"), ("unclassified", "llm_missing_index"), ("unclassified", "llm_r")]
    failed = spark.createDataFrame([("star_lin", 0)], "profile string, batch_id bigint")
    lost = labels.apply_labels(batches, given, categories, failed)
    assert {(r["category"], r["classification_reason"]) for r in lost.collect()} == {("unclassified", "llm_error")}
    rule_rows = make_items({"category": "concerts", "confidence": 0.9}, {"category": "unclassified"})
    done = labels.finalise(rule_rows, labelled, profiles)
    assert done.count() == 7 and done.filter("confidence is null").count() == 0
    # Labelled rows pass no view filter.
    assert done.filter("category = 'concerts'").count() == 2


def test_reports(catalog, profiles):
    categories = dims(profiles)["categories"]
    counts = {r["category"]: r["n"] for r in reports.category_counts(catalog, categories).collect()}
    assert counts == {"personal_mv": 2, "ost_singles": 1, "concerts": 1, "variety": 0, "interviews": 0,
                      "group_mv": 0, "collabs": 0, "discard": 1, "unclassified": 1, "TOTAL": 6}
    first = reports.reason_counts(catalog).first()
    assert (first["reason"], first["n"]) == ("b", 2)
    assert "unknown" in {r["reason"] for r in reports.reason_counts(catalog).collect()}
    buckets = {r["bucket"]: r for r in reports.confidence_buckets(catalog).collect()}
    assert [buckets[b]["n"] for b in ("high", "medium", "low")] == [1, 1, 3]
    assert buckets["low"]["percent"] == 60.0 and buckets["low"]["mean_confidence"] == 0.46
    tagged = catalog.withColumn("original_file_id", F.col("file_id"))
    matrix = {r["original_file_id"]: r for r in reports.migration_matrix(tagged).collect()}
    assert matrix[2]["personal_mv"] == 2 and matrix[3]["concerts"] == 0
    missing = {r["category"]: r["missing"] for r in reports.catalog_counts(catalog, categories).collect()}
    assert missing["variety"] and not missing["concerts"]
    assert tuple(reports.profile_summary(catalog, categories).first()) == ("star_lin", 4, 3)
    assert tuple(reports.rule_counts(catalog).first()) == ("star_lin", 5, 1)
