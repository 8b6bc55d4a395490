import random

import pytest
from pyspark.sql import functions as F

from catalogia.operators import dedup, reports, running_counts
from catalogia.sources.versioned import Catalogue

KEPT = ["profile", "file_id", "ord", "original_file_id", "url", "bvid", "source", "category", "classification_reason", "confidence"]
CATEGORIES = ["concerts", "interviews", "discard", "unclassified"]


@pytest.fixture
def made(make_items):
    def make(n, seed, **fixed):
        rng = random.Random(seed)
        return make_items(*[{
            "url": f"https://www.youtube.com/watch?v=video{rng.randrange(8):06d}", "source": "youtube",
            "profile": rng.choice(["a", "b", "c"]), "original_file_id": rng.choice([2, 3, None]),
            "category": rng.choice(CATEGORIES), "classification_reason": rng.choice(["r", "s", None]),
            "confidence": rng.choice([0.1, 0.5, 0.8, 0.95, None]), **fixed} for _ in range(n)]).select(*KEPT)

    return make


def rows(df):
    return sorted(map(repr, df.collect()))


def test_counts_after_changes_are_those_of_a_recount(spark, made, tmp_path):
    catalogue, path, keys = Catalogue(spark, str(tmp_path / "catalogue")), str(tmp_path / "counts"), str(tmp_path / "keys")
    categories = spark.createDataFrame(
        [(p, c, c.title(), i) for p in "abc" for i, c in enumerate(CATEGORIES[:2])], "profile string, key string, label string, id int")
    decisions = spark.createDataFrame(
        [("a", f"https://www.youtube.com/watch?v=video{i:06d}", action, 1) for i, action in enumerate(["approve", "reject", "skip"])],
        "profile string, url string, action string, decided_at long")
    steps = [
        lambda: catalogue.rewrite(made(60, 1)),
        lambda: catalogue.rewrite(made(20, 2, profile="b")),
        lambda: catalogue.review(decisions),
        lambda: catalogue.append_discards(made(15, 3)),
        lambda: catalogue.rewrite(made(0, 4), profiles=["c"]),
        lambda: catalogue.rewrite(made(0, 5), profiles=["a", "b"]),
    ]
    n = F.col("n")
    for number, step in enumerate(steps):
        step()
        if number == 3:
            # Two versions in one update.
            continue
        items, state = catalogue.read(), running_counts.update(catalogue, path)
        for report in (reports.reason_counts, reports.confidence_buckets, reports.migration_matrix, reports.rule_counts):
            assert rows(report(state, n=n)) == rows(report(items)), report
        for report in (reports.category_counts, reports.catalog_counts, reports.profile_summary):
            assert rows(report(state, categories, n=n)) == rows(report(items, categories)), report
        per_key = running_counts.update(catalogue, keys, running_counts.duplicate_keys())
        assert rows(dedup.dup_totals(per_key)) == rows(dedup.dup_count(items))
    assert state.count() == 0


def test_only_changed_commits_are_read(spark, made, tmp_path):
    catalogue = Catalogue(spark, str(tmp_path / "catalogue"))
    with pytest.raises(ValueError):
        catalogue.changes(0)
    first = catalogue.rewrite(made(30, 1, profile="a"))
    catalogue.rewrite(made(10, 2, profile="b"))
    second = catalogue.rewrite(made(5, 3, profile="b"))
    since = catalogue.changes(second - 1)
    assert {(r["profile"], r["sign"]): r["count"] for r in since.groupBy("profile", "sign").count().collect()} == {
        ("b", 1): 5, ("b", -1): 10}
    commits = {m["version"]: m["commit"] for m in catalogue.history()}
    assert not any(commits[first] in f for f in since.inputFiles())
    assert catalogue.changes(second).count() == 0


def test_a_failed_write_is_not_taken_for_counts(spark, made, tmp_path):
    catalogue, path = Catalogue(spark, str(tmp_path / "catalogue")), tmp_path / "counts"
    catalogue.rewrite(made(20, 1))
    running_counts.update(catalogue, str(path))
    catalogue.rewrite(made(10, 2, profile="a"))
    # What a run leaves that ended before its last step.
    made(3, 9).withColumn("n", F.lit(1)).write.parquet(str(path / "at=2"))
    (path / "at=2" / "_SUCCESS").unlink()
    got = running_counts.update(catalogue, str(path))
    assert rows(reports.rule_counts(got, n=F.col("n"))) == rows(reports.rule_counts(catalogue.read()))
    assert rows(running_counts.update(catalogue, str(path))) == rows(got)
