import pytest
from pyspark.sql import functions as F

from catalogia.sources.versioned import Catalogue, Conflict

KEPT = ["profile", "file_id", "ord", "original_file_id", "url", "category", "classification_reason", "confidence"]


@pytest.fixture
def rows(make_items):
    def make(*items):
        filled = [{"category": "concerts", "confidence": 0.5, "classification_reason": "r", "original_file_id": 2, **i} for i in items]
        return make_items(*filled).select(*KEPT)

    return make


@pytest.fixture
def catalogue(spark, tmp_path):
    return Catalogue(spark, str(tmp_path / "catalogue"))


def state(df):
    return sorted((r["profile"], r["url"], r["category"], r["confidence"]) for r in df.collect())


def test_versions_stay_readable(catalogue, rows):
    with pytest.raises(ValueError):
        catalogue.read()
    assert catalogue.version() == 0 and catalogue.orphans() == []
    assert catalogue.rewrite(rows({"url": "a"}, {"url": "b"}, {"url": "x", "profile": "o t/h=er+%"})) == 1
    assert catalogue.rewrite(rows({"url": "c"})) == 2
    assert state(catalogue.read(1)) == [("o t/h=er+%", "x", "concerts", 0.5), ("star_lin", "a", "concerts", 0.5), ("star_lin", "b", "concerts", 0.5)]
    assert state(catalogue.read()) == [("o t/h=er+%", "x", "concerts", 0.5), ("star_lin", "c", "concerts", 0.5)]
    assert state(catalogue.read(profile="star_lin")) == [("star_lin", "c", "concerts", 0.5)]
    assert state(catalogue.read(profile="nobody")) == []
    assert catalogue.read().columns == KEPT


def test_a_profile_can_lose_all_its_rows(catalogue, rows):
    catalogue.rewrite(rows({"url": "a"}, {"url": "x", "profile": "other"}))
    catalogue.rewrite(rows().limit(0), profiles=["other"])
    assert state(catalogue.read()) == [("star_lin", "a", "concerts", 0.5)]
    catalogue.rewrite(rows().limit(0), profiles=["star_lin"])
    assert state(catalogue.read()) == []


def test_review_and_discards_are_one_change_each(spark, catalogue, rows):
    catalogue.rewrite(rows({"url": "a"}, {"url": "b"}, {"url": "c"}, {"url": "a", "profile": "other"}))
    decisions = spark.createDataFrame(
        [("star_lin", "a", "reject", 1), ("star_lin", "b", "reject", 1), ("star_lin", "b", "approve", 2), ("star_lin", "c", "skip", 1)],
        "profile string, url string, action string, decided_at long")
    assert catalogue.review(decisions) == 2
    assert state(catalogue.read()) == [
        ("other", "a", "concerts", 0.5), ("star_lin", "a", "discard", 0.5), ("star_lin", "b", "concerts", 1.0), ("star_lin", "c", "concerts", 0.5)]
    more = rows({"url": "new", "ord": 9}, {"url": None, "ord": 10}, {"url": "p", "profile": "third"})
    assert catalogue.append_discards(more) == 3 and catalogue.append_discards(more) == 4
    assert sum(r["url"] in ("new", None, "p") for r in catalogue.read().collect()) == 3
    assert [m["operation"] for m in catalogue.history()] == ["rewrite", "review", "append discards", "append discards"]
    assert len(catalogue.read(2).collect()) == 4


def test_writers_of_one_profile_conflict(catalogue, rows):
    catalogue.rewrite(rows({"url": "a"}, {"url": "x", "profile": "other"}))
    catalogue.rewrite(rows({"url": "b"}), base=1)
    with pytest.raises(Conflict, match="star_lin"):
        catalogue.rewrite(rows({"url": "late"}), base=1)
    assert catalogue.rewrite(rows({"url": "y", "profile": "other"}), base=1) == 3
    assert [u for _, u, _, _ in state(catalogue.read())] == ["y", "b"]
    assert len(catalogue.orphans()) == 1


def test_a_taken_version_is_not_overwritten(catalogue, rows, monkeypatch):
    """Another writer publishes between the look at the log and the rename."""
    catalogue.rewrite(rows({"url": "a"}))
    publish, raced = Catalogue._publish, []

    def late(self, manifest):
        if not raced:
            raced.append(True)
            self.rewrite(rows({"url": "x", "profile": "other"}))
        return publish(self, manifest)

    monkeypatch.setattr(Catalogue, "_publish", late)
    assert catalogue.rewrite(rows({"url": "b"})) == 3
    assert state(catalogue.read()) == [("other", "x", "concerts", 0.5), ("star_lin", "b", "concerts", 0.5)]


def test_a_failed_write_leaves_the_last_version(catalogue, rows):
    catalogue.rewrite(rows({"url": "a"}))
    broken = rows({"url": "b"}).withColumn("url", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        catalogue.rewrite(broken)
    assert catalogue.version() == 1 and state(catalogue.read()) == [("star_lin", "a", "concerts", 0.5)]
