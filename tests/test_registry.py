"""Registered queries next to their SQL on the smallest tables.

By default a few of them; CATALOGIA_PARITY=all runs every one.
"""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"
SOME = ["classify_rules", "confidence_scores", "dedup_first", "dedup_richest", "apply_link_checks",
        "category_counts", "track_coverage_gram", "gen_queries"]
NAMES = list(entry.queries()) if os.environ.get("CATALOGIA_PARITY") == "all" else SOME

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_parity(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in entry.oracle_sql():
        cursor = connect(SF).execute(entry.oracle_sql()[name])
        assert difference(df.columns, rows, [d[0] for d in cursor.description], cursor.fetchall()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_finalise_keeps_every_item_once(spark):
    """Unclassified items go to the labeller unfiltered and come back once."""
    queries, key = entry.queries(), ["profile", "file_id", "ord"]
    done = queries["finalise"](spark, SF).select(*key).collect()
    lines = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("sum(size(split(text, '\\n'))) as n").first()["n"]
    assert len(done) == len(set(done)) == lines
    counts = queries["rule_counts"](spark, SF).collect()
    assert sum(r["n_unclassified"] for r in counts) == queries["label_batches"](spark, SF).count()
