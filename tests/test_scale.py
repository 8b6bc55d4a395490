"""How work is dealt over tasks, and how often inputs are read."""

import random
import re

import pytest
from pyspark.sql import functions as F

from catalogia import fixed_values as V
from catalogia.operators import browse, querygen, rank_index, review, rules, title_index
from catalogia.plans import browse_queries, tables  # noqa: F401
from catalogia.plans.registry import QUERIES


def task_sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def write(spark, tmp_path, **made):
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_parts_of_one_file_are_expanded_by_several_tasks(spark, tmp_path):
    n = 45_000
    spark.range(0, n, 1, 1).selectExpr(
        "id as p_partkey", "concat('part ', id) as p_name", "concat('Brand#', id % 7) as p_brand",
        "if(id % 3 = 0, 'LARGE', 'PROMO') as p_type", "cast(id % 50 as int) as p_size",
    ).write.parquet(f"{tmp_path}/part.parquet")
    sf_dir = write(
        spark, tmp_path, supplier=([(1, "S", 2)], "s_suppkey long, s_name string, s_nationkey long"),
        nation=([(2, "N", 3)], "n_nationkey long, n_name string, n_regionkey long"),
        region=([(3, "R")], "r_regionkey long, r_name string"),
        lineitem=([(0, 1), (1, 1)], "l_partkey long, l_suppkey long"))
    tracks = tables.part_entries(spark, sf_dir).filter("kind = 'tracks'")
    sizes = task_sizes(tracks)
    assert sum(sizes) == n and max(sizes) <= 20_000


def test_documents_of_one_task_are_expanded_by_several(spark, make_profiles, profiles):
    many = profiles.crossJoin(spark.range(0, 2500, 1, 1)).coalesce(1)
    albums = querygen.document_entries(many).filter("kind = 'albums' and i = 0")
    assert max(task_sizes(albums)) <= 1000


@pytest.mark.parametrize("pattern", sorted(
    {v for n, v in vars(V).items() if isinstance(v, str) and "|" in v and n.isupper() and "TABLE" not in n and "LINE" not in n}))
def test_patterns_match_as_before_without_trying_branches(spark, pattern):
    r = random.Random(pattern)
    pieces = [p for b in pattern.removeprefix("(?U)").split("|") for p in (
        b, re.sub(r"\\s\*", " ", b), re.sub(r"\\[sd][*+]", "7", b), re.sub(r"\\.|\?", "", b), b[:-1], b.replace(r"\d+", "12"), b.replace("\\", ""))]
    texts = [(None,), ("",)] + [("".join(r.choice(pieces + [" ", "\u2003", "x", "é"]) for _ in range(r.randrange(1, 4))),) for _ in range(400)]
    rows = spark.createDataFrame(texts, "t string").selectExpr(
        "t", f"rlike(t, r'{pattern}') as want", f"{rules.matches(pattern, 't')} as got").collect()
    assert [x for x in rows if x["want"] != x["got"]] == [] and len({x["want"] for x in rows}) == 3
    assert "rlike" not in rules.matches(V.LIVE)


def count_reads(spark, df, column):
    """``df`` with a column that counts how often a row is made."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def note(_):
        seen.add(1)
        return True

    return df.filter(note.asNondeterministic()(column)), seen


def test_the_queue_reads_its_items_once(spark, make_items):
    items = make_items(*[{"title": f"t{i}"} for i in range(40)]).selectExpr(
        "profile", "file_id", "ord", "'concerts' as category", "ord / 100D as confidence")
    counted, seen = count_reads(spark, items, "ord")
    assert [r["ord"] for r in review.review_queue(counted).collect()] == list(range(40))
    assert seen.value == 40


def test_a_title_index_reads_its_items_once(spark, make_items, tmp_path):
    counted, seen = count_reads(spark, make_items(*[{"title": f"nerth dai {i}"} for i in range(40)]), "ord")
    title_index.write_title_index(counted, str(tmp_path))
    assert seen.value == 40
    assert title_index.search_index(spark, str(tmp_path), "nerth dai").count() == 40


def test_many_ranges_are_cut_by_few_tasks(spark, make_items, tmp_path):
    items = make_items(*[{"view_count": i % 50} for i in range(300)]).repartition(3)
    rank_index.write_rank_index(items, str(tmp_path), range_rows=2)
    ranges = spark.read.parquet(f"{tmp_path}/ranges")
    assert ranges.count() == 150 and ranges.filter("n = 2").count() == 150
    want = [r["ord"] for r in browse.browse(items, limit=7, offset=141).collect()]
    assert [r["ord"] for r in rank_index.read_page(spark, str(tmp_path), 141, 7).collect()] == want


def test_pieces_of_a_rank_index_join_up(spark, make_items, tmp_path, monkeypatch):
    monkeypatch.setattr(rank_index, "INDEX_ROWS", 40)
    items = make_items(*[{"view_count": i % 7, "published_at": None} for i in range(150)])
    rank_index.write_rank_index(items, str(tmp_path), range_rows=9)
    for offset, limit in ((0, 20), (35, 60), (140, 30)):
        want = [r["ord"] for r in browse.browse(items, limit=limit, offset=offset).collect()]
        got = rank_index.read_page(spark, str(tmp_path), offset, limit).collect()
        assert [r["ord"] for r in got] == want and [r["rank"] for r in got] == list(range(offset, offset + len(want)))


def test_dimension_issues_parse_documents_once(spark, tmp_path):
    sf_dir = write(spark, tmp_path, customer=(
        [(k, f"C{k}", k % 5, "M") for k in range(30)], "c_custkey long, c_name string, c_nationkey long, c_mktsegment string"))
    plan = QUERIES["dimension_issues"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "customer" not in plan
    assert {tuple(r) for r in QUERIES["dimension_issues"](spark, sf_dir).collect()} == {
        tuple(r) for r in QUERIES["profile_issues"](spark, sf_dir).select(*QUERIES["dimension_issues"](spark, sf_dir).columns).collect()}
