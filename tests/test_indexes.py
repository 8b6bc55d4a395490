import random

import pytest
from pyspark.sql import functions as F

from catalogia.operators import bands, browse, distribution, rank_index
from catalogia.plans import browse_queries, tables


@pytest.mark.parametrize("sort, desc", [("plays", True), ("date", False)])
def test_pages_equal_those_of_a_sort(spark, make_items, tmp_path, sort, desc):
    r = random.Random(1)
    items = make_items(*[
        {"view_count": r.choice([None, 0, 5, r.randrange(100)]), "published_at": r.choice([None, "", f"2020-01-{r.randrange(10, 30)}"])}
        for _ in range(230)])
    rank_index.write_rank_index(items, str(tmp_path), sort, desc, range_rows=25)
    for offset, limit in ((0, 10), (20, 30), (199, 1), (225, 50), (300, 5)):
        want = [x["ord"] for x in browse.browse(items, sort=sort, desc=desc, limit=limit, offset=offset).collect()]
        page = rank_index.read_page(spark, str(tmp_path), offset, limit).collect()
        assert [x["ord"] for x in page] == want
        assert [x["rank"] for x in page] == list(range(offset, offset + len(want)))


def test_a_page_reads_the_ranges_that_hold_it(spark, make_items, tmp_path):
    items = make_items(*[{"view_count": i} for i in range(200)])
    rank_index.write_rank_index(items, str(tmp_path), range_rows=20)
    plan = rank_index.read_page(spark, str(tmp_path), 100, 3)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(list(tmp_path.glob("rows/_range=*"))) == 10


def test_an_empty_catalogue_has_empty_pages(spark, make_items, tmp_path):
    rank_index.write_rank_index(make_items(), str(tmp_path))
    assert rank_index.read_page(spark, str(tmp_path), 0, 5).count() == 0


def test_bands_equal_brute_force(spark):
    r = random.Random(2)
    values = [(f"p{i % 2}", i, r.choice([None, 0, -5, r.randrange(-100, 5000), 2 ** 40])) for i in range(150)]
    made = [(f"p{k % 3}", k, low, low + r.choice([-3, 0, 1, 2, 7, 8, 900, 2 ** 41]), k / 10)
            for k in range(120) for low in [r.randrange(-200, 5000)]] + [("p0", 999, None, 5, 1.0)]
    items = spark.createDataFrame(values, "profile string, id int, v long")
    table = spark.createDataFrame(made, "profile string, band int, low long, high long, score double")
    got = sorted((x["id"], x["band"]) for x in bands.join_bands(items, F.col("v"), table, ["profile"]).collect())
    assert got == sorted((i, b) for p, i, v in values for q, b, low, high, _ in made
                         if p == q and v is not None and low is not None and low <= v < high)
    assert bands.join_bands(items, F.col("v"), table.limit(0), ["profile"]).count() == 0


@pytest.mark.parametrize("fits", [True, False])
def test_merged_bands_count_every_band_and_meet_an_item_once_per_length(spark, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(distribution, "fits_broadcast", lambda *a: False)
    r = random.Random(4)
    values = [(f"p{i % 2}", i, r.choice([None, 0, -5, r.randrange(-100, 5000), 2 ** 40, -2 ** 62])) for i in range(150)]
    made = [(f"p{k % 3}", k, low, low + r.choice([-3, 0, 1, 2, 7, 8, 900, 4096, 2 ** 41, 2 ** 62]), k / 10)
            for k in range(300) for low in [r.choice([r.randrange(-200, 5000), 0, 4096, -2 ** 62])]] + [("p0", 999, None, 5, 1.0)]
    made += [("p1", 1000 + k, 0, 5000, 1.0) for k in range(200)]
    items = spark.createDataFrame(values, "profile string, id int, v long")
    table = spark.createDataFrame(made, "profile string, band int, low long, high long, score double")
    held = bands.merged_bands(
        items, F.col("v"), table, ["profile"], n=F.count(F.lit(1)), first=F.min("band"), last=F.max("band"), score=F.max("score"))
    met = bands.join_bands(items, F.col("v"), held, ["profile"])
    got = {x["id"]: tuple(x)[1:] for x in met.groupBy("id").agg(F.sum("n"), F.min("first"), F.max("last"), F.max("score")).collect()}
    want = {}
    for p, i, v in values:
        own = [(b, s) for q, b, low, high, s in made if p == q and v is not None and low is not None and low <= v < high]
        if own:
            want[i] = (len(own), min(own)[0], max(own)[0], max(s for _, s in own))
    assert got == want and max(n for n, *_ in want.values()) > 200
    assert max(x["n"] for x in met.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()) <= 63
    assert bands.merged_bands(items, F.col("v"), table.limit(0), ["profile"], n=F.count(F.lit(1))).count() == 0


@pytest.mark.parametrize("name", ["items_in_bands", "band_scores"])
def test_an_item_in_very_many_bands_is_joined_a_few_times(spark, monkeypatch, tmp_path, name):
    """300 equal bands hold the value: the join makes rows per length, not per band."""
    keys = [(14_000_000 * i + 13,) for i in range(300)]
    spark.createDataFrame(keys, "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    made, plain = [], bands.join_bands
    monkeypatch.setattr(bands, "join_bands", lambda *a: made.append(plain(*a)) or made[-1])
    monkeypatch.setattr(browse_queries, "views", lambda: F.lit(1800))
    monkeypatch.setattr(tables, "items", lambda s, d: s.createDataFrame(
        [("de", 2, 1, 5, 5)], "profile string, file_id int, ord long, view_count long, play_count long"))
    rows = getattr(browse_queries, name)(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and (name != "items_in_bands" or rows[0]["n_bands"] == 300)
    assert made[0].count() <= 14
