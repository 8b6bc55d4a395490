import random
import re

from pyspark.sql import Window, functions as F

from catalogia.operators import dedup, distribution, links


def ords(df):
    return sorted(r["ord"] for r in df.collect())


def watch(i, extra=""):
    return f"https://www.youtube.com/watch?v={i}{extra}"


def test_dedup_first(make_items):
    items = make_items(
        {"url": watch("a"), "source": "youtube"}, {"url": watch("a", "&t=60"), "source": "youtube"},
        {"source": "bilibili", "url": "u"}, {"source": "bilibili", "url": "u"},
        {"source": "google", "url": ""}, {"source": "google", "url": ""},
        {"source": "google", "url": "w"}, {"source": "bilibili", "bvid": "w"},
        {"url": watch("a"), "source": "youtube", "file_id": 3},
    )
    once = dedup.dedup_first(items)
    assert ords(once) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert ords(dedup.dedup_first(once)) == ords(once)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_dedup_richest(make_items):
    items = make_items(
        {"url": watch("a"), "source": "youtube", "file_id": 2},
        {"url": watch("a"), "source": "youtube", "file_id": 4, "title": "rich", "verified": True},
        {"url": watch("b"), "source": "youtube", "file_id": 4, "title": "late"},
        {"url": watch("b"), "source": "youtube", "file_id": 2, "title": "early"},
        {"source": "google", "url": ""}, {"source": "google", "url": ""},
    )
    got = {r["url"]: r for r in dedup.dedup_richest(items).collect()}
    a, b = got[watch("a")], got[watch("b")]
    assert (a["title"], a["original_file_id"], a["file_id"], a["ord"]) == ("rich", 4, 2, 0)
    assert (b["title"], b["original_file_id"]) == ("early", 2)
    assert len(got) == 3
    counts = dedup.dup_count(items).first()
    assert (counts["n_items"], counts["n_keys"], counts["n_removed"]) == (6, 3, 3)
    narrow = dedup.dedup_richest(items, ["url", "title", "source", "bvid"])
    assert narrow.count() == 3 and "description" not in narrow.columns


def test_mark_duplicates(make_items):
    items = make_items(
        {"url": watch("a"), "source": "youtube"}, {"url": watch("a", "&x"), "source": "youtube"},
        {"url": watch("a"), "source": "google"}, {"url": watch("a"), "source": "other"},
        {"source": "bilibili"}, {"source": "bilibili"},
    )
    got = [r["duplicate"] for r in dedup.mark_duplicates(items).orderBy("ord").collect()]
    assert got == [False, True, False, True, False, False]


def test_uploads(make_items):
    crawl = make_items(
        {"video_id": "a"}, {"video_id": "a", "file_id": 3}, {"video_id": ""}, {"video_id": "b"}, {},
    )
    assert ords(dedup.dedup_across_channels(crawl)) == [0, 3]
    catalog = make_items({"url": watch("a", "&t=1")}, {"url": "x"}, {"url": ""})
    new, known = dedup.split_new_known(crawl, catalog)
    assert ords(known) == [0, 1] and ords(new) == [2, 3, 4]
    new, known = dedup.split_new_known(crawl, catalog.filter("false"))
    assert ords(new) == [0, 1, 2, 3, 4] and known.count() == 0


def test_spread_join_loses_nothing(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", None, "z"])) for i in range(600)]
    big = spark.createDataFrame(rows, "i int, k string")
    small = spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = distribution.spread_join(big, small, ["k"], ["i"], how)
        plain = big.join(small, "k", how)
        assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    attached = distribution.attach(big, small, ["k"], ["i"], "left", max_bytes=0)
    assert attached.count() == 600


def test_ordered_index_equals_a_window(spark):
    rng = random.Random(2)
    rows = [(f"p{rng.random() < 0.8}", rng.randrange(3), i) for i in rng.sample(range(10 ** 12), 700)]
    df = spark.createDataFrame(rows, "p string, f int, o bigint")
    plain = F.row_number().over(Window.partitionBy("p").orderBy("f", "o")) - 1
    for pieces in (None, 1, 5, 64):
        got = distribution.ordered_index(df, ["p"], ["f"], "o", pieces=pieces)
        both = got.join(df.withColumn("w", plain), ["p", "f", "o"])
        assert both.count() == 700 and both.filter("index <> w").count() == 0
    assert distribution.ordered_index(df.filter("false"), ["p"], ["f"], "o").count() == 0


def test_first_by(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "id")
    assert distribution.first_by(df, ["g"], [F.desc("id")], 2).count() == 6


def test_link_verdicts(spark):
    rows = [
        (watch("a"), 404, True, 200, "YouTube API verified"), ("https://youtu.be/a", None, True, 200, None),
        ("", 200, False, 0, "invalid URL format"), ("ftp://x", 200, False, 0, "invalid URL format"),
        (None, 200, False, 0, None), ("https://x", 200, True, 200, ""), ("https://y", 302, True, 302, ""),
        ("https://z", 404, False, 404, "HTTP 404"), ("https://t", 0, False, 0, "timeout"),
    ]
    df = spark.createDataFrame([(i, r[0], r[1], "timeout" if r[1] == 0 else "") for i, r in enumerate(rows)],
                               "i int, url string, status int, note string")
    got = df.select("i", links.link_verdict(F.col("url"), F.col("status"), F.col("note")).alias("v")).orderBy("i").collect()
    for r, (_, _, valid, status, note) in zip(got, rows):
        assert (r["v"]["valid"], r["v"]["status"]) == (valid, status)
        assert note is None or r["v"]["note"] == note


def test_apply_link_checks(spark, make_items):
    items = make_items(
        {"source": "youtube", "url": "https://dead"}, {"source": "google", "url": "https://ok"},
        {"source": "google", "url": "https://dead"}, {"source": "bilibili", "url": "https://slow"},
        {"source": "google", "url": "https://unknown"}, {"source": "google", "url": ""},
    )
    checks = spark.createDataFrame(
        [("https://dead", 200, "", 1), ("https://dead", 404, "", 2), ("https://ok", 200, "", 1),
         ("https://slow", 0, "timeout", 1)],
        "url string, status int, note string, checked_at int")
    got = {r["ord"]: (r["verified"], r["verify_status"], r["verify_note"])
           for r in links.apply_link_checks(items, checks).collect()}
    assert got == {0: (True, None, None), 1: (True, 200, ""), 3: (False, 0, "timeout"),
                   4: (True, None, None), 5: (True, None, None)}
    counts = links.verify_counts(links.apply_link_checks(items, checks)).first()
    assert (counts["n_verified"], counts["n_unverified"]) == (4, 1)


def test_link_chunks(make_items):
    items = make_items(*[{"source": "google", "url": f"https://x/{i}"} for i in range(53)],
                       {"source": "youtube", "url": "https://y"})
    got = links.links_to_check(items).groupBy("chunk").count().orderBy("chunk").collect()
    assert [tuple(r) for r in got] == [(0, 50), (1, 3)]


def test_richest_moves_no_text_that_is_not_asked_for(spark, make_items):
    items = make_items({"url": watch("a")}, {"url": watch("a"), "description": "more"})
    best = dedup.dedup_richest(items)
    assert [r["description"] for r in best.collect()] == ["more"]
    narrow = best.select("profile", "original_file_id")
    plan = spark._jvm.PythonSQLUtils.explainString(narrow._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert moved and not any("description" in m or "snippet" in m for m in moved)
