import pytest
from pyspark.sql import functions as F

from catalogia import functions as C


@pytest.fixture(scope="module")
def apply(spark):
    """Values of a column expression over a list of inputs, in order."""
    def run(make, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        rows = df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return run


def test_iso_duration_text(apply):
    given = ["PT4M35S", "PT45S", "PT3M", "PT1H23M45S", "PT2H", "PT1H5S", "INVALID", "PT10M9S",
             "PT2H59M59S", "", "PT", "PT90M"]
    wanted = ["4:35", "0:45", "3:00", "1:23:45", "2:00:00", "1:00:05", "INVALID", "10:09",
              "2:59:59", "", "0:00", "90:00"]
    assert apply(C.iso_duration_text, given) == wanted


def test_duration_seconds(apply):
    given = ["4:35", "1:23:45", "45", "", None, "a:b", "1:2:3:4", "1.5:00", " 1 : 2 "]
    assert apply(C.duration_seconds, given) == [275, 5025, None, None, None, None, None, None, 62]


def test_dates(apply):
    assert apply(C.epoch_to_date, [0, None, 1500000000], "bigint") == ["", "", "2017-07-14"]
    assert apply(C.year_month, ["2024-05-06", "", None]) == ["2024-05", "—", "—"]


def test_text(apply):
    assert apply(C.strip_tags, ['<em class="k">a</em> b　', "\n x<br>"]) == ["a b", "x"]
    assert apply(lambda x: C.truncate_desc(x, 5), ["ab\ncdefg", None, "星\n河河河河河"]) == [
        "ab cd", "", "星 河河河",
    ]
    assert apply(C.slug, ["Star Lin", "D.O.T.", "A-Name"]) == ["star_lin", "dot", "a-name"]
    assert apply(C.escape_md, [" a|b\nc ", None]) == ["a\\|b c", ""]
    fence = "```"
    assert apply(C.strip_fences, [f"{fence}json\n[1]\n{fence}", "x", f"{fence}only", f"a{fence}"]) == [
        "[1]", "x", "", "a",
    ]


def test_video_ids(apply):
    given = ["https://www.youtube.com/watch?v=abc123", "https://www.youtube.com/watch?v=abc123&t=60",
             "https://youtu.be/abc123", "https://youtu.be/abc123?t=30", "https://example.com/x", ""]
    assert apply(C.video_id_simple, given) == ["abc123"] * 4 + ["", ""]
    assert apply(C.video_id_parsed, given) == ["abc123"] * 4 + [None, None]
    odd = ["https://www.youtube.com/watch?v=&v=b", "https://m.YouTube.com:443/watch?a=1&v=a%20b#v=c",
           "https://evil.com/watch?v=x", "https://youtu.be/", "https://www.youtube.com/x y?v=q"]
    assert apply(C.video_id_parsed, odd) == ["b", "a b", None, None, "q"]
    assert apply(C.uploads_playlist_id, ["UCxUC", "PLx"]) == ["UUxUC", "PLx"]


def test_keys(spark):
    rows = [
        ("https://www.youtube.com/watch?v=a&t=1", None, "youtube"), ("", None, "youtube"),
        ("https://youtu.be/q", None, "youtube"), ("u", "B1", "bilibili"), ("u", "", "bilibili"),
        ("w", None, "google"), ("", None, "google"), (None, None, None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, url string, bvid string, source string")
    key = [F.col("url"), F.col("bvid"), F.col("source")]
    got = df.select("i", C.batch_key(*key).alias("b"), C.catalog_key(*key).alias("c")).orderBy("i").collect()
    assert [r["b"] for r in got] == [
        "yt:a", None, "yt:https://youtu.be/q", "bili:B1", None, "url:w", None, None]
    assert [r["c"] for r in got] == [
        "yt:a", "url:", "yt:q", "bili:B1", "url:u", "url:w", "url:", "url:"]


def test_view_formats_round_like_the_binary_value(apply):
    n = [0, 9999, 10000, 10500, 11500, 12500, 123456, 1250000]
    assert apply(C.views_wan, n, "bigint") == ["0", "9999"] + [
        f"{x / 10000:.1f}万" for x in n[2:]]
    assert apply(C.views_wan, ["abc", "", None, "15000"]) == ["abc", "", "", "1.5万"]
    m = [0, None, 999, 1050, 1250, 999999, 1_250_000]
    assert apply(C.views_mk, m, "bigint") == ["N/A", "N/A", "999"] + [
        f"{x / 1000:.1f}K" for x in m[3:6]] + [f"{1.25:.1f}M"]
    y = [0, 999, 1234, 25000, 14999, 25_000_000, 125_000_000, 115_000_000]
    assert apply(C.views_yi, y, "bigint") == [
        "—", "999", "1,234", "3萬", "1萬", "3千萬", "1.3億", "1.1億"]


def test_marks_differ_on_unknown(spark):
    rows = [(False, None), (False, 0), (None, 0), (True, 0), (False, 404), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, v boolean, s int")
    got = df.select("i", C.table_mark(F.col("v"), F.col("s")).alias("t"),
                    C.browser_mark(F.col("v"), F.col("s")).alias("b")).orderBy("i").collect()
    assert [bool(r["t"]) for r in got] == [True, True, False, False, False, False]
    assert [bool(r["b"]) for r in got] == [False, True, True, False, False, False]


def test_item_fallbacks(make_items):
    items = make_items(
        {"title": "t", "channel": "", "author": "a", "view_count": 0, "play_count": 5000, "verified": True},
        {"channel": "c", "author": "a", "view_count": 250_000, "duration": "1:00"},
        {},
    )
    got = items.select("ord", C.who().alias("w"), C.views().alias("v"), C.richness().alias("r")).orderBy("ord").collect()
    assert [tuple(r)[1:] for r in got] == [("a", 5000, 2 + 5 + 5), ("c", 250_000, 3 + 100), ("", None, 0)]


def test_compact_item_drops_nulls(make_items):
    got = make_items({"title": "t", "view_count": 3, "confidence": 0.5}).select(C.compact_item()).first()[0]
    assert got == '{"title":"t","view_count":3}'
