import random

import pytest
from pyspark.sql import functions as F

from catalogia.operators import browse, coverage, profile_checks, querygen, rendering
from catalogia.operators.profiles import dims
from catalogia.sources.files import write_documents
from catalogia.operators.querygen import dims_of_documents
from sample_profiles import document


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def near(title, q, tolerance):
    t, q, n = title.lower(), q.lower(), len(q)
    windows = [t[i:i + n] for i in range(max(len(t) - n + 1, 1))]
    return q in t or min(distance(w, q) for w in windows) <= int(n * tolerance)


@pytest.mark.parametrize("q", ["night sky", "星空下的河", "a", "Hello World"])
def test_search_equals_brute_force(make_items, q):
    rng = random.Random(q)
    titles = ["Night Sky", "nite sky live", "星空下河", "hello wrld", "", "x"]
    for _ in range(150):
        base = list(q.lower() + rng.choice(["", " live", "星"]))
        for _ in range(rng.randrange(6)):
            base[rng.randrange(len(base))] = rng.choice("abcé星 ")
        titles.append("".join(rng.choice("xyz ") for _ in range(rng.randrange(8))) + "".join(base))
    items = make_items(*[{"title": t} for t in titles])
    got = {r["ord"] for r in browse.search_titles(items, q).collect()}
    assert got == {i for i, t in enumerate(titles) if near(t, q, 0.35)}


def test_browse(make_items):
    items = make_items(
        {"title": "A", "source": "youtube", "view_count": 5, "published_at": "2020-01-01"},
        {"title": "B", "source": "bilibili", "play_count": 9},
        {"title": "C", "source": "youtube", "view_count": 0, "play_count": 99, "published_at": "2021-01-01"},
    )

    def titles(**options):
        return "".join(r["title"] for r in browse.browse(items, **options).collect())

    assert titles() == "BAC" and titles(desc=False) == "CAB"
    assert titles(sort="date") == "CAB" and titles(sort="date", desc=False) == "BAC"
    assert titles(platform="youtube") == "AC" and titles(query="  ") == "BAC"
    assert titles(limit=1) == "B" and titles(limit=1, offset=1) == "A"
    facet = browse.facets(items, platform="bilibili").first()
    assert tuple(facet)[2:] == (3, 2, 1, 1)


def test_cards_and_navigation(make_items, make_profiles, profiles):
    card = browse.landing_cards(profiles).first()
    assert (card["card"], card["n_categories"]) == ("1990 · Pop · 最佳新人", 7)
    bare = document()
    bare["artist"] = {**bare["artist"], "genre": None, "awards": []}
    assert browse.landing_cards(make_profiles(bare)).first()["card"] == "1990"
    nav = browse.nav_counts(make_items({"category": "concerts"}, {"category": "discard"}), dims(profiles)["categories"])
    counts = {r["category"]: r["n"] for r in nav.collect()}
    assert counts["concerts"] == 1 and counts["variety"] == 0 and counts["TOTAL"] == 1


@pytest.mark.parametrize("way", ["scan", "gram"])
def test_coverage(spark, make_items, way):
    tracks = spark.createDataFrame(
        [("star_lin", "One", 0, "T1"), ("star_lin", "One", 1, "T2"), ("star_lin", "Two", 0, "t3 Live"), ("other", "X", 0, "T1")],
        "profile string, album string, pos int, track string")
    items = make_items({"title": "t1 official"}, {"title": "T3 LIVE"}, {"title": ""}, {})
    found = coverage.track_found(tracks, items, way=way)
    assert {(r["profile"], r["track"]): r["found"] for r in found.collect()} == {
        ("star_lin", "T1"): True, ("star_lin", "T2"): False, ("star_lin", "t3 Live"): True, ("other", "T1"): False}
    album = {r["album"]: r for r in coverage.album_coverage(found, lists=True).filter("profile = 'star_lin'").collect()}
    assert album["One"]["found_tracks"] == ["T1"] and album["One"]["missing_tracks"] == ["T2"]
    singles = tracks.select("profile", F.col("track").alias("name"), F.lit("s").alias("source"), F.lit(2000).alias("year"))
    single = coverage.single_coverage(singles, items, way)
    heads = spark.createDataFrame([("star_lin",), ("empty",)], "profile string")
    total = {r["profile"]: r for r in coverage.coverage_summary(heads, found, single).collect()}
    assert (total["star_lin"]["album_tracks_missing"], total["star_lin"]["album_coverage_pct"]) == (1, 66.7)
    assert (total["empty"]["album_tracks_total"], total["empty"]["ost_coverage_pct"]) == (0, 0.0)
    none = coverage.track_found(tracks, items.filter("false"), way=way)
    assert none.filter("found").count() == 0


def test_both_ways_of_coverage_agree(spark, make_items):
    rng = random.Random(3)
    letters = "ab星é \n"
    titles = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    names = [t[i:i + n] for t in titles for i, n in [(rng.randrange(len(t)), rng.randrange(1, 70))]]
    names += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 70))) for _ in range(60)] + [""]
    tracks = spark.createDataFrame([("star_lin", n) for n in names], "profile string, track string")
    items = make_items(*[{"title": t} for t in titles])
    wanted = sorted((n, any(n in t for t in titles)) for n in names)
    for way in ("scan", "gram"):
        got = coverage.track_found(tracks, items, way=way).collect()
        assert sorted((r["track"], r["found"]) for r in got) == wanted


def test_documents(spark, make_items, profiles, tmp_path):
    items = make_items(
        {"category": "concerts", "source": "youtube", "title": "a|b\nc", "url": "u", "view_count": 12345,
         "channel": "ch", "duration": "4:00", "published_at": "2020-01-01", "verified": True},
        {"category": "concerts", "source": "bilibili", "title": "d", "url": "v", "verified": False, "author": "au"},
        {"category": "concerts", "source": "google", "title": "e", "url": "w", "snippet": "s" * 100, "verified": False, "verify_status": 404},
    )
    d = dims(profiles)
    lines = rendering.document_lines(items, d["categories"], d["profiles"], "2024-05-06")
    place = ["section", "block", "file_id", "ord"]
    text = [r["text"] for r in lines.filter("category = 'concerts'").orderBy(*place).collect()]
    assert text == [
        "# 林星河concerts", "", "> ", "> 数据来源：YouTube Data API v3、Bilibili 搜索 API、Google 搜索（Serper.dev）",
        "> 共收录 3 条结果 | 最后更新：2024-05-06", "", "---", "",
        "## YouTube 视频", "", "| 内容名称 | 链接 | 平台 | 发布日期 | 播放量 | 频道/作者 | 时长 |",
        "|---------|------|------|---------|-------|---------|------|",
        "| a\\|b c | [观看](u) | YouTube | 2020-01-01 | 1.2万 | ch | 4:00 |", "",
        "## Bilibili 视频", "", "| 内容名称 | 链接 | 平台 | 发布日期 | 播放量 | 频道/作者 | 时长 |",
        "|---------|------|------|---------|-------|---------|------|",
        "| d | [观看](v) | Bilibili |  | 0 | au |  ⚠️|", "",
        "## 其他来源", "", "| 内容名称 | 链接 | 来源 | 日期 | 摘要 |", "|---------|------|------|------|------|",
        "| e | [链接](w) | Google |  | " + "s" * 80 + " |", "",
    ]
    empty = [r["text"] for r in lines.filter("category = 'variety'").orderBy(*place).collect()]
    assert empty[8:] == ["*暂无搜索结果。*", ""]
    path = str(tmp_path / "docs")
    write_documents(lines, path)
    folder = tmp_path / "docs" / "profile=star_lin" / "category=concerts"
    written = "".join(f.read_text(encoding="utf-8") for f in sorted(folder.glob("part-*")))
    assert written == "\n".join(text) + "\n"


def test_query_generation(spark, profiles, make_profiles):
    d = dims_of_documents(profiles)
    queries = querygen.gen_queries(d)
    rows = sorted(queries.collect(), key=lambda r: r["ord"])
    listed = [(r["tool"], r["query"], r["page"], r["category"]) for r in rows]
    assert listed[:5] == [
        ("youtube", "林星河 MV official", 1, "personal_mv"), ("youtube", "Star Lin MV official", 1, "personal_mv"),
        ("youtube", "林星河 海邊的信 MV", 1, "personal_mv"), ("youtube", "林星河 HELLO! MV", 1, "personal_mv"),
        ("youtube", "林星河 夏天的風 MV", 1, "personal_mv"),
    ]
    assert len({q[:3] for q in listed}) == len(listed)
    # The category that emits a query first owns it.
    assert ("youtube", "林星河 小雨 MV", 1, "personal_mv") in listed
    assert ("youtube", "林星河 光年PLUS 台北", 1, "concerts") in listed
    assert ("bilibili", "林星河 演唱会 全场", 2, "concerts") in listed
    assert ("youtube", "N.O.W 星夜舞台", 1, "variety") in listed
    assert ("youtube", "NOWBAND MV official", 1, "group_mv") in listed
    assert ("youtube", "林星河 阿海", 1, "collabs") in listed and ("youtube", "April 林星河", 1, "collabs") in listed
    assert ("youtube", "林星河 獨立單曲", 1, "ost_singles") in listed
    plan = querygen.search_plan(queries, d, nested=True).orderBy("pos").collect()
    assert [p["category"] for p in plan] == [c["key"] for c in document()["categories"]]
    assert sum(len(p["searches"]) for p in plan) == len(listed)
    assert plan[0]["searches"][0]["query"] == "林星河 MV official" and plan[0]["title"] == "林星河personal_mv"
    counts = querygen.query_counts(queries).collect()
    assert sum(r["n"] for r in counts if r["tool"]) == sum(r["n"] for r in counts if r["category"]) == len(listed)
    solo = make_profiles(document(group=None))
    alone = querygen.gen_queries(dims_of_documents(solo)).collect()
    assert not [r for r in alone if r["category"] == "group_mv" or "N.O.W" in r["query"]]
    empty = querygen.search_plan(querygen.gen_queries(dims_of_documents(solo)), dims_of_documents(solo), nested=True)
    assert [r["searches"] for r in empty.filter("category = 'group_mv'").collect()] == [[]]


def test_top_n_of_query_generation(make_profiles):
    d = document()
    d["discography"]["solo_albums"] = [{"name": "A", "year": 2000, "tracks": [f"t{i}" for i in range(9)]}]
    d["discography"]["ost_singles"] = [{"name": f"o{i}", "source": "s", "year": 2000} for i in range(12)]
    d["discography"]["interview_channels"] = [f"c{i}" for i in range(12)]
    d["discography"]["group_mvs"] = [f"g{i}" for i in range(15)]
    got = {(r["tool"], r["query"]) for r in querygen.gen_queries(dims_of_documents(make_profiles(d))).collect()}
    assert ("bilibili", "林星河 t4 MV") in got and ("bilibili", "林星河 t5 MV") not in got
    assert ("bilibili", "林星河 o7") in got and ("bilibili", "林星河 o8") not in got
    assert ("youtube", "林星河 c7") in got and ("youtube", "林星河 c8") not in got
    assert ("bilibili", "N.O.W g9 MV") in got and ("bilibili", "N.O.W g10 MV") not in got


def test_profile_issues(make_profiles):
    good = document()
    d = good["discography"]
    d["ost_singles"] = d["ost_singles"][:2]
    d["collaborators"] = d["collaborators"][:1]
    d["notable_interviewers"] = ["Host"]
    d["solo_albums"][1]["tracks"].append("三")
    assert profile_checks.document_issues(make_profiles(good)).count() == 0
    assert profile_checks.profile_issues(dims(make_profiles(good))).count() == 0
    bad = document()
    bad["discography"]["variety_show_singles"] = []
    bad["discography"]["variety_shows"] = [{"name": "The Singer", "network": ""}, {"name": "Talk", "network": ""}]
    wanted = {
        "ost_without_source": (1, 3, ["獨立單曲"]), "collab_without_songs": (1, 2, ["阿海"]),
        "singing_shows_without_singles": (1, None, ["The Singer"]), "no_interviewers": (1, None, ["林星河"]),
        "short_album": (1, 2, ["Two (2 tracks)"]),
    }
    for issues in (profile_checks.document_issues(make_profiles(bad)),
                   profile_checks.profile_issues(dims(make_profiles(bad)), names=True)):
        assert {r["check"]: (r["n"], r["total"], r["names"]) for r in issues.collect()} == wanted


def test_profile_stats_and_schema(make_profiles):
    stats = profile_checks.profile_stats(make_profiles(document())).first()
    assert tuple(stats)[1:] == (2, 3, 1, 2, 7)
    assert profile_checks.schema_problems(make_profiles(document())).count() == 0
    broken = document(classification={"priority": None})
    assert [r["problem"] for r in profile_checks.schema_problems(make_profiles(broken)).collect()] == [
        "missing classification.priority"]
