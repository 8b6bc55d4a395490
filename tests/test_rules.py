import copy
import itertools

import pytest
from pyspark.sql import functions as F

from catalogia import fixed_values as V
from catalogia.operators import quality, rules, scoring
from catalogia.operators.profiles import dims, has_group_name
from sample_profiles import document

ONE_PER_REASON = [
    ("林星河 海邊的信 reaction", "遠聲唱片", "4:00", "discard", "rule0_wrong_context"),
    ("錯誤場合 林星河", "x", "4:00", "discard", "rule0_wrong_context"),
    ("Taylor Swift MV", "x", "4:00", "discard", "rule0_western_blacklist"),
    ("某歌", "Taylor Swift Fans", "4:00", "discard", "rule0_western_blacklist"),
    ("別家歌手 新歌", "x", "4:00", "discard", "rule0_chinese_blacklist"),
    ("cooking video", "x", "4:00", "discard", "rule0_artist_not_primary"),
    ("林星河 新歌 Official MV", "遠聲唱片", "4:00", "personal_mv", "rule1_official_mv"),
    ("林星河 官方　MV", "遠聲唱片", "4:00", "personal_mv", "rule1_official_mv"),
    ("海邊的信 MV", "x", "4:00", "personal_mv", "rule1_known_track_mv"),
    ("林星河 海邊的信 歌词", "x", "4:00", "personal_mv", "rule1_known_track_broad"),
    ("N.O.W 恋曲 MV", "x", "4:00", "group_mv", "rule2_she_mv"),
    ("未滿的我們 MV", "x", "4:00", "group_mv", "rule2_she_known_track_mv"),
    ("n.o.w SUPER MOON", "x", "4:00", "group_mv", "rule2_she_known_track_broad"),
    ("小雨 那年的約定", "x", "4:00", "ost_singles", "rule3_ost_with_source"),
    ("小雨 lyric", "x", "4:00", "ost_singles", "rule3_ost_official"),
    ("翻頁 单曲 星河", "x", "4:00", "ost_singles", "rule3_variety_single"),
    ("林星河 小雨", "x", "4:00", "ost_singles", "rule3_ost_broad"),
    ("林星河 四月天 滿足", "x", "4:00", "collabs", "rule4_collab_known_song"),
    ("四月天 feat 林星河", "x", "4:00", "collabs", "rule4_collab_pattern"),
    ("光年Plus 台北", "x", "4:00", "concerts", "rule5_known_concert"),
    ("林星河 海洋樂園", "x", "4:00", "concerts", "rule5_she_concert"),
    ("林星河 演唱会", "x", "4:00", "concerts", "rule5_concert_keyword"),
    ("林星河 Live 全场", "x", "1:00:00", "concerts", "rule5_long_live"),
    ("林星河 小巨蛋 现场", "x", "4:00", "concerts", "rule5_venue"),
    ("星夜舞台 第3期", "x", "4:00", "variety", "rule6_known_show"),
    ("林星河 在 浙江卫视", "x", "4:00", "variety", "rule6_tv_network"),
    ("林星河 跨年", "x", "4:00", "variety", "rule6_award_gala"),
    ("林星河 EP12", "x", "4:00", "variety", "rule6_episode_pattern"),
    ("林星河 专访", "x", "4:00", "interviews", "rule7_interview_keyword"),
    ("林星河 花絮", "x", "4:00", "interviews", "rule7_behind_scenes"),
    ("林星河 新闻", "x", "4:00", "interviews", "rule7_news"),
    ("林星河 近况", "ETtoday", "4:00", "interviews", "rule7_media_channel"),
    ("林星河 日记", "x", "4:00", "unclassified", "no_rule_match"),
]

ORDER = [
    # Rule 1 before rule 5.
    ("林星河 Official MV 光年plus", "遠聲唱片", "4:00", "personal_mv", "rule1_official_mv"),
    # A show with interview framing leaves rule 6 and is taken by rule 7.
    ("星夜舞台 林星河 专访", "x", "4:00", "interviews", "rule7_interview_keyword"),
    ("星夜舞台 林星河 专访 表演", "x", "4:00", "variety", "rule6_known_show"),
    # A song performance never becomes variety.
    ("林星河 海邊的信 现场 颁奖", "x", "4:00", "unclassified", "no_rule_match"),
    # A track that is also a film song: with the film it is the single.
    ("雙重身份 MV", "x", "4:00", "personal_mv", "rule1_known_track_mv"),
    ("雙重身份 暗戰 MV", "x", "4:00", "ost_singles", "rule3_ost_with_source"),
    # Short blacklist terms hit inside words; the artist's name exempts.
    ("live at noon", "x", "4:00", "discard", "rule0_western_blacklist"),
    ("林星河 MV live", "x", "4:00", "unclassified", "no_rule_match"),
    # A long live recording of a known show is the show's.
    ("林星河 星夜舞台 live", "x", "1:00:00", "variety", "rule6_known_show"),
    # The group's name without the artist's keeps rule 1 out.
    ("N.O.W 海邊的信 MV", "x", "4:00", "group_mv", "rule2_she_mv"),
]


def outcomes(df):
    return [(r["title"], r["category"], r["classification_reason"]) for r in df.orderBy("ord").collect()]


def rows(table):
    return [{"title": t, "channel": c, "duration": d} for t, c, d, *_ in table]


@pytest.mark.parametrize("table", [ONE_PER_REASON, ORDER], ids=["reasons", "order"])
def test_waterfall(make_items, profiles, table):
    got = outcomes(rules.classify(make_items(*rows(table)), profiles))
    assert got == [(t, cat, reason) for t, _, _, cat, reason in table]


def test_every_reason_has_a_row():
    assert {r[4] for r in ONE_PER_REASON} == {
        *V.STRONG_REASONS, *V.MEDIUM_REASONS, "no_rule_match"}


def test_solo_performer_never_meets_group_rules(make_items, make_profiles):
    solo = make_profiles(document(group=None))
    got = outcomes(rules.classify(make_items(*rows(ONE_PER_REASON)), solo))
    assert not [g for g in got if g[1] == "group_mv"]


def test_profiles_see_only_their_own_dictionary(make_items, make_profiles):
    other = copy.deepcopy(document())
    other["artist"]["names"] = {"primary": "另一人", "english": "Other One", "aliases": []}
    both = make_profiles(document(), other)
    items = make_items({"title": "林星河 专访"}, {"title": "林星河 专访", "profile": "other_one"},
                       {"title": "另一人 专访", "profile": "other_one"})
    assert [g[2] for g in outcomes(rules.classify(items, both))] == [
        "rule7_interview_keyword", "rule0_artist_not_primary", "rule7_interview_keyword"]


def test_word_boundary_option(make_items, profiles):
    items = make_items({"title": "live 海邊的信"}, {"title": "ive 海邊的信"})
    plain = outcomes(rules.classify(items, profiles))
    strict = outcomes(rules.classify(items, profiles, word_boundary=True))
    assert [p[2] for p in plain] == ["rule0_western_blacklist"] * 2
    assert strict[0][2] != "rule0_western_blacklist" and strict[1][2] == "rule0_western_blacklist"


def test_venues_and_media_can_be_given(make_items, profiles):
    items = make_items({"title": "林星河 新場館 演出"}, {"title": "林星河 近况", "channel": "新媒體"})
    got = outcomes(rules.classify(items, profiles, venues=["新場館"], media=["新媒體"]))
    assert [g[2] for g in got] == ["rule5_venue", "rule7_media_channel"]


def test_collaborator_order_decides(make_items, make_profiles):
    d = document()
    d["discography"]["collaborators"] = [
        {"name": "甲", "aliases": [], "songs": ["歌一"]}, {"name": "乙", "aliases": ["甲"], "songs": ["歌二"]},
    ]
    items = make_items({"title": "林星河 甲 feat 歌一"}, {"title": "林星河 甲 歌二"})
    # The repeated name keeps its place and takes the later list of songs.
    assert [g[2] for g in outcomes(rules.classify(items, make_profiles(d)))] == [
        "rule4_collab_pattern", "rule4_collab_known_song"]


def test_filters_on_results_do_not_change_them(make_items, profiles):
    classified = rules.classify(make_items(*rows(ONE_PER_REASON)), profiles)
    kept = outcomes(classified.filter("category = 'concerts'"))
    assert kept == [g for g in outcomes(classified) if g[1] == "concerts"]


def score_of(items, profiles):
    return scoring.score(items, profiles).orderBy("ord").collect()


def test_scores(make_items, profiles):
    base = {"category": "personal_mv", "source": "youtube", "verified": True}
    got = score_of(make_items(
        {**base, "title": "林星河 Official MV", "channel": "遠聲唱片", "duration": "5:18",
         "view_count": 100_000_000, "classification_reason": "rule1_official_mv"},
        {**base, "title": "random", "channel": "u", "duration": "15:30", "view_count": 500,
         "classification_reason": "llm_unclear"},
        {"category": "discard", "classification_reason": "rule0_western_blacklist"},
    ), profiles)
    assert got[0]["confidence"] == 1.0 and len(got[0]["confidence_signals"]) == 5
    assert got[1]["confidence"] == pytest.approx(0.35 * 0.5 + 0.2 * 0.7 + 0.02 + 0.04 + 0.25 * 0.3)
    assert (got[2]["confidence"], got[2]["confidence_signals"]) == (1.0, {"rule_strength": 1.0})


def test_signals(make_items, profiles):
    def signal(name, *items):
        items = [{"category": "personal_mv", "classification_reason": "x", **i} for i in items]
        return [r["confidence_signals"][name] for r in score_of(make_items(*items), profiles)]

    reasons = ["rule1_official_mv", "rule1_known_track_broad", "llm_x", "no_rule_match", "other"]
    assert signal("rule_strength", *[{"classification_reason": r} for r in reasons]) == [1.0, 0.7, 0.5, 0.0, 0.6]
    assert signal(
        "source_reliability", {"channel": "遠聲唱片"}, {"channel": "a - Topic"},
        {"source": "youtube", "verified": True, "channel": "Label Two"},
        {"source": "bilibili", "verified": True}, {"channel": "Label Two"}, {"verified": False}, {},
    ) == [1.0, 0.85, 0.7, 0.6, 0.9, 0.3, 0.5]
    assert signal("view_count", {"view_count": 10_000_000}, {"view_count": 50_000}, {"view_count": 0}, {},
                  {"play_count": 500_000}, {"view_count": 0, "play_count": 1000}) == [
        1.0, 0.7, 0.4, 0.4, 0.85, 0.55]
    assert signal("title_match", {"title": "Official MV"}, {"title": "a mv b"}, {"title": "官方mv"},
                  {"title": "amv"}, {"title": "hello! audio"}, {"title": "x"}) == [
        1.0, 0.8, 1.0, 0.3, 0.6, 0.3]
    by_category = [("concerts", "演唱会", 1.0), ("concerts", "巡演", 0.7), ("variety", "星夜舞台", 1.0),
                   ("variety", "跨年", 0.8), ("interviews", "专访", 1.0), ("interviews", "花絮", 0.8),
                   ("ost_singles", "小雨", 0.9), ("ost_singles", "ost", 0.8), ("collabs", "feat", 1.0),
                   ("collabs", "april", 0.8), ("group_mv", "N.O.W mv", 1.0), ("group_mv", "mv", 0.6),
                   ("collabs", "x", 0.3), ("unclassified", "x", 0.5)]
    assert signal("title_match", *[{"category": c, "title": t} for c, t, _ in by_category]) == [
        s for _, _, s in by_category]


@pytest.mark.parametrize("category", ["concerts", "interviews", "personal_mv"])
def test_duration_fit_rounds_the_binary_value(spark, profiles, category):
    low, ideal_low, ideal_high, high = V.DURATION_BANDS[category]

    def wanted(s):
        if ideal_low <= s <= ideal_high:
            return 1.0
        if not low <= s <= high:
            return 0.2
        ramp = (s - low) / (ideal_low - low) if s < ideal_low else None
        if ramp is not None:
            return round(0.6 + 0.4 * (s - low) / (ideal_low - low), 2)
        return round(0.6 + 0.4 * (high - s) / (high - ideal_high), 2)

    seconds = spark.range(0, high + 60).withColumn("_seconds", F.col("id")).withColumn(
        "category", F.lit(category))
    got = seconds.select("id", F.expr(scoring.DURATION_FIT).alias("fit")).collect()
    assert [r["id"] for r in got if r["fit"] != wanted(r["id"])] == []


def test_score_is_bounded(make_items, profiles):
    combos = itertools.product(
        ["", "林星河 Official MV"], ["personal_mv", "concerts", "variety", "discard", "other"],
        ["rule1_official_mv", "llm_test", "no_rule_match"], [0, 10 ** 9], ["", "4:00", "99:00:00"],
    )
    items = [{"title": t, "category": c, "classification_reason": r, "view_count": v, "duration": d}
             for t, c, r, v, d in combos]
    assert all(0.0 <= r["confidence"] <= 1.0 for r in score_of(make_items(*items), profiles))


def test_low_views(spark, make_items, profiles):
    items = make_items(
        {"category": "personal_mv", "view_count": 499}, {"category": "personal_mv", "view_count": 500},
        {"category": "concerts", "view_count": 999}, {"category": "concerts", "view_count": 0},
        {"category": "concerts", "view_count": 1, "channel": "遠聲唱片"},
        {"category": "discard", "view_count": 1, "classification_reason": "kept"},
        {"category": "brand_new", "view_count": 999}, {"category": "concerts", "play_count": 5, "confidence": 0.9},
    )
    got = quality.filter_low_views(items, profiles).orderBy("ord").collect()
    moved = [r["classification_reason"] == "filtered_low_views" for r in got]
    assert moved == [True, False, True, False, False, False, True, True]
    assert got[7]["confidence"] == 0.9 and got[7]["category"] == "discard"
    custom = spark.createDataFrame([("concerts", 2)], "category string, min_views int")
    again = quality.filter_low_views(items, profiles, custom, default=10).orderBy("ord").collect()
    assert [r["category"] == "discard" for r in again] == [False] * 5 + [True, False, False]


def test_low_confidence_skips_null(make_items):
    items = make_items({"confidence": 0.3}, {"confidence": 0.7}, {})
    assert [r["ord"] for r in quality.low_confidence(items).collect()] == [0]


def test_dims(profiles):
    d = dims(profiles)
    assert [r["name"] for r in d["names"].orderBy("pos").collect()] == ["林星河", "Star Lin", "Starry", "星河"]
    assert d["tracks"].count() == 5 and d["concert_venues"].first()["venue"] == "台北"
    assert {r["kind"] for r in d["blacklist"].collect()} == {"western", "chinese", "wrong_context"}


def test_group_pattern(spark):
    rows = [("N.O.W live", ["N.O.W"], True), ("XN.O.W", ["N.O.W"], False), ("n.o.w", ["N.O.W"], True),
            ("NaOaW", ["N.O.W"], False), ("星N.O.W星", ["N.O.W"], True), ("x", [], False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, n array<string>, w boolean")
    assert df.filter(has_group_name(F.col("t"), F.col("n")) != F.col("w")).count() == 0
