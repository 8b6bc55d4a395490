import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from catalogia import fixed_values as V
from catalogia.operators import automaton, distribution, querygen, rules, scoring
from catalogia.operators.profiles import DICTIONARY
from catalogia.plans import tables
from sample_profiles import document

TITLES = [
    "林星河 海邊的信 Official MV", "star lin LIVE concert", "reaction 海邊的信", "Taylor Swift x", "別家歌手 新歌", "滿足 四月天",
    "april feat. 林星河", "小雨 那年的約定", "雙重身份", "雙重身份 暗戰 lyric", "N.O.W Super Moon MV", "光年PLUS 台北", "海洋樂園", "",
    "星夜舞台 第3期", "林星河 小巨蛋 現場", "NOWBAND 未滿的我們", "夏天的風 短歌", "翻頁 单曲", None, "HELLO! hello!", "電視台 专访 林星河",
]


@pytest.mark.parametrize("way", ["broadcast", "join"])
def test_matched_terms_equal_brute_force(spark, monkeypatch, way):
    if way == "join":
        monkeypatch.setattr(distribution, "fits_broadcast", lambda *a: False)
    r = random.Random(1)
    texts = ["".join(r.choice("abé☃ ") for _ in range(r.randrange(14))) for _ in range(150)] + [None, "", "ab", "aba"]
    terms = {"".join(r.choice("abé☃ ") for _ in range(r.randrange(1, 5))) for _ in range(60)} | {""}
    rows = [("p" if i % 3 else "q", i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "profile string, id int, text string")
    listed = [("p", t) for t in terms] + [("q", t) for t in sorted(terms)[:5]] + [("p", None), ("p", "ab"), ("p", "ab")]
    of = {k: {t for p, t in listed if p == k and t is not None} for k in "pq"}
    found = automaton.matched_terms(df, F.col("text"), spark.createDataFrame(listed, "profile string, term string"))
    got = {row["id"]: row["terms"] for row in found.collect()}
    assert got == {i: sorted(t for t in of[p] if text is not None and t in text) for p, i, text in rows}


def test_both_ways_classify_and_score_alike(make_items, profiles):
    items = make_items(*[
        {"title": t, "channel": c, "source": "youtube", "duration": d, "view_count": 5000, "verified": True}
        for t in TITLES for c, d in (("Yuansheng Music", "4:00"), ("ETtoday 別家歌手", "1:00:00"), (None, None))
    ])
    rows = {}
    for way in ("scan", "automaton"):
        kept = rules.classify(items, profiles, way=way, keep_dictionary=True)
        scored = scoring.score(kept, profiles).select("ord", "category", "classification_reason", "confidence", "confidence_signals")
        rows[way] = sorted(map(tuple, scored.collect()), key=lambda r: r[0])
    assert rows["scan"] == rows["automaton"]
    assert len({r[2] for r in rows["scan"]}) > 12


def test_a_large_profile_costs_what_its_titles_hold(make_items, make_profiles):
    many = document()
    many["discography"]["solo_albums"].append({"name": "All", "year": 2020, "tracks": [f"track number {i}" for i in range(100_000)]})
    profiles = make_profiles(many)
    items = make_items({"title": "林星河 track number 77777 MV", "channel": "x"}, {"title": "nothing", "channel": "track number 5"})
    found = {r["ord"]: r[DICTIONARY] for r in automaton.attach_found(items, profiles).collect()}
    assert found[0]["tracks"] == ["track number 7", "track number 77", "track number 777", "track number 7777", "track number 77777"]
    assert found[1]["tracks"] == ["track number 5"] and found[1]["has_group"] is True
    assert automaton.worthwhile(automaton.wide(profiles)) and not automaton.worthwhile(automaton.wide(make_profiles(document())))
    assert [r["classification_reason"] for r in rules.classify(items, profiles).orderBy("ord").collect()] == [
        "rule1_known_track_mv", "rule0_artist_not_primary"]


KIND = "struct<names:array<string>,solo:array<struct<track:string,sources:array<string>>>,collabs:array<struct<name:string,name_lc:string>>,has_group:boolean>"


def dictionaries(spark, known):
    kind = spark.createDataFrame([], f"d {KIND}").schema["d"].dataType
    table = pa.table({"profile": pa.array(list(known), pa.string()), DICTIONARY: pa.array(list(known.values()), to_arrow_type(kind))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return automaton.Dictionaries(sink.getvalue().to_pybytes(), kind)


def test_parts_equal_brute_force(spark):
    r = random.Random(2)
    word = lambda: r.choice([None, "", *["".join(r.choice("abé ") for _ in range(r.randrange(1, 4))) for _ in range(8)]])
    known = {name: {
        "names": None if name == "q" else [word() for _ in range(12)],
        "solo": [r.choice([None, {"track": word(), "sources": r.choice([None, [], ["x", None]])}]) for _ in range(9)],
        "collabs": [{"name": word(), "name_lc": word()} for _ in range(size)], "has_group": group,
    } for name, size, group in (("p", 7, True), ("q", 0, None), ("r", 3, False))}
    asked = [(r.choice(["p", "q", "r", "nobody", None]), ("".join(r.choice("abé c") for _ in range(r.randrange(9))), r.choice([None, "", "ab"]))) for _ in range(200)]

    def holds(entry, texts):
        keys = [entry] if isinstance(entry, str) else [entry[k] for k in ("name", "name_lc", "track") if k in entry]
        return any(k is not None and (k == "" or any(t and k in t for t in texts)) for k in keys)

    want = [known.get(name) and {k: v if not isinstance(v, list) else [e for e in v if e is not None and holds(e, texts)]
                                 for k, v in known[name].items()} for name, texts in asked]
    got = dictionaries(spark, known).part([name for name, _ in asked], [texts for _, texts in asked]).to_pylist()
    assert got == want
    assert dictionaries(spark, {}).part(["p"], [("x",)]).to_pylist() == [None]


def test_a_dictionary_takes_few_bytes_a_name(make_items, make_profiles, spark, monkeypatch):
    """What a worker holds beside the automaton and the Arrow buffers: numbers, no objects per name."""
    n, sent, plain = 20_000, [], spark.sparkContext.broadcast
    many = document()
    many["discography"]["solo_albums"].append({"name": "All", "year": 2020, "tracks": [f"track number {i}" for i in range(n)]})
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or plain(value))
    profiles = make_profiles(many)
    automaton.attach_found(make_items({"title": "x"}), profiles)
    assert isinstance(sent[0], bytes) and len(sent[0]) < 150 * n
    tracemalloc.start()
    held = automaton.Dictionaries(sent[0], automaton.wide(profiles).schema[DICTIONARY].dataType)
    assert held.part(["star_lin"], [("track number 7",)]).to_pylist()[0]["tracks"] == ["track number 7"]
    used, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert used < 150 * n


def test_items_of_an_unknown_profile(make_items, profiles):
    rows = automaton.attach_found(make_items({"title": "x", "profile": "nobody"}, {"title": "x", "profile": None}), profiles).collect()
    assert [r[DICTIONARY] for r in rows] == [None, None]


def test_no_dimension_of_the_generated_queries_is_empty(spark):
    dims = tables.part_dims(spark, "/root/testdata/sf0.001")
    assert [name for name, df in dims.items() if df.isEmpty()] == []
    filled = {r["dim"] for r in querygen._entries(tables.part_entries(spark, "/root/testdata/sf0.001")).select("dim").distinct().collect()}
    heads = {"primary", "other_english", "group", "group_alias"}
    assert filled | heads == {t[0] for t in V.QUERY_TEMPLATES}
