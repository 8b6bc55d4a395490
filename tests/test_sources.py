import json
import shutil

import pytest
from pyspark.sql import functions as F

from catalogia.operators import browse, dedup
from catalogia.operators.distribution import fits_broadcast
from catalogia.plans.refresh import refresh
from catalogia.sources import files, payloads, profiles as source
from catalogia.streaming import incremental
from sample_profiles import document


def raw_file(file_id, *batches):
    return {
        "file_id": file_id, "output_path": "x.md", "title": "t", "description": "d", "collected_at": "now",
        "searches": [{"tool": tool, "query": q, "page": 1, "result_count": len(hits), "results": hits}
                     for tool, q, hits in batches],
    }


def watch(i):
    return f"https://www.youtube.com/watch?v={i}"


@pytest.fixture
def raw_dir(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "file_2.json").write_text(json.dumps(raw_file(
        2, ("youtube", "q1", [{"title": "林星河 MV", "url": watch("a"), "view_count": 900}, {"title": "b", "url": watch("b")}]),
        ("google", "q2", [{"title": "林星河 专访", "url": "https://g", "description": "long"}, {"title": "again", "url": watch("a")}]),
        ("youtube", "q3", [{"title": "again", "url": watch("a") + "&t=1"}]),
    ), ensure_ascii=False, indent=2), encoding="utf-8")
    (folder / "file_3.json").write_text(json.dumps(raw_file(
        3, ("youtube", "q4", [{"title": "林星河 MV", "url": watch("a"), "view_count": 90_000}]),
    )), encoding="utf-8")
    (folder / "file_9.json").write_text("{broken", encoding="utf-8")
    (folder / "notes.json").write_text("{}", encoding="utf-8")
    return str(folder)


def test_read_raw(spark, raw_dir):
    raw = files.read_raw(spark, raw_dir, "star_lin", True).orderBy("file_id", "ord").collect()
    assert [(r["file_id"], r["ord"] >> 32, r["ord"] & 0xFFFFFFFF, r["source"], r["search_query"]) for r in raw] == [
        (2, 0, 0, "youtube", "q1"), (2, 0, 1, "youtube", "q1"), (2, 1, 0, "google", "q2"),
        (2, 1, 1, "google", "q2"), (2, 2, 0, "youtube", "q3"), (3, 0, 0, "youtube", "q4")]
    assert dedup.dedup_first(files.read_raw(spark, raw_dir, "p", True)).count() == 5
    with pytest.raises(Exception, match="unreadable file .*file_9.json"):
        files.read_raw(spark, raw_dir, "p").count()
    bad = files.unreadable_files(spark, raw_dir).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["reason"]) for r in bad] == [("file_9.json", "not valid JSON: {broken")]


def test_profiles_from_paths(spark, tmp_path):
    for name in ("one", "two words"):
        folder = tmp_path / "data" / name / "raw_results"
        folder.mkdir(parents=True)
        (folder / "file_2.json").write_text(json.dumps(raw_file(2, ("youtube", "q", [{"url": watch(name[:3])}]))), encoding="utf-8")
        (tmp_path / "data" / name / "state.json").write_text(json.dumps(
            {"reviewed": {"u": "skip"}, "session_start": None}), encoding="utf-8")
    raw = files.read_raw(spark, str(tmp_path))
    assert {(r["profile"], r["url"]) for r in raw.collect()} == {("one", watch("one")), ("two words", watch("two"))}
    decisions = files.read_decisions(spark, str(tmp_path / "data" / "*" / "state.json"))
    assert {r["profile"] for r in decisions.collect()} == {"one", "two words"}


def test_refresh_and_catalogue_round_trip(spark, raw_dir, profiles, tmp_path):
    catalog = refresh(files.read_raw(spark, raw_dir, "star_lin", True), profiles)
    path = str(tmp_path / "catalog")
    files.write_catalog(catalog, path)
    stored = files.read_catalog(spark, path)
    assert stored.count() == catalog.count() == 4
    mv = files.read_catalog(spark, path, "star_lin", "unclassified").collect()
    assert [(r["original_file_id"], r["file_id"], r["view_count"]) for r in mv] == [(3, 2, 90_000)]
    scan = files.read_catalog(spark, path, "star_lin", "discard")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(profile" in scan
    # A profile is overwritten whole: a category that empties leaves nothing; other profiles stay.
    other = spark.createDataFrame(stored.withColumn("profile", F.lit("other")).collect(), stored.schema)
    files.write_catalog(other, path)
    moved = stored.filter("profile = 'star_lin' and category = 'interviews'").withColumn("title", F.lit("new")).collect()
    files.write_catalog(spark.createDataFrame(moved, stored.schema), path)
    again = files.read_catalog(spark, path)
    assert again.filter("profile = 'star_lin'").count() == len(moved) and again.filter("profile = 'other'").count() == 4
    # A repeated append adds nothing.
    before = files.read_catalog(spark, path, category="discard").count()
    for _ in range(2):
        files.append_discards(spark.createDataFrame(mv, stored.schema), path)
    assert files.read_catalog(spark, path, category="discard").count() == before + 1
    files.append_discards(spark.createDataFrame(mv, stored.schema), str(tmp_path / "fresh"))
    assert files.read_catalog(spark, str(tmp_path / "fresh")).count() == 1
    parity = str(tmp_path / "parity")
    files.write_catalog(catalog, parity, keep_unclassified=False)
    assert files.read_catalog(spark, parity).filter("category = 'unclassified'").count() == 0


def test_documents_of_other_profiles_stay(spark, tmp_path):
    lines = [(p, "c", 0, i, None, None, f"{p}{i}") for p in ("a", "b") for i in range(3)]
    df = spark.createDataFrame(lines, "profile string, category string, section int, block int, file_id int, ord long, text string")
    for p in ("a", "b", "a"):
        files.write_documents(df.filter(F.col("profile") == p), str(tmp_path / "docs"))
    got = spark.read.text(str(tmp_path / "docs")).collect()
    assert sorted(r["value"] for r in got) == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_catalogue_files(spark, tmp_path):
    for i, hits in ((2, [{"title": "a", "url": watch("x")}, {"title": "b"}]), (4, [])):
        (tmp_path / f"file_{i}.json").write_text(json.dumps(
            {"file_id": i, "total_results": len(hits), "results": hits}), encoding="utf-8")
    got = files.read_catalog_files(spark, str(tmp_path), "p").orderBy("ord").collect()
    assert [(r["title"], r["original_file_id"], r["ord"]) for r in got] == [("a", 2, 0), ("b", 2, 1)]


def test_profiles_from_json_and_yaml(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "j").mkdir()
    (tmp_path / "y").mkdir()
    (tmp_path / "j" / "a.json").write_text(json.dumps(document(), ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "y" / "a.yaml").write_text(yaml.safe_dump(document(), allow_unicode=True), encoding="utf-8")
    (tmp_path / "y" / "bad.yaml").write_text("a: [", encoding="utf-8")
    (tmp_path / "y" / "nameless.yaml").write_text("artist: {names: {primary: x}}", encoding="utf-8")
    one = source.read_profiles(spark, str(tmp_path / "j")).collect()
    two = source.read_profiles(spark, str(tmp_path / "y"), "yaml").collect()
    assert one == two and one[0]["profile"] == "star_lin"


def test_decisions(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(
        {"reviewed": {"u1": "approve", "u2": "skip"}, "session_start": "2024-01-01T00:00:00"}), encoding="utf-8")
    got = files.read_decisions(spark, str(tmp_path / "s.json"), "p")
    assert {(r["url"], r["action"]) for r in got.collect()} == {("u1", "approve"), ("u2", "skip")}
    files.write_decisions(got, str(tmp_path / "table"))
    files.write_decisions(got, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 4


def payload(spark, data, **extra):
    row = {"payload": json.dumps(data, ensure_ascii=False), **extra}
    return spark.createDataFrame([row])


def test_video_details(spark):
    got = payloads.norm_video_details(payload(spark, {"items": [
        {"id": "a", "snippet": {"title": "T", "channelTitle": "C", "description": "x\n" * 200,
                                "publishedAt": "2020-01-02T00:00:00Z"},
         "statistics": {"viewCount": "12"}, "contentDetails": {"duration": "PT1H2M3S"}},
        {"id": "b", "snippet": {"title": "T", "channelTitle": "C", "publishedAt": "2020-01-02T00:00:00Z"}},
    ]})).orderBy("pos").collect()
    assert (got[0]["url"], got[0]["view_count"], got[0]["duration"], got[0]["verified"]) == (watch("a"), 12, "1:02:03", True)
    assert got[0]["description"] == "x " * 150 and got[0]["published_at"] == "2020-01-02"
    assert (got[1]["view_count"], got[1]["duration"], got[1]["description"]) == (0, "", "")


def test_uploads_pages(spark):
    page = {"items": [{"snippet": {"title": "T"}, "contentDetails": {"videoId": "v"}},
                      {"snippet": {"title": "no id"}, "contentDetails": {}}, {"snippet": {}}]}
    pages = payload(spark, page, page_no=1).unionByName(payload(spark, page, page_no=2))
    assert payloads.norm_playlist(pages).count() == 2
    one = payloads.norm_playlist(pages, max_pages=1).collect()
    assert [(r["url"], r["channel"], r["published_at"], r["source"]) for r in one] == [(watch("v"), "", "", "channel_crawl")]


def test_web_and_second_platform(spark):
    assert payloads.norm_web(payload(spark, {})).count() == 0
    web = payloads.norm_web(payload(spark, {"organic": [{"title": "t", "link": "l"}, {}]})).orderBy("pos").collect()
    assert [(r["title"], r["url"], r["snippet"], r["verified"]) for r in web] == [("t", "l", "", None), ("", "", "", None)]
    data = {"code": 0, "data": {"result": [
        {"bvid": "B1", "title": "<em>a</em> b ", "play": 7, "author": "u", "description": "d" * 300, "pubdate": 0, "duration": "3:2"},
        {"bvid": "", "title": "x"}]}}
    got = payloads.norm_bili(payload(spark, data)).collect()
    assert [(r["title"], r["url"], r["play_count"], len(r["description"]), r["published_at"]) for r in got] == [
        ("a b", "https://www.bilibili.com/video/B1", 7, 250, "")]
    assert payloads.norm_bili(payload(spark, {**data, "code": -352})).count() == 0


def test_profiles_with_data(make_items, profiles):
    assert browse.profiles_with_data(profiles, make_items({})).count() == 1
    assert browse.profiles_with_data(profiles, make_items({"profile": "other"})).count() == 0


def test_broadcast_is_measured(profiles):
    assert fits_broadcast(profiles) and not fits_broadcast(profiles, 100)


def test_incremental_ingest(spark, raw_dir, tmp_path):
    table, state = str(tmp_path / "items"), str(tmp_path / "state")
    (tmp_path / "raw" / "file_9.json").write_text(json.dumps(raw_file(9)), encoding="utf-8")
    hits = incremental.raw_stream(spark, raw_dir, "star_lin")
    incremental.start_ingest(hits, table, state).awaitTermination()
    assert spark.read.parquet(table).count() == 5
    shutil.copy(f"{raw_dir}/file_2.json", f"{raw_dir}/file_22.json")
    (tmp_path / "raw" / "file_23.json").write_text(json.dumps(raw_file(
        2, ("youtube", "q", [{"url": watch("a")}, {"url": watch("new")}]))), encoding="utf-8")
    incremental.start_ingest(hits, table, state).awaitTermination()
    assert spark.read.parquet(table).count() == 6
    # A repeated micro-batch replaces its own rows.
    again = files.read_raw(spark, raw_dir, "star_lin", True).filter(F.col("search_query") == "q")
    incremental.append_new(again, 1, table)
    assert spark.read.parquet(table).count() == 6
