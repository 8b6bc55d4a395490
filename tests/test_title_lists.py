import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from test_title_index import found

from catalogia.functions.varints import packed, unpacked
from catalogia.operators import distribution, title_index


def test_numbers_come_back():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 31, 2 ** 40, 0, 5])
    data, ends = packed(numbers)
    assert ends.tolist() == [1, 2, 3, 5, 7, 10, 15, 21, 22, 23]
    assert unpacked(data.tobytes()).tolist() == numbers.tolist()
    assert unpacked(packed(numbers[:0])[0].tobytes()).tolist() == []


def places(titles):
    whole, ends, out = "".join(titles), np.cumsum([len(t) for t in titles]).tolist(), {}
    for at in range(len(whole) - 1):
        if at + 1 not in ends:
            out.setdefault(whole[at:at + 2], []).append(at)
    return out


def read(titles):
    grams, data = title_index.posting_lists(titles)
    lists = {g: unpacked(d) for g, d in zip(grams, data.to_pylist(), strict=True)}
    assert len(lists) == len(grams)
    assert lists.pop(title_index.LENGTHS).tolist() == [len(t) for t in titles]
    return {g: np.cumsum(x).tolist() for g, x in lists.items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab é☃😀", max_size=12), min_size=1, max_size=8))
def test_lists_hold_every_place(titles):
    assert read(titles) == places(titles)


def test_lists_of_more_characters_than_two_bytes_count():
    titles = ["".join(map(chr, range(0x10000, 0x10000 + 66_000))), "ab", "".join(map(chr, range(0x10000, 0x10100)))]
    assert read(titles) == places(titles)


def test_parts_are_runs_of_one_block(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(title_index, "PART_CHARS", 5)
    rows = [(1, 0, "aa"), (1, 1, "bbb"), (1, 2, "c"), (1, 3, "d" * 9), (2, 0, ""), (2, 1, "e"), (2, 4, "f")]
    table = pa.table([pa.array(c) for c in zip(*rows)], ["block", "row", "title_lc"])
    want = [(1, 0, ["aa", "bbb"]), (1, 2, ["c"]), (1, 3, ["d" * 9]), (2, 0, ["", "e"]), (2, 4, ["f"])]
    for size in (1, 2, 7):
        assert list(title_index._parts(table.to_batches(size))) == want


def test_lists_take_about_a_byte_a_character(spark, make_items, tmp_path):
    """One row per title and bigram, with the place of the title, takes more than three on disk."""
    r = random.Random(3)
    words = ["".join(r.choices("etaoinshrdlucmfwyp", range(18, 0, -1), k=r.randrange(2, 9))) for _ in range(4000)]
    titles = [" ".join(r.choices(words, k=50)) for _ in range(3000)]
    title_index.write_title_index(make_items(*[{"title": t} for t in titles]), str(tmp_path))
    size = sum(f.stat().st_size for f in tmp_path.glob("postings/*.parquet"))
    assert size < 1.5 * sum(map(len, titles))


@pytest.mark.parametrize("fits", [True, False])
def test_blocks_twice_and_nulls(spark, make_items, tmp_path, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(distribution, "fits_broadcast", lambda *a: False)
    r = random.Random(5)
    titles = ["".join(r.choice("aabn ert") for _ in range(r.randrange(0, 60))) for _ in range(300)]
    titles += [None, "", "banana", "xbanxna", "bbanana", "banan"]
    items = make_items(*[{"title": t} for t in titles], {"title": "banana", "profile": None}).repartition(5, "ord")
    title_index.write_title_index(items.unionAll(items.filter(F.col("title").contains("xb"))), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/titles").select("block").distinct().count() > 1
    got = sorted(x["ord"] for x in title_index.search_index(spark, str(tmp_path), "banana").collect())
    want = found(titles, "banana")
    assert 10 < len(want) < 250
    assert got == sorted([*want, *(i for i, t in enumerate(titles) if t and "xb" in t and i in want)])


def test_a_title_that_is_no_candidate_does_not_meet_its_windows(spark, make_items, tmp_path):
    title_index.write_title_index(make_items({"title": "nerth day"}, {"title": "zzzz zzzz"}, {"title": ""}), str(tmp_path))
    rows = title_index.candidate_windows(spark, str(tmp_path), "nerth dai", 3).collect()
    assert [(x["row"], x["starts"]) for x in rows] == [(0, [0])]


def test_an_empty_index_finds_nothing(spark, make_items, tmp_path):
    title_index.write_title_index(make_items(), str(tmp_path))
    assert title_index.search_index(spark, str(tmp_path), "nerth dai").count() == 0
    assert title_index.search_index(spark, str(tmp_path), "n").count() == 0
