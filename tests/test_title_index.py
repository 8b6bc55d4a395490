import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from catalogia.functions.nearness import code_points, near_windows, window_distances
from catalogia.operators import browse, title_index


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def found(titles, q, tolerance=0.35):
    q, m = q.strip().lower(), len(q.strip())
    limit = int(m * tolerance)
    out = set()
    for i, t in enumerate(titles):
        t = (t or "").lower()
        windows = [t[s:s + m] for s in range(max(1, len(t) - m + 1))]
        if q in t or any(distance(w, q) <= limit for w in windows):
            out.add(i)
    return out


@settings(max_examples=150, deadline=None)
@given(st.text("abé☃", max_size=30), st.text("abé☃", min_size=1, max_size=9))
def test_windows_have_their_edit_distance(text, query):
    starts = np.arange(max(0, len(text) - len(query) + 1))
    got = window_distances(code_points(text), starts, code_points(query)).tolist()
    assert got == [distance(text[s:s + len(query)], query) for s in starts.tolist()]


@pytest.mark.parametrize("m", [63, 64, 65, 80])
def test_long_queries(m):
    r = random.Random(m)
    text, query = ("".join(r.choice("abc") for _ in range(n)) for n in (200, m))
    starts = np.arange(len(text) - m + 1)
    assert window_distances(code_points(text), starts, code_points(query)).tolist() == [
        distance(text[s:s + m], query) for s in starts.tolist()]


def test_short_null_and_many_texts(monkeypatch):
    monkeypatch.setattr("catalogia.functions.nearness.CHUNK", 10)
    r = random.Random(1)
    texts = [None, "", "a", "ab", "abc"] + ["".join(r.choice("abcd") for _ in range(r.randrange(12))) for _ in range(300)]
    got = near_windows(texts, "abca", 1).tolist()
    want = found([t or "" for t in texts], "abca", 0.25)
    assert got == [t is not None and i in want for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def titles():
    r = random.Random(2)
    made = ["".join(r.choice("aabn ert☃") for _ in range(r.randrange(0, 40))) for _ in range(250)]
    return made + [None, "", "Nerth Day", "xx nerth dai", "the nert dayy", "erth dai", "NERTHDAI", "n", "banana", "ananas anana"]


@pytest.mark.parametrize("q", ["nerth dai", "an", "banana", " Tear ", "b", "nan nan nan", "ere☃te"])
def test_index_finds_what_a_scan_finds(spark, make_items, titles, tmp_path_factory, q):
    items = make_items(*[{"title": t} for t in titles])
    path = str(tmp_path_factory.getbasetemp() / "index")
    if not (tmp_path_factory.getbasetemp() / "index").exists():
        title_index.write_title_index(items, path)
    want = found(titles, q)
    assert {r["ord"] for r in title_index.search_index(spark, path, q).collect()} == want
    assert {r["ord"] for r in browse.search_titles(items, q).collect()} == want


def test_search_reads_the_lists_of_its_bigrams(spark, make_items, titles, tmp_path):
    title_index.write_title_index(make_items(*[{"title": t} for t in titles]), str(tmp_path))
    plan = title_index.candidate_windows(spark, str(tmp_path), "nerth", 1)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(gram" in plan.replace("IsNotNull(gram), ", "") and "title_lc" not in plan
    assert title_index.candidate_windows(spark, str(tmp_path), "zzzzz", 1).count() == 0
