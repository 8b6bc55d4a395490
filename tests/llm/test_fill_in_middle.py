import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from catalogia.llm.fill_in_middle import (
    ARRANGEMENTS, PLAIN, PieceTable, arrange, byte_place, choose, fill_in_middle, restore, restored,
)
from helpers import awkward, documents


def plain(doc, text):
    """Straight from the definition, with slices of the text."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, PLAIN, None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_equals_the_definition(spark):
    texts = awkward() + ["😀é☃" * 40, "a<P>b", "x <M>", "<S>", "<", "P>", "<<P", "long ☃ " * 30_000]
    texts += [f"text {i} über ☃ <P <S M> {'é' * (i % 7)}" for i in range(200)]
    rows = {r["doc_id"]: r for r in fill_in_middle(documents(spark, texts, clash=True)).collect()}
    assert len(rows) == len(texts)
    assert {r["form"] for r in rows.values()} == {"plain", "psm", "spm"}
    for i, text in enumerate(texts):
        n, form, prefix, middle, output = plain(i, text)
        r = rows[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == (n, form, prefix, middle, output)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_null_and_repeated_ids(spark):
    texts = [(3, "one two three"), (3, "one two three"), (3, "four"), (None, "five six"), (None, None)]
    rows = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["output"]) for r in fill_in_middle(documents(spark, texts)).collect())
    assert rows == sorted((-1 if d is None else d, plain(d, t)[4]) for d, t in texts)


def test_empty_table(spark):
    assert fill_in_middle(documents(spark, [])).count() == 0


def test_other_seed_other_cuts():
    assert {choose(i, 1000, False, 1) for i in range(50)} != {choose(i, 1000, False, 2) for i in range(50)}


def test_restored_as_a_column(spark):
    texts = [t for t in awkward() if t] + [f"t {i} é☃\n{i}" for i in range(60)]
    docs = documents(spark, texts)
    made = fill_in_middle(docs).select("doc_id", restored(F.col("output"), F.col("form")).alias("again"))
    assert {r["doc_id"]: r["again"] for r in made.collect()} == dict(enumerate(texts))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(0, 60), st.integers(0, 60), st.sampled_from(sorted(ARRANGEMENTS)))
def test_inverse(text, x, y, form):
    if any(s in text for s in ("<P>", "<S>", "<M>")):
        return
    content, n = text.encode("utf-8", "replace"), len(text)
    a, b = sorted((min(x, n), min(y, n)))
    parts = PieceTable.over(content).cut(byte_place(content, n, a), byte_place(content, n, b))
    assert [p.content().decode() for p in parts] == [text.encode("utf-8", "replace").decode()[i:j] for i, j in ((0, a), (a, b), (b, n))]
    assert restore(arrange(parts, form).content(), form).content() == content


def test_cuts_split_descriptors_of_several_buffers():
    joined = PieceTable.joined([PieceTable.over(b"abc"), PieceTable.over(b""), PieceTable.over(b"defg")])
    for i in range(8):
        for j in range(i, 8):
            assert [p.content() for p in joined.cut(i, j)] == [b"abcdefg"[:i], b"abcdefg"[i:j], b"abcdefg"[j:]]


@pytest.mark.parametrize("content", ["", "abc", "é☃😀", "a😀b"])
def test_byte_places(content):
    raw = content.encode()
    for i in range(len(content) + 1):
        assert byte_place(raw, len(content), i) == len(content[:i].encode())
