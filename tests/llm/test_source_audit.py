import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from catalogia.llm import source_audit as audit
from helpers import awkward, documents, prose

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWERED = {c: c + 32 for c in range(65, 91)}


def plain(rows):
    """The audit by definition; rows are (text, lang, source)."""
    docs = [[x or "" for x in row] for row in rows]
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = TERM.findall(text.translate(LOWERED))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {d[1] for d in docs}:
        kept = sorted(t for t, n in held[lang].items() if n >= 3)
        sources = sorted({d[2] for d in docs if d[1] == lang})

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (count[t] + 1) // total for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-((own[s][t] - whole[t]) ** 2 // whole[t]), t.encode(), t) for t in kept
                     if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


def audited(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def rows_of(df):
    return [(r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_equals_the_definition(spark):
    r = random.Random(4)
    words = ["éa", "x", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijklmnopq", "ABCDEFGH", "日本語文章", "日本"] + [
        "w" * i for i in range(1, 30)]
    texts = awkward(400) + [" ".join(r.choice(words) for _ in range(r.randrange(40))) for _ in range(120)]
    texts += ["don't stop-now a1b2 É\x00é", "z\u0000z_z", "日本語文章日本"] * 3
    docs = documents(spark, texts, clash=True).repartition(5)
    assert audited(audit.source_audit(docs)) == plain(rows_of(docs))


@pytest.mark.parametrize("limit", [1, 300])
def test_small_chunks_and_many_terms(spark, monkeypatch, limit):
    monkeypatch.setattr(audit, "CHUNK_BYTES", limit)
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = [prose(i, 900, 2000).translate(letters) for i in range(30)] + [None, ""]
    docs = documents(spark, texts)
    found = audited(audit.source_audit(docs))
    assert found == plain(rows_of(docs))
    assert max(r[5] for r in found if r[2] == "term") == 200


def test_groups_without_terms_have_their_pairs(spark):
    docs = documents(spark, ["", None, "1 2 3", "only once", "a b", "c d"])
    found = audited(audit.source_audit(docs))
    assert found == plain(rows_of(docs)) and found and all(r[4] == 0 and r[2] == "pair" for r in found)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = documents(spark, [(7, "same words here"), (7, "same words here"), (7, "same words here"), (None, "same more"), (None, "more")])
    assert audited(audit.source_audit(docs)) == plain(rows_of(docs))
    assert audit.source_audit(documents(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "a", "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "abcdefghabcdefghx", "é" * 9, "b"]),
                         max_size=8).map(" ".join), max_size=6))
def test_pointers_are_sorted_by_their_words(texts):
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in raw])).astype(np.int64)
    starts, lengths = audit.term_pointers(buffer, offsets)
    want = [w for t in raw for w in t.split()]
    words = [buffer[s:s + n].tobytes() for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
    assert words == want
    if words:
        order, new = audit.sort_pointers(buffer, starts, lengths)
        assert order.tolist() == sorted(range(len(words)), key=lambda i: (words[i], i))
        assert [words[i] for i in order[new]] == sorted(set(words))


def test_shares_are_exact():
    counts = np.array([0, 1, 10 ** 14, 5 * 10 ** 12, 7], np.int64)
    total = 10 ** 15 + 7
    assert audit.shares(counts, total).tolist() == [1 + 10 ** 9 * (c + 1) // total for c in counts.tolist()]
    assert audit.shares(np.array([0, 5], np.int64), np.array([1, 6])).tolist() == [10 ** 9 + 1] * 2
