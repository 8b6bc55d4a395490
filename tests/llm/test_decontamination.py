import random
from collections import Counter

import numpy as np

from catalogia.llm.decontamination import best_match, drop_contaminated, find_contamination, pieces_of, words_of
from helpers import awkward, documents, prose


def distance_in(pattern, text):
    """(least distance, its first end) of the pattern in any stretch of the text."""
    row = list(range(len(pattern) + 1))
    best = (len(pattern), 0)
    for j, t in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != t), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, (row[-1], j))
    return best


def test_best_match_equals_table():
    r = random.Random(1)
    for _ in range(300):
        pattern = [r.randrange(4) for _ in range(r.randrange(1, 90))]
        text = [r.randrange(4) for _ in range(r.randrange(0, 60))]
        if r.random() < 0.5:
            text[5:5] = [x for x in pattern if r.random() < 0.9]
        assert best_match(np.array(pattern), np.array(text, int)) == distance_in(pattern, text)


def test_pieces():
    for m in range(1, 60):
        parts = pieces_of(m, m // 8)
        assert len(parts) == m // 8 + 1 and sum(n for _, n in parts) == m and min(n for _, n in parts) >= 1


def edited(text, seed, edits):
    r, words = random.Random(seed), text.split()
    for _ in range(edits):
        at = r.randrange(1, len(words) - 1)
        kind = r.randrange(3)
        words[at:at + (kind != 0)] = [f"new{r.randrange(999)}"] if kind < 2 else []
    return " ".join(words)


def plain(docs, items):
    out = set()
    for i, t in docs:
        for j, p in items:
            words = words_of(p)
            if words:
                d = distance_in(words, words_of(t))[0]
                if d <= len(words) // 8:
                    out.add((i, j, d))
    return out


def test_equals_brute_force_both_ways(spark):
    items = [(j, prose(900 + j, 10 + 6 * j, 3000)) for j in range(8)] + [(50, None), (51, ""), (52, "tiny item")]
    docs = list(enumerate(awkward(300)))
    docs += [(100 + 10 * k + j, f"{prose(k, 30)} {edited(t, 7 * k + j, k)} {prose(k + 50, 20)}")
             for k in range(6) for j, t in items[:8]]
    docs += [(200, items[3][1].upper().replace(" ", "!! ")), (201, "a Tiny, item."), (201, "nothing"), (202, items[2][1] * 2)]
    d = documents(spark, docs, clash=True)
    i = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 0):
        got = find_contamination(d, i, broadcast_bytes=limit).collect()
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == plain(docs, items)
        found = {r["doc_id"] for r in got}
        kept = drop_contaminated(d, i, broadcast_bytes=limit)
        assert kept.columns == d.columns
        if limit:
            assert sorted(r["text"] or "" for r in kept.collect()) == sorted(
                t or "" for x, t in docs if x not in found or (x, t) == (201, "nothing"))
    places = {(r["doc_id"], r["item_id"]): (r["first_word"], r["last_word"]) for r in find_contamination(d, i).collect()}
    assert places[100, 0] == (30, 39)


def test_repeated_and_null_ids_both_ways(spark):
    items = [(j, prose(900 + j, 24, 3000)) for j in range(3)] + [(2, prose(950, 24, 3000))]
    held = [f"{prose(k, 20)} {edited(items[k][1], k, k % 3)} {prose(k + 50, 20)}" for k in range(4)]
    texts = [(None, held[0]), (None, held[0]), (None, prose(60)), (None, None), (7, held[1]), (7, held[1]),
             (7, prose(61)), (7, held[2] + " " + held[3]), (8, held[3]), (8, ""), (8, None), (9, prose(62)), (9, prose(62))]
    docs = documents(spark, texts, clash=True)
    given = spark.createDataFrame(items, "item_id long, text string")
    hits, clean = Counter(), Counter()
    for doc, text in texts:
        found = {}
        for _, item, distance in sorted(plain([(0, text)], items), reverse=True):
            found[item] = min(distance, found.get(item, distance))
        hits.update((doc, item, d) for item, d in found.items())
        clean[doc, text] += not found
    assert sum(hits.values()) == 6
    places = []
    for limit in (1 << 20, 0):
        got = find_contamination(docs, given, broadcast_bytes=limit).collect()
        assert Counter((r["doc_id"], r["item_id"], r["distance"]) for r in got) == hits
        places.append(Counter(got))
        kept = drop_contaminated(docs, given, broadcast_bytes=limit)
        assert kept.schema == docs.schema
        assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == +clean
    assert places[0] == places[1]


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "item_id long, text string"), documents(spark, awkward(100))
    assert find_contamination(some, none).count() == 0
    assert drop_contaminated(some, none).count() == some.count()
    assert find_contamination(documents(spark, []), none).count() == 0
