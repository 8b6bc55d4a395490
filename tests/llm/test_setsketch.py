import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from catalogia.llm import setsketch, similar_classes
from catalogia.llm.setsketch import estimate, merged, near_duplicates, sketch
from helpers import awkward, documents, near, prose

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(texts):
    out = []
    for t in texts:
        w = [] if t is None else t.encode().translate(LOWER).split()
        out.append(set(zip(w, w[1:])) if len(w) >= 2 else ({tuple(w)} if w else set()))
    return out


def plain(ids, texts):
    sets, label = sets_of(texts), list(range(len(ids)))
    changed = True
    linked = [(i, j) for i in range(len(ids)) for j in range(i) if sets[i] and sets[j]
              and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in linked:
            least = min(label[i], label[j])
            if label[i] != least or label[j] != least:
                label[i] = label[j] = least
                changed = True
    groups = {}
    for i, d in enumerate(ids):
        if d is not None:
            groups[label[i]] = min(groups.get(label[i], d), d)
    rows = []
    for i, d in enumerate(ids):
        least = groups.get(label[i])
        rows.append((d, len(sets[i]), least, None if d is None or least is None else d == least))
    return sorted(rows, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in df.collect()), key=repr)


def random_sets(seed, shared, own_a, own_b):
    hashes = np.random.default_rng(seed).integers(0, 1 << 63, shared + own_a + own_b, dtype=np.uint64)
    return hashes[:shared + own_a], np.concatenate([hashes[:shared], hashes[shared + own_a:]])


def test_equals_brute_force(spark):
    base = [prose(50 + i, 60 + 10 * i, 80) for i in range(6)]
    texts = awkward(400) + [near(b, 9 * i + k, k) for i, b in enumerate(base) for k in range(1, 6)]
    texts += [" ".join(base[4].split()[:n]) for n in (60, 70, 80, 88, 100)] + ["a b", "B A", "b a", "A  b", "x"]
    docs = documents(spark, texts, clash=True)
    assert found(near_duplicates(docs)) == plain(range(len(texts)), texts)


@pytest.mark.parametrize("block", [3, 500])
def test_group_of_near_copies_and_common_passage(spark, monkeypatch, block):
    monkeypatch.setattr(similar_classes, "BLOCK", block)
    passage, base = prose(3, 30), prose(4, 100)
    texts = [near(base, i, 5) for i in range(60)] + [prose(100 + i, 60) + " " + passage for i in range(40)]
    assert found(near_duplicates(documents(spark, texts))) == plain(range(len(texts)), texts)


def test_repeated_and_null_ids(spark):
    a, b = prose(1), prose(2)
    rows = [(3, a), (3, b), (7, near(a, 1)), (None, near(b, 2)), (None, prose(5)), (2, None), (2, ""), (9, a), (9, a)]
    assert found(near_duplicates(documents(spark, rows))) == plain([i for i, _ in rows], [t for _, t in rows])


def test_empty_tables(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert found(near_duplicates(documents(spark, [None, ""]))) == [(0, 0, 0, True), (1, 0, 1, True)]


def test_registers_merge():
    a, b = random_sets(1, 300, 50, 80)
    both = sketch([np.union1d(a, b)])[0]
    assert (merged(*sketch([a, b])) == both).all()
    assert (sketch([a[::-1].copy()])[0] == sketch([a])[0]).all()


def test_joint_estimate_is_near_the_similarity():
    for shared, own_a, own_b in ((800, 100, 100), (450, 50, 60), (900, 0, 100), (500, 250, 250), (40, 5, 5), (100, 900, 900)):
        true = shared / (shared + own_a + own_b)
        guesses = []
        for seed in range(40):
            a, b = random_sets(seed, shared, own_a, own_b)
            x, y = sketch([a, b])
            guesses.append(estimate(x, y, len(a), len(b)))
        assert abs(np.mean(guesses) - true) < 0.02 and np.std(guesses) < 0.06


def test_banding_loses_no_pair_at_the_threshold():
    """Every one of 2000 pairs at the threshold shares a band and passes the estimate."""
    r, missed = random.Random(3), 0
    for seed in range(2000):
        shared = r.choice([40, 80, 200, 400])
        own = shared // 4
        a, b = random_sets(seed, shared, own - own // 2, own // 2)
        x, y = sketch([a, b])
        bands = (x == y).reshape(-1, setsketch.BAND).all(axis=1)
        missed += not bands.any() or estimate(x, y, len(a), len(b)) < setsketch.LEAST_ESTIMATE
    assert missed == 0


def test_partners_are_named_once_per_limit():
    """All pairs of a group pass: each place names its first partners and says whether there are more."""
    start, label = np.array([0] * 6 + [6] * 3), np.arange(9)
    none = np.zeros(9, np.int64)
    for limit in (1, 2, 100):
        left, right, more = similar_classes.partners(start, label, none, none > 0, limit, lambda a, b: np.ones(len(a), bool))
        got = sorted(zip(right.tolist(), left.tolist(), strict=True))
        want = [(i, j) for i in range(9) for j in range(start[i], i) if j - start[i] < limit]
        assert got == want
        assert more.tolist() == [i - start[i] > limit for i in range(9)]


@pytest.mark.parametrize("times", [1, 2])
def test_texts_are_shuffled_only_where_rows_repeat(spark, monkeypatch, times):
    made, plain_stored = [], similar_classes.stored
    monkeypatch.setattr(similar_classes, "stored", lambda df: made.append(df) or plain_stored(df))
    texts = [prose(i, 20) for i in range(30)]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] * times).repartition(4)
    classes = docs.distinct().selectExpr("doc_id as fp", "struct(doc_id, xxhash64(text) as text_hash) as rep").filter("fp % 2 = 0").distinct()
    got = similar_classes.texts_of(docs, classes, classes.filter("fp > 4")).collect()
    assert {r["fp"]: zstandard.ZstdDecompressor().decompress(r["packed"]).decode() for r in got} == {i: texts[i] for i in range(6, 30, 2)}
    assert len(got) == 12 and len(made) == 1 + times
    plan = made[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(fp") == 0


def test_two_components_are_joined_by_few_pairs():
    r = np.random.default_rng(6)
    start, label = np.repeat([0, 40], 40), r.integers(0, 4, 80)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(80), np.arange(80)))
    ok = (left < right) & (start[left] == start[right]) & (label[left] != label[right])
    left, right = left[ok], right[ok]
    for limit in (1, 3, 10_000):
        kept = similar_classes.fewest(start, label, left, right, limit)
        groups = {}
        for a, b, k in sorted(zip(left.tolist(), right.tolist(), kept.tolist(), strict=True), key=lambda x: (x[1], x[0])):
            groups.setdefault((start[b], *sorted([label[a], label[b]])), []).append(k)
        assert all(g == [i < limit for i in range(len(g))] for g in groups.values()) and len(groups) == 12
    none = np.zeros(0, np.int64)
    assert similar_classes.fewest(none, none, none, none, 1).tolist() == []


def test_links_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Two blocks of near copies become components of their own, which then meet under very many keys."""
    made, plain = [], similar_classes._linked
    monkeypatch.setattr(similar_classes, "BLOCK", 50)
    monkeypatch.setattr(similar_classes, "_linked", lambda pairs, *a: made.append(pairs.count()) or plain(pairs, *a))
    base = prose(4, 120)
    texts = [near(base, i, 2) for i in range(200)]
    rows = found(near_duplicates(documents(spark, texts)))
    assert {c for _, _, c, _ in rows} == {0}
    assert sum(made) < 15 * len(texts)


def test_later_rounds_open_only_keys_with_pairs_left(spark, monkeypatch):
    """Once all pairs of a key have been verified, its sets are not looked at again."""
    opened, plain_rounds = [], similar_classes._candidates
    monkeypatch.setattr(similar_classes, "MORE_PARTNERS", 2)
    monkeypatch.setattr(similar_classes, "_candidates", lambda rows, *a: opened.append(rows.count()) or plain_rounds(rows, *a))
    base, apart = prose(4, 100), [prose(100 + i, 60) for i in range(40)]
    texts = [near(base, i, k) for k in (1, 4, 8, 12, 16) for i in range(k * 100, k * 100 + 25)]
    texts += [t for i, one in enumerate(apart) for t in (one, near(one, i, 9))]
    assert found(near_duplicates(documents(spark, texts))) == plain(range(len(texts)), texts)
    assert len(opened) > 2 and all(b < a for a, b in zip(opened[1:], opened[2:], strict=False))


def test_only_sets_of_near_sizes_meet(spark):
    r = np.random.default_rng(7)
    rows = [(int(k), int(f), 1 + int(f) * 7919 % 200) for k, f in zip(r.integers(0, 60, 400), r.integers(0, 90, 400), strict=True)]
    got = similar_classes.size_fits(spark.createDataFrame(rows, "key long, fp long, n int"), 80).collect()
    size = {f: n for _, f, n in rows}
    of_key = {k: {f for key, f, _ in rows if key == k} for k, _, _ in rows}
    want = {(k, f) for k, fps in of_key.items() for f in fps for g in fps - {f}
            if 100 * min(size[f], size[g]) >= 80 * max(size[f], size[g])}
    assert sorted((x["key"], x["fp"]) for x in got) == sorted(want) and 0 < len(want) < len(set(rows))


def test_parities_of_different_widths():
    """They never show more than the sets differ in, and tell unlike sets apart at every size."""
    r = np.random.default_rng(8)
    sets = []
    for n in (1, 5, 40, 64, 100, 200, 500, 800, 1500, 5000):
        common, own = r.integers(0, 1 << 63, n).astype(np.uint64), r.integers(0, 1 << 63, n).astype(np.uint64)
        sets += [common, np.concatenate([common[n // 10:], own[:n // 10]]), own]
    bits = [similar_classes.fitting_bits(len(x)) for x in sets]
    assert min(bits) == similar_classes.LEAST_BITS and max(bits) == similar_classes.MOST_BITS and len(set(bits)) > 4
    column = pa.array([similar_classes.parity(x, b).tobytes() for x, b in zip(sets, bits, strict=True)], pa.binary())
    left, right = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    for skip in (0, 4):
        on = (left >= skip) & (right >= skip)
        apart = similar_classes.Parities(column.slice(skip)).apart(left[on] - skip, right[on] - skip)
        assert all(a <= len(np.setxor1d(sets[i], sets[j])) for a, i, j in zip(apart.tolist(), left[on], right[on], strict=True))
        for k in range(6, len(sets), 3):
            n = len(sets[k])
            at = np.flatnonzero((left[on] == k) & (right[on] == k + 2))
            assert not similar_classes.may_overlap(apart[at], np.array([n]), np.array([n]), 80).any()


def test_pairs_that_were_left_out_are_tried_later(spark, monkeypatch):
    """Of two components that meet, the pairs that link come after many that do not."""
    monkeypatch.setattr(similar_classes, "MORE_PARTNERS", 2)
    base = prose(4, 100)
    texts = [near(base, i, k) for k in (1, 4, 8, 12, 16) for i in range(k * 100, k * 100 + 25)]
    assert found(near_duplicates(documents(spark, texts))) == plain(range(len(texts)), texts)


def test_partners_in_small_chunks(monkeypatch):
    r = np.random.default_rng(5)
    monkeypatch.setattr(similar_classes, "PAIRS", 7)
    sizes = r.integers(1, 12, 30)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    label, own = r.integers(0, 6, len(start)), r.integers(0, 2, len(start))
    across = np.repeat(r.random(30) < 0.5, sizes)
    similar = r.random((len(start), len(start))) < 0.3
    for limit in (1, 3, 50):
        left, right, more = similar_classes.partners(start, label, own, across, limit, lambda a, b: similar[a, b])
        want = {i: [j for j in range(start[i], i) if label[i] != label[j] and similar[j, i]
                    and not (across[i] and own[i] == own[j])] for i in range(len(start))}
        got = {i: sorted(left[right == i].tolist()) for i in want}
        for i, listed in want.items():
            assert got[i] == listed[:limit]
            assert more[i] or len(listed) <= limit


def test_pairs_left_over_open_one_key_each(spark, monkeypatch):
    """Two components that meet under many keys: a pair is tried again under one of its keys, not under all."""
    opened, plain_open = [], similar_classes._open_postings
    monkeypatch.setattr(similar_classes, "MORE_PARTNERS", 4)
    monkeypatch.setattr(similar_classes, "_open_postings", lambda rows, labels: opened.append(
        rows.select("key").distinct().count()) or plain_open(rows, labels))
    keys = spark.range(200).selectExpr("id", f"pmod(xxhash64(id), {similar_classes.FIRST_KEYS}) = 0 as early").collect()
    early, late = ([r["id"] for r in keys if r["early"] == e] for e in (True, False))
    # Four copies in each component; every pair of unlike texts shares three keys of its own.
    texts = {f: prose(1 if f < 4 else 2, 60) for f in range(8)}
    rows = [(early[f // 4], f) for f in texts]
    rows += [(late[3 * (4 * a + b) + i], f) for a in range(4) for b in range(4) for i in range(3) for f in (a, 4 + b)]
    packed = [(f, zstandard.ZstdCompressor().compress(t.encode())) for f, t in texts.items()]
    labels = similar_classes.similar_labels(
        spark.createDataFrame(rows, "key long, fp long"), spark.createDataFrame([(f, 1) for f in texts], "fp long, n long"),
        spark.createDataFrame(packed, "fp long, packed binary"),
        lambda table: (similar_classes.everywhere, similar_classes.everywhere), setsketch.two_word_sets, 80).collect()
    assert {(r["node"], r["label"]) for r in labels} == {(f, 4 * (f // 4)) for f in texts}
    assert opened == [2, 50, 16]
