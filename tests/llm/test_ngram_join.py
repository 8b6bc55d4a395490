import numpy as np
import pytest

from catalogia.llm import ngram_join
from catalogia.llm.components import components
from catalogia.llm.ngram_join import jaccard_components, prefix_length
from helpers import awkward, documents, near, prose

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(texts):
    out = []
    for t in texts:
        w = [] if t is None else t.encode().translate(LOWER).split()
        grams = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        out.append(grams if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def plain(ids, texts):
    sets, parent = sets_of(texts), list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d if d is not None else -1, len(sets[i]), least.get(find(i), -1)) for i, d in enumerate(ids))


def found(df):
    return sorted(tuple(-1 if v is None else v for v in (r["doc_id"], r["n_shingles"], r["component_id"]))
                  for r in df.collect())


def test_equals_brute_force(spark):
    base = [prose(50 + i, 60 + 10 * i, 80) for i in range(6)]
    texts = awkward(400) + [near(b, 9 * i + k, k) for i, b in enumerate(base) for k in range(1, 5)]
    # Sizes that differ as much as a link allows, and a chain of links.
    texts += [" ".join(base[4].split()[:n]) for n in (60, 70, 80, 88, 100)]
    assert found(jaccard_components(documents(spark, texts, clash=True))) == plain(range(len(texts)), texts)


def test_group_of_near_copies_and_common_passage(spark):
    passage, base = prose(3, 30), prose(4, 100)
    texts = [near(base, i, 3) for i in range(60)] + [prose(100 + i, 60) + " " + passage for i in range(40)]
    assert found(jaccard_components(documents(spark, texts))) == plain(range(len(texts)), texts)


def test_repeated_and_null_ids(spark):
    a, b = prose(1), prose(2)
    rows = [(3, a), (3, b), (7, near(a, 1)), (None, near(b, 2)), (None, prose(5)), (2, None), (2, "")]
    got = found(jaccard_components(documents(spark, rows)))
    assert got == plain([i for i, _ in rows], [t for _, t in rows])


def test_empty_table(spark):
    assert jaccard_components(documents(spark, [])).count() == 0


def test_only_empty_texts(spark):
    assert found(jaccard_components(documents(spark, [None, ""]))) == [(0, 0, 0), (1, 0, 1)]


def test_counts_demanded_are_safe():
    """Any two sets of enough overlap share the demanded number of prefix tokens under any order."""
    import random
    r = random.Random(1)
    for _ in range(400):
        n = r.randrange(1, 60)
        x = set(r.sample(range(200), n))
        y = set(r.sample(sorted(x), r.randrange(max(1, n - 8), n + 1))) | set(r.sample(range(200, 400), r.randrange(0, 6)))
        both = len(x & y)
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        order = list(range(400))
        r.shuffle(order)
        px, py = (set(sorted(s, key=order.__getitem__)[:prefix_length(len(s))]) for s in (x, y))
        least = -(-80 * (len(x) + len(y)) // 180)
        needed = max(1, min(least - -(-80 * len(s) // 100) + 1 for s in (x, y)))
        assert len(px & py) >= needed


def test_components(spark):
    import random
    r, n = random.Random(2), 200
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(r.randrange(150, n), r.randrange(150, n)) for _ in range(30)] + [(5, 5)]
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in nodes}


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 101])
def test_prefix_length(n):
    assert prefix_length(n) == n - -(-8 * n // 10) + 1
    assert ngram_join.PERCENT == 80


def test_counts_travel_as_planes():
    r = np.random.default_rng(1)
    size = ngram_join.CELLS // ngram_join.SLICES
    for counts in (r.poisson(0.2, size), np.zeros(size), r.integers(0, 1 << 32, size)):
        counts = counts.astype(np.uint32)
        (batch,) = ngram_join._slices({3: counts})
        assert (ngram_join._counts_in(batch.column(1)[0].as_py()) == counts).all()
    (batch,) = ngram_join._slices({0: r.poisson(0.2, size).astype(np.uint32)})
    assert len(batch.column(1)[0].as_py()) < size // 8
