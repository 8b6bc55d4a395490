import hashlib
from collections import Counter

import numpy as np
import pytest

from catalogia.llm.common import word_chunks
from catalogia.llm.substring_dedup import leftmost_min, remove_duplicates
from helpers import awkward, documents, near, prose


def plain(texts, window=35):
    words = [[] if t is None else t.encode().split() for t in texts]
    starts = Counter(tuple(w[s:s + window]) for w in words for s in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if starts[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def digests(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"], r["kept_sha256"])
                  for r in df.collect())


def test_leftmost_min():
    values = np.random.default_rng(1).integers(0, 9, 300).astype(np.uint64)
    for span in (1, 2, 3, 7, 28):
        want = [i + int(np.argmin(values[i:i + span])) for i in range(len(values) - span + 1)]
        assert leftmost_min(values, span).tolist() == want


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    base = [prose(seed * 100 + i, 90, 30) for i in range(6)]
    texts = awkward() + base + [near(b, seed + i, 1 + i % 3) for i, b in enumerate(base)]
    texts += [" ".join(base[0].split()[10:60] + base[1].split()[5:70] + base[2].split()[20:56])]
    want = sorted((i, *row) for i, row in enumerate(plain(texts)))
    assert digests(remove_duplicates(documents(spark, texts, clash=True))) == want


def test_repeated_and_null_ids(spark):
    texts = [(5, prose(1)), (5, prose(2)), (5, prose(1)), (None, prose(3)), (None, prose(4) + " " + prose(3))]
    want = sorted((-1 if i is None else i, *row) for (i, _), row in zip(texts, plain([t for _, t in texts]), strict=True))
    assert digests(remove_duplicates(documents(spark, texts))) == want


@pytest.mark.parametrize("space", ["\u00a0", "\u3000", "\u2028", "\x85", "\x1c", "\x1f"])
def test_only_ascii_white_space_ends_a_word(spark, space):
    words = prose(20, 80).split()
    joined = " ".join(words[:10]) + space + " ".join(words[10:])
    blank = " ".join(words[:45]) + " 10 000 " + " ".join(words[45:])
    texts = [joined, " ".join(words), f"{space} {prose(21, 40)} {joined}{space}", blank,
             blank.replace("10 000", f"10{space}000"), prose(22, 36).replace(" ", space), f" {space} ".join(words)]
    texts += [f" {space} ".join(words[20:60]), " ".join(f"a{space}b" for _ in range(40))]
    want = sorted((i, *row) for i, row in enumerate(plain(texts)))
    assert digests(remove_duplicates(documents(spark, texts))) == want


def test_words_are_bytes():
    with pytest.raises(TypeError):
        list(word_chunks(["a b"]))


def test_empty_table(spark):
    assert remove_duplicates(documents(spark, [])).count() == 0
