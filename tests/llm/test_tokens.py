import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalogia.llm.encoding import Encoder, encoded_batches
from catalogia.llm.packing import CapacityTree, best_fit_plan, pack_documents
from catalogia.llm import token_store
from catalogia.llm.token_store import Block, blocks_of, look_up, perfect_hash, read_store, write_store
from helpers import awkward, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["  a  b\n\n c\t d", "don't  'tis I'LL we're x   y\r\n z ", "<|endoftext|> x", "a<|endoftext|>b", " x  <|endoftext|><|endoftext|>\n y", "<|endoftext|", "é\x1cà \x85b", "日本語 テスト　全角",
       "12ab34 !!?? ''' 's", " \n \n", "a​b ᠎ c", "naïve.Next,word;x½y²", "don'tcan't it's'll"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_equals_tokenizer(reference):
    r = random.Random(3)
    texts = awkward(300) + ODD + ["".join(r.choice([*"abé.,'’ \n\t\x1c19!ñ", "<|endoftext|>"]) for _ in range(50)) for _ in range(1500)]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoded_batches(texts, Encoder(PATH), chars=5000)]
    assert got == [reference(t) for t in texts]


def test_tightest_bin():
    r, tree, open_bins = random.Random(1), CapacityTree(100), []
    for _ in range(2000):
        if r.random() < 0.6 or not open_bins:
            c = r.randrange(1, 101)
            tree.add(c, 1)
            bisect.insort(open_bins, c)
        else:
            c = open_bins.pop(r.randrange(len(open_bins)))
            tree.add(c, -1)
        length = r.randrange(1, 101)
        k = bisect.bisect_left(open_bins, length)
        assert tree.tightest(length) == (open_bins[k] if k < len(open_bins) else None)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    r, cap = random.Random(seed), 64
    counts = {r.randrange(1, cap + 1): r.randrange(1, 60) for _ in range(25)}
    used, places = {}, 0
    for length, _, items, per_bin, first, offset in best_fit_plan(counts, cap):
        for i in range(items):
            b, at = first + i // per_bin, offset + i % per_bin * length
            assert used.get(b, 0) == at
            used[b] = at + length
            places += 1
    assert places == sum(counts.values()) and max(used.values()) <= cap
    bins, n = [], 0
    for length in sorted((k for k, c in counts.items() for _ in range(c)), reverse=True):
        k = bisect.bisect_left(bins, length)
        if k == len(bins):
            n, room = n + 1, cap - length
        else:
            room = bins.pop(k) - length
        bisect.insort(bins, room)
    assert len(used) == n


def test_packing(spark, reference):
    texts = awkward(900)
    rows = pack_documents(documents(spark, texts, clash=True), PATH, capacity=64).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for doc, pieces in by_doc.items():
        ids, pieces = np.array(reference(texts[doc]), "<u4"), sorted(pieces, key=lambda p: p["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(p["length"] == 64 for p in pieces[1:]) and (len(pieces) == 1 or len(ids) > 64)
        for p in pieces:
            assert zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 64
    assert pack_documents(documents(spark, []), PATH).count() == 0


def test_perfect_hash():
    for n in (1, 2, 3, 10, 500):
        hashes = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
        assert sorted(perfect_hash(hashes)[1].tolist()) == list(range(n))


def test_perfect_hash_is_quick_and_takes_the_least_displacement():
    n = 3000
    hashes = np.random.default_rng(7).integers(0, 1 << 63, n).astype(np.uint64)
    calls, plain = [], token_store._slots
    token_store._slots = lambda *a: calls.append(1) or plain(*a)
    try:
        displacements, slot = perfect_hash(hashes)
    finally:
        token_store._slots = plain
    assert len(calls) < 8 * len(displacements)
    taken, buckets = np.zeros(n, bool), (hashes % np.uint64(len(displacements))).astype(np.int64)
    for b in np.argsort(-np.bincount(buckets, minlength=len(displacements)), kind="stable"):
        members = np.flatnonzero(buckets == b)
        if len(members) < 2:
            break
        for d in range(displacements[b] + 1):
            at = plain(hashes[members], np.full(len(members), d), n)
            fits = not taken[at].any() and len(set(at.tolist())) == len(at)
            assert fits == (d == displacements[b])
        assert slot[members].tolist() == at.tolist()
        taken[at] = True


def test_words_encoded_together(reference):
    encoder, r = Encoder(PATH), random.Random(5)
    words = sorted({" " + "".join(r.choice("abcdeèüßñ日本я") for _ in range(r.randrange(1, 14))) for _ in range(6000)})
    got = dict(encoder._encoded_words(words))
    assert [np.frombuffer(got[w], "<u4").tolist() for w in words] == [reference(w)[:-1] for w in words]
    # Words that a token with a blank does not begin are encoded one by one.
    encoder.opens[:] = False
    assert dict(encoder._encoded_words(words)) == got and dict(encoder._encoded_words([])) == {}


def test_store(spark, reference, tmp_path):
    texts = [(100 - 3 * i, t) for i, t in enumerate(awkward(900) + ODD)]
    texts += [(28, "twice"), (None, "no key"), (None, None)]
    path = str(tmp_path / "store")
    write_store(documents(spark, texts, clash=True), PATH, path, block_bytes=300)
    rows = sorted(read_store(spark, path).collect(), key=lambda r: r["start"])
    assert len(rows) == len(texts)
    ids_of = [-1 << 63 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids_of == sorted(-1 << 63 if i is None else i for i, _ in texts)
    at, seen = 0, []
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        seen.append((r["doc_id"], r["n_tokens"], r["ids_crc32"]))
    want = [(i, len(reference(t)), zlib.crc32(np.array(reference(t), "<u4").tobytes())) for i, t in texts]
    assert sorted(seen, key=repr) == sorted(want, key=repr)
    got = look_up(spark, path, [100, 97, 28, 10 ** 6, 10 ** 6]).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == sorted((i, reference(t)) for i, t in texts if i in (100, 97, 28))
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len(blocks) > 5
    absent = np.arange(10 ** 6, 10 ** 6 + 200)
    assert all((Block(b).find(absent, np.zeros(200, np.int64)) < 0).all() for b in blocks)


def test_look_up_opens_only_the_blocks_of_its_keys(spark, reference, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "INDEX_KEYS", 7)
    texts = [(i, f"text {i} " * 20) for i in range(60)] + [(33, f"copy {k} " * 30) for k in range(20)]
    path = str(tmp_path / "store")
    write_store(documents(spark, texts), PATH, path, block_bytes=200)
    places = {d: [(b["part"], b["block"]) for b in blocks if d in np.frombuffer(b["keys"], np.int64)]
              for blocks in [spark.read.parquet(f"{path}/blocks").collect()] for d in range(60)}
    for d in (0, 17, 59):
        assert blocks_of(spark, path, [d]) == places[d] and len(places[d]) == 1
    assert len(places[33]) > 3 and set(places[33]) <= set(blocks_of(spark, path, [33]))
    assert sorted(r["ids"] for r in look_up(spark, path, [33, 61]).collect()) == sorted(
        reference(t) for i, t in texts if i == 33)
    assert blocks_of(spark, path, []) == [] and look_up(spark, path, []).count() == 0


def test_empty_store(spark, tmp_path):
    path = str(tmp_path / "store")
    write_store(documents(spark, []), PATH, path)
    assert read_store(spark, path).count() == 0
    assert look_up(spark, path, [1]).count() == 0
