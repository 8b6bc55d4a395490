"""Benchmark decontamination: pigeonhole seeds verified by bit-parallel edit distance.

A test item of m words may be found with up to k word edits.  Cut into k + 1 pieces, at least one
piece of any such occurrence is untouched: pieces are looked up exactly by hash, and the
surroundings of each hit are verified by Myers' bit-parallel approximate search.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catalogia.llm.common import NO_ID, Rolling, small_batches, word_hashes

# One edit is allowed per this many words of an item.
WORDS_PER_EDIT = 8
# Items are given to every task up to this measured size; larger sets are joined by piece.
BROADCAST_BYTES = 64 * 1024 * 1024
EDGES = "".join(c for c in map(chr, range(0x2050)) if unicodedata.category(c)[0] in "PS")
HITS = "doc_id long, item_id long, distance int, first_word long, last_word long"
HIT = {"item_id": pa.int64(), "distance": pa.int32(), "first_word": pa.int64(), "last_word": pa.int64()}
KEY = ["_doc", "_hash"]
KEYED = dict.fromkeys(KEY, pa.int64())


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without punctuation at their edges."""
    stripped = (w.strip(EDGES) for w in (text or "").lower().split())
    return [w.encode() for w in stripped if w]


def pieces_of(m: int, k: int) -> list[tuple[int, int]]:
    """(start, length) of k + 1 pieces of nearly equal length covering m words."""
    cuts = [m * i // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_match(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(distance, end) of the best approximate occurrence of pattern in text; the first of equals.

    Myers' vectors as whole numbers of m bits: one step per word of the text whatever m is.
    """
    m = len(pattern)
    masks: dict[int, int] = defaultdict(int)
    for i, symbol in enumerate(pattern.tolist()):
        masks[symbol] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, at = full, 0, m, m, 0
    for j, symbol in enumerate(text.tolist()):
        eq = masks.get(symbol, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        ph, mh = down | (~(d | up) & full), up & d
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        up, down = mh | (~(x | ph) & full), ph & x
        if score < best:
            best, at = score, j + 1
    return best, at


class Items:
    """Hashed items, and their pieces by length, ready for look-up."""

    def __init__(self, rows: list[tuple[int, list[bytes]]], words_per_edit: int):
        self.hashes, self.edits, found = {}, {}, defaultdict(list)
        for item, words in rows:
            h = word_hashes(words)
            k = len(h) // words_per_edit
            self.hashes[item], self.edits[item] = h, k
            if len(h):
                rolling = Rolling(h)
                for start, length in pieces_of(len(h), k):
                    key = int(rolling.of(np.array([start]), np.array([start + length]))[0])
                    found[length].append((key, item, start))
        self.by_length = {}
        for length, entries in found.items():
            entries.sort()
            keys = np.array([e[0] for e in entries], dtype=np.uint64)
            sieve = np.zeros(1 << 16, dtype=bool)
            sieve[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.by_length[length] = keys, sieve, entries

    def candidates(self, h: np.ndarray) -> dict[int, list[int]]:
        """item -> places where an occurrence would start, from exact piece hits."""
        places = defaultdict(list)
        if not len(h):
            return places
        rolling = Rolling(h)
        for length, (keys, sieve, entries) in self.by_length.items():
            n = len(h) - length + 1
            if n < 1:
                continue
            at = np.arange(n)
            seen = rolling.of(at, at + length)
            at = at[sieve[(seen & np.uint64(0xFFFF)).astype(np.int64)]]
            low = np.searchsorted(keys, seen[at], "left")
            for pos, first in zip(at.tolist(), low.tolist(), strict=True):
                value = int(seen[pos])
                while first < len(entries) and entries[first][0] == value:
                    places[entries[first][1]].append(pos - entries[first][2])
                    first += 1
        return places

    def verify(self, h: np.ndarray, item: int, places: list[int]):
        """(distance, first, last) of the best occurrence within the budget, or None."""
        pattern, k = self.hashes[item], self.edits[item]
        m, best, done = len(pattern), None, -1
        for place in sorted(set(places)):
            low, high = max(0, place - k), min(len(h), place + m + k)
            if high <= done:
                continue
            done = high
            distance, end = best_match(pattern, h[low:high])
            if distance <= k and (best is None or distance < best[0]):
                _, length = best_match(pattern[::-1], h[low:low + end][::-1])
                best = (distance, low + end - length, low + end - 1)
                if distance == 0:
                    break
        return best


def _rows(found: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))


def find_contamination(docs: DataFrame, items: DataFrame, words_per_edit: int = WORDS_PER_EDIT,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per (doc_id, item_id) whose text holds the item within its edit budget.

    The budget of an item of m words is m // words_per_edit word edits (insert, delete, replace);
    words are lower-case without punctuation at their edges.  ``distance`` is the least found,
    ``first_word`` and ``last_word`` its place among those words (the first of equally near).
    Items without words are found nowhere, null and empty documents hold nothing; repeated
    documents give repeated rows, repeated item ids (with their own texts) are searched each and
    give the nearest; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    items = _distinct(items)
    rows = docs.select("doc_id", "text")
    pairs = _listed(items, broadcast_bytes)
    if pairs is None:
        keyed = rows.select("doc_id", *_key(), "text")
        found = _joined(keyed.select("_doc", "_hash", "text"), items, words_per_edit)
        return keyed.drop("text").join(found, KEY).select(
            F.col("doc_id").cast("long").alias("doc_id"), "item_id", "distance", "first_word", "last_word")

    def search(batches):
        known = Searcher(pairs, words_per_edit)
        for batch in batches:
            yield _rows([
                (doc, item, *hit)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for item, hit in known.hits(text).items()
            ], {"doc_id": pa.int64(), **HIT})

    return rows.mapInArrow(search, HITS)


def drop_contaminated(docs: DataFrame, items: DataFrame, words_per_edit: int = WORDS_PER_EDIT,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the rows in which ``find_contamination`` finds an item; columns unchanged."""
    small_batches(docs.sparkSession)
    items = _distinct(items)
    pairs = _listed(items, broadcast_bytes)
    if pairs is None:
        rows = docs.select(F.struct("*").alias("_row"), *_key())
        found = _joined(docs.select(*_key(), "text"), items, words_per_edit).select(*KEY).distinct()
        return rows.join(found, KEY, "left_anti").select("_row.*")

    def clean(batches):
        known = Searcher(pairs, words_per_edit)
        for batch in batches:
            yield batch.filter(pa.array([not known.hits(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def _key():
    """Columns that tell rows apart by what is searched: the id (null: NO_ID) and the text's hash."""
    return (F.coalesce("doc_id", F.lit(NO_ID)).alias("_doc"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))


def _distinct(items: DataFrame) -> DataFrame:
    return items.filter("item_id is not null").select("item_id", "text").distinct()


def _listed(items: DataFrame, broadcast_bytes: int) -> list[tuple[int, list[bytes]]] | None:
    """Items and their words, or None if their measured size is over the limit."""
    size = items.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 64).alias("b")).first()["b"] or 0
    if size > broadcast_bytes:
        return None
    return [(r["item_id"], words_of(r["text"])) for r in items.collect()]


class Searcher:
    """Finds the listed items in texts."""

    def __init__(self, pairs: list[tuple[int, list[bytes]]], words_per_edit: int):
        self.ids = [item for item, _ in pairs]
        self.items = Items(list(enumerate(words for _, words in pairs)), words_per_edit)

    def hits(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """item_id -> (distance, first word, last word) of the nearest occurrence."""
        h, best = word_hashes(words_of(text)), {}
        for i, places in self.items.candidates(h).items():
            hit, item = self.items.verify(h, i, places), self.ids[i]
            if hit and (item not in best or hit < best[item]):
                best[item] = hit
        return best


def _joined(keyed: DataFrame, items: DataFrame, words_per_edit: int) -> DataFrame:
    """Hits of each key (_doc, _hash) for items of any size: pieces meet in an equi-join, pairs are
    verified after it.  Rows of one key have one text, so it is searched once."""
    rows = keyed.dropDuplicates(KEY)

    def cut(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = word_hashes(words_of(text))
                if len(h):
                    rolling = Rolling(h)
                    for a, n in pieces_of(len(h), len(h) // words_per_edit):
                        out.append((item, n, int(rolling.of(np.array([a]), np.array([a + n])).view(np.int64)[0])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64()))],
                ["item_id", "length", "piece"],
            )

    pieces = items.mapInArrow(cut, "item_id long, length int, piece long")
    lengths = sorted(r["length"] for r in pieces.select("length").distinct().collect())

    def scan(batches):
        for batch in batches:
            for doc, fp, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                h = word_hashes(words_of(text))
                rolling = Rolling(h) if len(h) else None
                for n in lengths:
                    if len(h) >= n:
                        at = np.arange(len(h) - n + 1)
                        keys = np.unique(rolling.of(at, at + n)).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keys), doc)), pa.array(np.full(len(keys), fp)),
                             pa.array(np.full(len(keys), n, np.int32)), pa.array(keys)],
                            [*KEY, "length", "piece"])

    hits = (
        rows.mapInArrow(scan, "_doc long, _hash long, length int, piece long")
        .join(pieces, ["length", "piece"]).select(*KEY, "item_id").distinct()
    )
    met = hits.join(rows, KEY).join(items.withColumnRenamed("text", "item"), "item_id").select(
        *KEY, "text", "item_id", "item")

    def check(batches):
        for batch in batches:
            found = []
            for doc, fp, text, item_id, item in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                known, h = Items([(0, words_of(item))], words_per_edit), word_hashes(words_of(text))
                for _, places in known.candidates(h).items():
                    hit = known.verify(h, 0, places)
                    if hit:
                        found.append((doc, fp, item_id, *hit))
            yield _rows(found, {**KEYED, **HIT})

    near = met.mapInArrow(check, f"_doc long, _hash long, {HITS.removeprefix('doc_id long, ')}")
    best = F.min(F.struct("distance", "first_word", "last_word")).alias("b")
    return near.groupBy(*KEY, "item_id").agg(best).select(*KEY, "item_id", "b.*")
