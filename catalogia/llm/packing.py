"""Best-fit-decreasing packing of token sequences.

What best fit does depends only on how many pieces there are of each length, so the plan is made
from a histogram of at most ``capacity`` numbers, whatever the corpus.  A segment tree over
remaining capacities finds the tightest open bin in logarithmic time; equal pieces are placed in
runs.  Pieces are numbered per length without a global sort and look their place up in the plan.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catalogia.llm.common import numbered, stored
from catalogia.llm.encoding import encoded_batches, encoder_of

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """Number of open bins per remaining capacity, as a segment tree of sums."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        i = remaining + self.size
        while i:
            self.sums[i] += bins
            i //= 2

    def tightest(self, length: int) -> int | None:
        """Least remaining capacity of at least ``length`` that an open bin has."""
        i = length + self.size
        if not self.sums[i]:
            # Up to the first ancestor whose right sibling holds a bin, then down to the left.
            while i > 1 and (i & 1 or not self.sums[i + 1]):
                i //= 2
            if i == 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.sums[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Runs (length, first, items, per_bin, bin, offset) of best-fit decreasing.

    Pieces ``first .. first + items - 1`` of ``length`` fill bins from ``bin`` on, ``per_bin``
    to a bin, starting at ``offset`` in each.
    """
    tree, open_runs, plan, bins = CapacityTree(capacity), {}, [], 0

    def release(remaining, first_bin, n):
        if n and remaining:
            open_runs.setdefault(remaining, []).append((first_bin, n))
            tree.add(remaining, n)

    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, fits = capacity, capacity // length
                n = -(-left // fits)
                first_bin, bins = bins, bins + n
            else:
                # A bin takes pieces until it is too full for one more: it stays the tightest.
                fits = room // length
                first_bin, there = open_runs[room].pop()
                tree.add(room, -there)
                n = min(there, -(-left // fits))
                release(room, first_bin + n, there - n)
            items = min(left, n * fits)
            plan.append((length, placed, items, fits, first_bin, capacity - room))
            full, rest = divmod(items, fits)
            release(room - fits * length, first_bin, full)
            if rest:
                release(room - rest * length, first_bin + full, 1)
            placed, left = placed + items, left - items
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; only the first may be shorter."""
    def run(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            rows = []
            ids = encoded_batches(batch.column(1).to_pylist(), encoder)
            for doc, data in zip(batch.column(0).to_pylist(), ids, strict=True):
                n = len(data) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                rows.extend(
                    (doc, i, a, b - a, zlib.crc32(data[4 * a:4 * b]))
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                )
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length`` and an ``ident`` to tell them apart."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length: dict[int, list] = {}
    for length, *run in best_fit_plan(counts, capacity):
        by_length.setdefault(length, []).append(run)
    runs = {k: np.array(v, dtype=np.int64).T for k, v in by_length.items()}
    ranked = numbered(pieces, "length", "ident", "_rank")

    def look_up(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            where, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length).tolist():
                own = length == value
                first, _, per_bin, first_bin, base = runs[value]
                i = np.searchsorted(first, rank[own], "right") - 1
                inside = rank[own] - first[i]
                where[own] = first_bin[i] + inside // per_bin[i]
                offset[own] = base[i] + inside % per_bin[i] * value
            kept = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(where), pa.array(offset)],
                [*kept, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "_rank")
    return ranked.mapInArrow(look_up, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``.

    A document is its ids and an end id; a null or empty text is the end id alone.  Documents of
    over ``capacity`` ids are cut into full pieces, the first of which may be shorter.
    Sequences are numbered from 0, pieces of one stand without gaps from offset 0.  Repeated rows
    are packed each; a null id is kept as such; an empty table gives no rows; other columns are
    ignored.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity))
    ident = F.struct("doc_id", "piece", "ids_crc32")
    return place_pieces(pieces.withColumn("ident", F.xxhash64(ident)), capacity).drop("ident")
