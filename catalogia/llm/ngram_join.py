"""N-gram Jaccard self-join with prefix filters under several global token orders.

Two sets of Jaccard similarity t or more share a token among the first few tokens of both under
any global order, and in fact a number of them that follows from their sizes.  Sets are put in
order twice, by two independent hash orders inside levels of corpus frequency (rare first).  Sets
meet where they share a prefix token of the first order; before a pair is named at all, its sizes
and the count that the second order demands must fit, the latter by signatures of the second
prefix that never turn a similar pair away, as does a signature of the whole set.

Equal sets are one class from the start; pairs are verified whole and components merged by rounds.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from catalogia.llm.common import NO_ID, OUTPUT_ROWS, Rolling, join_counted, keyed_texts, mixed, stored, word_chunks
from catalogia.llm.similar_classes import (
    Parities, apart_bits, everywhere, fitting_bits, fixed_width, may_overlap, parity, similar_labels, size_fits, texts_of,
)

SHINGLE = 5
PERCENT = 80
ORDERS = (1, 2)
# Bits of the signature of a set's second prefix.
SIGNATURE_BITS = 256
# Cells of the frequency sketch: its size, and that of its broadcast (a byte a cell), is fixed.
CELLS = 1 << 24
SLICES = 64
# Bytes of UTF-8 text with A-Z lower-cased.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MERGE_PARTS = 16


def shingle_sets(texts: Iterable[str | bytes | None], shingle: int = SHINGLE):
    """Yield the sorted distinct shingle hashes of each text; texts below ``shingle`` words are one shingle."""
    lowered = ((t.encode() if isinstance(t, str) else t).translate(LOWER) if t else None for t in texts)
    for _, bounds, hashes in word_chunks(lowered):
        at = np.arange(max(0, len(hashes) - shingle + 1))
        made = Rolling(hashes).of(at, at + shingle)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= shingle:
                yield np.unique(made[a:b - shingle + 1])
            elif b > a:
                whole = np.full(1, b - a, np.uint64)
                for h in hashes[a:b]:
                    whole = mixed(whole * np.uint64(31) + h, 4)
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63) if len(tokens) else 0


def _sketch(batches):
    counts, held, size = np.zeros(CELLS, np.uint32), [], 0

    def count():
        cells, n = np.unique(np.concatenate(held) & np.uint64(CELLS - 1), return_counts=True)
        counts[cells.astype(np.int64)] += n.astype(np.uint32)

    for batch in batches:
        for tokens in shingle_sets(batch.column(0).to_pylist()):
            held.append(tokens)
            size += len(tokens)
            if size >= OUTPUT_ROWS:
                count()
                held, size = [], 0
    if held:
        count()
    if counts.any():
        yield from _slices(dict(enumerate(counts.reshape(SLICES, -1))))


def _slices(found: dict[int, np.ndarray]):
    packer = zstandard.ZstdCompressor(level=1)
    for i, part in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([packer.compress(_planes(part))], pa.binary())],
            ["slice", "counts"])


def _planes(counts: np.ndarray) -> bytes:
    """Counts as planes of one bit of each, which take far less room than numbers that are mostly small."""
    return b"".join(np.packbits((counts >> np.uint32(k)) & np.uint32(1) != 0).tobytes() for k in range(int(counts.max()).bit_length()))


def _counts_in(data: bytes, cells: int = CELLS // SLICES) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(-1, -(-cells // 8))
    counts = np.zeros(cells, np.uint32)
    for k, plane in enumerate(planes):
        counts |= np.unpackbits(plane, count=cells).astype(np.uint32) << np.uint32(k)
    return counts


def _merge(batches):
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            part = _counts_in(data)
            found[i] = found[i] + part if i in found else part
    yield from _slices(found)


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """Level of each sketch cell: 0 up to twice the mean count, then one more per doubling.

    Counted over all shingles of all documents and merged in two distributed steps; at most
    four bytes a cell come back whatever the corpus.
    """
    kind = "slice int, counts binary"
    parts = docs.select("text").mapInArrow(_sketch, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))
    merged = parts.repartition("slice", "salt").select("slice", "counts").mapInArrow(_merge, kind)
    found = merged.repartition("slice").mapInArrow(_merge, kind).collect()
    counts = [_counts_in(row["counts"]) for row in found]
    mean = max(1.0, sum(int(c.sum(dtype=np.int64)) for c in counts) / CELLS)
    levels = np.zeros((SLICES, CELLS // SLICES), np.uint8)
    for row, c in zip(found, counts, strict=True):
        levels[row["slice"]] = np.clip(np.floor(np.log2(np.maximum(c, 1) / mean)), 0, 60)
    return levels.reshape(-1)


def prefix_length(n: int) -> int:
    """Tokens of a set of n of which one is shared, at least, with any set similar enough."""
    return n - -(-PERCENT * n // 100) + 1


def prefixes(tokens: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
    """Tokens of the prefix under each order."""
    p, found = prefix_length(len(tokens)), []
    level = levels[(tokens & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58)
    for order in ORDERS:
        rank = level | (mixed(tokens, order) >> np.uint64(6))
        found.append(tokens[np.argpartition(rank, p - 1)[:p]] if p < len(tokens) else tokens)
    return found


def shared_needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Least number of prefix tokens that sets of n and m tokens share, if they are similar enough.

    With an overlap of at least o, a prefix that is l - 1 tokens longer than the one for o must
    show l common ones; l is how far the fixed prefix exceeds that of the pair's overlap.
    """
    least = -(-PERCENT * (n + m) // (100 + PERCENT))
    own = np.minimum(least + PERCENT * n // -100, least + PERCENT * m // -100) + 1
    return np.maximum(1, own)


def pair_filters(table: pa.Table):
    """The filter of pairs that share a prefix token of the first order: sizes, the count of common
    prefix tokens under the second order and the overlap of the whole sets, the last two as far as
    the signatures tell.  No similar pair is turned away."""
    sizes = table.column("n").to_numpy().astype(np.int64)
    second = fixed_width(table.column("second").chunk(0), SIGNATURE_BITS // 8).view(np.uint64)
    whole = Parities(table.column("whole").chunk(0))

    def passes(left, right):
        n, m = sizes[left], sizes[right]
        ok = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
        at = np.flatnonzero(ok)
        left, right, n, m = left[at], right[at], n[at], m[at]
        common = prefix_length(n) + prefix_length(m) - apart_bits(second, left, right) >= 2 * shared_needed(n, m)
        ok[at] = common
        at, left, right, n, m = at[common], left[common], right[common], n[common], m[common]
        ok[at] = may_overlap(whole.apart(left, right), n, m, PERCENT)
        return ok

    return passes, everywhere


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs`` (doc_id, text).

    A set holds the distinct 5-word shingles of the text, A-Z lower-cased (a shorter text is one
    shingle); sets link at a Jaccard similarity of PERCENT or more, component_id is the least
    doc_id reachable.  Empty and null texts have empty sets and link with nothing, so each is its
    own component.  Repeated ids are rows of their own with equal components where their texts
    link; null ids are kept and stay out of the least; other columns are ignored.
    """
    members, named = _labelled(docs)
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    answer = stored(named.join(least, "label").select("fp", "copies", "component_id"))
    linked = join_counted(members.filter("n > 0"), answer, ["fp"], "doc_id", n="copies")
    alone = members.filter("n = 0").withColumn("component_id", F.col("known"))
    wanted = [F.col("known").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*wanted).unionByName(alone.select(*wanted))


def component_firsts(docs: DataFrame) -> DataFrame:
    """doc_id (null: NO_ID), text_hash, alone: the rows that stand for the components of ``docs``.

    Of a component it is the key of its least id (null ids last), then of the least text hash.
    Rows with empty sets, ``alone``, stand for themselves.  The keys are distinct.
    """
    members, named = _labelled(docs)
    firsts = named.groupBy("label").agg(F.min("first").alias("first")).select(
        "first.doc_id", "first.text_hash", F.lit(False).alias("alone"))
    empty = members.filter("n = 0").select("doc_id", "text_hash", F.lit(True).alias("alone")).distinct()
    return firsts.unionByName(empty)


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the fingerprints of their sets, and classes of equal sets with their component's label."""
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs))
    kind = "doc_id long, text_hash long, fp long, n long, second binary, whole binary, tokens array<long>"

    def describe(batches):
        seen = set()
        for batch in batches:
            for rows in _described(batch, levels.value, seen):
                yield rows

    described = stored(keyed_texts(docs).mapInArrow(describe, kind))
    members = described.select("doc_id", "text_hash", "fp", "n").withColumn("known", F.nullif("doc_id", F.lit(NO_ID)))
    classes = stored(described.withColumn("known", F.nullif("doc_id", F.lit(NO_ID))).filter("n > 0").groupBy("fp").agg(
        F.min("known").alias("doc_id"), F.min(F.struct("doc_id", "text_hash")).alias("rep"),
        F.min(F.struct(F.col("known").isNull().alias("last"), "doc_id", "text_hash")).alias("first"), F.max("n").alias("n"),
        F.max("second").alias("second"), F.max("whole").alias("whole"), F.count(F.lit(1)).alias("copies")))

    posted = described.filter("tokens is not null").select(F.explode("tokens").alias("key"), "fp", F.col("n").cast("int").alias("n"))
    postings = stored(size_fits(posted, PERCENT))
    texts = texts_of(docs, classes, postings)
    details = classes.select("fp", "n", "second", "whole")
    labels = similar_labels(postings, details, texts, pair_filters, shingle_sets, PERCENT)
    named = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "doc_id", "first", "copies", F.coalesce("label", "fp").alias("label"))
    return members, named


def _described(batch: pa.RecordBatch, levels: np.ndarray, seen: set[int]):
    """Rows of a batch with fingerprint and size; the first row of a set in a task has its prefix, too.

    Tokens are those of the prefix under the first order; signatures are those of the prefix under
    the second order and of the whole set.
    """
    held, size, at = [], 0, 0

    def rows():
        fps, sizes, seconds, wholes, tokens = zip(*held, strict=True)
        part = batch.slice(at, len(held))
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(seconds, pa.binary()), pa.array(wholes, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "fp", "n", "second", "whole", "tokens"])

    for tokens in shingle_sets(batch.column(2).to_pylist()):
        fp, second, whole, first = set_id(tokens), None, None, None
        if len(tokens) and fp not in seen:
            seen.add(fp)
            first, second = prefixes(tokens, levels)
            second, whole = parity(second, SIGNATURE_BITS).tobytes(), parity(tokens, fitting_bits(len(tokens))).tobytes()
            first = first.view(np.int64)
            size += len(first)
        held.append((fp, len(tokens), second, whole, first))
        if size >= OUTPUT_ROWS:
            yield rows()
            at += len(held)
            held, size = [], 0
    if held:
        yield rows()
