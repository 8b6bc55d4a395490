"""Substring dedup by relative Lempel-Ziv factors over content-defined reference blocks.

Every window of WINDOW words belongs to its least GRAM-word hash (the leftmost of equals), so
equal windows have equal owners.  Neighbouring windows of one owner form a block; the blocks of
all documents are the reference, indexed by their owner and their content.  A document is parsed
greedily into blocks that the index knows from elsewhere: their windows are duplicates as they
stand, and runs of them are long factors.  Where a factor ends, a block is known only by its owner:
there, at the factor boundaries, windows are compared one by one.

Only blocks (about one per 15 words) are shuffled, window hashes only around factor boundaries.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from catalogia.llm.common import (
    NO_ID, OUTPUT_ROWS, Rolling, join_counted, keyed_texts, packed_texts, stored, word_chunks,
)

WINDOW = 35
GRAM = 8
RUNS = "doc_id long, fp long, gram long, block long, start int, n int"
KEY = ["doc_id", "fp"]


def leftmost_min(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the leftmost least value in each stretch of ``span`` values."""
    at, width = np.arange(len(values)), 1

    def better(left, right):
        return np.where(values[right] < values[left], right, left)

    while 2 * width <= span:
        at = better(at[:-width], at[width:])
        width *= 2
    rest = span - width
    return better(at[:len(at) - rest], at[rest:]) if rest else at


def blocks_of(hashes: np.ndarray, bounds: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(document, gram hash, block hash, first window, windows) of each block of a chunk.

    A block hash covers all words of its windows; windows never cross documents.
    """
    n = len(hashes)
    if n < window:
        return [np.zeros(0, np.int64)] * 5
    rolling, starts = Rolling(hashes), np.arange(n - gram + 1)
    grams = rolling.of(starts, starts + gram)
    owner = leftmost_min(grams, window - gram + 1)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    if not len(inside):
        return [np.zeros(0, np.int64)] * 5
    owners = owner[inside]
    new = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    first, last = inside[new], inside[np.append(new[1:], len(inside)) - 1]
    block = rolling.of(first, last + window)
    return doc[first], grams[owners[new]], block, first - bounds[doc[first]], last - first + 1


def _runs(batches):
    for batch in batches:
        ids, fps = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        texts = (t.encode() if t else None for t in batch.column(2).to_pylist())
        for base, bounds, hashes in word_chunks(texts):
            doc, gram, block, start, n = blocks_of(hashes, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[base + doc]), pa.array(fps[base + doc]), pa.array(gram.view(np.int64)),
                 pa.array(block.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                ["doc_id", "fp", "gram", "block", "start", "n"],
            )


def _windows(batches):
    """Hash of each window of the listed blocks of a document."""
    unpack, held, size = zstandard.ZstdDecompressor(), [], 0

    def rows():
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["doc_id", "fp", "gram", "window", "start"])

    for batch in batches:
        for doc, fp, packed, blocks in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            for _, _, hashes in word_chunks([unpack.decompress(packed)]):
                first, n = np.array([b["start"] for b in blocks]), np.array([b["n"] for b in blocks])
                # Windows first, first + 1, .. of each block, all blocks in one array.
                at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                gram = np.repeat(np.array([b["gram"] for b in blocks]), n)
                found = Rolling(hashes).of(at, at + WINDOW).view(np.int64)
                held.append((np.full(len(at), doc), np.full(len(at), fp), gram, found, at.astype(np.int32)))
                size += len(at)
            if size >= OUTPUT_ROWS:
                yield rows()
                held, size = [], 0
    if held:
        yield rows()


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """doc_id, fp, start, n, reference: ``n`` windows from word ``start`` on that also start elsewhere.

    ``reference`` is the least document with the same block, null at factor boundaries.
    """
    return _spans(keyed_texts(docs, "fp"))


def _spans(keyed: DataFrame) -> DataFrame:
    runs = stored(keyed.mapInArrow(_runs, RUNS))
    shared = stored(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"))
    near = stored(join_counted(runs, shared, ["gram"], ["doc_id", "start"], n="met").drop("met"))
    blocks = stored(near.groupBy("gram", "block").agg(
        F.count(F.lit(1)).alias("met"), F.min(F.struct("doc_id", "fp", "start", "n")).alias("first")
    ))
    known = join_counted(near, blocks.select("gram", "block", "met", F.col("first.doc_id").alias("reference")),
                         ["gram", "block"], ["doc_id", "start"], n="met")
    factors = known.filter("met > 1").select(*KEY, "start", "n", "reference")
    # Owners with several contents: one block of each content stands for all of its copies.
    several = stored(blocks.groupBy("gram").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1"))
    edges = join_counted(blocks, several, ["gram"], "block", n="contents").select("gram", "first.*")
    listed = edges.groupBy(*KEY).agg(F.collect_list(F.struct("gram", "start", "n")).alias("blocks"))
    windows = stored(
        packed_texts(keyed, *KEY).dropDuplicates(KEY).join(listed, KEY)
        .mapInArrow(_windows, "doc_id long, fp long, gram long, window long, start int")
    )
    repeated = stored(
        windows.groupBy("gram", "window").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    )
    ends = join_counted(windows, repeated, ["gram", "window"], ["doc_id", "start"], n="met").select(
        *KEY, "start", F.lit(1).alias("n"), F.lit(None).cast("long").alias("reference"))
    return factors.unionByName(ends)


def covered_words(n_words: int, spans: list[tuple[int, int]], window: int = WINDOW) -> np.ndarray:
    """Which words stand in a window of one of the spans (first window, number of windows)."""
    step = np.zeros(n_words + 1, np.int64)
    for start, n in spans:
        step[start] += 1
        step[start + n - 1 + window] -= 1
    return np.cumsum(step)[:-1] > 0


def remove_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, kept_text, n_words, n_removed, kept_sha256 of each row of ``docs``.

    Words are runs without ASCII white space, unchanged; each word of a window of WINDOW words
    that also starts anywhere else in the table (same document included) is removed, all windows
    being judged on the input.  Kept words are joined by one blank.  A null or empty text has no
    words; texts below WINDOW words lose none; repeated rows are copies of each other like any
    others; other columns are ignored.
    """
    keyed = keyed_texts(docs, "fp")
    spans = _spans(keyed).groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, spans_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = unpack.decompress(packed).split()
                kept = words
                if spans_:
                    gone = covered_words(len(words), [(s["start"], s["n"]) for s in spans_])
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                text = b" ".join(kept)
                rows.append((text.decode(), len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest()))
            texts, counts, removed, digests = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "kept_text", "n_words", "n_removed", "kept_sha256"],
            )

    joined = packed_texts(keyed, *KEY).join(spans, KEY, "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(
        run, "doc_id long, kept_text string, n_words long, n_removed long, kept_sha256 string"
    ).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
