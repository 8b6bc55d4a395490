"""Source divergence audit: which terms set a source apart from its language, and sources from each other.

Inside a task the texts of an Arrow batch lie in one buffer.  A pointer is kept per word start and
the pointers are sorted by what they point to: multikey quicksort with eight bytes as one key, in
which only runs of equal keys whose words go on are sorted by the next eight bytes.  Equal runs of
the sorted pointers are terms; document frequency and counts per source are read off their length
and the documents that they fall into.  Counts of all tasks are then summed.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from catalogia.llm.common import OUTPUT_ROWS, stored

# Fixed values of the audit.
MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
# UTF-8 bytes of text whose pointers are sorted together; a longer document is sorted alone.
CHUNK_BYTES = 16_000_000
# Cells of one block of terms x sources that are compared at once.
BLOCK_CELLS = 500_000

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
# Letters A-Z, a-z and every byte of a character beyond ASCII.
IN_TERM = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)

CELLS = "lang string, source string, term string, n long, docs long"


def term_pointers(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the terms in a buffer of documents, ascending; none crosses documents."""
    inside = IN_TERM[buffer]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(buffer))]
    first[bounds] = inside[bounds]
    last[bounds - 1] = inside[bounds - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def _keys(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from ``depth`` on as one big-endian number; zeros stand after a word's end."""
    # The word loads of all places of the buffer, read without a copy of it.
    loads = np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,))
    left = np.clip(lengths - depth, 0, 8).astype(np.uint64)
    keep = np.where(left > 0, ~np.uint64(0) << (np.uint64(64) - np.uint64(8) * np.maximum(left, np.uint64(1))), np.uint64(0))
    return loads[np.minimum(starts + depth, len(padded) - 8)].astype(np.uint64) & keep


def sort_pointers(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): pointers in the order of their words, ascending among equals; where a word begins."""
    padded = np.append(buffer, np.zeros(8, np.uint8))
    keys = _keys(padded, starts, lengths, 0)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = keys[1:] != keys[:-1]
    # Places in runs of several pointers whose words go on after these eight bytes.
    single = new & np.append(new[1:], True)
    open_ = np.flatnonzero(~single & ((keys & np.uint64(255)) != 0))
    depth = 8
    while len(open_):
        pointers, run = order[open_], np.cumsum(new)[open_]
        keys = _keys(padded, starts[pointers], lengths[pointers], depth)
        by = np.lexsort((keys, run))
        keys = keys[by]
        order[open_] = pointers[by]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])
        new[open_] |= fresh
        single = fresh & np.append(fresh[1:], True)
        open_ = open_[~single & ((keys & np.uint64(255)) != 0)]
        depth += 8
    return order, new


def _strings(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The pointed-to words as an Arrow array."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buffer[places].tobytes())])


def _chunks(texts: pa.Array):
    """Stretches (from, to) of an array of texts of bounded size in bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
        yield at, to
        at = to


def _count(batches):
    """Cells (lang, source, term, occurrences, documents) of the documents of a task."""
    for batch in batches:
        langs, sources, texts = (pc.fill_null(batch.column(i), "") for i in range(3))
        group = np.unique(
            np.stack([pc.dictionary_encode(c).indices.to_numpy(zero_copy_only=False) for c in (langs, sources)]),
            axis=1, return_inverse=True)[1].reshape(-1) if batch.num_rows else np.zeros(0, np.int64)
        # Documents of one group are neighbours, so equal words of one group are, too.
        by = np.argsort(group, kind="stable")
        group, langs, sources, texts = group[by], langs.take(pa.array(by)), sources.take(pa.array(by)), texts.take(pa.array(by))
        for a, b in _chunks(texts):
            # A copy has its own offsets, from 0 on.
            part = pa.concat_arrays([texts.slice(a, b - a), pa.array([], texts.type)])
            _, offsets, data = part.buffers()
            offsets = np.frombuffer(offsets, np.int32)[part.offset:part.offset + len(part) + 1].astype(np.int64)
            if offsets[-1] == offsets[0]:
                continue
            buffer = LOWER[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]]
            offsets -= offsets[0]
            starts, lengths = term_pointers(buffer, offsets)
            if not len(starts):
                continue
            order, new = sort_pointers(buffer, starts, lengths)
            doc = (np.searchsorted(offsets, starts, side="right") - 1)[order]
            of = group[a:b][doc]
            new[1:] |= of[1:] != of[:-1]
            cell = np.flatnonzero(new)
            next_doc = new.copy()
            next_doc[1:] |= doc[1:] != doc[:-1]
            n, docs = np.diff(np.append(cell, len(order))), np.add.reduceat(next_doc.astype(np.int64), cell)
            for i in range(0, len(cell), OUTPUT_ROWS):
                at = slice(i, i + OUTPUT_ROWS)
                some = order[cell[at]]
                rows = pa.array(a + doc[cell[at]])
                yield pa.RecordBatch.from_arrays(
                    [langs.take(rows), sources.take(rows), _strings(buffer, starts[some], lengths[some]),
                     pa.array(n[at]), pa.array(docs[at])], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term of every group."""
    has = set(docs.columns)
    read = [(F.col(c) if c in has else F.lit(None)).cast("string").alias(c) for c in ("lang", "source", "text")]
    return docs.select(*read).mapInArrow(_count, CELLS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), digit by digit so that nothing overflows."""
    left, whole = counts + 1, np.zeros_like(counts)
    for _ in range(3):
        left = left * 1000
        whole = whole * 1000 + left // total
        left = left % total
    return whole + 1


def _share(count: str, total: str) -> Column:
    """The same as a column."""
    scaled = f"cast({SCALE} as decimal(10, 0)) * cast({count} + 1 as decimal(19, 0))"
    return F.expr(f"1 + ({scaled}) div cast({total} as decimal(19, 0))")


def source_audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of sources inside each language.

    Part ``pair`` compares a source with each other source of its language over all kept terms,
    part ``term`` lists up to TOP_TERMS kept terms that the source uses more than its language does.
    A term is kept in a language if MIN_DOCS of its documents hold it.  Null text, language and
    source are read as empty; a group without terms still has its pairs; repeated rows and ids are
    documents of their own, no id is read; ties are ordered by the item's UTF-8 bytes; an empty
    table gives no rows; other columns are ignored.

    Part of the plan is one small record per (language, source), of which the answer has the square.
    """
    spark = docs.sparkSession
    has = set(docs.columns)
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in has else F.lit("").alias(c) for c in ("lang", "source")]
    groups = stored(docs.select(*named).distinct())
    # One row per kept term; as many cells as the language has sources, at most.
    kept = stored(term_counts(docs).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("cells")
    ).filter(F.col("docs") >= MIN_DOCS).select("lang", "term", "total", "cells"))
    cells = kept.select("lang", "term", "total", F.inline("cells"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    totals = stored(
        groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", (F.coalesce("n_group", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("of_group"),
            (F.coalesce("n_lang", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("of_lang")))
    vectors: dict[str, dict[str, int]] = {}
    for row in totals.orderBy("lang", "source").toLocalIterator():
        vectors.setdefault(row["lang"], {})[row["source"]] = row["of_group"]
    known = spark.sparkContext.broadcast(vectors)

    def compare(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            lang_of = pc.dictionary_encode(batch.column(0))
            code_of = lang_of.indices.to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            used, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), used)
            for code, lang in enumerate(lang_of.dictionary.to_pylist()):
                names, of = list(known.value[lang]), np.array(list(known.value[lang].values()), np.int64)
                terms = np.flatnonzero(code_of == code)
                found = sums.setdefault(lang, np.zeros((len(names), len(names)), np.int64))
                step = max(1, BLOCK_CELLS // len(names))
                for i in range(0, len(terms), step):
                    some = terms[i:i + step]
                    own = np.flatnonzero(np.isin(owner, some))
                    rows = pa.array(own)
                    counts = np.zeros((len(some), len(names)), np.int64)
                    at = pc.index_in(flat.field(0).take(rows), pa.array(names)).to_numpy(zero_copy_only=False)
                    counts[np.searchsorted(some, owner[own]), at] = flat.field(1).take(rows).to_numpy(zero_copy_only=False)
                    p = shares(counts, of[None, :])
                    for s in range(len(names)):
                        apart = p[:, s:s + 1] - p
                        found[s] += (apart * apart // p).sum(axis=0)
        for lang, found in sums.items():
            names = list(known.value[lang])
            for name, values in zip(names, found, strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array([name] * len(names), pa.string()),
                     pa.array(names, pa.string()), pa.array(values)], ["lang", "source", "item", "value"])

    compared = kept.select("lang", "cells").mapInArrow(
        compare, "lang string, source string, item string, value long"
    ).filter("source <> item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.join(others, "lang").filter("source <> item").join(
        compared, ["lang", "source", "item"], "left"
    ).select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    judged = cells.join(totals, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _share("n", "of_group").alias("p"), _share("total", "of_lang").alias("q")
    ).filter("p > q")
    terms = judged.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best)
    return pairs.withColumn("rank", rank).unionByName(
        terms.withColumn("rank", rank).filter(F.col("rank") <= TOP_TERMS))
