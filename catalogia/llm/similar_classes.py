"""Links between sets that share keys: candidate pairs inside the groups of a key, verified whole.

Pairs of a group are never rows.  A task goes through the groups of its keys with arrays, and each
set names at most a few earlier sets of its group that pass the operator's filter and belong to
another component.  Named pairs are verified, components merge, and the next round names more
partners, but only under keys that still have unverified ones in other components, and a bounded number
for any two components; it ends when there are none, so no link is lost.  A large group is dealt to cells of bounded size, two blocks in each.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from catalogia.llm.common import keyed_texts, packed_texts, stored
from catalogia.llm.components import components

# Sets of one block of a key's group; a cell holds two blocks at most.
BLOCK = 2000
# Pairs that are compared at once inside a task.
PAIRS = 200_000
# Partners that a set names in the first round, and the factor of each further one.
FIRST_PARTNERS, MORE_PARTNERS = 1, 64
# One in so many keys is looked at before all others.
FIRST_KEYS = 8
# Tasks that may share the neighbours of one set.
HUB_SALTS = 8

# Bits of a parity whose width follows the size of its set: at least, and at most.
LEAST_BITS, MOST_BITS = 64, 4096

# Columns of named pairs.
NAMED = ["key", "a", "b", "low", "high", "more"]

# Classes whose rows are looked for with a broadcast list (24 bytes each); above, by a shuffled join.
LISTED_CLASSES = 500_000
# (left places, right places) of pairs of a table to a boolean array.
Filter = Callable[[np.ndarray, np.ndarray], np.ndarray]
# From a table of postings: which pairs may link, and which of those this key is to name, as the
# others are named under another key.
Filters = Callable[[pa.Table], tuple[Filter, Filter]]


def everywhere(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.ones(len(left), bool)


def parity(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Parity per bit of the hashes that fall on it: two signatures differ in no more bits than the
    sets differ in hashes."""
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8))


def apart_bits(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which pairs of signatures (rows of 64-bit numbers) differ."""
    return np.bitwise_count(rows[left] ^ rows[right]).sum(axis=1, dtype=np.int64)


def fitting_bits(n: int) -> int:
    """Bits of the parity of a set of n hashes, a power of two near n: with far fewer, unlike sets
    differ in no more bits than similar ones may."""
    return min(max(1 << round(math.log2(max(n, 1))), LEAST_BITS), MOST_BITS)


class Parities:
    """Parities of ``fitting_bits`` each.  As their bits are taken by remainders, a wider one is folded to a
    narrower one by the exclusive or of its halves."""

    def __init__(self, column: pa.Array):
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        self.widths, self.folded = np.diff(offsets), {}
        width = int(self.widths.max(initial=0))
        while width:
            rows = np.zeros((len(column), width // 8), np.uint64)
            wider = self.folded.get(2 * width)
            if wider is not None:
                rows = wider[:, :width // 8] ^ wider[:, width // 8:]
            own = np.flatnonzero(self.widths == width)
            if len(own):
                data = np.frombuffer(column.buffers()[2], np.uint8)
                rows[own] = data[offsets[own][:, None] + np.arange(width)].view(np.uint64)
            self.folded[width] = rows
            width = width // 2 if width > self.widths.min() else 0

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Bits in which pairs differ, in the width of the narrower one."""
        width, apart = np.minimum(self.widths[left], self.widths[right]), np.zeros(len(left), np.int64)
        for one, rows in self.folded.items():
            at = np.flatnonzero(width == one)
            apart[at] = apart_bits(rows, left[at], right[at])
        return apart


def may_overlap(apart: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m members that differ in ``apart`` members at least may be similar enough:
    of their n + m members, 2 percent / (100 + percent) are common ones."""
    return (100 + percent) * apart <= (100 - percent) * (n + m)


def fixed_width(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of binaries of one width, as a matrix of bytes."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    first = int(offsets[column.offset])
    return np.frombuffer(column.buffers()[2], np.uint8)[first:first + width * len(column)].reshape(-1, width)


def whole_groups(batches, keys: list[str]):
    """Tables of whole groups from batches sorted by ``keys``; a table holds at least one group."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        new = group_starts(table, keys)
        last = int(new[-1])
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield held


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def partners(
    start: np.ndarray, label: np.ndarray, own: np.ndarray, across: np.ndarray, limit: int, passes: Filter,
    named_here: Filter = everywhere,
):
    """(left, right, more): the first ``limit`` earlier places of the group that each place may link to.

    ``start`` is the first place of each place's group.  Pairs of one label are left out, and those
    of one block in cells ``across`` two blocks.  ``more`` marks places that may have further ones.
    Pairs that are not ``named_here`` count, but are not returned.
    """
    place = np.arange(len(start))
    more = np.zeros(len(start), bool)

    def tested(left, right):
        ok = (label[left] != label[right]) & ~(across[right] & (own[left] == own[right]))
        at = np.flatnonzero(ok)
        ok[at] = passes(left[at], right[at])
        return ok

    found, rest = [], place[place > start]
    low = start
    if limit == 1:
        # Most sets of a group of near copies link to its first one: look there before anywhere else.
        hits = np.concatenate([tested(start[r], r) for r in np.array_split(rest, len(rest) // PAIRS + 1)]) if len(rest) else np.zeros(0, bool)
        hit = rest[hits]
        hit = hit[named_here(start[hit], hit)]
        found.append((start[hit], hit))
        more[rest[hits]] = rest[hits] > start[rest[hits]] + 1
        rest, low = rest[~hits], start + 1
    widths = rest - low[rest]
    bounds = np.searchsorted(np.cumsum(widths), np.arange(PAIRS, widths.sum() + PAIRS, PAIRS), side="left") + 1 if len(rest) else []
    at = 0
    for to in bounds:
        some, wide = rest[at:to], widths[at:to]
        at = to
        if not len(some) or not wide.sum():
            continue
        right = np.repeat(some, wide)
        left = np.arange(len(right)) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(low[some], wide)
        hit = np.flatnonzero(tested(left, right))
        left, right = left[hit], right[hit]
        rank = np.arange(len(right)) - np.searchsorted(right, right)
        more[right[rank >= limit]] = True
        left, right = left[rank < limit], right[rank < limit]
        here = named_here(left, right)
        found.append((left[here], right[here]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), more
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), more


def fewest(start: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Which of the named pairs are among the first ``limit`` of their group that join the same two labels."""
    ends = np.sort(np.stack([label[left], label[right]]), axis=0)
    keys = [right, ends[1], ends[0], start[right]]
    order = np.lexsort([left, *keys])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys[1:]:
        new[1:] |= key[order][1:] != key[order][:-1]
    firsts = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(firsts, np.diff(np.append(firsts, len(order))))
    kept = np.empty(len(order), bool)
    kept[order] = rank < limit
    return kept


def size_fits(postings: DataFrame, percent: int) -> DataFrame:
    """(key, fp) of postings (key, fp, n) that share their key with another set of a size near enough.

    In the order of sizes the nearest one is a neighbour, so no similar pair is turned away; repeated
    postings become one.
    """
    by_size = Window.partitionBy("key").orderBy("n", "fp")
    once = postings.withColumn("before", F.lag("fp").over(by_size)).filter("before is null or before <> fp").drop("before")
    less, greater = F.lag("n").over(by_size), F.lead("n").over(by_size)
    near = once.withColumn("near", F.coalesce(100 * less >= percent * F.col("n"), F.lit(False))
                           | F.coalesce(100 * F.col("n") >= percent * greater, F.lit(False)))
    return near.filter("near").select("key", "fp")


def _open_postings(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The postings, with labels, of keys under which at least two components meet."""
    named = postings.withColumn("label", F.col("fp"))
    if labels is not None:
        named = postings.drop("label").join(labels, postings["fp"] == labels["node"], "left").withColumn(
            "label", F.coalesce("label", "fp")).drop("node")
    open_keys = named.groupBy("key").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.count(F.lit(1)).alias("members")
    ).filter("first < last").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    return named.drop("blocks").join(open_keys, "key")


def _candidates(opened: DataFrame, details: DataFrame, limit: int, filters_of: Filters, first: bool) -> DataFrame:
    """(key, a, b, low, high, more) of open postings: a before b by fp, in the components ``low`` < ``high``.

    In the first round, which need not be complete, the blocks of a large group stay by themselves.
    Later ones name ``limit`` pairs of the same two components in a cell: one that links is enough.
    """
    others = F.array("own") if first else F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = opened.withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(others)).withColumns(
        {"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}
    ).drop("blocks", "other").join(details, "fp")

    def run(batches):
        for table in whole_groups(batches, ["key", "lo", "hi"]):
            table = table.combine_chunks()
            starts = group_starts(table, ["key", "lo", "hi"])
            start = np.repeat(starts, np.diff(np.append(starts, table.num_rows)))
            label, own, lo, hi, fp, key = (table.column(c).to_numpy() for c in ("label", "own", "lo", "hi", "fp", "key"))
            passes, named_here = filters_of(table)
            left, right, more = partners(
                start, label, own, lo != hi, limit, passes, everywhere if first else named_here)
            if not first:
                kept = fewest(start, label, left, right, limit)
                more[right[~kept]] = True
                left, right = left[kept], right[kept]
            ends = [np.minimum(label[left], label[right]), np.maximum(label[left], label[right])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (key[right], fp[left], fp[right], *ends, more[right])], NAMED)
            # Groups with further partners tell so even where none of those places' pairs is named here.
            silent = np.flatnonzero(more & ~np.isin(np.arange(len(more)), right))
            silent = silent[np.unique(start[silent], return_index=True)[1]]
            if len(silent):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (key[silent], fp[silent], fp[silent], label[silent], label[silent], more[silent])], NAMED)

    keys = ["key", "lo", "hi"]
    return cells.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(
        run, "key long, a long, b long, low long, high long, more boolean")


def _linked(pairs: DataFrame, texts: DataFrame, sets_of, percent: int) -> DataFrame:
    """Pairs (a, b) that really link, both sets compared whole; a's text travels once per salt."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(HUB_SALTS)).cast("int").alias("salt"))
    hubs = salted.select("a", "salt").distinct().join(texts.withColumnRenamed("fp", "a"), "a").select(
        "a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "packed")
    others = salted.join(texts.withColumnRenamed("fp", "b"), "b").select(
        "a", "salt", F.lit(1).alias("role"), "b", "packed")

    def check(batches):
        unpacker, hub, hub_id = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            a, role, b, packed = (batch.column(c) for c in ("a", "role", "b", "packed"))
            kept = []
            sets = sets_of(unpacker.decompress(p.as_py()) for p in packed)
            for x, r, y, found in zip(a.to_pylist(), role.to_pylist(), b.to_pylist(), sets, strict=True):
                if not r:
                    hub, hub_id = found, x
                    continue
                if x != hub_id:
                    raise ValueError("the text of a set did not reach its neighbours")
                both = len(np.intersect1d(hub, found, assume_unique=True))
                if 100 * both >= percent * (len(hub) + len(found) - both):
                    kept.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], ["a", "b"])

    met = hubs.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "b")
    return met.mapInArrow(check, "a long, b long")


def texts_of(docs: DataFrame, classes: DataFrame, fps: DataFrame) -> DataFrame:
    """(fp, packed), stored: a text of each listed class; classes (fp, rep) name the row to take it from."""
    wanted = stored(classes.join(fps.select("fp").distinct(), "fp").select("fp", "rep.doc_id", "rep.text_hash"))
    keyed, key, listed = keyed_texts(docs), ["doc_id", "text_hash"], wanted.count()
    if listed <= LISTED_CLASSES:
        # Only texts that are needed are packed and travel.
        keyed = keyed.join(F.broadcast(wanted.select(*key)), key, "left_semi")
        wanted = F.broadcast(wanted)
    texts = stored(packed_texts(keyed, *key).join(wanted, key).select("fp", "packed"))
    # Only rows that repeat an id and its text give a class more than one.
    return texts if texts.count() <= listed else stored(texts.dropDuplicates(["fp"]))


def similar_labels(
    postings: DataFrame, details: DataFrame, texts: DataFrame, filters_of: Filters, sets_of, percent: int,
) -> DataFrame:
    """node, label of every set that links to another; label is the least set of its component.

    ``postings`` (key, fp, ..), ``details`` (fp, and what the filters read) and ``texts`` (fp, packed)
    are stored tables; ``sets_of`` turns texts as bytes into arrays of distinct hashes.
    """
    # Groups of near copies share most of their keys: a part of the keys merges nearly all of them,
    # and of the others only keys under which components still meet are looked at.
    some = F.pmod(F.xxhash64("key"), F.lit(FIRST_KEYS)) == 0
    opened = _open_postings(postings.filter(some), None)
    links = tried = labels = None
    limit, first = FIRST_PARTNERS, True
    while True:
        found = stored(_candidates(opened, details, limit, filters_of, first))
        # A pair that is named under several keys is found again under any one of them.
        pairs = found.filter("a <> b").groupBy("a", "b", "low", "high").agg(F.min("key").alias("key"))
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        if first:
            pairs = stored(pairs.select("a", "b"))
        else:
            # Two components that meet under many keys are joined by a few pairs, or tried again.
            untried = stored(pairs)
            place = F.row_number().over(Window.partitionBy("low", "high").orderBy("a", "b"))
            ranked = stored(untried.withColumn("place", place).filter(F.col("place") <= limit + 1))
            pairs, cut = ranked.filter(F.col("place") <= limit).select("a", "b"), ranked.filter(F.col("place") > limit)
            # All pairs of the other keys have been verified.
            left = untried.select("key", "low", "high").distinct()
            again = stored(found.filter("more").select("key").union(
                left.join(cut.select("low", "high"), ["low", "high"], "left_semi").select("key")).distinct())
        tried = pairs if tried is None else tried.union(pairs)
        linked = stored(_linked(pairs, texts, sets_of, percent))
        if links is None or linked.limit(1).count():
            links = linked if links is None else links.union(linked)
            labels = components(links)
        if not first and not again.limit(1).count():
            return labels
        limit *= MORE_PARTNERS
        opened = stored(_open_postings(postings if first else opened.join(again, "key", "left_semi"), labels))
        first = False
