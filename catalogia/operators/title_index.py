"""A positional bigram index of titles, stored beside a catalogue, and search through it.

A window of the query's length within k edits keeps all of the query's bigrams but 2 k, each moved
by k places at most.  A search reads only the posting lists of the query's bigrams; titles are read
only where enough of them agree on a window, and only those windows are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogia import fixed_values as V
from catalogia.functions import title_lc
from catalogia.functions.nearness import code_points, near_windows
from catalogia.functions.varints import packed, unpacked
from catalogia.operators import browse
from catalogia.operators.distribution import attach
from catalogia.session import stored

PLACE = ["profile", "file_id", "ord"]
# Row groups of posting lists are small, so that a bigram's lists lie in few of them.
POSTING_BYTES = 1024 * 1024
# A block is 2 ** BLOCK_BITS titles; lists hold what a block, or a part of it of so many characters, has of a bigram.
BLOCK_BITS = 12
PART_CHARS = 1_500_000
# Both tables are written once and read seldom, so they are compressed more than tables in passing.
WRITTEN = {"mode": "overwrite", "compression": "zstd"}
# The list of this "bigram" holds the lengths of the titles.
LENGTHS = ""


def _parts(batches):
    """(block, row of the first title, titles) of runs of titles of one block."""
    block, first, held, size = None, 0, [], 0
    for batch in batches:
        for its_block, row, text in zip(*[c.to_pylist() for c in batch.columns]):
            if held and ((its_block, row) != (block, first + len(held)) or size + len(text) > PART_CHARS):
                yield block, first, held
                held, size = [], 0
            if not held:
                block, first = its_block, row
            held.append(text)
            size += len(text)
    if held:
        yield block, first, held


def _order_by_bigram(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places ``at`` ordered by the two characters there; places of one bigram keep their order."""
    letters = np.zeros(0x110000, bool)
    letters[points] = True
    # Short numbers for characters, because arrays of two bytes are sorted by radix.
    number = np.cumsum(letters, dtype=np.int32) - 1
    short = (number.astype(np.uint16) if number[-1] < 1 << 16 else number)[points]
    at = at[np.argsort(short[at + 1], kind="stable")]
    return at[np.argsort(short[at], kind="stable")]


def posting_lists(titles: list[str]) -> tuple[list[str], pa.Array]:
    """Bigrams of the titles and their lists: gaps between places in the titles put end to end."""
    lengths = np.fromiter(map(len, titles), np.int32, len(titles))
    ends, points = np.cumsum(lengths, dtype=np.int32), code_points("".join(titles))
    # A bigram does not begin with the last character of a title.
    whole = np.ones(len(points), bool)
    whole[ends[lengths > 0] - 1] = False
    at = _order_by_bigram(points, np.flatnonzero(whole).astype(np.int32))
    left, right = points[at], points[at + 1]
    lead = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))[:len(at)])
    grams = [LENGTHS, *(chr(a) + chr(b) for a, b in zip(left[lead].tolist(), right[lead].tolist()))]
    gaps = np.diff(at, prepend=np.int32(0))
    gaps[lead] = at[lead]
    data, cuts = packed(np.concatenate([lengths, gaps]))
    # The first list is that of the lengths; each list ends where the next one begins.
    offsets = np.append(0, cuts[np.append(lead, len(at)) + len(lengths) - 1]).astype(np.int32)
    return grams, pa.BinaryArray.from_buffers(
        pa.binary(), len(grams), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def write_title_index(items: DataFrame, path: str) -> None:
    """Store titles by block and row, and posting lists (bigram, block, places) by bigram.

    Rows need a place of their own (profile, file_id, ord).  Null titles count as empty.

    Items are read once: lists are made of the stored titles.  A list holds the places of a bigram in
    one block of titles, a byte or two each.  Tasks order the lists of their own titles by bigram, so no
    list moves between tasks; a search reads from each file the row groups of its bigrams.
    """
    numbered = items.select(*PLACE, title_lc().alias("title_lc"), F.monotonically_increasing_id().alias("n"))
    numbered.select(
        *PLACE, "title_lc", F.shiftright("n", BLOCK_BITS).alias("block"),
        (F.col("n") % (1 << BLOCK_BITS)).cast("int").alias("row"),
    ).write.parquet(f"{path}/titles", **WRITTEN)
    titles = items.sparkSession.read.parquet(f"{path}/titles")

    def lists(batches):
        for block, first, held in _parts(batches):
            grams, data = posting_lists(held)
            n = len(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.string()), pa.array([block] * n, pa.int64()), pa.array([first] * n, pa.int32()), data],
                ["gram", "block", "first", "places"])

    postings = titles.select("block", "row", "title_lc").mapInArrow(lists, "gram string, block long, first int, places binary")
    postings.sortWithinPartitions("gram", "block", "first").write.option(
        "parquet.block.size", POSTING_BYTES).parquet(f"{path}/postings", **WRITTEN)


def candidate_windows(spark: SparkSession, path: str, query: str, limit: int) -> DataFrame:
    """(block, row, starts): titles and window starts whose posting lists allow the query within ``limit`` edits.

    Windows that would pass the end of a title are given as its last one.
    """
    m = len(query)
    wanted: dict[str, list[int]] = {}
    for at in range(m - 1):
        wanted.setdefault(query[at:at + 2], []).append(at)
    needed = max(1, m - 1 - 2 * limit)
    # Room between titles, so that no window is near those of two titles.
    room = m + 2 * limit
    schema = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("starts", pa.list_(pa.int32()))])

    def windows(key, table):
        lists = dict(zip(table["gram"].to_pylist(), table["places"].to_pylist()))
        lengths = unpacked(lists.pop(LENGTHS))
        if sum(len(wanted[gram]) for gram in lists) < needed:
            return schema.empty_table()
        ends = np.cumsum(lengths)
        begins = ends - lengths + room * np.arange(1, len(lengths) + 1)
        counts = np.zeros(ends[-1] + room * (len(lengths) + 1), np.int32)
        for gram, places in lists.items():
            places = np.cumsum(unpacked(places))
            places += room * (np.searchsorted(ends, places, "right") + 1)
            # Each place of a bigram speaks for the windows that start near (place - its place in the query).
            for at in wanted[gram]:
                near = np.zeros(len(counts), bool)
                for moved in range(-limit, limit + 1):
                    near[places - at + moved] = True
                counts += near
        found = np.flatnonzero(counts >= needed)
        title = np.searchsorted(begins, found + (m - 2 + limit), "right") - 1
        starts = found - begins[title]
        title, starts = title[starts >= 0], starts[starts >= 0]
        starts = np.minimum(starts, np.maximum(lengths[title] - m, 0))
        fresh = (np.diff(title, prepend=-1) != 0) | (np.diff(starts, prepend=-1) != 0)
        title, starts = title[fresh], starts[fresh]
        lead = np.flatnonzero(np.diff(title, prepend=-1))
        rows = pa.array(title[lead] + key[1].as_py(), pa.int32())
        offsets = pa.array(np.append(lead, len(title)), pa.int32())
        return pa.table([
            pa.repeat(key[0], len(rows)), rows, pa.ListArray.from_arrays(offsets, pa.array(starts, pa.int32()))], schema=schema)

    postings = spark.read.parquet(f"{path}/postings")
    # Two reads, as each asks for lists that lie together.
    read = postings.filter(F.col("gram").isin(list(wanted))).unionAll(postings.filter(F.col("gram") == LENGTHS))
    return read.groupBy("block", "first").applyInArrow(windows, "block long, row int, starts array<int>")


def search_index(spark: SparkSession, path: str, query: str, tolerance: float = V.SEARCH_TOLERANCE) -> DataFrame:
    """(profile, file_id, ord, title_lc) of the titles that ``browse.title_matches`` would find.

    Queries that are too short for their tolerance to leave a bigram, and exact ones of one
    character, are looked for in the stored titles.  Only candidates meet their windows.
    """
    q = query.strip().lower()
    titles = spark.read.parquet(f"{path}/titles")
    limit = int(len(q) * tolerance)
    if len(q) < 2 or len(q) - 1 - 2 * limit < 1:
        return titles.filter(browse.matches_text(F.col("title_lc"), q, limit)).select(*PLACE, "title_lc")
    windows = stored(candidate_windows(spark, path, q, limit), "windows")
    # A bit per title says whether it is a candidate, 64 of them a word, so that the others do not move.
    words = windows.groupBy("block", F.expr("row div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, row % 64))").alias("bits"))
    marks = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("marks"))
    # Rows without a place of their own are not found.
    marked = attach(titles.dropna(subset=PLACE), marks, ["block"], ["block", "row"], "inner").filter(
        F.expr("getbit(marks[row div 64], row % 64) = 1"))
    met = marked.drop("marks").join(windows, ["block", "row"])

    @F.arrow_udf("boolean")
    def near(texts: pa.Array, starts: pa.Array) -> pa.Array:
        return pa.array(near_windows(texts.to_pylist(), q, limit, starts.to_pylist()))

    return met.filter(F.contains("title_lc", F.lit(q)) | near("title_lc", "starts")).select(*PLACE, "title_lc")
