"""Token-id store: blocks of raw ids with a minimal perfect hash index per block.

A store has two Parquet folders.  ``blocks``, in ascending document order, hold the raw ids of some
consecutive documents in one payload and an index from document key to its stretch: a displacement
per hash bucket makes the hash of every key of the block fall on a slot of its own, and the slot
holds the place, the key and a fingerprint of it.  ``index`` has the same kind of index from the keys
of a part of the hash space to the blocks that hold them, so a look-up reads one row of the index per
key, and the blocks that it names.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalogia.llm.common import NO_ID, OUTPUT_CHARS, mixed
from catalogia.llm.encoding import encoded_batches, encoder_of
from catalogia.llm.similar_classes import group_starts, whole_groups

# Bytes of ids after which a block is closed; a longer document has a block to itself.
BLOCK_BYTES = 256 * 1024
ROW_GROUP_BYTES = 16 * 1024 * 1024
# Displacements that are tried at once for a bucket: at first, and at most.
FIRST_TRIES, MOST_TRIES = 8, 512
# Buckets that are placed together, and the displacements that are tried for all of them.
CHUNK_BUCKETS, CHUNK_TRIES = 256, 64
# Keys of one row of the index.
INDEX_KEYS = 50_000
INDEX = "bucket long, displacements binary, fingerprints binary, places binary"
DIRECT = np.int64(1) << np.int64(40)
BLOCK = (
    "part int, block int, first_doc long, last_doc long, n_docs long, n_tokens long, before long, "
    "width int, keys binary, occurrences binary, displacements binary, fingerprints binary, "
    "places binary, payload binary"
)


def key_hash(docs: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    return mixed(mixed(docs.view(np.uint64), 11) + occurrences.astype(np.uint64), 12)


def _slots(hashes: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    spread = mixed(hashes + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 13)
    slots = (spread % np.uint64(n)).astype(np.int64)
    return np.where(displacement >= DIRECT, displacement - DIRECT, slots)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacements, slot of each hash): distinct hashes to distinct slots 0 .. n - 1.

    Large buckets are placed first, by the least displacement that hits free slots only; buckets
    of one key name their slot directly.
    """
    n = len(hashes)
    buckets = (hashes % np.uint64(max(1, n // 3))).astype(np.int64)
    displacements = np.zeros(max(1, n // 3), dtype=np.int64)
    slot, taken = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    order = np.argsort(buckets, kind="stable")
    starts = np.searchsorted(buckets[order], np.arange(len(displacements) + 1))
    sizes = np.diff(starts)
    by_size = np.argsort(-sizes, kind="stable")
    for some in _chunks_of_a_size(by_size[:int((sizes > 1).sum())], sizes):
        members = order[starts[some][:, None] + np.arange(sizes[some[0]])]
        # The first displacements of many buckets at once: those that fit now may still do so in turn.
        tried = _slots(hashes[members][:, None, :], np.arange(CHUNK_TRIES)[:, None], n)
        at = np.sort(tried, axis=2)
        fits = ~taken[at].any(axis=2) & (at[:, :, 1:] != at[:, :, :-1]).all(axis=2)
        rows, fitting = (x.tolist() for x in np.nonzero(fits))
        firsts = np.searchsorted(rows, np.arange(len(some) + 1)).tolist()
        for i, b in enumerate(some.tolist()):
            for d in fitting[firsts[i]:firsts[i + 1]]:
                chosen = tried[i, d]
                if not taken[chosen].any():
                    break
            else:
                d = _least_displacement(hashes[members[i]], taken, CHUNK_TRIES)
                chosen = _slots(hashes[members[i]], np.full(len(members[i]), d), n)
            displacements[b], slot[members[i]], taken[chosen] = d, chosen, True
    single = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~taken)[:len(single)]
    members = order[starts[single]]
    displacements[single], slot[members] = free + DIRECT, free
    return displacements, slot


def _chunks_of_a_size(buckets: np.ndarray, sizes: np.ndarray):
    """Consecutive buckets of one size, at most CHUNK_BUCKETS together."""
    ends = np.flatnonzero(np.diff(sizes[buckets])) + 1
    for run in np.split(buckets, ends) if len(buckets) else []:
        yield from (run[a:a + CHUNK_BUCKETS] for a in range(0, len(run), CHUNK_BUCKETS))


def _least_displacement(own: np.ndarray, taken: np.ndarray, d: int) -> int:
    """The least displacement from ``d`` on that hits free slots only."""
    tries = FIRST_TRIES
    while True:
        # The more slots are taken the more displacements fail: ever more are tried at once.
        at = np.sort(_slots(own, np.arange(d, d + tries)[:, None], len(taken)), axis=1)
        fits = np.flatnonzero(~taken[at].any(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1))
        if len(fits):
            return d + int(fits[0])
        d, tries = d + tries, min(4 * tries, MOST_TRIES)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, 14) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _by_slot(values: np.ndarray, slot: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[slot] = values
    return out


def _block(part: int, number: int, before: int, docs: list, seen: list, data: list[bytes], travelled: int) -> tuple:
    keys, occurrences = np.array(docs, np.int64), np.array(seen, np.int64)
    lengths = np.array([len(d) // travelled for d in data], np.int64)
    hashes = key_hash(keys, occurrences)
    displacements, slot = perfect_hash(hashes)
    places = np.stack([np.cumsum(lengths) - lengths, lengths], axis=1)
    ids = np.frombuffer(b"".join(data), f"<u{travelled}")
    width = 2 if ids.max() < 1 << 16 else 4
    return (
        part, number, docs[0], docs[-1], len(docs), len(ids), before, width,
        *(_by_slot(v, slot).tobytes() for v in (keys, occurrences)), displacements.tobytes(),
        *(_by_slot(v, slot).tobytes() for v in (_fingerprints(hashes), places)),
        ids.astype(f"<u{width}").tobytes(),
    )


def _index_row(bucket: int, docs: np.ndarray, places: np.ndarray) -> tuple:
    hashes = key_hash(docs, np.zeros(len(docs), np.int64))
    displacements, slot = perfect_hash(hashes)
    return (bucket, displacements.tobytes(), _by_slot(_fingerprints(hashes), slot).tobytes(), _by_slot(places, slot).tobytes())


def bucket_of(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(docs.view(np.uint64), 15) % np.uint64(buckets)).astype(np.int64)


def _write_index(spark: SparkSession, path: str) -> None:
    """Index rows from the keys of all blocks: per key its first and last block."""
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    n_docs = blocks.agg(F.sum("n_docs").alias("n")).first()["n"] or 0
    buckets = max(1, -(-n_docs // INDEX_KEYS))

    def keys_of(batches):
        for batch in batches:
            for part, block, keys in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                docs = np.unique(np.frombuffer(keys, np.int64))
                place = np.full(len(docs), (part << 32) + block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_of(docs, buckets)), pa.array(docs), pa.array(place)], ["bucket", "doc_id", "place"])

    spans = blocks.select("part", "block", "keys").mapInArrow(keys_of, "bucket long, doc_id long, place long").groupBy(
        "bucket", "doc_id").agg(F.min("place").alias("first"), F.max("place").alias("last"))

    def index(batches):
        for table in whole_groups(batches, ["bucket"]):
            starts = group_starts(table, ["bucket"])
            columns = [table.column(c).to_numpy() for c in ("bucket", "doc_id", "first", "last")]
            for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
                row = _index_row(int(columns[0][a]), columns[1][a:b], np.stack([c[a:b] for c in columns[2:]], axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]], pa.int64()), *(pa.array([v], pa.binary()) for v in row[1:])],
                    ["bucket", "displacements", "fingerprints", "places"])

    spans.repartitionByRange("bucket").sortWithinPartitions("bucket").mapInArrow(index, INDEX).withColumn(
        "buckets", F.lit(buckets).cast("long")).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/index")


def write_store(docs: DataFrame, tokenizer: str, path: str, block_bytes: int = BLOCK_BYTES) -> None:
    """Write the ids of all documents (and an end id each) in ascending order of doc_id.

    A null or empty text is the end id alone.  Rows of a repeated id are all kept, told apart by an
    occurrence number; rows without an id come first, under the key NO_ID that no document may have.
    Ids take two bytes where they fit.  Extra columns are ignored; an empty table makes an empty store.

    Texts are encoded where they are read; only ids travel to the range that they are written in, in two
    bytes each if the tokenizer has no more.
    """
    schema = [(f.split()[0], f.split()[1]) for f in BLOCK.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}

    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    # Where parts begin: quantiles of the ids, as many numbers as there are parts.
    cuts = [(i + 1) / parts for i in range(parts - 1)]
    found = keyed.agg(F.percentile_approx("doc_id", cuts, 100 * parts).alias("at")).first()["at"] if cuts else []
    bounds = np.array(found or [], np.int64)
    travelled = 2 if encoder_of(tokenizer).size <= 1 << 16 else 4

    def encode(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            docs_ = batch.column(0).to_numpy()
            # An id that fills several parts is dealt to all of them.
            first, last = (np.searchsorted(bounds, docs_, side) for side in ("left", "right"))
            part = pa.array((first + np.arange(len(docs_)) % (last - first + 1)).astype(np.int32))
            held, size, at = [], 0, 0

            def rows():
                n = len(held)
                return pa.RecordBatch.from_arrays(
                    [part.slice(at, n), batch.column(0).slice(at, n), pa.array(held, pa.binary())], ["part", "doc_id", "ids"])

            for one in encoded_batches(batch.column(1).to_pylist(), encoder):
                held.append(np.frombuffer(one, "<u4").astype(f"<u{travelled}").tobytes())
                size += len(one)
                if size >= OUTPUT_CHARS:
                    yield rows()
                    at, held, size = at + len(held), [], 0
            if held:
                yield rows()

    def run(batches):
        part = TaskContext.get().partitionId()
        number = before = size = 0
        docs_, seen, data, last, times = [], [], [], None, 0

        def closed():
            row = _block(part, number, before, docs_, seen, data, travelled)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kinds[t]) for v, (_, t) in zip(row, schema, strict=True)], [n for n, _ in schema]
            )

        for batch in batches:
            for doc, one in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                times = times + 1 if doc == last else 0
                last = doc
                docs_.append(doc)
                seen.append(times)
                data.append(one)
                size += 4 * (len(one) // travelled)
                if size >= 2 * block_bytes:
                    yield closed()
                    number, before = number + 1, before + size // 4
                    # Occurrences are counted inside a block, which is what its index tells apart.
                    docs_, seen, data, size, last = [], [], [], 0, None
        if docs_:
            yield closed()

    (
        keyed.mapInArrow(encode, "part int, doc_id long, ids binary").repartitionById(parts, "part")
        .sortWithinPartitions("doc_id", "ids").select("doc_id", "ids").mapInArrow(run, BLOCK)
        .write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/blocks")
    )
    _write_index(docs.sparkSession, path)


def _found(row: dict, hashes: np.ndarray) -> np.ndarray:
    """Slot of each key's hash in an index, -1 where the fingerprint says that it isn't there."""
    displacements, fingerprints = np.frombuffer(row["displacements"], np.int64), np.frombuffer(row["fingerprints"], np.uint32)
    if not len(fingerprints):
        return np.full(len(hashes), -1)
    bucket = (hashes % np.uint64(len(displacements))).astype(np.int64)
    slot = _slots(hashes, displacements[bucket], len(fingerprints))
    return np.where(fingerprints[slot] == _fingerprints(hashes), slot, -1)


class Block:
    """One block's index and ids."""

    def __init__(self, row: dict):
        self.row = row
        self.keys, self.occurrences = (np.frombuffer(row[c], np.int64) for c in ("keys", "occurrences"))
        self.places = np.frombuffer(row["places"], np.int64).reshape(-1, 2)
        self.payload, self.width = row["payload"], row["width"]

    def find(self, docs: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where the block hasn't it."""
        slot = _found(self.row, key_hash(docs, occurrences))
        if not len(self.keys):
            return slot
        same = (self.keys[slot] == docs) & (self.occurrences[slot] == occurrences)
        return np.where(same, slot, -1)

    def ids(self, slot: int) -> np.ndarray:
        start, length = self.places[slot]
        return np.frombuffer(self.payload, f"<u{self.width}", length, start * self.width)


def _rows(blocks: pa.RecordBatch):
    for row in blocks.to_pylist():
        yield row, Block(row)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, each read through its block's index.

    ``start`` counts the ids of all documents before it: those of earlier parts (a total per
    written part), of earlier blocks of the part (kept in the block) and of the block.  Rows that
    were written without an id have none here.
    """
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(earlier, F.lit(0)).alias("earlier"))

    def run(batches):
        for batch in batches:
            for row, block in _rows(batch):
                slots = block.find(block.keys, block.occurrences)
                if (slots < 0).any():
                    raise ValueError("the index of a block does not know one of its keys")
                crc = [zlib.crc32(block.ids(s).astype("<u4").tobytes()) for s in slots.tolist()]
                places = block.places[slots]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), row["part"], np.int32)), pa.array(block.keys),
                     pa.array(row["before"] + places[:, 0]), pa.array(places[:, 1].copy()), pa.array(crc, pa.int64())],
                    ["part", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    found = blocks.mapInArrow(run, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(parts, "part").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), (F.col("earlier") + F.col("inside")).alias("start"),
        "n_tokens", "ids_crc32"
    )


def blocks_of(spark: SparkSession, path: str, doc_ids: list[int]) -> list[tuple[int, int]]:
    """(part, block) of every block that the index names for the documents, ascending."""
    index = spark.read.parquet(f"{path}/index")
    head = index.select("buckets").first()
    wanted = np.array(sorted(set(doc_ids)), np.int64)
    if head is None or not len(wanted):
        return []
    of = bucket_of(wanted, head["buckets"])
    places = set()
    for row in index.filter(F.col("bucket").isin(np.unique(of).tolist())).toLocalIterator():
        docs = wanted[of == row["bucket"]]
        slots = _found(row.asDict(), key_hash(docs, np.zeros(len(docs), np.int64)))
        for first, last in np.frombuffer(row["places"], np.int64).reshape(-1, 2)[slots[slots >= 0]].tolist():
            places.add((first, last))
    if not places:
        return []
    # An id repeated over several blocks: every block from its first to its last.
    spans = [(F.col("part").cast("long") * (1 << 32) + F.col("block")).between(a, b) for a, b in places if a != b]
    found = {(a >> 32, a & 0xFFFFFFFF) for a, b in places if a == b}
    for i in range(0, len(spans), 100):
        listed = spark.read.schema(BLOCK).parquet(f"{path}/blocks").select("part", "block").filter(
            reduce(lambda x, y: x | y, spans[i:i + 100]))
        found |= {(r["part"], r["block"]) for r in listed.collect()}
    return sorted(found)


def look_up(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, ids (array<int>) of the given documents; unknown ids give no row, repeated ones a row each.

    The index names the blocks; in each a key is found by one slot, whose stored key is compared.
    """
    wanted = np.array(sorted(set(doc_ids)), np.int64)
    places = blocks_of(spark, path, doc_ids)
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    by_part: dict[int, list[int]] = {}
    for part, block in places:
        by_part.setdefault(part, []).append(block)
    named = [(F.col("part") == p) & F.col("block").isin(b) for p, b in by_part.items()]
    blocks = blocks.filter(reduce(lambda x, y: x | y, named, F.lit(False)))

    def run(batches):
        for batch in batches:
            for row, block in _rows(batch):
                own = wanted[(wanted >= row["first_doc"]) & (wanted <= row["last_doc"])]
                for k in range(row["n_docs"]):
                    slots = block.find(own, np.full(len(own), k))
                    own, slots = own[slots >= 0], slots[slots >= 0]
                    if not len(own):
                        break
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), pa.array([block.ids(s).astype(np.int32).tolist() for s in slots.tolist()],
                                                 pa.list_(pa.int32()))], ["doc_id", "ids"])

    return blocks.mapInArrow(run, "doc_id long, ids array<int>")
