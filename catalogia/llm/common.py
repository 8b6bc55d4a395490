"""Shared pieces: tables, stored intermediate results, hot-key joins, numbering, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# A key is hot from this many rows, or from one part in HOT_SHARE of all rows if that is more;
# so there are at most HOT_SHARE hot keys whatever the data, which bounds their broadcast.
HOT_ROWS = 10_000
HOT_SHARE = 20_000
# Rows that one numbering task sorts.
CELL_ROWS = 100_000
# Words handled at once inside a task; a longer document is handled alone.
CHUNK_WORDS = 150_000
# Fixed odd multiplier of the rolling word hash (64 bits) and its inverse.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Rows of one Arrow batch that a task emits.
OUTPUT_ROWS = 200_000
# Characters of text in one Arrow batch that a task emits; a longer text is alone in its batch.
OUTPUT_CHARS = 8_000_000
# Bytes of one Arrow batch that a Python worker is given (a longer row is alone in its batch): what executor and
# worker hold of a batch, several times over, must not grow with the length of the texts.
BATCH_BYTES = 4 * 1024 * 1024
# Stands for a null id where rows are joined by id.
NO_ID = -(1 << 63)

_scratch: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers of this session get batches of BATCH_BYTES at most."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one that the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _scratch.setdefault(app, tempfile.mkdtemp(prefix="catalogia-scratch-"))
    return f"{base.rstrip('/')}/catalogia-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives executors."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, index: DataFrame, on: list[str], spread: str | list[str], n: str = "n") -> DataFrame:
    """Inner join with an index of which column ``n`` tells how many rows have its key.

    Hot keys (see HOT_SHARE) go to as many tasks as they need: their rows get a salt from
    ``spread`` (columns that tell the rows of a key apart) and their index row is repeated once per salt.  ``index`` is read three times:
    give a stored one.
    """
    total = index.agg(F.sum(n).alias("rows")).first()["rows"] or 0
    limit = max(HOT_ROWS, total // HOT_SHARE)
    parts = F.ceil(F.col(n) / limit).cast("int")
    hot = index.filter(F.col(n) > limit).select(*on, parts.alias("_parts"))
    salted = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_parts").isNull(), 0).otherwise(
            F.pmod(F.xxhash64(*([spread] if isinstance(spread, str) else spread)), F.col("_parts")).cast("int"))
    ).drop("_parts")
    repeated = index.withColumn(
        "_salt", F.explode(F.when(F.col(n) > limit, F.sequence(F.lit(0), parts - 1))
                           .otherwise(F.array(F.lit(0))))
    )
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")


def numbered(df: DataFrame, by: str, order: str, name: str) -> DataFrame:
    """0-based gapless number of each row within ``by``; no task sorts a whole group.

    Rows are dealt to cells by a hash of ``order``; the number is the cell's offset plus the
    place inside the cell, so it is dense but does not follow ``order`` across cells.  ``order``
    must be unique within ``by``.  ``df`` is read three times: give a stored one.
    """
    cells = max(1, -(-df.count() // CELL_ROWS))
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(order), F.lit(cells)).cast("int"))
    before = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    place = F.row_number().over(Window.partitionBy(by, "_cell").orderBy(order)) - 1
    return (
        dealt.withColumn("_place", place).join(offsets, [by, "_cell"])
        .withColumn(name, (F.col("_offset") + F.col("_place")).cast("long"))
        .drop("_cell", "_place", "_offset")
    )


def keyed_texts(docs: DataFrame, name: str = "text_hash") -> DataFrame:
    """doc_id (null: NO_ID), the text's hash and the text; the two tell rows of one id apart."""
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias(name), "text",
    )


def packed_texts(keyed: DataFrame, first: str, second: str) -> DataFrame:
    """Two key columns and ``packed``: texts compressed before they are shuffled (null: empty)."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [pack.compress((t or "").encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary())], [first, second, "packed"])

    return keyed.select(first, second, "text").mapInArrow(run, f"{first} long, {second} long, packed binary")


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser that spreads 64-bit values; one permutation per seed."""
    x = x ^ np.uint64((seed * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)


def word_chunks(texts: Iterable[bytes | None], lower: bool = False):
    """Yield (first document, bounds, hashes): documents of a batch in chunks of bounded size.

    Words are maximal runs without ASCII white space; document ``first + i`` has the hashes
    ``bounds[i]:bounds[i + 1]``.  A null text has no words.  Strings are refused: they would be
    split at other places than their bytes.
    """
    first, bounds, parts, size = 0, [0], [], 0
    for i, text in enumerate(texts):
        if isinstance(text, str):
            raise TypeError("words are cut in UTF-8 bytes")
        words = ((text.lower() if lower else text).split()) if text else []
        if size and size + len(words) > CHUNK_WORDS:
            yield first, np.array(bounds), np.concatenate(parts)
            first, bounds, parts, size = i, [0], [], 0
        parts.append(word_hashes(words))
        size += len(words)
        bounds.append(size)
    if len(bounds) > 1:
        yield first, np.array(bounds), np.concatenate(parts)


class Rolling:
    """Hash of any stretch of a word-hash array, from prefix sums modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        powers = np.full(len(hashes) + 1, BASE)
        powers[0] = 1
        inverse = np.full(len(hashes) + 1, BASE_INVERSE)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * np.cumprod(powers)[:-1], out=sums[1:])
        self.sums = sums

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of words starts:ends; the length is part of it."""
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
