"""Near-duplicate classes by SetSketch registers.

A register holds a truncated minimum: of the exponential variates that the shingles of a text draw
for it, the least one, on an exponentially spaced scale.  Registers of two texts agree the oftener
the more similar the texts are, and the registers of a union are the greater ones of its parts.
Bands of registers bring similar sets together; the similarity of a pair is estimated jointly from
the counts of greater, equal and lesser registers by maximum likelihood, and only pairs that may
reach the threshold are verified on their full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from catalogia.llm.common import NO_ID, join_counted, keyed_texts, mixed, stored
from catalogia.llm.ngram_join import set_id, shingle_sets
from catalogia.llm.similar_classes import apart_bits, fixed_width, may_overlap, parity, similar_labels, size_fits, texts_of

SHINGLE = 2
PERCENT = 80
# Registers, the spacing of their scale, the rate of the variates, and the greatest register: one
# byte each holds sets of 1 to 10**9 shingles far from both ends.
REGISTERS = 160
BASE = 1.2
RATE = 20.0
TOP = 255
# Registers of a band: a pair at the threshold agrees on one of the 32 bands but for 6 in 10**7.
BAND = 5
BANDS = REGISTERS // BAND
BAND_BITS = BANDS.bit_length() - 1
# Estimates have a standard deviation of about 0.03; this is five of them below the threshold.
LEAST_ESTIMATE = 0.65
# Bits of a set's parity, which tells near misses from links before any text is fetched.
PARITY_BITS = 512

_I = np.arange(1, REGISTERS + 1, dtype=np.uint64)
_FLIP, _FACTOR = mixed(_I, 21), mixed(_I, 22) | np.uint64(1)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (one row per set) of sets of at least one hash."""
    bounds = np.cumsum([0, *map(len, sets)])
    hashes = np.concatenate(sets)
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((hashes ^ _FLIP[i]) * _FACTOR[i], bounds[:-1])
    uniform = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    variates = -np.log1p(-np.minimum(uniform, 1 - 2.0 ** -53)) / RATE
    return np.clip(1 + np.floor(-np.log(variates) / np.log(BASE)), 0, TOP).astype(np.uint8)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _odds(x):
    """Probability that a register is greater by the share x of the elements, and its derivative."""
    lost = (BASE - 1) / BASE
    return -np.log1p(-x * lost) / np.log(BASE), lost / (1 - x * lost) / np.log(BASE)


def slope(above, below, n, m, similarity):
    """Derivative of the joint log-likelihood at a similarity, for sets of n and m elements of which
    the first has ``above`` registers greater and ``below`` lesser; the likelihood is concave."""
    u, v = n / (n + m), m / (n + m)
    first, first_slope = _odds(np.maximum(u - v * similarity, 1e-12))
    second, second_slope = _odds(np.maximum(v - u * similarity, 1e-12))
    equal = REGISTERS - above - below
    return (
        -above * v * first_slope / first - below * u * second_slope / second
        + equal * (v * first_slope + u * second_slope) / (1 - first - second)
    )


def estimate(a: np.ndarray, b: np.ndarray, n: int, m: int) -> float:
    """Jaccard similarity of greatest joint likelihood, given the registers and sizes of two sets."""
    above, below = int((a > b).sum()), int((a < b).sum())
    low, high = 0.0, min(n, m) / max(n, m)
    if slope(above, below, n, m, high - 1e-9) >= 0:
        return high
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(above, below, n, m, middle) >= 0 else (low, middle)
    return low


def pair_filters(table: pa.Table):
    """The filter of pairs that share a band: sizes fit, the joint estimate is near the threshold and
    the parity of the sets does not speak against it.  A pair is named under its first common band."""
    sizes = table.column("n").to_numpy().astype(np.int64)
    registers = fixed_width(table.column("registers").chunk(0), REGISTERS)
    parities = fixed_width(table.column("parities").chunk(0), PARITY_BITS // 8).view(np.uint64)
    band = table.column("key").to_numpy() & (BANDS - 1)

    def passes(left, right):
        n, m = sizes[left], sizes[right]
        ok = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
        at = np.flatnonzero(ok)
        ok[at] = may_overlap(apart_bits(parities, left[at], right[at]), n[at], m[at], PERCENT)
        at = np.flatnonzero(ok)
        for some in np.array_split(at, len(at) // 50_000 + 1):
            a, b = registers[left[some]], registers[right[some]]
            above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
            ok[some] = slope(above, below, n[some], m[some], LEAST_ESTIMATE) >= 0
        return ok

    def first_band(left, right):
        if not len(left):
            return np.zeros(0, bool)
        common = (registers[left] == registers[right]).reshape(len(left), -1, BAND).all(axis=2)
        return common.argmax(axis=1) == band[right]

    return passes, first_band


def two_word_sets(texts):
    return shingle_sets(texts, SHINGLE)


def _describe(batches):
    """Rows with fingerprint and size; the first row of a set in a task has its registers, too."""
    seen: set[int] = set()
    for batch in batches:
        fps, sizes, held, places = [], [], [], []
        registers: list[bytes | None] = [None] * batch.num_rows
        parities: list[bytes | None] = [None] * batch.num_rows

        def fill():
            for place, row in zip(places, sketch(held), strict=True):
                registers[place] = row.tobytes()
            held.clear()
            places.clear()

        size = 0
        for i, shingles in enumerate(two_word_sets(batch.column(2).to_pylist())):
            fps.append(set_id(shingles))
            sizes.append(len(shingles))
            if len(shingles) and fps[-1] not in seen:
                seen.add(fps[-1])
                parities[i] = parity(shingles, PARITY_BITS).tobytes()
                held.append(shingles)
                places.append(i)
                size += len(shingles)
                # What the registers read again and again should stay near the processor.
                if size >= 100_000:
                    fill()
                    size = 0
        if held:
            fill()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(registers, pa.binary()), pa.array(parities, pa.binary())],
            ["doc_id", "text_hash", "fp", "n", "registers", "parities"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``docs`` (doc_id, text).

    A set holds the distinct 2-word shingles of the text, A-Z lower-cased (a shorter text is one
    shingle); sets link at a Jaccard similarity of PERCENT or more, found by bands of registers
    and confirmed on the full sets; component_id is the least doc_id reachable and ``kept`` marks
    its rows.  Empty and null texts have empty sets and link with nothing.  Equal sets are one
    class from the start.  Repeated ids are rows of their own; a row without an id is kept out of
    the least, and its ``kept`` is null where no row of its component has an id.  Other columns
    are ignored; an empty table gives no rows.
    """
    described = stored(keyed_texts(docs).mapInArrow(
        _describe, "doc_id long, text_hash long, fp long, n long, registers binary, parities binary"))
    members = described.drop("registers", "parities").withColumn("known", F.nullif("doc_id", F.lit(NO_ID)))
    classes = stored(described.filter("n > 0").groupBy("fp").agg(
        F.min(F.nullif("doc_id", F.lit(NO_ID))).alias("doc_id"), F.min(F.struct("doc_id", "text_hash")).alias("rep"),
        F.max("n").alias("n"), F.max("registers").alias("registers"), F.max("parities").alias("parities"), F.count(F.lit(1)).alias("copies")))
    # The last five bits of a key say which band it is of.
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    bands = classes.select("fp", F.col("n").cast("int").alias("n"), F.explode(F.transform(numbers, lambda i: F.shiftleft(F.shiftright(F.xxhash64(
        F.call_function("substring", "registers", i * BAND + 1, F.lit(BAND)), i), BAND_BITS), BAND_BITS).bitwiseOR(i))).alias("key"))
    postings = stored(size_fits(bands, PERCENT))
    texts = texts_of(docs, classes, postings)
    details = classes.select("fp", "n", "registers", "parities")
    labels = similar_labels(postings, details, texts, pair_filters, two_word_sets, PERCENT)
    named = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "doc_id", "copies", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    answer = stored(named.join(least, "label").select("fp", "copies", "component_id"))
    linked = join_counted(members.filter("n > 0"), answer, ["fp"], "doc_id", n="copies")
    alone = members.filter("n = 0").withColumn("component_id", F.col("known"))
    wanted = [F.col("known").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"]
    rows = linked.select(*wanted).unionByName(alone.select(*wanted))
    return rows.withColumn("kept", F.col("doc_id") == F.col("component_id"))
