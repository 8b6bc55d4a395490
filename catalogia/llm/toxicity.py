"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

The lexicon, the trees and the calibration are each learned from their own part of a bounded
sample of labelled rows; every document is then scored in one pass.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from catalogia.llm.common import stored
from catalogia.llm.encoding import encoder_of

# Labelled rows that are learned from at most: the first by a hash of their id.
SAMPLE_ROWS = 20_000
# Entries of the lexicon at most: whole words and word beginnings of these lengths.
LEXICON_SIZE = 500
STEMS = (4, 5, 6, 7)
MIN_DOCUMENTS = 3
TREES, DEPTH, STEP = 24, 3, 0.2
# Pronouns of address, and look-alikes used to hide words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
)
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
EDGES = ".,;:!?\"'()[]{}«»¿¡…-*#%&"
NEAR = 5
# Words remembered in a task at most, and what is remembered of most of them.
MEMO_WORDS = 200_000
NOTHING = (0.0, 0.0, 0.0, 0.0)
FEATURES = [
    "hits_rate", "weight_rate", "hits", "max_weight", "distinct_hits", "near_second_person",
    "second_person_rate", "upper_rate", "punct_rate", "loud_rate", "obfuscated_rate", "hidden_hits",
    "length", "distinct_rate",
]
HIDDEN = re.compile(r"[a-zà-ÿ][0-9@$!|*]+[a-zà-ÿ]|[a-zà-ÿ][0-9@$|*]|[0-9@$|*][a-zà-ÿ]")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def keys_of(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


def _count_keys(batches):
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w.strip(EDGES) for w in (text or "").lower().split()}
            (toxic if label else clean).update({k for w in words if w for k in keys_of(w)})
    keys = [k for k in toxic if toxic[k] > 0]
    yield pa.RecordBatch.from_pydict({
        "key": pa.array(keys, pa.string()), "toxic": pa.array([toxic[k] for k in keys], pa.int64()),
        "clean": pa.array([clean[k] for k in keys], pa.int64()),
    })
    rest = [k for k in clean if k not in toxic]
    yield pa.RecordBatch.from_pydict({
        "key": pa.array(rest, pa.string()), "toxic": pa.array([0] * len(rest), pa.int64()),
        "clean": pa.array([clean[k] for k in rest], pa.int64()),
    })


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings with the largest log odds among toxic texts (text, toxic)."""
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    counts = sample.select("text", "toxic").mapInArrow(_count_keys, "key string, toxic long, clean long")
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    top = (
        counts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= max(MIN_DOCUMENTS, n1 // 100))
        .withColumn("odds", odds).filter("odds > 2")
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "key").limit(LEXICON_SIZE)
    )
    return {r["key"]: r["odds"] for r in top.collect()}


class Memo(dict):
    """(weight, is address, is disguised, hit only when undisguised) of each word met; bounded."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(k, 0.0) for k in keys_of(word)), default=0.0)

    def __missing__(self, raw: str):
        if len(self) > MEMO_WORDS:
            self.clear()
        word = raw.strip(EDGES)
        weight, hidden = self.weight(word), bool(HIDDEN.search(word))
        found = 0.0
        if hidden and not weight:
            found = self.weight(word.translate(LOOKALIKES).replace("*", ""))
        out = (max(weight, found), float(word in SECOND_PERSON), float(hidden), float(found > 0))
        self[raw] = out = out if any(out) else NOTHING
        return out


def features(text: str | None, memo: Memo) -> list[float]:
    """The dense features in the order of FEATURES; an empty text gives zeros."""
    words = (text or "").lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    table = np.array(list(map(memo.__getitem__, words)))
    n, weights = len(words), table[:, 0]
    hits = np.flatnonzero(weights)
    address = np.flatnonzero(table[:, 1])
    near = 0
    if len(hits) and len(address):
        right = np.searchsorted(address, hits)
        gap = np.minimum(
            np.abs(address[np.minimum(right, len(address) - 1)] - hits),
            np.abs(address[np.maximum(right - 1, 0)] - hits),
        )
        near = int((gap <= NEAR).sum())
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    upper = ((raw >= 65) & (raw <= 90)).sum()
    punct = ((raw >= 33) & (raw <= 47) | (raw >= 58) & (raw <= 64)).sum()
    return [
        len(hits) / n, float(weights.sum()) / n, float(np.log1p(len(hits))), float(weights.max()),
        float(len({words[i].strip(EDGES) for i in hits})), near / n, len(address) / n, upper / len(raw),
        punct / len(raw), text.count("!") / len(raw), float(table[:, 2].mean()), float(table[:, 3].sum()),
        float(np.log1p(n)), len(set(words)) / n,
    ]


def with_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """``row``, a struct of the columns ``keep`` whatever their names are, and ``features`` of each row."""
    chosen = docs.select(F.struct(*[F.col(f"`{n}`") for n in keep]).alias("row"), "text")

    def run(batches):
        # What tokenization remembered in this worker is not needed beside this memory.
        encoder_of.cache_clear()
        memo = Memo(lexicon)
        for batch in batches:
            found = [features(t, memo) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["row", "features"])

    return chosen.mapInArrow(run, f"row {chosen.dtypes[0][1]}, features array<double>").withColumn(
        "vector", array_to_vector("features"))


class ToxicityModel:
    """A lexicon, trees and a calibration; without the latter two a constant score."""

    def __init__(self, lexicon, trees=None, calibration=None, constant=0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def scored(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """``row`` (the columns ``keep``), ``score`` and ``predicted`` of every row."""
        if self.trees is None:
            rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in keep]).alias("row"))
            score = F.lit(float(self.constant))
        else:
            margins = self.trees.transform(with_features(docs, self.lexicon, keep)).withColumn(
                "margin", vector_to_array("probability")[1])
            rows = self.calibration.transform(margins)
            # A little of the margin keeps an order among documents of one calibrated level.
            score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("level") + 0.02 * F.col("margin")))
        return rows.select("row", score.alias("score")).withColumn(
            "predicted", (F.col("score") >= 0.5).cast("int"))

    def drop_toxic(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the rows that are predicted toxic; columns unchanged."""
        return self.scored(docs, docs.columns).filter("predicted = 0").select("row.*")


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from at most SAMPLE_ROWS labelled rows: half for the lexicon, three tenths for the
    trees, a fifth for the calibration.

    Taken are rows of ``labels`` outside fold 0 with a non-null ``toxic``, and their texts.  Of
    several labels of one id the largest counts, of several texts each.  Where a part lacks one of
    the classes, the score is the share of toxic rows (0 without rows).
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(fold_of(F.col("doc_id")) != 0)
    chosen = (
        known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    )
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)).cast("long").alias("part"), "toxic", "text"
    ))
    lexicon = learn_lexicon(sample.filter("part < 5"))
    made = stored(
        with_features(sample.filter("part >= 5"), lexicon, ["part", "toxic"])
        .select("row.*", "features", F.col("row.toxic").cast("double").alias("label"))
    ).withColumn("vector", array_to_vector("features"))
    seen = {(r["late"], r["toxic"]): r["n"] for r in made.groupBy(
        (F.col("part") >= 8).alias("late"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(seen.get((late, t), 0) for late in (False, True) for t in (0, 1)) == 0:
        return ToxicityModel(lexicon, constant=sample.agg(F.avg("toxic").alias("s")).first()["s"] or 0.0)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", predictionCol="class", maxIter=TREES, maxDepth=DEPTH,
        stepSize=STEP, seed=7, minInstancesPerNode=5, maxBins=64,
    ).fit(made.filter("part < 8"))
    levels = trees.transform(made.filter("part >= 8")).select(
        vector_to_array("probability")[1].alias("margin"), "label")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="level").fit(levels)
    return ToxicityModel(lexicon, trees, calibration)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``, by a model fitted to its labelled rows.

    ``held_out`` marks fold 0, which is never learned from; it is false for a null id.  A null or
    empty text has all features 0 and is scored like any other.  Repeated ids are rows of their
    own, an empty table gives no rows, other columns are ignored.
    """
    held = docs.select("doc_id", "text", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"))
    scored = fit_toxicity(docs, labels).scored(held, ["doc_id", "held_out"])
    return scored.select("row.*", "score", "predicted")
