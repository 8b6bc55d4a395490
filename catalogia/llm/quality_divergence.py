"""Quality rules: distance of a document's histograms from those of its language.

Two histograms per document - character classes and common words - are compared with the mean
histograms of all usable documents of the same language by Jensen-Shannon distance (base 2,
0 to 1).  Texts below a minimum length say too little and pass unjudged.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from catalogia.llm.common import Rolling, stored, word_hashes

# Frequent function words of the languages with a word reference of their own.
COMMON_WORDS = {
    "en": "the of and to a in is it that for on with as was by be this are from at or an he his not".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par sur avec pas au plus ou il ce".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o".split(),
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})
SPACE = "\t\n\v\f\r "
SYMBOLS = "#*$%&|<>"
EDGES = ".,;:!?\"'()[]{}«»¿¡…-#*$%&|<>"
# Least size of a judged text and largest distances of a kept one.
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.36

CLASSES = 8
STATS = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_chars long, classes array<long>, commons array<long>"
)


def _class_table() -> np.ndarray:
    """Class of each UTF-8 byte; CLASSES marks bytes inside a character."""
    kinds = np.full(256, 7, dtype=np.int64)
    for i in range(256):
        c = chr(i)
        if i >= 0xC0:
            kinds[i] = 6
        elif i >= 0x80:
            kinds[i] = CLASSES
        elif c in SPACE:
            kinds[i] = 3
        elif c.isdigit():
            kinds[i] = 2
        elif c.islower():
            kinds[i] = 0
        elif c.isupper():
            kinds[i] = 1
        elif c in ".,;:!?'\"()-":
            kinds[i] = 4
        elif c.isprintable():
            kinds[i] = 5
    return kinds


KINDS = _class_table()


def repeat_words(hashes: np.ndarray, window: int = 3) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    at = np.arange(n)
    _, inverse, counts = np.unique(Rolling(hashes).of(at, at + window), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, classes, commons."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    classes = np.bincount(KINDS[np.frombuffer(raw, dtype=np.uint8)], minlength=CLASSES + 1)[:CLASSES]
    counts = Counter(w.strip(EDGES) for w in text.lower().split())
    commons = [counts[w] for w in WORDS]
    return (
        len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeat_words(word_hashes(words)), len(text), classes.tolist(),
        [*commons, max(0, len(words) - sum(commons))],
    )


def _stats(batches):
    types = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 2
    for batch in batches:
        found = list(zip(*map(text_stats, batch.column(2).to_pylist()), strict=True)) or [[]] * 8
        arrays = [pa.array(c, t) for c, t in zip(found, types, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *arrays],
            ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "n_chars", "classes", "commons"],
        )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays that each sum to 1; null if one is null."""
    def half(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: (half(a, b) + half(b, a)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), total))


def _shares(counts: str) -> Column:
    total = F.aggregate(F.col(counts), F.lit(0).cast("long"), lambda s, x: s + x)
    return F.when(total > 0, F.transform(F.col(counts), lambda x: x / total))


def judge_quality(docs: DataFrame) -> DataFrame:
    """Base measures, both distances and the verdict of each row of ``docs`` (doc_id, text, lang).

    Words are runs without ASCII white space.  ``base_failed``: under 50 words, or over half of
    the words in repeated 3-word windows.  References are means over all documents of a language
    that do not fail and reach the minimum length; a null language is one of its own.  ``kept`` is
    false for failed rows and for judged ones beyond either limit; short texts, and languages
    without a reference, are kept.  A null or empty text has no words and fails.  Repeated ids
    are rows of their own; other columns are ignored.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    measured = stored(
        docs.select("doc_id", F.coalesce(lang, F.lit("")).alias("lang"), "text").mapInArrow(_stats, STATS)
        .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
        .withColumn("judged", F.expr(f"not base_failed and n_chars >= {MIN_CHARS} and n_words >= {MIN_WORDS}"))
    )
    shares = measured.withColumn("p", _shares("classes")).withColumn("q", _shares("commons"))

    def means(column, n):
        return F.array(*[F.avg(F.get(column, F.lit(i))) for i in range(n)])

    references = stored(shares.filter("judged").groupBy("lang").agg(
        means("p", CLASSES).alias("ref_p"), means("q", len(WORDS) + 1).alias("ref_q")
    ))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE)
    return (
        shares.join(references, "lang", "left")
        .withColumn("char_distance", F.when(F.col("judged"), js_distance(F.col("p"), F.col("ref_p"))))
        .withColumn("word_distance", F.when(F.col("judged"), js_distance(F.col("q"), F.col("ref_q"))))
        .withColumn("kept", ~F.col("base_failed") & near)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "char_distance", "word_distance")
    )
