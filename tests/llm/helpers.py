"""Small document tables with the awkward cases, and plain versions of what operators compute."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
# Names that operators use inside.
CLASHING = ["row", "score", "predicted", "features", "fp", "gram", "block", "token", "part", "label",
            "length", "ident", "size", "shard", "spans", "n", "host", "key", "_id"]


def documents(spark, texts, clash=False):
    """Rows with ids 0, 1, ..; a pair (id, text) gives its own id."""
    rows = []
    for i, t in enumerate(texts):
        doc, text = t if isinstance(t, tuple) else (i, t)
        rows.append((doc, text, None if i % 5 == 0 else ["en", "fr"][i % 2], f"src{i % 3}" if i % 4 else None,
                     None if text is None else len(text)))
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clash:
        from pyspark.sql import functions as F
        for name in CLASHING:
            df = df.withColumn(name, F.lit("x"))
    return df


def prose(seed, words=120, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def near(text, seed, changes=1):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = f"x{r.randrange(10 ** 6)}"
    return " ".join(words)


def awkward(long_words=3000):
    """Texts with nulls, empties, blanks, copies, near copies, shared passages and a long text."""
    a, b = prose(1), prose(2)
    passage = prose(3, 50)
    return [
        None, "", " \n\t ", "one", "one two three", a, a, near(a, 5), near(a, 6, 2), b,
        prose(7) + " " + passage, passage + "\n" + prose(8), prose(9, 40) + "  " + passage + " " + prose(10, 40),
        "same " * 100, "same " * 90, "a b " * 60, prose(11, long_words, 10 ** 6), a.upper(), "é ü   ñ ß",
        prose(12, 34), prose(12, 34), prose(13, 35), prose(13, 35), None, "",
    ]
