"""A corpus from documents to packed training sequences: one operator of ``catalogia.llm`` per stage.

Every stage takes what its predecessor kept, written as Parquet and read again.  All but the last
return rows of ``documents``; the last returns the pieces and their places in sequences.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalogia.llm.common import NO_ID, scratch, small_batches, stored, table
from catalogia.llm.decontamination import drop_contaminated
from catalogia.llm.ngram_join import component_firsts
from catalogia.llm.packing import pack_documents
from catalogia.llm.pii import replace_pii
from catalogia.llm.queries import PII_KEY, TOKENIZER
from catalogia.llm.toxicity import fit_toxicity

# Rows that are left out by a broadcast list of their keys (16 bytes each); above, by a shuffled join.
LISTED_ROWS = 2_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated model does not call toxic."""
    small_batches(spark)
    return fit_toxicity(docs, table(spark, sf_dir, "labels")).drop_toxic(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that of the least id (ids before none), then
    of the least text hash; documents without words stay.

    Of rows without an id that are equal in text one stays; repeats of one row with an id, being
    the same document, stay or go together.
    """
    small_batches(spark)
    firsts = stored(component_firsts(docs).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "alone"))
    rows = docs.select(
        F.struct("*").alias("_row"), F.coalesce("doc_id", F.lit(NO_ID)).alias("_doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    with_id = rows.filter("_row.doc_id is not null")
    left_out = stored(with_id.select("_doc", "_hash").join(firsts, ["_doc", "_hash"], "left_anti").distinct())
    if left_out.count() <= LISTED_ROWS:
        # Texts stay where they are.
        with_id = with_id.join(F.broadcast(left_out), ["_doc", "_hash"], "left_anti")
    else:
        with_id = with_id.join(firsts, ["_doc", "_hash"], "left_semi")
    without = rows.filter("_row.doc_id is null").join(firsts.filter(F.col("_doc") == NO_ID), ["_doc", "_hash"])
    copy = F.row_number().over(Window.partitionBy("_hash").orderBy("_doc"))
    one = without.filter("not alone").withColumn("_copy", copy).filter("_copy = 1")
    parts = [with_id, without.filter("alone"), one]
    return reduce(DataFrame.unionByName, [p.select("_row.*") for p in parts])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms; n_chars follows the text."""
    small_batches(spark)
    hidden = replace_pii(docs, PII_KEY, counts=False)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        hidden = hidden.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return hidden.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", hide_personal_values),
    ("packing", pack),
]

# Training, tokenization and packing have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
