"""Profile documents from JSON or YAML files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogia.functions import slug
from catalogia.schema import PROFILE_DOCUMENT


def _yaml_to_json(batches):
    import yaml

    for batch in batches:
        texts = []
        for text in batch["value"]:
            try:
                texts.append(json.dumps(yaml.safe_load(text), ensure_ascii=False, default=str))
            except yaml.YAMLError:
                texts.append(None)
        batch["json"] = texts
        yield batch[["path", "json"]]


def parse_documents(documents: DataFrame, on_error: str = "PERMISSIVE") -> DataFrame:
    """``documents(json)`` and any other columns to typed documents; every document keeps its row.

    A document that is no JSON object has null in every part; a part of another type is null.
    """
    kept = [c for c in documents.columns if c != "json"]
    return documents.select(
        *kept, F.from_json("json", PROFILE_DOCUMENT, {"mode": on_error}).alias("d")
    ).select(*kept, "d.*")


def parse_profiles(documents: DataFrame, on_error: str = "PERMISSIVE") -> DataFrame:
    """``documents(json)`` to profile rows; the slug of the English name is the profile key."""
    parsed = parse_documents(documents.select("json"), on_error)
    return parsed.filter(F.coalesce("artist.names.english", F.lit("")) != "").select(
        slug(F.col("artist.names.english")).alias("profile"), "*"
    )


def read_profiles(spark: SparkSession, path: str, fmt: str = "json", on_error="PERMISSIVE") -> DataFrame:
    """One row per profile document under ``path``; unreadable documents give no row.

    ``on_error='FAILFAST'`` makes a document that does not fit the schema an error.
    """
    texts = spark.read.text(path, wholetext=True)
    if fmt == "json":
        return parse_profiles(texts.withColumnRenamed("value", "json"), on_error)
    named = texts.select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_profiles(named.mapInPandas(_yaml_to_json, "path string, json string"), on_error)
