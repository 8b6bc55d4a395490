"""Sinks and the versioned catalogue: every query writes below the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.operators import reports, running_counts
from catalogia.plans import browse_queries, tables
from catalogia.plans.classify_queries import _DECISIONS, _decisions
from catalogia.plans.oracle_parts import is_in, with_ctes
from catalogia.plans.registry import ORACLES, query
from catalogia.session import shared_folder
from catalogia.sources import files
from catalogia.sources.versioned import Catalogue

_CATEGORIES = ["personal_mv", "concerts", V.DISCARD, V.UNCLASSIFIED]
_KEPT = ["profile", "file_id", "ord", "original_file_id", "url", "title", "category", "classification_reason", "confidence"]
_BASE = f"""base as (select profile, file_id, ord, original_file_id, url, title,
  {_CATEGORIES}[1 + ord % 4] as category, 'given' as classification_reason, (ord % 10) / 10e0 as confidence from items)"""
_LIST = ", ".join(_KEPT)


def _sorted_items(spark, sf_dir) -> DataFrame:
    """All items with a category by their line, as a collection would hand them over."""
    given = F.get(F.array(*[F.lit(c) for c in _CATEGORIES]), (F.col("ord") % 4).cast("int"))
    return tables.items(spark, sf_dir).withColumns({
        "category": given, "classification_reason": F.lit("given"), "confidence": F.col("ord") % 10 / 10,
    }).select(*_KEPT)


@query(with_ctes("items", f"""select {_LIST} from base
where category <> 'unclassified' and (profile <> 'en' or confidence >= 0.5)""", _BASE))
def catalog_written(spark, sf_dir):
    """A catalogue written whole, then one profile of it again; the others stay as they were."""
    path, items = shared_folder(spark, "catalog"), _sorted_items(spark, sf_dir)
    files.write_catalog(items, path, keep_unclassified=False)
    files.write_catalog(items.filter("profile = 'en' and confidence >= 0.5"), path, keep_unclassified=False)
    return files.read_catalog(spark, path).select(*_KEPT)


@query(with_ctes("items", f"select {_LIST} from base", _BASE))
def discards_appended(spark, sf_dir):
    """Discards added twice to a catalogue without any are there once."""
    path, items = shared_folder(spark, "catalog"), _sorted_items(spark, sf_dir)
    files.write_catalog(items.filter(F.col("category") != V.DISCARD), path)
    for _ in range(2):
        files.append_discards(items.filter(F.col("category") == V.DISCARD), path)
    return files.read_catalog(spark, path).select(*_KEPT)


@query(f"select profile, category, text from ({ORACLES['document_lines']}) t")
def documents_written(spark, sf_dir):
    """The rendered documents as text files, read back line by line."""
    path = shared_folder(spark, "documents")
    files.write_documents(browse_queries.document_lines(spark, sf_dir), path)
    return spark.read.text(path).select("profile", "category", F.col("value").alias("text"))


@query(with_ctes("items", f"""select profile, file_id, ord, original_file_id, b.url, title,
  case when action = 'reject' then 'discard' else category end as category,
  case when action = 'reject' then 'review_rejected' else classification_reason end as classification_reason,
  case when action = 'approve' then 1e0 else confidence end as confidence
from base b left join decided d using (profile, url) where category <> 'discard' and profile <> 'fr'
union all select {_LIST} from base where category = 'discard' and profile <> 'fr'""", _BASE, _DECISIONS))
def catalog_versions(spark, sf_dir):
    """Rewrite, review, append and the removal of a profile as versions of one catalogue."""
    items = _sorted_items(spark, sf_dir)
    catalogue = Catalogue(spark, shared_folder(spark, "versions"))
    catalogue.rewrite(items.filter(F.col("category") != V.DISCARD))
    catalogue.review(_decisions(spark, sf_dir))
    catalogue.append_discards(items.filter(F.col("category") == V.DISCARD))
    catalogue.rewrite(items.limit(0), profiles=["fr"])
    return catalogue.read().select(*_KEPT)


@query(with_ctes("items", f"""select profile, count(*) as n, count(*) filter (category in {is_in(_CATEGORIES[:2])}) as n_sorted
from base where category <> 'discard' group by profile""", _BASE))
def catalog_first_version(spark, sf_dir):
    """An earlier version stays readable after later changes."""
    items = _sorted_items(spark, sf_dir)
    catalogue = Catalogue(spark, shared_folder(spark, "versions"))
    first = catalogue.rewrite(items.filter(F.col("category") != V.DISCARD))
    catalogue.rewrite(items.limit(0), profiles=tables.LANGS)
    return catalogue.read(first).groupBy("profile").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("category").isin(_CATEGORIES[:2])).alias("n_sorted"))


_VERSIONS = ORACLES["catalog_versions"]


def _condensed(spark, sf_dir) -> DataFrame:
    """Counts stored after the first version of a catalogue and brought to its last by what changed since."""
    items, decisions = _sorted_items(spark, sf_dir), _decisions(spark, sf_dir)
    catalogue = Catalogue(spark, shared_folder(spark, "versions"))
    counts = shared_folder(spark, "counts")
    catalogue.rewrite(items.filter(F.col("category") != V.DISCARD))
    running_counts.update(catalogue, counts)
    catalogue.review(decisions)
    running_counts.update(catalogue, counts)
    catalogue.append_discards(items.filter(F.col("category") == V.DISCARD))
    catalogue.rewrite(items.limit(0), profiles=["fr"])
    return running_counts.update(catalogue, counts)


@query(f"""select profile, coalesce(classification_reason, 'unknown') as reason, count(*) as n
from ({_VERSIONS}) v group by all""")
def reason_counts_current(spark, sf_dir):
    return reports.reason_counts(_condensed(spark, sf_dir), n=F.col("n"))


@query(f"""select profile, original_file_id, {', '.join(f"count(*) filter (category = '{c}') as {c}" for c in _CATEGORIES)}
from ({_VERSIONS}) v group by all""")
def migration_matrix_current(spark, sf_dir):
    return reports.migration_matrix(_condensed(spark, sf_dir), _CATEGORIES, n=F.col("n"))
