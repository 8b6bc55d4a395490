"""The whole flow from raw batches to a stored catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from catalogia.operators.dedup import dedup_first, dedup_richest
from catalogia.operators.labels import apply_labels, finalise, parse_label_responses
from catalogia.operators.links import apply_link_checks
from catalogia.operators.profiles import dims
from catalogia.operators.quality import filter_low_views
from catalogia.operators.rules import classify
from catalogia.operators.scoring import score


def clean_items(raw: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """Raw hits to items: first per file, dead links dropped, richest per key."""
    unique = dedup_first(raw)
    return dedup_richest(unique if checks is None else apply_link_checks(unique, checks))


def classify_items(items: DataFrame, profiles: DataFrame) -> DataFrame:
    """Category, reason, confidence and view filter; the dictionaries are attached once."""
    classified = classify(items, profiles, keep_dictionary=True)
    return filter_low_views(score(classified, profiles, keep_dictionary=True), profiles)


def refresh(
    raw: DataFrame, profiles: DataFrame, checks: DataFrame | None = None,
) -> DataFrame:
    """Raw hits to catalogue rows.  Store the result before labelling or review."""
    return classify_items(clean_items(raw, checks), profiles)


def merge_labels(
    catalog: DataFrame, batches: DataFrame, responses: DataFrame, profiles: DataFrame,
) -> DataFrame:
    """Settled rows plus the labelled ones; ``batches`` as they were handed out."""
    categories = dims(profiles, "categories")["categories"]
    labelled = apply_labels(batches, parse_label_responses(responses), categories)
    return finalise(catalog, labelled, profiles)
