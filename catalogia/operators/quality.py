"""Quality filters over classified items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions import views, who
from catalogia.operators.distribution import attach
from catalogia.operators.profiles import DICTIONARY, with_dictionary


def filter_low_views(
    items: DataFrame, profiles: DataFrame, thresholds: DataFrame | None = None,
    default: int = V.VIEW_THRESHOLD_DEFAULT, keep_dictionary=False,
) -> DataFrame:
    """Move items below the view threshold of their category to ``discard``.

    Items without a view count, items of official channels and unclassified items (the
    labeller gets those unfiltered) are exempt; confidence stays what it was.  ``thresholds(category, min_views)`` replaces the fixed ones.
    """
    names = [c for c in items.columns if c != DICTIONARY]
    base = with_dictionary(items, profiles)
    if thresholds is None:
        limit = F.lit(default)
        for category, least in V.VIEW_THRESHOLDS.items():
            limit = F.when(F.col("category") == category, least).otherwise(limit)
    else:
        custom = thresholds.select("category", F.col("min_views").alias("_min"))
        base = attach(base, custom, ["category"], ["file_id", "ord"], "left")
        limit = F.coalesce(F.col("_min"), F.lit(default))
    official = F.coalesce(F.array_contains(f"{DICTIONARY}.official", who()), F.lit(False))
    count = F.coalesce(views(), F.lit(0))
    low = ~F.col("category").isin(V.DISCARD, V.UNCLASSIFIED) & (count != 0) & ~official & (count < limit)
    changed = {
        "category": F.when(low, V.DISCARD).otherwise(F.col("category")),
        "classification_reason": F.when(low, "filtered_low_views").otherwise(
            F.col("classification_reason")
        ),
    }
    extra = [DICTIONARY] if keep_dictionary else []
    return base.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in names], *extra
    )


def low_confidence(items: DataFrame, threshold: float = V.REVIEW_THRESHOLD) -> DataFrame:
    """Scored items below the threshold; a comparison with null is never true."""
    return items.filter(F.col("confidence") < threshold)
