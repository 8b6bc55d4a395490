"""Review of low-confidence items as table operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.operators.distribution import spread_join
from catalogia.operators.quality import low_confidence
from catalogia.session import cut_lineage

_ROW = ["file_id", "ord"]


def latest_decisions(decisions: DataFrame) -> DataFrame:
    """One action per profile and url: the last answer counts, of equal times the greatest action."""
    order = F.struct("decided_at", "action")
    return decisions.groupBy("profile", "url").agg(F.max_by("action", order).alias("action"))


def _decided(items: DataFrame, decisions: DataFrame) -> DataFrame:
    return spread_join(items, latest_decisions(decisions), ["profile", "url"], _ROW)


def review_queue(
    items: DataFrame, threshold: float = V.REVIEW_THRESHOLD, category: str | None = None,
    decisions: DataFrame | None = None,
) -> DataFrame:
    """Items to look at, least certain first; decided ones (skips too) are left out.

    A sort reads its input twice, once for its ranges, so the listed rows are stored before it.
    """
    listed = low_confidence(items, threshold).filter(F.col("category").isin(
        [category] if category else list(V.CATEGORY_FILE_IDS)
    ))
    if decisions is not None:
        listed = _decided(listed, decisions).filter(F.col("action").isNull()).drop("action")
    rank = F.lit(99)
    for key, file_id in V.CATEGORY_FILE_IDS.items():
        rank = F.when(F.col("category") == key, file_id).otherwise(rank)
    return cut_lineage(listed).orderBy("confidence", rank, *_ROW)


def with_review(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every item with the effect of its decision.

    Approve: confidence 1.0.  Reject: category ``discard``.  Skip or none: unchanged.
    Earlier discards are not under review.
    """
    open_ = F.col("category") != V.DISCARD
    approved, rejected = (
        F.coalesce(open_ & (F.col("action") == a), F.lit(False)) for a in ("approve", "reject")
    )
    changed = {
        "category": F.when(rejected, V.DISCARD).otherwise(F.col("category")),
        "classification_reason": F.when(rejected, "review_rejected").otherwise(
            F.col("classification_reason")
        ),
        "confidence": F.when(approved, 1.0).otherwise(F.col("confidence")),
    }
    if "confidence_signals" in items.columns:
        changed["confidence_signals"] = F.when(
            approved, F.create_map(F.lit("review_approved"), F.lit(1.0))
        ).otherwise(F.col("confidence_signals"))
    return _decided(items, decisions).select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in items.columns]
    )


def apply_review(items: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items that stay in their category, all discards: earlier and newly rejected)."""
    reviewed = with_review(items, decisions)
    discarded = F.col("category") == V.DISCARD
    return reviewed.filter(~discarded), reviewed.filter(discarded)


def action_summary(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per profile: queued items, how many of them got which action, how many remain."""
    action = F.col("action")
    return _decided(queue, decisions).groupBy("profile").agg(
        F.count(F.lit(1)).alias("n_queue"),
        F.count_if(action == "approve").alias("n_approved"),
        F.count_if(action == "reject").alias("n_rejected"),
        F.count_if(action == "skip").alias("n_skipped"),
        F.count_if(action.isNull()).alias("n_remaining"),
    )
