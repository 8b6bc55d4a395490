"""Counts over a classified catalogue.

``n`` is how many items a row stands for: one, or the count column of condensed rows
(see ``running_counts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions.display import fixed


def _times(n: Column | None) -> Column:
    return F.lit(1).cast("bigint") if n is None else n


def _counted(items: DataFrame, n: Column | None) -> DataFrame:
    return items.groupBy("profile", "category").agg(F.sum(_times(n)).alias("n"))


def category_counts(items: DataFrame, categories: DataFrame, n: Column | None = None) -> DataFrame:
    """Items per category, empty ones shown, plus discard, unclassified and a TOTAL row.

    ``categories(profile, key, id)``; the catalogue is aggregated before it meets them.
    """
    extra = categories.select("profile").distinct().select(
        "profile", F.explode(F.array(F.lit(V.DISCARD), F.lit(V.UNCLASSIFIED))).alias("category"),
        F.lit(None).cast("int").alias("file_id"),
    )
    listed = categories.select(
        "profile", F.col("key").alias("category"), F.col("id").cast("int").alias("file_id")
    ).unionByName(extra)
    filled = listed.join(_counted(items, n), ["profile", "category"], "left").fillna(0, ["n"])
    summed = filled.groupingSets(
        [["profile", "category", "file_id"], ["profile"]], "profile", "category", "file_id"
    ).agg(F.sum("n").alias("n"), F.grouping("category").alias("_total"))
    return summed.select(
        "profile", F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("category")).alias(
            "category"
        ), "file_id", "n",
    )


def reason_counts(items: DataFrame, n: Column | None = None) -> DataFrame:
    reason = F.coalesce("classification_reason", F.lit("unknown")).alias("reason")
    return items.groupBy("profile", reason).agg(F.sum(_times(n)).alias("n")).orderBy(
        F.desc("n"), "profile", "reason"
    )


def confidence_buckets(items: DataFrame, n: Column | None = None) -> DataFrame:
    """Count, percent and mean per confidence bucket; the mean is summed in decimals.

    Both are rounded on the exact binary value.
    """
    c, times = F.col("confidence"), _times(n)

    def within(condition: Column) -> Column:
        return F.sum(F.when(condition, times).otherwise(0))

    sums = items.filter(c.isNotNull()).groupBy("profile").agg(
        F.sum(times).alias("total"), F.sum(c.cast("decimal(12,6)") * times).alias("s"),
        within(c >= 0.8).alias("high"), within((c >= 0.5) & (c < 0.8)).alias("medium"), within(c < 0.5).alias("low"),
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("bucket"), F.col(name).alias("n"))
        for name in ("high", "medium", "low")
    ])
    return sums.select("profile", "total", "s", F.inline(rows)).select(
        "profile", "bucket", "n",
        fixed(F.col("n") * 100.0 / F.col("total"), 1).cast("double").alias("percent"),
        fixed(F.col("s").cast("double") / F.col("total"), 3).cast("double").alias("mean_confidence"),
    )


def migration_matrix(items: DataFrame, keys: list[str] | None = None, n: Column | None = None) -> DataFrame:
    """Old file by new category; the category list is given, so no pass to find it."""
    listed = keys or [*V.CATEGORY_FILE_IDS, V.DISCARD, V.UNCLASSIFIED]
    return items.groupBy("profile", "original_file_id").pivot("category", listed).agg(
        F.sum(_times(n))
    ).fillna(0, listed)


def catalog_counts(items: DataFrame, categories: DataFrame, n: Column | None = None) -> DataFrame:
    """Total per category of the profile; ``missing`` where nothing was collected."""
    listed = categories.select("profile", F.col("key").alias("category"), "label")
    joined = listed.join(_counted(items, n), ["profile", "category"], "left")
    return joined.select(
        "profile", "category", "label", F.coalesce("n", F.lit(0)).alias("n"),
        F.col("n").isNull().alias("missing"),
    )


def profile_summary(items: DataFrame, categories: DataFrame, n: Column | None = None) -> DataFrame:
    counts = catalog_counts(items, categories, n)
    return counts.groupBy("profile").agg(
        F.sum("n").alias("n_items"), F.count_if(F.col("n") > 0).alias("n_categories")
    )


def rule_counts(items: DataFrame, n: Column | None = None) -> DataFrame:
    open_, times = F.col("category") == V.UNCLASSIFIED, _times(n)
    return items.groupBy("profile").agg(
        F.sum(F.when(~open_, times).otherwise(0)).alias("n_classified"),
        F.sum(F.when(open_, times).otherwise(0)).alias("n_unclassified"),
    )
