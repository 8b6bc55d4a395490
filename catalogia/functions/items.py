"""Expressions over the columns of an item row."""

from pyspark.sql import functions as F

from catalogia import fixed_values as V
from catalogia.functions.text import blank_to_null


def who():
    """Channel, else author, else ''."""
    return F.coalesce(blank_to_null(F.col("channel")), blank_to_null(F.col("author")), F.lit(""))


def views():
    """View count unless 0 or null, else play count; may be null or 0."""
    return F.coalesce(F.nullif(F.col("view_count"), F.lit(0)), F.col("play_count"))


def title():
    return F.coalesce(F.col("title"), F.lit(""))


def title_lc():
    return F.lower(title())


def richness():
    """How much is known about an item; higher is kept."""
    filled = [
        F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0)
        for c in ("title", "channel", "author", "description", "published_at", "duration")
    ]
    score = F.least(F.floor(F.coalesce(views(), F.lit(0)) / 1000), F.lit(100))
    for one in filled:
        score = score + one
    return score + F.when(F.coalesce(F.col("verified"), F.lit(False)), 5).otherwise(0)


def compact_item():
    """JSON of the named keys without null ones."""
    return F.to_json(F.struct(*V.COMPACT_KEYS))
