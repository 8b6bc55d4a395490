"""Display forms of counts and marks."""

from pyspark.sql import functions as F

from catalogia import fixed_values as V


def fixed(x, digits):
    """Fixed-point text, rounded on the exact binary value (ties to even)."""
    return F.translate(F.format_number(x, digits), ",", "")


def views_wan(count):
    """``1.2万`` from 10 000 up; text that is no whole number passes through."""
    n = count.try_cast("bigint")
    return F.coalesce(
        F.when(n >= 10_000, F.concat(fixed(n / 10_000, 1), F.lit("万"))).otherwise(
            n.cast("string")
        ),
        count.cast("string"),
        F.lit(""),
    )


def views_mk(n):
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "N/A")
        .when(n >= 1_000_000, F.concat(fixed(n / 1_000_000, 1), F.lit("M")))
        .when(n >= 1_000, F.concat(fixed(n / 1_000, 1), F.lit("K")))
        .otherwise(n.cast("string"))
    )


def views_yi(n):
    """Browser form; exact ties round up there, so they are nudged here."""
    tie = F.when(n % 50_000_000 == 25_000_000, 0.01).otherwise(0.0)
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "—")
        .when(n >= 100_000_000, F.concat(fixed(n / 100_000_000 + tie, 1), F.lit("億")))
        .when(n >= 10_000_000, F.concat(F.floor((n + 5_000_000) / 10_000_000), F.lit("千萬")))
        .when(n >= 10_000, F.concat(F.floor((n + 5_000) / 10_000), F.lit("萬")))
        .otherwise(F.format_number(n, 0))
    )


def table_mark(verified, status):
    """Mark of the text tables: only an explicit "not verified" without a status."""
    hit = (verified == F.lit(False)) & (F.coalesce(status, F.lit(0)) == 0)
    return F.when(hit, V.UNVERIFIED_MARK).otherwise("")


def browser_mark(verified, status):
    """Mark of the browser: not verified or unknown, with status exactly 0."""
    hit = ~F.coalesce(verified, F.lit(False)) & (F.coalesce(status, F.lit(-1)) == 0)
    return F.when(hit, V.UNVERIFIED_MARK).otherwise("")
