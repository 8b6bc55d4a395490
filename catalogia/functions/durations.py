"""Durations and dates."""

from pyspark.sql import functions as F

_ISO = r"\APT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"


def iso_duration_text(iso):
    """``PT1H2M3S`` -> ``1:02:03``; text that is no ISO duration is kept."""

    def part(i):
        return F.coalesce(F.regexp_extract(iso, _ISO, i).try_cast("bigint"), F.lit(0))

    h, m, s = part(1), part(2), part(3)
    text = F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(
        F.format_string("%d:%02d", m, s)
    )
    return F.when(iso.startswith("PT"), text).otherwise(F.coalesce(iso, F.lit("")))


def duration_seconds(text):
    """``h:mm:ss`` or ``m:ss`` to seconds, else null."""
    parts = F.split(text, ":")

    def number(i):
        return F.get(parts, F.lit(i)).try_cast("bigint")

    return (
        F.when(F.size(parts) == 3, number(0) * 3600 + number(1) * 60 + number(2))
        .when(F.size(parts) == 2, number(0) * 60 + number(1))
    )


def duration_text(seconds):
    """Seconds to ``h:mm:ss`` or ``m:ss``."""
    h, m, s = (
        F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60,
    )
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(
        F.format_string("%d:%02d", m, s)
    )


def epoch_to_date(seconds):
    """Epoch seconds to a date text in the session time zone; 0 and null give ''."""
    return F.when(
        F.coalesce(seconds, F.lit(0)) != 0, F.from_unixtime(seconds, "yyyy-MM-dd")
    ).otherwise("")


def year_month(date_text):
    return F.coalesce(F.nullif(F.substring(date_text, 1, 7), F.lit("")), F.lit("—"))
