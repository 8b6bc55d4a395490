"""Text helpers as column expressions."""

from pyspark.sql import functions as F

# Characters that count as white space when trimming.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))


def trim_all(text):
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text):
    return F.nullif(text, F.lit(""))


def strip_tags(text):
    return trim_all(F.regexp_replace(text, "<[^>]+>", ""))


def truncate_desc(text, n):
    """First n characters on one line; null reads as empty."""
    return F.translate(F.substring(F.coalesce(text, F.lit("")), 1, n), "\n", " ")


def slug(name):
    return F.translate(F.lower(name), " .", "_")


def escape_md(text):
    one_line = F.translate(F.coalesce(text, F.lit("")), "\n", " ")
    return trim_all(F.replace(one_line, F.lit("|"), F.lit("\\|")))


def strip_fences(text):
    """Drop a leading fence line and a trailing fence."""
    opened = F.regexp_replace(trim_all(text), r"\A```[^\n]*\n?", "")
    return trim_all(F.regexp_replace(opened, r"```\z", ""))


def contains_any(text, terms):
    """True if any element of the array column ``terms`` is a substring of ``text``."""
    return F.exists(terms, lambda term: F.contains(text, term))
