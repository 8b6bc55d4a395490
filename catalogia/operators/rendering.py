"""Tables and documents as rows of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions import compact_item, escape_md, table_mark, views, views_wan, who
from catalogia.operators.distribution import attach

_PLACE = ["profile", "category", "file_id", "ord"]
_SECTIONS = ["youtube", "bilibili", "google"]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _mark() -> Column:
    return table_mark(F.col("verified"), F.col("verify_status"))


def _row(*cells: Column) -> Column:
    joined = F.concat_ws(" | ", *cells)
    return F.concat(F.lit("| "), joined, F.lit(" "), _mark(), F.lit("|"))


def video_text() -> Column:
    platform = F.when(F.col("source") == "youtube", "YouTube").otherwise("Bilibili")
    link = F.concat(F.lit(f"[{V.VIDEO_LINK_LABEL}]("), _text("url"), F.lit(")"))
    return _row(
        escape_md(F.col("title")), link, platform, _text("published_at"),
        views_wan(F.coalesce(views(), F.lit(0))), escape_md(who()), _text("duration"),
    )


def web_text() -> Column:
    link = F.concat(F.lit(f"[{V.WEB_LINK_LABEL}]("), _text("url"), F.lit(")"))
    snippet = F.substring(escape_md(F.col("snippet")), 1, V.WEB_SNIPPET_CHARS)
    return _row(escape_md(F.col("title")), link, F.lit("Google"), _text("date"), snippet)


def video_lines(items: DataFrame) -> DataFrame:
    """One table row of text per video of the two video platforms."""
    return items.filter(F.col("source").isin("youtube", "bilibili")).select(
        *_PLACE, video_text().alias("text")
    )


def web_lines(items: DataFrame) -> DataFrame:
    return items.filter(F.col("source") == "google").select(*_PLACE, web_text().alias("text"))


def document_lines(
    items: DataFrame, categories: DataFrame, names: DataFrame, updated: str,
) -> DataFrame:
    """Every line of every category document.

    Lines sort by (``section``, ``block``, ``file_id``, ``ord``) inside a category: the
    place is part of the row, so a document of any length is never gathered to number
    its lines.  Section 0 is the head; 1 to 3 are the platforms.
    """
    counts = items.groupBy("profile", "category").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("source") == s).alias(f"n_{s}") for s in _SECTIONS],
    )
    head = categories.join(names.select("profile", "primary"), "profile").select(
        "profile", F.col("key").alias("category"),
        F.concat("primary", "label").alias("title"), _text("description").alias("description"),
    ).join(counts, ["profile", "category"], "left").fillna(0, ["n", *[f"n_{s}" for s in _SECTIONS]])

    def line(section, place, text, when=None):
        row = F.struct(
            F.lit(section).alias("section"), F.lit(place[0]).alias("block"),
            F.lit(place[1]).cast("int").alias("file_id"),
            F.lit(place[1]).cast("bigint").alias("ord"), text.alias("text"),
        )
        return row if when is None else F.when(when, row)

    lines = [
        line(0, (i, 0), text) for i, text in enumerate([
            F.concat(F.lit("# "), "title"), F.lit(""), F.concat(F.lit("> "), "description"),
            F.lit(V.SOURCES_LINE), F.format_string(V.TOTAL_LINE, "n", F.lit(updated)), F.lit(""),
            F.lit("---"), F.lit(""),
        ])
    ]
    for number, source in enumerate(_SECTIONS, 1):
        web = source == "google"
        filled = F.col(f"n_{source}") > 0
        texts = [
            V.SECTION_TITLES[source], "", V.WEB_TABLE_HEADER if web else V.VIDEO_TABLE_HEADER,
            V.WEB_TABLE_RULE if web else V.VIDEO_TABLE_RULE,
        ]
        lines += [line(number, (i, 0), F.lit(t), filled) for i, t in enumerate(texts)]
        lines.append(line(number, (5, 0), F.lit(""), filled))
    lines += [
        line(4, (i, 0), F.lit(t), F.col("n") == 0) for i, t in enumerate([V.EMPTY_NOTICE, ""])
    ]
    framing = head.select(
        "profile", "category",
        F.inline(F.filter(F.array(*lines), lambda r: r.isNotNull())),
    )
    rank = F.lit(0)
    for number, source in enumerate(_SECTIONS, 1):
        rank = F.when(F.col("source") == source, number).otherwise(rank)
    listed = categories.select("profile", F.col("key").alias("category"))
    body = attach(
        items.filter(F.col("source").isin(_SECTIONS)), listed, ["profile", "category"],
        ["file_id", "ord"], "left_semi",
    ).select(
        "profile", "category", rank.alias("section"), F.lit(4).alias("block"), "file_id", "ord",
        F.when(F.col("source") == "google", web_text()).otherwise(video_text()).alias("text"),
    )
    return framing.unionByName(body)


def compact_payload(items: DataFrame) -> DataFrame:
    """Compact JSON of each item, in (``file_id``, ``ord``) order within its category."""
    return items.select(*_PLACE, compact_item().alias("payload"))
