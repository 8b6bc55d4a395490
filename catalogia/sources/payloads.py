"""Platform payloads (one JSON text per call) to item columns.

Input: ``payload`` plus any other columns, which are kept in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia import schema
from catalogia.functions import epoch_to_date, iso_duration_text, strip_tags, truncate_desc

_WATCH = "https://www.youtube.com/watch?v="
_SECOND_PLATFORM = "https://www.bilibili.com/video/"


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _hits(payloads: DataFrame, shape, path: str) -> DataFrame:
    """One row per element of the payload's list, with its position; no list, no rows."""
    rest = [c for c in payloads.columns if c != "payload"]
    parsed = payloads.select(*rest, F.from_json("payload", shape).alias("_d"))
    return parsed.select(*rest, F.posexplode(f"_d.{path}").alias("pos", "e"))


def norm_video_details(payloads: DataFrame) -> DataFrame:
    hits = _hits(payloads, schema.VIDEO_DETAILS_PAYLOAD, "items")
    rest = [c for c in hits.columns if c != "e"]
    return hits.select(
        *rest, F.col("e.snippet.title").alias("title"),
        F.concat(F.lit(_WATCH), "e.id").alias("url"),
        F.col("e.snippet.channelTitle").alias("channel"),
        truncate_desc(F.col("e.snippet.description"), V.VIDEO_DESCRIPTION_CHARS).alias(
            "description"
        ),
        F.substring("e.snippet.publishedAt", 1, 10).alias("published_at"),
        F.coalesce(F.col("e.statistics.viewCount").try_cast("bigint"), F.lit(0)).alias("view_count"),
        iso_duration_text(_text(F.col("e.contentDetails.duration"))).alias("duration"),
        F.lit(True).alias("verified"),
    )


def norm_playlist(pages: DataFrame, max_pages: int = 0) -> DataFrame:
    """Uploads pages; entries without an id are skipped.  ``page_no`` starts at 1."""
    read = pages.filter(F.col("page_no") <= max_pages) if max_pages else pages
    hits = _hits(read, schema.UPLOADS_PAGE_PAYLOAD, "items")
    rest = [c for c in hits.columns if c != "e"]
    video = F.col("e.contentDetails.videoId")
    return hits.filter(_text(video) != "").select(
        *rest, _text(F.col("e.snippet.title")).alias("title"),
        F.concat(F.lit(_WATCH), video).alias("url"), video.alias("video_id"),
        _text(F.col("e.snippet.channelTitle")).alias("channel"),
        truncate_desc(F.col("e.snippet.description"), V.VIDEO_DESCRIPTION_CHARS).alias(
            "description"
        ),
        F.substring(_text(F.col("e.snippet.publishedAt")), 1, 10).alias("published_at"),
        F.lit(True).alias("verified"), F.lit("channel_crawl").alias("source"),
    )


def norm_web(payloads: DataFrame) -> DataFrame:
    hits = _hits(payloads, schema.WEB_PAYLOAD, "organic")
    rest = [c for c in hits.columns if c != "e"]
    return hits.select(
        *rest, _text(F.col("e.title")).alias("title"), _text(F.col("e.link")).alias("url"),
        _text(F.col("e.snippet")).alias("snippet"), _text(F.col("e.date")).alias("date"),
        F.lit(None).cast("boolean").alias("verified"),
    )


def norm_bili(payloads: DataFrame) -> DataFrame:
    """Second video platform; an answer with an error code or an entry without id gives nothing."""
    hits = _hits(
        payloads.filter(F.get_json_object("payload", "$.code") == "0"),
        schema.SECOND_PLATFORM_PAYLOAD, "data.result",
    )
    rest = [c for c in hits.columns if c != "e"]
    return hits.filter(_text(F.col("e.bvid")) != "").select(
        *rest, strip_tags(_text(F.col("e.title"))).alias("title"),
        F.concat(F.lit(_SECOND_PLATFORM), "e.bvid").alias("url"), F.col("e.bvid").alias("bvid"),
        F.coalesce("e.play", F.lit(0)).alias("play_count"), _text(F.col("e.author")).alias("author"),
        F.substring(
            strip_tags(_text(F.col("e.description"))), 1, V.SECOND_PLATFORM_DESCRIPTION_CHARS
        ).alias("description"),
        epoch_to_date(F.col("e.pubdate")).alias("published_at"),
        _text(F.col("e.duration")).alias("duration"), F.lit(None).cast("boolean").alias("verified"),
    )
