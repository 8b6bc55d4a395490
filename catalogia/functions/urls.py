"""Video ids, dedup keys and link tests."""

from pyspark.sql import functions as F

from catalogia.functions.text import blank_to_null

_HOST = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*/+([^?#;]*)"
_QUERY_V = r"\A[^?#]*\?(?:[^#]*?&)?v=([^&#]+)"


def uploads_playlist_id(channel_id):
    return F.regexp_replace(channel_id, r"\AUC", "UU")


def _after_last(text, mark, stop):
    return F.substring_index(F.substring_index(text, mark, -1), stop, 1)


def video_id_simple(url):
    """Id after the last ``v=``, else after the short host, else ''."""
    return (
        F.when(F.contains(url, F.lit("v=")), _after_last(url, "v=", "&"))
        .when(F.contains(url, F.lit("youtu.be/")), _after_last(url, "youtu.be/", "?"))
        .otherwise("")
    )


def url_host(url):
    netloc = F.regexp_extract(url, _HOST, 1)
    return F.lower(F.regexp_replace(F.substring_index(netloc, "@", -1), r":\d*\z", ""))


def video_id_parsed(url):
    """Id by host: path of the short host, else the decoded query parameter; blank is null."""
    host = url_host(url)
    raw = F.regexp_extract(url, _QUERY_V, 1)
    decoded = F.coalesce(F.try_url_decode(raw), raw)
    known = F.contains(host, F.lit("youtube.com")) | F.contains(host, F.lit("youtu.be"))
    return blank_to_null(
        F.when(host == "youtu.be", F.regexp_extract(url, _PATH, 1)).when(known, decoded)
    )


def batch_key(url, bvid, source):
    """Key inside one collection file; null means "never a duplicate"."""
    url_or_null = blank_to_null(url)
    return (
        F.when(
            source == "youtube",
            F.when(
                F.contains(url, F.lit("v=")), F.concat(F.lit("yt:"), _after_last(url, "v=", "&"))
            ).otherwise(F.concat(F.lit("yt:"), url_or_null)),
        )
        .when(source == "bilibili", F.concat(F.lit("bili:"), blank_to_null(bvid)))
        .otherwise(F.concat(F.lit("url:"), url_or_null))
    )


def catalog_key(url, bvid, source):
    """Key across the catalogue; never null, all empty urls share one key."""
    return F.coalesce(
        F.when(source == "youtube", F.concat(F.lit("yt:"), video_id_parsed(url))),
        F.when(source == "bilibili", F.concat(F.lit("bili:"), blank_to_null(bvid))),
        F.concat(F.lit("url:"), F.coalesce(url, F.lit(""))),
    )


def tracker_key(url, bvid, source):
    """Key of the duplicate marker: like ``batch_key`` without its prefix."""
    return (
        F.when(
            source == "youtube",
            F.when(F.contains(url, F.lit("v=")), _after_last(url, "v=", "&")).otherwise(
                blank_to_null(url)
            ),
        )
        .when(source == "bilibili", blank_to_null(bvid))
        .otherwise(blank_to_null(url))
    )
