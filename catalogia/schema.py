"""Schemas of items, profiles and the nested files around them."""

from pyspark.sql import types as T

_S, _L, _I, _D, _B = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
)


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STRINGS = T.ArrayType(_S)

# One hit as the platforms deliver it; absent keys read as null.
HIT = _struct(
    title=_S, url=_S, source=_S, bvid=_S, video_id=_S, channel=_S, author=_S,
    description=_S, snippet=_S, published_at=_S, date=_S, duration=_S,
    view_count=_L, play_count=_L, verified=_B, verify_status=_I, verify_note=_S,
    search_query=_S, original_file_id=_I, category=_S, classification_reason=_S,
    confidence=_D, confidence_signals=T.MapType(_S, _D),
)

# An item row: a hit with its profile and its place in the collection.
ITEM = T.StructType(
    [T.StructField("profile", _S), T.StructField("file_id", _I), T.StructField("ord", _L)]
    + HIT.fields
)

RAW_FILE = _struct(
    file_id=_I, output_path=_S, title=_S, description=_S, collected_at=_S,
    searches=T.ArrayType(_struct(
        tool=_S, query=_S, page=_I, result_count=_I, results=T.ArrayType(HIT),
    )),
)

CATALOG_FILE = _struct(
    file_id=_I, output_path=_S, title=_S, description=_S, processed_at=_S,
    total_results=_L, results=T.ArrayType(HIT),
)

DECISIONS_FILE = _struct(reviewed=T.MapType(_S, _S), session_start=_S)

PROFILE_DOCUMENT = _struct(
    artist=_struct(
        names=_struct(primary=_S, english=_S, aliases=_STRINGS),
        official_channels=_STRINGS, labels=_STRINGS, birth_year=_I, genre=_S,
        awards=_STRINGS, social_links=T.MapType(_S, _S),
        channels=T.ArrayType(_struct(platform=_S, id=_S, name=_S)),
    ),
    group=_struct(name=_S, aliases=_STRINGS, members=_STRINGS, member_names=_STRINGS),
    discography=_struct(
        solo_albums=T.ArrayType(_struct(name=_S, year=_I, tracks=_STRINGS)),
        ost_singles=T.ArrayType(_struct(name=_S, source=_S, year=_I)),
        variety_show_singles=T.ArrayType(_struct(name=_S, source=_S, year=_I)),
        concerts=T.ArrayType(_struct(name=_S, years=_S, aliases=_STRINGS, venues=_STRINGS)),
        group_concerts=T.ArrayType(_struct(name=_S, years=_S)),
        variety_shows=T.ArrayType(_struct(name=_S, network=_S)),
        collaborators=T.ArrayType(_struct(name=_S, aliases=_STRINGS, songs=_STRINGS)),
        group_mvs=_STRINGS, venues=_STRINGS, interview_channels=_STRINGS,
        notable_interviewers=_STRINGS, western_artist_blacklist=_STRINGS,
        other_chinese_artist_blacklist=_STRINGS, wrong_context_patterns=_STRINGS,
    ),
    categories=T.ArrayType(_struct(
        id=_I, key=_S, label=_S, sub=_S, output_path=_S, description=_S,
    )),
    classification=_struct(priority=_STRINGS),
)

# A parsed profile row adds its slug.
PROFILE = T.StructType([T.StructField("profile", _S)] + PROFILE_DOCUMENT.fields)

# Payload shapes of the platforms.
VIDEO_DETAILS_PAYLOAD = _struct(items=T.ArrayType(_struct(
    id=_S,
    snippet=_struct(title=_S, channelTitle=_S, description=_S, publishedAt=_S),
    statistics=_struct(viewCount=_S),
    contentDetails=_struct(duration=_S),
)))
UPLOADS_PAGE_PAYLOAD = _struct(
    items=T.ArrayType(_struct(
        snippet=_struct(title=_S, channelTitle=_S, description=_S, publishedAt=_S),
        contentDetails=_struct(videoId=_S),
    )),
    nextPageToken=_S,
)
WEB_PAYLOAD = _struct(organic=T.ArrayType(_struct(title=_S, link=_S, snippet=_S, date=_S)))
SECOND_PLATFORM_PAYLOAD = _struct(
    code=_I,
    data=_struct(result=T.ArrayType(_struct(
        bvid=_S, title=_S, play=_L, author=_S, description=_S, pubdate=_L, duration=_S,
    ))),
)
LABELS = T.ArrayType(_struct(index=_I, category=_S, reason=_S))
