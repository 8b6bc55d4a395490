"""Scalar functions, payloads, duplicates and link checks over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia import functions as C
from catalogia.operators import dedup, links
from catalogia.plans import tables
from catalogia.plans.oracle_parts import WHO, with_ctes
from catalogia.plans.refresh import classify_items
from catalogia.plans.registry import query
from catalogia.plans.tables import items_sql
from catalogia.sources import files, payloads

_ROW = "profile, file_id, ord"

# The white space that trimming removes, as an SQL expression.
_SPACE = " || ".join(f"chr({ord(c)})" for c in C.text.WHITESPACE)


# --- scalar functions ------------------------------------------------------------------

@query("""
select l_orderkey, l_linenumber, case when h > 0 then h || ':' || lpad(m::varchar, 2, '0') || ':'
    || lpad(s::varchar, 2, '0') else m || ':' || lpad(s::varchar, 2, '0') end as duration,
  h * 3600 + m * 60 + s as seconds
from (select l_orderkey, l_linenumber, l_partkey % 3 as h, l_suppkey % 60 as m,
  cast(l_quantity as bigint) as s from lineitem) t""")
def durations(spark, sf_dir):
    """ISO durations made of line items, to text and to seconds."""
    lines = tables.table(spark, sf_dir, "lineitem")
    h, m, s = F.col("l_partkey") % 3, F.col("l_suppkey") % 60, F.col("l_quantity").cast("bigint")
    iso = F.concat(
        F.lit("PT"), F.when(h > 0, F.concat(h.cast("string"), F.lit("H"))).otherwise(""),
        F.when(m > 0, F.concat(m.cast("string"), F.lit("M"))).otherwise(""),
        F.when(s > 0, F.concat(s.cast("string"), F.lit("S"))).otherwise(""),
    )
    text = lines.select("l_orderkey", "l_linenumber", C.iso_duration_text(iso).alias("duration"))
    return text.withColumn("seconds", C.duration_seconds(F.col("duration")))


@query("""
with v as (select o_orderkey, cast(floor(o_totalprice * case o_orderkey % 4 when 0 then 0e0 when 1 then 0.01e0
  when 2 then 1e0 else 1000e0 end) as bigint) as n from orders)
select o_orderkey,
  case when n >= 10000 then printf('%.1f', n / 10000e0) || '万' else n::varchar end as wan,
  case when n = 0 then 'N/A' when n >= 1000000 then printf('%.1f', n / 1000000e0) || 'M'
    when n >= 1000 then printf('%.1f', n / 1000e0) || 'K' else n::varchar end as mk,
  case when n = 0 then '—'
    when n >= 100000000 then (case when n % 50000000 = 25000000
      then printf('%.1f', n / 100000000e0 + 0.01e0) else printf('%.1f', n / 100000000e0) end) || '億'
    when n >= 10000000 then ((n + 5000000) // 10000000)::varchar || '千萬'
    when n >= 10000 then ((n + 5000) // 10000)::varchar || '萬'
    when n >= 1000 then (n // 1000)::varchar || ',' || lpad((n % 1000)::varchar, 3, '0')
    else n::varchar end as yi
from v""")
def view_formats(spark, sf_dir):
    """The three display forms of a count, over order totals."""
    k = F.col("o_orderkey") % 4
    scale = F.when(k == 0, F.lit(0).cast("double")).when(k == 1, 0.01).when(k == 2, 1.0).otherwise(
        1000.0
    )
    counts = tables.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") * scale).alias("n")
    )
    n = F.col("n")
    return counts.select(
        "o_orderkey", C.views_wan(n).alias("wan"), C.views_mk(n).alias("mk"), C.views_yi(n).alias("yi")
    )


@query(f"""
select page_id, trim(regexp_replace(html, '<[^>]+>', '', 'g'), {_SPACE}) as plain,
  replace(substr(html, 1, 300), chr(10), ' ') as short,
  trim(replace(replace(html, chr(10), ' '), '|', '\\|'), {_SPACE}) as escaped,
  trim(html, {_SPACE}) as unfenced
from pages""")
def text_functions(spark, sf_dir):
    """Tag stripping, shortening, escaping and fence stripping over whole pages."""
    pages = tables.table(spark, sf_dir, "pages")
    html = F.col("html")
    fenced = F.concat(F.lit(" ```html\n"), html, F.lit("\n```\n"))
    return pages.select(
        "page_id", C.strip_tags(html).alias("plain"),
        C.truncate_desc(html, V.VIDEO_DESCRIPTION_CHARS).alias("short"),
        C.escape_md(html).alias("escaped"), C.strip_fences(fenced).alias("unfenced"),
    )


_URLS = """urls as (
  select page_id, case page_id % 5
    when 0 then 'https://www.youtube.com/watch?v=' || page_id || 'a%20b&t=6#x'
    when 1 then 'https://youtu.be/' || page_id || '?t=30'
    when 2 then 'https://m.youtube.com/watch?list=z&v=id' || page_id
    when 3 then 'https://www.youtube.com/playlist?x=' || page_id
    else url end as url from pages)"""


@query(f"""with {_URLS} select page_id, url,
  case when contains(url, 'v=') then string_split(string_split(url, 'v=')[-1], '&')[1]
    when contains(url, 'youtu.be/') then string_split(string_split(url, 'youtu.be/')[-1], '?')[1]
    else '' end as simple_id,
  case page_id % 5 when 0 then page_id || 'a b' when 1 then page_id::varchar
    when 2 then 'id' || page_id end as parsed_id,
  regexp_extract(url, '//([^/?#]*)', 1) as host,
  'UU' || page_id || 'UC' as playlist
from urls""")
def video_ids(spark, sf_dir):
    """Both ways to read a video id, over page urls and urls made of page ids."""
    page, url = F.col("page_id").cast("string"), F.col("url")
    k = F.col("page_id") % 5
    made = F.when(
        k == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), page, F.lit("a%20b&t=6#x"))
    ).when(k == 1, F.concat(F.lit("https://youtu.be/"), page, F.lit("?t=30"))).when(
        k == 2, F.concat(F.lit("https://m.youtube.com/watch?list=z&v=id"), page)
    ).when(k == 3, F.concat(F.lit("https://www.youtube.com/playlist?x="), page)).otherwise(url)
    pages = tables.table(spark, sf_dir, "pages").select("page_id", made.alias("url"))
    return pages.select(
        "page_id", "url", C.video_id_simple(url).alias("simple_id"),
        C.video_id_parsed(url).alias("parsed_id"), C.url_host(url).alias("host"),
        C.uploads_playlist_id(F.concat(F.lit("UC"), page, F.lit("UC"))).alias("playlist"),
    )


@query("""
select event_id, case when event_id % 10 = 0 then '' else strftime(ts, '%Y-%m-%d') end as day,
  case when event_id % 10 = 0 then '—' else strftime(ts, '%Y-%m') end as month
from events""")
def dates(spark, sf_dir):
    """Epoch seconds to dates and months, over event times."""
    epoch = F.when(F.col("event_id") % 10 != 0, F.unix_seconds(F.col("ts").cast("timestamp")))
    events = tables.table(spark, sf_dir, "events").select(
        "event_id", C.epoch_to_date(epoch).alias("day")
    )
    return events.withColumn("month", C.year_month(F.col("day")))


@query("""select p_partkey, replace(replace(lower('Dr. ' || p_name || ' X'), ' ', '_'), '.', '')
  as slug from part""")
def slugs(spark, sf_dir):
    name = F.concat(F.lit("Dr. "), "p_name", F.lit(" X"))
    return tables.table(spark, sf_dir, "part").select("p_partkey", C.slug(name).alias("slug"))


_KEY = """case when source = 'youtube' then 'yt:' || string_split(string_split(url, 'v=')[2], '&')[1]
  when source = 'bilibili' then 'bili:' || bvid else 'url:' || url end"""
_RICH = """least(floor(coalesce(nullif(view_count, 0), play_count, 0) / 1000), 100)
  + (title <> '')::int + coalesce((channel <> '')::int, 0) + coalesce((author <> '')::int, 0)
  + coalesce((description <> '')::int, 0) + coalesce((published_at <> '')::int, 0)
  + coalesce((duration <> '')::int, 0) + case when verified then 5 else 0 end"""


@query(with_ctes("items", f"""select {_ROW}, {_KEY} as batch_key, {_KEY} as catalog_key,
  cast({_RICH} as bigint) as richness, {WHO} as who,
  coalesce(nullif(view_count, 0), play_count) as plays,
  case when not verified and coalesce(verify_status, 0) = 0 then '⚠️' else '' end as table_mark,
  case when not coalesce(verified, false) and verify_status = 0 then '⚠️' else '' end
    as browser_mark
from items"""))
def item_functions(spark, sf_dir):
    """Keys, richness, fallbacks and marks of every item."""
    key = [F.col("url"), F.col("bvid"), F.col("source")]
    return tables.items(spark, sf_dir).select(
        "profile", "file_id", "ord", C.batch_key(*key).alias("batch_key"),
        C.catalog_key(*key).alias("catalog_key"), C.richness().alias("richness"),
        C.who().alias("who"), C.views().alias("plays"),
        C.table_mark(F.col("verified"), F.col("verify_status")).alias("table_mark"),
        C.browser_mark(F.col("verified"), F.col("verify_status")).alias("browser_mark"),
    )


# --- payloads: documents packed as the platforms would answer, then normalised ------------

def _documents(spark, sf_dir) -> DataFrame:
    return tables.table(spark, sf_dir, "documents")


def _packed(documents: DataFrame, payload) -> DataFrame:
    return documents.select("doc_id", F.to_json(payload).alias("payload"))


@query("""
select doc_id, cast(line_no as int) as pos, line as title,
  'https://www.youtube.com/watch?v=' || doc_id || 'x' || line_no as url, source as channel,
  substr(line, 1, 300) as description, '2020-01-02' as published_at,
  case when doc_id % 3 = 0 then 0 else length(line) end as view_count,
  ((doc_id + line_no) % 60) || ':07' as duration, true as verified
from """ + tables.LINES_SQL + " t")
def norm_video_details(spark, sf_dir):
    """An answer per document with a hit per line."""
    documents = _documents(spark, sf_dir)

    def hit(line, i):
        snippet = F.struct(
            line.alias("title"), F.col("source").alias("channelTitle"), line.alias("description"),
            F.lit("2020-01-02T03:04:05Z").alias("publishedAt"),
        )
        minutes = F.concat(F.lit("PT"), ((F.col("doc_id") + i) % 60).cast("string"), F.lit("M7S"))
        count = F.when(F.col("doc_id") % 3 != 0, F.length(line).cast("string"))
        return F.struct(
            F.concat(F.col("doc_id").cast("string"), F.lit("x"), i.cast("string")).alias("id"),
            snippet.alias("snippet"), F.struct(count.alias("viewCount")).alias("statistics"),
            F.struct(minutes.alias("duration")).alias("contentDetails"),
        )

    hits = F.transform(F.split("text", "\n"), hit)
    packed = _packed(documents, F.struct(hits.alias("items")))
    return payloads.norm_video_details(packed)


@query("""
select doc_id, cast(1 + doc_id % 4 as int) as page_no, cast(line_no as int) as pos, line as title,
  'https://www.youtube.com/watch?v=' || doc_id || '-' || line_no as url, doc_id || '-' || line_no as video_id,
  source as channel, substr(line, 1, 300) as description,
  case when doc_id % 2 = 0 then '2021-12-31' else '' end as published_at, true as verified,
  'channel_crawl' as source
from """ + tables.LINES_SQL + " t where lang <> 'fr'")
def norm_playlist(spark, sf_dir):
    """A page per document with an upload per line; hits without an id are dropped."""
    def upload(line, i):
        snippet = F.struct(
            line.alias("title"), F.col("source").alias("channelTitle"), line.alias("description"),
            F.when(F.col("doc_id") % 2 == 0, "2021-12-31T00:00:00Z").alias("publishedAt"),
        )
        video = F.when(F.col("lang") != "fr", F.concat(F.col("doc_id").cast("string"), F.lit("-"), i.cast("string")))
        return F.struct(snippet.alias("snippet"), F.struct(video.alias("videoId")).alias("contentDetails"))

    hits = F.transform(F.split("text", "\n"), upload)
    pages = _documents(spark, sf_dir).select(
        "doc_id", (F.col("doc_id") % 4 + 1).cast("int").alias("page_no"),
        F.to_json(F.struct(hits.alias("items"))).alias("payload"),
    )
    return payloads.norm_playlist(pages)


@query("""
select page_id, url as title, url, html as snippet, '' as date, cast(null as boolean) as verified
from pages""")
def norm_web(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    hit = F.struct(F.col("url").alias("title"), F.col("url").alias("link"), F.col("html").alias("snippet"))
    listed = F.array(hit)
    packed = pages.select("page_id", F.to_json(F.struct(listed.alias("organic"))).alias("payload"))
    return payloads.norm_web(packed).drop("pos")


@query(f"""
select page_id, trim(regexp_replace('<em class="k">' || url || '</em> ', '<[^>]+>', '', 'g'),
    {_SPACE}) as title,
  'https://www.bilibili.com/video/BV' || page_id as url, 'BV' || page_id as bvid,
  page_id * 3 as play_count, 'author' || page_id % 7 as author,
  substr(trim(regexp_replace(html, '<[^>]+>', '', 'g'), {_SPACE}), 1, 250) as description,
  case when page_id % 3 = 0 then '' else strftime(to_timestamp(1500000000 + page_id * 86400)
    at time zone 'UTC', '%Y-%m-%d') end as published_at,
  '3:' || lpad((page_id % 60)::varchar, 2, '0') as duration, cast(null as boolean) as verified
from pages where not contains(url, '#')""")
def norm_bili(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    page = F.col("page_id")
    item = F.struct(
        F.when(~F.contains("url", F.lit("#")), F.concat(F.lit("BV"), page.cast("string"))).alias("bvid"),
        F.concat(F.lit('<em class="k">'), "url", F.lit("</em> ")).alias("title"),
        (page * 3).alias("play"), F.concat(F.lit("author"), (page % 7).cast("string")).alias("author"),
        F.col("html").alias("description"),
        F.when(page % 3 == 0, 0).otherwise(page * 86400 + 1500000000).alias("pubdate"),
        F.format_string("3:%02d", page % 60).alias("duration"),
    )
    answer = F.struct(F.lit(0).alias("code"), F.struct(F.array(item).alias("result")).alias("data"))
    return payloads.norm_bili(pages.select("page_id", F.to_json(answer).alias("payload"))).drop("pos")


# --- raw batches and duplicates ---------------------------------------------------------

_RAW = """raw as (
  select lang as profile, cast(doc_id as int) as file_id,
    ((i - 1) // 3) * 4294967296 + (i - 1) % 3 as ord, l[i] as title,
    ['youtube', 'bilibili', 'google'][1 + ((i - 1) // 3) % 3] as source,
    'query ' || ((i - 1) // 3) as search_query,
    'https://www.youtube.com/watch?v=' || md5(l[i]) || '&t=7' as url,
    case when length(l[i]) % 4 <> 0 then md5(l[i]) end as bvid
  from (select doc_id, lang, l, unnest(range(1, len(l) + 1)) as i
    from (select doc_id, lang, string_split(text, chr(10)) as l from documents) a) b)"""


@query(f"with {_RAW} select {_ROW}, title, source, search_query, url, bvid from raw")
def raw_items(spark, sf_dir):
    """Nested search batches, one file per document, to item rows with their order."""
    raw = files.explode_raw(tables.raw_files(spark, sf_dir))
    return raw.select("profile", "file_id", "ord", "title", "source", "search_query", "url", "bvid")


@query(f"""with {_RAW},
keyed as (select *, case when source = 'youtube' then 'yt:' || md5(title)
    when source = 'bilibili' then 'bili:' || bvid else 'url:' || url end as k from raw)
select {_ROW}, source, search_query, url from (
  select *, row_number() over (partition by profile, file_id, k order by ord) as rn from keyed) r
where rn = 1 or k is null""")
def dedup_first(spark, sf_dir):
    raw = files.explode_raw(tables.raw_files(spark, sf_dir))
    return dedup.dedup_first(raw).select(
        "profile", "file_id", "ord", "source", "search_query", "url"
    )


_KEYED = f"keyed as (select *, {_KEY} as k, cast({_RICH} as bigint) as rich from items)"


@query(with_ctes("items", """select r.profile, f.file_id, f.ord, r.original_file_id, r.url, r.title
from (select *, row_number() over (partition by profile, k order by rich desc, file_id, ord) as rn
  from keyed) r
join (select profile, k, file_id, ord, row_number() over (
  partition by profile, k order by file_id, ord) as rn from keyed) f
on f.profile = r.profile and f.k = r.k and f.rn = 1 where r.rn = 1""", _KEYED))
def dedup_richest(spark, sf_dir):
    return dedup.dedup_richest(tables.items(spark, sf_dir)).select(
        "profile", "file_id", "ord", "original_file_id", "url", "title"
    )


@query(with_ctes("items", """select profile, count(*) as n_items, count(distinct k) as n_keys,
  count(*) - count(distinct k) as n_removed from keyed group by profile""", _KEYED))
def dup_count(spark, sf_dir):
    return dedup.dup_count(tables.items(spark, sf_dir))


@query(with_ctes("items", f"""select {_ROW}, row_number() over (
  partition by profile, case when source in ('youtube', 'bilibili') then source else 'web' end, k
  order by file_id, ord) > 1 as duplicate from keyed""", _KEYED))
def mark_duplicates(spark, sf_dir):
    return dedup.mark_duplicates(tables.items(spark, sf_dir)).select(
        "profile", "file_id", "ord", "duplicate"
    )


@query(with_ctes("items", f"""select {_ROW}, video_id from (select *, row_number() over (
  partition by profile, video_id order by file_id, ord) as rn from items where video_id <> '') r
where rn = 1"""))
def dedup_across_channels(spark, sf_dir):
    return dedup.dedup_across_channels(tables.items(spark, sf_dir)).select(
        "profile", "file_id", "ord", "video_id"
    )


_KNOWN = f"""known as (select distinct i.profile, i.video_id from items i
  join labels l on l.doc_id = i.ord >> {tables.LINE_SHIFT} where video_id <> ''),
flagged as (select i.*, k.video_id is not null as known from items i
  left join known k on k.profile = i.profile and k.video_id = i.video_id)"""


def _flagged(spark, sf_dir) -> DataFrame:
    """All documents as a crawl against a catalogue of the labelled ones."""
    items = tables.items(spark, sf_dir)
    marks = tables.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_doc"))
    labelled = items.withColumn("_doc", tables.document_of(F.col("ord"))).join(marks, "_doc", "left_semi")
    return dedup.flag_known(items, labelled.drop("_doc"))


@query(with_ctes("items", f"select {_ROW}, known from flagged", _KNOWN))
def split_new_known(spark, sf_dir):
    return _flagged(spark, sf_dir).select("profile", "file_id", "ord", "known")


@query(with_ctes("items", """select profile, count(*) as total_uploads,
  count(*) filter (not known) as new_videos, count(*) filter (known) as already_known
from flagged group by profile""", _KNOWN))
def crawl_summary(spark, sf_dir):
    return files.crawl_summary(_flagged(spark, sf_dir))


# --- the flow from items to the catalogue -------------------------------------------------

_UNIQUE = f"""all_items as ({items_sql()}),
all_keyed as (select *, {_KEY} as k, cast({_RICH} as bigint) as rich from all_items),
items as (
  select r.* exclude (file_id, ord, original_file_id, k, rich, rn), f.file_id, f.ord,
    r.file_id as original_file_id
  from (select *, row_number() over (partition by profile, k order by rich desc, file_id, ord) as rn
    from all_keyed) r
  join (select profile, k, file_id, ord, row_number() over (
    partition by profile, k order by file_id, ord) as rn from all_keyed) f
  on f.profile = r.profile and f.k = r.k and f.rn = 1 where r.rn = 1)"""


def _refreshed(spark, sf_dir) -> DataFrame:
    unique = dedup.dedup_richest(tables.items(spark, sf_dir))
    return classify_items(unique, tables.profiles(spark))


@query(with_ctes("filtered", f"""select {_ROW}, original_file_id, category, classification_reason,
  confidence, url from filtered""", items=_UNIQUE))
def catalog_refresh(spark, sf_dir):
    """Unique items, classified, scored and filtered in one plan."""
    return _refreshed(spark, sf_dir).select(
        "profile", "file_id", "ord", "original_file_id", "category", "classification_reason",
        "confidence", "url",
    )


@query(with_ctes("filtered", """select profile, category, count(*) as n,
  count(distinct original_file_id) as n_files, max(plays) as most_plays
from filtered group by profile, category""", items=_UNIQUE))
def unique_items_per_category(spark, sf_dir):
    return _refreshed(spark, sf_dir).groupBy("profile", "category").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("original_file_id").alias("n_files"),
        F.max(C.views()).alias("most_plays"),
    )


@query("""
select lang as profile, cast(doc_id as int) as file_id, i - 1 as ord, l[i] as title,
  'https://example.org/' || md5(l[i]) as url, cast(doc_id as int) as original_file_id
from (select doc_id, lang, l, unnest(range(1, len(l) + 1)) as i
  from (select doc_id, lang, string_split(text, chr(10)) as l from documents) a) b""")
def catalog_items(spark, sf_dir):
    """Nested catalogue files, one per document with its lines as results, to item rows."""
    results = F.transform(F.split("text", "\n"), lambda line: F.struct(
        line.alias("title"), F.concat(F.lit("https://example.org/"), F.md5(line)).alias("url"),
        F.lit(None).cast("int").alias("original_file_id"),
    ))
    nested = _documents(spark, sf_dir).select(
        F.col("lang").alias("profile"), F.col("doc_id").cast("int").alias("file_id"),
        results.alias("results"),
    )
    return files.explode_catalog(nested).select(
        "profile", "file_id", "ord", "title", "url", "original_file_id"
    )


@query("""
select distinct doc_id, md5(line) as url,
  ['approve', 'reject', 'skip'][1 + length(line) % 3] as action,
  timestamp '2024-01-02 03:04:05' as decided_at
from (select doc_id, unnest(string_split(text, chr(10))) as line from documents) t""")
def decision_rows(spark, sf_dir):
    """Review state files, one per document with its lines as urls, to decision rows."""
    lines = F.array_distinct(F.split("text", "\n"))
    actions = F.array(F.lit("approve"), F.lit("reject"), F.lit("skip"))
    state = F.map_from_arrays(
        F.transform(lines, F.md5), F.transform(lines, lambda x: F.get(actions, F.length(x) % 3))
    )
    return files.explode_decisions(_documents(spark, sf_dir).select(
        "doc_id", state.alias("reviewed"), F.lit("2024-01-02T03:04:05").alias("session_start")
    ))


# --- link checks: item urls, with a status per url as a probe would report it ----------

_STATUSES = [200, 301, 404, 0, 500, 206]


def _checks(spark, sf_dir) -> DataFrame:
    """Two probes per distinct url of the items; the second one counts."""
    urls = tables.items(spark, sf_dir).select("url").distinct()
    statuses = F.array(*[F.lit(s) for s in _STATUSES])
    second = F.get(statuses, F.conv(F.substring(F.md5("url"), 1, 4), 16, 10).cast("int") % 6)
    probes = F.array(
        F.struct(F.lit(503).alias("status"), F.lit("").alias("note"), F.lit(1).alias("checked_at")),
        F.struct(
            second.alias("status"), F.when(second == 0, "timeout").otherwise("").alias("note"),
            F.lit(2).alias("checked_at"),
        ),
    )
    return urls.select("url", F.inline(probes))


def _hex(text: str) -> str:
    digits = "'0123456789abcdef'"
    return " + ".join(
        f"(instr({digits}, substr({text}, {i + 1}, 1)) - 1) * {16 ** (3 - i)}" for i in range(4)
    )


_VERDICTS = f"""checks as (
  select url, {_STATUSES}[1 + cast({_hex('md5(url)')} as int) % 6] as status
  from (select distinct url from items) u),
verdicts as (
  select url, status, case when not starts_with(url, 'http') then false
      when contains(url, 'youtube.com/watch') then true
      else status in (200, 206, 301, 302, 303, 307, 308) end as valid,
    case when not starts_with(url, 'http') then 0 when contains(url, 'youtube.com/watch') then 200
      else status end as code,
    case when not starts_with(url, 'http') then 'invalid URL format'
      when contains(url, 'youtube.com/watch') then 'YouTube API verified'
      when status in (200, 206, 301, 302, 303, 307, 308) then ''
      when status = 0 then 'timeout' else 'HTTP ' || status end as note
  from checks),
merged as (
  select i.* exclude (verified, verify_status, verify_note),
    case when asked then v.valid else true end as verified,
    case when asked then v.code else i.verify_status end as verify_status,
    case when asked then v.note end as verify_note
  from (select *, source <> 'youtube' and starts_with(url, 'http') as asked from items) i
  join verdicts v on v.url = i.url where not asked or v.valid or v.code = 0)"""


@query(with_ctes("items", f"""select {_ROW}, url, cast(floor((row_number() over (
  partition by profile, file_id order by ord) - 1) / 50) as bigint) as chunk
from items where source <> 'youtube' and starts_with(url, 'http')"""))
def links_to_check(spark, sf_dir):
    return links.links_to_check(tables.items(spark, sf_dir))


@query(with_ctes("items", "select url, valid, code as status, note from verdicts", _VERDICTS))
def link_verdict(spark, sf_dir):
    latest = _checks(spark, sf_dir).filter("checked_at = 2")
    verdict = links.link_verdict(F.col("url"), F.col("status"), F.col("note"))
    return latest.select("url", verdict.alias("v")).select("url", "v.*")


def _merged(spark, sf_dir) -> DataFrame:
    return links.apply_link_checks(tables.items(spark, sf_dir), _checks(spark, sf_dir))


@query(with_ctes(
    "items", f"select {_ROW}, verified, verify_status, verify_note from merged", _VERDICTS
))
def apply_link_checks(spark, sf_dir):
    return _merged(spark, sf_dir).select(
        "profile", "file_id", "ord", "verified", "verify_status", "verify_note"
    )


@query(with_ctes("items", """select profile, count(*) as n_items,
  count(*) filter (verified) as n_verified, count(*) filter (not verified) as n_unverified
from merged group by profile""", _VERDICTS))
def verify_counts(spark, sf_dir):
    return links.verify_counts(_merged(spark, sf_dir))
