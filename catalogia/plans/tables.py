"""Item, profile and dimension views over the supplied tables.

The tables hold no media catalogue, so each view is one projection that reads a whole
table.  Projections are plain SQL text that other engines can repeat word for word.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from catalogia import fixed_values as V
from catalogia.operators.distribution import dealt
from catalogia.operators.querygen import entry_sql
from catalogia.schema import PROFILE
from catalogia.sources.profiles import parse_profiles

LANGS = ["en", "de", "es", "fr"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _profile(primary, english, alias, group, tracks, ost, concert, shows, collabs):
    """A small profile document; words are ones that occur in the documents."""
    return {
        "artist": {
            "names": {"primary": primary, "english": english, "aliases": [alias]},
            "official_channels": ["src0", "src1"], "labels": ["src2", "src3"],
            "birth_year": 1980, "genre": "Pop", "awards": ["First Award"], "social_links": {},
            "channels": [],
        },
        "group": group and {
            "name": group[0], "aliases": group[1], "members": [], "member_names": [],
        },
        "discography": {
            "solo_albums": [
                {"name": f"{english} I", "year": 2010, "tracks": tracks[:2]},
                {"name": f"{english} II", "year": 2012, "tracks": tracks[2:]},
            ],
            "ost_singles": [{"name": n, "source": s, "year": 2015} for n, s in ost],
            "variety_show_singles": [{"name": f"{alias} single", "source": shows[0][0], "year": 2017}],
            "concerts": [{"name": concert[0], "years": "2016", "aliases": concert[1], "venues": []}],
            "group_concerts": [{"name": f"SHE {concert[0][::-1]} Land", "years": "2006"}]
            if group else [],
            "variety_shows": [{"name": n, "network": w} for n, w in shows],
            "collaborators": [{"name": n, "aliases": a, "songs": s} for n, a, s in collabs],
            "group_mvs": [f"Super {alias}", "Two Part"] if group else [],
            "venues": [], "interview_channels": [], "notable_interviewers": [],
            "western_artist_blacklist": ["ive", "Other Star"],
            "other_chinese_artist_blacklist": ["别的歌手"],
            "wrong_context_patterns": ["Wrong Place"],
        },
        "categories": [
            {"id": i, "key": k, "label": f"{k} of {primary}", "sub": k.upper(),
             "output_path": f"{k}.md", "description": f"About {k}"}
            for i, k in (
                (2, "personal_mv"), (3, "ost_singles"), (4, "concerts"), (5, "variety"),
                (6, "interviews"), (7, "group_mv"), (8, "collabs"),
            )
        ],
        "classification": {"priority": ["personal_mv"]},
    }


PROFILES = {
    "en": _profile(
        "Eriner", "Attion Ray", "thanea", ("Onth Band", ["OTB"]),
        ["thanedble", "Nerth Day", "Red Ou", "Shedan"],
        [("thre", "Thon Film"), ("Nerth Day", "Hand Film"), ("Lone Ou", "")],
        ("Onea World", ["O.W. Tour"]), [("thing", "Net One"), ("Erin Show", "")],
        [("Reedan", ["R. Ed"], ["Duo Song"]), ("Hesh", [], ["Con Fide", "thble"]),
         ("Reedan", [], ["Late Song"])],
    ),
    "de": _profile(
        "Nichtan", "Sich Ember", "aulich", ("Kein Trio", ["KTR"]),
        ["erüver", "Ungö Lied", "Tag Heit", "Enschau"],
        [("geheit", "Bever Film"), ("Ungö Lied", "Haus Film"), ("Allein", "")],
        ("Einbe Welt", ["E.W. Reise"]), [("schtz", "Netz Eins"), ("Abend Show", "")],
        [("Verch", ["V. Ch"], ["Duett"]), ("Lichü", [], ["Zwei", "enach"])],
    ),
    "es": _profile(
        "Osga", "Para Cimi", "ciónja", None,
        ["ciónll", "Arez Luz", "Mente Sol", "Asra"],
        [("ciónie", "Cine Uno"), ("Arez Luz", "Cine Dos"), ("Sola", "")],
        ("Mundo Ción", ["M.C. Gira"]), [("asci", "Red Uno"), ("Noche Show", "")],
        [("Ciue", ["C. Ue"], ["Dueto"]), ("Osdo", [], ["Dos", "ciónado"])],
    ),
    "fr": _profile(
        "Eauoué", "Avec Dans", "réleou", ("Trio Ouier", ["TOU"]),
        ["enmentai", "Aile Jour", "Lement Nuit", "Oument"],
        [("laleenéelle", "Film Un"), ("Aile Jour", "Film Deux"), ("Seule", "")],
        ("Monde Aivi", ["M.A. Tour"]), [("ouieré", "Chaine Un"), ("Soir Show", "")],
        [("Treau", ["T. Eau"], ["Duo"]), ("Pachque", [], ["Deux", "étion"])],
    ),
}

# Title endings, one per document in turn, so that every rule meets every profile.
MARKERS = [
    "", "Official MV", "MV", "Music  Video", "lyric video", "Live", "concert", "演唱会", "feat. X",
    "合唱", "第3期", "EP12", "专访", "interview 演唱", "花絮", "新闻", "跨年", "颁奖 现场", "小巨蛋 现场",
    "Legacy live", "单曲", "digital", "reaction", "ktv", "浙江卫视", "官方 MV", "全场 live", "ost",
    "press  conference", "a | b", "- Topic",
]


def _endings(p: dict) -> list[str]:
    """Dictionary entries of a profile, alone and combined, that titles carry in turn."""
    d, names = p["discography"], p["artist"]["names"]
    who, track = names["primary"], d["solo_albums"][0]["tracks"][0]
    both = d["solo_albums"][0]["tracks"][1]
    ost, alone = d["ost_singles"][0], d["ost_singles"][2]
    concert, collab, second = d["concerts"][0], d["collaborators"][0], d["collaborators"][1]
    group = p["group"]["name"] if p["group"] else "No Band"
    group_track = d["group_mvs"][0] if d["group_mvs"] else "No Part"
    short = d["group_concerts"][0]["name"][4:] if d["group_concerts"] else "No Land"
    return [
        "", who, names["english"].upper(), track, f"{who} {track}", both, f"{who} {both}",
        f"{both} {d['ost_singles'][1]['source']}", ost["name"], f"{ost['name']} {ost['source']}",
        f"{who} {alone['name']}", group, f"{group} {group_track}", group_track.lower(),
        concert["name"], f"{track} {concert['aliases'][0].lower()}", short,
        d["variety_shows"][1]["name"], f"{who} {d['variety_shows'][0]['name']}",
        f"{collab['name']} {collab['songs'][0]}", f"{who} {collab['aliases'][0].lower()}",
        second["songs"][0], d["variety_show_singles"][0]["name"], "other star", f"{who} live",
        "别的歌手", f"{track} {alone['name']}", f"{group} {who}", d["variety_shows"][0]["network"],
        "wrong place",
    ]


def _pick(values: list[str], index: str) -> str:
    joined = ";".join(values).replace("'", "''")
    return f"split_part('{joined}', ';', cast(1 + {index} as int))"


# Every line of every document, for other engines; ``lines`` is the same as a DataFrame.
LINES_SQL = """(select doc_id, lang, source, i - 1 as line_no, l[i] as line
  from (select doc_id, lang, source, l, unnest(range(1, len(l) + 1)) as i
    from (select doc_id, lang, source, string_split(text, chr(10)) as l from documents) a) b)"""
# Place of a line among all: document in the upper half, line in the lower.
LINE_SHIFT = 32


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, line_no, line) of every line of every document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def document_of(ord_: Column) -> Column:
    """The document of an item's place."""
    return F.shiftright(ord_, LINE_SHIFT)


def items_sql(lines: str = LINES_SQL) -> str:
    """Item rows, one per line of a document: the title is the line with an ending and a marker,
    the description the line itself; equal lines share video id and url."""
    endings = " ".join(
        f"when '{lang}' then "
        + _pick(_endings(PROFILES[lang]), f"floor(n / {len(MARKERS)}) % 30")
        for lang in LANGS
    )
    marker = _pick(MARKERS, f"n % {len(MARKERS)}")
    return f"""
select lang as profile, cast(2 + n % 7 as int) as file_id, doc_id * {1 << LINE_SHIFT} + line_no as ord,
  line || ' ' || ending || ' ' || marker as title,
  case when kind = 0 then 'https://www.youtube.com/watch?v=' || vid || '&t=' || cast(n as string)
       when kind = 1 then 'https://www.bilibili.com/video/' || vid
       when n % 5 = 0 then 'ftp://example.org/' || vid
       else 'https://example.org/' || vid end as url,
  case when kind = 0 then 'youtube' when kind = 1 then 'bilibili' else 'google' end as source,
  case when kind = 1 then vid end as bvid,
  case when kind = 0 then vid else '' end as video_id,
  case when kind = 0 then source when kind = 2 and n % 13 = 0 then 'ETtoday' end as channel,
  case when kind = 1 then source when n % 17 = 0 then source || ' - Topic' end as author,
  line as description,
  case when kind = 2 then line end as snippet,
  case when n % 10 <> 3 then '20' || cast(10 + n % 14 as string) || '-'
    || lpad(cast(1 + n % 12 as string), 2, '0') || '-'
    || lpad(cast(1 + n % 28 as string), 2, '0') end as published_at,
  case when n % 3 = 0 then '2020-01-0' || cast(1 + n % 9 as string) end as date,
  case when n % 19 = 0 then null
       when seconds >= 3600 then cast(cast(floor(seconds / 3600) as bigint) as string) || ':'
         || lpad(cast(cast(floor(seconds % 3600 / 60) as bigint) as string), 2, '0') || ':'
         || lpad(cast(seconds % 60 as string), 2, '0')
       else cast(cast(floor(seconds / 60) as bigint) as string) || ':'
         || lpad(cast(seconds % 60 as string), 2, '0') end as duration,
  case when kind <> 1 and n % 11 <> 0 then plays end as view_count,
  case when kind = 1 and n % 11 <> 0 then plays end as play_count,
  case when n % 9 = 0 then null else n % 4 <> 0 end as verified,
  case when n % 6 = 0 then 0 when n % 7 = 0 then 404 end as verify_status,
  cast(null as string) as verify_note,
  cast(null as string) as search_query,
  cast(2 + n % 7 as int) as original_file_id
from (
  select *, instr('0123456789abcdef', substr(vid, 1, 1)) % 3 as kind,
    case when n % 8 = 0 then n * 17 % 16000
         when n % 2 = 0 then n * 7 % 600 else n * 37 % 9000 end as seconds,
    case when n % 5 = 0 then n * 37 % 1500 else n * 7919 % 2000000 end as plays,
    {marker} as marker,
    case lang {endings} end as ending
  from (select doc_id, lang, source, line_no, line, doc_id + 11 * line_no as n, md5(line) as vid from {lines} t) l
) d"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(items_sql("{lines}"), lines=lines(spark, sf_dir))


def profiles(spark: SparkSession) -> DataFrame:
    """The four small profile documents, one per language of the documents."""
    rows = json.dumps([{"profile": lang, **PROFILES[lang]} for lang in LANGS], ensure_ascii=False)
    parsed = F.from_json(F.lit(rows), T.ArrayType(PROFILE))
    return spark.range(1, numPartitions=1).select(F.inline(parsed))


# Names as a large profile would list them: the last word of each line, if it has nine letters or more.
LONG_WORD = "([A-Za-zÀ-ÖØ-öø-ÿ]{9,})[^A-Za-zÀ-ÖØ-öø-ÿ]*$"
LONG_WORDS_SQL = f"""(select distinct lang as profile, regexp_extract(line, '{LONG_WORD}', 1) as term
  from {LINES_SQL} t where regexp_matches(line, '{LONG_WORD}'))"""


def long_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(profile, term): one large dictionary per profile, read from all lines."""
    return lines(spark, sf_dir).filter(F.rlike("line", F.lit(LONG_WORD))).select(
        F.col("lang").alias("profile"), F.regexp_extract("line", LONG_WORD, 1).alias("term")).distinct()


def large_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small profiles with an album more, whose tracks are the long words."""
    words = long_words(spark, sf_dir).groupBy("profile").agg(F.sort_array(F.collect_list("term")).alias("words"))
    album = F.struct(F.lit("Long words").alias("name"), F.lit(2020).alias("year"), F.col("words").alias("tracks"))
    more = F.concat("discography.solo_albums", F.array(album))
    return profiles(spark).join(words, "profile").withColumn(
        "discography", F.col("discography").withField("solo_albums", more)).drop("words")


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw files from the lines of each document, built inside its own row."""
    documents = table(spark, sf_dir, "documents")

    def hit(line):
        vid = F.md5(line)
        return F.struct(
            line.alias("title"),
            F.concat(F.lit("https://www.youtube.com/watch?v="), vid, F.lit("&t=7")).alias("url"),
            F.when(F.length(line) % 4 != 0, vid).alias("bvid"),
            F.lit(None).cast("string").alias("source"),
            F.lit(None).cast("string").alias("search_query"),
        )

    tools = F.array(F.lit("youtube"), F.lit("bilibili"), F.lit("google"))
    lines = F.split("text", "\n")
    starts = F.sequence(F.lit(1), F.size(lines), F.lit(3))
    batches = F.transform(starts, lambda s, i: F.struct(
        F.element_at(tools, (i % 3 + 1).cast("int")).alias("tool"),
        F.concat(F.lit("query "), i.cast("string")).alias("query"), F.lit(1).alias("page"),
        F.transform(F.slice(lines, s, F.lit(3)), hit).alias("results"),
    ))
    return documents.select(
        F.col("lang").alias("profile"), F.col("doc_id").cast("int").alias("file_id"),
        batches.alias("searches"),
    )


CATEGORY_KEYS = [*V.CATEGORY_FILE_IDS, "extra"]


# The lists that parts and their suppliers make, as entries: each table is read once for all of them.
_PART_ENTRIES = ", ".join([
    entry_sql("tracks", "substr(p_brand, 7)", "p_partkey", album="p_brand", track="p_name"),
    entry_sql("ost", "p_partkey", name="p_name", source="case p_size % 3 when 0 then '' when 1 then p_name else p_brand end"),
    entry_sql("variety_singles", "p_partkey", name="p_name", source="case when p_type = 'PROMO' then '' else p_brand end"),
    entry_sql("concerts", "p_partkey", name="p_name || ' Tour'"),
    f"if(p_size > 25, {entry_sql('concert_aliases', 'p_partkey', alias='p_brand')}, null)",
    entry_sql("concert_venues", "p_partkey", "p_size", venue="p_brand || ' Hall'",
              short_name="case when p_size > 25 then p_brand else p_name || ' Tour' end"),
    entry_sql("group_concerts", "p_partkey", name="p_name || ' Group Tour'"),
    entry_sql("collabs", "p_partkey", name="p_brand || ' ' || p_name", n_songs="p_size % 3"),
    f"""if(p_size % 3 > 0, {entry_sql('collab_songs', 'p_partkey', collab="p_brand || ' ' || p_name", song="p_name || ' Duet'")}, null)""",
    entry_sql("collab_aliases", "p_partkey", alias="p_brand"),
    entry_sql("group_mvs", "p_partkey", track="p_name"),
])
_ALBUM_ENTRY = entry_sql("albums", "substr(p_brand, 7)", album="p_brand", year="1990 + cast(substr(p_brand, 7) as int)")
_SUPPLIER_ENTRIES = ", ".join([
    entry_sql("aliases", "n_nationkey", alias="n_name"),
    entry_sql("shows", "s_suppkey", name="s_name",
              network="case when s_nationkey % 2 = 0 then '' else 'Net ' || cast(s_nationkey as string) end"),
    f"if(profile <> 'LARGE', {entry_sql('interviewers', 'r_regionkey', name='r_name')}, null)",
    entry_sql("interview_channels", "n_nationkey", name="n_name || ' TV'"),
])


def part_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of all kinds from the part, lineitem, supplier, nation and region tables."""
    names = ("part", "supplier", "nation", "region", "lineitem")
    part, supplier, nation, region, lineitem = (table(spark, sf_dir, t) for t in names)

    def listed(structs):
        return F.inline(F.expr(f"filter(array({structs}), e -> e is not null)"))

    parts = part.select(F.col("p_type").alias("profile"), "p_brand", "p_name", "p_partkey", "p_size", "p_type")
    own = dealt(parts).select("profile", listed(_PART_ENTRIES))
    albums = parts.select("profile", "p_brand").distinct().select("profile", listed(_ALBUM_ENTRY))
    supply = lineitem.join(part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("p_type").alias("profile"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    placed = supply.join(supplier, "s_suppkey").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).join(
        region, F.col("r_regionkey") == F.col("n_regionkey"))
    return own.unionByName(albums).unionByName(placed.select("profile", listed(_SUPPLIER_ENTRIES)).distinct())


def part_generation(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What query generation needs of those tables."""
    heads = part_dims(spark, sf_dir, "profiles", "categories")
    return {"entries": part_entries(spark, sf_dir), **heads}


def part_dims(spark: SparkSession, sf_dir: str, *wanted: str) -> dict[str, DataFrame]:
    """Profile dimensions from the part, lineitem, supplier, nation and region tables: the named ones, or all."""
    names = ("part", "supplier", "nation", "region", "lineitem")
    sources = {t: table(spark, sf_dir, t) for t in names}
    found = {}
    for name, sql in DIMS_SQL.items():
        if wanted and name not in wanted:
            continue
        used = {t: df for t, df in sources.items() if "{" + t + "}" in sql}
        found[name] = spark.sql(sql, **used)
    listed = F.posexplode(F.array(*[F.lit(k) for k in CATEGORY_KEYS]))
    key = F.col("key")
    found["categories"] = (
        sources["part"].select(F.col("p_type").alias("profile")).distinct()
        .select("profile", listed.alias("pos", "key")).select(
            "profile", "pos", (F.col("pos") + 2).alias("id"), "key",
            F.concat(F.lit(" "), key).alias("label"), F.concat(key, F.lit(".md")).alias("output_path"),
            F.concat(F.lit("About "), key).alias("description"),
        )
    )
    return found


# Suppliers of the parts of a profile.
_SUPPLY = """(select distinct p_type as profile, l_suppkey as suppkey
  from {lineitem} join {part} on p_partkey = l_partkey)"""

# Each dimension reads whole tables; {part} and the like stand for their names.
DIMS_SQL = {
    "profiles": """
select distinct p_type as profile, p_type as primary,
  case when length(p_type) = 5 then p_type else 'The ' || p_type end as english,
  case when length(p_type) > 5 then p_type || ' Band' end as group_name,
  case when length(p_type) > 6 then 'B-' || p_type end as group_alias
from {part}""",
    "albums": """
select distinct p_type as profile, cast(substr(p_brand, 7) as int) as pos, p_brand as album,
  1990 + cast(substr(p_brand, 7) as int) as year
from {part}""",
    "tracks": """
select p_type as profile, cast(substr(p_brand, 7) as int) as album_pos, p_brand as album,
  p_partkey as pos, p_name as track
from {part}""",
    "aliases": f"""
select distinct profile, n_nationkey as pos, n_name as alias
from {_SUPPLY} s join {{supplier}} on s_suppkey = suppkey
  join {{nation}} on n_nationkey = s_nationkey""",
    "ost": """
select p_type as profile, p_partkey as pos, p_name as name,
  case p_size % 3 when 0 then '' when 1 then p_name else p_brand end as source,
  1990 + p_size as year
from {part}""",
    "variety_singles": """
select p_type as profile, p_partkey as pos, p_name as name,
  case when p_type = 'PROMO' then '' else p_brand end as source, 1990 + p_size as year
from {part}""",
    "concerts": """
select p_type as profile, p_partkey as pos, p_name || ' Tour' as name,
  case when p_size > 25 then p_brand end as first_alias
from {part}""",
    "concert_aliases": """
select p_type as profile, p_partkey as concert_pos, p_name || ' Tour' as concert, 0 as pos,
  p_brand as alias
from {part} where p_size > 25""",
    "concert_venues": """
select p_type as profile, p_partkey as concert_pos, p_name || ' Tour' as concert, p_size as pos,
  p_brand || ' Hall' as venue
from {part}""",
    "group_concerts": """
select p_type as profile, p_partkey as pos, p_name || ' Group Tour' as name from {part}""",
    "shows": f"""
select profile, cast(s_suppkey as int) as pos, s_name as name,
  case when s_nationkey % 2 = 0 then '' else 'Net ' || cast(s_nationkey as string) end as network
from {_SUPPLY} s join {{supplier}} on s_suppkey = suppkey""",
    "collabs": """
select p_type as profile, p_partkey as pos, p_brand || ' ' || p_name as name,
  p_size % 3 as n_songs
from {part}""",
    "collab_songs": """
select p_type as profile, p_partkey as collab_pos, p_brand || ' ' || p_name as collab,
  0 as pos, p_name || ' Duet' as song
from {part} where p_size % 3 > 0""",
    "collab_aliases": """
select p_type as profile, p_partkey as collab_pos, p_brand || ' ' || p_name as collab,
  0 as pos, p_brand as alias
from {part}""",
    "group_mvs": """
select p_type as profile, p_partkey as pos, p_name as track from {part}""",
    "interviewers": f"""
select distinct profile, r_regionkey as pos, r_name as name
from {_SUPPLY} s join {{supplier}} on s_suppkey = suppkey
  join {{nation}} on n_nationkey = s_nationkey join {{region}} on r_regionkey = n_regionkey
where profile <> 'LARGE'""",
    "interview_channels": f"""
select distinct profile, n_nationkey as pos, n_name || ' TV' as name
from {_SUPPLY} s join {{supplier}} on s_suppkey = suppkey
  join {{nation}} on n_nationkey = s_nationkey""",
}


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, json): a profile document per customer, its lists made of the customer's key."""
    k = F.col("c_custkey")

    def listed(n, make):
        places = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.transform(places, make)

    def numbered(text, i):
        return F.concat(F.lit(text), i.cast("string"))

    none = F.array().cast("array<string>")
    key = numbered("c", k)
    albums = listed(k % 4 + 1, lambda a: F.struct(
        numbered("album ", a).alias("name"), F.lit(2000).alias("year"),
        listed((k + a) % 5 + 1, lambda t: F.concat(
            numbered("track ", a), F.lit("-"), t.cast("string")
        )).alias("tracks"),
    ))
    ost = listed(k % 3, lambda i: F.struct(
        numbered("ost ", i).alias("name"),
        F.when((k + i) % 2 == 0, "").otherwise("film").alias("source"), F.lit(2001).alias("year"),
    ))
    collabs = listed(k % 3, lambda i: F.struct(
        numbered("friend ", i).alias("name"), none.alias("aliases"),
        F.when((k + i) % 4 == 0, none).otherwise(F.array(F.lit("duet"))).alias("songs"),
    ))
    shows = F.when(k % 7 < 3, F.array(F.struct(
        F.lit("The Singer Show").alias("name"), F.lit("net").alias("network")
    ))).otherwise(F.array().cast("array<struct<name:string,network:string>>"))
    singles = F.when(k % 5 == 0, F.array(F.struct(
        F.lit("one").alias("name"), F.lit("show").alias("source"), F.lit(2002).alias("year")
    )))
    concerts = listed(k % 2, lambda i: F.struct(
        numbered("tour ", i).alias("name"), F.lit("2003").alias("years"), none.alias("aliases"),
        none.alias("venues"),
    ))
    categories = listed(k % 3, lambda i: F.struct(
        i.cast("int").alias("id"), numbered("cat ", i).alias("key"), numbered("Cat ", i).alias("label")
    ))
    artist = F.struct(
        F.struct(F.col("c_name").alias("primary"), key.alias("english"), none.alias("aliases")).alias(
            "names"
        ),
        none.alias("official_channels"), F.when(k % 6 > 0, none).alias("labels"),
        F.when(k % 3 > 0, F.col("c_nationkey") + 1950).alias("birth_year"),
        F.when(k % 4 > 0, F.col("c_mktsegment")).alias("genre"),
        F.when(k % 5 > 0, F.array(numbered("Award ", F.col("c_nationkey")))).alias("awards"),
    )
    discography = F.struct(
        albums.alias("solo_albums"), ost.alias("ost_singles"), singles.alias("variety_show_singles"),
        concerts.alias("concerts"), shows.alias("variety_shows"), collabs.alias("collaborators"),
        F.when(k % 2 > 0, F.array(F.lit("Host"))).alias("notable_interviewers"),
    )
    document = F.struct(
        artist.alias("artist"), discography.alias("discography"), categories.alias("categories"),
        F.struct(F.when(k % 9 > 0, none).alias("priority")).alias("classification"),
    )
    return table(spark, sf_dir, "customer").select(k.alias("key"), F.to_json(document).alias("json"))


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' documents read from JSON, as documents arrive."""
    return parse_profiles(customer_documents(spark, sf_dir).select("json"))


def faulty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' documents, some of them broken in one of several ways by their key."""
    k, text = F.col("key"), F.col("json")
    broken = (
        F.when(k % 5 == 0, F.substring(text, 1, 40))
        .when(k % 7 == 1, F.regexp_replace(text, '"english":"[^"]*",', ""))
        .when(k % 7 == 2, F.regexp_replace(text, '"year":2000', '"year":"soon"'))
        .when(k % 7 == 3, F.regexp_replace(text, '"label":', '"title":'))
        .when(k % 7 == 4, F.regexp_replace(text, '"solo_albums":', '"albums":'))
        .otherwise(text)
    )
    return customer_documents(spark, sf_dir).select("key", broken.alias("json"))
