"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from catalogia.llm.common import scratch, table
from catalogia.llm.decontamination import find_contamination
from catalogia.llm.fill_in_middle import fill_in_middle
from catalogia.llm.kd_shards import shard_documents
from catalogia.llm.ngram_join import jaccard_components
from catalogia.llm.packing import pack_documents
from catalogia.llm.pii import replace_pii
from catalogia.llm.quality_divergence import judge_quality
from catalogia.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from catalogia.llm.setsketch import near_duplicates
from catalogia.llm.source_audit import source_audit
from catalogia.llm.substring_dedup import remove_duplicates
from catalogia.llm.token_store import read_store, write_store
from catalogia.llm.toxicity import score_toxicity
from catalogia.llm.url_filters import RULES, filter_urls

# The key is a parameter of the operator; this one belongs to the supplied test tables.
PII_KEY = b"key of the test tables"
TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def _near_sql(shingle: int, columns: str) -> str:
    """Near-duplicate components by definition: prefix candidates, whole intersections, all that is reachable."""
    return rf"""
    with recursive docs as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
    ), sets as (
        select doc_id, case when len(w) = 0 then [] when len(w) < {shingle} then [array_to_string(w, ' ')]
            else list_distinct([array_to_string(w[i:i + {shingle - 1}], ' ') for i in range(1, len(w) - {shingle - 2})]) end as s
        from docs
    ), classes as (
        select s, min(doc_id) as id, len(s) as n from sets where len(s) > 0 group by s
    ), grams as (select id, n, unnest(s) as g from classes),
    ranked as (
        select id, n, g, row_number() over (partition by id order by df, g) as place
        from (select *, count(*) over (partition by g) as df from grams) t
    ), prefixes as (select id, n, g from ranked where place <= n - (8 * n + 9) // 10 + 1),
    candidates as (
        select distinct a.id as a, b.id as b from prefixes a join prefixes b on a.g = b.g and a.id < b.id
            and 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
    ), links as (
        select a, b from (
            select c.a, c.b, x.n + y.n as both_sizes, len(list_intersect(x.s, y.s)) as common
            from candidates c join classes x on x.id = c.a join classes y on y.id = c.b) t
        where 100 * common >= 80 * (both_sizes - common)
    ), ways as (select a, b from links union all select b, a from links),
    reached(id, other) as (
        select id, id from classes union select r.id, w.b from reached r join ways w on w.a = r.other
    ), labels as (select id, min(other) as component_id from reached group by id),
    answer as (
        select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(l.component_id, s.doc_id) as component_id
        from sets s left join classes c on c.s = s.s left join labels l on l.id = c.id
    )
    select {columns} from answer"""


@query(rf"""
    with parts as (
        select page_id,
            translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
        from pages
    ), rules(rhost, rpath, rverdict) as (values {_RULE_ROWS}),
    fits as (
        select page_id, max({{'h': length(rhost), 'p': length(rpath), 'rule': rhost || rpath,
            'verdict': rverdict}}) as best
        from parts join rules
            on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
        group by page_id
    )
    select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict
    from parts left join fits using (page_id)
""")
def op10_url_filters(spark, sf_dir):
    """Host, path, winning rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, RULES)
    return filter_urls(table(spark, sf_dir, "pages"), rules, "page_id")


@query()
def op2_quality_divergence(spark, sf_dir):
    """Base measures, distances from the language references and verdict of every document."""
    return judge_quality(table(spark, sf_dir, "documents"))


@query()
def op7_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item within its edit budget, with the place."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_toxicity(spark, sf_dir):
    """Calibrated toxicity of every document."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_kd_shards(spark, sf_dir):
    """Eight shards of nearly equal bytes; equal texts stay together."""
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op4_best_fit_packing(spark, sf_dir):
    """Every piece of every document with its sequence and place."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query()
def op6_token_store(spark, sf_dir):
    """Start, length and checksum of every document, read back from a written store."""
    path = scratch(spark)
    write_store(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path)
    return read_store(spark, path)


@query()
def op5_pii_pseudonyms(spark, sf_dir):
    """Every document with keyed pseudonyms in place of personal values."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, PII_KEY)


@query(r"""
    with docs as (
        select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
    ), windows as (
        select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) as h
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) as i from docs) t
    ), repeated as (select h from windows group by h having count(*) > 1),
    gone as (
        select distinct doc_id, i + k as i from windows join repeated using (h), range(35) r(k)
    ), words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from docs),
    kept as (
        select doc_id, string_agg(word, ' ' order by i) as t, count(*) as n
        from words anti join gone using (doc_id, i) group by doc_id
    )
    select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
        sha256(coalesce(t, '')) as kept_sha256
    from docs d left join kept k using (doc_id)
""")
def op1_substring_dedup(spark, sf_dir):
    """Words left of every document after removal of repeated windows, as a digest."""
    kept = remove_duplicates(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query(_near_sql(5, "doc_id, n_shingles, component_id"))
def op3_ngram_jaccard(spark, sf_dir):
    """Set size and near-duplicate component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("""
    with cut as (
        select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
        from documents
    ), numbers as (
        select doc_id, t, length(t) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
            cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4
        from cut
    ), formed as (
        select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
            case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90
                then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
        from numbers
    ), parts as (
        select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from formed
    )
    select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
        case when form <> 'plain' then b - a end as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
            else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
        sha256(t) as restored_sha256
    from parts
""")
def op12_fill_in_middle(spark, sf_dir):
    """Form, cuts and digests of every document's fill-in-middle output."""
    return fill_in_middle(table(spark, sf_dir, "documents")).drop("output")


@query(r"""
    with docs as (
        select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
        from documents
    ), words as (
        select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
    ), cells as (
        select lang, source, term, cast(count(*) as hugeint) as n, count(distinct r) as d from words group by all
    ), kept as (
        select lang, term, cast(sum(n) as hugeint) as total from cells group by all having sum(d) >= 3
    ), langs as (
        select lang, cast(count(*) as hugeint) as v, cast(sum(total) as hugeint) as n from kept group by lang
    ), full_cells as (
        select g.lang, g.source, k.term, k.total, coalesce(c.n, 0) as n
        from (select distinct lang, source from docs) g join kept k on k.lang = g.lang
        left join cells c on c.lang = g.lang and c.source = g.source and c.term = k.term
    ), shared as (
        select f.lang, f.source, term, f.n as count_here,
            1 + (1000000000 * (f.n + 1)) // cast(sum(f.n) over (partition by f.lang, f.source) + v as hugeint) as p,
            1 + (1000000000 * (total + 1)) // (l.n + v) as q
        from full_cells f join langs l on l.lang = f.lang
    ), pairs as (
        select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
        from shared a join shared b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
    ), groups as (select distinct lang, source from docs),
    listed as (
        select g.lang, g.source, 'pair' as part, o.source as item, cast(coalesce(value, 0) as bigint) as value
        from groups g join groups o on o.lang = g.lang and o.source <> g.source
        left join pairs p on p.lang = g.lang and p.source = g.source and p.item = o.source
        union all
        select lang, source, 'term', term, cast((p - q) * (p - q) // q as bigint)
        from shared where count_here > 0 and p > q
    )
    select lang, source, part, item, value, cast(rank as int) as rank from (
        select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank
        from listed)
    where part = 'pair' or rank <= 200
""")
def op11_source_audit(spark, sf_dir):
    """Divergence of every source from the others of its language and its most telling terms."""
    return source_audit(table(spark, sf_dir, "documents"))


@query(_near_sql(2, "doc_id, n_shingles, component_id, doc_id = component_id as kept"))
def op13_setsketch(spark, sf_dir):
    """Set size, near-duplicate component and whether it stays, of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
