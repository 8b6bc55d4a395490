"""Classification, scoring, filters, reports, labels and review over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogia import fixed_values as V
from catalogia.operators import automaton, labels, quality, reports, review, rules, scoring
from catalogia.operators.profiles import dims
from catalogia.plans import tables
from catalogia.plans.oracle_parts import is_in, q, scored_cte, with_ctes
from catalogia.plans.registry import query
from catalogia.session import cut_lineage

_ROW = "profile, file_id, ord"
_CATEGORIES = [*V.CATEGORY_FILE_IDS, V.DISCARD, V.UNCLASSIFIED]


def _row(df: DataFrame, *columns) -> DataFrame:
    return df.select("profile", "file_id", "ord", *columns)


def classified(spark: SparkSession, sf_dir: str, **kept) -> DataFrame:
    return rules.classify(tables.items(spark, sf_dir), tables.profiles(spark), **kept)


def scored(spark: SparkSession, sf_dir: str, **kept) -> DataFrame:
    profiles = tables.profiles(spark)
    return scoring.score(classified(spark, sf_dir, keep_dictionary=True), profiles, **kept)


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scored(spark, sf_dir, keep_dictionary=True)
    return quality.filter_low_views(base, tables.profiles(spark))


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified and view-filtered items, for counts that need no confidence."""
    return quality.filter_low_views(
        classified(spark, sf_dir, keep_dictionary=True), tables.profiles(spark)
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored catalogue as a review meets it: written once, then only read."""
    columns = ["url", "category", "classification_reason", "confidence"]
    return cut_lineage(_row(filtered(spark, sf_dir), *columns))


def _categories(spark: SparkSession) -> DataFrame:
    return dims(tables.profiles(spark), "categories")["categories"]


@query(with_ctes("classified", f"select {_ROW}, category, classification_reason from classified"))
def classify_rules(spark, sf_dir):
    return _row(classified(spark, sf_dir), "category", "classification_reason")


@query(f"""select i.profile, i.file_id, i.ord, count(*) as n_terms, min(term) as first_term, max(term) as last_term
from ({tables.items_sql()}) i join {tables.LONG_WORDS_SQL} w on w.profile = i.profile and contains(i.title, w.term)
group by all""")
def dictionary_hits(spark, sf_dir):
    """Names of large dictionaries inside titles, found by one automaton per profile."""
    items = tables.items(spark, sf_dir).select("profile", "file_id", "ord", "title")
    found = automaton.matched_terms(items, F.col("title"), tables.long_words(spark, sf_dir)).filter(F.size("terms") > 0)
    return _row(
        found, F.size("terms").cast("bigint").alias("n_terms"), F.get("terms", F.lit(0)).alias("first_term"),
        F.element_at("terms", -1).alias("last_term"),
    )


@query(with_ctes("classified", f"select {_ROW}, category, classification_reason from classified").replace(
    "p_tracks(profile, term) as", "own_tracks(profile, term) as", 1
).replace(
    "solo_hits as (", "p_tracks as (select profile, term from own_tracks union select profile, term "
    f"from {tables.LONG_WORDS_SQL} w),\nsolo_hits as (", 1
))
def classify_large_profiles(spark, sf_dir):
    """Classification by profiles that list all long words as tracks, through automata."""
    profiles = tables.large_profiles(spark, sf_dir)
    done = rules.classify(tables.items(spark, sf_dir), profiles, way="automaton")
    return _row(done, "category", "classification_reason")


@query(with_ctes("scored", f"""select {_ROW}, category, confidence, s_rule as rule_strength,
  case when category <> 'discard' then s_source end as source_reliability,
  case when category <> 'discard' then s_duration end as duration_fit,
  case when category <> 'discard' then s_views end as view_signal,
  case when category <> 'discard' then s_title end as title_match from scored"""))
def confidence_scores(spark, sf_dir):
    signal = {
        "rule_strength": "rule_strength", "source_reliability": "source_reliability",
        "duration_fit": "duration_fit", "view_count": "view_signal", "title_match": "title_match",
    }
    return _row(
        scored(spark, sf_dir), "category", "confidence",
        *[F.try_element_at("confidence_signals", F.lit(k)).alias(n) for k, n in signal.items()],
    )


@query(with_ctes("filtered", f"select {_ROW}, category, classification_reason, confidence from filtered"))
def filter_low_views(spark, sf_dir):
    return _row(filtered(spark, sf_dir), "category", "classification_reason", "confidence")


@query(with_ctes("filtered", f"select {_ROW}, confidence from filtered where confidence < 0.7"))
def low_confidence(spark, sf_dir):
    return _row(quality.low_confidence(filtered(spark, sf_dir)), "confidence")


_LISTED = (
    "(select profile, key as category, id as file_id from p_cats union all "
    "select distinct profile, x.c, null from p_cats, (values ('discard'), ('unclassified')) x(c)) l"
)


@query(with_ctes("filtered", f"""
select profile, category, max(file_id) as file_id, cast(sum(n) as bigint) as n from (
  select l.profile, l.category, l.file_id, count(f.ord) as n from {_LISTED}
  left join filtered f on f.profile = l.profile and f.category = l.category
  group by l.profile, l.category, l.file_id) c
group by profile, category
union all
select profile, 'TOTAL', null, count(*) from filtered group by profile"""))
def category_counts(spark, sf_dir):
    return reports.category_counts(settled(spark, sf_dir), _categories(spark))


@query(with_ctes("filtered", """select profile, classification_reason as reason, count(*) as n
from filtered group by 1, 2"""))
def reason_counts(spark, sf_dir):
    return reports.reason_counts(settled(spark, sf_dir))


@query(with_ctes("filtered", """select profile, bucket, n, cast(printf('%.1f', n * 100e0 / total) as double) as percent,
  cast(printf('%.3f', cast(s as double) / total) as double) as mean_confidence from (
  select profile, count(*) as total, sum(cast(confidence as decimal(12, 6))) as s,
    count(*) filter (confidence >= 0.8e0) as high,
    count(*) filter (confidence >= 0.5e0 and confidence < 0.8e0) as medium,
    count(*) filter (confidence < 0.5e0) as low
  from filtered where confidence is not null group by profile) t
unpivot (n for bucket in (high, medium, low))"""))
def confidence_buckets(spark, sf_dir):
    return reports.confidence_buckets(filtered(spark, sf_dir))


@query(with_ctes("filtered", "select profile, original_file_id, " + ", ".join(
    f"count(*) filter (category = {q(c)}) as {c}" for c in _CATEGORIES
) + " from filtered group by profile, original_file_id"))
def migration_matrix(spark, sf_dir):
    return reports.migration_matrix(settled(spark, sf_dir))


_CATALOG_COUNTS = """counted as (
  select c.profile, c.key as category, c.label, count(f.ord) as n
  from p_cats c left join filtered f on f.profile = c.profile and f.category = c.key
  group by 1, 2, 3)"""


@query(with_ctes(
    "filtered", "select profile, category, label, n, n = 0 as missing from counted", _CATALOG_COUNTS
))
def catalog_counts(spark, sf_dir):
    return reports.catalog_counts(settled(spark, sf_dir), _categories(spark))


@query(with_ctes("filtered", """select profile, cast(sum(n) as bigint) as n_items,
  count(*) filter (n > 0) as n_categories from counted group by profile""", _CATALOG_COUNTS))
def profile_summary(spark, sf_dir):
    return reports.profile_summary(settled(spark, sf_dir), _categories(spark))


@query(with_ctes("filtered", """select profile,
  count(*) filter (category <> 'unclassified') as n_classified,
  count(*) filter (category = 'unclassified') as n_unclassified from filtered group by profile"""))
def rule_counts(spark, sf_dir):
    return reports.rule_counts(settled(spark, sf_dir))


# Labels. The label rows of the documents are turned into the labeller's answers.
_NUMBERED = """waiting as (
  select *, row_number() over (partition by profile order by file_id, ord) - 1 as n
  from classified where category = 'unclassified'),
batched as (select * exclude (n), cast(floor(n / 20) as bigint) as batch_id,
  cast(n % 20 as int) as idx from waiting)"""


def _batches(spark, sf_dir):
    """Numbering reads its input twice, so the waiting rows are stored first."""
    waiting = classified(spark, sf_dir).filter(F.col("category") == V.UNCLASSIFIED)
    return labels.label_batches(cut_lineage(waiting))


@query(with_ctes("classified", f'select {_ROW}, batch_id, idx as "index" from batched', _NUMBERED))
def label_batches(spark, sf_dir):
    return _row(_batches(spark, sf_dir), "batch_id", "index")


_ITEM_TEXT = """'[' || idx || '] 标题: ' || title || chr(10) || '    频道: '
  || coalesce(nullif(who, ''), 'N/A') || chr(10) || '    时长: ' || coalesce(duration, 'N/A')
  || chr(10) || '    简介: ' || substr(description, 1, 200)"""


@query(with_ctes("classified", f"""select t.profile, batch_id, n_items,
  '请对以下 ' || n_items || ' 条视频进行分类：' || chr(10) || chr(10) || body as message,
  category_lines from (
  select profile, batch_id, count(*) as n_items,
    string_agg({_ITEM_TEXT}, chr(10) || chr(10) order by idx) as body
  from batched group by profile, batch_id) t
join (select c.profile, string_agg('- ' || key || ': ' || description, chr(10) order by id)
    || chr(10) || '- discard: 与' || max(h.prim) || '无关的内容' as category_lines
  from p_cats c join p_heads h on h.profile = c.profile group by c.profile) l
on l.profile = t.profile""", _NUMBERED))
def label_prompts(spark, sf_dir):
    d = dims(tables.profiles(spark), "categories", "profiles")
    return labels.label_prompts(_batches(spark, sf_dir), d["categories"], d["profiles"])


_KEYS = [*V.CATEGORY_FILE_IDS, V.DISCARD, "no_such_category"]


def _answers(spark, sf_dir, batches: DataFrame) -> DataFrame:
    """A labeller's answers, each to a whole batch, in one of three envelopes.

    An answer lists the labelled items of its batch that are not toxic.  Every seventh batch gets
    chatter that is no JSON, every fourth a second answer about the items of even index.
    """
    marks = tables.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_doc"), "quality", "toxic")
    batched = batches.withColumn("_doc", tables.document_of(F.col("ord"))).join(marks, "_doc").filter("toxic = 0")
    keys = F.array(*[F.lit(k) for k in _KEYS])

    def listed(answer, shift, reason, condition):
        entry = F.struct("index", F.get(keys, (F.col("_doc") + shift) % len(_KEYS)).alias("category"), reason.alias("reason"))
        return batched.filter(condition).groupBy("profile", "batch_id").agg(
            F.to_json(F.array_sort(F.collect_list(entry))).alias("text")).withColumn("answer", F.lit(answer))

    first = listed(1, 0, F.concat(F.lit("quality "), F.col("quality").cast("string")), F.lit(True))
    second = listed(2, 1, F.lit("second"), "batch_id % 4 = 1 and index % 2 = 0")
    text, kind = F.col("text"), F.col("batch_id") % 3
    wrapped = F.to_json(F.struct(text.alias("result")))
    message = F.to_json(F.array(F.struct(
        F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("content")
    )))
    chatty = F.concat(F.lit("I think "), text)
    raw = F.when(F.col("batch_id") % 7 == 5, chatty).when(kind == 0, text).when(kind == 1, wrapped).otherwise(message)
    return first.unionByName(second).select("profile", "batch_id", "answer", raw.alias("raw"))


_KEY_LIST = "[" + ", ".join(q(k) for k in _KEYS) + "]"
_LABELS = f"""answers as (
  select b.profile, b.batch_id, b.idx, a.answer, case when a.answer = 1 then 'quality ' || l.quality else 'second' end as reason,
    {_KEY_LIST}[1 + (l.doc_id + a.answer - 1) % {len(_KEYS)}] as cat
  from batched b join labels l on l.doc_id = b.ord >> {tables.LINE_SHIFT}
  join (values (1), (2)) a(answer) on a.answer = 1 or (b.batch_id % 4 = 1 and b.idx % 2 = 0)
  where toxic = 0 and b.batch_id % 7 <> 5),
answered as (
  select profile, batch_id, idx, arg_max(cat, answer) as cat, arg_max(reason, answer) as reason
  from answers group by all)"""


@query(with_ctes(
    "classified",
    'select profile, batch_id, answer, idx as "index", cat as category, reason from answers',
    _NUMBERED, _LABELS,
))
def parse_label_responses(spark, sf_dir):
    answers = _answers(spark, sf_dir, _batches(spark, sf_dir))
    return labels.parse_label_responses(answers).drop("pos")


def _labelled(spark, sf_dir) -> DataFrame:
    batches = _batches(spark, sf_dir)
    parsed = labels.parse_label_responses(_answers(spark, sf_dir, batches))
    return labels.apply_labels(batches, parsed, _categories(spark))


_LABELLED = f"""labelled as (
  select b.* exclude (category, classification_reason, batch_id, idx),
    case when a.cat in {is_in(_KEYS[:-1])} then a.cat else 'unclassified' end as category,
    coalesce('llm_' || a.reason, 'llm_missing_index') as classification_reason
  from batched b left join answered a
    on a.profile = b.profile and a.batch_id = b.batch_id and a.idx = b.idx)"""


@query(with_ctes(
    "classified", f"select {_ROW}, category, classification_reason from labelled",
    _NUMBERED, _LABELS, _LABELLED,
))
def apply_labels(spark, sf_dir):
    return _row(_labelled(spark, sf_dir), "category", "classification_reason")


@query(with_ctes(
    "filtered",
    f"select {_ROW}, category, classification_reason, confidence from filtered "
    "where category <> 'unclassified' union all "
    f"select {_ROW}, category, classification_reason, confidence from rescored",
    _NUMBERED, _LABELS, _LABELLED, scored_cte("labelled", "rescored"),
))
def finalise(spark, sf_dir):
    """Every item once; the catalogue is classified once and stored, then settled and waiting rows part."""
    profiles, stored_rows = tables.profiles(spark), cut_lineage(classified(spark, sf_dir))
    ruled = stored_rows.filter(F.col("category") != V.UNCLASSIFIED)
    settled_rows = quality.filter_low_views(scoring.score(ruled, profiles, keep_dictionary=True), profiles)
    batches = labels.label_batches(stored_rows)
    parsed = labels.parse_label_responses(_answers(spark, sf_dir, batches))
    labelled = labels.apply_labels(batches, parsed, _categories(spark))
    done = labels.finalise(settled_rows, labelled, profiles)
    return _row(done, "category", "classification_reason", "confidence")


# Review. Two rounds of decisions on item urls come from the labels of the documents.
def _decisions(spark, sf_dir) -> DataFrame:
    marks = tables.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "_doc")
    judged = tables.items(spark, sf_dir).withColumn("_doc", tables.document_of(F.col("ord"))).join(marks, "_doc")
    rounds = F.array(
        F.struct(F.lit("skip").alias("action"), F.lit(1).cast("bigint").alias("decided_at")),
        F.struct(
            F.when(F.col("toxic") == 1, "skip").when(F.col("quality") == 1, "approve")
            .otherwise("reject").alias("action"),
            (F.col("ord") + 2).alias("decided_at"),
        ),
    )
    return judged.select("profile", "url", F.inline(rounds))


_DECISIONS = f"""decided as (
  select profile, url, arg_max(action, decided_at) as action from (
    select i.profile, i.url, case when toxic = 1 then 'skip' when quality = 1 then 'approve' else 'reject' end
      as action, i.ord + 2 as decided_at
    from items i join labels l on l.doc_id = i.ord >> {tables.LINE_SHIFT}) d
  group by profile, url)"""


@query(with_ctes("items", "select profile, url, action from decided", _DECISIONS))
def latest_decisions(spark, sf_dir):
    return review.latest_decisions(_decisions(spark, sf_dir))


@query(with_ctes("filtered", f"""select {_ROW}, category, confidence from filtered
where confidence < 0.7 and category in {is_in(V.CATEGORY_FILE_IDS)}"""))
def review_queue(spark, sf_dir):
    return review.review_queue(_row(filtered(spark, sf_dir), "category", "confidence"))


@query(with_ctes("filtered", f"""select {_ROW}, category, confidence from filtered
where confidence < 0.7 and category in {is_in(V.CATEGORY_FILE_IDS)}
  and not exists (select 1 from decided d
    where d.profile = filtered.profile and d.url = filtered.url)""", _DECISIONS))
def review_pending(spark, sf_dir):
    queue = review.review_queue(stored(spark, sf_dir), decisions=_decisions(spark, sf_dir))
    return _row(queue, "category", "confidence")


@query(with_ctes("filtered", f"""select f.profile, f.file_id, f.ord,
  case when action = 'reject' then 'discard' else category end as category,
  case when action = 'reject' and category <> 'discard' then 'review_rejected'
    else classification_reason end as classification_reason,
  case when action = 'approve' and category <> 'discard' then 1e0 else confidence end as confidence
from filtered f left join decided d on d.profile = f.profile and d.url = f.url""", _DECISIONS))
def apply_review(spark, sf_dir):
    kept, discards = review.apply_review(stored(spark, sf_dir), _decisions(spark, sf_dir))
    return _row(kept.unionByName(discards), "category", "classification_reason", "confidence")


@query(with_ctes("filtered", f"""select f.profile, count(*) as n_queue,
  count(*) filter (action = 'approve') as n_approved,
  count(*) filter (action = 'reject') as n_rejected,
  count(*) filter (action = 'skip') as n_skipped,
  count(*) filter (action is null) as n_remaining
from filtered f left join decided d on d.profile = f.profile and d.url = f.url
where confidence < 0.7 and category in {is_in(V.CATEGORY_FILE_IDS)} group by f.profile""", _DECISIONS))
def action_summary(spark, sf_dir):
    return review.action_summary(
        review.review_queue(stored(spark, sf_dir)), _decisions(spark, sf_dir)
    )
