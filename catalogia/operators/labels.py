"""Hand-over to an outside labeller and merging of its answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions import blank_to_null, strip_fences, trim_all, who
from catalogia.operators.distribution import attach, ordered_index
from catalogia.operators.scoring import score
from catalogia.schema import LABELS

_BATCH = ["profile", "batch_id", "index"]


def label_batches(
    items: DataFrame, size: int = V.LABEL_BATCH,
) -> DataFrame:
    """Unclassified items in batches of ``size`` per profile, in item order."""
    waiting = items.filter(F.col("category") == V.UNCLASSIFIED)
    numbered = ordered_index(waiting, ["profile"], ["file_id"], "ord", "_n")
    return numbered.withColumns({
        "batch_id": F.floor(F.col("_n") / size), "index": (F.col("_n") % size).cast("int"),
    }).drop("_n")


def _label_text() -> Column:
    description = F.substring(
        F.coalesce(F.col("description"), F.lit("")), 1, V.LABEL_DESCRIPTION_CHARS
    )
    return F.format_string(
        V.LABEL_ITEM_FORMAT, "index", F.coalesce("title", F.lit("N/A")),
        F.coalesce(blank_to_null(who()), F.lit("N/A")), F.coalesce("duration", F.lit("N/A")),
        description,
    )


def label_prompts(batches: DataFrame, categories: DataFrame | None = None,
                  names: DataFrame | None = None) -> DataFrame:
    """One message per batch; a batch holds at most ``size`` rows, so the list is bounded.

    With ``categories(profile, key, label, description, pos)`` and ``names(profile,
    primary)`` the category list is added as ``category_lines``.
    """
    texts = batches.select("profile", "batch_id", "index", _label_text().alias("text"))
    messages = texts.groupBy("profile", "batch_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_sort(F.collect_list(F.struct("index", "text"))).alias("rows"),
    )
    body = F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n")
    messages = messages.select(
        "profile", "batch_id", "n_items",
        F.format_string(V.LABEL_MESSAGE_FORMAT, "n_items", body).alias("message"),
    )
    if categories is None:
        return messages
    line = F.concat(
        F.lit("- "), F.col("key"), F.lit(": "),
        F.coalesce(blank_to_null(F.col("description")), F.col("label")),
    )
    listed = categories.select("profile", "pos", line.alias("line")).groupBy("profile").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("rows")
    )
    blocks = listed.join(names.select("profile", "primary"), "profile").select(
        "profile",
        F.concat_ws(
            "\n", F.transform("rows", lambda r: r["line"]),
            F.format_string(V.LABEL_DISCARD_LINE, "primary"),
        ).alias("category_lines"),
    )
    return attach(messages, blocks, ["profile"], ["batch_id"], "left")


def _answer_text(raw: Column) -> Column:
    """Answer inside its envelope: ``result`` of an object, text blocks of a list, or itself."""
    def texts_of(element):
        content = F.get_json_object(element, "$.content")
        blocks = F.from_json(content, "array<struct<type:string,text:string>>")
        joined = blank_to_null(F.array_join(F.transform(
            F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]
        ), "\n"))
        typed = F.coalesce(F.exists(blocks, lambda b: b["type"].isNotNull()), F.lit(False))
        direct = F.when(
            F.get_json_object(element, "$.type") == "text", F.get_json_object(element, "$.text")
        )
        return F.when(content.isNotNull(), F.coalesce(joined, F.when(~typed, content))).otherwise(
            F.coalesce(
                direct,
                F.get_json_object(element, "$.result"),
                # A list of plain strings.
                F.when(~element.startswith("{"), element),
            )
        )

    elements = F.from_json(raw, "array<string>")
    texts = F.filter(F.transform(elements, texts_of), lambda t: t.isNotNull())
    return (
        F.when(raw.startswith("{"), F.coalesce(F.get_json_object(raw, "$.result"), raw))
        .when(raw.startswith("["), F.coalesce(blank_to_null(F.array_join(texts, "\n")), raw))
        .otherwise(raw)
    )


def parse_label_responses(responses: DataFrame, fences: bool = False) -> DataFrame:
    """``responses(profile, batch_id, raw)`` to one row per label; bad answers give none."""
    answer = trim_all(_answer_text(trim_all(F.col("raw"))))
    if fences:
        answer = strip_fences(answer)
    listed = F.when(answer.startswith("["), F.from_json(answer, LABELS))
    keys = [c for c in responses.columns if c != "raw"]
    return responses.select(*keys, F.posexplode(listed).alias("pos", "e")).select(
        *keys, "pos", "e.index", "e.category", "e.reason"
    )


def apply_labels(
    batches: DataFrame, labels: DataFrame, categories: DataFrame, failed: DataFrame | None = None,
) -> DataFrame:
    """Category and reason of each batched item from the last label for its index.

    With several answers to a batch, column ``answer`` tells their order.
    ``categories(profile, key)`` lists the valid ones; ``failed(profile, batch_id)``
    names batches without any answer.
    """
    later = [c for c in ("answer", "pos") if c in labels.columns]
    last = labels.filter(F.col("index").isNotNull()).groupBy(*_BATCH).agg(
        F.max_by(F.struct("category", "reason"), F.struct(*later)).alias("_l")
    )
    valid = categories.select("profile", F.col("key").alias("_c"), F.lit(True).alias("_valid"))
    answered = batches.join(last, _BATCH, "left").withColumn("_c", F.col("_l.category"))
    answered = attach(answered, valid, ["profile", "_c"], ["file_id", "ord"], "left")
    accepted = F.coalesce(F.col("_valid"), F.lit(False)) | (F.col("_c") == V.DISCARD)
    has_label = F.col("_l").isNotNull()
    category = F.when(has_label & accepted, F.col("_c")).otherwise(V.UNCLASSIFIED)
    reason = F.when(
        has_label, F.concat(F.lit("llm_"), F.coalesce("_l.reason", F.lit("llm_fallback")))
    ).otherwise("llm_missing_index")
    if failed is not None:
        gone = failed.select("profile", "batch_id").distinct().withColumn("_failed", F.lit(True))
        answered = answered.join(gone, ["profile", "batch_id"], "left")
        lost = F.col("_failed").isNotNull()
        category = F.when(lost, V.UNCLASSIFIED).otherwise(category)
        reason = F.when(lost, "llm_error").otherwise(reason)
    kept = [c for c in batches.columns if c not in ("category", "classification_reason")]
    return answered.select(
        *kept, category.alias("category"), reason.alias("classification_reason")
    )


def finalise(rule_rows: DataFrame, labelled: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rule-classified rows as they are, plus labelled rows with their score.

    Labelled rows pass no view filter.
    """
    scored = score(labelled.drop("batch_id", "index"), profiles)
    settled = rule_rows.filter(F.col("category") != V.UNCLASSIFIED)
    return settled.unionByName(scored, allowMissingColumns=True)
