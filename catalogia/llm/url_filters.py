"""URL filters: a sort-merge range join of canonical url keys with nested prefix rules.

A rule (host, path, verdict) fits the urls of its host and of all subdomains whose path starts
with the rule's path.  With reversed hosts a rule is a prefix of a canonical key, so rules are
intervals of the sorted key space, and the intervals of one host nest.  Urls and rules are
sorted together, and a sweep keeps, per nesting depth, the rule that started last: a stack.
A rule of the stack is active for a key as long as the key starts with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from catalogia.llm.common import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("verdict", T.StringType()),
])
# Distinct keys of one domain that one sweep takes.
SWEEP_ROWS = 500_000


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``a.example.org`` as ``org.example.a``; order then follows the domain tree."""
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _with_depth(rules: DataFrame) -> DataFrame:
    """Number of rules, itself included, whose key is a prefix of the rule's key."""
    sized = rules.withColumn("_l", F.length("key"))
    prefixes = sized.select(
        F.col("key").alias("whole"),
        F.explode(F.sequence(F.length("domain") + 1, F.col("_l"))).alias("_p"),
    ).select("whole", F.expr("substr(whole, 1, _p)").alias("key"))
    depth = prefixes.join(rules.select("key"), "key").groupBy("whole").agg(
        F.count(F.lit(1)).cast("int").alias("depth")
    )
    return rules.join(depth.withColumnRenamed("whole", "key"), "key")


def filter_urls(urls: DataFrame, rules: DataFrame, id_col: str, url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """id, host, path, rule, verdict of each url; ``rule`` is null and the verdict ``default`` without one.

    The longest rule wins: the longest host first, then the longest path; of equal (host, path)
    pairs ``block`` wins.  A null url, or one without ``://``, has empty host and path and fits
    no rule.  Repeated ids keep one row each in the input's number; extra columns are dropped.
    Rows of ``rules`` with a null host or verdict are ignored, a null path is empty; an empty
    rule table gives every url the default.  Equal urls are swept once.
    """
    seen = urls.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    parts = seen.select("_id", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"))
    listed = stored(_with_depth(
        rules.filter("host is not null and verdict is not null and host <> ''")
        .select(F.translate("host", UPPER, UPPER.lower()).alias("host"),
                F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("domain", reversed_host(F.col("host")))
        .withColumn("key", F.concat("domain", F.lit("/"), "path"))
    ))
    shape = listed.agg(
        F.max("depth").alias("depth"), F.max(F.size(F.split("host", r"\."))).alias("labels")
    ).first()
    if shape["depth"] is None:
        return _answer(parts, id_col, default)

    # One key per parent domain that could have rules: at most as many labels as rules use.
    labels = F.reverse(F.split("host", r"\."))
    domains = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape["labels"]))),
        lambda k: F.array_join(F.slice(labels, 1, k), "."),
    )
    keys = (
        parts.filter("host <> ''").select("host", "path", F.explode(F.array_distinct(domains)).alias("domain"))
        .join(listed.select("domain").distinct(), "domain").distinct()
    )
    best = _sweep(keys, listed, shape["depth"]).groupBy("host", "path").agg(F.max(F.struct(
        F.length("found.host").alias("h"), F.length("found.path").alias("p"),
        F.concat("found.host", "found.path").alias("rule"), F.col("found.verdict").alias("verdict"),
    )).alias("best"))
    return _answer(parts.join(best, ["host", "path"], "left"), id_col, default)


def _sweep(keys: DataFrame, rules: DataFrame, depth: int) -> DataFrame:
    """Rows of ``keys`` with the deepest rule of the stack that covers them.

    Intervals never cross from one domain to another, so each domain is swept by itself; the
    keys of a frequent one are dealt to several sweeps, each of which gets its rules.
    """
    parts = keys.groupBy("domain").agg(
        F.ceil(F.count(F.lit(1)) / SWEEP_ROWS).cast("int").alias("parts")
    )
    cut = stored(parts)
    events = ["domain", "part", "key", "kind", "host", "path", "depth", "verdict"]
    urls = keys.join(cut, "domain").select(
        "domain", F.pmod(F.xxhash64("host", "path"), F.col("parts")).cast("int").alias("part"),
        F.concat("domain", F.lit("/"), "path").alias("key"), F.lit(1).alias("kind"), "host", "path",
        F.lit(None).cast("int").alias("depth"), F.lit(None).cast("string").alias("verdict"),
    )
    started = rules.join(cut, "domain").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).withColumn("kind", F.lit(0)).select(*events)
    order = Window.partitionBy("domain", "part").orderBy("key", "kind", "depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    stack = [
        F.last(F.when((F.col("kind") == 0) & (F.col("depth") == d),
                      F.struct("key", "host", "path", "verdict")), ignorenulls=True).over(order).alias(f"_d{d}")
        for d in range(1, depth + 1)
    ]
    active = F.coalesce(*[
        F.when(F.startswith(F.col("key"), F.col(f"_d{d}.key")), F.col(f"_d{d}"))
        for d in range(depth, 0, -1)
    ])
    return (
        urls.unionByName(started).select("*", *stack).filter("kind = 1")
        .select("host", "path", active.alias("found")).filter("found is not null")
    )


def _answer(rows: DataFrame, id_col: str, default: str) -> DataFrame:
    best = "best" in rows.columns
    return rows.select(
        F.col("_id").alias(id_col), "host", "path",
        (F.col("best.rule") if best else F.lit(None).cast("string")).alias("rule"),
        F.coalesce(F.col("best.verdict") if best else F.lit(None), F.lit(default)).alias("verdict"),
    )
