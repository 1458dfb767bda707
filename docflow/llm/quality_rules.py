"""Operator 3: quality rules whose thresholds adapt to language and source.

Fixed cutoffs suit one language or site and not another. Here every rule's threshold comes
from the values that documents of the same language and source have. The values of a rule
go into a quantile sketch of logarithmic buckets: a bucket is a whole number, a sketch is
its buckets' counts, and two sketches merge by adding counts, so Spark builds them with a
partial aggregation and a group of a third of all rows shrinks before the shuffle. A
sketch has at most BUCKETS buckets, whatever the group's size; its quantiles are within
`ACCURACY` of the true ones, and equal inputs give equal thresholds, in any order.

A threshold is an upper fence: the upper quartile plus `FENCE` times the distance between
median and upper quartile, at least the rule's allowance. Clean groups thus lose nothing
by quota. A group whose own quartiles are spoiled is held by the ceiling: `LEEWAY` times
the median of the groups' fences. In this median a group weighs as many documents as it
has, but never more than all others together, so no group of any size sets the ceiling
above what the others' fences reach.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import documents, saved, widened
from docflow.llm.measures import measure

ACCURACY = 0.02
SMALLEST = 1e-4
BUCKETS = 600
FENCE = 4.0
LEEWAY = 2.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# A rule: a value that is higher in worse texts, and the value that is always allowed.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 0.02),
    "dup_lines": ("greatest(n_dup_lines - 1, 0) / greatest(n_lines, 1)", 0.10),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.15),
    "upper": ("n_upper / greatest(word_chars, 1)", 0.10),
    "word_length": ("word_chars / greatest(n_words, 1)", 12.0),
}

_LOG_GAMMA = math.log((1 + ACCURACY) / (1 - ACCURACY))


def bucket(value: str) -> str:
    """SQL: the bucket of a value of 0 or more."""
    return f"case when {value} < {SMALLEST:e} then 0 else least({BUCKETS}, 1 + cast(floor(ln({value} / {SMALLEST:e}) / {_LOG_GAMMA:.17e}) as int)) end"


def bucket_value(name: str) -> str:
    """SQL: the value that stands for a bucket."""
    return f"case when {name} = 0 then 0e0 else {SMALLEST:e} * exp(({name} - 5e-1) * {_LOG_GAMMA:.17e}) end"


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the counts of each text in its place; null and empty texts have zeros."""
    names = [*COUNTS, "n_lines", "n_upper"]

    def rows(batch: pa.RecordBatch) -> list:
        found = [measure(b) for b in w.blocks(batch.column(text))]
        return [pa.array(np.concatenate([m[n] for m in found]) if found else [], pa.int64()) for n in names]

    return widened(docs, [(n, "long") for n in names], rows, without=(text,))


def sketches(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, bucket, n): the sketches of all rules, one row per bucket in use."""
    rules = ", ".join(f"struct('{name}' as rule, {bucket(f'({value})')} as bucket)" for name, (value, _) in RULES.items())
    long = counted.select(*keys, F.expr(f"explode(array({rules}))").alias("__r"))
    return long.groupBy(*keys, "__r.rule", "__r.bucket").agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, fence, n) from the quartiles of each sketch; n is its documents."""
    over = ", ".join(f"`{k}`" for k in [*keys, "rule"])
    run = sketch.select(
        "*",
        F.expr(f"sum(n) over (partition by {over} order by bucket)").alias("__upto"),
        F.expr(f"sum(n) over (partition by {over})").alias("__all"),
    )
    at = {q: F.min(F.when(F.col("__upto") >= F.col("__all") * q, F.col("bucket"))) for q in (0.5, 0.75)}
    out = run.groupBy(*keys, "rule").agg(at[0.5].alias("__mid"), at[0.75].alias("__high"), F.max("__all").alias("n"))
    mid, high = F.expr(bucket_value("__mid")), F.expr(bucket_value("__high"))
    return out.select(*keys, "rule", (high + FENCE * (high - mid)).alias("fence"), "n")


def ceilings(own: DataFrame, sketch: DataFrame) -> DataFrame:
    """(rule, __ceiling): the lower median of the groups' fences, each group weighing its
    documents, at most as many as all others have."""
    total = sketch.groupBy("rule").agg(F.sum("n").alias("__total"))
    weight = F.least(F.col("n"), F.col("__total") - F.col("n"))
    some = own.join(total, "rule").groupBy("rule", "fence").agg(F.sum(weight).alias("weight"))
    run = some.select(
        "rule",
        "fence",
        F.expr("sum(weight) over (partition by rule order by fence)").alias("__upto"),
        F.expr("sum(weight) over (partition by rule)").alias("__all"),
    )
    return run.filter("2 * __upto >= __all").groupBy("rule").agg(F.min("fence").alias("__ceiling"))


def thresholds(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, one column per rule): the thresholds of each group."""
    fine = sketches(counted, keys)
    own = fences(fine, keys)
    least = F.create_map(*[F.lit(x) for name, (_, low) in RULES.items() for x in (name, low)])
    both = own.join(ceilings(own, fine), "rule")
    low = least[F.col("rule")]
    limit = F.greatest(low, F.least(F.col("fence"), LEEWAY * F.greatest(low, F.col("__ceiling"))))
    picked = [F.max(F.when(F.col("rule") == name, limit)).alias(f"max_{name}") for name in RULES]
    return both.groupBy(*keys).agg(*picked)


def judge(counted: DataFrame, keys: list[str]) -> DataFrame:
    """counted with base_failed and kept.

    Keys may be null: nulls are a group like any other. A text without words fails the
    base rule. Repeated rows count each. No rows, no result rows.
    """
    limits = thresholds(counted, keys)
    marks = {k: f"__k_{k}" for k in keys}
    limits = limits.select(*[F.col(k).alias(m) for k, m in marks.items()], *[f"max_{r}" for r in RULES])
    on = [F.col(k).eqNullSafe(F.col(m)) for k, m in marks.items()]
    joined = counted.join(limits, on)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for name, (value, _) in RULES.items():
        within = within & (F.expr(value) <= F.col(f"max_{name}"))
    return joined.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & within).drop(*marks.values())


def op3_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every document, with thresholds by language and source."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    counted = saved(text_counts(docs), "rule-counts")
    out = judge(counted, ["lang", "source"])
    return out.select("doc_id", *COUNTS, "base_failed", "kept")
