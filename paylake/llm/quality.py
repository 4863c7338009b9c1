"""Quality rules with adaptive thresholds.

Per document a few ratios are measured. Per language and source each ratio's
distribution is summarised in a mergeable quantile sketch: counts in
log-linear buckets (exact below 64, relative width 1/32 above), which add up
in any order, so partial sketches of a hot source are combined before the
shuffle and reruns agree bit for bit. Sketches of a language, and of
everything, are the sums of their parts. The sketches are of the documents that
pass the base rules, so junk does not widen its own fence. A document fails when
a ratio lies above its group's fence ``q90 + SPREAD * (q90 - q50)`` (the distance
never taken smaller than the sketch's resolution, ``q50 / 32``) and the count
behind it is worth the name (``LEAST``; one repeated line of three is a third,
and no fault by itself); word length also fails below the mirrored fence. A
group with too few documents uses its language's fence, and failing that the
fence of all documents.

NULL and empty texts have no words and fail the base rule; very long texts are
measured whole, in memory of a few times their size; NULL lang or source is a
group of its own; equal rows fare alike; an empty table gives an empty result. Other columns are untouched.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from paylake.llm.common import SPACES, broadcast_if_small, fresh, row_key, staged, text_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# A group's own fence needs this many measured documents.
MIN_GROUP = 200
# Multiple of the distance between the median and the upper decile that a fence
# keeps from the decile, and the least counts of symbols, repeated words and
# duplicate lines that a document can fail by.
SPREAD = 5
LEAST = {"symbols": 10, "repeats": 60, "dup_lines": 4, "word_length": 0}
BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"
TWO_SIDED = ("word_length",)

_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list) -> int:
    """Words in 3-word windows that occur twice or more, first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total = end = 0
    for i, x in enumerate(windows):
        if seen[x] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = text.split("\n")
    held = [x for x in lines if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(held) - len(set(held)), repeated_words(words), len(lines))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in _METRICS]))
def _measure(texts: pa.Array) -> pa.Array:
    columns = zip(*(measure(t or "") for t in texts.to_pylist())) if len(texts) else [[]] * len(_METRICS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(_METRICS))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, key of the row's content, lang, source and the metrics of every row."""
    m = _measure(text_of("text"))
    return (docs.select("doc_id", row_key(F.col("text"), F.col("lang"), F.lit("|"), F.col("source")).alias("key"),
                        "lang", "source", m.alias("m"))
            .select("doc_id", "key", "lang", "source", "m.*"))


def ratios() -> Column:
    """Scaled integer ratios of a document with words, as an array of (metric,
    value, enough): the least value of its bucket, and whether the count behind
    it is at least ``LEAST``."""
    def ratio(name, scale, num, den):
        value = value_of(f"({bucket_text(f'({scale} * {num} div {den})')})")  # as the sketch has it
        return F.struct(F.lit(name).alias("metric"), value.alias("value"),
                        (F.col(num) >= LEAST[name]).alias("enough"))
    return F.array(ratio("symbols", 1000, "n_symbols", "n_words"), ratio("repeats", 1000, "n_repeat_words", "n_words"),
                   ratio("dup_lines", 1000, "n_dup_lines", "n_lines"), ratio("word_length", 100, "word_chars", "n_words"))


def bucket_text(value: str) -> str:
    e = f"greatest(length(bin({value})) - 6, 0)"
    return f"CAST({e} * 32 + shiftright({value}, {e}) AS BIGINT)"


def bucket_of(value: str) -> Column:
    """Log-linear bucket of a non-negative integer: the value itself below 64,
    else 32 buckets for every doubling."""
    return F.expr(bucket_text(value))


def value_of(bucket: str) -> Column:
    """Least value of a bucket."""
    e = f"greatest({bucket} div 32 - 1, 0)"
    return F.expr(f"shiftleft({bucket} - {e} * 32, CAST({e} AS INT))")


def sketch(metrics: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket) -> n over documents that pass the base rules."""
    return (metrics.where(f"NOT {BASE_FAILED}").select("lang", "source", F.explode(ratios()).alias("r"))
            .select("lang", "source", "r.metric", bucket_of("r.value").alias("bucket"))
            .groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric) -> n, lo, hi from merged sketches. The windows run over
    one group's buckets, a few hundred rows whatever the number of documents."""
    merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*keys, "metric")
    ranked = merged.select(*keys, "metric", "bucket", F.sum("n").over(group).alias("total"),
                           F.sum("n").over(group.orderBy("bucket")).alias("upto"))

    def decile(k):
        return F.min(F.when(F.expr(f"10 * upto >= {k} * total"), value_of("bucket")))
    q = ranked.groupBy(*keys, "metric").agg(F.max("total").alias("n"), decile(1).alias("low"), decile(5).alias("mid"),
                                            decile(9).alias("high"))
    least = F.expr("mid div 32")  # what the sketch can tell apart
    below = F.col("low") - SPREAD * F.greatest(F.col("mid") - F.col("low"), least)
    return q.select(*keys, "metric", "n", F.when(F.col("metric").isin(*TWO_SIDED), below).otherwise(F.lit(-1)).alias("lo"),
                    (F.col("high") + SPREAD * F.greatest(F.col("high") - F.col("mid"), least)).alias("hi"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): a map metric -> (lo, hi), taken from the
    finest level that has enough documents."""
    own = fences(sketches, ["lang", "source"])
    lang = fences(sketches, ["lang"]).select(F.col("lang").alias("lang_2"), F.col("metric").alias("metric_2"),
                                             F.col("n").alias("n_2"), F.col("lo").alias("lo_2"),
                                             F.col("hi").alias("hi_2"))
    every = fences(sketches, []).select(F.col("metric").alias("metric_3"), F.col("lo").alias("lo_3"),
                                        F.col("hi").alias("hi_3"))
    joined = (own.join(lang, F.col("lang").eqNullSafe(F.col("lang_2")) & (F.col("metric") == F.col("metric_2")))
              .join(F.broadcast(every), F.col("metric") == F.col("metric_3")))  # one row per metric

    def level(c):
        return F.when(F.col("n") >= MIN_GROUP, F.col(c)).when(F.col("n_2") >= MIN_GROUP, F.col(f"{c}_2")) \
            .otherwise(F.col(f"{c}_3"))
    return (joined.select("lang", "source", "metric", F.struct(level("lo").alias("lo"), level("hi").alias("hi"))
                          .alias("fence"))
            .groupBy("lang", "source")
            .agg(F.map_from_entries(F.collect_list(F.struct("metric", "fence"))).alias("fences")))


def judged(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, key, the metrics, base_failed, failed
    (metrics outside their fence, for documents that pass the base rules) and kept."""
    metrics = staged(measured(docs), "quality-metrics")
    fence = broadcast_if_small(staged(thresholds(sketch(metrics)), "quality-fences"))
    fence = fence.select(F.col("lang").alias("fence_lang"), F.col("source").alias("fence_source"), "fences")
    out = metrics.join(fence, F.col("lang").eqNullSafe(F.col("fence_lang"))
                       & F.col("source").eqNullSafe(F.col("fence_source")), "left")
    base = F.expr(BASE_FAILED)
    failed = F.when(~base, F.transform(
        F.filter(ratios(), lambda r: r.enough & ((r.value > F.col("fences")[r.metric].hi)
                                                 | (r.value < F.col("fences")[r.metric].lo))), lambda r: r.metric)) \
        .otherwise(F.array().cast("array<string>"))
    return (out.select("doc_id", "key", *_METRICS, base.alias("base_failed"), failed.alias("failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. The verdict
    depends on text, lang and source alone, so equal rows share it."""
    verdict = judged(docs).where("kept").select("doc_id", "key").distinct()
    key, right_id, right_key = fresh(docs, "llm_key"), fresh(docs, "llm_id"), fresh(docs, "llm_key_2")
    keyed = docs.withColumn(key, row_key(F.col("text"), F.col("lang"), F.lit("|"), F.col("source")))
    verdict = verdict.select(F.col("doc_id").alias(right_id), F.col("key").alias(right_key))
    return keyed.join(verdict, (F.col(key) == F.col(right_key)) & F.col("doc_id").eqNullSafe(F.col(right_id)),
                      "left_semi").drop(key)


def op4_quality_rules(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept")
