"""Language identification by Bayesian evidence fusion.

For every page the posterior of a language is the product of

* the likelihood of its visible text: a multinomial model over hashed byte
  trigrams, fitted here on a bounded sample of labelled documents
  (``TRAIN_DOCS`` per language) and tempered, since trigrams are not independent;
* the likelihoods of the language its markup declares (``<html lang>``, else a
  content-language meta tag) and of its address suffix (the host's last label
  and a two-letter first folder), given the language;
* the prior of its host, smoothed towards the prior of the host's suffix, and
  that towards the prior of all pages.

The conditional tables and priors are grouped sums of the pages' text
posteriors over all pages; a page's own text is left out of its host's prior.
The sums are partially aggregated, so a host with a third of all pages is one
row per task, and are joined back from staged tables.

NULL, empty or textless pages have flat text likelihoods and are decided by the
other evidence; a NULL or unreadable address has host and suffix NULL, a group
of its own; a missing declaration is evidence like any other value; repeated
rows count as often as they occur; very long pages are read whole, in time
proportional to their length; without labelled documents every page's language
is NULL; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import BROADCAST_ROWS, broadcast_if_small, fresh, staged, text_of

# Labelled documents fitted on, per language. Hash buckets of trigrams: so many,
# and fewer where that many languages would make the model larger than MODEL_CELLS.
TRAIN_DOCS = 2_000
BUCKETS = 1 << 16
MODEL_CELLS = 1 << 24
# Conditional tables up to this size are broadcast.
TABLE_BYTES = 32 * 1024 * 1024
# Trigrams that a long text counts for, smoothing of the trigram model and of
# the conditional tables, and pages' worth of belief in the next wider prior.
TEXT_TRIGRAMS = 60
TRIGRAM_ALPHA = 0.1
TABLE_ALPHA = 1.0
HOST_PAGES = 5.0

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9]*")
_ENDS = {"script": re.compile(r"</script\s*>", re.I), "style": re.compile(r"</style\s*>", re.I), "!--": re.compile("-->")}
# An attribute: a name after white space, and the letters its value begins with.
_LANG = re.compile(r"\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
_CONTENT = re.compile(r"\scontent\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
_EQUIV = re.compile(r"\shttp-equiv\s*=\s*[\"']?content-language\b", re.I)
_SPACE = re.compile(r"\s+")


def read_page(page: str) -> tuple[str, str | None]:
    """(visible text, declared language) of a page, in one pass over it.

    Tags, comments, scripts and styles are dropped; one that is not closed is a
    tag like any other, and a ``<`` without ``>`` after it is text. The language
    is that of the first ``<html lang>``, else of the first content-language
    meta tag, whatever the order of its attributes."""
    parts, at, declared, meta = [], 0, None, None
    missing = set()  # ends that do not occur any more
    while True:
        start = page.find("<", at)
        end = page.find(">", start) if start >= 0 else -1
        if end < 0:
            break
        parts.append(page[at:start])
        name = _NAME.match(page, start + 1, end)
        kind = name[0].lower() if name else "!--" if page.startswith("<!--", start) else ""
        if kind == "html" and declared is None:
            found = _LANG.search(page, name.end(), end)
            declared = found[1].lower() if found else None
        elif kind == "meta" and meta is None and _EQUIV.search(page, name.end(), end):
            found = _CONTENT.search(page, name.end(), end)
            meta = found[1].lower() if found else None
        at = end + 1
        if kind in _ENDS and kind not in missing:
            close = _ENDS[kind].search(page, start + 4 if kind == "!--" else at)
            if close:
                at = close.end()
            else:
                missing.add(kind)
    text = " ".join([*parts, page[at:]])
    return _SPACE.sub(" ", html_lib.unescape(text)).strip(), declared or meta


def visible_text(page: str) -> str:
    return read_page(page)[0]


def declared_language(page: str) -> str | None:
    return read_page(page)[1]


def buckets_for(languages: int) -> int:
    """A power of two."""
    n = BUCKETS
    while n > 256 and n * languages > MODEL_CELLS:
        n //= 2
    return n


def trigrams(text: str) -> np.ndarray:
    """Numbers below ``BUCKETS`` of the byte trigrams of the lower-cased text."""
    b = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    g = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (g * np.uint32(2654435761)) >> np.uint32(16)


# --- the text model -------------------------------------------------------------

def _counter(buckets: int):
    """Counts of a partition's sample, one array per language in it."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(lang, np.zeros(buckets, np.int64))
                counts[lang] += np.bincount(trigrams(text) % buckets, minlength=buckets)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int64)),
                                              pa.array(c[at])], names=["lang", "bucket", "n"])
    return run


class TextModel:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.buckets = languages, counts.shape[1]
        p = counts + TRIGRAM_ALPHA
        self.log_p = np.log(p / p.sum(axis=1, keepdims=True)).T.astype(np.float32)

    def log_likelihoods(self, text: str) -> np.ndarray:
        """Tempered: the mean over the trigrams times at most TEXT_TRIGRAMS."""
        g = trigrams(text) % self.buckets
        if not len(g):
            return np.zeros(len(self.languages))
        total = np.zeros(len(self.languages))
        step = max(1, (1 << 22) // max(1, len(self.languages)))
        for i in range(0, len(g), step):
            total += self.log_p[g[i:i + step]].sum(axis=0, dtype=np.float64)
        return total * (min(len(g), TEXT_TRIGRAMS) / len(g))


def training_sample(docs: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """About ``per_language`` labelled documents of each language, by a hash of their ids."""
    docs = docs.select("doc_id", "lang", "text")
    counts = staged(docs.where("lang IS NOT NULL").groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")),
                    "lang-counts")
    unit = F.pmod(F.xxhash64(F.lit(3), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return docs.join(broadcast_if_small(counts), F.col("lang") == F.col("of")).where(
        unit * F.col("n") < F.lit(float(per_language))).drop("of", "n")


_FEATURES = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bucket", T.LongType()),
                          T.StructField("n", T.LongType())])


def fit_text_model(docs: DataFrame, per_language: int = TRAIN_DOCS) -> TextModel:
    """The model of every language in ``docs``: at most MODEL_CELLS numbers (and
    256 for each language beyond that)."""
    sample = training_sample(docs, per_language).select("lang", text_of("text").alias("text"))
    languages = sorted(r.lang for r in docs.where("lang IS NOT NULL").select("lang").distinct().collect())
    buckets = buckets_for(len(languages))
    rows = (sample.mapInArrow(_counter(buckets), _FEATURES).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n")))
    counts = np.zeros((len(languages), buckets))
    number = {x: i for i, x in enumerate(languages)}
    for r in rows.toLocalIterator():  # one array per language
        counts[number[r.lang], r.at] = r.n
    return TextModel(languages, counts)


# --- evidence and fusion -----------------------------------------------------------

_EVIDENCE = T.StructType([T.StructField("declared", T.StringType()),
                          T.StructField("ll", T.ArrayType(T.DoubleType()))])


def _evidence(model):
    @F.arrow_udf(_EVIDENCE)
    def run(pages: pa.Array) -> pa.Array:
        read = [read_page(p) for p in pages.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([lang for _, lang in read], pa.string()),
             pa.array([model.value.log_likelihoods(text) for text, _ in read], pa.list_(pa.float64()))],
            ["declared", "ll"])
    return run


def _let(value, use):
    """``use`` of a value that is computed once (an expression named in a lambda
    would be computed for each element)."""
    return F.transform(F.array(value), use)[0]


def _total(mass):
    return F.aggregate(mass, F.lit(0.0), lambda a, x: a + x)


def _normalised(logs):
    """exp of log weights, adding up to 1."""
    return _let(logs, lambda v: _let(F.array_max(v), lambda top: _let(
        F.transform(v, lambda x: F.exp(x - top)), lambda w: _let(
            _total(w), lambda total: F.transform(w, lambda x: x / total)))))


def _summed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Element-wise sums of the text posteriors per group."""
    parts = df.select(*keys, F.posexplode("q").alias("i", "x")).groupBy(*keys, "i").agg(F.sum("x").alias("x"))
    return parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
                                    .alias("mass"))


def _joined(df: DataFrame, table: DataFrame, keys: list[str], name: str, n: int) -> DataFrame:
    rows = min(BROADCAST_ROWS, TABLE_BYTES // (8 * n + 100))  # a number for each language in every row
    table = broadcast_if_small(staged(table, f"lang-{name}"), rows)
    table = table.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.col("mass").alias(name))
    return df.join(table, [F.col(k).eqNullSafe(F.col(f"{name}_{k}")) for k in keys]).drop(
        *[f"{name}_{k}" for k in keys])


def fused(evidence: DataFrame, n: int) -> DataFrame:
    """``evidence`` (host, suffix, declared, ll) with the posterior array ``p``."""
    e = staged(evidence.withColumn("q", _normalised(F.col("ll"))), "lang-evidence")
    total = ([r.mass for r in _summed(e, []).collect()] or [[0.0] * n])[0]  # a number for each language
    whole = F.array(*[F.lit(float(x)) for x in total])
    pages = max(1.0, float(sum(total)))
    kinds = {c: e.select(c).distinct().count() for c in ("declared", "suffix")}
    for keys, name in ((["declared"], "by_declared"), (["suffix"], "by_suffix"), (["host"], "by_host")):
        e = _joined(e, _summed(e, keys), keys, name, n)

    def given_language(mass, i, kind):  # P(value | language)
        return (F.col(mass)[i] + TABLE_ALPHA) / (F.col("whole")[i] + TABLE_ALPHA * kinds[kind])

    def prior(i, in_suffix, in_host):
        wide = (F.col("whole")[i] + 1.0) / (pages + n)
        suffix = (F.col("by_suffix")[i] + HOST_PAGES * wide) / (in_suffix + HOST_PAGES)
        own = F.greatest(F.col("by_host")[i] - F.col("q")[i], F.lit(0.0))
        return (own + HOST_PAGES * suffix) / (in_host + HOST_PAGES)

    def logs(in_suffix, in_host):
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.col("ll")[i]
                           + F.log(given_language("by_declared", i, "declared"))
                           + F.log(given_language("by_suffix", i, "suffix")) + F.log(prior(i, in_suffix, in_host)))
    pages_of_host = F.greatest(_total("by_host") - 1.0, F.lit(0.0))  # without this page
    fused_logs = _let(_total("by_suffix"), lambda x: _let(pages_of_host, lambda y: logs(x, y)))
    return e.withColumn("whole", whole).withColumn("p", _normalised(fused_logs)).drop(
        "by_declared", "by_suffix", "by_host", "whole")


def identify(pages: DataFrame, docs: DataFrame, language: str | None = None) -> DataFrame:
    """``pages`` (url, html and any others) with a struct: host, suffix,
    declared, text_lang (by text alone), lang and confidence."""
    name = language or fresh(pages, "language")
    model = fit_text_model(docs)
    names, n = model.languages, len(model.languages)
    if not n:
        none = F.lit(None).cast("struct<host:string,suffix:string,declared:string,text_lang:string,lang:string,"
                                "confidence:double>")
        return pages.withColumn(name, none)
    shipped = pages.sparkSession.sparkContext.broadcast(model)
    host = F.lower(F.nullif(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1),
                            F.lit("")))
    folder = F.regexp_extract(F.col("url"), r"^[^:]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    rows = pages.select(F.struct(*pages.columns).alias("row"), host.alias("host"), F.lower(folder).alias("folder"),
                        _evidence(shipped)(text_of("html")).alias("e"))
    rows = rows.select(
        "row", "host", F.concat_ws("/", F.element_at(F.split("host", r"\."), -1),
                                   F.nullif(F.col("folder"), F.lit(""))).alias("suffix"),
        F.col("e.declared").alias("declared"), F.col("e.ll").alias("ll"))
    out = fused(rows, n)
    labels = F.array(*[F.lit(x) for x in names])

    def best(p):
        return F.element_at(labels, F.array_position(p, F.array_max(p)).cast("int"))
    return out.select("row.*", F.struct(
        "host", "suffix", "declared", F.when(F.array_min("q") < F.array_max("q"), best(F.col("q"))).alias("text_lang"),
        best(F.col("p")).alias("lang"), F.round(F.array_max("p"), 4).alias("confidence")).alias(name))


def op7_language_id(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per page: its host, the evidence, the fused language and its posterior."""
    out = identify(pages.select("page_id", "url", "html"), docs, "language")
    return out.select("page_id", "language.*")
