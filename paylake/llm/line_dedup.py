"""Line dedup with DataFrame functions only.

Lines are exploded and hashed; hashes seen often enough become candidates; the
candidates' rows are counted exactly per normalised line; the lines to drop
are gathered per document by position, and the document is reassembled from
the positions that stay.

A line's key is the line stripped of ASCII white space with A-Z lower-cased.
Lines are first grouped by a 128-bit hash of their fully lower-cased form,
which never separates equal keys; the exact key is formed for candidates only.
Counting is partially aggregated before every shuffle, so a line found in a
third of all documents costs one row per task; the joins back run against
staged tables, where skewed partitions are split.

NULL and empty texts are one empty line and stay; NULL doc_id counts as one
document, smaller than any number; rows that share a doc_id are one document
for counting and keep or lose their lines alike; a very long text is exploded
like any other, and only its line numbers meet again; an empty table gives an
empty result. Other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import SPACES, broadcast_if_small, fresh, row_key, staged, text_of

MIN_CHARS = 20
MIN_DOCS = 3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _hashes(value: Column) -> list[Column]:
    """Two independent 64-bit hashes: at 10^12 lines one alone would collide."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, key, positions) of the documents that lose lines; ``key`` is
    the row key of the text."""
    text = text_of("text")
    lines = (docs.select("doc_id", row_key(text).alias("key"), F.posexplode(lines_of(text)).alias("pos", "line"))
             .select("doc_id", "key", "pos", stripped(F.col("line")).alias("line"))
             .where(F.length("line") >= min_chars))
    coarse = lines.select("doc_id", "key", "pos", "line", *_hashes(F.lower("line")))
    often = staged(coarse.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") >= min_docs).select("h1", "h2"), "line-often")
    rows = staged(coarse.join(broadcast_if_small(often), ["h1", "h2"])
                  .select("doc_id", "key", "pos", F.translate("line", UPPER, UPPER.lower()).alias("line"))
                  .select("doc_id", "key", "pos", *_hashes(F.col("line"))), "line-rows")
    # NULL ids: countDistinct and max pass over them, so they are counted beside
    shared = (rows.groupBy("h1", "h2")
              .agg(F.count_distinct("doc_id").alias("n"), F.max(F.col("doc_id").isNull().cast("int")).alias("nulls"),
                   F.max("doc_id").alias("last"))
              .where(F.col("n") + F.col("nulls") >= min_docs).select("h1", "h2", "last"))
    shared = broadcast_if_small(staged(shared, "line-shared"))
    return (rows.join(shared, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
            .groupBy("doc_id", "key").agg(F.collect_set("pos").alias("positions")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, and two more
    columns: ``n_lines`` before dropping and ``n_dropped`` (with a number behind
    the name where ``docs`` has such a column)."""
    drops = dropped_positions(docs, min_chars, min_docs)
    key = fresh(docs, "llm_key")
    r_id, r_key, gone = (fresh(docs, x) for x in ("llm_id", "llm_key_r", "llm_gone"))
    lines, stay = fresh(docs, "llm_lines"), fresh(docs, "llm_stay")
    drops = drops.select(F.col("doc_id").alias(r_id), F.col("key").alias(r_key), F.col("positions").alias(gone))
    joined = docs.withColumn(key, row_key(text_of("text"))).join(
        drops, (F.col(key) == F.col(r_key)) & F.col("doc_id").eqNullSafe(F.col(r_id)), "left")
    split = joined.withColumn(lines, lines_of(text_of("text")))
    kept = F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)),
        lambda i: F.element_at(F.col(lines), i + 1)))
    return (split.withColumn(stay, kept)
            .select(*[F.array_join(stay, "\n").alias(c) if c == "text" else F.col(c) for c in docs.columns],
                    F.size(lines).cast("long").alias(fresh(docs, "n_lines")),
                    (F.size(lines) - F.size(stay)).cast("long").alias(fresh(docs, "n_dropped"))))


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
