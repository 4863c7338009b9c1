"""Benchmark decontamination with an FM-index per training shard.

Benchmark items are cut into phrases of ``PHRASE_WORDS`` consecutive words (a
shorter item is one phrase). Their words are the alphabet: a task turns its
documents into numbers, every other word into a separator, and drops runs too
short to hold a phrase, where nothing can occur. What is left, some million
words at a time, is a shard: an FM-index is built over it, all phrases are
searched backwards through wavelet ranks at once, occurrences are located by
sampled suffix positions, and overlapping ones merge into removal spans.

Documents are not shuffled for the search. The phrases go to every task and are
checked to fit (``BLOCK_BYTES`` of item text, some eighty times that in a
worker); a larger benchmark is searched in blocks of items, one pass over the
texts for each, and the blocks' hits are merged per text.

NULL and empty texts and items have no words; very long texts are searched
whole, as a shard of their own. Equal item_ids count as one;
items with the same phrase are all reported; rows of documents are searched
each on its own, also when a doc_id repeats; a NULL item_id is not reported by
name but its phrases hit. Empty tables give empty results or no hits. Other
columns are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import broadcast_if_small, fresh, staged, text_of
from paylake.llm.fm_index import FMIndex, ranges

PHRASE_WORDS = 10
# Words of one index; item text searched at once.
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 4 * 1024 * 1024
# A word in either case, as Java's expressions have it.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Bytes of words: digits, lower-cased letters, everything outside ASCII.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def normalised(text: str) -> bytes:
    """Lower-cased A-Z, separators as spaces; as long as the text's UTF-8."""
    return text.encode().translate(_BYTES)


class Phrases:
    """Phrases of items as rows of word numbers, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = PHRASE_WORDS):
        self.number: dict[bytes, int] = {}
        held: dict[tuple[int, ...], set] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in normalised(text or "").split()]
            for i in range(max(1, len(words) - width + 1) if words else 0):
                held.setdefault(tuple(words[i:i + width]), set()).add(item)
        self.lengths = np.array([len(p) for p in held], np.int64)
        self.rows = np.zeros((len(held), width), np.int64)
        for i, p in enumerate(held):
            self.rows[i, :len(p)] = p
        self.items = [sorted(x for x in s if x is not None) for s in held.values()]
        self.shortest = int(self.lengths.min()) if len(held) else 0


class _Shard:
    """Runs of alphabet words of some documents, ready to be indexed."""

    def __init__(self):
        self.parts, self.docs, self.offsets, self.size = [], [], [], 0

    def add(self, doc: int, numbers: np.ndarray, shortest: int) -> None:
        bounds = np.flatnonzero(np.diff(np.concatenate([[0], numbers > 0, [0]]).astype(np.int8)))
        for s, e in zip(bounds[::2].tolist(), bounds[1::2].tolist()):
            if e - s >= shortest:
                self.parts.append(np.append(numbers[s:e], 0))
                self.docs.append(doc)
                self.offsets.append(s)
                self.size += e - s + 1

    def hits(self, phrases: Phrases) -> dict[int, tuple[list[tuple[int, int]], list[str]]]:
        """document -> merged (start, end) word spans, items that occur."""
        if not self.parts:
            return {}
        text = np.concatenate(self.parts)
        run_start = np.concatenate([[0], np.cumsum([len(p) for p in self.parts])[:-1]])
        index = FMIndex(text, len(phrases.number))
        lo, hi = index.search(phrases.rows, phrases.lengths)
        rows, which = ranges(lo, hi)
        start = index.locate(rows)
        run = np.searchsorted(run_start, start, side="right") - 1
        doc = np.array(self.docs, np.int64)[run]
        begin = np.array(self.offsets, np.int64)[run] + start - run_start[run]
        end = begin + phrases.lengths[which]
        found: dict[int, tuple[list, list]] = {}
        for i in np.lexsort((begin, doc)).tolist():
            spans = found.setdefault(int(doc[i]), ([], []))[0]
            if spans and begin[i] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], int(end[i]))
            else:
                spans.append([int(begin[i]), int(end[i])])
        for d, p in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
            found[d][1].extend(phrases.items[p])
        return {d: ([(s, e) for s, e in spans], sorted(set(items))) for d, (spans, items) in found.items()}


def search(texts: list[str], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """(words, merged spans, items) of every text, indexing about SHARD_WORDS at a time."""
    get, n_words, found, shard = phrases.number.get, [], {}, _Shard()
    for i, t in enumerate(texts):
        words = normalised(t).split()
        n_words.append(len(words))
        if phrases.shortest and len(words) >= phrases.shortest:
            numbers = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
            shard.add(i, numbers, phrases.shortest)
        if shard.size >= SHARD_WORDS:
            found |= shard.hits(phrases)
            shard = _Shard()
    found |= shard.hits(phrases)
    return [(n, *found.get(i, ([], []))) for i, n in enumerate(n_words)]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less the bytes from each span's first to its last word; a
    line break stays where something was cut out."""
    raw, words = text.encode(), [m.span() for m in _WORD.finditer(normalised(text))]
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:words[s][0]])
        at = words[e - 1][1]
    out.append(raw[at:])
    return b"\n".join(out).decode()


def cleaned(texts: list[str], phrases: Phrases) -> list[str]:
    """Texts with every occurrence removed; what a cut joins is searched again."""
    texts, todo = list(texts), range(len(texts))
    while todo:
        found = search([texts[i] for i in todo], phrases)
        todo = [(i, spans) for i, (_, spans, _) in zip(todo, found) if spans]
        for i, spans in todo:
            texts[i] = without(texts[i], spans)
        todo = [i for i, _ in todo]
    return texts


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str | None]]]:
    """The query set (item_id as string, text), in blocks of bounded size."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).toLocalIterator():
        if block and size + len(r.t or "") > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += len(r.t or "")
    yield block


_HIT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                     T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])
_ARROW_HIT = pa.struct([("n_words", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("items", pa.list_(pa.string()))])


def _searcher(items):
    """A column function for one block; a worker builds the phrases once."""
    state = []

    @F.arrow_udf(_HIT)
    def run(batch: pa.Array) -> pa.Array:
        if not state:
            state.append(Phrases(items))
        rows = [{"n_words": n, "spans": [{"start": s, "end": e} for s, e in spans], "items": names}
                for n, spans, names in search([t or "" for t in batch.to_pylist()], state[0])]
        return pa.array(rows, type=_ARROW_HIT)
    return run


def _only_block(benchmark: DataFrame):
    """The block, if there is just one."""
    blocks = item_blocks(benchmark)
    first = next(blocks)
    return first if next(blocks, None) is None else None


def find_benchmark(docs: DataFrame, benchmark: DataFrame, hits: str | None = None) -> DataFrame:
    """``docs`` with ``n_words``, removal ``spans`` of words and ``items`` in a struct column."""
    hits, block = hits or fresh(docs, "hits"), _only_block(benchmark)
    if block is not None:
        return docs.withColumn(hits, _searcher(block)(text_of("text")))
    return _found_by_blocks(docs, benchmark, hits)


_SPANS = "array<struct<start:bigint,end:bigint>>"


def _joined_spans(spans):
    """Sorted spans with those that overlap or touch as one."""
    def last(acc):
        return F.element_at(acc, -1)
    return F.aggregate(
        F.array_sort(spans), F.array().cast(_SPANS),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] <= last(acc)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))


def _found_by_blocks(docs: DataFrame, benchmark: DataFrame, hits: str) -> DataFrame:
    """``docs`` with the hits of all blocks. Every block is a pass of its own
    over the texts, so that a worker and the driver hold one block at a time;
    a pass hands on what it found, once for equal texts."""
    text = text_of("text")
    marks = [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]
    found = None
    for block in item_blocks(benchmark):
        x = docs.select(*marks, _searcher(block)(text).alias("x")).where(F.size("x.spans") > 0)
        part = staged(x.groupBy("h1", "h2").agg(F.first("x.spans").alias("spans"), F.first("x.items").alias("items")),
                      "benchmark-block")
        found = part if found is None else found.unionByName(part)
    merged = staged(found.groupBy("h1", "h2").agg(F.flatten(F.collect_list("spans")).alias("spans"),  # a row per block
                                                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
                    .withColumn("spans", _joined_spans(F.col("spans"))), "benchmark-found")
    h1, h2, own = fresh(docs, "llm_h1"), fresh(docs, "llm_h2"), fresh(docs, "llm_found")
    merged = merged.select(F.col("h1").alias(f"{own}_1"), F.col("h2").alias(f"{own}_2"),
                           F.struct("spans", "items").alias(own))
    joined = docs.withColumn(h1, marks[0]).withColumn(h2, marks[1]).join(
        broadcast_if_small(merged), (F.col(h1) == F.col(f"{own}_1")) & (F.col(h2) == F.col(f"{own}_2")), "left")
    none = F.array().cast("array<string>")
    return joined.withColumn(hits, F.struct(
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.coalesce(F.col(own)["spans"], F.array().cast(_SPANS)).alias("spans"),
        F.coalesce(F.col(own)["items"], none).alias("items"))).drop(h1, h2, own, f"{own}_1", f"{own}_2")


def _cleaner(items):
    state = []

    @F.arrow_udf(T.StringType())
    def run(batch: pa.Array) -> pa.Array:
        if not state:
            state.append(Phrases(items))
        texts = batch.to_pylist()
        clean = cleaned([t or "" for t in texts], state[0])
        return pa.array([None if t is None else c for t, c in zip(texts, clean)], pa.string())
    return run


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    rows = zip(texts.to_pylist(), spans.to_pylist())
    return pa.array([without(t, [(s["start"], s["end"]) for s in cuts]) for t, cuts in rows], pa.string())


def _cut_by_blocks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What ``cleaned`` does, with the phrases in several blocks: all blocks'
    spans of a text are merged and cut at once, and the texts that were cut are
    searched again for all blocks until none has a span. Every round cuts
    words, so the rounds end."""
    hits = fresh(docs, "llm_hits")
    hit = F.size(F.col(hits)["spans"]) > 0
    out, todo = None, docs
    while True:
        found = staged(_found_by_blocks(todo, benchmark, hits), "benchmark-hits")
        clean = found.where(~hit).drop(hits)
        out = clean if out is None else out.unionByName(clean)
        if found.where(hit).isEmpty():
            return out
        todo = found.where(hit).withColumn("text", _cut(F.col("text"), F.col(hits)["spans"])).drop(hits)


def remove_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with every occurrence of a phrase cut out of ``text`` (and
    ``n_chars`` set anew where a text changed); other rows stay as they are.
    Words that a cut brings together are searched again, so no occurrence is
    left; the result does not depend on the size of the blocks."""
    was = fresh(docs, "llm_text")
    out, block = docs.withColumn(was, F.col("text")), _only_block(benchmark)
    out = _cut_by_blocks(out, benchmark) if block is None else out.withColumn("text", _cleaner(block)(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").eqNullSafe(F.col(was)), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.drop(was)


def op8_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_benchmark(docs.select("doc_id", "text"), benchmark, "hits").select("doc_id", "hits.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
