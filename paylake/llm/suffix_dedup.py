"""Repeated passages by sparse suffix arrays.

Of all suffixes of a text's word sequence only those at minimiser positions
are kept: in every window of ``PASSAGE - SEED_WORDS + 1`` consecutive seeds
(runs of ``SEED_WORDS`` words) the one with the least hash. The choice depends
on the words alone, so two texts that share a passage of ``PASSAGE`` words
keep at least one suffix at the same place in it.

1. The kept suffixes of all documents are sorted by their first
   ``SEED_WORDS`` words (a 64-bit hash) and doc_id, and neighbours compared: a
   suffix matches when one next to it has the same words in another document.
2. Matches are extended to the left and right: every passage-long window that
   has a matching suffix as its minimiser is sorted among its like by the
   window's words (a 96-bit hash) and doc_id, and neighbours are compared
   again. Windows that agree in two documents are repeated; consecutive ones
   merge into maximal passages.

Both sorts are range partitionings on hash and doc_id, so equal suffixes found
in a third of all documents spread over as many tasks as they need; a task
streams its range and hands on only what matched, plus the first and last run
of its range, which are compared across ranges in a small join. The result is
exact up to hash collisions: a word is in a reported passage if and only if it
is in ``PASSAGE`` consecutive words that also occur in another document. Only
documents with a matching suffix have their texts moved.

NULL and empty texts have no words; a text shorter than a passage has none
to report; rows that share a doc_id are one document (so copies under one
doc_id are not repeats); a NULL doc_id is a document of its own, sorted first
and reported as NULL; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from paylake.llm.common import broadcast_if_small, discard, fresh, row_key, staged, text_of

PASSAGE = 50
SEED_WORDS = 20
MEMO_WORDS = 400_000

_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
# doc_id that stands for NULL in comparisons.
NULL_ID = -(1 << 63)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 7)
        if len(self) < MEMO_WORDS:
            self[word] = h
        return h


_HASH = _WordHash()


def word_hashes(text: str) -> np.ndarray:
    words = text.encode().split()
    if len(_HASH) >= MEMO_WORDS:
        _HASH.clear()
    return np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(h: np.ndarray, width: int, base: np.uint64 = _B1) -> np.ndarray:
    """Hash of every run of ``width`` words, by doubling: the hash of two
    adjacent runs is that of the first times the base's power, plus the second's."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    done, out = 0, None
    run, length, power = h, 1, int(base)  # hashes of all runs of ``length``; power = base ** length
    while True:
        if width >> (length.bit_length() - 1) & 1:
            part = run[done:done + n]
            out = part if out is None else out * np.uint64(power) + part
            done += length
        if done == width:
            return mixed(out)
        run = run[:-length] * np.uint64(power) + run[length:]
        length, power = length * 2, power * power % (1 << 64)


def minimisers(seeds: np.ndarray, window: int) -> np.ndarray:
    """For every window of consecutive seeds, the position of its least (leftmost) one."""
    n = len(seeds) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, length = np.arange(len(seeds)), 1
    while length * 2 <= window:
        a, b = at[:-length], at[length:]
        at = np.where(seeds[a] <= seeds[b], a, b)
        length *= 2
    a, b = at[:n], at[window - length:window - length + n]
    return np.where(seeds[a] <= seeds[b], a, b)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _kept_suffixes(texts: pa.Array, passage: pa.Array, seed: pa.Array) -> pa.Array:
    """Seed hashes at the kept positions of every text."""
    out = []
    k, s = (passage[0].as_py(), seed[0].as_py()) if len(texts) else (1, 1)
    for t in texts.to_pylist():
        seeds = gram_hashes(word_hashes(t), s)
        kept = np.unique(minimisers(seeds, k - s + 1))
        out.append(np.unique(seeds[kept]).view(np.int64))
    return pa.array(out, pa.list_(pa.int64()))


_WINDOWS = T.StructType([T.StructField("starts", T.ArrayType(T.IntegerType())),
                         T.StructField("h1", T.ArrayType(T.LongType())),
                         T.StructField("h2", T.ArrayType(T.IntegerType()))])


@F.arrow_udf(_WINDOWS)
def _windows(texts: pa.Array, matching: pa.Array, passage: pa.Array, seed: pa.Array) -> pa.Array:
    """Start and hash of the windows whose minimiser is among the matching seeds."""
    cols: list[list] = [[], [], []]
    k, s = (passage[0].as_py(), seed[0].as_py()) if len(texts) else (1, 1)
    at_seed, all_seeds = matching.offsets.to_pylist(), matching.values.to_numpy()
    for t, a, b in zip(texts.to_pylist(), at_seed, at_seed[1:]):
        h, seen = word_hashes(t), all_seeds[a:b]
        seeds = gram_hashes(h, s)
        at = minimisers(seeds, k - s + 1)
        starts = np.flatnonzero(np.isin(seeds[at].view(np.int64), seen))
        cols[0].append(starts.astype(np.int32))
        cols[1].append(gram_hashes(h, k, _B1)[starts].view(np.int64))
        cols[2].append((gram_hashes(h, k, _B2)[starts] >> np.uint64(32)).astype(np.uint32).view(np.int32))
    return pa.StructArray.from_arrays([pa.array(cols[0], pa.list_(pa.int32())), pa.array(cols[1], pa.list_(pa.int64())),
                                       pa.array(cols[2], pa.list_(pa.int32()))], ["starts", "h1", "h2"])


def _neighbours(hashes: list[str], rest: list[str]):
    """Compares a sorted range run by run (rows of one hash and id): keeps the
    rows with a neighbour of the same hash, and the range's first and last run."""
    keys = [*hashes, "id"]

    def run(batches):
        held, before, opened = None, None, False  # rows of the open run, the run before it, any run out yet

        def done(rows: dict, following: tuple | None, last: bool):
            """All runs of ``rows``; ``following`` is the run after them."""
            nonlocal before, opened
            new = np.ones(len(rows["id"]), bool)
            new[1:] = np.logical_or.reduce([rows[k][1:] != rows[k][:-1] for k in keys])
            first = np.flatnonzero(new)
            runs = [rows[k][first] for k in keys]
            prev, nxt = np.full(len(first), NULL_ID), np.full(len(first), NULL_ID)
            has_prev, has_next = np.zeros(len(first), bool), np.zeros(len(first), bool)
            same = np.logical_and.reduce([h[1:] == h[:-1] for h in runs[:-1]])
            has_prev[1:], has_next[:-1] = same, same
            prev[1:][same], nxt[:-1][same] = runs[-1][:-1][same], runs[-1][1:][same]
            if before is not None and all(h[0] == b for h, b in zip(runs[:-1], before)):
                has_prev[0], prev[0] = True, before[-1]
            if following is not None and all(h[-1] == f for h, f in zip(runs[:-1], following)):
                has_next[-1], nxt[-1] = True, following[-1]
            edge = np.zeros(len(first), bool)
            edge[0] = not opened
            edge[-1] |= last
            before, opened = tuple(r[-1] for r in runs), True
            of = np.cumsum(new) - 1
            keep = np.flatnonzero((has_prev | has_next | edge)[of])
            of = of[keep]
            cols = [pa.array(rows[k][keep]) for k in (*keys, *rest)]
            cols += [pa.array(prev[of], mask=~has_prev[of]), pa.array(nxt[of], mask=~has_next[of]), pa.array(edge[of])]
            return pa.RecordBatch.from_arrays(cols, names=[*keys, *rest, "prev", "next", "edge"])
        for batch in batches:
            rows = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in (*keys, *rest)}
            if held is not None:
                rows = {k: np.concatenate([held[k], rows[k]]) for k in rows}
            n = len(rows["id"])
            if n == 0:
                continue
            open_run = np.logical_and.reduce([rows[k] == rows[k][-1] for k in keys])
            cut = int(n - np.argmin(open_run[::-1])) if not open_run.all() else 0
            if cut:
                yield done({k: v[:cut] for k, v in rows.items()}, tuple(rows[k][-1] for k in keys), False)
            held = {k: v[cut:] for k, v in rows.items()}
        if held is not None:
            yield done(held, None, True)
    return run


def matching_neighbours(rows: DataFrame, hashes: list[str], rest: list[str], made: list[str] | None = None) -> DataFrame:
    """Sorts ``rows`` (integer columns ``hashes``, ``id`` and ``rest``) by hash and
    id, and gives those that have a neighbour of the same hash and another id,
    with the nearest smaller id ``prev`` and larger id ``next`` (NULL: none)."""
    order = [*hashes, "id"]
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in (*order, *rest, "prev", "next")]
                          + [T.StructField("edge", T.BooleanType())])
    found = staged(rows.select(*order, *rest).repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_neighbours(hashes, rest), schema), "suffix-neighbours", made)
    # Ranges meet at their first and last runs, two per task: among those of a
    # hash, in order of id, the runs next to each other are the neighbours.
    edges = found.where("edge")
    beside = W.partitionBy(*hashes).orderBy("id")
    runs = edges.select(*order).distinct().select(
        *[F.col(c).alias(f"o_{c}") for c in order], F.lag("id").over(beside).alias("o_prev"),
        F.lead("id").over(beside).alias("o_next"))
    near = edges.join(runs, [F.col(c) == F.col(f"o_{c}") for c in order]).select(
        *order, *rest, F.coalesce("prev", "o_prev").alias("prev"), F.coalesce("next", "o_next").alias("next"))
    return (found.where("NOT edge").select(*order, *rest, "prev", "next").unionByName(near)
            .where("prev IS NOT NULL OR next IS NOT NULL"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``key`` that tells apart rows of one id: 0 where an id
    has only one text, so that it costs nothing to carry along."""
    ends = rows.groupBy(F.col("id").alias("s_id")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    several = broadcast_if_small(staged(ends.where("lo <> hi").select("s_id"), "suffix-several"))
    return rows.join(several, F.col("id") == F.col("s_id"), "left").withColumn(
        "key", F.when(F.col("s_id").isNull(), F.lit(0).cast("long")).otherwise(F.col("key"))).drop("s_id")


def repeated_windows(docs: DataFrame, passage: int = PASSAGE, seed: int = SEED_WORDS) -> DataFrame:
    """(id, key, start, prev, next) of every window of ``passage`` words that
    occurs in two documents. ``id`` is doc_id with NULL_ID for NULL, ``key``
    tells apart rows that share it (0: none do)."""
    text, made = text_of("text"), []
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), _text_key().alias("key"),
                       text.alias("text"))
    k, s = F.lit(passage), F.lit(seed)
    suffixes = staged(rows.select(F.explode(_kept_suffixes("text", k, s)).alias("seed"), "id"), "suffixes", made)
    matching = matching_neighbours(suffixes, ["seed"], [], made)
    per_doc = matching.groupBy("id").agg(F.collect_set("seed").alias("seeds")).withColumnRenamed("id", "m_id")
    windows = (_keyed(rows).join(per_doc, F.col("id") == F.col("m_id"))
               .select("id", "key", _windows("text", "seeds", k, s).alias("w"))
               .select("id", "key", F.explode(F.arrays_zip("w.starts", "w.h1", "w.h2")).alias("w"))
               .select("id", "key", F.col("w.starts").alias("start"), F.col("w.h1").alias("h1"),
                       F.col("w.h2").alias("h2")))
    windows = staged(windows, "suffix-windows")
    discard(docs.sparkSession, made)
    return matching_neighbours(windows, ["h1", "h2"], ["key", "start"]).select(
        "id", "key", F.col("start").cast("long").alias("start"), "prev", "next")


def _text_key():
    """A row's key; never 0, which says that none is needed."""
    key = row_key(text_of("text"))
    return F.when(key == 0, F.lit(1).cast("long")).otherwise(key)


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("other", T.LongType())]))


def merge_windows(doc: np.ndarray, start: np.ndarray, other: np.ndarray, passage: int):
    """Overlapping or touching windows of each document (numbers ``doc``) as
    maximal passages: doc, start, end and least other, by doc and start."""
    order = np.lexsort((start, doc))
    doc, start, other = doc[order], start[order], other[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + passage)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], start[last] + passage, (np.minimum.reduceat(other, first) if len(first) else other)


@F.arrow_udf(_SPAN)
def _passages(windows: pa.Array, passage: pa.Array) -> pa.Array:
    n = len(windows)
    flat, sizes = windows.flatten(), np.diff(windows.offsets.to_numpy())
    doc, start, end, other = merge_windows(
        np.repeat(np.arange(n), sizes), flat.field("start").to_numpy(zero_copy_only=False),
        flat.field("other").to_numpy(zero_copy_only=False), passage[0].as_py() if n else 1)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(start), pa.array(end), pa.array(other)], ["start", "end", "other"])
    return pa.ListArray.from_arrays(pa.array(offsets), spans)


def _spans(windows: DataFrame, passage: int) -> DataFrame:
    """(id, key, spans): a document's windows meet here, at most its own words."""
    w = F.struct("start", F.coalesce("prev", "next").alias("other"))
    return windows.groupBy("id", "key").agg(F.collect_list(w).alias("ws")).select(
        "id", "key", _passages("ws", F.lit(passage)).alias("spans"))


def _plain(c: str):
    return F.when(F.col(c) != NULL_ID, F.col(c))


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, seed: int = SEED_WORDS) -> DataFrame:
    """One row per maximal passage: doc_id, key (0 where no other text has the doc_id), word offsets ``start`` and
    ``end`` (exclusive) and ``other``, a document that shares words of it (a
    smaller doc_id if one does)."""
    spans = _spans(repeated_windows(docs, passage, seed), passage).select("id", "key", F.explode("spans").alias("p"))
    return spans.select("id", "key", "p.*").select(_plain("id").alias("doc_id"), "key", "start", "end",
                                                   _plain("other").alias("other"))


def cut_repeats(docs: DataFrame, passage: int = PASSAGE, seed: int = SEED_WORDS) -> DataFrame:
    """``docs`` with every passage that a smaller doc_id has too taken out of
    ``text``; a line break stays where something was cut."""
    key, spans = fresh(docs, "llm_key"), fresh(docs, "llm_spans")
    r_id, r_key = fresh(docs, "llm_id"), fresh(docs, "llm_key_r")
    later = _spans(repeated_windows(docs, passage, seed).where("prev IS NOT NULL"), passage).select(
        _plain("id").alias(r_id), F.col("key").alias(r_key), F.col("spans").alias(spans))
    joined = docs.withColumn(key, _text_key()).join(
        later, F.col("doc_id").eqNullSafe(F.col(r_id)) & ((F.col(r_key) == 0) | (F.col(key) == F.col(r_key))), "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(_cut(text_of("text"), F.col(spans)))
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


@F.arrow_udf(T.StringType())
def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, ss in zip(texts.to_pylist(), spans.to_pylist()):
        if not ss:
            out.append(t)
            continue
        raw = t.encode()
        words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        parts, at = [], 0
        for x in ss:
            parts.append(raw[at:words[x["start"]][0]])
            at = words[x["end"] - 1][1]
        out.append(b"\n".join([*parts, raw[at:]]).decode())
    return pa.array(out, pa.string())


def op1_suffix_dedup(docs: DataFrame) -> DataFrame:
    """Every maximal passage of 50 words or more that a document shares with
    another: doc_id, start and end in words, its length, and a document that
    shares words of it."""
    found = repeated_passages(docs.select("doc_id", "text"))
    return found.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"),
                        F.col("other").alias("other_doc_id"))
