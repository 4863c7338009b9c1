"""Mixing sources to target weights, with DataFrame functions only.

1. Every source gets a target in words: its weight's part of the mix, at most
   ``MAX_EPOCHS`` times its own size, the excess reshared by weight.
2. A source's documents are put in a random order (a seeded hash); the order,
   gone through up to ``MAX_EPOCHS`` times, is the source's stream, and the
   part of it up to the target is the mix's. Stream offsets are distributed
   prefix sums: exact sums per hash range, added up over the ranges, then a
   running sum inside each range, so no source is ever one task's work.
3. The stream is cut into blocks of equal words, which gives every source an
   exact quota of blocks. A splitting tree deals the quotas out: a node splits
   its shards in halves and draws, without replacement, how many of each
   source's blocks go left (a multivariate hypergeometric draw, made by
   selection sampling from seeded hashes). The leaves are the shards' quotas.
4. Each source's blocks are permuted and the shards draw disjoint runs of
   them; a document's copy goes where the block it starts in goes, and each
   shard is ordered by a seeded hash of its copies.

A copy is taken when its middle word lies before the target, so a source's
words miss the target by at most half of one document, and no document is
taken more than ``MAX_EPOCHS`` times. Equal seeds give equal results.

NULL and empty texts have size 0 and are not taken; NULL source is a source,
listed last; NULL doc_id is a value like any other; equal rows are documents
of their own (which of them is taken is not observable); an empty table gives
an empty result. Other columns are passed through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from paylake.llm.common import broadcast_if_small, fresh, row_key, staged, text_of, word_count

WEIGHTS = (5, 2, 1)
MIX_SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
# Words of one output shard, blocks a shard is made of, and words a hash
# range should hold (the unit of the prefix sums).
SHARD_WORDS = 20_000_000
MIN_SHARDS = 8
BLOCKS_PER_SHARD = 64
RANGE_WORDS = 200_000
# Blocks of one hash range of blocks, and places in which a block looks for its run.
RANGE_BLOCKS = 50_000
STRETCH = 256


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = MIX_SHARE) -> DataFrame:
    """(source, source_size, target) from (source, size) rows. Capping and
    resharing by weight ends where target = min(cap, weight * level): with the
    sources in order of cap / weight, the level is the first at which the
    words left, shared by the weights left, exceed no cap."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.row_number().over(listed) - 1) % len(weights) + 1)
    per = per.select("source", "source_size", weight.alias("weight"),
                     (F.lit(share) * F.sum("source_size").over(W.partitionBy())).alias("mix"),
                     (MAX_EPOCHS * F.col("source_size")).alias("cap"))
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(before.rowsBetween(W.currentRow, W.unboundedFollowing))
    level = per.withColumn("level", (F.col("mix") - capped) / left)
    # past the first such place the level only falls
    found = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(W.partitionBy())
    return level.withColumn("found", found).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("found"), F.col("cap")))
        .cast("double").alias("target"))


def _drawn(node_sources: Column, left_blocks: Column, all_blocks: Column, seed: Column) -> Column:
    """How many blocks of each source go left: selection sampling over the
    node's blocks source by source, each block taken with chance (places
    left) / (blocks left). The result is multivariate hypergeometric."""
    def unit(idx, i):  # a seeded number in [0, 1)
        return F.pmod(F.xxhash64(seed, idx, i), F.lit(1 << 52)) / F.lit(float(1 << 52))

    def per_source(state, s):
        taken = F.aggregate(
            F.sequence(F.lit(1), s["q"]),
            F.struct(state["places"].alias("places"), state["blocks"].alias("blocks"),
                     F.lit(0).cast("long").alias("k")),
            lambda a, i: F.when(unit(s["idx"], i) * a["blocks"] < a["places"], F.struct(
                (a["places"] - 1).alias("places"), (a["blocks"] - 1).alias("blocks"), (a["k"] + 1).alias("k")))
            .otherwise(F.struct(a["places"].alias("places"), (a["blocks"] - 1).alias("blocks"), a["k"].alias("k"))))
        return F.transform(F.array(taken), lambda t: F.struct(
            t["places"].alias("places"), t["blocks"].alias("blocks"),
            F.concat(state["out"], F.array(F.struct(s["idx"].alias("idx"), t["k"].alias("q")))).alias("out")))[0]
    start = F.struct(left_blocks.cast("long").alias("places"), all_blocks.cast("long").alias("blocks"),
                     F.array().cast("array<struct<idx:int,q:bigint>>").alias("out"))
    return F.aggregate(node_sources, start, per_source, lambda s: s["out"])


def split_quotas(quotas: DataFrame, n_shards: int, seed: int = SEED) -> DataFrame:
    """(shard, idx, q) with q > 0: the blocks (idx, q) of every source dealt
    to ``n_shards`` shards of equal block counts (to within one) by the tree.
    A node holds one number per source that has blocks in it."""
    tree = quotas.where("q > 0").agg(F.sort_array(F.collect_list(F.struct(
        F.col("idx").cast("int").alias("idx"), F.col("q").cast("long").alias("q")))).alias("parts"))
    tree = tree.select(F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), "parts",
                       F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["q"]).alias("total"))
    tree = tree.withColumn("whole", F.col("total"))  # handed down to every node

    def places(shard):  # of shards [0, shard), out of all blocks
        return F.floor(shard.cast("long") * F.col("whole") / n_shards).cast("long")
    for depth in range(math.ceil(math.log2(n_shards)) if n_shards > 1 else 0):
        mid = F.floor((F.col("lo") + F.col("hi") + 1) / 2).cast("int")
        inner = tree.withColumn("mid", mid).withColumn(
            "drawn", _drawn(F.col("parts"), places(F.col("mid")) - places(F.col("lo")), F.col("total"),
                            F.xxhash64(F.lit(seed), F.lit(depth), F.col("lo"))))
        gone = F.zip_with("parts", "drawn", lambda p, d: F.struct(p["idx"].alias("idx"), (p["q"] - d["q"]).alias("q")))
        children = F.array(
            F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), F.col("drawn").alias("parts")),
            F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), gone.alias("parts")))
        children = F.when(F.col("hi") - F.col("lo") > 1, children).otherwise(F.array(F.struct(
            F.col("lo").alias("lo"), F.col("hi").alias("hi"), F.col("parts").alias("parts"))))
        tree = (inner.select("whole", F.explode(children).alias("c"))
                .select("whole", "c.lo", "c.hi", F.filter("c.parts", lambda p: p["q"] > 0).alias("parts"))
                .withColumn("total", F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["q"])))
    return tree.select(F.col("lo").alias("shard"), F.explode("parts").alias("p")).select("shard", "p.idx", "p.q")


def _block_rows(quotas: DataFrame, seed: int) -> DataFrame:
    """(idx, block, place): every source's blocks, a row each, and their places
    in the order of a seeded hash. Places are distributed prefix sums, as the
    documents' offsets are: sizes of hash ranges, then a count inside each."""
    chunk = F.explode(F.expr(f"sequence(0L, (q - 1) div {RANGE_BLOCKS})")).alias("chunk")
    block = F.explode(F.expr(f"sequence(chunk * {RANGE_BLOCKS}, least((chunk + 1) * {RANGE_BLOCKS}, q) - 1)"))
    rows = quotas.where("q > 0").select("idx", F.col("q").cast("long").alias("q"), chunk) \
        .repartition("idx", "chunk").select("idx", "q", block.alias("block"))
    h = F.xxhash64(F.lit(seed), F.col("idx").cast("int"), F.col("block"))
    ranges = F.ceil(F.col("q") / RANGE_BLOCKS)
    at = F.floor((h.cast("double") / float(1 << 64) + 0.5) * ranges)  # ascending with the hash
    rows = rows.select("idx", "block", h.alias("h"), F.least(at, ranges - 1).alias("range"))
    upto = W.partitionBy("idx").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("idx", "range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("idx").alias("sum_idx"), F.col("range").alias("sum_range"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("idx", "range").orderBy("h", "block")) - 1
    return rows.withColumn("inside", inside).join(
        broadcast_if_small(staged(sums, "mix-block-ranges")), (F.col("idx") == F.col("sum_idx")) & (F.col("range") == F.col("sum_range"))
    ).select("idx", "block", (F.col("before") + F.col("inside")).alias("place"))


def dealt_blocks(quotas: DataFrame, n_shards: int, seed: int = SEED) -> DataFrame:
    """(idx, block) -> shard: every source's blocks are permuted by a seeded
    hash, and its shards take disjoint runs of that order. A block finds its
    run among those that begin or end in the same stretch of places."""
    leaves = split_quotas(quotas, n_shards, seed)
    before = W.partitionBy("idx").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # a row for each shard
    runs = leaves.withColumn("lo", F.coalesce(F.sum("q").over(before), F.lit(0)))
    runs = runs.select(F.col("idx").alias("run_idx"), "shard", "lo", (F.col("lo") + F.col("q")).alias("hi"), F.explode(
        F.expr(f"sequence(lo div {STRETCH}, (lo + q - 1) div {STRETCH})")).alias("run_stretch"))
    blocks = _block_rows(quotas, seed).withColumn("stretch", F.expr(f"place div {STRETCH}"))
    return blocks.join(runs, (F.col("idx") == F.col("run_idx")) & (F.col("stretch") == F.col("run_stretch"))
                       & (F.col("place") >= F.col("lo")) & (F.col("place") < F.col("hi"))).select("idx", "block", "shard")


def placed(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = MIX_SHARE, seed: int = SEED,
           n_shards: int | None = None, measured: DataFrame | None = None) -> DataFrame:
    """``sized`` (columns doc_id, source, size, key) with source_size, target
    and ``shards``: for every pass over the source, the shard that takes a
    copy of the document (NULL: none does). ``measured``: the same rows, staged
    and without texts, for the statistics."""
    measured = sized if measured is None else measured
    per = staged(targets(measured, weights, share), "mix-targets")
    total = per.agg(F.sum("target")).first()[0] or 0.0
    n_shards = n_shards or max(MIN_SHARDS, math.ceil(total / SHARD_WORDS))
    block = max(1.0, total / (n_shards * BLOCKS_PER_SHARD))
    listed = W.orderBy(F.col("source").asc_nulls_last())
    per = per.select(
        F.col("source").alias("per_source"), "source_size", "target", F.row_number().over(listed).alias("idx"),
        F.ceil(F.col("target") / block).cast("long").alias("q"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / RANGE_WORDS)).cast("long").alias("ranges"))
    per = staged(per, "mix-sources")
    blocks = staged(dealt_blocks(per, n_shards, seed), "mix-blocks")
    bounded = broadcast_if_small(per)

    def spread(df):
        """A document's random number, and the hash range it falls into."""
        df = df.join(bounded, F.col("source").eqNullSafe(F.col("per_source")))
        at = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("key")), F.lit(1 << 40))
        return df.withColumn("at", at).withColumn("range", F.floor(F.col("at") * F.col("ranges") / (1 << 40)))
    sums = spread(measured).groupBy("idx", "range").agg(F.sum("size").alias("in_range"))
    upto = W.partitionBy("idx").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("idx").alias("sum_idx"), F.col("range").alias("sum_range"),
                       F.coalesce(F.sum("in_range").over(upto), F.lit(0)).alias("before"))
    sums = broadcast_if_small(staged(sums, "mix-ranges"))
    inside = W.partitionBy("idx", "range").orderBy("at", "doc_id", "key").rowsBetween(W.unboundedPreceding, -1)
    out = (spread(sized).withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
           .join(sums, (F.col("idx") == F.col("sum_idx")) & (F.col("range") == F.col("sum_range")))
           .withColumn("offset", F.col("before") + F.col("inside")))
    blocks = broadcast_if_small(blocks)
    shards = []
    for epoch in range(MAX_EPOCHS):
        start = F.col("offset") + epoch * F.col("source_size")
        taken = (F.col("size") > 0) & (start + F.col("size") / 2 < F.col("target"))
        out = out.withColumn(f"block_{epoch}", F.when(taken, F.floor(start / block).cast("long")))
        lookup = blocks.select(F.col("idx").alias(f"b_idx_{epoch}"), F.col("block").alias(f"b_block_{epoch}"),
                               F.col("shard").alias(f"shard_{epoch}"))
        out = out.join(lookup, (F.col("idx") == F.col(f"b_idx_{epoch}"))
                       & (F.col(f"block_{epoch}") == F.col(f"b_block_{epoch}")), "left")
        shards.append(F.col(f"shard_{epoch}"))
    return out.select(*sized.columns, "source_size", "target", F.array(*shards).alias("shards"))


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and the key of the row's text."""
    return docs.select("doc_id", "source", word_count(text_of("text")).alias("size"),
                       row_key(F.col("text")).alias("key"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = MIX_SHARE, seed: int = SEED,
        n_shards: int | None = None) -> DataFrame:
    """The mix: the rows of ``docs``, each as often as it is taken, with
    ``shard``, ``position`` in the shard and ``copy`` (0 for the first)."""
    rest = fresh(docs, "llm_row")
    carried = docs.select("doc_id", "source", word_count(text_of("text")).alias("size"),
                          row_key(F.col("text")).alias("key"), F.struct(*docs.columns).alias(rest))
    stats = staged(sized_rows(docs), "mix-sizes")
    out = placed(carried, weights, share, seed, n_shards, stats)
    copies = (out.select("doc_id", "key", rest, F.posexplode("shards").alias("copy", "shard"))
              .where(F.col("shard").isNotNull()))
    order = F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("key"), F.col("copy"))
    local = W.partitionBy("shard").orderBy(order, "doc_id", "key", "copy")
    names = {c.lower() for c in docs.columns}
    extra = {c: c if c not in names else fresh(docs, f"mix_{c}") for c in ("shard", "position", "copy")}
    return copies.withColumn("position", F.row_number().over(local) - 1).select(
        *[F.col(rest)[c].alias(c) for c in docs.columns], *[F.col(c).alias(n) for c, n in extra.items()])


def op6_mix_sources(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its size, its source's size and target, the words
    taken of it, and the shards that take its copies."""
    sizes = staged(sized_rows(docs), "mix-sizes")
    out = placed(sizes)
    copies = F.filter("shards", lambda s: s.isNotNull())
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.size(copies)).alias("taken"), F.array_join(copies, ",").alias("shards"))
