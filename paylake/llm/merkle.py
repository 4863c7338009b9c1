"""Merkle manifest of a dataset, by rolling rank digits up into nested structs.

Every row is a leaf: the SHA-256 of its columns. Within a group (by default
the source) leaves are put in order and every ``FANOUT`` consecutive nodes
become one, until one is left, the group's subroot; the subroots in order of
their groups become the root in the same way.

A row's rank in its group is written in digits of base ``FANOUT``. The last
``DIGITS`` of them are grouped away one after the other: rows that agree in
all other digits become an array of child structs beside the hash of their
joined hashes. All of this happens within a block, the rows that agree in the
digits before those, so one exchange serves all groupings of a block and a
block never holds more than ``FANOUT ** DIGITS`` nodes, whatever the size of
its group. The blocks' hashes are the nodes of the next tier. Coming back, a
block meets what lies above it by one more grouping and is exploded level by
level; each explode adds the siblings it passes to the proof. No join is
involved. Ranks come from a range partitioning and the sizes of its parts.

A proof is an array of (left, right) from the leaf up: the joined hashes of a
node's siblings before and after it.

NULL columns are hashed as such (``-``); NULL group is a group of its own,
listed first; NULL order comes first; rows that share their place in the order
are ordered by hash, so equal rows are leaves of their own and reruns agree.
Empty texts are texts; very long ones are hashed whole, one at a time. An empty
table has no rows and no root. Columns that are not named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from paylake.llm.common import broadcast_if_small, staged

FANOUT = 16
DIGITS = 2
BLOCK = FANOUT ** DIGITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def framed(value: Column) -> Column:
    """A value as it is hashed: ``-`` for NULL, else its length in bytes, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_hash(proof: Column) -> Column:
    """One hash for all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: F.concat(s["left"], s["right"]))), 256)


def ranked(nodes: DataFrame, *order: Column) -> tuple[DataFrame, int]:
    """``nodes`` with their 0-based ``rank`` within group ``g`` and the group's
    size ``n``; and the largest size. No group is one task's work: a node's rank
    is its place in its range partition plus what earlier partitions hold."""
    by = [F.col("g").asc_nulls_first(), *order]
    rows = staged(nodes.repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftrightunsigned("at", 33)  # the upper bits of the id number the partition
    runs = rows.groupBy(part.alias("part"), F.col("g").alias("of")).agg(
        F.count(F.lit(1)).alias("m"), F.min("at").alias("first"))
    own = W.partitionBy("of")  # a group has one run for each partition it reaches into
    before = F.coalesce(F.sum("m").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = staged(runs.select("part", "of", (before - F.col("first")).alias("shift"),
                              F.sum("m").over(own).alias("n")), "merkle-runs")
    out = rows.join(broadcast_if_small(runs), (part == F.col("part")) & F.col("g").eqNullSafe(F.col("of")))
    most = runs.agg(F.max("n")).first()[0] or 0
    return out.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "of", "shift"), most


def _rolled(nodes: DataFrame) -> DataFrame:
    """Blocks of (g, rank, n, h, x) rows: g, block, n, the block's hash h and
    its nodes as nested structs x. ``depth`` levels of a block are hashed; a
    group that is down to one node has it handed on as it is."""
    depth = sum((F.when(F.col("n") > FANOUT ** k, 1).otherwise(0) for k in range(DIGITS)), F.lit(0))
    digits = [F.expr(f"int(rank div {FANOUT ** k} % {FANOUT})").alias(f"d{k}") for k in range(DIGITS)]
    df = nodes.select("g", F.expr(f"rank div {BLOCK}").alias("block"), "n", depth.alias("depth"), *digits, "h", "x")
    df = df.repartition("g", "block")  # all groupings below keep to it
    for k in range(DIGITS):
        left = [f"d{j}" for j in range(k + 1, DIGITS)]
        kids = F.collect_list(F.struct(F.col(f"d{k}").alias("i"), "h", "x"))
        df = df.groupBy("g", "block", "n", "depth", *left).agg(F.array_sort(kids).alias("x"))
        joined = F.concat_ws("", F.transform("x", lambda c: c["h"]))
        df = df.withColumn("h", F.when(F.col("depth") > k, F.sha2(joined, 256)).otherwise(F.col("x")[0]["h"]))
    return df


def _met(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``blocks`` with ``path`` and ``tops`` of the row of ``above`` for the same (g, block)."""
    kinds = dict(blocks.dtypes) | dict(above.dtypes)
    columns = ["depth", "x", "path", "tops"]

    def side(df):
        return df.select("g", "block", *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c)
                                         for c in columns])
    return side(blocks).unionByName(side(above)).groupBy("g", "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in columns])


def _exploded(blocks: DataFrame) -> DataFrame:
    """The nodes of blocks (g, block, depth, x, path, tops) with their paths: g, rank, h, x, path, tops."""
    df = blocks.withColumnRenamed("block", "rank")
    for k in reversed(range(DIGITS)):
        df = (df.withColumn("all", F.transform("x", lambda c: c["h"]))
              .select("g", "rank", "depth", "path", "tops", "all", F.posexplode("x").alias("i", "kid")))
        step = F.struct(F.concat_ws("", F.slice("all", F.lit(1), F.col("i"))).alias("left"),
                        F.concat_ws("", F.slice("all", F.col("i") + 2, F.lit(FANOUT))).alias("right"))
        df = df.select("g", (F.col("rank") * FANOUT + F.col("kid.i")).alias("rank"), "depth", "tops",
                       F.when(F.col("depth") > k, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
                       .alias("path"), F.col("kid.h").alias("h"), F.col("kid.x").alias("x"))
    return df.drop("depth")


def _climbed(nodes: DataFrame, most: int, over=None) -> DataFrame:
    """The proofs of ``nodes`` (g, rank, n, h, x). ``tops`` are the last hashes
    they lead to. ``over`` gives what lies above the groups: (g, path, tops)
    from their last hashes (g, h); without it a group's last hash is its top."""
    blocks = staged(_rolled(nodes), "merkle-blocks")
    if most > BLOCK:
        up = blocks.select("g", F.col("block").alias("rank"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), "h",
                           F.lit(None).cast("int").alias("x"))
        above = _climbed(up, -(-most // BLOCK), over).withColumnRenamed("rank", "block")
        return _exploded(_met(blocks, above.select("g", "block", "path", "tops")))
    if over is None:
        return _exploded(blocks.select("g", "block", "depth", "x", F.array().cast(_PATH).alias("path"),
                                       F.array("h").alias("tops")))
    above = over(blocks.select("g", "h"))
    return _exploded(_met(blocks, above.select("g", F.lit(0).cast("long").alias("block"), "path", "tops")))


def _subroots(groups: DataFrame) -> DataFrame:
    """(g, path, tops) of the groups' last hashes: subroot and root, and the path between them."""
    nodes = groups.select(F.lit(0).alias("g"), "h", F.struct(F.col("g").alias("group")).alias("x"))
    nodes, most = ranked(nodes, F.col("x.group").asc_nulls_first())
    return _climbed(nodes, most).select(F.col("x.group").alias("g"), "path",
                                        F.concat(F.array("h"), F.col("tops")).alias("tops"))


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: its ``group`` and ``order`` columns, leaf,
    subroot, root and proof; ``carry`` names further values to hand through
    (of types that can be compared; they take part in no hash)."""
    values = F.struct(F.col(order).alias("order"), *[v.alias(f"c{i}") for i, v in enumerate((carry or {}).values())])
    leaves = staged(docs.select(F.col(group).alias("g"), leaf_hash(*map(F.col, columns)).alias("h"),
                                values.alias("x")), "merkle-leaves")
    nodes, most = ranked(leaves, F.col("x.order").asc_nulls_first(), F.col("h").asc())
    found = _climbed(nodes, most, _subroots)
    return found.select(F.col("g").alias(group), F.col("x.order").alias(order), F.col("h").alias("leaf"),
                        F.col("tops")[0].alias("subroot"), F.col("tops")[1].alias("root"), F.col("path").alias("proof"),
                        *[F.col(f"x.c{i}").alias(name) for i, name in enumerate(carry or {})])


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op13_merkle_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, and each proof folded again from the row as
    tampered with: texts of every fifth doc_id (by CRC-32 of its digits) in
    lower case. NULL doc_id and texts without capitals are not touched."""
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & F.col("text").rlike("[A-Z]")
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    tampered = F.when(chosen, leaf_hash(*[lowered if c == "text" else F.col(c) for c in COLUMNS]))
    found = manifest(docs, carry={"tampered": tampered})
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
