"""SimHash near-duplicates with pigeonring filtering.

A text's 64-bit fingerprint has a bit set when more than half of its word
shingles' XXH64 hashes have it. Texts whose fingerprints differ in at most
``distance`` bits are linked, and a component of links is a group.

Fingerprints are cut into ``distance + 1`` segments on a ring. By the
pigeonring principle two fingerprints within the distance have a segment from
which the differences of the chain of following segments stay within
proportional budgets: none in the first, at most 1 in the first two, at most 2
in the first three, and so on. Fingerprints that agree in a segment form a
bucket; inside a bucket the chain is checked segment by segment before the
full Hamming check.

A bucket that holds more than ``BUCKET_ROWS`` distinct fingerprints is not
compared: its chain is extended by one segment instead. Each way to spend the
next budget frees that many bits, and fingerprints that agree outside the
freed bits share a finer bucket. Every pair that satisfies the chain meets in
some finer bucket, so no link is lost, and the work per fingerprint does not
depend on how many fingerprints resemble it. In the last step all but one
segment are fixed up to the freed bits, which bounds a bucket's size by the
width of a segment whatever the input.

Equal fingerprints are one node, so copies never make pairs. A task compares
its buckets as arrays and passes on a spanning forest of the links it found.

NULL and empty texts have fingerprint zero, linked like any other; very long
texts are hashed whole, their bits counted a part at a time. NULL doc_id
is passed over when a component takes its smallest id (NULL if all are). Equal
rows and rows that share a doc_id are separate rows with equal fingerprints or
their own. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from paylake.llm.common import broadcast_if_small, fresh, row_key, staged, text_of
from paylake.llm.components import components

SHINGLE = 3
DISTANCE = 3
HASH_SEED = 42
BUCKET_ROWS = 4096
# Shingles whose bits are counted at once.
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number. ``bytes.lower`` touches A-Z only."""
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle \
        else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, HASH_SEED) for g in grams], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(texts, shingle: int = SHINGLE):
    """Column of signed 64-bit fingerprints of a text column."""
    @F.arrow_udf(T.LongType())
    def run(batch: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t or "", shingle) for t in batch.to_pylist()], np.uint64)
                        .view(np.int64))
    return run(texts)


# --- the ring ----------------------------------------------------------------

def segments(distance: int) -> list[list[int]]:
    """Bit numbers of each of the ``distance + 1`` segments."""
    n = distance + 1
    return [list(range(64 * i // n, 64 * (i + 1) // n)) for i in range(n)]


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def bucket_masks(distance: int) -> tuple[dict[tuple[int, int], list[int]], list[tuple[int, int]]]:
    """The masks a bucket agrees on, as (start, mask): a map from a bucket to
    its finer ones, and the first buckets. At length l of the chain, l - 1 bits
    are freed, at most j - 1 of them in the first j segments. A finer bucket
    hangs below the one that frees the same bits; where it frees fewer bits so
    far, below the first one that frees those too."""
    segs, n = segments(distance), distance + 1
    finer: dict[tuple[int, int], list[int]] = {}
    first = []
    for start in range(n):
        ring = [segs[(start + j) % n] for j in range(n)]
        level = {frozenset(): _mask(ring[0])}
        first.append((start, level[frozenset()]))
        for length in range(2, n):
            held = [b for s in ring[:length] for b in s]
            known = sorted(level, key=sorted)
            nxt: dict[frozenset, int] = {}
            for freed in _freed(ring[:length], length - 1):
                before = freed - set(ring[length - 1])
                parent = before if before in level else next(p for p in known if before <= p)
                nxt[freed] = _mask(b for b in held if b not in freed)
                finer.setdefault((start, level[parent]), []).append(nxt[freed])
            level = nxt
    return finer, first


def _freed(ring: list[list[int]], total: int):
    """Sets of ``total`` bits with at most j - 1 of them in the first j segments."""
    def spread(j, left):
        if j == len(ring):
            if left == 0:
                yield []
            return
        for k in range(left + 1):
            for rest in spread(j + 1, left - k):
                yield [k, *rest]
    for counts in spread(0, total):
        if all(sum(counts[:j + 1]) <= j for j in range(len(ring))):
            parts = [[]]
            for seg, k in zip(ring, counts):
                parts = [p + list(c) for p in parts for c in combinations(seg, k)]
            yield from map(frozenset, parts)


# --- comparison inside a task --------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges contracted to (node, least node of its component), nodes that are not least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        while True:
            hop = new[new]
            if np.array_equal(hop, new):
                break
            new = hop
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


class _Links:
    """Links found by a task, contracted whenever they pile up."""

    def __init__(self):
        self.a, self.b, self.n = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.n += len(a)
            if self.n > 2_000_000:
                self.contract()

    def contract(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        a, b = forest(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.n = [a], [b], len(a)
        return a, b


def _near(x: np.ndarray, y: np.ndarray, chain: list[int], distance: int) -> np.ndarray:
    """Indexes of the pairs that pass the chain's budgets, then the full check."""
    diff = x ^ y
    keep = np.arange(len(diff))
    cumulative = np.zeros(len(diff), np.uint8)
    for budget, seg in enumerate(chain):
        cumulative = cumulative + np.bitwise_count(diff & np.uint64(seg))
        ok = cumulative <= budget
        diff, keep, cumulative = diff[ok], keep[ok], cumulative[ok]
    return keep[np.bitwise_count(diff) <= distance]


def compare_buckets(starts: np.ndarray, bucket: np.ndarray, fp: np.ndarray, distance: int, links: _Links) -> None:
    """Whole buckets, one after the other: ``bucket`` numbers them, ``starts``
    gives each row's first segment. Small buckets are compared together by
    shifts of the array, large ones on their own, a block of rows at a time."""
    segs = [sum(1 << b for b in s) for s in segments(distance)]
    n = len(segs)
    sizes = np.bincount(bucket)
    end = np.cumsum(sizes)[bucket]
    row = np.arange(len(fp))
    small = sizes[bucket] <= 64
    for start in range(n):
        chain = [segs[(start + j) % n] for j in range(n)]
        mine = small & (starts == start)
        shift = 1
        at = row[mine]
        while len(at):
            at = at[at + shift < end[at]]
            near = _near(fp[at], fp[at + shift], chain, distance)
            links.add(fp[at[near]], fp[at[near] + shift])
            shift += 1
    for k in np.flatnonzero(sizes > 64):
        lo, hi = end[np.searchsorted(bucket, k)] - sizes[k], end[np.searchsorted(bucket, k)]
        start = int(starts[lo])
        chain = [segs[(start + j) % n] for j in range(n)]
        values = fp[lo:hi]
        if len(values) > 4 * BUCKET_ROWS:
            _cliques(values, start, distance, links)
            continue
        block = max(1, 1_000_000 // len(values))
        for i in range(0, len(values), block):
            x, y = values[i:i + block, None], values[None, i:]
            p, q = _block_near(x, y, chain, distance)
            links.add(values[i + p], values[i + q])


def _block_near(x, y, chain, distance):
    shape = (x.shape[0], y.shape[1])
    keep = _near(np.broadcast_to(x, shape).ravel(), np.broadcast_to(y, shape).ravel(), chain, distance)
    p, q = np.divmod(keep, shape[1])
    upper = p < q
    return p[upper], q[upper]


def _cliques(values: np.ndarray, start: int, distance: int, links: _Links) -> None:
    """The chain's last step for a crowded bucket: fingerprints that agree
    outside ``distance`` freed bits are all within the distance of each other,
    so each is linked to the first of its like, and none are compared."""
    segs = segments(distance)
    ring = [segs[(start + j) % len(segs)] for j in range(len(segs))]
    varying = int(np.bitwise_or.reduce(values ^ values[0]))
    free = [[b for b in s if varying >> b & 1] for s in ring]
    for total in range(distance + 1):
        for freed in _freed(free, total):
            kept = values & ~np.uint64(sum(1 << b for b in freed))
            _, first, inverse = np.unique(kept, return_index=True, return_inverse=True)
            links.add(values, values[first][inverse])


# --- Spark -----------------------------------------------------------------------

_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _comparer(distance: int):
    def run(batches):
        links, tail = _Links(), None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("start", "mask", "value", "fp")]
            rows = np.stack([c.astype(np.int64) for c in cols], axis=1) if len(batch) else np.empty((0, 4), np.int64)
            tail = rows if tail is None else np.concatenate([tail, rows])
            if len(tail) == 0:
                continue
            cut = _last_bucket(tail)
            _compare(tail[:cut], distance, links)
            tail = tail[cut:]
        if tail is not None:
            _compare(tail, distance, links)
        a, b = links.contract()
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
    return run


def _last_bucket(rows: np.ndarray) -> int:
    """Index of the first row of the last bucket."""
    same = (rows[:, 1:3] == rows[-1, 1:3]).all(axis=1)
    return int(len(rows) - np.argmin(same[::-1])) if not same.all() else 0


def _compare(rows: np.ndarray, distance: int, links: _Links) -> None:
    if len(rows) < 2:
        return
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, 1:3] != rows[:-1, 1:3]).any(axis=1)
    compare_buckets(rows[:, 0], np.cumsum(new) - 1, np.ascontiguousarray(rows[:, 3]).view(np.uint64), distance, links)


def _array(longs):
    return F.array(*[F.lit(x).cast("long") for x in longs])


def buckets(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(start, mask, value, fp) of every fingerprint in buckets that are small
    enough to be compared, refining crowded ones as far as needed."""
    finer, first = bucket_masks(distance)
    masks = F.array(*[F.struct(F.lit(s).alias("start"), F.lit(m).cast("long").alias("mask")) for s, m in first])
    rows = nodes.select("fp", F.explode(masks).alias("m")).select(
        "m.start", "m.mask", F.col("fp").bitwiseAND(F.col("m.mask")).alias("value"), "fp")
    out = None
    for _ in range(distance - 1):
        crowded = staged(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
                         .where(F.col("n") > BUCKET_ROWS).select("mask", "value"), "simhash-crowded")
        if crowded.isEmpty():
            break
        crowded = broadcast_if_small(crowded)
        fine = rows.join(crowded, ["mask", "value"], "left_anti")
        out = fine if out is None else out.unionByName(fine)
        table = F.create_map(*[x for (s, m), kids in finer.items() for x in (
            F.lit(m).cast("long"), _array(kids))])
        rows = staged(rows.join(crowded, ["mask", "value"], "left_semi")
                      .select("start", F.explode(table[F.col("mask")]).alias("mask"), "fp")
                      .select("start", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"),
                      "simhash-finer")
    return rows if out is None else out.unionByName(rows)


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) that span the components of distinct fingerprints ``fp``."""
    if distance == 0:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    return (buckets(nodes, distance).repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
            .mapInArrow(_comparer(distance), _EDGE))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs``: doc_id, key of its text, fingerprint ``fp``, the
    component's least fingerprint ``root`` and smallest doc_id ``component_id``."""
    rows = staged(docs.select("doc_id", row_key(text_of("text")).alias("key"),
                              fingerprints(F.col("text"), shingle).alias("fp")), "simhash-rows")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), distance))
    nodes = staged(nodes.join(roots, F.col("fp") == F.col("node"), "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = staged(nodes.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    nodes = staged(nodes.join(broadcast_if_small(least), "root").select("fp", "root", "component_id"),
                   "simhash-groups")
    return rows.join(broadcast_if_small(nodes), "fp").select("doc_id", "key", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id (NULL last), then the smallest key, then the first by the hash of
    all columns; of equal rows any one."""
    found = near_duplicates(docs, shingle, distance)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")
    kept = staged(found.groupBy("root").agg(best).select("best.doc_id", "best.key"), "simhash-kept")
    key, r_id, r_key = fresh(docs, "llm_key"), fresh(docs, "llm_id"), fresh(docs, "llm_key_r")
    kept = kept.select(F.col("doc_id").alias(r_id), F.col("key").alias(r_key))
    out = docs.withColumn(key, row_key(text_of("text"))).join(
        kept, (F.col(key) == F.col(r_key)) & F.col("doc_id").eqNullSafe(F.col(r_id)), "left_semi")
    repeats = found.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if repeats:
        return out.drop(key)
    row, place = F.to_json(F.struct(*docs.columns)), fresh(docs, "llm_place")
    first = W.partitionBy("doc_id", key).orderBy(F.xxhash64(row), row)
    return out.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(key, place)


def op3_simhash(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
