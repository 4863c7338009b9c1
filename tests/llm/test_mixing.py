"""Mixing: targets, exact quotas of the splitting tree, and the mix itself."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paylake.llm import mixing


def slow_targets(sizes, weights=(5, 2, 1), share=1.5):
    """Capping and resharing until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 5000, "B": 0, None: 30, "é": 70}, {"z": 0}, {"s": 7},
    {f"s{i}": (i * 37) % 101 for i in range(23)}])
def test_targets(spark, sizes):
    rows = [(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()]
    got = {r.source: (r.source_size, r.target) for r in mixing.targets(
        spark.createDataFrame(rows, "source string, size long")).collect()}
    want = slow_targets(sizes)
    for s in sizes:
        assert got[s][0] == sizes[s] and got[s][1] == pytest.approx(want[s], abs=1e-6)


@pytest.mark.parametrize("n_shards", [1, 2, 5, 8, 13])
def test_tree_deals_exact_quotas(spark, n_shards):
    quotas = {1: 40, 2: 3, 3: 0, 4: 71}
    df = spark.createDataFrame(list(quotas.items()), "idx int, q long")
    rows = mixing.split_quotas(df, n_shards).collect()
    for idx, q in quotas.items():
        assert sum(r.q for r in rows if r.idx == idx) == q
    per_shard = Counter()
    for r in rows:
        per_shard[r.shard] += r.q
    total = sum(quotas.values())
    assert all(abs(per_shard[s] - total / n_shards) < 1 for s in range(n_shards))
    dealt = mixing.dealt_blocks(df, n_shards).collect()
    assert Counter((r.idx, r.shard) for r in dealt) == Counter({(r.idx, r.shard): r.q for r in rows})
    assert {(r.idx, r.block) for r in dealt} == {(i, b) for i, q in quotas.items() for b in range(q)}
    assert len(dealt) == total


def test_draws_are_hypergeometric_on_average(spark):
    df = spark.createDataFrame([(1, 30), (2, 10)], "idx int, q long")
    left = [sum(r.q for r in mixing.split_quotas(df, 2, seed).collect() if (r.shard, r.idx) == (0, 2)) for seed in range(60)]
    assert 4 < sum(left) / len(left) < 6 and len(set(left)) > 3


def documents(n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["b", "c", "d", None])
        rows.append((i, " ".join(["w"] * rng.randrange(1, 60)), source))
    rows += [(i, None, "b") for i in range(500, 505)] + [(600, "", "empty"), (None, "x y z", "b"), (7, "again and again", "c"),
                                                        (7, "again and again", "c")]
    return rows


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_WORDS", 300)  # several hash ranges per source
    rows = documents()
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, copy int")
    table = mixing.op6_mix_sources(docs).collect()
    assert len(table) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = slow_targets(sizes), Counter()
    by_source = {s: [r for r in table if r.source_size == sizes[s] and r.target == pytest.approx(want[s])] for s in sizes}
    for s, rs in by_source.items():
        taken[s] = sum(r.taken for r in rs)
        assert abs(taken[s] - want[s]) <= 30, s  # half of the longest document
    assert all(0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in table)
    again = mixing.op6_mix_sources(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, table))
    mix = mixing.mix(docs)
    assert mix.columns == [*docs.columns, "shard", "position", "mix_copy"]
    out = mix.collect()
    assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in table)
    assert Counter(r.doc_id for r in out if r.doc_id not in (None, 7)) == Counter(
        {r.doc_id: r.taken // r.size for r in table if r.taken and r.doc_id not in (None, 7)})
    for shard in {r.shard for r in out}:
        mine = sorted(r.position for r in out if r.shard == shard)
        assert mine == list(range(len(mine)))


def test_no_python_on_the_way(spark):
    docs = spark.createDataFrame(documents(50), "doc_id long, text string, source string")
    for df in (mixing.op6_mix_sources(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.op6_mix_sources(docs).count() == 0 and mixing.mix(docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.op6_mix_sources(blank).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(blank).where(F.lit(True)).count() == 0


def test_blocks_are_dealt_as_rows(spark, monkeypatch):
    """Over 200,000 blocks of one source: every shard gets its quota, in several tasks, and again the same."""
    monkeypatch.setattr(mixing, "RANGE_BLOCKS", 20_000)
    quotas = spark.createDataFrame([(1, 200_000), (2, 37), (3, 0)], "idx int, q long")
    dealt = mixing.dealt_blocks(quotas, 5).cache()
    want = {(r.shard, r.idx): r.q for r in mixing.split_quotas(quotas, 5).collect()}
    got = {(r.shard, r.idx): r["count"] for r in dealt.groupBy("shard", "idx").count().collect()}
    assert got == want and dealt.count() == 200_037 == dealt.select("idx", "block").distinct().count()
    rows = mixing._block_rows(quotas, mixing.SEED)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # too few bytes here to be left apart
    try:
        parts = rows.where("idx = 1").select(F.spark_partition_id().alias("p"), "place").groupBy("p").agg(F.max("place"))
        assert parts.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.place for r in rows.where("idx = 2").collect()) == list(range(37))
    mark = F.sum(F.xxhash64("idx", "block", "shard").cast("decimal(38,0)"))
    assert dealt.agg(mark).first() == mixing.dealt_blocks(quotas.repartition(3), 5).agg(mark).first()
