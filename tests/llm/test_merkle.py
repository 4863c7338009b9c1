"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest

from paylake.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def frame(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(top, path of every node) of a list of hashes."""
    level, at, paths = list(nodes), list(range(len(nodes))), [[] for _ in nodes]
    while len(level) > 1:
        for k, i in enumerate(at):
            lo = i // 16 * 16
            paths[k].append(("".join(level[lo:i]), "".join(level[i + 1:lo + 16])))
        level, at = [H(*level[i:i + 16]) for i in range(0, len(level), 16)], [i // 16 for i in at]
    return (level[0] if level else None), paths


def brute(rows):
    """Sorted result rows for (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, H(*map(frame, r)), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        tops[s] = tree([x[2] for x in groups[s]])
    root, above = tree([tops[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (_, _, leaf, r), path in zip(groups[s], tops[s][1]):
            proof, changed = path + up, r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            h = H(*map(frame, changed))
            for left, right in proof:
                h = H(left, h, right)
            out.append((r[0], leaf, tops[s][0], root, H(*[x + y for x, y in proof]), h, h == root))
    return sorted(map(str, out))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _docs(sizes, seed=3):
    rng, rows, i = random.Random(seed), [], 0
    for s, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 37 % 100_003, s, rng.choice(["en", None]), rng.choice([None, i]), f"Text {i} É"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16, "b": 17}, {"a": 256, None: 1, "B": 257}, {"one": 700, "é": 3, "": 2},
    {f"s{i}": 1 + i % 3 for i in range(300)}])
def test_equals_a_plain_tree(spark, sizes):
    rows = _docs(sizes)
    got = merkle.op13_merkle_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_more_than_two_tiers(spark):
    rows = _docs({"hot": 70_000, "b": 5})
    got = merkle.op13_merkle_manifest(spark.createDataFrame(rows, SCHEMA).repartition(16))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_odd_rows(spark):
    """NULL everywhere, repeated rows, shared ids, empty and very long texts, extra columns."""
    rows = [(None, None, None, None, None)] * 3 + [(5, "a", "en", 1, "")] * 20 + [(5, "a", "en", 1, "Z" * 3_000_000)] \
        + [(5, "a", None, 2, "QX"), (-7, "a", "x", 0, None), (10**15, "A", "y", 3, "tail")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", root int")
    got = merkle.op13_merkle_manifest(df).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_empty_table(spark):
    assert merkle.op13_merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_proofs_hold_and_change_is_seen(spark):
    from pyspark.sql import functions as F
    rows = _docs({"a": 40, "b": 300})
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), carry={"lang_too": F.col("lang")})
    assert found.columns == ["source", "doc_id", "leaf", "subroot", "root", "proof", "lang_too"]
    good = merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")
    bad = merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")
    assert found.where(good).count() == 340 and found.where(bad).count() == 0
    assert {r.doc_id: r.lang_too for r in found.collect()} == {r[0]: r[2] for r in rows}


def test_plan_has_no_join_above_the_ranks(spark):
    """Blocks are rolled up within one exchange, and explode without a join."""
    nodes = spark.range(1000).selectExpr("id % 3 as g", "id div 3 as rank", "334L as n", "sha2(string(id), 256) as h",
                                         "id as x")
    plan = merkle._rolled(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
