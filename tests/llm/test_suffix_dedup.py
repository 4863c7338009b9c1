"""Repeated passages against all windows of all documents."""

import random

import numpy as np
import pandas as pd
import pytest

from paylake.llm import suffix_dedup as sd


def brute(docs, k):
    """(doc_id, start, end) of maximal passages by comparing all windows."""
    where = {}
    words = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in words:
        for s in range(len(w) - k + 1):
            where.setdefault(tuple(w[s:s + k]), set()).add(i)
    out = set()
    for i, w in words:
        spans = []
        for s in range(len(w) - k + 1):
            if len(where[tuple(w[s:s + k])]) > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + k
                else:
                    spans.append([s, s + k])
        out |= {(i, s, e) for s, e in spans}
    return out


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def planted(seed):
    rng = random.Random(seed)
    passages = [words(rng, n) for n in (12, 13, 19, 30, 60)]
    docs = []
    for i in range(60):
        w = words(rng, rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) - 8)
            w[rng.randrange(len(w) + 1):0] = p[a:a + rng.randrange(8, 60)]
        docs.append((i, " ".join(w)))
    copy = docs[3][1]
    docs += [(100, copy), (101, copy.replace(" ", "\n")), (102, copy + " x"), (103, None), (104, ""), (None, copy),
             (7, docs[9][1]), (7, docs[9][1])]
    return docs


def test_gram_hashes_depend_on_their_words_only():
    h = np.array([5, 7, 9, 5, 7, 9, 11, 5, 7, 9, 11], np.uint64)
    for width in (1, 2, 3, 4):
        g = sd.gram_hashes(h, width)
        for i in range(len(g)):
            for j in range(len(g)):
                assert (g[i] == g[j]) == (h[i:i + width].tolist() == h[j:j + width].tolist())
    assert len(sd.gram_hashes(h, 12)) == 0


def test_minimisers_are_the_leftmost_least():
    seeds = np.random.default_rng(0).integers(0, 9, 200).astype(np.uint64)
    for window in (1, 2, 3, 7, 31):
        want = [i + int(np.argmin(seeds[i:i + window])) for i in range(len(seeds) - window + 1)]
        assert sd.minimisers(seeds, window).tolist() == want


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    docs = planted(seed)
    df = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, start string")
    rows = sd.repeated_passages(df, 12, 5).collect()
    assert {(r.doc_id, r.start, r.end) for r in rows} == brute(docs, 12)
    assert all(r.other != r.doc_id for r in rows)
    assert {r.doc_id for r in rows} >= {3, 100, 101, 102}


def test_many_ranges_agree_with_one(spark):
    docs = planted(3) + [(1000 + i, planted(3)[5][1]) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = sd.repeated_passages(df, 12, 5).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert {(r.doc_id, r.start, r.end) for r in rows} == brute(docs, 12)


def test_cut_keeps_the_first(spark):
    docs = planted(1)[:60]
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, llm_key int")
    out = sd.cut_repeats(df, 12, 5)
    assert out.columns == df.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert len(texts) == len(docs)
    # what remains of all documents has every window of the input exactly once or is cut at its borders
    assert not {x for x in brute(list(texts.items()), 12) if x[2] - x[1] > 24}
    untouched = {i for i, _ in docs} - {i for i, _, _ in brute(docs, 12)}
    assert all(texts[i] == t for i, t in docs if i in untouched)


def test_query_on_a_table_and_on_none(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = sd.op1_suffix_dedup(spark.read.parquet(path)).collect()
    table = pd.read_parquet(path)
    assert {(r.doc_id, r.start, r.end) for r in rows} == brute(list(zip(table.doc_id.tolist(), table.text)), 50)
    assert sd.op1_suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
