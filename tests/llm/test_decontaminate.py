"""FM-index and decontamination against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylake.llm import decontaminate as dc
from paylake.llm.fm_index import FMIndex, ranges, suffix_array


def test_suffix_array_orders_suffixes_up_to_their_separator():
    rng = np.random.default_rng(0)
    text = rng.integers(1, 4, 200)
    text[rng.integers(0, 200, 25)] = 0
    text[-1] = 0
    sep = np.cumsum(text == 0) - 1

    def suffix(i):
        out = []
        while text[i]:
            out.append((1, text[i]))
            i += 1
        return [*out, (0, sep[i])]
    assert suffix_array(text).tolist() == sorted(range(200), key=suffix)


@pytest.mark.parametrize("symbols", [1, 2, 7, 300])
def test_search_and_locate(symbols):
    rng = np.random.default_rng(symbols)
    text = rng.integers(1, symbols + 1, 3000)
    text[rng.integers(0, 3000, 200)] = 0
    text[-1] = 0
    index = FMIndex(text, symbols)
    phrases = np.zeros((80, 4), np.int64)
    lengths = rng.integers(1, 5, 80)
    for i, n in enumerate(lengths):
        at = rng.integers(0, 2990)
        phrases[i, :n] = np.maximum(1, text[at:at + n])
    lo, hi = index.search(phrases, lengths)
    rows, which = ranges(lo, hi)
    found = index.locate(rows)
    for i, n in enumerate(lengths):
        want = [j for j in range(3000 - n + 1) if (text[j:j + n] == phrases[i, :n]).all()]
        assert sorted(found[which == i].tolist()) == want


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items, width=10):
    phrases = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            phrases.setdefault(tuple(w[s:s + width]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for p, ids in phrases.items():
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s:s + len(p)]) == p:
                    hit |= set(range(s, s + len(p)))
                    names |= ids
        listed = sorted(str(x) for x in names if x is not None)
        out.append((i, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return out


def planted():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(40)] + ["Été", "naïve", "3,14"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "!!!"), (15, items[0][1].upper()), (None, items[4][1]), (2, items[2][1])]
    docs = []
    for i in range(80):
        w = rng.choices(vocab, k=rng.randrange(60))
        if i % 2:
            piece = words(items[rng.randrange(12)][1])
            a = rng.randrange(max(1, len(piece) - 5))
            w[rng.randrange(len(w) + 1):0] = piece[a:]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    return docs + [(200, None), (201, ""), (None, items[3][1]), (7, items[5][1] * 3), (7, items[5][1])], items


@pytest.mark.parametrize("shard, block", [(2_000_000, 10**9), (50, 10**9), (2_000_000, 60)])
def test_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(dc, "SHARD_WORDS", shard)
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (block,))
    docs, items = planted()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, hits int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in dc.op8_decontaminate(df, bench).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(docs, items)))


def test_removal(spark):
    docs, items = planted()
    df = spark.createDataFrame([(i, t, len(t or ""), "c") for i, t in docs],
                               "doc_id long, text string, n_chars int, llm_text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.remove_benchmark(df, bench)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    rows = out.collect()
    assert not any(r[5] for r in brute([(r.doc_id, r.text) for r in rows], items))
    clean = {r[0] for r in brute(docs, items) if not r[5]}
    before = {i: t for i, t in docs}
    assert all(r.text == before[r.doc_id] for r in rows if r.doc_id in clean)
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert out.where(F.col("text").isNull()).count() == 1


def test_words_brought_together_are_searched_again():
    p = dc.Phrases([("1", "a b c d"), ("2", "x y")], 3)
    assert "".join(dc.cleaned(["k x a b c d y k"], p)).split() == ["k", "k"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in dc.op8_decontaminate(docs, none).collect()] == [(2, 0, 0)]
    assert dc.op8_decontaminate(docs.limit(0), none).count() == 0
    assert dc.remove_benchmark(docs, none).collect() == docs.collect()


@pytest.mark.parametrize("block", [1, 60])
def test_removal_does_not_depend_on_the_blocks(spark, monkeypatch, block):
    docs, items = planted()
    items = [("x", "q1 q2"), ("y", "p1 p2 p3"), ("z", "p3 p4 p5"), *[(str(i), t) for i, t in items]]
    docs = [*docs, (900, "k q1 p1 p2 p3 q2 k"),  # the cut of a later block's phrase joins an earlier block's
            (901, "k p1 p2 p3 p4 p5 k"),         # phrases of two blocks share a word
            (902, "k q1 p3 p1 p2 p3 p4 p5 q2 k")]
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in docs], "doc_id long, text string, n_chars int")
    bench = spark.createDataFrame(items, "item_id string, text string").coalesce(1)
    want = sorted(map(str, dc.remove_benchmark(df, bench).collect()))
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (block,))
    assert len(list(dc.item_blocks(bench))) > 1
    out = dc.remove_benchmark(df, bench)
    rows = out.collect()
    assert out.columns == df.columns and sorted(map(str, rows)) == want
    left = {r.doc_id: r.text.split() for r in rows if r.doc_id in (900, 901)}
    assert left == {900: ["k", "k"], 901: ["k", "k"]}
    assert not any(r[5] for r in brute([(r.doc_id, r.text) for r in rows], items))
