"""Cross-tokenizer alignment against whole-text encoding and plain set intersection."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import token_align
from paylake.llm.encoding import read_vocabulary


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_str(read_vocabulary())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=token_align.default_model())


def _tokens(text, tokenizers):
    """[(id, bytes)] of A and of B; none if they do not spell the text."""
    a, b = tokenizers
    byte = token_align.letter_bytes()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    out_a = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in ids_a]
    out_b = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
    want = (" " + text).encode()
    if not text or any(b"".join(x for _, x in o) != want for o in (out_a, out_b)):
        return [], []
    return out_a, out_b


def _ends(tokens):
    at, out = 0, {}
    for k, (_, x) in enumerate(tokens):
        at += len(x)
        out[at] = k
    return out


def brute(texts, tokenizers):
    docs = []
    for t in texts:
        a, b = _tokens(t or "", tokenizers)
        ea, eb = _ends(a), _ends(b)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ea.keys() & eb.keys()):
            p, q = ea[end] + 1, eb[end] + 1
            groups.append(",".join(str(x) for x, _ in a[i:p]) + "|" + ",".join(str(x) for x, _ in b[j:q]))
            links.append((a[p - 1][0], b[q - 1][0]))
            i, j = p, q
        docs.append((len(a), len(b), groups, links))
    count = Counter(x for d in docs for x in d[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [(na, nb, len(g), len(k), sum(count[x] == most[x[1]] for x in k), sum(count[x] for x in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if na else "") for na, nb, g, k in docs]


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "\0 \0a b\0", "it's they're", "x ▁ y", "a▁b", "é ñ  ü",
       "  x 　y", "<s> </s> <unk> <0x0A>", "<|endoftext|> a<|endoftext|>", "tab\tx \ty", "x" * 500, "日本語 テキスト",
       "\U0001f600 \U0001f601", "a\x1c b", "a\x85b c", "é nfc", "ﬁ ﬁ ligature", "﻿bom", "trail \n",
       "ALL CAPS, and; punctuation!! 12345 3.14", None]


def _got(df, **kw):
    return {r[0]: tuple(r)[1:] for r in token_align.op12_token_align(df, **kw).collect()}


@pytest.mark.parametrize("pair_rows", [1_000_000, 0])
def test_odd_texts(spark, tokenizers, pair_rows):
    rows = [(i, t, 7) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int").repartition(3)
    got = _got(df, pair_rows=pair_rows)
    for (i, t, _), want in zip(rows, brute(ODD, tokenizers)):
        assert got[i] == want, repr(t)


def test_table(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = _got(docs)
    assert [got[r.doc_id] for r in rows] == brute([r.text for r in rows], tokenizers)


def test_repeated_and_long(spark, tokenizers):
    long = "some words, repeated over and over. " * 20_000
    texts = [long, "same text", "same text"]
    df = spark.createDataFrame([(1, long), (None, "same text"), (None, "same text")], "doc_id long, text string")
    got = sorted(tuple(r)[1:] for r in token_align.op12_token_align(df).collect())
    assert got == sorted(brute(texts, tokenizers))
    assert token_align.op12_token_align(df.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sa1.é\0 ▁<>"), st.characters()), max_size=30), max_size=5))
def test_any_text(tokenizers, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    if not texts:
        return
    found = _codec().align(pa.array(texts, pa.large_string()), True)
    want = brute(texts, tokenizers)
    assert list(zip(*(x.to_pylist() for x in found[:4]))) == [(w[0], w[1], w[2], w[6]) for w in want]


def _codec(made=[]):  # noqa: B006 - one for all examples
    if not made:
        with open(token_align.default_model(), "rb") as f:
            made.append(token_align.Aligner(read_vocabulary(), f.read()))
    return made[0]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)))
def test_common_ends(shared, left, right):
    a, b = (np.array(sorted(shared | x | {401}), np.int64) for x in (left, right))
    i, j = token_align.common_ends(a, b)
    both, p, q = np.intersect1d(a, b, return_indices=True)
    assert np.array_equal(i, p) and np.array_equal(j, q) and np.array_equal(a[i], both)


def test_groups_as_text(spark):
    row = token_align.align(spark.createDataFrame([(1, "Hello world")], "doc_id long, text string")).first()
    assert row.groups.count(";") + 1 == row.n_groups == sum(row.times)
    counts = token_align.pair_counts(spark.createDataFrame([row]), token_align.model_size()).collect()
    assert {(r.a, r.b): r["count"] for r in counts} == {divmod(p, 32_000): t for p, t in zip(row.pairs, row.times)}
    assert all(r.best for r in counts)
