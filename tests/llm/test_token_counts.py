"""Token counts by section against the tokenizer's own offsets."""

import numpy as np
import pandas as pd
import pytest

from paylake.llm import token_counts as tc
from paylake.llm.encoding import read_vocabulary

TEXTS = ["", "\n", "\n\n", "one line", "two\nlines here", "a\n\n\nb", "  lead \n\t mixed \n", "é ñ\nü 😀 x", "word, word.\nMore; text",
         "x" * 300 + "\n" + "y z " * 50, "a  b\n  c", " ends with space ", "<|endoftext|>\nx", "tab\there\nnow", "\n a"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(read_vocabulary())
    return t


def brute(tokenizer, text, sections=None):
    spans = tokenizer.encode(text or "", add_special_tokens=False).offsets
    if sections is None:
        sections, at = [], 0
        for line in (text or "").split("\n"):
            sections.append((at, min(len(text or ""), at + len(line) + 1)))
            at += len(line) + 1
    counts, crossing = [0] * len(sections), 0
    for s, e in spans:
        held = [max(0, min(e, b) - max(s, a)) for a, b in sections]
        crossing += sum(h > 0 for h in held) > 1
        if held and max(held) > 0:
            counts[held.index(max(held))] += 1
    return len(spans), crossing, counts


def test_spans_equal_the_tokenizers(tokenizer):
    codec = tc.SpanEncoder(read_vocabulary(), plain_special=False)
    for _ in range(2):
        for t, got in zip(TEXTS, codec.spans(TEXTS)):
            assert list(map(tuple, got.tolist())) == tokenizer.encode(t, add_special_tokens=False).offsets, t


def test_lines(spark, tokenizer):
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    docs = list(zip(map(int, table.doc_id[:80]), table.text[:80])) + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    docs += [(None, None), (5, "a\nb"), (5, "a\nb")]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, counts int")
    rows = tc.op10_token_counts(df).collect()
    assert len(rows) == len(docs)
    for r, (i, t) in zip(rows, docs):
        n, crossing, counts = brute(tokenizer, t)
        got = [int(x) for x in r.section_tokens.split(",")]
        assert (r.doc_id, r.n_tokens, r.n_crossing, r.n_sections) == (i, n, crossing, len(counts))
        assert got == counts and sum(got) == n
    assert tc.op10_token_counts(df.limit(0)).count() == 0


def test_given_sections_and_the_boundary_rule(spark, tokenizer):
    text = "alpha beta gammadelta epsilon"
    sections = [(0, 8), (8, 13), (17, 29)]
    df = spark.createDataFrame([(1, text, sections), (2, text, []), (3, text, None)],
                               "doc_id long, text string, fields array<struct<start:int,end:int>>")
    rows = tc.count_tokens(df, "fields").select("doc_id", "counts.*").collect()
    n, crossing, counts = brute(tokenizer, text, sections)
    assert (rows[0].n_tokens, rows[0].n_crossing, rows[0].section_tokens) == (n, crossing, counts)
    assert [r.section_tokens for r in rows[1:]] == [[], []]


def test_ties_go_to_the_earlier_section():
    counts, crossing = tc.attribute(np.array([[0, 4], [4, 6], [6, 9], [20, 21]]), np.array([0, 5, 7]), np.array([5, 7, 10]))
    assert counts.tolist() == [2, 0, 1] and crossing == 2


def test_special_tokens_as_tokens(spark):
    from tokenizers import Tokenizer
    default = Tokenizer.from_str(read_vocabulary())
    texts = ["one<|endoftext|> two", "a\n<|endoftext|>\nb", "plain text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tc.count_tokens(df, counts="c", plain_special=False).select("c.*").collect()
    assert [(r.n_tokens, r.n_crossing, r.section_tokens) for r in got] == [brute(default, t) for t in texts]


def test_special_tokens_as_in_the_token_files(spark, tokenizer):
    """By default the string of a special token is one token, as op5 writes it; ``plain_special`` makes it text."""
    from paylake.llm import token_files
    df = spark.createDataFrame([(1, "one<|endoftext|> two\n<|endoftext|>"), (2, "no such string")], "doc_id long, text string")
    ours = {r.doc_id: r.n_tokens for r in tc.op10_token_counts(df).collect()}
    files = {r.doc_id: r.n_tokens - 1 for r in token_files.op5_token_output(df).collect()}  # less the end id
    assert ours == files and ours[1] == 5
    plain = {r.doc_id: r.counts.n_tokens for r in tc.count_tokens(df, counts="counts", plain_special=True).collect()}
    assert plain[1] > ours[1] and plain[2] == ours[2]
