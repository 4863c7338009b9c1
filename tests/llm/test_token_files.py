"""Token files: exact round trips, and the written ids against direct encoding."""

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import token_files
from paylake.llm.encoding import IdEncoder, read_vocabulary
from paylake.llm.pfor import BLOCK, TokenFile, TokenFileWriter, pack, unpack


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(read_vocabulary())
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 2**31, 2**32])
def test_blocks_round_trip(high):
    rng = np.random.default_rng(high % 1000)
    ids = rng.integers(0, high, 20 * BLOCK, dtype=np.uint64).astype(np.uint32)
    ids[::97] = rng.integers(0, 2**32, len(ids[::97]), dtype=np.uint64).astype(np.uint32)
    data, *index = pack(ids)
    assert np.array_equal(unpack(np.frombuffer(data, np.uint8), *index).ravel(), ids)


def test_outliers_become_exceptions():
    ids = np.full(BLOCK, 7, np.uint32)
    ids[[3, 900]] = 2**32 - 1
    data, start, low, width, n_over = pack(ids)
    assert (width[0], n_over[0], len(data)) == (0, 2, 12)


@pytest.mark.parametrize("sizes", [[], [0], [5, 0, 1024, 1, 5000, 0], [600_000, 3, 0, 1_200_000]])
def test_files_round_trip(sizes):
    rng = np.random.default_rng(1)
    docs = [(None if i == 1 else i * 10 - 3, rng.integers(0, 50_000, n).astype("<u4")) for i, n in enumerate(sizes)]
    out = io.BytesIO()
    w = TokenFileWriter(out)
    for i, ids in docs:
        w.add(i, ids.tobytes())
    w.close()
    f = TokenFile(io.BytesIO(out.getvalue()), len(out.getvalue()))
    got, at = list(f.documents()), 0
    assert len(got) == len(docs)
    for (i, ids), (j, start, read) in zip(docs, got):
        assert (i, at) == (j, start) and np.array_equal(ids, read)
        at += len(ids)
    every = np.concatenate([x for _, x in docs]) if docs else np.empty(0)
    assert np.array_equal(f.read(min(2000, at), min(3100, at)), every[2000:3100])


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "\0 \0a b\0", "it's they're 'll x's", "  lead",
       "trail  ", "tab\tx \ty", "é ñ  ü", "  x 　y", "<|endoftext|> a<|endoftext|>", "1 22 333", "x" * 500,
       " ".join(["y" * 70] * 3), "a\x1c b", "a\x85b c", "  z", "\U0001f600 \U0001f601"]


def test_pieces_equal_whole_texts(tokenizer):
    codec = IdEncoder(read_vocabulary())
    for _ in range(2):  # the second time from the memo
        for text, got in zip(ODD, codec.encode(ODD)):
            assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sa1.é\0 "), st.characters()), max_size=40),
                max_size=5))
def test_pieces_equal_whole_texts_for_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    codec = _codec()
    want = [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == want


def _codec(made=[]):  # noqa: B006 - one for all examples
    if not made:
        made.append(IdEncoder(read_vocabulary()))
    return made[0]


def expected(docs, tokenizer):
    at, out = 0, []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [40, 64_000_000])
def test_documents(spark, tokenizer, tmp_path, file_ids):
    docs = [(i * 7 % 41 - 5, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id"), (99, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int")
    folder = f"file://{tmp_path}/out"
    manifest = token_files.write_tokens(df, folder, file_ids=file_ids)
    got = [tuple(r) for r in token_files.read_tokens(manifest, folder).collect()]
    want = expected(docs, tokenizer)
    assert sorted(r[0] is None or r[0] for r in got) == sorted(r[0] is None or r[0] for r in want)
    ordered = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in ordered] == [r[0] for r in want]
    single = {r[0]: r for r in want if [w[0] for w in want].count(r[0]) == 1}
    alike = {r[0]: r for r in ordered}
    assert sum(r[2] for r in got) == sum(r[2] for r in want)
    assert {i: alike[i] for i in single} == single
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".tokens")]


def test_query_on_a_table_and_on_none(spark, default_tokenizer):
    import pandas as pd
    path = "/root/testdata/sf0.001/documents.parquet"
    got = sorted(tuple(r) for r in token_files.op5_token_output(spark.read.parquet(path)).collect())
    rows = pd.read_parquet(path)
    assert got == expected(list(zip(rows.doc_id.tolist(), rows.text.tolist())), default_tokenizer)
    assert token_files.op5_token_output(spark.createDataFrame([], "doc_id long, text string")).count() == 0


SPECIAL = ["one<|endoftext|> two", "<|endoftext|>", "a <|endoftext|> b <|endoftext|>\nc", "<|endoftext|", "endoftext|> x"]


@pytest.fixture(scope="module")
def default_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(read_vocabulary())


def test_special_tokens_by_the_default_tokenizer(default_tokenizer):
    assert default_tokenizer.encode(SPECIAL[0], add_special_tokens=False).ids == [505, 50256, 734]
    codec = IdEncoder(read_vocabulary(), plain_special=False)
    for _ in range(2):
        for text, got in zip(ODD + SPECIAL, codec.encode(ODD + SPECIAL)):
            want = default_tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(got, "<u4").tolist() == want, text


def test_added_tokens_with_a_space_in_them():
    from tokenizers import AddedToken, Tokenizer
    t = Tokenizer.from_str(read_vocabulary())
    t.add_tokens([AddedToken("big deal", normalized=False)])
    t.add_special_tokens([AddedToken("<|a b|>", normalized=False)])
    texts = ["a big deal", "big", "deal", "no big", "deal big", "x<|a b|>y", "x <|a", "b|> y"]
    for plain in (False, True):
        t.encode_special_tokens = plain
        want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
        got = IdEncoder(t.to_str(), plain_special=plain).encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_query_and_pipeline_stage_take_special_tokens_as_tokens(spark, default_tokenizer):
    import corpus_pipeline
    docs = [(i, t) for i, t in enumerate(SPECIAL + ODD)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = expected(docs, default_tokenizer)
    assert sorted(tuple(r) for r in token_files.op5_token_output(df).collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.token_output(spark, df, "").collect()) == want
