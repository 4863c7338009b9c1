"""The pipeline against its stages' brute-force versions, each on its own input."""

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from test_decontaminate import brute as brute_hits
from test_simhash import groups_of, slow_fingerprint

import corpus_pipeline
from paylake.llm import quality
from paylake.llm.encoding import read_vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and gave, written and read again in between."""
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs.toPandas(), after.toPandas())
        if name != "token_output":
            assert after.columns == columns
        docs = after
    return out


def rows(frame):
    return Counter(map(tuple, frame.astype(object).where(frame.notna(), None).itertuples(index=False)))


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "token_output"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality(spark, stages):
    before, after = stages["quality"]
    verdict = {r.doc_id: r.kept for r in quality.op4_quality_rules(spark.createDataFrame(before)).collect()}
    assert rows(after) == rows(before[[verdict[i] for i in before.doc_id]])
    for t in after.text:
        m = quality.measure(t)
        assert m[0] >= 50 and 100 * m[4] <= 50 * m[0]


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    fps = {i: slow_fingerprint(t) for i, t in zip(before.doc_id, before.text)}
    root = groups_of(list(fps.values()), 3)
    first = {}
    for i, f in fps.items():
        first[root[f]] = min(first.get(root[f], i), i)
    assert rows(after) == rows(before[before.doc_id.isin(set(first.values()))])


def test_decontamination(stages):
    before, after = stages["decontamination"]
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    items = list(zip(map(str, bench.item_id), bench.text))
    hit = {r[0] for r in brute_hits(list(zip(before.doc_id, before.text)), items) if r[5]}
    left = dict(zip(after.doc_id, after.text))
    assert sorted(left) == sorted(before.doc_id)
    for i, t in zip(before.doc_id, before.text):
        assert (left[i] == t) == (i not in hit)
    assert not any(r[5] for r in brute_hits([(i, left[i]) for i in hit], items))


def test_mixing(stages):
    from test_mixing import slow_targets
    before, after = stages["mixing"]
    size = {i: len(t.encode().split()) for i, t in zip(before.doc_id, before.text)}
    sources, taken, copies = Counter(), Counter(), Counter(after.doc_id)
    for i, s in zip(before.doc_id, before.source):
        sources[s] += size[i]
        taken[s] += size[i] * copies[i]
    want = slow_targets(dict(sources))
    assert all(abs(taken[s] - want[s]) <= max(size.values()) / 2 + 1 for s in sources)
    assert max(copies.values()) <= 2 and set(rows(after)) <= set(rows(before))


def test_token_output(stages):
    from tokenizers import Tokenizer
    before, after = stages["token_output"]
    t = Tokenizer.from_str(read_vocabulary())
    want = Counter()
    for i, text in zip(before.doc_id, before.text):
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter(zip(after.doc_id, after.n_tokens, after.ids_crc32)) == want
    after = after.sort_values("start")
    assert after.doc_id.is_monotonic_increasing
    assert after.start.tolist() == [0, *np.cumsum(after.n_tokens)[:-1].tolist()]


def test_run_gives_the_same(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas()
    want = stages["token_output"][1]
    assert rows(got[sorted(got)]) == rows(want[sorted(want)])
