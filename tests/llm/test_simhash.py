"""SimHash near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash

from paylake.llm import simhash
from paylake.llm.components import components


def slow_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", low)]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_of(fps, distance):
    """node -> least node of its component, by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def near_set(rng, n, center_bits):
    centers = rng.integers(0, 2**63, 6, dtype=np.uint64) | np.uint64(1 << 63)
    out = set()
    while len(out) < n:
        c = int(centers[rng.integers(len(centers))])
        for b in rng.integers(0, 64, rng.integers(0, center_bits + 1)):
            c ^= 1 << int(b)
        out.add(c)
    return sorted(out)


def test_fingerprint_matches_the_definition():
    for t in ["", " \n", "one", "One two", "a b c", "A b C d\te  f", "Élan É x y z ñ", "x " * 200, None]:
        assert simhash.fingerprint(t or "") == slow_fingerprint(t)


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
@pytest.mark.parametrize("limit", [2, 40, 100_000])
def test_links_keep_every_component(spark, monkeypatch, distance, limit):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", limit)
    if distance == 4 and limit == 2:
        return  # thousands of masks on a handful of rows: nothing new to see
    fps = near_set(np.random.default_rng(distance), 220, 6)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    nodes = spark.createDataFrame(signed, "fp long")
    edges = simhash.links(nodes, distance).collect()
    for e in edges:
        assert e.a in {s for s, in signed} and e.b in {s for s, in signed}
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    found = {}
    for s, in signed:
        found.setdefault(roots.get(s, s), set()).add(s & (2**64 - 1))
    want = {}
    for f, r in groups_of(fps, distance).items():
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_crowded_last_bucket_is_linked_by_cliques(monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 8)
    rng = np.random.default_rng(0)
    low = np.unique(rng.integers(0, 1 << 14, 150)).astype(np.uint64)
    fps = np.concatenate([low, low[:20] ^ np.uint64(1 << 33)])
    fps = np.unique(fps)
    links = simhash._Links()
    start = 1  # ring: bits 16-31, 32-47, 48-63, 0-15: only the last segment varies, within all of the budget
    same = fps[(fps >> np.uint64(32)) == 0]
    simhash._cliques(same, start, 3, links)
    a, b = links.contract()
    got = {int(f): int(f) for f in same} | {int(x): int(y) for x, y in zip(a, b)}
    assert got == groups_of([int(f) for f in same], 3)


DOCS = [(5, "a b c d e f g"), (3, "a b c d e f g"), (9, "A B c d e f g"), (1, None), (7, ""), (2, "quite another text"),
        (None, "a b c d e f g"), (4, "one more thing entirely different"), (4, "one more thing entirely different"),
        (None, "nobody knows this one")]


def test_documents(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, fp int, root string")
    rows = [tuple(r) for r in simhash.op3_simhash(docs).collect()]
    assert len(rows) == len(DOCS)
    fps = {slow_fingerprint(t) for _, t in DOCS}
    group = groups_of(fps, 3)
    want = []
    for i, t in DOCS:
        ids = [j for j, u in DOCS if j is not None and group[slow_fingerprint(u)] == group[slow_fingerprint(t)]]
        want.append((i, f"{slow_fingerprint(t):016x}", min(ids) if ids else None))
    assert sorted(map(str, rows)) == sorted(map(str, want))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.op3_simhash(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, j) for j in range(1000, 1200)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + hub, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{j: 7 for j in range(1000, 1200)}}


def test_the_row_that_stays_does_not_depend_on_order(spark):
    """Rows with one doc_id and text but other columns: the same one stays, whichever comes first."""
    rows = [(1, "one and the same text of words", "en", "b"), (1, "one and the same text of words", "fr", "a"),
            (2, "one and the same text of words", "de", "c"), (None, "another text altogether, of its own", None, None)]
    kept = []
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string, source string").coalesce(1)
        kept.append(sorted(map(str, simhash.drop_near_duplicates(df, 3, 3).collect())))
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2
