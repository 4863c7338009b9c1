"""Line dedup against a plain count."""

import hashlib
import random

from paylake.llm import line_dedup


def brute(docs, min_chars=20, min_docs=3):
    lower = str.maketrans(line_dedup.UPPER, line_dedup.UPPER.lower())

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    shared = {k: max((i for i in s if i is not None), default=None) for k, s in holders.items() if len(s) >= min_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in shared or shared[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def documents():
    rng = random.Random(1)
    common = ["This line is in very many documents.", "\t tHIS line is in Very many documents. \r", "short line",
              "É ligne commune à tous les documents", "é LIGNE commune à tous les documents", "x" * 19, "y" * 20,
              "line with\x1cother separators inside", "  not stripped by ASCII rules "]
    docs = []
    for i in range(60):
        lines = [f"unique line number {rng.random()} of document" for _ in range(rng.randrange(5))]
        lines += rng.choices(common, k=rng.randrange(6))
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    return docs + [(100, None), (101, ""), (102, "\n\n"), (103, "\n" + common[0] + "\n"), (None, common[0] + "\n" + common[3]),
                   (5, common[0]), (5, common[0]), (104, "\n".join([common[6]] * 5000))]


def test_against_brute_force(spark):
    docs = documents()
    df = spark.createDataFrame([(i, t, "a", 2) for i, t in docs], "doc_id long, text string, line string, pos int")
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.op9_line_dedup(df).collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert sorted(map(str, [(r.doc_id, r.text) for r in out.collect()])) == sorted(
        str((i, t)) for i, _, _, t in brute(docs))


def test_two_documents_are_not_enough(spark):
    line = "a line that is long enough to count"
    df = spark.createDataFrame([(1, line + "\n" + line), (2, line), (2, line)], "doc_id long, text string")
    assert [r.n_dropped for r in line_dedup.op9_line_dedup(df).collect()] == [0, 0, 0]


def test_columns_of_the_same_names_stay(spark):
    """Given columns called like the added ones keep their values, in whatever case."""
    line = "a line that is long enough to count"
    df = spark.createDataFrame([(i, f"{line}\nown {i}", "keep", i) for i in range(4)], "doc_id long, text string, N_LINES string, n_dropped int")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "N_LINES", "n_dropped", "n_lines_1", "n_dropped_1"]
    rows = sorted(out.collect())
    assert [(r.N_LINES, r.n_dropped) for r in rows] == [("keep", i) for i in range(4)]
    assert [(r.n_lines_1, r.n_dropped_1) for r in rows] == [(2, 1), (2, 1), (2, 1), (2, 0)]


def test_no_python_and_empty(spark):
    df = spark.createDataFrame(documents(), "doc_id long, text string")
    plan = line_dedup.op9_line_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert line_dedup.op9_line_dedup(df.limit(0)).count() == 0
