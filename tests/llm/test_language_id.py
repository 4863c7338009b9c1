"""Language identification: held-out accuracy, and what each kind of evidence does."""

import pytest
from pyspark.sql import functions as F

from paylake.llm import language_id as li

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_reading_a_page():
    page = '<!doctype html><HTML class="x" LANG=fr-CA><style>p{}</style><script>var de="</p>"</script><!-- nein --><p>a&amp;b</p>'
    assert li.declared_language(page) == "fr"
    assert li.visible_text(page) == "a&b"
    assert li.declared_language('<meta http-equiv="content-language" content="de">') == "de"
    assert li.declared_language("<html><body>") is None and li.visible_text("") == ""


def test_text_model_on_held_out_documents(spark, docs):
    """Fitted on a bounded sample of half the documents, tried on the other half."""
    half = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(2)) == 0
    model = li.fit_text_model(docs.where(half), per_language=60)
    rows = docs.where(~half & (F.length("text") > 200)).select("lang", "text").collect()
    right = sum(model.languages[int(model.log_likelihoods(r.text).argmax())] == r.lang for r in rows)
    assert right >= 0.97 * len(rows), (right, len(rows))


def test_the_sample_is_bounded(spark, docs):
    n = {r.lang: r["count"] for r in li.training_sample(docs, 30).groupBy("lang").count().collect()}
    assert set(n) == {"de", "en", "es", "fr"} and all(10 <= x <= 60 for x in n.values())


def pages_of(docs, lang, n):
    return [r.text[:800] for r in docs.where((F.col("lang") == lang) & (F.length("text") > 300)).orderBy("doc_id")
            .limit(n).collect()]


def test_fusion(spark, docs):
    fr, de = pages_of(docs, "fr", 12), pages_of(docs, "de", 12)
    rows = [(i, f"http://a.example.fr/{i}", f'<html lang="fr"><p>{t}</p>') for i, t in enumerate(fr)]
    rows += [(100 + i, f"https://b.example.de/x/{i}", f'<html lang="de"><p>{t}</p>') for i, t in enumerate(de)]
    rows += [(200, "http://a.example.fr/e", '<html lang="fr"><p></p>'),      # no text: markup, suffix and host
             (201, "https://b.example.de/e", "<html><p></p>"),               # no text, no markup: suffix and host
             (202, "http://a.example.fr/z", f'<html lang="fr"><p>{de[0]}</p>'),  # text against all the rest
             (203, None, None), (204, "not an address", "<p>1</p>"), (200, "http://a.example.fr/e", '<html lang="fr"><p></p>')]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, language string")
    out = li.identify(pages, docs, "found")
    assert out.columns == [*pages.columns, "found"]
    got = {}
    for r in out.collect():
        got.setdefault(r.page_id, r.found)
    assert out.count() == len(rows)
    assert all(got[i].lang == "fr" for i in range(12)) and all(got[100 + i].lang == "de" for i in range(12))
    assert got[200].lang == "fr" and got[200].text_lang is None and got[201].lang == "de"
    assert got[202].lang == "de" and got[202].confidence <= got[100].confidence
    assert got[203].host is None and got[203].lang is not None and got[204].host is None
    assert got[0].host == "a.example.fr" and got[0].suffix == "fr"


def test_query_and_empty_tables(spark, docs):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = li.op7_language_id(pages, docs).collect()
    assert len(rows) == pages.count() and {r.lang for r in rows} <= {"de", "en", "es", "fr"}
    agree = [r for r in rows if r.declared and r.suffix and r.suffix.endswith(r.declared) and r.text_lang == r.declared]
    assert agree and all(r.lang == r.declared for r in agree)
    assert li.op7_language_id(pages.limit(0), docs).count() == 0
    none = li.op7_language_id(pages.limit(3), docs.limit(0)).collect()
    assert [r.lang for r in none] == [None] * 3


def test_every_language_can_be_found(spark):
    """300 labelled languages, each with words of its own."""
    words = {f"l{k:03d}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + (k * 7 + j) % 26)}{j}q" for j in range(12)]
             for k in range(300)}
    docs = spark.createDataFrame([(k * 10 + j, " ".join(w * 6), lang) for k, (lang, w) in enumerate(words.items())
                                  for j in range(2)], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(k, None, "<p>" + " ".join(w * 4) + "</p>") for k, w in enumerate(words.values())],
                                  "page_id long, url string, html string")
    assert len(li.fit_text_model(docs).languages) == 300
    got = {r.page_id: r.text_lang for r in li.op7_language_id(pages, docs).collect()}
    assert [got[k] for k in range(300)] == list(words)
    assert li.buckets_for(200) == li.BUCKETS and li.buckets_for(300) * 300 <= li.MODEL_CELLS


@pytest.mark.parametrize("piece", ["<", "<script>", "<html ", "<!--", "<style", "</script ", "<meta http-equiv=content-language "])
def test_hostile_pages_take_time_in_proportion(piece):
    import time
    for tail in ("", ">"):
        page = piece * (1_000_000 // len(piece)) + tail
        start = time.process_time()
        li.read_page(page)
        assert time.process_time() - start < 1.5, piece


def test_odd_markup():
    assert li.declared_language('<html data-lang="de" lang="fr">') == "fr"
    assert li.declared_language('<html data-lang="de">') is None
    assert li.declared_language('<meta content="es" http-equiv="Content-Language">') == "es"
    assert li.declared_language('<meta http-equiv="content-language" content="de"><html lang="fr">') == "fr"
    assert li.visible_text("a<script>b") == "a b" and li.visible_text("1 < 2") == "1 < 2"
    assert li.visible_text("x<!-- > y -->z<!-- w > v") == "x z v"
    assert li.visible_text("a<style>p</STYLE >b<style >q") == "a b q"


def brute(pages, model):
    """Posterior of every page from the definitions: (host, suffix, declared, html) rows."""
    import numpy as np
    n, soft = len(model.languages), lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    ll = [model.log_likelihoods(li.visible_text(p[3] or "")) for p in pages]
    q = np.array([soft(x) for x in ll])
    whole = q.sum(axis=0)

    def mass(k, value):
        return q[[i for i, p in enumerate(pages) if p[k] == value]].sum(axis=0)
    out = []
    for i, p in enumerate(pages):
        given = [np.log((mass(k, p[k]) + li.TABLE_ALPHA) / (whole + li.TABLE_ALPHA * len({x[k] for x in pages})))
                 for k in (2, 1)]
        wide = (whole + 1) / (len(pages) + n)
        suffix = (mass(1, p[1]) + li.HOST_PAGES * wide) / (mass(1, p[1]).sum() + li.HOST_PAGES)
        own = np.maximum(mass(0, p[0]) - q[i], 0)
        prior = (own + li.HOST_PAGES * suffix) / (max(mass(0, p[0]).sum() - 1, 0) + li.HOST_PAGES)
        out.append(soft(ll[i] + given[0] + given[1] + np.log(prior)))
    return out


def test_posterior_against_its_definition(spark, docs):
    texts = pages_of(docs, "fr", 5) + pages_of(docs, "de", 4) + [""]
    urls = ["http://a.fr/x", "http://a.fr/y", "http://b.de/fr/z", "http://b.de/w", None, "http://c.fr/", "http://b.de/fr/u",
            "http://d.com/", "http://a.fr/v", "http://a.fr/t"]
    marks = ["<html lang=fr>", "", "<html lang=de>", "<html lang=de>", "", "<html lang=fr>", "", "", "<html lang=xx>", ""]
    rows = [(i, u, m + t) for i, (u, m, t) in enumerate(zip(urls, marks, texts))]
    got = {r.page_id: r for r in li.op7_language_id(
        spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    model = li.fit_text_model(docs)
    want = brute([(got[i].host, got[i].suffix, got[i].declared, h) for i, _, h in rows], model)
    for i, p in enumerate(want):
        assert got[i].lang == model.languages[int(p.argmax())] and abs(got[i].confidence - p.max()) < 2e-4, i
