"""Toxicity, quality, language and URL verdicts: brute force and held-out accuracy."""

import re

import numpy as np
import pytest
from conftest_llm import awkward, prose
from pyspark.sql import functions as F

from ledgerlens.llm import language_id, quality, toxicity, url_filter
from ledgerlens.llm.store import held_out, table

SF = "/root/testdata/sf0.01"

# --- 6 ---------------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "https://A.Example.COM/en/x?q#f", "http://www.example.com/en/1", "http://example.com",
        "http://xexample.com/en/", "http://m.www.example.com/en/", "ftp://a.net/es/1", "http://a.net/es", "http://net/fr/2",
        "http://a.b.net?x=/fr/", "x://y://z/es/", "http://ÄB.org/", "http://com/", "http://a.com:80/", "http://e.net/en/",
        "http://a.com/" + "x" * 5000, "http://a.com/\n/b", "http://a.com/en/1"] * 2


def by_hand(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule, verdict in url_filter.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    return host, path, best


def test_urls_are_split_and_ruled_as_by_hand(spark):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, f int")
    got = url_filter.judge(pages, url_filter.labelled_table(spark)).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path, rule = by_hand(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        assert r.verdict == (rule[1] if rule else "block" if r.p_block >= url_filter.BLOCK_AT else "allow")


def test_url_model_is_the_gradient_descent(spark):
    """The coefficients' recursion equals descent on the weights themselves."""
    rows = url_filter.LABELLED[:10] + url_filter.LABELLED[-10:]
    labelled = url_filter.labelled_table(spark, rows)
    got = np.array(url_filter.train(labelled).first().w)
    host, path = url_filter.host_path(F.col("url"))
    seen = labelled.select(F.col("label"), url_filter.features(host, path).alias("f")).collect()
    x = np.zeros((len(seen), url_filter.DIM + 1))
    for i, r in enumerate(seen):
        x[i, r.f] = 1 / np.sqrt(len(r.f))
        x[i, -1] = 1
    y = np.array([r.label == "block" for r in seen], float)
    w = np.zeros(url_filter.DIM + 1)
    for _ in range(url_filter.STEPS):
        w = w * (1 - url_filter.RATE * url_filter.DECAY) + url_filter.RATE / len(y) * x.T @ (y - 1 / (1 + np.exp(-x @ w)))
    assert np.allclose(got, w, atol=1e-6)


def test_url_model_knows_bad_names(spark):
    urls = ["http://the-casino-win.test/en/5", "https://m.free-bets.org/x", "http://www.gardening.org/en/5", "http://thther.org/en/9"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, url_filter.labelled_table(spark)).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow"}


def test_url_filter_of_nothing_and_native(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    labelled = url_filter.labelled_table(spark)
    out = url_filter.judge(none, labelled)
    assert out.count() == 0 and not re.search("Python|Pandas|MapInArrow", out._jdf.queryExecution().toString())
    got = url_filter.judge(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), labelled.limit(0)).first()
    assert got.verdict == "allow"


# --- 7 ---------------------------------------------------------------------------------------

def test_block_max_finds_the_exact_neighbours():
    rng = np.random.default_rng(3)
    dense = rng.random((500, 40)) * (rng.random((500, 40)) < 0.1)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    rows = [np.flatnonzero(d) for d in dense]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    index = toxicity.BlockMaxIndex(first, np.concatenate(rows), np.concatenate([d[r] for d, r in zip(dense, rows)]),
                                   rng.integers(2, size=500), np.arange(500), 40)
    for q in dense[:60]:
        at = np.flatnonzero(q)
        place, cosine = index.nearest(at, q[at])
        want = np.sort(dense @ q)[::-1][:toxicity.NEIGHBOURS]
        want = want[want > 1e-12]
        assert np.allclose(cosine, want) and np.allclose(dense[index.ids[place]] @ q, cosine)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = toxicity.score(docs, labels, held_out("doc_id", 4, 2))
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == 1000
    bad = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in bad]) > 0.55 and np.mean([r.predicted for r in clean]) < 0.03
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in out.collect())


# --- 8 ---------------------------------------------------------------------------------------

def test_rare_words_of_a_family_are_telling(spark):
    family = [f"bomen{end}" for end in ("teja", "tell", "teci", "tura")]
    teach = [(i, prose(i, 30) + (" " + family[i % 4] if i < 20 else "")) for i in range(200)]
    docs = spark.createDataFrame(teach + [(1000 + k, w) for k, w in enumerate(family)] + [(2000, "bread")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(200)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels, F.col("doc_id") >= 1000).collect()}
    assert all(got[1000 + k].predicted == 1 and got[1000 + k].evidence for k in range(4))
    assert got[2000].predicted == 0


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.score(docs, labels, held_out("doc_id", 5, 0)).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_pairs_give_the_preferred_side_the_higher_score():
    rng = np.random.default_rng(1)
    good, poor = rng.normal(1, 1, (200, 3)), rng.normal(0, 1, (200, 3))
    w = quality.fit_pairs(good, poor)
    wins = ((good @ w)[:, None] > (poor @ w)[None, :]).mean()
    assert wins > 0.85
    d = good[:50] - poor[:50]
    assert (1 / (1 + np.exp(-d @ w))).mean() > 0.7


# --- 9 ---------------------------------------------------------------------------------------

def test_languages_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    got = language_id.identify(docs, held_out("doc_id", 4, 2)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() / got.count() > 0.98


def test_mixture_names_both_languages():
    rng = np.random.default_rng(5)
    model = rng.dirichlet(np.full(language_id.BUCKETS, 0.02), 3) + 1e-7
    model /= model.sum(axis=1, keepdims=True)
    texts = [prose(1, 300), prose(2, 300, 3000).upper()]
    both = (texts[0] + " " + "0123 4567 89" * 60).encode()
    data = np.frombuffer(both, np.uint8)
    seen = language_id._trigrams(data, np.array([0, len(data)]))[0]
    model[0] += 50 * np.bincount(seen[:len(texts[0])], minlength=language_id.BUCKETS) / len(seen)
    model[1] += 50 * np.bincount(seen[len(texts[0]):], minlength=language_id.BUCKETS) / len(seen)
    model /= model.sum(axis=1, keepdims=True)
    share = language_id.infer(data, np.array([0, len(data)]), model)[0]
    part = len(texts[0]) / len(both)
    assert share[2] == 0 and share[0] == pytest.approx(part, abs=0.1) and share.sum() == pytest.approx(1)


# --- awkward tables for all three ----------------------------------------------------------------

def test_awkward_rows(spark, odd, empty, labels):
    for docs, n in ((odd, len(awkward())), (empty, 0)):
        for marks in (labels, labels.limit(0)):
            for name, mod, run in (("toxic", 4, toxicity.score), ("quality", 5, quality.score)):
                out = run(docs, marks, held_out("doc_id", mod, 2 if mod == 4 else 0)).collect()
                assert len(out) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out), name
        out = language_id.identify(docs, held_out("doc_id", 4, 2)).collect()
        assert len(out) == n
        for r in out:
            if r.doc_id in (1, 2, 3, 4):
                assert (r.lang_pred, r.score) == ("und", 0.0)
            else:
                assert r.lang_pred in ("en", "fr") and 0 <= r.score <= 1
    assert {r.lang_pred for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()} == {"und"}
