"""Common passages, many rows of one id and text, and bounds of the sketches."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose

from ledgerlens.llm import fingerprint, ngram_join, packing, quality, substring_dedup
from ledgerlens.llm.ngram_join import least_estimate, like_pairs, ngrams, sketches


def rare(seed, words):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(words))


@pytest.mark.parametrize("words", [6, 12, 40, 150, 600, 3000])
def test_sketches_keep_pairs_at_the_threshold(words):
    """Pairs of 0.8 and a little more, of every length, pass the sketches."""
    rng = random.Random(words)
    kept = total = 0
    for _ in range(60):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
        near = base[:-1] if words < 40 else base[:int(words * 0.91)] + [f"v{rng.randrange(10 ** 6)}" for _ in range(int(words * 0.01))]
        grams, first = ngrams(*_column([" ".join(base), " ".join(near)]))
        a, b = set(grams[:first[1]]), set(grams[first[1]:])
        if len(a & b) >= 0.8 * len(a | b):
            total += 1
            kept += like_pairs(sketches(grams, first), 0.8)[0, 1]
    assert kept == total and (total or words == 6)
    assert least_estimate(0.8) == pytest.approx(0.7)


def _column(texts):
    from ledgerlens.llm import words as W
    return W.column_bytes(pa.array(texts))


def test_sketches_part_texts_with_a_common_passage():
    common = rare(1, 70)
    texts = [common + " " + rare(100 + i, 50) for i in range(300)]
    grams, first = ngrams(*_column(texts))
    linked = like_pairs(sketches(grams, first), 0.8)
    assert linked.sum() == 0 and (linked == linked.T).all()


def test_a_common_passage_links_nothing(spark):
    common = rare(1, 70)
    rows = [(i, common + " " + rare(100 + i, 50)) for i in range(300)] + [(900, common), (901, common + " x")]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{i: (i, 0) for i in range(300)}, 900: (900, 1), 901: (900, 1)}


def test_many_rows_of_one_id_and_text(spark):
    """Every row of a repeated (id, text) is judged as the one row would be."""
    passage = prose(5, 40)
    one = [(None, passage + " " + prose(6, 30)), (3, passage), (4, None)]
    many = [r for r in one for _ in range(200)]
    few, all_ = (spark.createDataFrame(rows, "doc_id long, text string") for rows in (one, many))
    alone = sorted(map(str, substring_dedup.dedup(few).collect()))
    assert sorted(map(str, substring_dedup.dedup(all_).collect())) == sorted(alone * 200)
    pieces = packing.packed(all_).collect()
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert fingerprint.fingerprints(all_).where("near_next < 1").count() <= 3


def test_equal_rows_spread_over_shards(spark):
    rows = spark.createDataFrame([(None, "same text")] * 400, "doc_id long, text string").repartition(2)
    assert len({r.shard for r in packing.packed(rows, shard_rows=50).collect()}) > 4


def test_common_extensions_are_exact(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abé") for _ in range(n)) for n in (0, 1, 7, 40, 41, 300)]
    texts += [texts[-1][:200] + "z", texts[-1], texts[-1] + "q"]
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        half = len(t) // 2
        for other, name in ((after, "common_next"), (t[:len(t) - half] + after[:half], "common_edited")):
            same = next((k for k, (x, y) in enumerate(zip(t, other)) if x != y), min(len(t), len(other)))
            assert got[i][name] == same


def test_quality_statistics_cover_all_rows(spark, monkeypatch):
    """The cut is the quantile over all labelled rows, not over the sample."""
    monkeypatch.setattr(quality, "SAMPLE", 60)
    docs = spark.createDataFrame([(i, prose(i, 40) if i % 4 else "!!! $$$ 11 22 " * 8) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id long, quality int")
    from pyspark.sql import functions as F
    got = quality.score(docs, labels, F.lit(False)).collect()
    good = sum(r.predicted for r in got)
    assert 0.97 * 300 <= good <= 300 + 4 and all((r.doc_id % 4 > 0) == bool(r.predicted) for r in got if r.score > 0.6 or r.score < 0.1)


def test_quality_equals_brute_force(spark):
    """Scores from the features, weights on drawn pairs, quantile and spread, all in numpy."""
    texts = [prose(i, 30 + i % 9) if i % 3 else "a1 " * (3 + i % 5) + prose(i, 4).upper() for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 120, 2)], "doc_id long, quality int")
    from pyspark.sql import functions as F
    got = {r.doc_id: r.score for r in quality.score(docs, labels, F.lit(False)).collect()}
    part = pa.RecordBatch.from_arrays([pa.array(range(120), pa.int64()), pa.array([False] * 120), pa.array(texts)],
                                      names=["doc_id", "held_out", "text"])
    f = np.concatenate([quality._features(b.column("f")) for b in quality._measure(iter([part]))])
    mean, scale = f.mean(axis=0), np.sqrt(np.maximum(f.var(axis=0), 1e-12))
    z = np.clip((f - mean) / scale, -6, 6)
    x = np.column_stack([z, z * z])
    known = np.arange(0, 120, 2)
    y = (known % 3 > 0).astype(int)
    w = quality.fit_pairs(x[known][y == 1], x[known][y == 0])
    s = np.sort(x[known] @ w)
    low = s[max(int(np.ceil((1 - y.mean()) * len(s))) - 1, 0)]
    cut = (low + s[s > low].min()) / 2
    want = 1 / (1 + np.exp(-np.clip((x @ w - cut) / max(s.std() / 4, 1e-6) + np.log(quality.CUT / (1 - quality.CUT)), -30, 30)))
    assert [got[i] for i in range(120)] == pytest.approx(want.tolist(), abs=1e-6)
