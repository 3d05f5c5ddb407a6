"""The pipeline against brute force, stage by stage, and whole."""

import collections
import re

import pytest
from conftest_llm import awkward, prose
from test_llm_search import expected_classes, expected_removals, grams, near_copies
from test_llm_text import reference_ids

import corpus_pipeline as cp
from ledgerlens.llm.store import pin

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, key int"


def written(spark, folder, rows, labels, items):
    spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), "x", 1) for i, t, g in rows], DOCS) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    rude = ["blorgh", "zzwump", "kwexx"]
    toxic = [(1000 + i, prose(500 + i, 60) + f" {rude[i % 3]} " + prose(900 + i, 40) + f" {rude[(i + 1) % 3]}", "en") for i in range(40)]
    clean = [(2000 + i, prose(1500 + i, 100), "en") for i in range(120)]
    item = prose(77, 40)
    rows = awkward() + near_copies(8) + toxic + clean + [(3000, prose(70, 30) + " " + item + " " + prose(71, 30), "fr")]
    labels = [(i, 1, 1) for i, _, _ in toxic] + [(i, 1, 0) for i, _, _ in clean]
    sf = written(spark, tmp_path_factory.mktemp("corpus"), rows, labels, [(1, item), (2, None), (3, "short")])
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        docs = out[name] = pin(stage(spark, docs, sf))
    return sf, rows, out


def kept(frame):
    return [(r.doc_id, r.text, r.lang) for r in frame.collect()]


def test_whole_documents_until_the_last_stage(staged):
    _, _, out = staged
    assert all(tuple(out[name].columns) == cp.COLUMNS for name, _ in cp.STAGES[:-1]) and 4 <= len(cp.STAGES) <= 5


def test_toxic_rows_go_and_clean_rows_stay(staged):
    _, rows, out = staged
    ids = collections.Counter(r[0] for r in kept(out["toxicity"]))
    assert ids == collections.Counter(i for i, _, _ in rows if i is None or not 1000 <= i < 2000)


def test_one_of_each_group_stays(staged):
    _, _, out = staged
    before = kept(out["toxicity"])
    named = collections.Counter((d, c) for d, c, _ in expected_classes(before))
    want = sorted((d for (d, c), n in named.items() for _ in range(n) if d == c), key=str)
    assert sorted((r[0] for r in kept(out["ngram_jaccard_join"])), key=str) == want


def test_repeats_are_cut(staged):
    _, _, out = staged
    before = kept(out["ngram_jaccard_join"])
    words = {str(d): (n, gone) for d, n, gone, _ in expected_removals(before)}
    after = collections.defaultdict(list)
    for d, t, _ in kept(out["substring_dedup"]):
        after[str(d)].append(len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    for d, (n, gone) in words.items():
        if d != "5":                                     # several rows share this id
            assert after[d] == ([] if n and n == gone else [n - gone])
    untouched = {d for d, (_, gone) in words.items() if not gone}
    texts = {str(d): t or "" for d, t, _ in before}
    assert all((t == texts[str(d)]) for d, t, _ in kept(out["substring_dedup"]) if str(d) in untouched and d != 5)


def test_benchmark_rows_go(staged):
    _, _, out = staged
    item = grams(prose(77, 40))
    before, after = kept(out["substring_dedup"]), kept(out["benchmark_decontamination"])
    want = sorted((d for d, t, _ in before if len(item & grams(t)) < 0.8 * len(item)), key=str)
    assert sorted((d for d, _, _ in after), key=str) == want and 3000 not in want


def test_run_returns_the_pieces_of_what_is_left(spark, staged):
    sf, _, out = staged
    rows = kept(out["benchmark_decontamination"])
    tokens = sum(map(len, reference_ids([t for _, t, _ in rows])))
    pieces = cp.run(spark, sf).collect()
    assert sum(p.length for p in pieces) == tokens
    assert sorted(map(tuple, pieces), key=str) == sorted(map(tuple, out["packing"].collect()), key=str)


def test_empty_tables(spark, tmp_path):
    sf = written(spark, tmp_path, [], [], [])
    assert cp.run(spark, sf).count() == 0
