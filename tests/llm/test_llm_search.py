"""Decontamination, n-gram join and substring dedup against brute force."""

import collections
import hashlib
import re

import pytest
from conftest_llm import awkward, frame, prose

from ledgerlens.llm import decontamination, ngram_join, substring_dedup


def grams(text, size=5):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


# --- 1 ---------------------------------------------------------------------------------------

def bench_rows():
    item = prose(5, 60)
    words = prose(77, 40).split()
    return [(1, item), (2, " ".join(words)), (3, "too short"), (4, None), (5, ""), (None, prose(3, 30_000)[:900]), (1, item)]


def test_decontamination_is_exact_containment(spark, odd):
    words = prose(77, 40).split()
    some = words[:20] + ["other"] + words[21:]                     # 31 of 36 5-grams left: over 0.8
    few = words[:10] + ["x"] + words[11:20] + ["y"] + words[21:30] + ["z"] + words[31:]
    more = frame(spark, [(20, prose(30, 4000) + " " + " ".join(some) + " " + prose(31, 4000), "en"),
                         (21, " ".join(few), "en"), (22, " ".join(words).upper(), "en")])
    items = spark.createDataFrame(bench_rows(), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in decontamination.search(odd.union(more), items).collect()}
    docs = awkward() + [(20, " ".join(some), ""), (21, " ".join(few), ""), (22, " ".join(words), "")]
    want = {}
    for item, text in dict(bench_rows()).items():
        g = grams(text)
        if len(g) < 2:
            continue
        for doc, body, _ in docs:
            shared = len(g & grams(body))
            if shared >= 0.8 * len(g):
                want[doc, item] = (len(g), shared)
    assert got == want and (20, 2) in got and (22, 2) in got and (21, 2) not in got


def test_decontamination_of_nothing(spark, odd, empty):
    items = spark.createDataFrame(bench_rows(), "item_id long, text string")
    assert decontamination.search(empty, items).count() == 0
    assert decontamination.search(odd, items.limit(0)).count() == 0
    kept = decontamination.clean(odd, items)
    assert kept.columns == odd.columns and not {10, 11, 14} & {r.doc_id for r in kept.collect()}


def test_only_rows_that_hold_an_item_go(spark):
    item = prose(5, 60)
    rows = [(1, item, "en"), (1, prose(50, 80), "en"), (None, prose(51, 20) + " " + item, "en"), (None, prose(52, 80), "en"),
            (None, None, "en"), (2, prose(53, 80), "en")]
    kept = decontamination.clean(frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(((i, t) for i, t, _ in (rows[1], *rows[3:])), key=str)


def test_seeds_that_must_agree():
    from math import comb
    for _, seeds in decontamination.SEEDS:
        need = decontamination.agreeing(seeds, 0.8)
        miss = sum(comb(seeds, k) * 0.8 ** k * 0.2 ** (seeds - k) for k in range(need))
        assert need > 1 and miss <= decontamination.MISS


def test_decontamination_runs_no_python(spark, odd):
    items = spark.createDataFrame(bench_rows(), "item_id long, text string")
    plan = decontamination.search(odd, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


# --- 2 ---------------------------------------------------------------------------------------

def expected_classes(rows):
    sets = [grams(t) for _, t, _ in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    named = collections.defaultdict(list)
    for i in range(len(rows)):
        named[find(i)].append(rows[i][0])
    return sorted(((rows[i][0], min((x for x in named[find(i)] if x is not None), default=None), links[i])
                   for i in range(len(rows))), key=str)


def near_copies(n):
    words = prose(40, 300).split()
    out = []
    for k in range(n):
        w = list(words)
        for at in {(k * 37) % 300, (k * 91) % 300}:
            w[at] = f"edit{k}"
        out.append((100 + k, " ".join(w), "en"))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_join_is_exact(spark, monkeypatch, block):
    """With tiny blocks the group of near copies is verified in many squares."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = awkward() + near_copies(30) + [(200, near_copies(1)[0][1], "en")] * 3
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(frame(spark, rows)).collect()), key=str)
    assert got == expected_classes(rows)


def test_join_of_nothing_and_one_of_each(spark, odd, empty):
    assert ngram_join.join(empty).count() == 0
    kept = ngram_join.one_of_each(odd)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert kept.columns == odd.columns and 7 in ids and not {8, 9} & set(ids) and ids.count(5) == 3


def test_one_of_each_is_decided_row_by_row(spark):
    def near(seed, edit=None):
        w = prose(seed, 200).split()
        return " ".join(w if edit is None else w[:edit] + ["edited"] + w[edit + 1:])
    rows = [(7, near(601), "en"), (7, near(602), "en"), (3, near(601, 90), "en"), (9, near(602, 50), "en"),
            (None, near(603), "en"), (None, near(604), "en"), (11, near(604, 20), "en"),
            (None, near(605), "en"), (None, near(605, 70), "en"), (None, near(605), "fr"),
            (None, near(606), "en"), (None, near(606), "en"), (None, "", "en"), (None, "", "en")]
    out = ngram_join.one_of_each(frame(spark, rows))
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == frame(spark, rows).columns
    assert sorted(d for d, _ in kept if d is not None) == [3, 7, 11] and (7, near(602)) in kept
    bare = collections.Counter(t for d, t in kept if d is None)
    assert bare[near(603)] == 1 and bare[near(604)] == 0 and bare[""] == 2
    assert bare[near(605)] + bare[near(605, 70)] == 1 and bare[near(606)] == 1


def test_banding_reaches_its_recall():
    bands, rows = ngram_join.banding()
    assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8 ** rows) ** bands >= ngram_join.RECALL


# --- 5 ---------------------------------------------------------------------------------------

def expected_removals(rows):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    for i in order:
        for s in range(len(words[i]) - 19):
            key, at = tuple(words[i][s:s + 20]), (rows[i][0], s)
            first.setdefault(key, at)
    for i, (doc, _, _) in enumerate(rows):
        w, gone, own = words[i], set(), set()
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            if first[key][0] != doc or key in own:
                gone |= set(range(s, s + 20))
            own.add(key)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_dedup_is_exact(spark):
    rows = awkward() + near_copies(6) + [(300, prose(50, 19), "en"), (301, prose(50, 19), "en"), (302, prose(51, 20), "en"),
                                         (303, "x " + prose(51, 20) + " y", "en")]
    got = sorted((tuple(r) for r in substring_dedup.dedup(frame(spark, rows)).collect()), key=str)
    assert got == expected_removals(rows)


def test_cleaned_texts(spark, odd, empty):
    kept = {r.doc_id: r for r in substring_dedup.cleaned(odd).collect()}
    assert 9 not in kept and kept[7].text == awkward()[8][1] and kept[11].n_chars == len(kept[11].text) < 400
    assert kept[2].text == "" and kept[3].text == " \n\t " and kept[7].row == 7
    assert substring_dedup.cleaned(odd).columns == odd.columns
    assert substring_dedup.dedup(empty).count() == 0 == substring_dedup.cleaned(empty).count()


def test_queries_equal_their_sql(spark):
    import duckdb

    from ledgerlens.llm.queries import ORACLE_SQL, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, sf)
        rel = con.sql(sql)
        columns = sorted(got.columns)
        assert columns == sorted(rel.columns), name
        mine = sorted(tuple(r[c] for c in columns) for r in got.collect())
        theirs = sorted(tuple(dict(zip(rel.columns, r))[c] for c in columns) for r in rel.fetchall())
        assert mine == theirs, name
