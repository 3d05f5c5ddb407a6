"""Prefix trie, license scans and centroid clustering against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from ledgerlens.llm import license_scan, prefix_trie, vafile
from ledgerlens.llm.prefix_trie import Slots

TURNS = "conv_id long, turn long, role string, text string, depth int, k1 int, part string, last int"


def _order(role, text):
    return xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_trie(rows, group=100, heads=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, role.encode(), _signed(_order(role, text))), role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        full[c] = tuple(own.get(c - int(math.fmod(c, group)), [])[:h] + own[c][h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids = defaultdict(set)
    for path in members:
        if path:
            kids[path[:-1]].add(path)

    def under(path):
        leaves, saved = int(not kids[path]), (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        for k in kids[path]:
            a, b = under(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for path, m in members.items():
        ends = sorted(c for c in m if full[c] == path)
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(kids[path]), *under(path),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out)


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, 4, 7, 12])):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn else "user", rng.choice("abcdé") * (turn + 1)))
    for c in range(n, n + 40):                                           # copies, one very common opening
        rows += [(c, t, "user", f"turn {t}") for t in range(9 if c % 3 else 6)]
    rows += [(5, None, None, None), (5, None, "user", None), (6, 1, "user", "same"), (6, 1, "user", "same"), (6, 1, "user", "other"),
             (None, 1, "user", "lost"), (-7, 1, "user", "a"), (n + 300, 1, "user", "x" * 100_000), (1 << 60, 3, "", "")]
    rows += [(n + 301 + k, t, "bot", f"long {t}") for k in range(2) for t in range(300)]
    rng.shuffle(rows)
    return rows


def _trie(spark, rows, **settings):
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], TURNS)
    return sorted((tuple(r) for r in prefix_trie.trie(df, **settings).collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("settings", [{}, {"shard": 20, "bound": 4}, {"shard": 1000, "bound": 60}])
def test_trie_equals_brute_force(spark, settings):
    rows = conversations(1, 260)
    assert _trie(spark, rows, **settings) == brute_trie(rows)


def test_trie_of_one_conversation_over_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(c, t, "user", f"{t % 7}") for c in (3, 104, 205) for t in range(500)] + [(104, 500, "user", "more")]
        assert _trie(spark, rows) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    # 105 takes its only turn from the absent conversation 100, so nothing is left
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(c, 1, "user", "gone")]
    assert _trie(spark, rows) == brute_trie(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert _trie(spark, []) == [] and _trie(spark, [(None, 1, "user", "x")]) == []


def test_ids_of_a_node_span_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = spark.createDataFrame([(1, 2, c) for c in range(100)] + [(1, 3, 7)], "k1 long, k2 long, conv_id long")
    got = {(r.k1, r.k2): r.ends for r in prefix_trie._ended(rows.repartition(3)).collect()}
    assert got == {(1, 2): hashlib.sha256(",".join(map(str, range(100))).encode()).hexdigest(),
                   (1, 3): hashlib.sha256(b"7").hexdigest()}


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    k1, k2 = (rng.integers(1 << 63, size=5000, dtype=np.uint64) for _ in range(2))
    k1[:100] = 7                                                         # only the second half tells these apart
    slots = Slots(k1, k2)
    assert sorted(slots.slot) == list(range(5000)) and (slots.find(k1, k2) == slots.slot).all()
    assert (slots.find(k1, k2 + np.uint64(1)) == -1).all()
    assert len(slots.find(k1[:0], k2[:0])) == 0 and (Slots(k1[:0], k2[:0]).find(k1, k2) == -1).all()
    with pytest.raises(ValueError):
        Slots(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_scan(text, templates, phrases, containment):
    w = _words(text)
    base = [(i, label) for p, label in phrases for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    hits = []
    for b in range(0, len(w), 32):
        block = set(w[b:b + 64])
        for label, t in templates:
            t = set(_words(t))
            if len(block & t) >= containment * len(t):
                hits.append((label, len(block & t) / len(t)))
    at = [i for i, _ in base]
    return (len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})),
            ",".join(sorted({x for _, x in base} | {x for x, _ in hits})), 1.0 if base else max((c for _, c in hits), default=0.0), len(hits))


TEXTS = [None, "", "...", "MIT License", "mit\nLICENSE mit license", "apache licenses", "the gnu general public licens",
         "É MIT Licence cc-by cc.by CC BY-NC 4.0", "licensed under cc by nc 4 0", "cc", "by cc", "x " * 70_000 + "released under the mit license",
         " ".join(license_scan.TEMPLATES[1][1].split()[::-1]), "mit", "license"]


@pytest.mark.parametrize("containment", [0.34, 0.6, 0.9, 1.0])
def test_scan_equals_all_pairs(spark, containment):
    rng = random.Random(3)
    stock = sorted({w for _, t in license_scan.TEMPLATES for w in t.split()}) + ["é", "zz", "q1"]
    texts = TEXTS + [" ".join(rng.choice(stock[:rng.choice([20, 60, 200])]) for _ in range(rng.choice([5, 40, 63, 64, 65, 97, 300])))
                     for _ in range(120)]
    texts += [" ".join(rng.sample(t.split(), len(t.split()) - 1) + ["zz"] * rng.randint(0, 70)) for _, t in license_scan.TEMPLATES]
    rows = [(None if i % 50 == 9 else i // 2, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, template int")
    got = sorted((tuple(r) for r in license_scan.scan(df.repartition(3), containment=containment).collect()), key=repr)
    want = sorted(((i, *brute_scan(t, license_scan.TEMPLATES, license_scan.PHRASES, containment)) for i, t, *_ in rows), key=repr)
    assert got == want


def test_matches_name_block_and_template(spark):
    text = "w " * 100 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated " \
        "documentation files to deal in the Software without restriction"
    df = spark.createDataFrame([(4, text), (5, "clean words")], "doc_id long, text string")
    got = license_scan.matches(df).collect()
    assert {(r.doc_id, r.label) for r in got} == {(4, "mit-notice")} and {r.first_word for r in got} == {64, 96}
    assert all(r.containment == 1.0 for r in got)


def test_scan_of_an_empty_table(spark, empty):
    assert license_scan.scan(empty).count() == 0 and license_scan.matches(empty).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, distance string, cells int"


def brute_clusters(rows, dim, k, rounds=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-(1 << 27), min(1 << 27, math.floor(64 * float(np.float32(x))))) for x in v]))
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        where = [n for _, n in assign()]
        for n in range(len(centroids)):
            own = [v for (_, v), w in zip(kept, where) if w == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    at = assign()
    return sorted(((i, n, d, sum(e for e, m in at if m == n), sum(e for e, _ in at),
                    hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, at)), key=repr)


def _clusters(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], VECTORS).repartition(3)
    return sorted((tuple(r) for r in vafile.cluster(df, **settings).collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_clusters_equal_brute_force(spark, bits):
    rng = random.Random(5)
    middle = [[rng.gauss(0, 2) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.8) for x in rng.choice(middle)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(60)] + [(500, rows[3][1]), (500, rows[3][1]), (None, rows[4][1]), (None, [0.0] * 8)]
    rows += [(600, None), (601, [1.0] * 7), (602, [1.0] * 7 + [None]), (603, [1.0] * 7 + [float("nan")]), (604, [float("inf")] * 8), (605, [])]
    assert _clusters(spark, rows, dim=8, bits=bits) == brute_clusters(rows, 8, 16)


def test_clusters_of_few_equal_or_huge_vectors(spark):
    few = [(i, [float(i), 1.0]) for i in range(5)]
    assert _clusters(spark, few, dim=2) == brute_clusters(few, 2, 16)
    same = [(i, [0.5, -0.5]) for i in range(40)]
    assert _clusters(spark, same, dim=2) == brute_clusters(same, 2, 16)
    huge = [(i, [1e30 if i % 2 else -1e30, 0.1 * i]) for i in range(20)]
    assert _clusters(spark, huge, dim=2) == brute_clusters(huge, 2, 16)
    assert _clusters(spark, []) == [] and _clusters(spark, [(1, [1.0]), (2, None)]) == []


def test_vectors_are_fetched_only_where_intervals_overlap(spark):
    rng = random.Random(6)
    far = [[rng.uniform(-4, 4) for _ in range(64)] for _ in range(16)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in far[i % 16]], 1, 2, "x", 3) for i in range(800)]
    done = vafile.Clustering(spark.createDataFrame(rows, VECTORS))
    assert len(done.fetched) == 3 and all(n < 800 for n in done.fetched)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_license_scans", "op13_centroid_clustering"])
def test_queries_equal_their_sql(spark, sf_small, name):
    from ledgerlens.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    got = QUERIES[name](spark, sf_small)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
