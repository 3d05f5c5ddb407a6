"""Fingerprints, packing and LM scores against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import awkward, prose

from ledgerlens.llm import context_mixing, fingerprint, packing
from ledgerlens.llm.store import held_out, table

# --- 3 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_block", [1024, 2])
def test_edits_follow_the_order_of_ids(spark, odd, rows_per_block):
    got = fingerprint.fingerprints(odd, rows_per_block).collect()
    assert len(got) == len(awkward())
    texts = collections.defaultdict(list)
    for i, t, _ in awkward():
        texts[i].append(t or "")
    for r in got:
        if list(texts).count(r.doc_id) and len(texts[r.doc_id]) > 1:
            continue                                          # ties go by text hash
        own = texts[r.doc_id][0]
        order = sorted(texts, key=lambda i: (i is not None, i or 0))
        after = order[(order.index(r.doc_id) + 1) % len(order)]
        half = len(own) // 2
        options = {hashlib.sha256((own[:len(own) - half] + nxt[:half]).encode()).hexdigest() for nxt in texts[after]}
        assert r.n_chars == len(own) and r.edited_sha256 in options
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_equal_texts_have_equal_fingerprints_and_others_not(odd):
    got = fingerprint.fingerprints(odd).collect()
    of = {r.doc_id: r for r in got}
    assert of[7].fingerprint == of[9].fingerprint != of[8].fingerprint
    assert of[1].fingerprint == of[2].fingerprint
    distinct = {t or "" for _, t, _ in awkward()}
    assert len({r.fingerprint for r in got}) == len(distinct)


def test_likeness():
    def of(t):
        return fingerprint.sketches(fingerprint.points(t), np.array([0, len(t)]))[0]
    a, b = prose(1, 400), prose(2, 400)
    assert fingerprint.likeness(of(a), of(a)) == 1 and fingerprint.likeness(of(""), of("")) == 1
    assert fingerprint.likeness(of(a), of("")) == 0 and fingerprint.likeness(of(a), of(b)) < 0.1
    assert fingerprint.likeness(of(a), of(a[:len(a) // 2] + b[:len(a) // 2])) > 0.3
    near = a[:900] + "zz" + a[902:]
    assert fingerprint.likeness(of(a), of(near)) > 0.8
    assert str(fingerprint.Sketch.parse(str(of(a)))) == str(of(a))
    assert fingerprint.likeness(fingerprint.Sketch.parse(str(of(a))), of(near)) == fingerprint.likeness(of(a), of(near))


def test_spans_and_extensions():
    a, b = "abracadabra" * 9, "xxabracadabra" * 5
    x, y = fingerprint.PrefixHash(a), fingerprint.PrefixHash(b)
    for i in range(0, 40, 3):
        for j in range(0, 40, 5):
            want = next((k for k in range(99) if a[i + k:i + k + 1] != b[j + k:j + k + 1] or i + k >= len(a)), 99)
            assert x.common(i, y, j) == want
            assert x.equal(i, y, j, 3) == (a[i:i + 3] == b[j:j + 3])


def test_fingerprints_of_few(spark, odd, empty):
    assert fingerprint.fingerprints(empty).count() == 0
    one = fingerprint.fingerprints(odd.where("doc_id = 7")).collect()
    text = awkward()[8][1]
    half = len(text) // 2
    assert len(one) == 1 and one[0].near_next == 1
    assert one[0].edited_sha256 == hashlib.sha256((text[:len(text) - half] + text[:half]).encode()).hexdigest()


# --- 4 ---------------------------------------------------------------------------------------

def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids + [0] for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("shard_rows", [2048, 4])
def test_pieces_rebuild_every_document(spark, odd, shard_rows):
    special = spark.createDataFrame([(400, "a <|endoftext|> b  \n\n  c\u3000d\x1c e"), (401, "tab\t\ttab   ")],
                                    "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(special)
    pieces = packing.packed(rows, shard_rows=shard_rows).collect()
    texts = [(r.doc_id, r.text or "") for r in rows.collect()]
    want = collections.Counter()
    for (doc, _), ids in zip(texts, reference_ids([t for _, t in texts])):
        want[doc] += len(ids)
        mine = sorted((p.start, p.length, p.ids_crc32) for p in pieces if p.doc_id == doc and p.doc_tokens == len(ids))
        unique = sorted(set(mine))
        assert [s for s, _, _ in unique][0] == 0 and sum(n for _, n, _ in unique) % len(ids) == 0
        for s, n, crc in unique:
            assert n > 0 and crc == zlib.crc32(np.array(ids[s:s + n], dtype="<u4").tobytes())
    assert collections.Counter({d: sum(p.length for p in pieces if p.doc_id == d) for d, _ in texts}) == want
    filled = collections.defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for parts in filled.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= packing.WINDOW
    shards = len({p.shard for p in pieces})
    assert sum(sum(n for _, n in p) < packing.WINDOW for p in filled.values()) <= shards


def test_queries_match_the_added_token(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgerlens.llm.queries import QUERIES
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>x"), (3, " \n<|endoftext|>\n y  "), (4, "<|endoftext|"),
            (5, "<|endoftext|>"), (6, prose(1, 900) + "<|endoftext|>" + prose(2, 900)), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for pieces in (QUERIES["op4_packing"](spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, str(tmp_path))):
        pieces = pieces.collect()
        for doc, text in rows:
            ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
            mine = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces if p.doc_id == doc)
            assert sum(n for _, n, _, _ in mine) == len(ids)
            assert all(t == len(ids) and c == zlib.crc32(ids[s:s + n].tobytes()) for s, n, c, t in mine)


def test_seed_takes_its_nearest_neighbour():
    a, b = np.arange(100, 400), np.arange(1000, 1300)
    docs = [a, b, np.append(a[:250], 9), np.append(b[:250], 9)]
    first = [d for d, _, _ in packing.pack(docs)[0]]
    assert first[:2] == [0, 2]


def test_neighbours_are_ranked_by_all_terms():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 150, size=rng.integers(40, 200)) for _ in range(60)]
    df = collections.Counter(t for d in docs for t in set(d))
    mean = sum(map(len, docs)) / len(docs)

    def bm25(ask, d):
        tf = collections.Counter(d)
        norm = packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
        return sum(math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (packing.K1 + 1) / (tf[t] + norm)
                   for t in set(ask) if tf[t])
    index = packing.Bm25Shard(docs)
    for seed in (0, 17):
        want = [bm25(docs[seed], d) for d in docs]
        got = index.ask(seed)
        assert len(got) == sum(w > 0 for w in want)
        assert all(want[a] >= want[b] - 1e-9 for a, b in zip(got, got[1:]))
    rest = np.array([i % 2 for i in range(60)])
    before = [d for d in index.ask(17) if rest[d]]
    index.forget(rest)
    assert list(index.ask(17)) == before


def test_packing_of_nothing(empty):
    assert packing.packed(empty).count() == 0


# --- 10 --------------------------------------------------------------------------------------

def test_lm_base_is_exact_and_model_is_a_probability(spark, odd):
    rows = spark.createDataFrame([(1000 + i, prose(i, 200), ) for i in range(60)] + [(r[0], r[1]) for r in awkward()],
                                 "doc_id long, text string")
    got = context_mixing.score(rows, held_out("doc_id", 10, 0)).collect()
    texts = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) + ["\n"])
             for r in rows.collect()]
    out = {d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in texts}
    count = collections.Counter(w for d, ws in texts if not out[d] for w in ws)
    total, kinds = sum(count.values()), len(count)
    want = sorted((str(d), out[d], len(ws), sum(count[w] > 0 for w in ws), total,
                   round(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws), 4)) for d, ws in texts)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def _brute_lm(texts, held, m):
    """Scores by dictionaries: followers and word prefixes counted over the
    training texts; the letter tables, weights and map are the model's."""
    cm, end = context_mixing, b"\n"
    begin, depth, nodes, bits = m.tree
    squash = lambda z: 1 / (1 + math.exp(-min(max(z, -18), 18)))

    def tokens(t):
        return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda x: x[0].lower(), (t or "").encode())) + [end]

    def code(word):
        part = pa.RecordBatch.from_arrays([pa.array([word.decode()]), pa.array([False])], names=["text", "held_out"])
        return next(c for c in cm._slice(part)[2] if word == end or c != cm.END)

    def path(symbol):
        return [(nodes[begin[symbol] + k], bits[begin[symbol] + k]) for k in range(depth[symbol])]

    follow, prefix = collections.defaultdict(collections.Counter), collections.defaultdict(lambda: [0, 0])
    for t, out in zip(texts, held):
        before = end
        for w in [] if out else tokens(t):
            follow[before][w] += 1
            before = w
            whole = w + b" " * (w != end)
            for pos, symbol in enumerate(whole):
                for node, bit in path(symbol):
                    prefix[whole[:pos], node][bit] += 1

    def decided(x, gate, node, bit):
        z = sum(a * b for a, b in zip(x, m.weights[gate]))
        p = (squash(z) + m.refine[node * cm._BINS + min(max(int((z + 9) / 18 * cm._BINS), 0), cm._BINS - 1)]) / 2
        return math.log10(p if bit else 1 - p)

    def rank(value, edges):
        return sum(value > e for e in edges)

    def spelled(w):
        whole, total, step = w + b" " * (w != end), 0.0, 0
        chunk = list(cm._decisions(m.tree, (np.array([code(w)], np.uint64), np.array([len(w)]), np.frombuffer(w, np.uint8))))
        slots = [np.concatenate([c[5][k] for c in chunk]) for k in range(len(cm.SLOTS))]
        for pos, symbol in enumerate(whole):
            for node, bit in path(symbol):
                seen = [[t[2 * s[step]], t[2 * s[step] + 1]] for t, s in zip(m.tables, slots)]
                if pos >= cm.HEAD:
                    seen[0] = prefix[whole[:pos], node]
                x = [math.log((b + cm.PRIOR) / (a + cm.PRIOR)) for a, b in seen] + [0.3]
                gate = rank(sum(seen[0]), [0.5, 1.5, 4, 16, 200]) * 4 + rank(sum(seen[-1]), [0.5, 10, 300])
                total += decided(x, gate, node, bit)
                step += 1
        return total

    of = {}
    out = []
    for t in texts:
        total, before = 0.0, end
        for w in tokens(t):
            seen = follow[before]
            best = sorted(seen, key=lambda f: (-seen[f], cm._follower(np.array([code(f)], np.uint64))[0]))[:2]
            rest, kinds = sum(seen.values()), len(seen)
            for j, f in enumerate(best):
                n, d = seen[f], max(kinds - j, 1)
                x = [math.log((n + cm.PRIOR) / (rest - n + cm.PRIOR)), math.log((max(rest - d, 0) + cm.PRIOR) / (d + cm.PRIOR)),
                     math.log((n + cm.PRIOR) / (d + cm.PRIOR)), 0, 0, 0.3]
                gate = cm._LETTER_GATES + j * cm._WORD_GATES + rank(rest, [1.5, 4, 16, 100]) * 4 + rank(n, [1.5, 4, 16])
                total += decided(x, gate, cm._NODES - 2 + j, f == w)
                rest -= n
                if f == w:
                    break
            if w not in best:
                total += of.setdefault(w, spelled(w))
            before = w
        out.append(total)
    return out


def test_lm_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "BUCKET", 60)                     # several buckets
    texts = [prose(i % 5, 30, 80) for i in range(30)] + [None, "", "A", "né " * 20, "word word word", prose(99, 60, 300)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    held = held_out("doc_id", 10, 0)
    out = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    want = _brute_lm(texts, out, context_mixing.learn(rows, held))
    got = {r.doc_id: r.score for r in context_mixing.score(rows, held).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-3)


def test_lm_scores_with_cut_heads_and_words_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    ends = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 5))) for _ in range(60)]
    texts = [" ".join(rng.choice(["prefi" + rng.choice(ends), "a-common-start-of-words-" + rng.choice(ends), "the " + prose(rng.randint(0, 999), 1, 300) + " the " + rng.choice(ends),
                                  prose(rng.randint(0, 99), 3, 80)]) for _ in range(40)) for i in range(14)] + [None, "", "prefi", "the"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3).cache()
    held = held_out("doc_id", 10, 0)
    out = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    monkeypatch.setattr(context_mixing, "HEAVY", 60)
    monkeypatch.setattr(context_mixing, "SAMPLE", 4)
    m = context_mixing.learn(rows, held)
    cuts, kept = m.common.cuts, m.lexicon.collect()
    assert (cuts["inner"] & (cuts["follow"] == 0)).sum() > 10 and (cuts["follow"] > 0).sum() > 2
    assert len(m.common.words) > 0 and len(m.common.keys) > 100
    assert max(len(r.follow) for r in kept) < 0.15 * sum(len(r.follow) for r in kept)
    want = _brute_lm(texts, out, m)
    got = {r.doc_id: r.score for r in context_mixing.score(rows, held).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-3)


def test_lm_hears_the_order_of_words(spark):
    known = [prose(i, 40, 3000) for i in range(40)]
    words = known[0].split()
    rows = [(i, t) for i, t in enumerate(known)] * 2
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows += [(held[0], known[0]), (held[1], " ".join(sorted(words)))]
    train = [r for r in rows if r[0] >= 1000 or r[0] == 0 or zlib.crc32(str(r[0]).encode()) % 10]
    df = spark.createDataFrame(train, "doc_id long, text string")
    is_held = df.doc_id >= 1000
    got = {r.doc_id: r for r in context_mixing.score(df, is_held).where("held_out").collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score)
    assert got[held[0]].score > 0.6 * got[held[1]].score                   # a known sentence costs far less


def test_lm_grows_with_the_corpus(spark):
    def kept(n):
        df = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(n)], "doc_id long, text string")
        m = context_mixing.learn(df, F.lit(False))
        return sum(len(r.code) + len(r.follow) for r in m.lexicon.collect())
    from pyspark.sql import functions as F
    assert kept(80) > 3 * kept(20)


def test_lm_beats_word_counts_on_held_out_rows(spark):
    held = context_mixing.score(table(spark, "/root/testdata/sf0.01", "documents"), held_out("doc_id", 10, 0)).where("held_out")
    model, base = held.groupBy().sum("score", "base_score").first()
    assert model > base                 # logarithms: the larger, the better


def test_lm_scores_sum_to_one():
    """Over all one-byte continuations of the tree the decisions' probabilities sum to one."""
    begin, depth, nodes, bits = context_mixing.code_tree(np.arange(256) ** 2)
    p = np.linspace(0.01, 0.99, 255)
    total = sum(np.prod([p[n] if b else 1 - p[n] for n, b in zip(nodes[s:s + d], bits[s:s + d])]) for s, d in zip(begin, depth))
    assert total == pytest.approx(1)


def test_lm_without_training_or_rows(spark, odd, empty):
    from pyspark.sql import functions as F
    assert context_mixing.score(empty, F.lit(False)).count() == 0
    got = context_mixing.score(odd.where("doc_id in (1, 2, 5)"), F.lit(True)).collect()
    assert len(got) == 5 and all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 and r.score < 0 for r in got)
