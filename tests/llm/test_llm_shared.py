"""Word arrays, components, written tables."""

import re

import numpy as np
import pyarrow as pa

from ledgerlens.llm import words as W
from ledgerlens.llm.graph import components
from ledgerlens.llm.store import pin

TEXTS = ["a bb  ccc", None, "", " x\ty\n", "Éa bb", "no end ", "bb"]


def test_words_and_hashes_follow_content_only():
    data, offs = W.column_bytes(pa.array(TEXTS))
    start, end, first = W.find(data, offs)
    got = [bytes(data[a:b]).decode() for a, b in zip(start, end)]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]
    assert got == sum(want, []) and list(np.diff(first)) == [len(w) for w in want]
    h = W.hashes(data, start, end)
    assert len({w: x for w, x in zip(got, h)}) == len(set(h)) == len(set(got))


def test_hashes_do_not_depend_on_the_run():
    data, offs = W.column_bytes(pa.array([" ".join(f"w{i % 37}" * (1 + i % 5) for i in range(500)), "x" * 300]))
    start, end, _ = W.find(data, offs)
    assert (W.hashes(data, start, end) == W.hashes(data, start, end, step=50)).all()


def test_adjacent_texts_do_not_join_words():
    data, offs = W.column_bytes(pa.array(["ab", "cd"]))
    assert len(W.find(data, offs)[0]) == 2


def test_windows_equal_where_words_are():
    data, offs = W.column_bytes(pa.array(["p q r s", "z q r s t"]))
    start, end, first = W.find(data, offs)
    h = W.hashes(data, start, end)
    w = W.windows(h, 3)
    assert w[1] == w[5] and w[0] != w[5]
    assert list(np.flatnonzero(W.whole(first, len(h), 3))) == [0, 1, 4, 5, 6]


def test_slices_cut_rows_never_texts():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 7 + ["y" * 100])], names=["text"])
    parts = list(W.slices([batch], "text", limit=25))
    assert [p.num_rows for p in parts] == [2, 2, 2, 1, 1]


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 5), (20, 3), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 10: 10, 11: 10, 30: 30, 31: 30, 32: 30, 33: 30, 34: 30, 35: 30}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pin_keeps_rows_and_cuts_lineage(spark):
    out = pin(spark.range(10).selectExpr("id", "id % 3 as k"))
    assert out.count() == 10 and "Range" not in out._jdf.queryExecution().toString()
