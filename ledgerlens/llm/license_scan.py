"""License scans by an exact set-similarity join.

A text block is 64 consecutive words of a text, one starting at every 32nd
word, so every run of 33 words lies whole in a block.  A block matches a
template when it holds at least ``CONTAINMENT`` of the template's distinct
words.  Only words of some template can count; they are ordered by how often
all texts use them, rarest first, and for a template of m words that needs o of
them the join uses

* length: a block with fewer than o template words is out;
* prefix: a match shares one of the template's m - o + 1 rarest words;
* position: a block and a template that share the i-th of the template's and
  the j-th of the block's words share at most 1 + min(m - i, |block| - j) (from
  1 on); if that is less than o, this word makes no candidate.

What passes is verified by counting the shared words.  The filters drop no
match: ``tests/llm`` holds the result against all pairs of blocks and templates.

Beside the templates, base phrases are found as consecutive words.

One scan counts the template words (a row per task and word, then Spark's sum;
the driver gets one number per template word), one scan joins; no text is
shuffled.  The templates are a small table of fixed values, or the caller's.

Cases: null and empty texts have no words and a score of 0; rows without an id
and repeated rows each get their row; very long texts are worked on whole;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

CONTAINMENT = 0.9
BLOCK = 64
STEP = 32

#: The phrases every scan reports, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Opening words of well-known license notices, and their labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license unless required by applicable law or "
                   "agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
              "public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                   "associated documentation files to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def _tokens(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _hash(words: list[str]) -> np.ndarray:
    data, offs = W.column_bytes(pa.array(words, pa.string()))
    return W.hashes(data, offs[:-1], offs[1:])


class Index:
    """The templates over words in global order, and the postings of their prefixes."""

    def __init__(self, templates, counts: dict[str, int], containment: float):
        sets = [set(_tokens(text)) for _, text in templates]
        if not all(sets):
            raise ValueError("a template without words")
        order = sorted(set().union(*sets), key=lambda w: (counts.get(w, 0), w))        # rarest first
        place = {w: i for i, w in enumerate(order)}
        h = _hash(order)
        self.by_hash = np.argsort(h)
        self.hashes = h[self.by_hash]
        self.holds = np.zeros((len(sets), len(order)), bool)
        postings = []
        self.size = np.array([len(s) for s in sets])
        self.need = np.array([next(o for o in range(1, len(s) + 1) if o >= containment * len(s)) for s in sets])
        for t, words in enumerate(sets):
            at = sorted(place[w] for w in words)
            self.holds[t, at] = True
            postings += [(w, t, i) for i, w in enumerate(at[:len(at) - self.need[t] + 1])]
        self.word, self.template, self.at = np.array(sorted(postings)).T
        self.first = np.searchsorted(self.word, np.arange(len(order) + 1))

    def words(self, h: np.ndarray) -> np.ndarray:
        """Number of each word in the global order, -1 outside the templates."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.by_hash[at], -1)

    def join(self, block: np.ndarray, word: np.ndarray):
        """(block, template, shared words) of every match, from distinct pairs
        of block and word number, sorted by both."""
        none = np.zeros(0, np.int64)
        if not len(block):
            return none, none, none
        lead = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        size = np.diff(np.append(lead, len(block)))
        own = np.repeat(np.arange(len(lead)), size)
        left = size[own] - (np.arange(len(block)) - lead[own]) - 1                      # words of the block after this one
        many = self.first[word + 1] - self.first[word]
        pair = np.repeat(np.arange(len(word)), many)
        edge = np.concatenate([[0], np.cumsum(many)])[:-1]
        post = np.arange(len(pair)) - edge[pair] + self.first[word][pair]
        t, need = self.template[post], self.need[self.template[post]]
        most = 1 + np.minimum(self.size[t] - self.at[post] - 1, left[pair])
        may = (size[own[pair]] >= need) & (most >= need)
        cand = np.unique(own[pair][may] * len(self.size) + t[may])
        b, t = cand // len(self.size), cand % len(self.size)
        each = np.repeat(np.arange(len(b)), size[b])                                    # verify: words of each candidate block
        edge = np.concatenate([[0], np.cumsum(size[b])])[:-1]
        at = np.arange(len(each)) - edge[each] + lead[b][each]
        shared = np.bincount(each, weights=self.holds[t[each], word[at]], minlength=len(b)).astype(np.int64)
        hit = shared >= self.need[t]
        return block[lead[b[hit]]], t[hit], shared[hit]


def _read(part: pa.RecordBatch):
    data, offs = W.column_bytes(part.column("text"))
    data = W.LOWER[data]
    start, end, first = W.find(data, offs, W.ALNUM)
    return W.hashes(data, start, end), first


def _in_blocks(index: Index, h: np.ndarray, first: np.ndarray):
    """Distinct (block, word) pairs, the text of each block, its number there."""
    word = index.words(h)
    at = np.flatnonzero(word >= 0)
    doc = np.searchsorted(first, at, side="right") - 1
    blocks = -(-np.diff(first) // STEP)                      # blocks of each text
    base = np.concatenate([[0], np.cumsum(blocks)])
    k = (at - first[doc]) // STEP
    keys = []
    for back in range(BLOCK // STEP):                        # every block that covers the word
        ok = k >= back
        keys.append((base[doc[ok]] + k[ok] - back) * index.holds.shape[1] + word[at[ok]])
    pairs = np.unique(np.concatenate(keys))
    return pairs // index.holds.shape[1], pairs % index.holds.shape[1], base


def _count(vocabulary: list[str]):
    def run(batches):
        h = _hash(vocabulary)
        order = np.argsort(h)
        total = np.zeros(len(h), np.int64)
        for part in W.slices(batches, "text"):
            got, _ = _read(part)
            at = np.minimum(np.searchsorted(h[order], got), len(h) - 1)
            total += np.bincount(order[at[h[order][at] == got]], minlength=len(h))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(h))), pa.array(total)], names=["word", "n"])
    return run


def _index(docs: DataFrame, templates, containment: float) -> Index:
    vocabulary = sorted({w for _, text in templates for w in _tokens(text)})
    counted = (docs.select("text").mapInArrow(_count(vocabulary), "word long, n long")
               .groupBy("word").agg(F.sum("n").alias("n")).collect())        # a row per template word
    return Index(templates, {vocabulary[r.word]: r.n for r in counted}, containment)


def matches(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, first_word (of the block), template (its place in ``templates``),
    label, shared words and containment of every match."""
    index = _index(docs, templates, containment)
    labels = np.array([label for label, _ in templates])

    def run(batches):
        for part in W.slices(batches, "text"):
            h, first = _read(part)
            block, word, base = _in_blocks(index, h, first)
            block, t, shared = index.join(block, word)
            doc = np.searchsorted(base, block, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()).take(pa.array(doc)), pa.array((block - base[doc]) * STEP), pa.array(t, pa.int32()),
                 pa.array(labels[t], pa.string()), pa.array(shared), pa.array(shared / index.size[t])],
                names=["doc_id", "first_word", "template", "label", "shared", "containment"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, first_word long, template int, label string, shared long, containment double")


def _places(phrases, h: np.ndarray, first: np.ndarray):
    """Start and phrase of every place where a phrase's words stand in one text."""
    starts, which = [], []
    for p, (text, _) in enumerate(phrases):
        want = _hash(_tokens(text))
        at = np.flatnonzero(W.whole(first, len(h), len(want)))
        for i, w in enumerate(want):
            at = at[h[at + i] == w]
        starts.append(at)
        which.append(np.full(len(at), p))
    return np.concatenate(starts), np.concatenate(which)


def _joined(names: list[str], row: np.ndarray, name: np.ndarray, n: int) -> list[str]:
    """Per row, its distinct names, sorted, with commas."""
    out = [""] * n
    for r, k in sorted({(int(r), names[k]) for r, k in zip(row, name)}):
        out[r] = f"{out[r]},{k}" if out[r] else k
    return out


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score (1 with a base phrase, else the greatest containment of a match, else
    0), and the number of matches, for every row."""
    index = _index(docs, templates, containment)
    names = [label for _, label in phrases] + [label for label, _ in templates]

    def run(batches):
        for part in W.slices(batches, "text"):
            h, first = _read(part)
            n = part.num_rows
            at, phrase = _places(phrases, h, first)
            doc = np.searchsorted(first, at, side="right") - 1
            n_base = np.bincount(doc, minlength=n)
            low, high = np.full(n, len(h)), np.full(n, -1)
            np.minimum.at(low, doc, at - first[doc])
            np.maximum.at(high, doc, at - first[doc])
            block, word, base = _in_blocks(index, h, first)
            block, t, shared = index.join(block, word)
            owner = np.searchsorted(base, block, side="right") - 1
            score = np.minimum(n_base, 1).astype(float)
            np.maximum.at(score, owner, shared / index.size[t])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(np.diff(first)), pa.array(n_base),
                 pa.array(low, mask=n_base == 0), pa.array(high, mask=n_base == 0),
                 pa.array(_joined(names, doc, phrase, n), pa.string()),
                 pa.array(_joined(names, np.concatenate([doc, owner]), np.concatenate([phrase, t + len(phrases)]), n), pa.string()),
                 pa.array(score), pa.array(np.bincount(owner, minlength=n))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_matches"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, n_matches long")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


#: The definition itself: every block against every template, no filter.
SQL = rf"""
WITH phrase AS (SELECT *, len(string_split(p, ' ')) AS m FROM (VALUES {_values(PHRASES)}) AS x(p, label)),
template AS (
  SELECT t, label, list_distinct(string_split(p, ' ')) AS s
  FROM (VALUES {_values((i, label, text) for i, (label, text) in enumerate(TEMPLATES))}) AS x(t, label, p)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
place AS (
  SELECT r, label, i - 1 AS pos
  FROM (SELECT r, w, label, p, m, unnest(range(1, len(w) + 1)) AS i FROM doc CROSS JOIN phrase
        WHERE list_has_all(w, string_split(p, ' ')))
  WHERE array_to_string(w[i:i + m - 1], ' ') = p),
block AS (
  SELECT r, list_distinct(w[b + 1:b + {BLOCK}]) AS s FROM (SELECT r, w, unnest(range(0, len(w), {STEP})) AS b FROM doc)),
hit AS (
  SELECT r, label, len(list_intersect(block.s, template.s)) / len(template.s) AS c FROM block CROSS JOIN template
  WHERE len(list_intersect(block.s, template.s)) >= {CONTAINMENT} * len(template.s)),
base AS (
  SELECT r, count(*) AS n, min(pos) AS low, max(pos) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM place GROUP BY r),
more AS (SELECT r, count(*) AS n, max(c) AS c FROM hit GROUP BY r),
named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM place UNION ALL SELECT r, label FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, low::BIGINT AS first_word, high::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(named.labels, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(more.c, 0)::DOUBLE END AS score, coalesce(more.n, 0)::BIGINT AS n_matches
FROM doc LEFT JOIN base USING (r) LEFT JOIN more USING (r) LEFT JOIN named USING (r)
"""
