"""Packing of documents into sequences by lexical retrieval.

Each document becomes token ids and an end id.  Whole windows of a long
document are sequences of their own; what is left over (under one window) is
packed: documents are dealt to shards of bounded size, each shard builds a
BM25 inverted index over its leftovers, and a seed takes its unused nearest
neighbours until its window is full.  The last neighbour is cut to fit and
its rest stays in the index, so only the last sequence of a shard is padded.

Cases: null text counts as empty and is packed as its end id; a null doc_id
is a document like any other; repeated rows are packed each; other columns
are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

WINDOW = 1024
END = 0
SHARD_ROWS = 2048   # documents of one shard on average
K1, B = 1.2, 0.75
ADDED = ("<|endoftext|>", 50256)     # the added token of byte_bpe_50k.json

_encoder: dict[str, object] = {}


def encoder(path: str | None = None):
    """The byte-level BPE whose ids ``byte_bpe_50k.json`` gives, from its rank
    table; ``path`` names another table of the same kind."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _encoder:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoder[path] = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                           special_tokens={})
    return _encoder[path]


def encoded(text: str, encode, special_as_text: bool) -> list[int]:
    """Ids of ``text``; unless ``special_as_text``, the added token is matched
    first and what stands between is encoded by itself, as tokenizers does."""
    if special_as_text or ADDED[0] not in text:
        return encode(text)
    parts = [encode(part) for part in text.split(ADDED[0])]
    return parts[0] + [i for part in parts[1:] for i in (ADDED[1], *part)]


def _tokens(path, special_as_text):
    def run(batches):
        encode = encoder(path).encode_ordinary
        for part in W.slices(batches, "text"):
            total, crcs, rest = [], [], []
            for text in part.column("text").to_pylist():
                ids = np.array(encoded(text or "", encode, special_as_text) + [END], dtype="<u4")
                cut = len(ids) // WINDOW * WINDOW
                total.append(len(ids))
                crcs.append([zlib.crc32(ids[i:i + WINDOW].tobytes()) for i in range(0, cut, WINDOW)])
                rest.append(ids[cut:].astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4").tobytes())
            wide = [len(r) == 4 * (t % WINDOW) and t % WINDOW > 0 for r, t in zip(rest, total)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("shard"), pa.array(total, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64())), pa.array(rest, pa.binary()), pa.array(wide, pa.bool_())],
                names=["doc_id", "shard", "doc_tokens", "crcs", "rest", "wide"])
    return run


class Bm25Shard:
    """Inverted index over the leftovers of one shard."""

    def __init__(self, ids: list[np.ndarray]):
        n = len(ids)
        size = np.array([len(x) for x in ids], dtype=np.int64)
        own = np.repeat(np.arange(n), size)
        token = np.concatenate(ids).astype(np.int64) if n else np.zeros(0, np.int64)
        key, tf = np.unique(token * n + own, return_counts=True)
        token, self.own = key // max(n, 1), key % max(n, 1)
        terms, self.start, df = np.unique(token, return_index=True, return_counts=True)
        self.end = self.start + df
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        length = 1 - B + B * size / max(size.mean(), 1) if n else size
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + K1 * length[self.own])
        # terms of each document that others share
        term = np.repeat(np.arange(len(terms)), df)
        shared = df[term] > 1
        order = np.lexsort((term[shared], self.own[shared]))
        self.terms = term[shared][order]
        self.first = np.searchsorted(self.own[shared][order], np.arange(n + 1))
        self.n = n

    def ask(self, doc: int) -> np.ndarray:
        """Documents that share a term with ``doc``, the best by all its terms first."""
        terms = self.terms[self.first[doc]:self.first[doc + 1]]
        if not len(terms):
            return terms
        spans = [slice(self.start[t], self.end[t]) for t in terms]
        own = np.concatenate([self.own[s] for s in spans])
        got = np.bincount(own, weights=np.concatenate([self.weight[s] for s in spans]), minlength=1)
        found = np.flatnonzero(got)
        return found[np.lexsort((found, -got[found]))]

    def forget(self, rest: np.ndarray) -> None:
        """Drop the postings of documents without a rest; weights stay."""
        keep = rest[self.own] > 0
        place = np.concatenate([[0], np.cumsum(keep)])
        self.own, self.weight = self.own[keep], self.weight[keep]
        self.start, self.end = place[self.start], place[self.end]


def pack(ids: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start within its leftover, length)."""
    index = Bm25Shard(ids)
    begin = [0] * len(ids)                       # what of each leftover is packed so far
    rest = [len(x) for x in ids]
    sequences, seed, carry = [], 0, -1
    left = len(ids)                              # documents with a rest when postings were dropped last
    while True:
        alive = len(ids) - rest.count(0)
        if alive < 0.8 * left:
            index.forget(np.array(rest))
            left = alive
        doc = carry if carry >= 0 and rest[carry] else -1        # a cut document seeds the next window
        while doc < 0 and seed < len(ids):
            doc, seed = (seed if rest[seed] else -1), seed + 1
        if doc < 0:
            return sequences
        carry, room, window = -1, WINDOW, []
        near = iter(index.ask(doc))
        fill = seed
        while room and doc >= 0:
            take = min(room, rest[doc])
            window.append((doc, begin[doc], take))
            begin[doc] += take
            rest[doc] -= take
            room -= take
            carry = doc if rest[doc] else -1
            if not room:
                break
            doc = next((int(d) for d in near if rest[d]), -1)    # unused neighbours, the best first
            while doc < 0 and fill < len(ids):                   # none left: the next unused document
                doc, fill = (fill if rest[fill] else -1), fill + 1
        sequences.append(window)


_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, shard int")


def _pack_shard(rows: pa.Table) -> pa.Table:
    rows = rows.combine_chunks().sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending"), ("rest", "ascending")])
    ids = [np.frombuffer(r, dtype="<u4" if w else "<u2").astype("<u4")
           for r, w in zip(rows["rest"].to_pylist(), rows["wide"].to_pylist())]
    shard, total = rows["shard"][0].as_py(), rows["doc_tokens"].to_numpy()
    pieces, sequence = [], shard << 32
    for i, crcs in enumerate(rows["crcs"].to_pylist()):
        for j, crc in enumerate(crcs):
            pieces.append((i, j * WINDOW, WINDOW, crc, sequence, 0))
            sequence += 1
    base = [int(t) - len(x) for t, x in zip(total, ids)]
    for window in pack(ids):
        offset = 0
        for doc, start, length in window:
            crc = zlib.crc32(ids[doc][start:start + length].tobytes())
            pieces.append((doc, base[doc] + start, length, crc, sequence, offset))
            offset += length
        sequence += 1
    doc, start, length, crc, seq, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces))
    return pa.table({"doc_id": rows["doc_id"].take(pa.array(doc)), "start": start, "length": length, "ids_crc32": crc,
                     "doc_tokens": total[doc], "sequence_id": seq, "offset": offset,
                     "shard": np.full(len(doc), shard, dtype=np.int32)})


def packed(docs: DataFrame, tokenizer: str | None = None, shard_rows: int = SHARD_ROWS,
           encode_special_tokens: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and the shard whose index was asked.

    ``encode_special_tokens`` is the setting of that name in tokenizers: true
    spells the added token in a text as ordinary pieces, false (there the
    default, and what the queries use) gives it its id."""
    shards = max(1, -(-docs.count() // shard_rows))
    # the row's place in its scan is part of the hash: rows that repeat an id and text still spread
    shard = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard")
    return (docs.select("doc_id", shard, "text")
            .mapInArrow(_tokens(tokenizer, encode_special_tokens), "doc_id long, shard int, doc_tokens long, crcs array<long>, rest binary, "
                                            "wide boolean")
            .groupBy("shard").applyInArrow(_pack_shard, _SCHEMA))
