"""Language-model scores by logistic context mixing.

A document is its tokens: words, then one end.  Every token is a walk of binary
decisions, each predicted by several hashed contexts whose predictions are
mixed as logits, with weights chosen by a gate (how much the strongest
contexts have seen); the mixed probability is refined by an adaptive map.

* Context over the text, the word before: is this token the commonest follower
  of that word?  If not, the second commonest?  Predicted from the followers'
  counts (``Followers``).
* If neither, the token is spelled in bytes and closed by a space; every byte is
  a walk down one code tree.  Contexts: the word so far, and the last 1, 2, 3
  and 4 bytes.

What a word is spelled for depends on the word alone and what a follower costs
on the pair alone, so each distinct word and pair of the corpus is scored once:

1. documents become blocks: token ids into the block's own sorted dictionary
   (written), and for every word of it the followers it has there (dealt; the
   texts are scanned twice, which must give the same rows in the same order, as
   tables do);
2. dictionaries are dealt by word code into buckets and merged: training counts
   of every word and pair of the corpus, and each block's places.  A code begins
   with the hash of the word's first ``HEAD`` bytes, so words that share them
   meet in one bucket, where the contexts "word so far" from that length on and
   all followers are counted exactly, in arrays as large as what they count.
   Where that is too much for one bucket, it is cut by the bytes after the head,
   and a word's followers by theirs: then buckets tell what they count of the
   prefixes and words beside a cut, and all get the sums (``Common``);
3. buckets add up the counts of the short letter contexts, then fit weights and
   map online, each occurrence judged without itself;
4. buckets answer each block with its words' and pairs' log-probabilities; a
   block sums them per document.

So the model grows with the corpus: word counts, pairs and word prefixes stay
in the buckets.  What reaches the driver: samples that place the cuts (40 bytes
for each ``SAMPLE`` of a block), and for each cut the counts of a few prefixes and
at most one word.  Only contexts of at most four bytes have tables of fixed size (``SLOTS``, sent to the
executors): there are no more of them however long the corpus is, as far as
the alphabet goes; contexts that share a slot share their counts.

Memory: a block holds ``BLOCK`` bytes of text at most (one longer text is a
block of its own), a bucket about ``BUCKET`` dictionary entries with their
pairs, or up to about twice ``HEAVY`` of spelled bytes and pairs, but at least
what all blocks have of the words with the same first 21 bytes, or of one word's
followers with the same first five.

Cases: null text is an empty one (one end token); a null doc_id is a training
row; repeated rows each get their row; with nothing to train on the base score
is 0 and every decision is even; words of any length are spelled whole; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import ctypes
import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import few_rows, pin, tidy, unpin

BLOCK = 8 << 20
BUCKET = 25_000
ROW_GROUP = 16 << 20
SCAN = 2048                                  # documents that a scan hands over at a time
HEAD = 4                                    # bytes from which on "word so far" is counted exactly
HEAVY = 1 << 19                             # bytes spelled and pairs of blocks in a cut bucket; up to twice that is not cut
SAMPLE = 1 << 15                            # of these one in so many is told to the driver, to place the cuts
ORDERS = (1, 2, 3, 4)                       # bytes of the letter contexts
SLOTS = (20, 16, 18, 19, 20)                # table sizes: word so far below HEAD, then ORDERS
PRIOR = 0.4
_SYMBOLS = 1 << 15                          # bytes spelled at once
_ROWS = 4096
_LOW = np.uint64((1 << 40) - 1)             # bits of a code below those of its head
_KEY = 24                                   # bytes that order words: three of the head's hash, then the word's first 21
_PLACE = np.dtype([("key", f"S{_KEY}"), ("code", "<u8"), ("follow", "<u8"), ("inner", "?")])
_RIM = np.dtype([("cut", "<i4"), ("size", "u1"), ("symbol", "u1"), ("n", "<f8")])
_PART = np.dtype([("code", "<u8"), ("all", "<f8"), ("distinct", "<f8"), ("n", "<f8", 2), ("follow", "<u4", 2)])
END = np.uint64(0xD1B54A32D192ED03)
_WIDTH = len(SLOTS) + 1                     # predictions mixed: contexts and a constant
_LETTER_GATES = 24
_WORD_GATES = 20
_GATES = _LETTER_GATES + 2 * _WORD_GATES
_BINS = 24
_SURE = 1e-6                                # a follower costs at least this: 16-bit floats keep it from zero
_NODES = 258                                # of the code tree, then the first and the second follower


def _follower(code: np.ndarray) -> np.ndarray:
    """What tells the followers of one word apart: 32 mixed bits of the code."""
    return (W.mix(code) >> np.uint64(32)).astype("<u4")


def _let_go() -> None:
    """Freed memory goes back to the system: workers stay while their executor's JVM goes on."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    edge = np.concatenate([[0], np.cumsum(length)])
    return data[np.repeat(start - edge[:-1], length) + np.arange(edge[-1])]


def _slice(part: pa.RecordBatch):
    """Tokens of some texts: per text its token count; per token its dictionary
    place; the dictionary (code, training count, length, word)."""
    data, offs = W.column_bytes(part.column("text"))
    data = W.LOWER[data]
    start, end, first = W.find(data, offs)
    h = W.hashes(data, start, end)
    head = W.hashes(data, start, np.minimum(end, start + HEAD))
    n_docs, n_words = len(offs) - 1, np.diff(first)
    # an end after the words of each text: its word is one line feed after the data
    at = np.arange(len(h)) + W.owner(first)
    last = np.cumsum(n_words + 1) - 1
    code, s, e = (np.empty(len(h) + n_docs, t) for t in (np.uint64, np.int64, np.int64))
    code[at], s[at], e[at] = head & ~_LOW | h >> np.uint64(24), start, end
    code[last], s[last], e[last] = END, len(data), len(data) + 1
    own = np.repeat(np.arange(n_docs), n_words + 1)
    train = ~part.column("held_out").to_numpy(zero_copy_only=False)
    entry, pick, place = np.unique(code, return_index=True, return_inverse=True)
    count = np.bincount(place, weights=train[own], minlength=len(entry)).astype(np.int64)
    length = (e - s)[pick]
    return n_words + 1, place, entry, count, length, _gather(np.append(data, np.uint8(10)), s[pick], length)


def _merge(entries, counts, lengths, words):
    """One sorted dictionary out of several, and the places of their entries."""
    entry = np.concatenate(entries)
    length = np.concatenate(lengths)
    merged, pick, place = np.unique(entry, return_index=True, return_inverse=True)
    count = np.bincount(place, weights=np.concatenate(counts), minlength=len(merged)).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(length)])[:-1]
    return merged, count, length[pick], _gather(np.concatenate(words), start[pick], length[pick]), place


def _keys(code: np.ndarray, length: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Bytes that order words: the head's hash, then the first bytes of the
    word (zeros beyond its end).  Words with a common prefix stand together."""
    key = np.zeros((len(code), _KEY), np.uint8)
    key[:, :3] = code.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :3]
    start, has = np.cumsum(length) - length, np.arange(len(code))
    for j in range(_KEY - 3):
        has = has[length[has] > j]
        key[has, 3 + j] = words[start[has] + j]
    return key


def _first(key: np.ndarray) -> np.ndarray:
    """The first eight bytes of keys as numbers: they ascend as keys do."""
    return key.view(">u8")[::_KEY // 8].astype(np.uint64)


def _pairs(ids: np.ndarray, entries: int, end: int):
    """Of a block's tokens: distinct (word before, word) as one number, and
    which of them each token is.  Before a text's first word stands an end."""
    before = np.concatenate([[end], ids[:-1]])
    return np.unique(before.astype(np.int64) * entries + ids, return_inverse=True)


def _blocks(batches):
    """Blocks of the scanned texts: number, rows (without text), tokens per row,
    token ids, the dictionary (code, count, length, words) by key, then code, and
    its keys.  Which rows make a block depends on the scan alone, so two scans
    give the same blocks."""
    number, held, size = 0, [], 0

    def close():
        nonlocal number
        entry, count, length, words, place = _merge(*[[x[k] for _, x in held] for k in (2, 3, 4, 5)])
        shift = np.cumsum([0] + [len(x[2]) for _, x in held])
        key = _keys(entry, length, words)
        order = np.lexsort(key.view(">u8").astype(np.uint64).T[::-1])             # stable: equal keys stay by code
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order))
        ids = rank[place][np.concatenate([x[1] + o for (_, x), o in zip(held, shift)])]
        words = _gather(words, (np.cumsum(length) - length)[order], length[order])
        entry, count, length, key = entry[order], count[order], length[order], key[order].view(f"S{_KEY}").ravel()
        block = (TaskContext.get().partitionId() << 24) + number
        number += 1
        rows = [pa.chunked_array([p.column(c) for p, _ in held]).combine_chunks() for c in ("doc_id", "held_out")]
        return block, rows, np.concatenate([x[0] for _, x in held]), ids, (entry, count, length, words), key

    for part in W.slices(batches, "text"):
        for at in range(0, part.num_rows, _ROWS):
            rows = part.slice(at, _ROWS)
            bytes_ = int(W.column_bytes(rows.column("text"))[1][-1])
            if held and size + bytes_ > BLOCK:
                yield close()
                held, size = [], 0
            held.append((rows.drop_columns(["text"]), _slice(rows)))
            size += bytes_ + rows.num_rows
    if held:
        yield close()
    held = []
    _let_go()


_LOAD = "block long, entries long, doc_id array<long>, held_out array<boolean>, tokens array<long>, low binary, high binary, sample binary"


def _sample(block: int, ids, code, length, key, stride: int) -> np.ndarray:
    """Places of one in ``stride`` of a block's spelled bytes and of its pairs."""
    salt, n = W.mix(np.array([block], np.uint64))[0], np.uint64(len(code))
    spelled = np.cumsum(length + 1)
    at = np.searchsorted(spelled, np.arange(int(salt) % stride, spelled[-1], stride), side="right")
    pair = np.concatenate([ids[-1:], ids[:-1]]).astype(np.uint64) * n + ids
    pair = np.unique(pair[W.mix(pair ^ salt) < np.uint64((1 << 64) // stride)])
    out = np.zeros(len(at) + len(pair), _PLACE)
    word = np.concatenate([at, (pair // n).astype(np.int64)])
    out["key"], out["code"] = key[word], code[word]
    out["follow"][len(at):] = _first(key[(pair % n).astype(np.int64)])
    return out


def _load(stride: int):
    """What a block keeps until its answers come: its rows and token ids; and
    samples of its words and pairs."""
    def run(batches):
        for block, (docs, out), many, ids, (code, _, length, _), key in _blocks(batches):
            sample = _sample(block, ids, code, length, key, stride)
            ids = ids.view("<u2").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([len(code)]), pa.array([docs.cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                 pa.array([out.to_pylist()], pa.list_(pa.bool_())), pa.array([many], pa.list_(pa.int64())),
                 pa.array([ids[:, 0].tobytes()], pa.binary()), pa.array([ids[:, 1].astype("<u2").tobytes()], pa.binary()),
                 pa.array([sample.tobytes()], pa.binary())],
                names=[f.split()[0] for f in _LOAD.split(", ")])
    return run


def _cuts(sample: np.ndarray, buckets: int, heavy: int, stride: int) -> np.ndarray:
    """Where the buckets after the first begin: equal ranges of the heads, and
    those of more than twice ``heavy`` cut further at a word's key (it and all
    after it go right), or among the followers of a word that is heavy itself
    (its followers from that key on go right, and all words after its key)."""
    plain = np.zeros(buckets - 1, _PLACE)
    plain["key"] = [((i << 24) // buckets).to_bytes(3, "big") for i in range(1, buckets)]
    sample = sample[np.lexsort((sample["follow"], sample["code"], sample["key"]))]
    each = max(1, heavy // stride)
    _, of, often = np.unique(sample["code"], return_inverse=True, return_counts=True)
    edge = np.concatenate([[0], np.searchsorted(sample["key"], plain["key"]), [len(sample)]])
    at = [k for i in np.flatnonzero(np.diff(edge) > 2 * each) for k in range(edge[i] + each, edge[i + 1] - each // 2, each)]
    inner = sample[at]
    light = (often[of[at]] < max(2, each // 2)) | (inner["follow"] == 0)
    inner["code"][light] = inner["follow"][light] = 0
    inner["inner"] = True
    return np.unique(np.concatenate([plain, inner]))


_PIECE = ("code", "count", "length", "words", "before", "fan", "follow", "times")


def _deal(cuts):
    """Entries of each block's dictionary, with their followers, by bucket.  A
    piece whose followers are not those of all its words and of no others names
    the words before (``before``)."""
    def run(batches):
        place = cuts.value
        within = np.flatnonzero(place["follow"])
        for block, (_, out), many, ids, (code, count, length, words), key in _blocks(batches):
            pair, which = _pairs(ids, len(code), int(ids[-1]))             # the last token is an end
            train = np.repeat(~out.to_numpy(zero_copy_only=False), many)
            times = np.bincount(which, weights=train, minlength=len(pair)).astype("<u4")
            fan = np.bincount(pair // len(code), minlength=len(code))
            after = pair % len(code)
            follow = _follower(code)[after]
            del pair, which, train
            at, link = (np.concatenate([[0], np.cumsum(x)]) for x in (length, fan))
            cut = np.searchsorted(key, place["key"])
            tie = np.searchsorted(key, place["key"][within], side="right")
            part = link[cut]
            first = _first(key) if len(within) else None
            for k, lo, hi, c, f in zip(within, cut[within], tie, place["code"][within], place["follow"][within]):
                w = lo + int(np.searchsorted(code[lo:hi], c))
                has = w < hi and code[w] == c
                part[k] = link[w] + (np.searchsorted(first[after[link[w]:link[w + 1]]], f) if has else 0)
            cut[within] = tie
            del after, first
            cut, part = np.concatenate([[0], cut, [len(code)]]), np.concatenate([[0], part, [len(times)]])
            rows = []
            for k in np.flatnonzero((np.diff(cut) > 0) | (np.diff(part) > 0)):
                (x, y), (p, q) = cut[k:k + 2], part[k:k + 2]
                before, some = None, fan[x:y]
                if p != link[x] or q != link[y]:
                    u = int(np.searchsorted(link, p, side="right")) - 1
                    v = max(u, int(np.searchsorted(link, q)))
                    before, some = code[u:v].astype("<u8").tobytes(), np.diff(np.clip(link[u:v + 1], p, q))
                rows.append((int(k), block, code[x:y].astype("<u8").tobytes(), count[x:y].astype("<u4").tobytes(),
                             length[x:y].astype("<u4").tobytes(), words[at[x]:at[y]].tobytes(), before, some.astype("<u4").tobytes(),
                             follow[p:q].tobytes(), times[p:q].tobytes()))
                if len(rows) == 32:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return run


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), *[pa.binary()] * len(_PIECE)))],
        names=["bucket", "block", *_PIECE])


_BUCKET_FIELDS = ("bucket int, code binary, count binary, length binary, words binary, blocks array<long>, sizes array<long>, "
                  "places binary, outside binary, owners binary, fan binary, follow binary, times binary, pairs array<long>, "
                  "rims binary, parts binary, words_seen long, tokens_seen long")


def _bucket(cuts):
    """The pieces of a bucket merged: its words, each block's places; the words
    before its pairs (``owners``: places, then ``outside``) where they are not
    the same; what the cuts beside it have here of common prefixes and words."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        bucket = rows["bucket"][0].as_py()
        code, count, length, words = ([np.frombuffer(x, t) for x in rows[c].to_pylist()] for c, t in (
            ("code", "<u8"), ("count", "<u4"), ("length", "<u4"), ("words", "u1")))
        sizes, pieces = [len(c) for c in code], code
        code, count, length, words, place = _merge(code, count, [x.astype(np.int64) for x in length], words)
        outside, owners = code[:0], None
        if rows["before"].null_count < len(rows):
            before = np.concatenate([c if b is None else np.frombuffer(b, "<u8") for b, c in zip(rows["before"].to_pylist(), pieces)])
            outside = np.setdiff1d(before, code)
            all_ = np.concatenate([code, outside])
            order = np.argsort(all_)
            owners = order[np.searchsorted(all_, before, sorter=order)]
        fan, follow, times = (b"".join(rows[c].to_pylist()) for c in ("fan", "follow", "times"))
        beside = [k for k in (bucket - 1, bucket) if 0 <= k < len(cuts.value) and cuts.value["inner"][k]]
        rims = _rims(cuts.value, beside, code, count, length, words)
        parts = _parts(cuts.value, beside, np.concatenate([code, outside]), place if owners is None else owners,
                       *(np.frombuffer(x, "<u4") for x in (fan, follow, times)))
        return pa.table({
            "bucket": rows["bucket"].slice(0, 1), "code": [code.astype("<u8").tobytes()],
            "count": [count.astype("<u8").tobytes()], "length": [length.astype("<u4").tobytes()], "words": [words.tobytes()],
            "blocks": pa.array([rows["block"].to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([sizes], pa.list_(pa.int64())), "places": [place.astype("<u4").tobytes()],
            "outside": [outside.astype("<u8").tobytes()], "owners": pa.array([None if owners is None else owners.astype("<u4").tobytes()], pa.binary()),
            "fan": [fan], "follow": [follow], "times": [times],
            "pairs": pa.array([[len(x) // 4 for x in rows["follow"].to_pylist()]], pa.list_(pa.int64())),
            "rims": [rims.tobytes()], "parts": [parts.tobytes()],
            "words_seen": [int((count > 0).sum())], "tokens_seen": [int(count.sum())]})
    return run


def _rims(cuts, beside, code, count, length, words) -> np.ndarray:
    """Of each prefix of the keys of the cuts beside a bucket, how often each
    symbol comes next here: words on both sides of a cut share no others."""
    out, told = [np.zeros(0, _RIM)], set()
    start = np.cumsum(length) - length
    key = _keys(code, length, words) if beside else None
    for k in beside:
        mark = np.frombuffer(cuts["key"][k].ljust(_KEY, b"\0"), np.uint8)
        common = np.logical_and.accumulate(key == mark, axis=1).sum(axis=1) - 3
        for size in range(HEAD, _KEY - 3):
            with_ = np.flatnonzero((common >= size) & (length >= size))
            if not len(with_):
                break
            if (prefix := mark[:3 + size].tobytes()) in told:
                continue
            told.add(prefix)
            longer = length[with_] > size
            symbol = np.full(len(with_), 0x20, np.uint8)
            symbol[longer] = words[start[with_[longer]] + size]
            n = np.bincount(symbol, weights=count[with_], minlength=256)
            some = np.zeros(np.count_nonzero(n), _RIM)
            some["cut"], some["size"], some["symbol"], some["n"] = k, size, np.flatnonzero(n), n[n > 0]
            out.append(some)
    return np.concatenate(out)


def _parts(cuts, beside, code, owners, fan, follow, times) -> np.ndarray:
    """Of each word with a cut among its followers: its occurrences, distinct
    followers and two commonest followers here."""
    out = []
    for c in {int(cuts["code"][k]) for k in beside if cuts["follow"][k]}:
        mine = np.repeat(code[owners] == np.uint64(c), fan)
        kind, which = np.unique(follow[mine], return_inverse=True)
        n = np.bincount(which, weights=times[mine], minlength=len(kind))
        best = np.lexsort((kind, -n))[:2]
        best = best[n[best] > 0]
        if len(best):
            row = np.zeros(1, _PART)
            row["code"], row["all"], row["distinct"] = c, n.sum(), np.count_nonzero(n)
            row["n"][0, :len(best)], row["follow"][0, :len(best)] = n[best], kind[best]
            out.append(row)
    return np.concatenate([np.zeros(0, _PART), *out])


class Common:
    """What buckets have in common across the cuts: counts of the prefixes
    that words on both sides of a cut share; of the words with a cut among
    their followers, all occurrences, distinct followers, and the two
    commonest (count, follower, bucket)."""

    def __init__(self, cuts, tree, found):
        self.cuts, self.words, self.prefixes = cuts, {}, {}
        begin, depth, nodes, bits = tree
        number, rims = {}, np.concatenate([np.zeros(0, _RIM), *[np.frombuffer(x, _RIM) for _, x, _ in found]])
        keys, which = np.unique(rims["cut"].astype(np.int64) * 32 + rims["size"], return_inverse=True)
        named = [cuts["key"][k // 32].ljust(_KEY, b"\0")[3:3 + k % 32] for k in keys]
        for p in named:
            number.setdefault(p, len(number))
        of = np.array([number[p] for p in named], np.int64)[which]
        many = depth[rims["symbol"]]
        rep = np.repeat(np.arange(len(rims)), many)
        step = begin[rims["symbol"]][rep] + np.arange(len(rep)) - (np.cumsum(many) - many)[rep]
        pair, which = np.unique(of[rep] * 256 + nodes[step], return_inverse=True)
        n = np.bincount(2 * which + bits[step], weights=rims["n"][rep], minlength=2 * len(pair))
        self.counts = n[::2], n[1::2]
        hashes = np.array([W.spans(*W.prefix(np.frombuffer(p, np.uint8).astype(np.uint64) + np.uint64(1), W._BYTES),
                                   np.array([0]), np.array([len(p)]))[0] for p in number], np.uint64)
        self.keys = _salted(hashes[pair // 256], pair % 256)
        self.edge = np.searchsorted(pair, np.arange(len(number) + 1) * 256)
        for k in np.flatnonzero(cuts["inner"]):
            mark = cuts["key"][k].ljust(_KEY, b"\0")[3:]
            self.prefixes[int(k)] = [number[p] for p in (mark[:size] for size in range(HEAD, _KEY - 3)) if p in number]
        for bucket, _, parts in found:
            for row in np.frombuffer(parts, _PART):
                best = [(float(n), int(f), bucket) for n, f in zip(row["n"], row["follow"]) if n]
                all_, distinct, old = self.words.get(int(row["code"]), (0.0, 0.0, []))
                self.words[int(row["code"])] = (all_ + float(row["all"]), distinct + float(row["distinct"]),
                                                sorted(old + best, key=lambda x: (-x[0], *x[1:]))[:2])

    def _beside(self, bucket: int):
        return [k for k in (bucket - 1, bucket) if 0 <= k < len(self.cuts) and self.cuts["inner"][k]]

    def contexts(self, bucket: int) -> np.ndarray:
        """Which keys and counts concern a bucket."""
        of = sorted({p for k in self._beside(bucket) for p in self.prefixes[k]})
        return np.concatenate([np.zeros(0, np.int64), *[np.arange(self.edge[p], self.edge[p + 1]) for p in of]])

    def shared(self, bucket: int):
        """Words of which other buckets hold followers too."""
        codes = {int(self.cuts["code"][k]) for k in self._beside(bucket) if self.cuts["follow"][k]}
        return [(c, *self.words[c]) for c in sorted(codes) if c in self.words]


def _salted(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Key of a context's hash at a node of the code tree."""
    salt = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (context ^ salt) * np.uint64(0xD6E8FEB86659FD93)


def code_tree(frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Huffman tree over the 256 bytes: path start and length of each byte,
    then node and bit of every step."""
    heap = [(int(f) + 1, k, k) for k, f in enumerate(frequency)]
    heapq.heapify(heap)
    parent, bit, node = {}, {}, 256
    while len(heap) > 1:
        (fa, _, a), (fb, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a], parent[b], bit[a], bit[b] = node, node, 0, 1
        heapq.heappush(heap, (fa + fb, node, node))
        node += 1
    paths = []
    for k in range(256):
        path = []
        while k in parent:
            path.append((parent[k] - 256, bit[k]))
            k = parent[k]
        paths.append(path[::-1])
    length = np.array([len(p) for p in paths])
    steps = np.array([s for p in paths for s in p])
    return np.concatenate([[0], np.cumsum(length)])[:-1], length, steps[:, 0], steps[:, 1]


def _spelled(code, length, words):
    """Bytes of the words with their closing space (an end has none), the word
    of each, its place there, and the hash of each context before it: the word
    so far, then ``ORDERS``."""
    total = length + (code != END)
    edge = np.concatenate([[0], np.cumsum(total)])
    sym = np.full(edge[-1], 0x20, np.uint8)
    body = np.concatenate([[0], np.cumsum(length)])
    sym[np.arange(body[-1]) + np.repeat(edge[:-1] - body[:-1], length)] = words
    own = np.repeat(np.arange(len(code)), total)
    pos = np.arange(len(sym)) - edge[:-1][own]
    sums, down = W.prefix(sym.astype(np.uint64) + np.uint64(1), W._BYTES)
    here = np.arange(len(sym))
    contexts = [W.spans(sums, down, edge[:-1][own], here)]
    for order in ORDERS:
        contexts.append(W.spans(sums, down, here - np.minimum(pos, order), here) + np.uint64(order))
    return sym, own, pos, contexts


def _decisions(tree, bucket):
    """Chunks of binary decisions: word, node, bit, whether the word so far is
    short of ``HEAD``, the key of the word so far, each context's slot."""
    begin, depth, nodes, bits = tree
    code, length, words = bucket
    edge = np.concatenate([[0], np.cumsum(length)])
    cuts = np.searchsorted(edge, np.arange(0, edge[-1] + _SYMBOLS, _SYMBOLS))
    cuts = np.unique(np.append(np.minimum(cuts, len(code)), [0, len(code)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        sym, own, pos, contexts = _spelled(code[a:b], length[a:b], words[edge[a]:edge[b]])
        many = depth[sym]
        rep = np.repeat(np.arange(len(sym)), many)
        first = np.concatenate([[0], np.cumsum(many)])[:-1]
        step = begin[sym][rep] + np.arange(len(rep)) - first[rep]
        node = nodes[step]
        keys = [_salted(c[rep], node) for c in contexts]
        slots = [(k >> np.uint64(64 - size)).astype(np.int32) for k, size in zip(keys, SLOTS)]
        yield (a + own[rep]).astype(np.int32), node.astype(np.int16), bits[step].astype(np.int8), (pos < HEAD)[rep], keys[0], slots


class Prefixes:
    """Exact counts of the bucket's contexts "word so far" from ``HEAD`` on;
    of those that words of other buckets share, the counts over all of them.
    In the decisions, places in the counts take the keys' place."""

    def __init__(self, decisions, count, common: Common, bucket: int):
        long = [(key[~short], bit[~short], word[~short]) for word, _, bit, short, key, _ in decisions]
        key, bit, word = (np.concatenate(x) for x in zip(*long)) if long else (np.zeros(0, t) for t in (np.uint64, np.int8, np.int32))
        self.keys, at = np.unique(key, return_inverse=True)
        both = np.bincount(2 * at + bit, weights=count[word], minlength=2 * len(self.keys))
        self.counts = both[::2], both[1::2]
        del key, bit, word
        edge = 0
        for k, (word, node, bit, short, _, slots) in enumerate(decisions):
            place = np.zeros(len(short), np.int32)
            many = len(short) - int(short.sum())
            place[~short] = at[edge:edge + many]
            decisions[k], edge = (word, node, bit, short, place, slots), edge + many
        wide = common.contexts(bucket)
        if len(wide) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, common.keys[wide]), len(self.keys) - 1)
            here = self.keys[at] == common.keys[wide]
            for mine, all_ in zip(self.counts, common.counts):
                mine[at[here]] = all_[wide[here]]

    def add(self, n0, n1, short, place):
        """Counts of the short contexts, replaced where the word so far is long."""
        long = np.flatnonzero(~short)
        at = place[long]
        n0[long], n1[long] = self.counts[0][at], self.counts[1][at]


def _rows(batches):
    """Rows as dictionaries, one at a time: they are large."""
    for b in batches:
        for r in range(b.num_rows):
            yield {name: b.column(k)[r].as_py() for k, name in enumerate(b.schema.names)}
        pa.default_memory_pool().release_unused()
    _let_go()


def _open(row):
    code, count, length, words = (np.frombuffer(row[c], t) for c, t in (
        ("code", "<u8"), ("count", "<u8"), ("length", "<u4"), ("words", "u1")))
    return (code, length.astype(np.int64), words), count.astype(np.float64)


class Followers:
    """Training counts of a bucket's pairs: which pair each block's pairs are
    (``which``), and of each pair its word ``w`` and count ``n``; of each word
    all occurrences, distinct followers, and the two commonest (-1: none).  Of
    words with followers in other buckets these are counted over all of them; a
    commonest follower held elsewhere stands behind the pairs."""

    def __init__(self, row, code: np.ndarray, common: Common):
        code = np.concatenate([code, np.frombuffer(row["outside"], "<u8")])
        words = len(code)
        place, fan, follow, times = (np.frombuffer(row[c], "<u4") for c in ("places" if row["owners"] is None else "owners", "fan", "follow", "times"))
        key, self.which = np.unique(np.repeat(place.astype(np.uint64), fan) << np.uint64(32) | follow, return_inverse=True)
        self.w = (key >> np.uint64(32)).astype(np.int64)
        self.n = np.bincount(self.which, weights=times, minlength=len(key))
        known = np.flatnonzero(self.n)
        self.all = np.bincount(self.w, weights=self.n, minlength=words)
        self.distinct = np.bincount(self.w[known], minlength=words).astype(float)
        order = known[np.lexsort((known, -self.n[known], self.w[known]))]
        lead = np.flatnonzero(np.diff(self.w[order], prepend=-1))
        self.top = np.full((2, words), -1)
        for j in range(2):
            at = lead[lead + j < len(order)]
            at = at[self.w[order[at + j]] == self.w[order[at]]] + j
            self.top[j, self.w[order[at]]] = order[at]
        far = []
        for c, all_, distinct, best in common.shared(row["bucket"]):
            for w in np.flatnonzero(code == np.uint64(c)):
                self.all[w], self.distinct[w], self.top[:, w] = all_, distinct, -1
                for j, (n, follower, bucket) in enumerate(best):
                    if bucket == row["bucket"]:
                        self.top[j, w] = np.searchsorted(key, np.uint64(int(w) << 32 | follower))
                    else:
                        self.top[j, w] = len(key) + len(far)
                        far.append(n)
        self.n = np.concatenate([self.n, far])

    def decisions(self, own: int):
        """For each rank of follower, in runs: pairs that come to it, whether they
        are it, predictions and gate; ``own`` of each pair's occurrences left out."""
        n, come = self.n, np.arange(len(self.w))
        gone, kinds = np.zeros(len(self.all)), 0             # of each word: what the ranks before took
        for j in range(2):
            top = self.top[j, self.w[come]]
            come = come[top >= 0]
            for at in range(0, len(come), _SYMBOLS):
                k = come[at:at + _SYMBOLS]
                top = self.top[j, self.w[k]]
                if own:                                      # known from elsewhere, and an occurrence to judge
                    ok = (n[k] > 0) & ((top != k) | (n[k] > 1))
                    k, top = k[ok], top[ok]
                hit = top == k
                has = n[top] - own * hit
                r = np.maximum(self.all[self.w[k]] - gone[self.w[k]] - own, has)
                d = np.maximum(self.distinct[self.w[k]] - kinds - own * (n[k] == 1), 1)
                x = np.zeros((len(k), _WIDTH))
                x[:, 0] = np.log((has + PRIOR) / (r - has + PRIOR))
                x[:, 1] = np.log((np.maximum(r - d, 0) + PRIOR) / (d + PRIOR))
                x[:, 2] = np.log((has + PRIOR) / (d + PRIOR))
                x[:, -1] = 0.3
                gate = np.searchsorted([1.5, 4, 16, 100], r) * 4 + np.searchsorted([1.5, 4, 16], has)
                yield j, k, hit, x, _LETTER_GATES + j * _WORD_GATES + gate
            known = self.top[j] >= 0
            gone[known] += n[self.top[j, known]]
            kinds += 1
            come = come[self.top[j, self.w[come]] != come]


def _tables(tree):
    """Counts of zeros and ones per slot of each context, over a task's buckets."""
    def run(batches):
        tables = [np.zeros(2 << size) for size in SLOTS]
        for row in _rows(batches):
            bucket, count = _open(row)
            for word, _, bit, short, _, slots in _decisions(tree, bucket):
                seen = count[word]
                for k, (t, slot) in enumerate(zip(tables, slots)):
                    keep = short if k == 0 else slice(None)
                    np.add.at(t, (2 * slot + bit)[keep], seen[keep])
        for k, t in enumerate(tables):
            for at in range(0, len(t), 1 << 17):
                piece = t[at:at + (1 << 17)]
                if piece.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([at], pa.int32()),
                         pa.array([TaskContext.get().partitionId()], pa.int64()),
                         pa.array([_shrunk(piece)], pa.binary())], names=["context", "at", "part", "counts"])
    return run


def _shrunk(counts: np.ndarray) -> bytes:
    """Counts by byte planes (the high ones are nearly all zero), deflated."""
    return zlib.compress(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _grown(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _add(rows: pa.Table) -> pa.Table:
    total = sum(_grown(x) for x in rows["counts"].to_pylist())
    return pa.table({**{c: rows[c].slice(0, 1) for c in ("context", "at", "part")}, "counts": [_shrunk(total)]})


def _add_sums(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<f8") for x in rows["sums"].to_pylist())
    return pa.table({"part": rows["part"].slice(0, 1), "sums": [total.tobytes()]})


def _tree(rows: DataFrame, keys: list[str], add, tasks: int, fan: int = 64) -> DataFrame:
    """Rows of ``tasks`` tasks added up in groups of ``fan``, level by level,
    so that no task holds what more than ``fan`` others made."""
    schema = rows.schema
    while tasks > 1:
        tasks = -(-tasks // fan)
        rows = (rows.withColumn("part", F.floor(F.col("part") / fan)).groupBy(*keys, "part")
                .applyInArrow(add, schema))
    return rows


def _logits(tables, prefixes, bit, short, place, slots, own):
    """Logit of each context's prediction (own occurrences taken out), a
    constant, and the gate."""
    x = np.empty((len(bit), _WIDTH))
    x[:, -1] = 0.3
    seen = []
    for k, (t, slot) in enumerate(zip(tables, slots)):
        n0, n1 = t[2 * slot].astype(float), t[2 * slot + 1].astype(float)
        if k == 0:
            prefixes.add(n0, n1, short, place)
        n0, n1 = np.maximum(n0 - own * (1 - bit), 0), np.maximum(n1 - own * bit, 0)
        x[:, k] = np.log((n1 + PRIOR) / (n0 + PRIOR))
        if k in (0, len(SLOTS) - 1):
            seen.append(n0 + n1)
    gate = np.searchsorted([0.5, 1.5, 4, 16, 200], seen[0]) * 4 + np.searchsorted([0.5, 10, 300], seen[1])
    return x, gate


def _squash(z):
    return 1 / (1 + np.exp(-np.clip(z, -18, 18)))


def _bin(z):
    return np.clip(((z + 9) / 18 * _BINS).astype(np.int64), 0, _BINS - 1)


def _learn(tree, model, common):
    """Online fit over a task's buckets: weights per gate by Newton steps on
    each chunk, curvature added up; the map counts what the weights of the
    moment would have said."""
    def run(batches):
        w = np.full((_GATES, _WIDTH), 0.25)
        curve = np.tile(np.eye(_WIDTH) * 50.0, (_GATES, 1, 1))
        mass = np.zeros(_GATES)
        seen = np.zeros((2, _NODES * _BINS))

        def step(x, gate, node, bit, n):
            z = np.einsum("ij,ij->i", x, w[gate])
            p = _squash(z)
            place = node * _BINS + _bin(z)
            seen[0] += np.bincount(place, weights=n, minlength=_NODES * _BINS)
            seen[1] += np.bincount(place, weights=n * bit, minlength=_NODES * _BINS)
            for g in np.unique(gate):
                at = np.flatnonzero(gate == g)
                xs, ns = x[at], n[at]
                curve[g] += (xs * (ns * p[at] * (1 - p[at]))[:, None]).T @ xs
                w[g] += np.linalg.solve(curve[g], xs.T @ (ns * (bit[at] - p[at])))
                mass[g] += ns.sum()

        for row in _rows(batches):
            bucket, count = _open(row)
            decisions = list(_decisions(tree, bucket))
            prefixes = Prefixes(decisions, count, common.value, row["bucket"])
            for word, node, bit, short, place, slots in decisions:
                n = count[word]
                keep = np.flatnonzero(n)
                n, bit, node = n[keep], bit[keep], node[keep]
                x, gate = _logits(model.value, prefixes, bit, short[keep], place[keep], [s[keep] for s in slots], 1)
                step(x, gate, node, bit, n)
            del decisions, prefixes
            followers = Followers(row, bucket[0], common.value)
            for j, come, hit, x, gate in followers.decisions(1):
                if len(come):
                    step(x, gate, np.full(len(come), _NODES - 2 + j), hit.astype(float), followers.n[come])
        sums = np.concatenate([(w * mass[:, None]).ravel(), mass, seen.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([sums.astype("<f8").tobytes()], pa.binary())], names=["part", "sums"])
    return run


def _bits(x, gate, node, bit, weights, refine):
    """Log-probability of each decision's outcome."""
    z = np.einsum("ij,ij->i", x, weights[gate])
    p = (_squash(z) + refine[node * _BINS + _bin(z)]) / 2
    return np.log10(np.where(bit, p, 1 - p))


def _scored(tree, tables, common, weights, refine, row):
    """Of a bucket: training counts and spelling score of each word; of each
    block's pair the follower decisions' score, positive and negated where the
    token is a follower (and not spelled)."""
    bucket, count = _open(row)
    spelled = np.zeros(len(count))
    decisions = list(_decisions(tree, bucket))
    prefixes = Prefixes(decisions, count, common, row["bucket"])
    for word, node, bit, short, place, slots in decisions:
        x, gate = _logits(tables, prefixes, bit, short, place, slots, 0)
        spelled += np.bincount(word, weights=_bits(x, gate, node, bit, weights, refine), minlength=len(count))
    del decisions, prefixes
    followers = Followers(row, bucket[0], common)
    pair, found = np.zeros(len(followers.n)), np.zeros(len(followers.n), bool)
    for j, come, hit, x, gate in followers.decisions(0):
        pair[come] += _bits(x, gate, _NODES - 2 + j, hit, weights, refine)
        found[come[hit]] = True
    return count, spelled, np.where(found, np.maximum(-pair, _SURE), pair)[followers.which]


def _answer(tree, model, common, weights, refine):
    """Log-probabilities dealt back to the blocks that hold the words and pairs."""
    def run(batches):
        for row in _rows(batches):
            count, spelled, pair = _scored(tree, model.value, common.value, weights, refine, row)
            place = np.frombuffer(row["places"], "<u4")
            edge, pairs = (np.concatenate([[0], np.cumsum(row[c])]) for c in ("sizes", "pairs"))
            spans = list(zip(row["blocks"], edge[:-1], edge[1:], pairs[:-1], pairs[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block for block, *_ in spans], pa.int64()), pa.array([row["bucket"]] * len(spans), pa.int32()),
                 pa.array([count[place[x:y]].astype("<u4").tobytes() for _, x, y, _, _ in spans], pa.binary()),
                 pa.array([spelled[place[x:y]].astype("<f4").tobytes() for _, x, y, _, _ in spans], pa.binary()),
                 pa.array([pair[p:q].astype("<f2").tobytes() for _, _, _, p, q in spans], pa.binary())],
                names=["block", "bucket", "seen", "score", "pairs"])
    return run


_RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double")


def _sum_up(tokens: int, vocabulary: int):
    """A block's documents from its payload and the buckets' answers in order."""
    def run(rows: pa.Table) -> pa.Table:
        _let_go()                                               # of the block before
        rows = rows.sort_by("bucket")
        load = rows.slice(0, 1).to_pylist()[0]                  # bucket -1: the block itself
        seen, score, pairs = (np.concatenate([np.frombuffer(x, t) for x in rows[c].to_pylist()[1:]]).astype(np.float64)
                              for c, t in (("seen", "<u4"), ("score", "<f4"), ("pairs", "<f2")))
        if len(seen) != load["entries"]:
            raise ValueError("two scans of the documents gave different blocks: write them to a table first")
        base = np.log10((seen + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        ids = np.stack([np.frombuffer(load["low"], "<u2"), np.frombuffer(load["high"], "<u2")], axis=1).copy().view("<u4").ravel()
        many = np.array(load["tokens"], dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(many)])[:-1]        # every document has its end
        cost = pairs[_pairs(ids, len(seen), int(ids[-1]))[1]]   # the last token is an end
        return pa.table({
            "doc_id": pa.array(load["doc_id"], pa.int64()), "held_out": pa.array(load["held_out"], pa.bool_()),
            "n_tokens": many, "n_known": np.add.reduceat((seen > 0)[ids].astype(np.int64), at),
            "train_tokens": np.full(len(many), tokens, np.int64), "base_score": np.add.reduceat(base[ids], at),
            "score": np.add.reduceat(np.where(cost > 0, -cost, cost + score[ids]), at)})
    return run


@dataclass
class Learned:
    """What ``learn`` made: the buckets' and the blocks' tables, and the model
    of fixed size (code tree, letter tables, weights, map)."""
    lexicon: DataFrame
    load: DataFrame
    tokens: int
    vocabulary: int
    tree: tuple
    tables: list
    common: Common
    sent: tuple                       # tables and common, broadcast
    weights: np.ndarray
    refine: np.ndarray


_MODELLED = ("bucket", "code", "count", "length", "words", "places", "outside", "owners", "fan", "follow", "times")


def learn(docs: DataFrame, held) -> Learned:
    """Learn from the rows outside ``held`` (a boolean column)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    with few_rows(spark, SCAN):
        load = pin(rows.mapInArrow(_load(SAMPLE), _LOAD), ROW_GROUP)
    buckets = max(1, -(-load.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0] // BUCKET))
    sample = b"".join(bytes(r["sample"]) for r in load.select("sample").collect())     # one in SAMPLE
    place = _cuts(np.frombuffer(sample, _PLACE), buckets, HEAVY, SAMPLE)
    buckets, cuts = len(place) + 1, spark.sparkContext.broadcast(place)
    pieces = ", ".join(f"{c} binary" for c in _PIECE)
    dealt = rows.mapInArrow(_deal(cuts), f"bucket int, block long, {pieces}")          # scanned again: cheaper than written
    with few_rows(spark, SCAN):                           # the same blocks again
        lexicon = pin(dealt.groupBy("bucket").applyInArrow(_bucket(cuts), _BUCKET_FIELDS), ROW_GROUP)
    vocabulary, tokens = lexicon.agg(F.coalesce(F.sum("words_seen"), F.lit(0)),
                                     F.coalesce(F.sum("tokens_seen"), F.lit(0))).first()
    spelled = lexicon.select("code", "count", "length", "words")

    def bytes_(batches):
        total = np.zeros(256)
        for row in _rows(batches):
            (code, length, words), count = _open(row)
            total += np.bincount(words, weights=np.repeat(count, length), minlength=256)
            total[0x20] += count[code != END].sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    frequency = np.zeros(256)
    with few_rows(spark):
        for r in spelled.mapInArrow(bytes_, "byte long, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect():
            frequency[r.byte] = r.n
    tree = code_tree(frequency)
    found = lexicon.where("length(rims) > 0 or length(parts) > 0").select("bucket", "rims", "parts").collect() if place["inner"].any() else []
    common = Common(place, tree, found)
    shared = spark.sparkContext.broadcast(common)         # a few prefixes for each cut
    tables = [np.zeros(2 << size, np.float32) for size in SLOTS]
    with tidy(spark), few_rows(spark):
        pieces = _tree(spelled.mapInArrow(_tables(tree), "context int, at int, part long, counts binary"),
                       ["context", "at"], _add, buckets).collect()      # one row for each piece of the tables
    for r in pieces:
        piece = _grown(r.counts)
        tables[r.context][r["at"]:r["at"] + len(piece)] += piece
    model = spark.sparkContext.broadcast(tables)          # of fixed size

    fitted = lexicon.select(*_MODELLED)
    with tidy(spark), few_rows(spark):
        fits = _tree(fitted.mapInArrow(_learn(tree, model, shared), "part long, sums binary"), [], _add_sums, buckets).collect()
    weights, refine = _model(sum((np.frombuffer(r.sums, "<f8") for r in fits), np.zeros(_GATES * (_WIDTH + 1) + 2 * _NODES * _BINS)))

    return Learned(lexicon, load, int(tokens), int(vocabulary), tree, tables, common, (model, shared), weights, refine)


def score(docs: DataFrame, held) -> DataFrame:
    """Learn from the rows outside ``held`` (a boolean column), score all."""
    m = learn(docs, held)
    model, common = m.sent
    answers = m.lexicon.select(*_MODELLED, "blocks", "sizes", "pairs").mapInArrow(
        _answer(m.tree, model, common, m.weights, m.refine), "block long, bucket int, seen binary, score binary, pairs binary")
    with few_rows(docs.sparkSession):
        answers = pin(answers, ROW_GROUP)
    unpin(m.lexicon)
    return m.load.drop("sample").withColumn("bucket", F.lit(-1)).unionByName(answers, allowMissingColumns=True).groupBy("block").applyInArrow(
        _sum_up(m.tokens, m.vocabulary), _RESULT)


def _model(sums: np.ndarray):
    """Weights of each gate and the map, from the tasks' sums."""
    mass = sums[_GATES * _WIDTH:_GATES * (_WIDTH + 1)] + 1e-9
    weights = (sums[:_GATES * _WIDTH].reshape(_GATES, _WIDTH) + 0.25e-9) / mass[:, None]
    seen = sums[_GATES * (_WIDTH + 1):].reshape(2, -1)
    middle = np.tile(_squash((np.arange(_BINS) + 0.5) / _BINS * 18 - 9), _NODES)
    return weights, np.clip((seen[1] + 20 * middle) / (seen[0] + 20), 1e-8, 1 - 1e-8)
