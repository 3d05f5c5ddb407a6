"""Prefix trie of conversations over minimal-perfect-hash node tables.

Conversations that begin with the same turns share the nodes of that prefix.

1. Turns are numbered inside their conversation (``ordered_stats``: range
   sort, so one conversation may span many tasks) and conversations rebuilt:
   each takes its first turns from the first conversation of its hundred.
2. One range-sorted scan gives every prefix a 128-bit digest: the sums, modulo
   2**64, of mixed hashes of (turn, place) under two hash functions.  A
   conversation that began in an earlier task gets what that task had summed;
   the driver sees one row per task for that.
3. Distinct digests are the nodes: members are counted and the smallest taken
   before the shuffle, so a prefix of a third of all rows is one row per task.
   Nodes of a single member form chains with known numbers (one leaf, nothing
   saved) and go no further; the shared ones are counted up the tree.
4. Shared nodes are dealt to shards by subtree.  A subtree of more than
   ``bound`` nodes is cut at its next cut depth (1 to 8, then steps of a
   quarter), so shards hold whole subtrees of bounded size.  Each shard builds a
   minimal perfect hash over its digests; every slot keeps its digest, and a
   look-up counts only where it is the same.  Counts are scattered into flat
   arrays by slot and added up through the parents' slots, deepest level first.
5. The few nodes above the shards get the shards' totals by a join along the
   path of a member.

Conversation ids that end in a node are joined to text in sorted pieces, made
by many tasks; one pass over a node's pieces in order gives its SHA-256, a
digest that is sequential by definition, with one piece in memory at a time.

Cases: null role or text is empty; a null turn comes first; equal turn numbers
go by role, then by the hash of the text; repeated rows are turns of their own;
rows without a conv_id belong to no conversation; other columns are ignored;
an empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ordered_stats
from . import words as W
from .store import pin, tidy

GROUP = 100             # conversations that take their first turns from one of them
HEADS = 6               # how many turns: crc32 modulo this
SHARD = 200_000         # shared nodes a shard is planned for
BOUND = 200_000         # and of one subtree, beyond which it is cut
PIECE = 1 << 16         # ids joined into one piece
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def cut_depths(last: int = 1 << 31) -> list[int]:
    out = list(range(1, 9))
    while out[-1] < last:
        out.append(out[-1] + out[-1] // 4)
    return out


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (1 on), n (turns of the conversation), two hashes of each turn and its length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("v1"), F.xxhash64(F.lit("turn"), text, role).alias("v2"),
        F.char_length(text).cast("long").alias("chars"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("v1"), F.asc("v2")]
    return pin(ordered_stats(turns, order, ["conv_id"]).select(
        "conv_id", F.col("_rn").alias("place"), F.col("_n").alias("n"), "v1", "v2", "chars"))


def _rebuilt(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, turns after rebuilding) and their turns (conv_id, depth, v1, v2, chars, last)."""
    convs = pin(turns.groupBy("conv_id").agg(F.max("n").alias("n")).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
                .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = pin(convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
                .withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
                .select("conv_id", "base", "h", "taken", "size"))
    first = turns.where(F.col("place") < heads).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "v1", "v2", "chars")
    borrowed = convs.where("taken > 0").join(first, "base").where("depth <= taken")
    own = turns.join(convs, "conv_id").where("place > h").withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "depth", "v1", "v2", "chars", (F.col("depth") == F.col("size")).alias("last")]
    return convs, own.select(*columns).union(borrowed.select(*columns))


def _u64(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _i64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


_SUMS = "part int, conv_id long, depth long, chars long, last boolean, p1 long, p2 long, q1 long, q2 long"


def _sums(batches):
    """Running sums over each conversation's turns (p: with this one, q: before
    it), as far as they lie in this task."""
    conv, carry = None, [np.zeros(1, np.uint64)] * 2
    for b in batches:
        if not b.num_rows:
            continue
        own = b.column("conv_id").to_numpy()
        depth = _u64(b.column("depth"))
        lead = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        run = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(own))))
        out = []
        for k, (name, salt) in enumerate((("v1", _STEP), ("v2", _OTHER))):
            term = W.mix(_u64(b.column(name)) + depth * salt)
            before = np.cumsum(term) - term
            q = before - before[lead][run]
            if own[0] == conv:
                q[run == 0] += carry[k]
            out += [q + term, q]
            carry[k] = out[-2][-1:]
        conv = own[-1]
        yield pa.RecordBatch.from_arrays(
            [b.column(c) for c in ("part", "conv_id", "depth", "chars", "last")] + [_i64(out[i]) for i in (0, 2, 1, 3)],
            names=[f.split()[0] for f in _SUMS.split(", ")])


def _carries(edges) -> dict[int, tuple[int, int, int]]:
    """Of each task whose first conversation began before: that id, and its sums so far."""
    out, conv, sums = {}, None, (0, 0)
    for e in sorted(edges, key=lambda e: e.part):
        if e.first == conv:
            out[e.part] = (conv, *sums)
        begun = sums if e.first == e.final == conv else (0, 0)
        conv, sums = e.final, tuple((s + x) % (1 << 64) for s, x in zip(begun, (e.sums.p1, e.sums.p2)))
    return out


def _key(sums: np.ndarray, depth: np.ndarray) -> np.ndarray:
    return W.mix(sums + depth * _STEP)


_KEYED = "conv_id long, depth long, chars long, last boolean, k1 long, k2 long, u1 long, u2 long"


def _keys(carries):
    """Digest of each prefix (k1, k2) and of the one a turn shorter (u1, u2)."""
    def run(batches):
        for b in batches:
            part, conv = b.column("part").to_numpy(), b.column("conv_id").to_numpy()
            depth = _u64(b.column("depth"))
            sums = {c: _u64(b.column(c)).copy() for c in ("p1", "p2", "q1", "q2")}
            for p in np.unique(part):
                if int(p) in carries:
                    first, *before = carries[int(p)]
                    at = (part == p) & (conv == first)
                    for c, values in sums.items():
                        values[at] += np.uint64(before[int(c[1]) - 1])
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("conv_id", "depth", "chars", "last")]
                + [_i64(_key(sums[c], depth)) for c in ("p1", "p2")] + [_i64(_key(sums[c], depth - np.uint64(1))) for c in ("q1", "q2")],
                names=[f.split()[0] for f in _KEYED.split(", ")])
    return run


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each rebuilt turn: the prefix that ends with it, by digest."""
    ranged = (turns.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
              .withColumn("part", F.spark_partition_id()))
    summed = pin(ranged.mapInArrow(_sums, _SUMS))
    edges = summed.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("final"),
                                       F.max_by(F.struct("p1", "p2"), F.struct("conv_id", "depth")).alias("sums")).collect()
    return pin(summed.mapInArrow(_keys(_carries(edges)), _KEYED))


def _place(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (W.mix(k1 ^ W.mix(k2 + np.array([level], np.uint64) * _OTHER)) % np.uint64(size)).astype(np.int64)


class Slots:
    """A minimal perfect hash over distinct 128-bit digests: level by level, a
    digest alone at its place takes the next slot; the others go on."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels, given = [], 0
        self.slot = np.empty(len(k1), np.int64)
        alive = np.arange(len(k1))
        while len(alive):
            if len(self.levels) == 100:
                raise ValueError("equal digests")
            size = 2 * len(alive)
            h = _place(k1[alive], k2[alive], len(self.levels), size)
            alone = np.bincount(h, minlength=size) == 1
            rank = given + np.cumsum(alone) - 1
            here = alone[h]
            self.slot[alive[here]] = rank[h[here]]
            self.levels.append((alone, rank))
            given += int(here.sum())
            alive = alive[~here]
        self.k1, self.k2 = np.empty_like(k1), np.empty_like(k2)
        self.k1[self.slot], self.k2[self.slot] = k1, k2

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 where the slot holds another one."""
        out = np.full(len(k1), -1)
        pending = np.arange(len(k1))
        for level, (alone, rank) in enumerate(self.levels):
            h = _place(k1[pending], k2[pending], level, len(alone))
            here = alone[h]
            out[pending[here]] = rank[h[here]]
            pending = pending[~here]
        found = np.flatnonzero(out >= 0)
        same = (self.k1[out[found]] == k1[found]) & (self.k2[out[found]] == k2[found])
        out[found[~same]] = -1
        return out


_NODES = "k1 long, k2 long, u1 long, u2 long, conv_id long, depth long, n_convs long, children long, leaves long, saved long"
_COUNTED = _NODES + ", up_conv long, top boolean"


def _accumulate(rows: pa.Table) -> pa.Table:
    """One shard's nodes with their subtrees' totals; ``top`` where the parent is in no shard."""
    col = {f.name: rows[f.name].combine_chunks() for f in rows.schema}
    k1, k2, u1, u2 = (_u64(col[c]) for c in ("k1", "k2", "u1", "u2"))
    slots = Slots(k1, k2)
    at, up = slots.slot, slots.find(u1, u2)
    n = len(at)
    flat = {}
    for c in ("depth", "conv_id", "children", "leaves", "saved"):
        flat[c] = np.zeros(n, np.int64)
        flat[c][at] = col[c].to_numpy()
    parent = np.empty(n, np.int64)
    parent[at] = up
    inside = np.flatnonzero(parent >= 0)
    flat["children"] += np.bincount(parent[inside], minlength=n)
    order = inside[np.argsort(-flat["depth"][inside], kind="stable")]
    level = np.concatenate([np.flatnonzero(np.diff(flat["depth"][order])) + 1, [len(order)]])
    begin = 0
    for end in level:                                        # deepest first
        these = order[begin:end]
        for c in ("leaves", "saved"):
            np.add.at(flat[c], parent[these], flat[c][these])
        begin = end
    out = {c: col[c] for c in ("k1", "k2", "u1", "u2", "conv_id", "depth", "n_convs")}
    out |= {c: pa.array(flat[c][at]) for c in ("children", "leaves", "saved")}
    out["up_conv"] = pa.array(flat["conv_id"][np.maximum(up, 0)], mask=up < 0)
    out["top"] = pa.array(up < 0)
    return pa.table(out)


def _totals(shared: DataFrame, keyed: DataFrame, shard: int, bound: int) -> DataFrame:
    """The shared nodes with totals over their subtrees and the parent's smallest
    member (null below the root)."""
    marks = (keyed.where(F.col("depth").isin(cut_depths())).groupBy(F.col("conv_id").alias("member"))
             .agg(F.collect_list(F.struct("depth", F.col("k1").alias("cut"))).alias("path")))     # a cut depth each
    placed = pin(shared.join(marks, F.col("conv_id") == F.col("member")).withColumn(
        "cuts", F.transform(F.array_sort(F.filter("path", lambda e: e["depth"] <= F.col("depth"))), lambda e: e["cut"]))
        .drop("member", "path"))
    n = placed.count()
    bound = max(bound, n // 1000)                            # so at most 1000 heavy nodes of each cut depth
    heavy = [r.cut for r in placed.select(F.explode("cuts").alias("cut")).groupBy("cut").count().where(F.col("count") > bound).collect()]
    light = F.filter("cuts", lambda c: ~c.isin(heavy)) if heavy else F.col("cuts")
    dealt = placed.withColumn("anchor", F.get(light, F.lit(0))).drop("cuts")
    shards = max(1, -(-n // shard))
    counted = pin(dealt.where("anchor is not null").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
                  .drop("anchor").groupBy("shard").applyInArrow(_accumulate, _COUNTED))
    above = pin(dealt.where("anchor is null").drop("anchor"))

    tops = counted.where("top").select(*above.columns).union(above)
    line = keyed.join(above.select("k1", "k2"), ["k1", "k2"]).select(
        F.col("conv_id").alias("member"), F.col("depth").alias("at"), "k1", "k2")
    given = (tops.select(F.col("conv_id").alias("member"), F.col("depth").alias("below"), "leaves", "saved")
             .join(line, "member").where("at < below").groupBy("k1", "k2")
             .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"),
                  F.sum((F.col("at") == F.col("below") - 1).cast("long")).alias("more_children")))
    filled = above.join(given, ["k1", "k2"], "left")
    for c in ("children", "leaves", "saved"):
        filled = filled.withColumn(c, F.col(c) + F.coalesce(f"more_{c}", F.lit(0)))
    rest = counted.where("top").select(*above.columns).union(filled.select(*above.columns))
    parents = above.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("up_conv"))
    columns = [*above.columns, "up_conv"]
    return counted.where("not top").select(*columns).union(rest.join(parents, ["u1", "u2"], "left").select(*columns))


def _pieces(batches):
    """Ids of each node in order, joined by commas, ``PIECE`` of them a row."""
    for b in batches:
        if not b.num_rows:
            continue
        k1, k2, conv = (b.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
        new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        lead = np.flatnonzero(new)
        cuts = np.unique(np.concatenate([np.arange(a, z, PIECE) for a, z in zip(lead, np.append(lead[1:], len(conv)))]))
        ends = np.append(cuts[1:], len(conv))
        yield pa.RecordBatch.from_arrays(
            [pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(conv[cuts]),
             pa.array([",".join(map(str, conv[a:z].tolist())) for a, z in zip(cuts, ends)], pa.string())],
            names=["k1", "k2", "first", "ids"])


def _digests(batches):
    """SHA-256 over each node's pieces, which come in order."""
    key, state = None, None
    done = []

    def close():
        rows = pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in done], pa.int64()), pa.array([k[1] for k, _ in done], pa.int64()),
                                           pa.array([d for _, d in done], pa.string())], names=["k1", "k2", "ends"])
        done.clear()
        return rows

    for b in batches:
        for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) == key:
                state.update(b",")
            else:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            state.update(ids.encode())
        if len(done) > 4096:
            yield close()
    if state:
        done.append((key, state.hexdigest()))
    yield close()


def _ended(ends: DataFrame) -> DataFrame:
    keys = ["k1", "k2"]
    pieces = ends.repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id").mapInArrow(
        _pieces, "k1 long, k2 long, first long, ids string")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(_digests, "k1 long, k2 long, ends string")


def trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS, shard: int = SHARD, bound: int = BOUND) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = _numbered(conversations)
    convs, rebuilt = _rebuilt(turns, group, heads)
    keyed = prefixes(rebuilt)
    keys = ["k1", "k2"]
    nodes = pin(keyed.groupBy(*keys).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("u1").alias("u1"),
        F.min("u2").alias("u2"), F.min("chars").alias("chars"), F.sum(F.col("last").cast("long")).alias("ends")))
    shared = nodes.where("n_convs > 1")

    # nodes of one member: a chain below a shared node, or below the root
    over = shared.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("up_conv"))
    single = pin(nodes.where("n_convs = 1").join(over, ["u1", "u2"], "left")
                 .select("conv_id", "depth", "u1", "u2", "up_conv", (F.col("ends") > 0).alias("ended")))
    tails = single.where("up_conv is not null").groupBy("u1", "u2").agg(F.count("*").alias("tails"))
    tails = tails.withColumnsRenamed({"u1": "k1", "u2": "k2"})
    start = shared.join(tails, keys, "left").withColumn("tails", F.coalesce("tails", F.lit(0))).select(
        "k1", "k2", "u1", "u2", "conv_id", "depth", "n_convs", F.col("tails").alias("children"),
        (F.col("tails") + (F.col("ends") == F.col("n_convs")).cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    with tidy(keyed.sparkSession):
        totals = pin(_totals(pin(start), keyed, shard, bound))

    root = _key(np.zeros(1, np.uint64), np.zeros(1, np.uint64)).view(np.int64).tolist()[0]
    ends = keyed.where("last").select(*keys, "conv_id").union(
        convs.where("size = 0").select(F.lit(root).alias("k1"), F.lit(root).alias("k2"), "conv_id"))
    digest = pin(_ended(ends))
    none = F.sha2(F.lit("").cast("binary"), 256)
    many = totals.join(digest, keys, "left").select(
        "conv_id", "depth", "up_conv", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", none).alias("ends_sha256"))
    one = F.lit(1).cast("long")
    chains = single.select(
        "conv_id", "depth", F.when(F.col("depth") > 1, F.coalesce("up_conv", "conv_id")).alias("up_conv"), one.alias("n_convs"),
        F.when(F.col("ended"), F.lit(0)).otherwise(one).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("ended"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none).alias("ends_sha256"))

    # the root: sums over its children
    zero = F.lit(0).cast("long")
    below = totals.where("depth = 1").select("leaves", "saved").union(single.where("depth = 1").select(one, zero)).agg(
        F.count("*").alias("n_children"), F.coalesce(F.sum("leaves"), zero).alias("leaves"), F.coalesce(F.sum("saved"), zero).alias("saved"))
    at_root = digest.where((F.col("k1") == root) & (F.col("k2") == root)).agg(F.max("ends").alias("ends"))
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = whole.join(F.broadcast(below)).join(F.broadcast(at_root)).select(                     # one row each
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("up_conv"), "n_convs", "n_children",
        F.greatest("leaves", one).alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", none).alias("ends_sha256"))
    smallest = whole.select(F.col("conv_id").alias("root_conv"))
    return (top.union(many).union(chains).join(F.broadcast(smallest))                           # one row
            .select("conv_id", "depth", F.when(F.col("depth") == 1, F.col("root_conv")).otherwise(F.col("up_conv")).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))


#: The definition itself: prefixes as strings, subtrees by comparing them.  (Equal turn
#: numbers of one role go by text here, by its hash above; the tables have none.)
SQL = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS s, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, n, c - c % {GROUP} AS b, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % {HEADS} AS h
  FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
plan AS (SELECT x.c, x.b, x.h, least(x.h, coalesce(y.n, 0)) AS taken FROM conv x LEFT JOIN conv y ON y.c = x.b),
turn AS (
  SELECT plan.c, i AS d, s, chars FROM plan JOIN t ON t.c = b AND i <= taken
  UNION ALL SELECT plan.c, i - h + taken, s, chars FROM plan JOIN t ON t.c = plan.c AND i > h),
path AS (
  SELECT c, d, chars, array_to_string(list(s) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING), '') AS k FROM turn
  UNION ALL SELECT c, 0, 0, '' FROM plan),
node AS (SELECT k, d, min(c) AS c, count(*) AS n, (count(*) - 1) * min(chars) AS saved FROM path GROUP BY k, d),
kids AS (SELECT substr(k, 1, (d - 1) * 128) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
under AS (
  SELECT a.k, sum(x.saved) AS saved, count(*) FILTER (WHERE kids.k IS NULL) AS leaves
  FROM node a JOIN node x ON starts_with(x.k, a.k) LEFT JOIN kids ON kids.k = x.k GROUP BY a.k),
done AS (SELECT k, string_agg(c, ',' ORDER BY c) AS ids FROM (SELECT c, max_by(k, d) AS k FROM path GROUP BY c) GROUP BY k)
SELECT node.c AS conv_id, node.d AS depth, up.c AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       leaves AS n_leaves, under.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN under ON under.k = node.k LEFT JOIN kids ON kids.k = node.k LEFT JOIN done ON done.k = node.k
LEFT JOIN node up ON node.d > 0 AND up.k = substr(node.k, 1, (node.d - 1) * 128)
"""
