"""Prefix trie of conversations by union-find over the neighbours in sorted order.

A conversation is the sequence of its turns, each a 128-bit hash of role and text. Equal sequences are one, with the number of their
conversations and the SHA-256 of their ids. The distinct sequences are sorted over range partitions; two neighbours share their
longest common prefix (LCP). A union-find takes the edges between neighbours in descending LCP: components that an edge of depth d
joins become children of one branching node at depth d, and the unary chain above each child is closed. Every node of the trie lies
on one chain, and what it reports follows from the chain's end: members, smallest member, leaves, and savings with the prefix sums of
text lengths.

A partition cannot close the prefixes of its first and of its last sequence, as neighbouring partitions may share them. It contracts
them: one item for every such prefix at which something branches or ends, with what lies below it inside the partition. All
partitions' items, in order, are sequences with neighbours again, and the same union-find over them closes the rest. That pass reads
one row per partition: the two outer sequences and their items.

Conversations are rebuilt first (`rebuild`): the first h turns come from another conversation.

Defined cases: turns are ordered by turn, nulls first, and where that ties by a hash of role and text; null roles and texts are
empty; rows without conv_id are left out; repeated rows are repeated turns; a rebuilt conversation without turns is a member of the
root; very long texts are hashed where they are read, and only hashes and lengths move; a conversation's hashes (20 bytes a turn) are
one row, however many turns it has; an empty table has no nodes, not even a root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.storage import stage

TURNS = 200_000      # turns of a range partition
IDS = 8192           # conversation ids of a piece of a hashed list
NO_MEMBER = np.iinfo(np.int64).max
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, block long, item long"


def rebuild(conversations: DataFrame, block: int = 100, parts: int = 6) -> DataFrame:
    """conv_id, keys (two numbers per turn) and chars (code points of each text) of every rebuilt conversation: the first
    h = crc32(conv_id) % parts turns of the conversation that its block begins with, then its own without the first h."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.xxhash64(role, text).alias("k"), F.xxhash64(F.lit(7), role, text).alias("l"), F.length(text).alias("n")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    own = stage(own.select("conv_id", F.transform("own", lambda t: F.struct(*[t[c].alias(c) for c in "kln"])).alias("own")), "trie-conversations")
    heads = own.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("first"), F.slice("own", 1, parts - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % parts).cast("int")
    rows = own.withColumn("first", F.col("conv_id") - F.col("conv_id") % block).join(heads, "first", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", F.slice("own", 1, 0)), F.lit(1), h),
                            F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))).alias("t"))
    return rows.select("conv_id", F.flatten(F.transform("t", lambda t: F.array(t["k"], t["l"]))).alias("keys"), F.transform("t", lambda t: t["n"]).alias("chars"))


# --- equal sequences --------------------------------------------------------------------------------------------------


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]


def _id_pieces(batches):
    """Rows sorted by sequence and id -> for every run of up to IDS ids of a sequence their decimal list."""
    for batch in batches:
        s, t, ids = _numbers(batch, "s", "t", "conv_id")
        if not len(ids):
            continue
        new = np.ones(len(ids), bool)
        new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        new[::IDS] = True
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(ids)))
        names = [str(i) for i in ids.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s[at]), pa.array(t[at]), pa.array(ids[at]), pa.array(n), pa.array([",".join(names[a:a + k]) for a, k in zip(at.tolist(), n.tolist())], pa.string())],
            names=["s", "t", "first", "n", "ids"])


def _classes(batches):
    """Pieces sorted by sequence and first id -> a row per sequence: smallest id, number, hash of the whole list."""
    key = None
    for batch in batches:
        out = []
        for s, t, first, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (s, t) == key:
                total += n
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((rep, total, sha.hexdigest()))
            key, rep, total, sha = (s, t), first, n, hashlib.sha256(ids.encode())
        yield _class_batch(out)
    if key is not None:
        yield _class_batch([(rep, total, sha.hexdigest())])


def _class_batch(rows):
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["rep", "n", "sha"])


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """rep (smallest conv_id), n, sha (of all conv_ids), keys and chars of every distinct sequence. A sequence's ids are sorted and
    written out by many tasks; one hashes the pieces in order, holding one at a time."""
    ids = sequences.select(F.xxhash64("keys").alias("s"), F.xxhash64(F.lit(7), "keys").alias("t"), "conv_id")
    pieces = ids.repartitionByRange("s", "t", "conv_id").sortWithinPartitions("s", "t", "conv_id").mapInArrow(_id_pieces, "s long, t long, first long, n long, ids string")
    reps = pieces.repartition("s", "t").sortWithinPartitions("s", "t", "first").mapInArrow(_classes, "rep long, n long, sha string")
    return reps.join(sequences, F.col("rep") == F.col("conv_id")).select("rep", "n", "sha", "keys", "chars")


# --- union-find ---------------------------------------------------------------------------------------------------------


class Forest:
    """Components of items in sorted order. An item is a prefix of depth `top` with what is known below it: members, smallest
    member, children, leaves, savings, and the hash of the ids that end there."""

    def __init__(self, top, members, low, kids, leaves, saved, ends, lengths):
        """lengths(item, depth): code points of the item's first `depth` turns."""
        self.top, self.members, self.low, self.kids, self.leaves, self.saved, self.ends = (list(x) for x in (top, members, low, kids, leaves, saved, ends))
        self.lengths = lengths
        n = len(self.top)
        self.up = list(range(n))                  # items
        self.node = list(range(n))                # node at the top of a component; the first n belong to the items
        self.alias = list(range(n))               # nodes
        self.known: dict[int, tuple] = {}         # node -> (True, smallest member) or (False, number of the open item)
        self.chains: list[tuple] = []
        self.open: list[tuple[int, ...]] = []     # what an open component holds when it is contracted

    @staticmethod
    def _find(up, x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def _close(self, c: int, depth: int, parent: int | None) -> None:
        """The chain of component c from below `depth` to its top is whole; its parent learns what lies below."""
        top, n, kids = self.top[c], self.members[c], self.kids[c]
        leaves = self.leaves[c] if kids else 1
        self.known[self._find(self.alias, self.node[c])] = True, self.low[c]
        self.chains.append((c, depth + 1, top, self.low[c], n, kids, leaves, self.saved[c], self.ends[c], parent))
        self.kids[c], self.leaves[c] = 1, leaves
        self.saved[c] += (n - 1) * (self.lengths(c, top) - self.lengths(c, max(depth, 0)))

    def _contract(self, c: int, side: int) -> None:
        self.known[self._find(self.alias, self.node[c])] = False, len(self.open)
        self.open.append((side, self.top[c], self.members[c], self.low[c], self.kids[c], self.leaves[c], self.saved[c], self.ends[c]))
        self.members[c], self.low[c], self.kids[c], self.leaves[c], self.saved[c] = 0, NO_MEMBER, 0, 0, 0

    def merge(self, lcp: list[int], outer: bool) -> None:
        """outer: the first and the last item may go on in other partitions, so their components are contracted, not closed."""
        last = len(self.top) - 1
        first_of, last_of = list(range(last + 1)), list(range(last + 1))
        for e in sorted(range(last), key=lambda e: -lcp[e]):
            depth, pair = lcp[e], (self._find(self.up, e), self._find(self.up, e + 1))
            nodes = []
            for c in pair:
                if self.top[c] > depth:
                    fresh = len(self.alias)
                    self.alias.append(fresh)
                    if outer and (first_of[c] == 0 or last_of[c] == last):
                        self._contract(c, 0 if first_of[c] == 0 else 1)
                    else:
                        self._close(c, depth, fresh)
                    self.top[c], self.node[c], self.ends[c] = depth, fresh, None
                nodes.append(self._find(self.alias, self.node[c]))
            a, b = pair
            self.alias[nodes[1]] = nodes[0]
            self.up[b] = a
            last_of[a] = last_of[b]
            for x in (self.members, self.kids, self.leaves, self.saved):
                x[a] += x[b]
            self.low[a] = min(self.low[a], self.low[b])
            self.ends[a] = self.ends[a] or self.ends[b]
        root = self._find(self.up, 0)
        self._contract(root, 0) if outer else self._close(root, -1, None)

    def resolve(self, node: int | None):
        return (True, None) if node is None else self.known[self._find(self.alias, node)]


def _expanded(forest: Forest, lengths: np.ndarray, begin: np.ndarray, block: int | None):
    """A row for every node of the closed chains. lengths[begin[i] + d]: code points of the first d turns of item i."""
    if not forest.chains:
        return
    item, lo, hi, low, n, kids, leaves, saved = (np.array([c[k] for c in forest.chains], np.int64) for k in range(8))
    ends = [c[8] for c in forest.chains]
    above = [forest.resolve(c[9]) for c in forest.chains]
    size = hi - lo + 1
    edge = np.concatenate([[0], np.cumsum(size)])
    for x in range(0, len(size), IDS):
        y = min(x + IDS, len(size))
        own = np.repeat(np.arange(x, y), size[x:y])
        depth = lo[own] + np.arange(edge[y] - edge[x]) - (edge[own] - edge[x])
        top, at = depth == hi[own], begin[item[own]]
        parent = low[own].astype(object)
        head = np.flatnonzero(depth == lo[own])
        parent[head] = [v if whole else None for whole, v in above[x:y]]
        where, sha = np.full(len(own), None, object), np.full(len(own), None, object)
        where[head] = [None if whole else v for whole, v in above[x:y]]
        sha[np.flatnonzero(top)] = ends[x:y]
        yield {"conv_id": pa.array(low[own]), "depth": pa.array(depth), "parent_conv_id": pa.array(parent, pa.int64()), "n_convs": pa.array(n[own]),
               "n_children": pa.array(np.where(top, kids[own], 1)), "n_leaves": pa.array(leaves[own]),
               "saved_tokens": pa.array(saved[own] + (n[own] - 1) * (lengths[at + hi[own]] - lengths[at + np.maximum(depth - 1, 0)])),
               "ends_sha256": pa.array(sha, pa.string()), "block": pa.array([None if w is None else block for w in where], pa.int64()), "item": pa.array(where, pa.int64())}


def common_prefixes(keys: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the next one. keys: a row of two numbers per turn."""
    both = np.minimum(size[:-1], size[1:])
    edge = np.concatenate([[0], np.cumsum(both)])
    step = np.arange(edge[-1]) - np.repeat(edge[:-1], both)
    same = (keys[np.repeat(begin[:-1], both) + step] == keys[np.repeat(begin[1:], both) + step]).all(axis=1)
    out = both.copy()
    pair = np.repeat(np.arange(len(both)), both)[~same]
    np.minimum.at(out, pair, step[~same])
    return out


def _borders(column) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _forest_batches(batches):
    """Distinct sequences in order -> the nodes that this partition can close, and one row with what it cannot."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    rep, n = _numbers(table, "rep", "n")
    sha = table.column(table.schema.get_field_index("sha")).to_pylist()
    keys, _ = _borders(table.column(table.schema.get_field_index("keys")))
    chars, size = _borders(table.column(table.schema.get_field_index("chars")))
    keys, size = keys.reshape(-1, 2), size.astype(np.int64)
    begin = np.cumsum(size) - size
    run = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    some = len(rep)
    forest = Forest(size.tolist(), n.tolist(), rep.tolist(), [0] * some, [0] * some, [0] * some, sha, lambda c, d: int(run[begin[c] + d] - run[begin[c]]))
    forest.merge(common_prefixes(keys, begin, size).tolist(), outer=True)
    block = int(rep[0])
    # lengths[begin + d] - lengths[begin] are the first d turns, also across sequences
    for columns in _expanded(forest, run, begin, block):
        rows = len(columns["depth"])
        yield _batch(columns | {"first": pa.nulls(rows, pa.list_(pa.int64())), "forest": pa.nulls(rows, pa.binary())})
    ends = [(keys[begin[i]:begin[i] + size[i]], run[begin[i]:begin[i] + size[i] + 1] - run[begin[i]]) for i in (0, some - 1)]
    kept = pickle.dumps((block, forest.open, ends))
    empty = {f.split()[0]: pa.nulls(1, pa.string() if f.endswith("string") else pa.int64()) for f in NODE.split(", ")}
    yield _batch(empty | {"first": pa.array([ends[0][0].ravel()], pa.list_(pa.int64())), "forest": pa.array([kept], pa.binary())})


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _outer_batches(batches):
    """The contracted forests of all partitions, in order -> the remaining nodes, and the smallest member of each open item."""
    items, lcp, where, flat, starts = [], [], [], [np.zeros(0, np.int64)], []
    at, before = 0, None
    for batch in batches:
        for data in batch.column(batch.schema.get_field_index("forest")).to_pylist():
            block, found, ends = pickle.loads(data)
            begins = []
            for _, lengths in ends:
                begins.append(at)
                flat.append(lengths)
                at += len(lengths)
            # first sequence's prefixes from the deepest up, then the last one's down: neighbours share the shallower of the two
            order = sorted(range(len(found)), key=lambda i: (found[i][0], found[i][1] if found[i][0] else -found[i][1]))
            for k, i in enumerate(order):
                if items:
                    shared = min(items[-1][1], found[i][1])
                    lcp.append(shared if k else min(shared, _shared(before, ends[0][0])))
                items.append(found[i])
                starts.append(begins[found[i][0]])
                where.append((block, i))
            before = ends[1][0]
    if not items:
        return
    lengths, begin = np.concatenate(flat), np.array(starts, np.int64)
    forest = Forest(*([i[k] for i in items] for k in range(1, 8)), lambda c, d: int(lengths[begin[c] + d]))
    forest.merge(lcp, outer=False)
    for columns in _expanded(forest, lengths, begin, None):
        yield _batch(columns)
    rows = len(where)
    empty = {f.split()[0]: pa.nulls(rows, pa.string() if f.endswith("string") else pa.int64()) for f in NODE.split(", ")}
    yield _batch(empty | {"conv_id": pa.array([forest.resolve(i)[1] for i in range(rows)], pa.int64()), "block": pa.array([b for b, _ in where], pa.int64()),
                          "item": pa.array([i for _, i in where], pa.int64())})


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


def trie(sequences: DataFrame) -> DataFrame:
    """Every node of the trie of sequences (conv_id distinct, keys, chars): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256 (null where no conversation ends)."""
    spark = sequences.sparkSession
    sequences = stage(sequences.select("conv_id", "keys", "chars"), "trie-sequences")
    single = stage(distinct_sequences(sequences), "trie-distinct")
    turns = single.agg(F.sum(F.size("chars"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS))
    rows = single.repartitionByRange(parts, "keys").sortWithinPartitions("keys").mapInArrow(_forest_batches, f"{NODE}, first array<long>, forest binary")
    rows = stage(rows, "trie-forests")
    outer = rows.where("forest is not null").select("first", "forest").repartition(1).sortWithinPartitions("first")
    outer = stage(outer.mapInArrow(_outer_batches, NODE), "trie-outer")
    members = outer.where("depth is null").select("block", "item", F.col("conv_id").alias("above"))
    names = [f.split()[0] for f in NODE.split(", ")[:-2]]
    inner = rows.where("forest is null")
    hung = inner.where("item is not null").join(members, ["block", "item"]).withColumn("parent_conv_id", F.col("above"))
    return inner.where("item is null").select(names).unionByName(hung.select(names)).unionByName(outer.where("depth is not null").select(names))
