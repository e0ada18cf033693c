"""N-gram Jaccard join with count vectors.

A text is its set of distinct word n-grams, hashed. The hashes fall into groups by their leading bits, and the group counts make
the text a point. For two texts the sum over groups of the smaller count bounds the overlap, so an R-tree on the points (boxes
bounded by the largest count per group) finds all partners that may reach the threshold, and the sets settle which do.

What brings texts to one tree is exact, too. Two sets within the threshold differ in at most D n-grams, where D follows from the
smaller size; with more than D groups at least one group is equal. Every text gives a key (the content's hash) for its fullest
groups: for all that are no smaller than its (D+1)-th fullest. Of any linked pair, the text with the higher bar has more than D
such groups, so one of them is equal in the other, which is under a lower bar and gives the key as well. Texts connected by equal
keys form a family; families are compared in blocks of bounded size, block against block, and a block pair returns a spanning
forest of its links, not all pairs. Equal sets are one class from the start.

Defined cases: null, empty and wordless texts have an empty set and link with nothing; a text with fewer words than the n-gram is
one n-gram; rows that share a doc_id are one document; a row without doc_id has no component; columns besides doc_id and text are
not looked at. Hashes are 64 bits per n-gram and 128 per set.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt
from tidewatch.llm.components import components
from tidewatch.operators.text import spread_out, squeezed
from tidewatch.sources.storage import stage

BLOCK = 400_000      # n-grams of a family's block
AXES = 6             # the points have 2 ** AXES coordinates
FAN = 16             # entries of a tree node
KEYS = 1 << 22       # keys of a part that is searched for repeated ones
PIECE = 1 << 21      # keys that are sorted into parts at a time


def shingle_sets(buf: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    w = bt.Words(buf, at)
    h = w.hashes(bt.LOWER)
    grams = bt.gram_hashes(h, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(bt.mix64(bt.gram_hashes(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def spread(size: int, percent: int) -> int:
    """Most n-grams in which a set of this size and a linked one that is no smaller can differ."""
    return (100 - percent) * (100 * size // percent) // 100


def bits_for(d: int) -> int:
    """Binary digits of the number of groups used where up to d n-grams differ: more than d groups, and some to spare."""
    return (max(d + 1, -(-5 * d // 4)) - 1).bit_length()


def most_differences(bits: int) -> int:
    """Largest d with bits_for(d) <= bits."""
    g = 1 << bits
    return min(g - 1, 4 * g // 5)


def keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the contents of the fullest groups, for every number of groups a partner may use."""
    n, out = len(hashes), []
    if not n:
        return np.zeros(0, np.uint64)
    mixed = bt.mix64(hashes)
    smallest = -(-percent * n // 100)
    for bits in range(bits_for(spread(smallest, percent)), bits_for(spread(n, percent)) + 1):
        d = min(spread(n, percent), most_differences(bits))
        if not bits or not d:
            continue    # no differences: only equal sets link, and these are one class
        group = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        count = np.bincount(group, minlength=1 << bits)
        bar = np.partition(count, len(count) - 1 - d)[len(count) - 1 - d]
        run = np.concatenate([[np.uint64(0)], np.cumsum(mixed)])
        edge = np.concatenate([[0], np.cumsum(count)])
        total = run[edge[1:]] - run[edge[:-1]]
        use = np.flatnonzero(count >= bar)
        out.append(bt.mix64(total[use] + bt.mix64((use + (1 << bits)).astype(np.uint64)) + count[use].astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class PointTree:
    """R-tree on count vectors, packed: points sorted by size, then by their first coordinates, FAN to a node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = []
        top, least = self.points, self.sizes
        while len(top) > FAN:
            cut = np.arange(0, len(top), FAN)
            top, least = np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(least, cut)
            self.levels.append((top, least))

    def within(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Indices of points whose overlap with this one may reach the threshold."""
        def may(tops, least):
            return (100 + percent) * np.minimum(tops, point).sum(axis=1) >= percent * (size + least)
        nodes = None
        for top, least in reversed(self.levels):
            nodes = np.arange(len(top)) if nodes is None else nodes[nodes < len(top)]
            nodes = nodes[may(top[nodes], least[nodes])]
            nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        nodes = np.arange(len(self.points)) if nodes is None else nodes[nodes < len(self.points)]
        return self.order[nodes[may(self.points[nodes], self.sizes[nodes])]]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return False
    place = np.searchsorted(large, small)
    both = int((large[np.minimum(place, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def forest(sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect the same sets as all links do. side: compare only across the two values (None: all with all)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    points = np.stack([np.bincount((s >> np.uint64(64 - AXES)).astype(np.int64), minlength=1 << AXES) for s in sets])
    right = np.arange(len(sets)) if side is None else np.flatnonzero(side == 1)
    if not len(right):
        return []
    tree = PointTree(points[right], sizes[right])
    group, out = np.arange(len(sets)), []
    for u in range(len(sets)) if side is None else np.flatnonzero(side == 0):
        found = right[tree.within(points[u], sizes[u], percent)]
        found = found[found > u] if side is None else found
        while len(found := found[group[found] != group[u]]):
            v, found = found[0], found[1:]
            if linked(sets[u], sets[v], percent):
                out.append((int(u), int(v)))
                group[group == group[v]] = group[u]
    return out


@contextmanager
def _small_filters(spark):
    """Let Spark filter the texts by a Bloom filter of the wanted ids before it shuffles them, whatever their size."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def _sketch_batches(n: int, percent: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for lo, buf, at in bt.chunks(batch, "text"):
                sets = shingle_sets(buf, at, n)
                found = [keys(s, percent) for s in sets]
                classes = []
                for s in sets:
                    m = bt.mix64(s)
                    classes.append(np.array([m.sum() + np.uint64(len(s)), bt.mix64(m ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).tobytes() if len(s) else None)
                borders = np.concatenate([[0], np.cumsum([len(k) for k in found])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(borders), pa.array(flat))], names=["doc_id", "n", "class", "keys"])
    return run


def _set_batches(n: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for lo, buf, at in bt.chunks(batch, "text"):
                sets = shingle_sets(buf, at, n)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "grams"])
    return run


def _compare(percent: int):
    """Rows come sorted by block pair; each pair's sets are held together, one pair at a time."""
    def links(key, rows):
        sets = [np.frombuffer(g, np.uint64) for _, _, g in rows]
        side = None if key[1] == key[2] else np.array([0 if block == key[1] else 1 for _, block, _ in rows])
        return [(rows[u][0], rows[v][0]) for u, v in forest(sets, side, percent)]

    def run(frames):
        key, rows = None, []
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if (r.family, r.i, r.j) != key:
                    out += links(key, rows) if rows else []
                    key, rows = (r.family, r.i, r.j), []
                rows.append((r.node, r.block, r.grams))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        yield pd.DataFrame(links(key, rows) if rows else [], columns=["a", "b"], dtype="int64")
    return run


def _key_lists(parts: int):
    """Keys and the documents that give them, as packed lists by part."""
    def run(batches):
        for batch in batches:
            ids, lists = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "keys"))
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            nodes, lo = ids.to_numpy(zero_copy_only=False), 0
            while lo < len(ends):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE, "right")))
                sizes, found = np.diff(ends[lo:hi], prepend=ends[lo - 1] if lo else 0), lists.slice(lo, hi - lo).flatten()
                keys, node = found.to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(nodes[lo:hi], sizes)
                part = (keys % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
                order, borders = np.argsort(part, kind="stable"), np.cumsum(np.bincount(part, minlength=parts))[:-1]
                some = [(p, k, v) for p, (k, v) in enumerate(zip(np.split(keys[order], borders), np.split(node[order], borders))) if len(k)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([p for p, _, _ in some], pa.int32()), pa.array([k.tobytes() for _, k, _ in some], pa.binary()),
                    pa.array([squeezed(np.diff(v, prepend=np.int64(0))) for _, _, v in some], pa.binary())], names=["part", "keys", "nodes"])
                lo = hi
    return run


def _shared(lists: pa.Table) -> pa.Table:
    """(a, b): each document that gives a key of the part, next to the smallest one that gives it, too."""
    keys = np.concatenate([np.frombuffer(k.as_buffer(), np.uint64) for k in lists["keys"]])
    nodes = np.concatenate([spread_out(v, np.int64).cumsum() for v in lists["nodes"]])
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    first = np.append(True, keys[1:] != keys[:-1])
    again = ~(first & np.append(first[1:], True))       # of keys that occur more than once
    nodes, first = nodes[again], first[again]
    at = np.flatnonzero(first)
    hub = np.repeat(np.minimum.reduceat(nodes, at), np.diff(np.append(at, len(nodes)))) if len(at) else nodes
    return pa.table({"a": hub[hub != nodes], "b": nodes[hub != nodes]})


def families(sketches: DataFrame) -> DataFrame:
    """node, root for the documents that share a key with another. Keys move once, as packed lists: most occur once and go no further."""
    holders = sketches.where("doc_id is not null").select("doc_id", "keys")
    total = holders.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    parts = max(int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // KEYS))
    lists = holders.mapInArrow(_key_lists(parts), "part int, keys binary, nodes binary").repartitionById(parts, F.col("part"))
    return components(lists.groupBy("part").applyInArrow(_shared, "a long, b long"))


def join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links lead to) for every row of docs."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stage(docs.mapInArrow(_sketch_batches(n, percent), "doc_id long, n long, class binary, keys array<long>"), "ngram-sketches")
    reps = sketches.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    reps = stage(reps.where("rep is not null"), "class-reps")
    # one document stands for each class
    alone = reps.groupBy(F.col("rep").alias("node")).agg(F.max("n").alias("n"))
    kin = stage(families(sketches).join(alone, "node"), "families")
    size = kin.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    kin = kin.join(size, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    kin = stage(kin.select("node", F.col("root").alias("family"), "n", "block", "blocks"), "family-blocks")
    with _small_filters(spark):
        wanted = kin.where("n > 0").select("node")
        sets = stage(docs.join(wanted, F.col("doc_id") == F.col("node"), "left_semi").mapInArrow(_set_batches(n), "node long, grams binary"), "family-sets")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = kin.withColumn("with", other).select("node", "family", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    rows = sets.join(pairs, "node").select("family", "i", "j", "node", "block", "grams")
    rows = rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    links = rows.mapInPandas(_compare(percent), "a long, b long")
    roots = components(links.where("a <> b"))
    named = reps.join(roots, F.col("rep") == F.col("node"), "left").select("class", F.coalesce("root", "rep").alias("component"))
    out = sketches.select("doc_id", "n", "class").join(named, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Rows of docs without near copies: of each group the document with the smallest doc_id stays, once (of rows that share it the
    one whose text has the smallest hash). Rows without doc_id all stay."""
    kept = join(docs, n, percent).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    held = docs.join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi")
    one = held.groupBy(F.col("doc_id").alias("kept_id")).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64("text")).alias("row"))
    return one.select("row.*").unionByName(docs.where("doc_id is null"))
