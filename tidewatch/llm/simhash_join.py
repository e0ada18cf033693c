"""SimHash near-copies by the general pigeonhole principle.

A text's fingerprint has 64 bits, each the majority of that bit over the XXH64 hashes of all its word shingles, repeats included.
Two fingerprints link when few bits differ. The 64 positions are dealt to m partitions so that correlated bits lie together. If
two fingerprints differ in at most `distance` bits and a fingerprint x is given thresholds t_1 .. t_m of -1 or more with a sum of
distance - m + 1, then in some partition they differ in at most t_i bits. So x probes partition i with all values within t_i of
its own (none for -1), finds every partner there, and the whole fingerprints decide. Every fingerprint gets the thresholds of
least cost: a dynamic program over the partitions adds up probes and estimated candidates, taken from counts of all fingerprints
over pieces of each partition. The number of partitions is the one whose costs over all fingerprints are least.

Equal fingerprints are one class from the start. A value that many fingerprints share is split into blocks, block against block, and
a block pair returns a spanning forest of its links, not the links, so a large group of near copies gives few rows.

Defined cases: a null, empty or wordless text has fingerprint zero, which links like any other; with fewer words than a shingle the
whole sequence is one shingle; very long texts are hashed whole, a run of shingles at a time; a class is a fingerprint, so rows that
repeat a doc_id are each judged by their own text (two classes with the same smallest doc_id count as one); a row without doc_id
has a fingerprint and no component; an empty table gives an empty result; columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt
from tidewatch.llm.components import components
from tidewatch.sources.storage import stage

SEED = 42            # of XXH64
RUN = 1 << 16        # shingles whose bits are counted at once
PIECE = 11           # bits of a piece of a partition, over which fingerprints are counted
ADDERS = 8           # tasks that add up what the others counted
PROBE_COST = 30.0    # a probe row, in comparisons
BLOCK = 4096         # fingerprints of a block of a frequent value
PAIRS = 1 << 21      # comparisons made at once


def fingerprint(text: bytes, n: int) -> int:
    """Majority bits of the hashes of all n-word shingles of a text, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    k = min(n, len(words))
    cut, stop = start[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(cut), RUN):
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(cut[lo:lo + RUN], stop[lo:lo + RUN])], "<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(cut), bitorder="little").view("<u8")[0])


def _print_batches(n: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for lo, buf, at in bt.chunks(batch, "text"):
                data = buf.tobytes()
                prints = np.array([fingerprint(data[a:b], n) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(prints)), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """doc_id and fp (64 bits in a long) of every row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_print_batches(n), "doc_id long, fp long")


# --- partitions and thresholds ---------------------------------------------------------------------------------------


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _tally(prints: DataFrame, cells: int, count) -> np.ndarray:
    """Sum over all fingerprints of count(fps), an array of `cells` numbers. Each task adds up its own, a few tasks add up theirs."""
    def run(batches):
        total = np.zeros(cells)
        for batch in batches:
            total += count(_longs(batch, "fp").view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def add(batches):
        total = np.zeros(cells)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    rows = prints.select("fp").mapInArrow(run, "total binary").repartition(ADDERS).mapInArrow(add, "total binary").collect()
    return sum((np.frombuffer(r["total"]) for r in rows), np.zeros(cells))


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)


def _together(fps: np.ndarray) -> np.ndarray:
    out = np.zeros((64, 64))
    for lo in range(0, len(fps), RUN):
        b = _bits(fps[lo:lo + RUN]).astype(np.float32)
        out += b.T @ b
    return out.ravel()


def correlation(together: np.ndarray, total: float) -> np.ndarray:
    """Absolute correlation of the bits from how often two are set together."""
    p = np.diag(together) / total
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-24))
    out = np.abs(together / total - np.outer(p, p)) / spread
    np.fill_diagonal(out, 0)
    return out


def deal(related: np.ndarray, m: int) -> list[list[int]]:
    """The 64 positions in m partitions of even size, each grown around the position most related to what is left."""
    left, parts = set(range(64)), []
    for i in range(m):
        rest = sorted(left)
        part = [max(rest, key=lambda b: (related[b, rest].sum(), -b))]
        left.remove(part[0])
        while len(part) < 64 // m + (i < 64 % m):
            part.append(max(sorted(left), key=lambda b: (related[b, part].sum(), -b)))
            left.remove(part[-1])
        parts.append(sorted(part))
    return parts


def pick_bits(fps: np.ndarray, positions: list[int]) -> np.ndarray:
    """The bits at these positions side by side."""
    out = np.zeros(len(fps), np.uint64)
    for j, b in enumerate(positions):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(j)
    return out


def pieces(positions: list[int]) -> list[list[int]]:
    k = -(-len(positions) // PIECE)
    return [positions[len(positions) * i // k:len(positions) * (i + 1) // k] for i in range(k)]


def at_distance(counts: np.ndarray, most: int) -> np.ndarray:
    """For every value and every d <= most: how many fingerprints have a value that differs in exactly d bits."""
    near = np.zeros((most + 1, len(counts)))
    near[0] = counts
    value = np.arange(len(counts))
    for j in range(len(counts).bit_length() - 1):
        flipped = near[:, value ^ (1 << j)]
        near[1:] += flipped[:-1]
    return near


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of up to `radius` of `width` bits, by number of bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.uint64)


def ball_sizes(width: int, most: int) -> np.ndarray:
    sizes, term = [], 1
    for r in range(most + 1):
        sizes.append(term if r <= width else 0)
        term = term * (width - r) // (r + 1)
    return np.cumsum(sizes)


class Plan:
    """Partitions with the counts from which a fingerprint's thresholds follow."""

    def __init__(self, parts: list[list[int]], distance: int):
        self.parts, self.distance = parts, distance
        self.pieces = [pieces(p) for p in parts]
        self.cells = sum(1 << len(q) for p in self.pieces for q in p)

    def count(self, fps: np.ndarray) -> np.ndarray:
        """Fingerprints per value of each piece, one piece after the other."""
        return np.concatenate([np.bincount(pick_bits(fps, q).astype(np.int64), minlength=1 << len(q)) for p in self.pieces for q in p])

    def learn(self, counts: np.ndarray, total: float) -> None:
        self.total, self.near, at = total, [], 0
        for p in self.pieces:
            tables = []
            for q in p:
                tables.append(at_distance(counts[at:at + (1 << len(q))] / max(total, 1), self.distance))
                at += 1 << len(q)
            self.near.append(tables)

    def costs(self, fps: np.ndarray, i: int) -> np.ndarray:
        """Cost of partition i at thresholds -1 .. distance: probes, and candidates if its pieces were independent."""
        share = np.zeros((self.distance + 1, len(fps)))
        share[0] = 1
        for q, near in zip(self.pieces[i], self.near[i]):
            mine = near[:, pick_bits(fps, q).astype(np.int64)]
            share = np.stack([sum(share[a] * mine[d - a] for a in range(d + 1)) for d in range(self.distance + 1)])
        probes = ball_sizes(len(self.parts[i]), self.distance)
        out = np.zeros((self.distance + 2, len(fps)))
        out[1:] = np.cumsum(share, axis=0) * self.total + PROBE_COST * probes[:, None]
        return out

    def thresholds(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(partition x fingerprint) thresholds of least total cost, and that cost. The sum of t + 1 is distance + 1."""
        units = self.distance + 1
        best = np.full((units + 1, len(fps)), np.inf)
        best[0] = 0
        took = []
        for i in range(len(self.parts)):
            cost, new = self.costs(fps, i), np.full_like(best, np.inf)
            use = np.zeros(best.shape, np.int8)
            for s in range(units + 1):
                for u in range(s + 1):
                    c = best[s - u] + cost[u]
                    better = c < new[s]
                    new[s][better], use[s][better] = c[better], u
            best = new
            took.append(use)
        left, out = np.full(len(fps), units), np.zeros((len(self.parts), len(fps)), np.int64)
        for i in range(len(self.parts) - 1, -1, -1):
            out[i] = took[i][left, np.arange(len(fps))]
            left = left - out[i]
        return out - 1, best[units]


def make_plan(prints: DataFrame, total: int, distance: int) -> Plan:
    """The plan of least cost over all fingerprints, for 2 to distance + 1 partitions."""
    related = correlation(_tally(prints, 64 * 64, _together).reshape(64, 64), total)
    plans = [Plan(deal(related, m), distance) for m in range(2, max(distance, 1) + 2)]
    counts = _tally(prints, sum(p.cells for p in plans), lambda fps: np.concatenate([p.count(fps) for p in plans]))
    for p in plans:
        p.learn(counts[:p.cells], total)
        counts = counts[p.cells:]
    cost = _tally(prints, len(plans), lambda fps: np.array([p.thresholds(fps)[1].sum() for p in plans]))
    return plans[int(np.argmin(cost))]


# --- probing ----------------------------------------------------------------------------------------------------------


def _cell_batches(plan: Plan):
    """A row per partition under a fingerprint's own value (role 1: to be found, 2: probing, 3: both), and the other probes."""
    def run(batches):
        for batch in batches:
            fps, nodes = _longs(batch, "fp").view(np.uint64), _longs(batch, "node")
            for lo in range(0, len(fps), 1024):
                fp, node = fps[lo:lo + 1024], nodes[lo:lo + 1024]
                limit, _ = plan.thresholds(fp)
                for i, part in enumerate(plan.parts):
                    own = pick_bits(fp, part)
                    yield _cells(i, own, fp, node, np.where(limit[i] >= 0, 3, 1))
                    for t in np.unique(limit[i][limit[i] > 0]).tolist():
                        at, masks = np.flatnonzero(limit[i] == t), ball(len(part), t)[1:]
                        few = max(1, (1 << 18) // len(masks))
                        for k in range(0, len(at), few):
                            some = at[k:k + few]
                            who = np.repeat(some, len(masks))
                            yield _cells(i, (own[some][:, None] ^ masks).ravel(), fp[who], node[who], np.full(len(who), 2))
    return run


def _cells(i, value, fp, node, role):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(value), i, np.int32)), pa.array(value.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(node), pa.array(role.astype(np.int32))],
        names=["part", "value", "fp", "node", "role"])


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (a, b) connect: every node with the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, up = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while len(u):
        np.minimum.at(up, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(up, up[up]):
            up = up[up]
        u, v = up[u], up[v]
        u, v = u[u != v], v[u != v]
    away = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[up[away]], nodes[away]


def _links(group: np.ndarray, fp: np.ndarray, node: np.ndarray, role: np.ndarray, distance: int):
    """Links within groups of rows (sorted by group), each found from its smaller fingerprint, as a spanning forest."""
    found = [(np.zeros(0, np.int64),) * 2]
    x, y = np.flatnonzero(role & 2), np.flatnonzero(role & 1)
    first = np.searchsorted(group[y], group[x], "left")
    many = np.searchsorted(group[y], group[x], "right") - first
    edge = np.concatenate([[0], np.cumsum(many)])
    lo = 0
    while lo < len(x):
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + PAIRS, "right")) - 1)
        n = many[lo:hi]
        left = np.repeat(x[lo:hi], n)
        right = y[np.arange(edge[hi] - edge[lo]) + np.repeat(first[lo:hi] - (edge[lo:hi] - edge[lo]), n)]
        near = (fp[left] < fp[right]) & (np.bitwise_count(fp[left] ^ fp[right]) <= distance)
        near &= node[left] != node[right]
        if near.any():
            found.append(spanning(node[left[near]], node[right[near]]))
        lo = hi
    return spanning(*(np.concatenate(f) for f in zip(*found)))


def _verify_batches(distance: int):
    """Rows come sorted by cell; a cell that the batch may not have ended is kept for the next one."""
    names = ("part", "value", "i", "j")

    def links(rows):
        new = np.ones(len(rows[0]), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in rows[:4]], axis=0)
        a, b = _links(np.cumsum(new), rows[4].view(np.uint64), rows[5], rows[6], distance)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            rows = [_longs(batch, c) for c in (*names, "fp", "node", "role")]
            if not len(rows[0]):
                continue
            rows = rows if held is None else [np.concatenate(c) for c in zip(held, rows)]
            last = np.all([c == c[-1] for c in rows[:4]], axis=0)
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = [c[cut:] for c in rows]
            if cut:
                yield links([c[:cut] for c in rows])
        if held is not None:
            yield links(held)
    return run


def links(prints: DataFrame, plan: Plan) -> DataFrame:
    """a, b: edges that connect the nodes of all fingerprints (fp, node) within the distance."""
    cells = stage(prints.select("fp", "node").mapInArrow(_cell_batches(plan), "part int, value long, fp long, node long, role int"), "simhash-cells")
    size = cells.groupBy("part", "value").agg(F.sum((F.col("role") >= 2).cast("long")).alias("x"), F.sum((F.col("role") != 2).cast("long")).alias("y"))
    large = stage(size.where((F.col("x") > BLOCK) | (F.col("y") > BLOCK)).select(
        "part", "value", *[F.ceil(F.greatest(F.col(c), F.lit(1)) / BLOCK).alias(f"{c}s") for c in "xy"]), "simhash-large")
    blocked = cells.join(large, ["part", "value"], "left")
    mine, zero = F.xxhash64("fp"), F.lit(0).cast("long")
    # a row that probes and is found goes both ways; in its own block of both kinds it does so once
    probe = blocked.where("role >= 2 and (xs is not null or role = 2)").select(
        "part", "value", F.coalesce(F.pmod(mine, "xs"), zero).alias("i"), F.explode(F.sequence(zero, F.coalesce(F.col("ys") - 1, zero))).alias("j"),
        "fp", "node", F.lit(2).alias("role"))
    found = blocked.where("role <> 2 and (xs is not null or role = 1)").select(
        "part", "value", F.explode(F.sequence(zero, F.coalesce(F.col("xs") - 1, zero))).alias("i"),
        F.coalesce(F.pmod(mine, "ys"), zero).alias("j"), "fp", "node", F.lit(1).alias("role"))
    both = blocked.where("role = 3 and xs is null").select("part", "value", zero.alias("i"), zero.alias("j"), "fp", "node", "role")
    rows = probe.unionByName(found).unionByName(both)
    rows = rows.repartition("part", "value", "i", "j").sortWithinPartitions("part", "value", "i", "j")
    return rows.mapInArrow(_verify_batches(plan.distance), "a long, b long")


def join(docs: DataFrame, n: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links lead to) for every row of docs."""
    rows = stage(fingerprints(docs, n), "simhash-prints")
    classes = stage(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-classes")
    total = classes.count()
    if not total:
        return rows.withColumn("component_id", F.col("doc_id"))
    named = classes.withColumn("root", F.col("node"))
    if distance:
        roots = components(links(classes, make_plan(classes, total, distance)))
        named = classes.join(roots.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left").select(
            "fp", F.coalesce("root", "node").alias("root"))
    return rows.join(named.select("fp", "root"), "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id"))
