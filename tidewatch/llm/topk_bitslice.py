"""Exact top-k search by inner product on a bit-sliced index.

Vectors are quantised to integers and indexed in blocks: per dimension one bitmap for each binary digit, a bit per row. A query's
scores for a whole block are the sum of its dimensions' slices, shifted by the digits of its own components; slices of one weight
are added three at a time by bitwise full adders. From the most significant slice of the sum downward rows are taken or left as
a whole; the rows tied at the border are settled by id, so the result is exact. Blocks of queries meet blocks of rows; a block
gives at most k rows per query, and the best of these are the result.

Defined cases: vectors that are null, hold a null or a number that is not finite, or have no id take no part, neither as query
nor as row; an empty vector scores 0; a shorter vector counts as padded with zeros; rows with the id of the query are its own;
repeated ids are rows of their own; fewer than k rows give fewer results; columns besides the two named are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.storage import stage

SCALE = 64
ROWS, QUERIES = 16_384, 256       # rows of an index block and of a query block


def quantised(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and q: floor(scale * x) of every usable vector."""
    def whole(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", whole))
    return rows.select("vec_id", F.transform("e", lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("q"))


def pack(values: np.ndarray) -> tuple[int, np.ndarray]:
    """The lowest value and the slices (dimension, digit, word) of values above it; rows are bits of the words."""
    low = int(values.min()) if values.size else 0
    above = (values - low).astype(np.uint64)
    digits = max(int(above.max()).bit_length(), 1) if above.size else 1
    words = -(-max(len(values), 1) // 64)
    bits = np.zeros((values.shape[1], digits, words * 64), np.uint8)
    for b in range(digits):
        bits[:, b, :len(values)] = ((above >> np.uint64(b)) & np.uint64(1)).T
    return low, np.packbits(bits, axis=2, bitorder="little").view(np.uint64)


def score_slices(query: np.ndarray, low: int, slices: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of the query's scores, the least significant first, and the number to add to them."""
    size = np.abs(query)
    digits = slices.shape[1]
    full = (1 << digits) - 1
    # a negative component adds the complement: |q| * (full - u) = |q| * full + q * u
    shift = low * int(query.sum()) - full * int(size[query < 0].sum())
    stacks: dict[int, list[np.ndarray]] = {}
    for c in range(int(size.max()).bit_length() if len(size) else 0):
        has = (size >> c) & 1 == 1
        for part in (slices[has & (query > 0)], ~slices[has & (query < 0)]):
            if len(part):
                for b in range(digits):
                    stacks.setdefault(b + c, []).append(part[:, b])
    out, weight = [], 0
    while weight <= max(stacks, default=-1):
        m = np.concatenate(stacks.pop(weight)) if weight in stacks else np.zeros((1, slices.shape[2]), np.uint64)
        carry = stacks.setdefault(weight + 1, []) if len(m) > 1 else None
        while len(m) > 1:
            if len(m) == 2:
                carry.append(m[:1] & m[1:])
                m = m[:1] ^ m[1:]
                break
            t = len(m) // 3 * 3
            a, b, c = m[0:t:3], m[1:t:3], m[2:t:3]
            x = a ^ b
            carry.append((a & b) | (x & c))
            m = np.concatenate([x ^ c, m[t:]])
        out.append(m[0])
        weight += 1
    return out, shift


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(slices: list[np.ndarray], live: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest scores among the live ones; ties go to the smaller row."""
    taken, tied = np.zeros_like(live), live
    need = k
    for s in reversed(slices):
        high = tied & s
        n = _count(high)
        if n > need:
            tied = high
        else:
            taken = taken | high
            need -= n
            tied = tied & ~s
            if not need:
                break
    rows = _rows(taken)
    return np.concatenate([rows, _rows(tied)[:need]]) if need else rows


def values_at(slices: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.int64)
    for b, s in enumerate(slices):
        out += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
    return out


def search_block(query_ids, queries, ids, low, slices, k):
    """(query_id, vec_id, score) arrays: the k best of one block for each query. ids ascend."""
    live = np.zeros(slices.shape[2] * 64, np.uint8)
    live[:len(ids)] = 1
    live = np.packbits(live, bitorder="little").view(np.uint64)
    out = []
    for own, q in zip(query_ids, queries):
        total, shift = score_slices(q[:slices.shape[0]], low, slices)
        left = live
        lo, hi = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        if hi > lo:
            left = live.copy()
            for r in range(lo, hi):
                left[r >> 6] &= ~np.uint64(1 << (r & 63))
        rows = select_top(total, left, k)
        out.append((np.full(len(rows), own), ids[rows], values_at(total, rows) + shift))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def _matrix(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def top_k(table: DataFrame, is_query: F.Column, k: int = 20, rows: int = ROWS, queries: int = QUERIES, **columns) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that satisfies is_query (on vec_id) its k best other rows."""
    q = stage(quantised(table, **columns), "sliced-rows")
    total = q.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(F.size("q"))).first()
    width = total[2] or 0
    n_blocks, n_groups = max(1, math.ceil(total[0] / rows)), max(1, math.ceil(total[1] / queries))
    spread = F.xxhash64("vec_id", "q")

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        low, slices = pack(_matrix(frame["q"].tolist(), width))
        return pd.DataFrame({"block": frame["block"].iloc[:1], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "low": low,
                             "digits": slices.shape[1], "slices": [slices.tobytes()]})

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"group": frame["group"].iloc[:1], "query_ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
                             "matrix": [_matrix(frame["q"].tolist(), width).tobytes()]})

    blocks = stage(q.withColumn("block", F.pmod(spread, F.lit(n_blocks))).groupBy("block").applyInPandas(
        index, "block long, ids binary, low long, digits long, slices binary"), "slice-index")
    groups = q.where(is_query).withColumn("group", F.pmod(spread, F.lit(n_groups))).groupBy("group").applyInPandas(
        gather, "group long, query_ids binary, matrix binary")
    # the stated queries against all rows, block by block
    pairs = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    pairs = pairs.repartition(min(n_blocks * n_groups, 10_000), "group", "block").join(blocks, "block")

    def search(frames):
        for frame in frames:
            for r in frame.itertuples():
                ids, asked = np.frombuffer(r.ids, np.int64), np.frombuffer(r.query_ids, np.int64)
                slices = np.frombuffer(r.slices, np.uint64).reshape(width, r.digits, -1) if width else np.zeros((0, 1, -(-len(ids) // 64)), np.uint64)
                a, b, s = search_block(asked, np.frombuffer(r.matrix, np.int64).reshape(len(asked), width), ids, r.low, slices, k)
                yield pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    best = pairs.select("query_ids", "matrix", "ids", "low", "digits", "slices").mapInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
