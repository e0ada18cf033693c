"""SimHash join against brute force, and its defined cases."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm import queries, simhash_join
from tests.llm.test_operators import EDGE, docs


def brute_print(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows, distance=4):
    """rows: (doc_id, fingerprint), doc_ids distinct -> smallest doc_id reachable."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, f in rows:
        for b, g in rows:
            if a < b and (f ^ g).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def near_copies(rng, groups, size, words=60):
    for _ in range(groups):
        base = [f"W{rng.randrange(3000)}" for _ in range(words)]
        for _ in range(rng.choice([1, 1, size])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(words)] = f"é{rng.randrange(3000)}"
            yield rng.choice([" ", "\t", " \n"]).join(w)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("block, pairs", [(4096, 1 << 21), (3, 5)])
def test_join_equals_brute_force(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(simhash_join, "BLOCK", block)
    rng = random.Random(9)
    rows = [(i, t, None, None) for i, t in enumerate(near_copies(rng, 40, 9))]
    rows += [(1000 + i, *e[1:]) for i, e in enumerate(EDGE)] + [(None, rows[0][1], None, None)]
    got = {(r.doc_id, r.fp): r.component_id for r in simhash_join.join(docs(spark, rows)).collect()}
    prints = [(i, brute_print(t)) for i, t, _, _ in rows]
    assert set(got) == {(i, signed(f)) for i, f in prints}
    want = brute_classes([(i, f) for i, f in prints if i is not None])
    assert all(got[(i, signed(f))] == (None if i is None else want[i]) for i, f in prints)
    assert len(set(want.values())) < len(want) - 20


def random_prints(spark, rng, kinds, distance):
    fps = []
    for _ in range(kinds):
        f = rng.getrandbits(64) & rng.getrandbits(64) if rng.random() < 0.5 else rng.getrandbits(64)
        fps += [f] + [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, distance + 2))) for _ in range(rng.choice([0, 3, 12]))]
    rows = [(i, f) for i, f in enumerate(dict.fromkeys(fps))]
    return rows, spark.createDataFrame([(signed(f), i) for i, f in rows], "fp long, node long")


@pytest.mark.parametrize("distance, m", [(1, 2), (4, 2), (4, 3), (4, 5), (7, 4), (7, 8)])
def test_probes_find_every_link(spark, distance, m):
    """Whatever the number of partitions, what the probes connect is what all pairs connect."""
    rng = random.Random(100 * distance + m)
    rows, table = random_prints(spark, rng, 40, distance)
    fps = np.array([f for _, f in rows], np.uint64)
    related = simhash_join.correlation(simhash_join._together(fps).reshape(64, 64), len(fps))
    plan = simhash_join.Plan(simhash_join.deal(related, m), distance)
    assert sorted(b for p in plan.parts for b in p) == list(range(64))
    plan.learn(plan.count(fps), len(fps))
    limits, _ = plan.thresholds(fps)
    assert (limits.sum(axis=0) == distance - m + 1).all() and limits.min() >= -1
    a, b = (np.array([r[c] for r in simhash_join.links(table, plan).collect()], np.int64) for c in "ab")
    up = dict(zip(*(x.tolist() for x in reversed(simhash_join.spanning(a, b)))))
    assert {i: up.get(i, i) for i, _ in rows} == brute_classes(rows, distance)


def test_thresholds_are_the_cheapest(spark):
    rng = random.Random(5)
    fps = np.array([rng.getrandbits(64) & ~(rng.getrandbits(16) << 8) for _ in range(300)], np.uint64)
    plan = simhash_join.Plan(simhash_join.deal(np.zeros((64, 64)), 3), 4)
    plan.learn(plan.count(fps), 1e8)
    limits, cost = plan.thresholds(fps)
    tables = [plan.costs(fps, i) for i in range(3)]
    for k in range(len(fps)):
        every = [tables[0][a, k] + tables[1][b, k] + tables[2][5 - a - b, k] for a in range(6) for b in range(6 - a)]
        assert cost[k] == pytest.approx(min(every)) == pytest.approx(sum(tables[i][limits[i, k] + 1, k] for i in range(3)))


def test_estimates_are_exact_within_a_piece():
    rng = random.Random(6)
    values = [rng.randrange(64) for _ in range(200)]
    near = simhash_join.at_distance(np.bincount(values, minlength=64).astype(float), 3)
    assert all(near[d, v] == sum((v ^ w).bit_count() == d for w in values) for d in range(4) for v in range(64))


def test_a_large_group_gives_few_links(spark, monkeypatch):
    """Thousands of fingerprints around one centre: no more rows than a forest per block pair."""
    monkeypatch.setattr(simhash_join, "BLOCK", 512)
    rng = random.Random(7)
    fps = list(dict.fromkeys(signed(sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))) for _ in range(3000)))
    table = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long")
    plan = simhash_join.make_plan(table, len(fps), 4)
    found = simhash_join.links(table, plan)
    n = found.count()
    assert n < 60 * len(fps)
    assert simhash_join.components(found).select("root").distinct().count() == 1


def test_empty_and_long_texts(spark):
    assert simhash_join.join(docs(spark, []).limit(0)).count() == 0
    assert simhash_join.join(docs(spark, [(None, "a b", None, None)])).collect()[0].component_id is None
    text = " ".join(f"w{i % 977}" for i in range(150_000))
    assert simhash_join.fingerprint(text.encode(), 4) == brute_print(text)


def test_query_columns(spark, tmp_path):
    rows = [(i, t, None, None) for i, t in enumerate(near_copies(random.Random(3), 10, 4))] + [(900, None, None, None)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_simhash_join(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    want = brute_classes([(i, brute_print(t)) for i, t, _, _ in rows])
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()} == {(i, f"{brute_print(t):016x}", want[i]) for i, t, _, _ in rows}


def test_a_hub_is_split(spark):
    """A node with most of the neighbours: the join with the smallest neighbours is a split skew join."""
    from tidewatch.llm import components as cc
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        edges = spark.range(1, 60_000).selectExpr("cast(0 as long) a", "id b").unionByName(spark.range(100_000, 110_000).selectExpr("id a", "id + 20000 b"))
        edges = cc.stage(edges, "hub-test")
        step = cc._large_star(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).unionByName(edges))
        step.collect()
        assert "skew=true" in step._jdf.queryExecution().toString()
        roots = dict(cc.components(edges).collect())
        assert len(roots) == 80_000 and all(roots[i] == 0 for i in range(60_000)) and roots[120_005] == 100_005
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
