"""Prefix trie against brute force over all prefixes and against SQL, and its defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.checker import compare, connect
from tidewatch.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, keys string, depth int, n int, item long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + ts[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def found(nodes):
    order = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    empty = hashlib.sha256(b"").hexdigest()
    return sorted(tuple(r[c] if c != "ends_sha256" else r[c] or empty for c in order) for r in nodes.collect())


def random_rows(rng, convs, depth, alphabet):
    rows = []
    for c in rng.sample(range(0, 4 * convs), convs):
        for t in range(rng.randint(1, depth)):
            rows.append((c, t, rng.choice(["user", None]) if rng.random() < 0.1 else "user", rng.choice(alphabet)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, depth, alphabet, parts", [
    (1, 400, 9, ["a", "bé", ""], 8), (2, 300, 30, ["x"], 8), (3, 60, 4, ["a", "b"], 211), (4, 500, 3, [f"t{i}" for i in range(200)], 5), (5, 1, 3, ["q"], 3)])
def test_equals_brute_force(spark, seed, convs, depth, alphabet, parts):
    rng = random.Random(seed)
    rows = random_rows(rng, convs, depth, alphabet)
    rows += [(None, 1, "user", "a"), (40_000, None, "user", "first"), (40_000, 0, None, None), (40_001, 0, "user", "x")] if seed == 1 else []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert found(prefix_trie.trie(prefix_trie.rebuild(table(spark, rows)))) == brute(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("cut", range(1, 12))
def test_partitions_anywhere_give_the_same_nodes(cut):
    """The union-find alone: sorted sequences, cut into runs of `cut`, contracted and merged."""
    rng = random.Random(cut)
    seqs = sorted({tuple(rng.choice([1, 2, 3]) for _ in range(rng.choice([0, 1, 2, 5, 6]))) for _ in range(40)})
    reps = rng.sample(range(1000), len(seqs))
    nodes, summaries = [], []
    for lo in range(0, len(seqs), cut):
        some = seqs[lo:lo + cut]
        arrays = [prefix_trie.pa.array(x, k) for x, k in (
            (reps[lo:lo + cut], prefix_trie.pa.int64()), ([1] * len(some), prefix_trie.pa.int64()), ([str(r) for r in reps[lo:lo + cut]], prefix_trie.pa.string()),
            ([[v for t in s for v in (t, -t)] for s in some], prefix_trie.pa.list_(prefix_trie.pa.int64())), ([list(s) for s in some], prefix_trie.pa.list_(prefix_trie.pa.int32())))]
        batch = prefix_trie.pa.RecordBatch.from_arrays(arrays, names=["rep", "n", "sha", "keys", "chars"])
        for out in prefix_trie._forest_batches(iter([batch.slice(0, 1), batch.slice(1)])):
            summaries += [out] if out.column("forest")[0].as_py() else []
            nodes += out.to_pylist()
    outer = [r for b in prefix_trie._outer_batches(iter(summaries)) for r in b.to_pylist()]
    above = {(r["block"], r["item"]): r["conv_id"] for r in outer if r["depth"] is None}
    nodes = [r for r in nodes if r["depth"] is not None] + [r for r in outer if r["depth"] is not None]
    convs = dict(zip(reps, seqs))
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    want = sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), sum(q[:-1] == p and len(q) > 0 for q in members),
                   sum(q[:len(p)] == p and not any(r[:-1] == q and r for r in members) for q in members),
                   sum((len(k) - 1) * q[-1] for q, k in members.items() if q and q[:len(p)] == p), next((str(c) for c in m if convs[c] == p), None)) for p, m in members.items())
    got = sorted((r["conv_id"], r["depth"], -1 if r["depth"] == 0 else above.get((r["block"], r["item"]), r["parent_conv_id"]), r["n_convs"], r["n_children"], r["n_leaves"],
                  r["saved_tokens"], r["ends_sha256"]) for r in nodes)
    assert got == want


def test_a_common_conversation_and_a_long_one(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = [(c, t, "user", f"t{t}") for c in range(7, 6000, 10) for t in range(8)] + [(9_999, t, "user", "z" * (t % 3)) for t in range(150)]
    got = found(prefix_trie.trie(prefix_trie.rebuild(table(spark, rows))))
    assert got == brute(rebuilt(rows))


def test_empty_table_and_turnless_conversation(spark):
    empty = table(spark, [(None, 1, "user", "a")]).where("conv_id > 0")
    assert prefix_trie.trie(prefix_trie.rebuild(empty)).count() == 0
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, 1, "user", "a")]
    assert found(prefix_trie.trie(prefix_trie.rebuild(table(spark, rows)))) == brute({c: []}) == brute(rebuilt(rows))


def test_ties_and_repeats(spark):
    """Turns that tie follow a hash, whatever order they are read in; repeated rows are repeated turns."""
    rows = [(206, 0, "user", x) for x in "abcabcdef"] + [(206, 1, "user", "z")]
    runs = [found(prefix_trie.trie(prefix_trie.rebuild(table(spark, r)))) for r in (rows, rows[::-1])]
    assert runs[0] == runs[1] and max(r[1] for r in runs[0]) == len(rebuilt(rows)[206])


def test_query_equals_sql(spark):
    got = queries.op12_prefix_trie(spark, "/root/testdata/sf0.01")
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert compare(got, connect("/root/testdata/sf0.01"), queries.ORACLES["op12_prefix_trie"]) is None
