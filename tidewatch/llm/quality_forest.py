"""Quality rules: an isolation forest on rule statistics.

One pass over the texts gives the rule counts. The trees' cuts are drawn over the box of all rows; every row labelled good (every row
where none are) is then counted in all trees, in the tasks. A region that holds less than one in `SCALE` of them is a leaf, so a row
whose average path to a leaf is short is an anomaly. The threshold is the score that best separates all labelled rows, with at most
`LOSS` of the good ones above it, from running counts per distinct score. Nothing is sampled.

Defined cases: a null, empty or wordless text has zero counts and fails the base rules; equal texts get equal verdicts; with no
rows there is no forest and no verdict; with no labels, or labels of one kind, everything that passes the base rules is kept;
a document with two labels counts by the lower one; columns besides doc_id, text and quality are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt
from tidewatch.operators.metrics import ranked_counts
from tidewatch.sources.storage import stage

TREES, SCALE, SEED = 96, 256, 5     # a tree tells regions apart down to one row in SCALE
LOSS = 0.01             # largest share of good labelled rows above the threshold

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def rule_counts(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """COUNTS of each text, one row each."""
    w = bt.Words(buf, at)
    out = np.zeros((len(at) - 1, len(COUNTS)), np.int64)
    out[:, 0] = w.per
    out[:, 1] = bt.doc_sums(~bt.WS[buf] & ((buf & 0xC0) != 0x80), at)
    out[:, 2] = bt.doc_sums(_SYMBOL[buf], at)
    if not len(w):
        return out
    # lines with a word, and those of them that have come before in the text
    cut = np.flatnonzero(buf == 10)
    start = np.unique(np.concatenate([at[:-1], cut + 1]))
    start = start[start < len(buf)]
    end = np.append(start[1:], len(buf))
    end = end - ((buf[end - 1] == 10) & (end > start))
    inked = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[inked], end[inked]
    owner = np.searchsorted(at, start, "right") - 1
    lines = bt.span_hashes(buf, start, end)
    order = np.lexsort((lines, owner))
    again = (lines[order][1:] == lines[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    out[:, 3] = np.bincount(owner[order][1:][again], minlength=len(out))
    out[:, 5] = np.bincount(owner, minlength=len(out))
    # words inside windows of five that occur twice or more in the text
    grams = bt.gram_hashes(w.hashes(), 5)
    if len(grams):
        inside = w.doc[:len(grams)] == w.doc[4:]
        key = bt.mix64(grams ^ (w.doc[:len(grams)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        place = np.flatnonzero(inside)
        order = place[np.argsort(key[place])]
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        edge = np.zeros(len(w) + 1, np.int64)
        edge[order[twice]] = 1
        edge[order[twice] + 5] -= 1
        out[:, 4] = bt.doc_sums((np.cumsum(edge) > 0)[:len(w)], w.first)
    return out


def features(rows: np.ndarray) -> np.ndarray:
    """FEATURES of rows of counts: roots of shares, so that small shares differ as visibly as large ones."""
    c = dict(zip(COUNTS, rows.T.astype(float)))
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack([np.log1p(c["word_chars"] / words), np.sqrt(c["n_symbols"] / chars), np.sqrt(c["n_dup_lines"] / lines),
                     np.sqrt(c["n_repeat_words"] / words)], axis=1)


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(COUNTS)), np.int64), *(rule_counts(buf, at) for _, buf, at in bt.chunks(batch, "text"))])


def _count_batches(batches):
    for batch in batches:
        rows = _counts(batch)
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in rows.T), *(pa.array(x) for x in features(rows).T)],
                                         names=["doc_id", *COUNTS, *FEATURES])


def count_rules(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS and FEATURES, one row per row of docs."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        _count_batches, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{f} double" for f in FEATURES)]))


def _usual_path(n: float) -> float:
    """Mean path of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def lay(low: np.ndarray, high: np.ndarray, trees: int = TREES, scale: int = SCALE, seed: int = SEED) -> list[dict]:
    """Trees as flat arrays, cut to the full depth: feature (-1 at a leaf), cut, left child (the right one is next to it) and depth.

    Cuts are drawn over a node's part of the box low..high, which holds all rows to be judged.
    """
    rng = np.random.default_rng(seed)
    return [_laid(rng, low, high, _deepest(scale)) for _ in range(trees)]


def _deepest(scale: float) -> int:
    return int(np.ceil(np.log2(max(scale, 2)))) + 3


def _laid(rng: np.random.Generator, low: np.ndarray, high: np.ndarray, deepest: int) -> dict:
    levels, lo, hi, size = [], low[None], high[None], 1
    for depth in range(deepest + 1):
        wide = hi > lo
        inner = wide.any(axis=1) & (depth < deepest)
        f = np.argmax(rng.random(wide.shape) * wide, axis=1)
        at = np.arange(len(f))
        cut = lo[at, f] + (hi[at, f] - lo[at, f]) * rng.random(len(f))
        levels.append({"feature": np.where(inner, f, -1).astype(np.int8), "cut": cut, "depth": np.full(len(f), depth, np.int8),
                       "left": np.where(inner, size + 2 * (np.cumsum(inner) - 1), 0).astype(np.int32)})
        lo, hi, f, cut = (np.repeat(x[inner], 2, axis=0) for x in (lo, hi, f, cut))
        at = np.arange(len(f))
        hi[at[::2], f[::2]] = cut[::2]
        lo[at[1::2], f[1::2]] = cut[1::2]
        size += len(f)
    return {k: np.concatenate([x[k] for x in levels]) for k in levels[0]}


def leaves(tree: dict, rows: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    node = np.zeros(len(rows), np.int64)
    while True:
        f = tree["feature"][node]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return node
        at = node[inner]
        node[inner] = tree["left"][at] + (rows[inner, f[inner]] > tree["cut"][at])


def weigh(tree: dict, counts: np.ndarray, scale: int = SCALE) -> dict:
    """The tree with path lengths, from the rows counted in each leaf: a node with less than one row in `scale` becomes a leaf."""
    n = counts.astype(float)
    for node in np.flatnonzero(tree["feature"] >= 0)[::-1]:     # children come after their parent
        n[node] = n[tree["left"][node]:tree["left"][node] + 2].sum()
    scale = min(scale, n[0])
    share = scale * n / max(n[0], 1.0)
    leaf = (tree["feature"] < 0) | (share < 1) | (tree["depth"] >= _deepest(scale))
    path = tree["depth"].astype(float)
    path[leaf] += [_usual_path(v) for v in share[leaf]]
    return {"feature": np.where(leaf, -1, tree["feature"]), "cut": tree["cut"], "left": tree["left"], "path": path, "usual": _usual_path(scale)}


def grow(rows: DataFrame, low: np.ndarray, high: np.ndarray, trees: int = TREES, scale: int = SCALE, seed: int = SEED) -> list[dict]:
    """Trees weighed by all rows (FEATURES). A task sends at most one count per leaf, and the driver receives as many."""
    laid = lay(low, high, trees, scale, seed)
    shipped = rows.sparkSession.sparkContext.broadcast(laid)

    def count(batches):
        totals = [np.zeros(len(t["cut"]), np.int64) for t in shipped.value]
        for batch in batches:
            points = _points(batch)
            for total, t in zip(totals, shipped.value):
                total += np.bincount(leaves(t, points), minlength=len(total))
        for i, total in enumerate(totals):
            leaf = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), i, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(total[leaf])],
                                             names=["tree", "leaf", "n"])

    sums = rows.select(*FEATURES).mapInArrow(count, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).toArrow()
    tree, leaf, n = (sums.column(c).to_numpy() for c in ("tree", "leaf", "n"))
    counts = [np.zeros(len(t["cut"]), np.int64) for t in laid]
    for i, c in enumerate(counts):
        c[leaf[tree == i]] = n[tree == i]
    return [weigh(t, c, scale) for t, c in zip(laid, counts)]


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)


def anomaly(trees: list[dict], rows: np.ndarray) -> np.ndarray:
    """2 ** -(mean path / usual path): near 1 for rows that a few splits set apart, 0.5 or less for the usual ones."""
    if not trees or not len(rows):
        return np.zeros(len(rows))
    total = sum(t["path"][leaves(t, rows)] for t in trees)
    usual = max(np.mean([t["usual"] for t in trees]), 1e-9)
    return 2.0 ** -(total / len(trees) / usual)


def threshold(scored: DataFrame, loss: float = LOSS) -> float:
    """The score above which rows (score, good) are rejected: most bad rows above it less good rows above it, with at most `loss` of the
    good. Between two scores, the middle; among equal gains, the lowest."""
    sums = scored.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not sums[0] or not sums[1]:
        return 2.0
    ok, bad = sums
    # tp and fp: good and bad rows down to a score, its own included; a cut just below it has those above
    curve = ranked_counts(scored.withColumn("good", F.col("good").cast("int")), "score", "good").select(
        "score", (F.col("tp") - F.col("pos")).alias("lost"), (F.col("fp") - F.col("neg")).alias("caught"))
    allowed = curve.where(F.expr(f"lost <= {loss!r}D * {ok}")).withColumn("gain", F.expr(f"caught / {bad}D - 2 * lost / {ok}D"))
    best = allowed.orderBy(F.col("gain").desc(), "score").first()["score"]
    above = scored.where(F.col("score") > best).agg(F.min("score")).first()[0]
    return float(best + 1 if above is None else (best + above) / 2)


def _scored(rows: DataFrame, trees: list[dict], keep: dict[str, str]) -> DataFrame:
    """The columns to keep (name and type) and the score of each row."""
    shipped = rows.sparkSession.sparkContext.broadcast(trees)

    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(anomaly(shipped.value, _points(batch)))],
                                             names=[*keep, "score"])

    return rows.mapInArrow(score, ", ".join([*(f"{c} {t}" for c, t in keep.items()), "score double"]))


def fit(rows: DataFrame, labels: DataFrame, seed: int = SEED) -> tuple[list[dict], float]:
    """The forest and its threshold, from all rows. rows: of count_rules. Only counts per leaf and single figures reach the driver."""
    rows = rows.where(f"not ({BASE_FAILED})")
    box = rows.agg(*[F.min(f) for f in FEATURES], *[F.max(f) for f in FEATURES]).first()
    if box[0] is None:
        return [], 2.0
    box = np.array(box, float).reshape(2, -1)
    known = labels.where("quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    known = stage(rows.join(known, rows.doc_id == known.label_id).select((F.col("quality") != 0).alias("good"), *FEATURES), "rule-labels")
    usual = known.where("good")
    trees = grow(rows if usual.isEmpty() else usual, box[0], box[1], seed=seed)
    return trees, threshold(stage(_scored(known, trees, {"good": "boolean"}), "rule-scores"))


def judge(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, the counts, base_failed, score (of the forest) and kept."""
    rows = stage(count_rules(docs), "rule-counts")
    trees, cut = fit(rows, labels, seed)
    out = _scored(rows, trees, {c: "long" for c in ("doc_id", *COUNTS)})
    return out.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", ~F.col("base_failed") & (F.col("score") <= cut))


def keep(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of docs, with all their columns, that pass the base rules and the forest."""
    trees, cut = fit(stage(count_rules(docs), "rule-counts"), labels, seed)
    shipped = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            rows = _counts(batch)
            c = dict(zip(COUNTS, rows.T))
            good = (c["n_words"] >= 10) & (100 * c["n_repeat_words"] <= 20 * c["n_words"]) & (anomaly(shipped.value, features(rows)) <= cut)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
