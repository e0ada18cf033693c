"""Toxicity: class-conditional Kneser-Ney models compared by length-normalised log-likelihood.

Two interpolated bigram models, one of toxic and one of ordinary labelled texts. A word's probability after another is its discounted
share of that word's pairs; the discounted rest goes to the class's words by continuation counts (how many different words precede
one), their rest to class stems (leading bytes), theirs to stems by continuation counts over both classes, so an expression rare in
both says little. A word's evidence is the difference of its two log-probabilities, taken from the text's median word (which takes out the
language) and beyond a dead band; a text's margin is the mean over its words. Discounts are chosen from a grid that holds the usual
one below 1 for words and for pairs, and larger ones, which are counted in units of the smaller class and scaled by class size for
the other, so that a rare word is not held against the class with less text. The choice, and a logistic curve over the margin that
gives the score, are fitted on labelled rows that the counts have not seen.

Words are hashed into tables of fixed size, pairs into another (colliding pairs share a count); these are all that is sent to the
tasks. Tasks add up the pairs of their texts before anything is shuffled, and texts are read again instead of being kept. At most
LABEL_ROWS labelled rows are learned from, picked by hash.

Defined cases: a null, empty or wordless text has margin 0 and the score of that; very long texts are scored whole; equal texts get
equal scores, rows that repeat a doc_id each their own; with no labelled rows every score is 0, and with labels of one class only the
curve follows that class; an empty table gives an empty result; a document with two labels counts as toxic if either says so; columns
besides doc_id, text and toxic are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt
from tidewatch.sources.storage import stage

LABEL_ROWS = 24_000
CALIBRATE = 4          # one labelled row in so many sets the curve, the others the counts
WORD_BITS, PAIR_BITS = 18, 20
START = 1 << WORD_BITS  # stands before a text's first word
STEM = 4               # leading bytes that stand for a rare word
USUAL = 0.75           # the Kneser-Ney discount
WORD_DISCOUNTS = (USUAL, 2.0, 6.0, 18.0, 36.0, 54.0)
PAIR_FACTOR = 32.0     # the large discount of a pair, in discounts of a word: pairs are rarer and chance shows more
DEAD_BAND = 1.0        # nats
KEYS = 300_000         # pairs and stems that a task adds up before it hands them on; Spark adds up what several such parts share
HANDED = 1 << 16       # rows of an Arrow batch of them


def choices(totals) -> list[tuple[np.ndarray, np.ndarray]]:
    """Discounts of words and pairs to choose from, each for (ordinary, toxic). A discount below 1 is the same for both."""
    scale = np.asarray(totals, float) / min(totals)
    usual = np.full(2, USUAL)
    words = [usual if d < 1 else d * scale for d in WORD_DISCOUNTS]
    return [(d, usual) for d in words] + [(d, PAIR_FACTOR * d) for d in words[1:]]


class Tokens:
    """Cells of a run of texts: words, the words before them (START at a text's beginning), pairs and stems."""

    def __init__(self, buf: np.ndarray, at: np.ndarray):
        self.words = w = bt.Words(buf, at)
        self.word = _cell(w.hashes(bt.LOWER))
        self.before = np.full(len(self.word), START, np.int64)
        self.before[1:] = self.word[:-1]
        self.before[w.first[:-1][w.per > 0]] = START
        self.pair = pair_cell(self.before, self.word)
        self.stem = _cell(bt.mix64(bt.span_hashes(bt.LOWER[buf], w.start, np.minimum(w.start + STEM, w.end)))) if len(self.word) else self.word


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def pair_cell(before, word):
    return (word << (PAIR_BITS - WORD_BITS)) ^ before


def _count_batches(batches):
    """(before, word) and (-1 - stem, word) with the occurrences in both classes, added up over the task's texts."""
    keys, counts = np.zeros(0, np.int64), np.zeros((2, 0), np.int64)
    for batch in batches:
        toxic = batch.column(batch.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, buf, at in bt.chunks(batch, "text"):
            t = Tokens(buf, at)
            kind = toxic[lo + t.words.doc]
            key = np.concatenate([keys, t.before << 32 | t.word, (-1 - t.stem) << 32 | t.word])
            keys, where = np.unique(key, return_inverse=True)
            old, new = where[:counts.shape[1]], where[counts.shape[1]:]
            counts = np.stack([np.bincount(old, counts[k], len(keys)) + np.bincount(new, np.tile(kind == k, 2), len(keys)) for k in (0, 1)]).astype(np.int64)
            if len(keys) > KEYS:
                yield from _counted(keys, counts)
                keys, counts = np.zeros(0, np.int64), np.zeros((2, 0), np.int64)
    yield from _counted(keys, counts)


def _counted(keys, counts):
    for lo in range(0, len(keys), HANDED):
        k = keys[lo:lo + HANDED]
        yield pa.RecordBatch.from_arrays([pa.array((k >> 32).astype(np.int32)), pa.array((k & 0xFFFFFFFF).astype(np.int32)), *(pa.array(c[lo:lo + HANDED]) for c in counts)],
                                         names=["v", "w", "c0", "c1"])


def _columns(found: DataFrame) -> dict[str, np.ndarray]:
    """A table by cell in the driver, as Arrow: no object per row, and four bytes a number."""
    kinds = {"cell": "int"}
    table = found.select(*[F.col(c).cast(kinds.get(c, "float")) for c in found.columns]).toArrow()
    return {c: table.column(c).to_numpy() for c in table.column_names}


class Model:
    """Counts of both classes; index 0 ordinary, 1 toxic. Chain: pair, word, stem, stem by counts shared by the classes."""

    def __init__(self, counts: DataFrame):
        """counts: v, w, c0, c1. Only tables by cell come to the driver."""
        size = 1 << WORD_BITS
        two = counts.where("v >= 0")
        words = stage(two.groupBy(F.col("w").alias("cell")).agg(
            F.count("*").alias("types"), *[F.count_if(F.col(f"c{k}") > 0).alias(f"n{k}") for k in (0, 1)]), "toxic-words")
        types = words.select(F.col("cell").alias("w"), "types")
        stems = counts.where("v < 0").join(types, "w").groupBy((-1 - F.col("v")).alias("cell")).agg(
            F.sum("types").alias("types"), *[F.sum(f"c{k}").alias(f"n{k}") for k in (0, 1)])
        stems = _columns(stems)
        words = _columns(words)
        pairs = _columns(two.groupBy(pair_cell_sql().alias("cell")).agg(*[F.sum(f"c{k}").alias(f"n{k}") for k in (0, 1)]))
        self.word, self.stem = (self._table(t, size) for t in (words, stems))
        self.pair = self._table(pairs, 1 << PAIR_BITS)
        types = np.zeros(size)
        types[stems["cell"]] = stems["types"]
        self.shared = self._shared(types)
        self.choices = choices(np.maximum(self.stem.sum(axis=1), 1))
        taken = [F.sum(F.least(F.col(f"c{k}"), F.lit(float(d[k])))).alias(f"t{k}_{i}") for i, d in enumerate(self._pair_discounts()) for k in (0, 1)]
        firsts = _columns(two.groupBy(F.col("v").alias("cell")).agg(*[F.sum(f"c{k}").alias(f"n{k}") for k in (0, 1)], *taken))
        self.first = self._table(firsts, size + 1)
        self.taken = [self._table(firsts, size + 1, f"t{{}}_{i}") for i in range(len(self._pair_discounts()))]
        self.choice, self.curve, self.levels = 0, np.zeros(3), []

    @staticmethod
    def _table(found, size: int, name: str = "n{}") -> np.ndarray:
        out = np.zeros((2, size), np.float32)
        for k in (0, 1):
            out[k, found["cell"]] = found[name.format(k)]
        return out

    def _pair_discounts(self) -> list[np.ndarray]:
        """The different ones among the choices."""
        out = []
        for _, d in self.choices:
            if not any(np.array_equal(d, o) for o in out):
                out.append(d)
        return out

    def settle(self, choice: int) -> None:
        """Keep one choice and what it needs."""
        words, pairs = self.choices[choice]
        self.taken = [t for t, d in zip(self.taken, self._pair_discounts()) if np.array_equal(d, pairs)]
        self.choices, self.choice, self.levels = [(words, pairs)], 0, []

    @staticmethod
    def _shared(types: np.ndarray) -> np.ndarray:
        """Continuation counts of stems over both classes, with a little for stems never met."""
        n = np.maximum(types - USUAL, 0)
        free = max(types.sum() - n.sum(), 1.0)
        return (n + free / len(n)) / (n.sum() + free)

    @staticmethod
    def _left(counts: np.ndarray, d: float) -> np.ndarray:
        return np.maximum(counts - d, 0).astype(np.float64)

    def _word_levels(self, k: int, d: float) -> tuple[float, float, float, float]:
        """Of stems and of words: the total, and the share of it that the discount frees for the next level."""
        out = []
        for table in (self.stem[k], self.word[k]):
            total = max(float(table.sum()), 1.0)
            out += [total, max(1 - self._left(table, d).sum() / total, 1e-6)]
        return tuple(out)

    def prepared(self) -> None:
        """Work out the levels once per task: numbers only, a table for each choice would take most of a worker's memory."""
        self.levels = self.levels or [[self._word_levels(k, float(d[k])) for k in (0, 1)] for d, _ in self.choices]

    def logs(self, t: Tokens, choice: int) -> list[np.ndarray]:
        """Log-probabilities of every word, of the ordinary and of the toxic model."""
        discounts = self._pair_discounts()
        word_discount, pair_discount = self.choices[choice]
        taken = next(x for x, d in zip(self.taken, discounts) if np.array_equal(d, pair_discount))
        out = []
        for k in (0, 1):
            total, free, types, spare = self.levels[choice][k]
            d = float(word_discount[k])
            stem = self._left(self.stem[k][t.stem], d) / total + free * self.shared[t.stem]
            base = self._left(self.word[k][t.word], d) / types + spare * stem
            seen = self.first[k][t.before].astype(np.float64)
            two = (np.maximum(self.pair[k][t.pair] - pair_discount[k], 0) + taken[k][t.before] * base) / np.maximum(seen, 1)
            out.append(np.log(np.where(seen > 0, two, base)))
        return out

    def margins(self, t: Tokens, choice: int) -> np.ndarray:
        """Per text: mean over words of the difference of log-probabilities, less its median."""
        first, n = t.words.first, t.words.per
        if not len(t.word):
            return np.zeros(len(n))
        logs = self.logs(t, choice)
        gap = logs[1] - logs[0]
        middle = gap[np.lexsort((gap, t.words.doc))][np.minimum(first[:-1] + n // 2, len(gap) - 1)]
        gap -= np.repeat(middle, n)
        gap = np.sign(gap) * np.maximum(np.abs(gap) - DEAD_BAND, 0)
        return bt.doc_sums(gap, first) / np.maximum(n, 1)

    @staticmethod
    def _inputs(margins, n):
        return np.stack([np.ones(len(n)), margins, margins * np.sqrt(n)], axis=1)

    def score(self, margins: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._inputs(margins, n) @ self.curve, -30, 30)))

    def calibrate(self, margins: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> None:
        """Logistic fit by Newton steps with a small ridge."""
        x = self._inputs(margins, n)
        scale = np.maximum(np.abs(x).mean(0), 1e-9)
        x, beta = x / scale, np.zeros(3)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            grad = x.T @ (toxic - p) - 1e-2 * beta
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), grad)
            beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        self.curve = beta / scale


def pair_cell_sql():
    return F.shiftleft("w", PAIR_BITS - WORD_BITS).bitwiseXOR(F.col("v"))


def _margin_batches(model, keep):
    """Columns `keep` with each text's margins, one for each choice of discounts, and number of words."""
    def run(batches):
        model.prepared()
        for batch in batches:
            some = range(len(model.choices))
            parts = [np.zeros((len(some) + 1, 0))]
            for _, buf, at in bt.chunks(batch, "text"):
                t = Tokens(buf, at)
                parts.append(np.stack([*(model.margins(t, i) for i in some), t.words.per]))
            out = np.concatenate(parts, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(x) for x in out],
                                             names=[*keep, *(f"margin{i}" for i in some), "n"])
    return run


def _chosen(docs: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """label_id and toxic of up to LABEL_ROWS labelled documents, by hash. Only about as many reach the ordering."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("long").alias("toxic"))
    found = stage(docs.select("doc_id").distinct().join(known, F.col("doc_id") == F.col("label_id"), "left_semi").join(
        known, F.col("doc_id") == F.col("label_id")).select("label_id", "toxic", F.xxhash64("label_id", F.lit(seed)).alias("h")), "toxic-labelled")
    share = min(1.0, 1.2 * LABEL_ROWS / max(found.count(), 1))
    if share < 1:
        found = found.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)))
    return stage(found.orderBy("h", "label_id").limit(LABEL_ROWS).select("label_id", "toxic"), "toxic-rows")


def fit(docs: DataFrame, labels: DataFrame, learn: F.Column | None = None, seed: int = 3) -> Model | None:
    """A calibrated model from labelled rows; `learn` says which of docs may be learned from."""
    rows = docs.select("doc_id", "text") if learn is None else docs.where(learn).select("doc_id", "text")
    chosen = F.broadcast(_chosen(rows, labels, seed))       # at most LABEL_ROWS rows of two numbers
    rows = rows.join(chosen, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(CALIBRATE)) == 0
    counts = rows.where(~part).select("text", "toxic").mapInArrow(_count_batches, "v int, w int, c0 long, c1 long")
    counts = stage(counts.groupBy("v", "w").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "toxic-counts")
    if counts.isEmpty():
        return None
    model = Model(counts)
    names = [f"margin{i}" for i in range(len(model.choices))]
    seen = rows.where(part).mapInArrow(_margin_batches(model, ["toxic"]), f"toxic long, {', '.join(n + ' double' for n in names)}, n double").toPandas()
    toxic, words = seen["toxic"].to_numpy(float), seen["n"].to_numpy()
    best, best_loss = None, np.inf
    for i, name in enumerate(names):
        model.calibrate(seen[name].to_numpy(), words, toxic)
        p = np.clip(model.score(seen[name].to_numpy(), words), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(toxic > 0, np.log(p), np.log(1 - p))) if len(p) else 0.0
        if loss < best_loss:
            best, best_loss = (i, model.curve), loss
    model.settle(best[0])
    model.curve = best[1]
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, margin, n, score (0 to 1) and predicted (1 from 0.5 on) for every row of docs."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("margin"), F.lit(0.0).alias("n"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    out = docs.select("doc_id", "text").mapInArrow(_margin_batches(model, ["doc_id"]), "doc_id long, margin0 double, n double").withColumnRenamed("margin0", "margin")
    a, b, c = (float(x) for x in model.curve)
    z = F.lit(a) + F.lit(b) * F.col("margin") + F.lit(c) * F.col("margin") * F.sqrt("n")
    p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return out.withColumn("score", F.round(p, 9)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, with all their columns, that are not predicted toxic."""
    if model is None:
        return docs
    margins = _margin_batches(model, [])

    def run(batches):
        for batch in batches:
            found = next(iter(margins([batch])))
            yield batch.filter(pa.array(np.round(model.score(*(c.to_numpy(zero_copy_only=False) for c in found.columns)), 9) < 0.5))

    return docs.mapInArrow(run, docs.schema)
