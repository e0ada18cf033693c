"""Language-model scoring by stupid backoff over corpus counts, leaving each text's own occurrences out.

A word's score is the count of the longest n-gram that ends in it over the count of that n-gram without the word, times BACKOFF for
every order given up; counts are those of the whole table less the text's own, so a text is scored by the others. A word that no
other text has gets BACKOFF ** order over the number of words. A text's score is the sum of the logarithms.

The counts are relations by hash: every block of texts lists its distinct n-grams per hash part, with their counts; a part adds
the lists of all blocks and answers each with the totals; blocks join the answers and sum per text. An n-gram crosses the
network once per block that has it, as a four-byte step from the one before, instead of once per occurrence. Blocks and parts are sized by the input, and
a frequent n-gram is one entry per block.

Defined cases: null, empty and wordless texts have no words and score 0; equal texts in two rows are two texts and see each other;
an empty table gives no rows; columns besides doc_id and text are not looked at. Within a part n-grams are told apart by 40 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt

ORDER = 3
BACKOFF = 0.4
BLOCK = 4 << 20        # bytes of text of a block
PART = 1 << 20         # words of the input per hash part
FINGER = 5             # bytes that tell n-grams of a part apart
OUT = "doc_id long, n_words long, log_score double, " + ", ".join(f"n_order{k} long" for k in range(ORDER + 1))


def _squeeze(counts: np.ndarray) -> bytes:
    """Counts as bytes, with those from 255 on spelled out behind."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.uint64).tobytes()


def _unsqueeze(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, np.uint64, offset=n).astype(np.int64)
    return out


def _deltas(fingers: np.ndarray) -> bytes:
    """Ascending numbers as four-byte steps, with larger steps spelled out behind."""
    step = np.diff(fingers, prepend=np.uint64(0))
    top = np.uint64((1 << 32) - 1)
    return np.minimum(step, top).astype(np.uint32).tobytes() + step[step >= top].tobytes()


def _undeltas(data: bytes, n: int) -> np.ndarray:
    step = np.frombuffer(data, np.uint32, n).astype(np.uint64)
    step[step == (1 << 32) - 1] = np.frombuffer(data[4 * n:], np.uint64)
    return np.cumsum(step, dtype=np.uint64)


class Block:
    """n-grams of a block of texts: `grams` distinct and sorted by part, `at[k]` the place of the n-gram of k + 1 words that ends
    at each word (-1 where the text has too few words before), `own[k]` how often the text has it."""

    def __init__(self, table: pa.Table, parts: int, order: int = ORDER):
        pieces = []
        for batch in table.select(["text"]).to_batches():
            for _, buf, at in bt.chunks(batch, "text"):
                w = bt.Words(buf, at)
                pieces.append((w.hashes(), w.per))
        h = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in pieces)])
        self.per = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in pieces)])
        self.first = np.concatenate([[0], np.cumsum(self.per)])
        doc = np.repeat(np.arange(len(self.per)), self.per)
        place = np.arange(len(h)) - self.first[doc] if len(h) else np.zeros(0, np.int64)
        ends, values = [], []
        for k in range(order):
            end = np.flatnonzero(place >= k)
            ends.append(end)
            values.append(bt.mix64(bt.gram_hashes(h, k + 1)[end - k] + np.uint64(k)) if len(end) else np.zeros(0, np.uint64))
        every = np.concatenate(values)
        part = (every & np.uint64(0xFFFFFF)) % np.uint64(parts)
        finger = every >> np.uint64(64 - 8 * FINGER)
        # one sort: part in the top bits, the fingerprint below
        key, back, self.tf = np.unique((part << np.uint64(8 * FINGER)) | finger, return_inverse=True, return_counts=True)
        self.part = (key >> np.uint64(8 * FINGER)).astype(np.int64)
        self.finger = key & np.uint64((1 << 8 * FINGER) - 1)
        cut = np.cumsum([0] + [len(v) for v in values])
        self.at, self.own = [], []
        for k, end in enumerate(ends):
            at = np.full(len(h), -1, np.int64)
            at[end] = back[cut[k]:cut[k + 1]]
            own = np.zeros(len(h), np.int64)
            if len(end):
                _, inv, n = np.unique(doc[end] * np.int64(len(key)) + at[end], return_inverse=True, return_counts=True)
                own[end] = n[inv]
            self.at.append(at)
            self.own.append(own)

    def lists(self):
        """(part, fingerprints, counts) of each part that the block has n-grams of."""
        parts, begin = np.unique(self.part, return_index=True)
        for p, a, b in zip(parts, begin, np.append(begin[1:], len(self.part))):
            yield int(p), int(b - a), _deltas(self.finger[a:b]), _squeeze(self.tf[a:b])

    def scores(self, totals: np.ndarray, words: int) -> list[np.ndarray]:
        """Sum of logarithms per text, and words scored at order 0 (unseen), 1, 2, ..."""
        n, order = len(self.at[0]), len(self.at)
        rest = [np.where(a >= 0, totals[a] - own, 0) if len(totals) else a * 0 for a, own in zip(self.at, self.own)]
        size = np.repeat(words - self.per, self.per)
        value = order * math.log(BACKOFF) - np.log(np.maximum(size, 1))
        used = np.zeros(n, np.int64)
        for k in range(order):
            below = size if k == 0 else np.concatenate([[0], rest[k - 1][:-1]]) if n else rest[k - 1]
            seen = rest[k] > 0
            value = np.where(seen, np.log(np.maximum(rest[k], 1) / np.maximum(below, 1)) + (order - 1 - k) * math.log(BACKOFF), value)
            used[seen] = k + 1
        # a text's first words have no longer history to give up
        place = np.arange(n) - np.repeat(self.first[:-1], self.per)
        value -= np.maximum(order - 1 - place, 0) * math.log(BACKOFF)
        return [bt.doc_sums(value.astype(np.float64), self.first), *(bt.doc_sums(used == k, self.first) for k in range(order + 1))]


def _sizes(batches):
    for batch in batches:
        size = words = 0
        for _, buf, at in bt.chunks(batch, "text"):
            size, words = size + len(buf), words + len(bt.Words(buf, at))
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([words])], names=["size", "words"])


def _answer(table: pa.Table) -> pa.Table:
    """The totals of a part, for each block's list."""
    size = table.column("size").to_pylist()
    fingers = [_undeltas(v, n) for v, n in zip(table.column("fingers").to_pylist(), size)]
    tf = np.concatenate([_unsqueeze(c, n) for c, n in zip(table.column("counts").to_pylist(), size)])
    _, back = np.unique(np.concatenate(fingers), return_inverse=True)
    total = np.bincount(back, tf).astype(np.int64)[back]
    cut = np.cumsum([0, *size])
    return pa.table({"block": table.column("block"), "part": table.column("part"),
                     "totals": pa.array([_squeeze(total[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())})


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_score, and how many words were scored at order 0 (unseen elsewhere) to ORDER."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size, words = docs.select("text").mapInArrow(_sizes, "size long, words long").agg(F.sum("size"), F.sum("words")).first()
    size, words = size or 0, words or 0
    blocks, parts = max(1, math.ceil(size / BLOCK)), max(1, math.ceil(words / PART))
    blocked = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def ask(key, table):
        rows = list(Block(table, parts).lists())
        cols = list(zip(*rows)) or [()] * 4
        return pa.table({"block": pa.array([key[0].as_py()] * len(rows), pa.int64()), "part": pa.array(cols[0], pa.int64()),
                         "size": pa.array(cols[1], pa.int64()), "fingers": pa.array(cols[2], pa.binary()),
                         "counts": pa.array(cols[3], pa.binary())})

    def tell(table, answers):
        block = Block(table, parts)
        by_part = dict(zip(answers.column("part").to_pylist(), answers.column("totals").to_pylist()))
        present, n = np.unique(block.part, return_counts=True)
        totals = np.concatenate([np.zeros(0, np.int64), *(_unsqueeze(by_part[p], k) for p, k in zip(present.tolist(), n.tolist()))])
        value, *orders = block.scores(totals, words)
        return pa.table({"doc_id": table.column("doc_id"), "n_words": pa.array(block.per), "log_score": pa.array(value),
                         **{f"n_order{k}": pa.array(o) for k, o in enumerate(orders)}})

    asked = blocked.groupBy("block").applyInArrow(ask, "block long, part long, size long, fingers binary, counts binary")
    answers = asked.groupBy("part").applyInArrow(_answer, "block long, part long, totals binary")
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tell, OUT)
