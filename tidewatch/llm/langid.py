"""Language ID: a convolutional network on bytes, trained in numpy on labelled texts.

A text is cut into windows of WINDOW bytes, the last one padded. In each window filters of several widths slide over byte classes;
each filter's largest response feeds a softmax. A text's class probabilities are the mean over its windows, weighted by their
letters. All windows of all texts are scored, in batches; a byte's share of a filter is a table entry, and two neighbouring
entries are summed beforehand, so a filter of width four costs two look-ups a byte.

The network is trained on the driver: at most LABEL_ROWS labelled texts, picked by hash, give at most WINDOWS windows.

Defined cases: a null text and one without a letter get `und` with score 0; equal texts get equal predictions; without labelled
texts everything is `und`; columns besides doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16            # per width
LABEL_ROWS = 6_000
WINDOWS = 16_000
EPOCHS, BATCH, RATE = 4, 256, 0.1
CLASSES = 128
UNKNOWN = "und"

_CLASS = np.zeros(256, np.int64)            # 0 pads and stands for control bytes
_CLASS[33:128] = 1                          # signs
_CLASS[list(b" \t\n\r")] = 2
_CLASS[48:58] = 3
for _upper in range(26):
    _CLASS[65 + _upper] = _CLASS[97 + _upper] = 4 + _upper
_CLASS[128:192] = np.arange(30, 94)         # continuation bytes
_CLASS[192:256] = 94 + np.arange(64) // 2   # leading bytes
_LETTER = (_CLASS >= 4)


def windows(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte classes as rows of WINDOW, and the number of rows of each text."""
    size = np.diff(at)
    per = -(-size // WINDOW)
    begin = np.concatenate([[0], np.cumsum(per)])[:-1] * WINDOW
    out = np.zeros(int(per.sum()) * WINDOW, np.int64)
    out[np.arange(len(buf)) + np.repeat(begin - at[:-1], size)] = _CLASS[buf]
    return out.reshape(-1, WINDOW), per


class Net:
    """tables[i][j]: response of the filters of WIDTHS[i] to a class at offset j."""

    def __init__(self, names: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.names = names
        self.tables = [rng.normal(0, 0.3 / w, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32)
        self.bias = np.zeros(len(names), np.float32)

    def pair_tables(self):
        """For each width the summed entries of neighbouring offsets, two by two (the last alone if the width is odd)."""
        return [[(t[j][:, None] + t[j + 1][None]).reshape(-1, FILTERS) if j + 1 < len(t) else t[j] for j in range(0, len(t), 2)]
                for t in self.tables]

    def responses(self, x: np.ndarray, tables=None) -> list[np.ndarray]:
        """Per width: windows x places x filters."""
        tables = tables or self.pair_tables()
        two = x[:, :-1] * CLASSES + x[:, 1:]
        out = []
        for w, parts in zip(WIDTHS, tables):
            places = WINDOW - w + 1
            total = None
            for i, table in enumerate(parts):
                j = 2 * i
                got = table.take((x if j + 1 == w else two)[:, j:j + places], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            out.append(total)
        return out

    def probabilities(self, x: np.ndarray, tables=None) -> np.ndarray:
        top = np.concatenate([r.max(axis=1) for r in self.responses(x, tables)], axis=1)
        z = np.maximum(top, 0) @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 2) -> Net:
        """Adagrad on cross entropy. Only the place of a filter's largest response gets its gradient."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.out, self.bias]
        spread = [np.full(p.shape, 1e-3, np.float32) for p in params]
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                pick = order[lo:lo + BATCH]
                b, kind = x[pick], y[pick]
                resp = self.responses(b)
                place = [r.argmax(axis=1) for r in resp]
                top = np.concatenate([np.take_along_axis(r, p[:, None], 1)[:, 0] for r, p in zip(resp, place)], axis=1)
                live = np.maximum(top, 0)
                z = live @ self.out + self.bias
                z = np.exp(z - z.max(axis=1, keepdims=True))
                d = z / z.sum(axis=1, keepdims=True)
                d[np.arange(len(b)), kind] -= 1
                d /= len(b)
                back = (d @ self.out.T) * (top > 0)
                grads = []
                for i, w in enumerate(WIDTHS):
                    g, p = back[:, i * FILTERS:(i + 1) * FILTERS], place[i]
                    cells = [b[np.arange(len(b))[:, None], p + j] * FILTERS + np.arange(FILTERS) for j in range(w)]
                    grads.append(np.stack([np.bincount(c.ravel(), g.ravel(), CLASSES * FILTERS).reshape(CLASSES, FILTERS) for c in cells]))
                for p, s, g in zip(params, spread, [*grads, live.T @ d, d.sum(0)]):
                    g = g.astype(np.float32)
                    s += g * g
                    p -= RATE * g / np.sqrt(s)
        return self


def fit(docs: DataFrame, learn: F.Column | None = None, seed: int = 9) -> Net | None:
    """A network trained on docs with a lang; `learn` says which may be learned from."""
    rows = docs if learn is None else docs.where(learn)
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    pick = F.xxhash64("doc_id", "lang", F.lit(seed))
    # the ids are ranked first; the chosen ones, LABEL_ROWS at most, go to the texts
    chosen = rows.select("doc_id", "lang").distinct().orderBy(pick, "doc_id", "lang").limit(LABEL_ROWS)
    chosen = chosen.select(F.col("doc_id").alias("pick_id"), F.col("lang").alias("pick_lang"))
    rows = rows.join(F.broadcast(chosen), (F.col("doc_id") == F.col("pick_id")) & (F.col("lang") == F.col("pick_lang")))
    each = max(1, WINDOWS // LABEL_ROWS) + 1

    def sample(batches):
        for batch in batches:
            for lo, buf, at in bt.chunks(batch, "text"):
                x, per = windows(buf, at)
                owner = np.repeat(np.arange(len(per)), per)
                # some windows of each text, spread over its length
                place = np.arange(len(x)) - np.repeat(np.cumsum(per) - per, per)
                step = np.maximum(per[owner] // each, 1)
                use = (place % step == step // 2) & (_letters(x) > 0)
                langs = batch.column(batch.schema.get_field_index("lang")).take(pa.array(lo + owner[use]))
                yield pa.RecordBatch.from_arrays(
                    [langs.cast(pa.string()), pa.array([r.tobytes() for r in x[use].astype(np.uint8)], pa.binary())], names=["lang", "x"])

    got = rows.select("lang", "text").mapInArrow(sample, "lang string, x binary")
    got = got.orderBy(F.xxhash64("x", "lang"), "lang", "x").limit(WINDOWS).toPandas()
    if not len(got):
        return None
    names = sorted(got["lang"].unique())
    x = np.frombuffer(b"".join(bytes(v) for v in got["x"]), np.uint8).reshape(-1, WINDOW).astype(np.int64)
    return Net(names).train(x, np.searchsorted(names, got["lang"].to_numpy(str)))


def _letters(x: np.ndarray) -> np.ndarray:
    return (x >= 4).sum(axis=1)


def predict(docs: DataFrame, net: Net | None) -> DataFrame:
    """doc_id, lang_pred and score for every row of docs."""
    if net is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches):
        tables, names = net.pair_tables(), np.array([*net.names, UNKNOWN])
        for batch in batches:
            total = [np.zeros((0, len(net.names)))]
            for _, buf, at in bt.chunks(batch, "text"):
                x, per = windows(buf, at)
                p = [np.zeros((0, len(net.names)))]
                for lo in range(0, len(x), 512):
                    p.append(net.probabilities(x[lo:lo + 512], tables) * (_letters(x[lo:lo + 512])[:, None] + 1e-3))
                run = np.concatenate([np.zeros((1, len(net.names))), np.cumsum(np.concatenate(p), axis=0)])
                edge = np.concatenate([[0], np.cumsum(per)])
                total.append(run[edge[1:]] - run[edge[:-1]])
            total = np.concatenate(total)
            whole = total.sum(axis=1)
            lettered = batch.column(batch.schema.get_field_index("lettered")).to_numpy(zero_copy_only=False).astype(bool)
            best = np.where(lettered & (whole > 0), total.argmax(axis=1), len(net.names))
            score = np.where(best < len(net.names), total.max(axis=1) / np.maximum(whole, 1e-9), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))],
                names=["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lettered).mapInArrow(run, "doc_id long, lang_pred string, score double")
