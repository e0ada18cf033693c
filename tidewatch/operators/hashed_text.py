"""Logistic regression on hashed words and word pairs: many training sets, each solved to its optimum.

Spark splits a text and hashes its terms into buckets; Arrow batches count them, a batch at a time. No text is moved or split twice: the
staged rows hold the bucket counts, and for the passes they are packed into blocks. Document frequencies and each step's loss and gradient
are sums over (training set, bucket), combined in the tasks into arrays that Spark adds up piece by piece, so no row or key is too frequent
for a task. The driver takes the steps
(limited-memory quasi-Newton, scaled by the second derivatives; those between the most frequent buckets are kept as well), a few
training sets at a time in one pass: some 150 bytes per bucket and set at work, and 16 per bucket and solved set, which `buckets`
bounds. Every step ships the coefficients once per executor.

Weight of a term in a text: (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1) with n and df of the training set, at unit length per text. The
objective is C * sum(w * loss) + |b|^2 / 2 without the intercept in b, with balanced class weights per training set. A missing text counts
as empty: only the intercept speaks for it. Rows without a label train nothing; where only one class is present its weight is 1/2 and the
intercept grows until the gradient is below the tolerance. Repeated rows count as often as they occur; nothing depends on a key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.clock import col
from tidewatch.operators.text import tokens
from tidewatch.sources.storage import fresh_path

BUCKETS = 1 << 20
HISTORY = 4             # pairs of steps and gradient changes kept per training set; the head's derivatives make up for more
REFRESH = 5             # steps after which the second derivatives are summed anew; then after twice as many, and so on
HEAD = 1 << 10             # most frequent buckets, whose second derivatives are summed for every two of them
TOGETHER = 2            # training sets whose steps are taken in one pass; the driver holds the steps of so many
ROWS = 1 << 12          # rows that are laid out over the head at a time
SMALLEST_STEP = 1e-9
PIECE = 1 << 20         # list elements that a task works on at a time
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CELLS = 1 << 13         # buckets whose sums travel together
LOW = 1 << 16           # a packed bucket's low digits
BLOCKS = 16             # blocks of at most PIECE list elements that go to a task's Python at a time
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass
class TextFit:
    fit: int
    rows: int
    positives: int
    terms: int                   # buckets with a term in the training set
    idf: np.ndarray              # by bucket
    coefficients: np.ndarray     # by bucket, the intercept last
    start: tuple[float, float]   # length and largest component of the gradient at zero coefficients, without the intercept's
    gradient: float              # largest component at the end, in absolute value
    steps: int
    at_optimum: bool


# --- counts -----------------------------------------------------------------------------------------------------------


def term_buckets(text: Column | str, buckets: int = BUCKETS) -> Column:
    """Bucket of every word and neighbouring pair of the whole text, repeats included, from 32 bits of the term's MD5."""
    words = F.array(tokens(F.coalesce(col(text), F.lit(""))))     # split once, then named by the lambda
    terms = F.transform(words, neighbours)[0]
    return F.transform(terms, lambda g: (F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long") % buckets).cast("int"))


def neighbours(words: Column) -> Column:
    """Single words followed by neighbouring pairs."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(words, F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b)))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number of each element, and the elements; a null list has none."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy(zero_copy_only=False)


def _pieces(rows, column: pa.Array) -> Iterator:
    """Consecutive slices of an array or batch, at most PIECE elements of the list column each unless one row has more."""
    ends, first = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), 0
    while first < len(column):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        yield rows.slice(first, last - first)
        first = last


def _counted(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, tf) of the distinct buckets of each list."""
    found, first = [(np.zeros(0, int),) * 3], 0
    for piece in _pieces(column, column):
        row, bucket = _lists(piece)
        cells, tf = np.unique(row * buckets + bucket, return_counts=True)
        found.append((first + cells // buckets, cells % buckets, tf))
        first += len(piece)
    return tuple(map(np.concatenate, zip(*found)))


def bucket_counts(buckets: int = BUCKETS):
    """Arrow function from term buckets to the distinct buckets of a row and their counts."""

    @F.arrow_udf("struct<bucket: array<int>, tf: array<int>>")
    def count(column: pa.Array) -> pa.Array:
        row, bucket, tf = _counted(column, buckets)
        ends = np.concatenate([[0], np.bincount(row, minlength=len(column)).cumsum()]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(ends, bucket.astype(np.int32)), pa.ListArray.from_arrays(ends, tf.astype(np.int32))], ["bucket", "tf"])

    return count


def _cut(fit: int, dense: np.ndarray, extra: Sequence[float]) -> pa.RecordBatch:
    """A task's sums for one training set: `extra` as piece -1, and the pieces of the buckets that are not all zero."""
    pieces = dense.reshape(-1, CELLS if len(dense) % CELLS == 0 else len(dense))
    filled = np.flatnonzero(pieces.any(axis=1))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(filled) + 1, fit, np.int32)), pa.array(np.append(-1, filled).astype(np.int32)),
        pa.array([np.asarray(extra, float).tobytes(), *(pieces[i].astype(float).tobytes() for i in filled)], pa.binary())],
        names=["at", "piece", "cells"])


def _total(cells: pa.Array) -> bytes:
    """Sum of arrays of equal length, one per task."""
    total = 0.0
    for one in cells:
        total = total + np.frombuffer(one.as_buffer())
    return total.tobytes()


@contextmanager
def _set(spark: SparkSession, **values: str) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _added(df: DataFrame, in_task, size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sums over all tasks, by training set: the extra numbers and the `size` others. Tasks send arrays, not a row per bucket.

    Shuffle files go when the sums have arrived; otherwise those of all steps fill the disks until the driver collects garbage."""
    with _set(df.sparkSession, **{CLEANUP: "true"} | ({RECORDS: str(BLOCKS)} if "low" in df.columns else {})):
        sums = df.mapInArrow(in_task, "at int, piece int, cells binary").groupBy("at", "piece").agg(F.arrow_udf(_total, "binary")("cells").alias("cells"))
        table = sums.toArrow()
    out: dict[int, list] = {}
    for i, piece, cells in zip(*(table.column(c).to_pylist() for c in ("at", "piece")), table.column("cells")):
        values, mine = np.frombuffer(cells.as_buffer()), out.setdefault(i, [None, np.zeros(size)])
        if piece < 0:
            mine[0] = values.copy()     # a view would keep the whole table
        else:
            mine[1][piece * len(values):(piece + 1) * len(values)] = values
    return {i: tuple(mine) for i, mine in sorted(out.items())}


def _training(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The training sets of a batch, each with the numbers of its rows."""
    row, fit = _lists(batch.column("at"))
    for i in np.unique(fit):
        yield int(i), np.unique(row[fit == i])


def _frequencies(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, positives = {}, {}, {}
        for batch in (p for whole in batches for p in _pieces(whole, whole.column("bucket"))):
            row, bucket = _lists(batch.column("bucket"))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for i, mine in _training(batch):
                seen = np.zeros(batch.num_rows, bool)
                seen[mine] = True
                df[i] = df.get(i, 0) + np.bincount(bucket[seen[row]], minlength=buckets)
                rows[i], positives[i] = rows.get(i, 0) + len(mine), positives.get(i, 0) + y[mine].sum()
        for i in df:
            yield _cut(i, df[i], [rows[i], positives[i]])

    return count


def _per_row(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; the rows' values lie one after the other."""
    out = np.zeros(len(sizes))
    if len(values):
        out[sizes > 0] = np.add.reduceat(values, starts[sizes > 0])
    return out


def _weights(sizes: np.ndarray, bucket: np.ndarray, lifted: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the terms before the text is brought to unit length, its length (1 where it has no term), and where its terms start."""
    starts = np.cumsum(sizes) - sizes
    x = lifted * idf[bucket]
    length = np.sqrt(_per_row(starts, sizes, x * x))
    return x, np.where(length == 0, 1.0, length), starts


def _lifted(tf: np.ndarray) -> np.ndarray:
    """1 + ln tf by a table of the usual counts."""
    if tf.dtype != np.uint8 and len(tf) and tf.max() > 255:
        return 1.0 + np.log(tf)
    return (1.0 + np.log(np.maximum(np.arange(256), 1))).take(tf)


def _between(row: np.ndarray, place: np.ndarray, x: np.ndarray, bend: np.ndarray, size: int) -> np.ndarray:
    """Second derivatives of every two of the `size` head buckets and the intercept. Cells are ordered by row; a place from `size` on is
    of no head bucket. Single precision serves: they only scale the steps."""
    total, hit, root = np.zeros((size + 1, size + 1)), place < size, np.sqrt(bend)
    row, place = row[hit], place[hit]
    x = x[hit] * root[row]
    for first in range(0, len(bend), ROWS):
        lo, hi = np.searchsorted(row, [first, first + ROWS])
        part = root[first:first + ROWS]
        laid = np.zeros((len(part), size + 1), np.float32)
        laid[row[lo:hi] - first, place[lo:hi]] = x[lo:hi]
        laid[:, size] = part
        total += laid.T @ laid      # one operand: half the products
    return total


PACKED = "at array<int>, y binary, sizes binary, length binary, high binary, low binary, tf binary"


def _packed(buckets: int, idf: dict[int, np.ndarray]):
    """Arrow function from staged counts to blocks of texts that are in the same training sets, as plain arrays: labels, numbers of
    buckets, lengths of the texts before they are brought to unit length (by training set), buckets (how many of a text share their high
    digits, and the low digits of each) and counts."""
    names, digits = np.array(sorted(idf)), -(-buckets // LOW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in _pieces(whole, whole.column("bucket"))):
            sets = np.zeros((batch.num_rows, len(names)), bool)
            row, fit = _lists(batch.column("at"))
            sets[row, np.searchsorted(names, fit)] = True
            sizes = batch.column("bucket").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bucket, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("bucket", "tf"))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            kinds, kind = np.unique(sets, axis=0, return_inverse=True)
            for k, members in enumerate(kinds):
                mine = kind.ravel() == k
                cells = np.repeat(mine, sizes)
                n, c, count = sizes[mine].astype(np.int32), bucket[cells], tf[cells]
                count = count.astype(np.uint8) if not len(count) or count.max() < 256 else count.astype(np.int32)
                lifted = _lifted(count)
                length = [_weights(n, c, lifted, idf[i])[1] for i in names[members].tolist()]
                high = np.bincount(np.repeat(np.arange(len(n)), n) * digits + c // LOW, minlength=len(n) * digits).astype(np.int32)
                if length:
                    arrays = y[mine], n, np.concatenate(length), high, (c % LOW).astype(np.uint16), count
                    yield pa.RecordBatch.from_arrays([pa.array([names[members].tolist()], pa.list_(pa.int32())),
                                                      *(pa.array([a.tobytes()], pa.binary()) for a in arrays)],
                                                     names=["at", "y", "sizes", "length", "high", "low", "tf"])

    return pack


def _unpacked(batch: pa.RecordBatch, buckets: int) -> Iterator[tuple]:
    """Of each block: training sets, labels, numbers of buckets, lengths by training set, buckets, 1 + ln tf."""
    digits = -(-buckets // LOW)
    for r in range(batch.num_rows):
        read = lambda name, kind: np.frombuffer(batch.column(name)[r].as_buffer(), kind)
        at, low = batch.column("at")[r].as_py(), read("low", np.uint16)
        tf = read("tf", np.uint8)
        tf = tf if len(tf) == len(low) else tf.view(np.int32)
        high = read("high", np.int32)
        bucket = low + np.repeat(np.tile(np.arange(digits) * LOW, len(high) // digits), high)
        yield at, read("y", float), read("sizes", np.int32), read("length", float).reshape(len(at), -1), bucket, _lifted(tf)


def _slopes(buckets: int, fixed, shipped):
    """Loss, gradient and, where asked for, second derivatives by bucket and between head buckets of the rows of a task at the shipped
    coefficients, without the penalty."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, bends, extra, scaled, places = {}, {}, {}, {}, {}
        for at, y, n, lengths, c, lifted in (block for batch in batches for block in _unpacked(batch, buckets)):
            starts, target = np.cumsum(n) - n, y.astype(int)
            for i, length in zip(at, lengths):
                if i not in shipped.value:
                    continue
                (idf, weights, head), (b, curved) = fixed[i].value, shipped.value[i]
                if i not in scaled:
                    scaled[i], gradient[i], extra[i] = b[:-1] * idf, np.zeros(buckets), 0.0
                z = _per_row(starts, n, scaled[i].take(c) * lifted) / length + b[-1]
                w = weights[target]
                p = np.exp(-np.logaddexp(0, -z))
                slope, bend = w * (p - y), w * p * (1 - p)
                gradient[i] += np.bincount(c, lifted * np.repeat(slope / length, n), buckets)
                between = np.zeros(0)
                if curved:
                    if i not in places:
                        places[i], bends[i] = np.full(buckets, len(head), np.int32), np.zeros(buckets)
                        places[i][head] = np.arange(len(head))
                    bends[i] += np.bincount(c, lifted * lifted * np.repeat(bend / length ** 2, n), buckets)
                    between = _between(np.repeat(np.arange(len(n)), n), places[i].take(c), lifted * idf.take(c) / np.repeat(length, n), bend, len(head)).ravel()
                loss = (w * (np.logaddexp(0, z) - y * z)).sum()
                extra[i] = extra[i] + np.concatenate([[loss, slope.sum()], between])
        for i in gradient:
            idf = fixed[i].value[0]
            yield _cut(i, np.concatenate([gradient[i] * idf, bends[i] * idf * idf]) if i in bends else gradient[i] * idf, extra[i])

    return add


def _dense(held: np.ndarray, x: np.ndarray, buckets: int) -> np.ndarray:
    b = np.zeros(buckets + 1)
    b[held] = x
    return b


# --- fit --------------------------------------------------------------------------------------------------------------


class _Descent:
    """Steps of one training set over the buckets it holds; a step that does not lower the loss enough is halved.

    Directions are scaled by the second derivatives: frequent terms and the intercept bend the loss far more than rare terms do. Frequent
    terms meet in most texts, so among those at `head`, the intercept last, the derivatives of every two are taken into account."""

    def __init__(self, size: int, bound: float, head: np.ndarray):
        self.x, self.bound, self.head, self.steps, self.length = np.zeros(size), bound, head, 0, 1.0
        self.due = REFRESH
        self.loss = self.gradient = self.way = self.bends = self.inverse = None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def tried(self) -> np.ndarray:
        return self.x if self.way is None else self.x + self.length * self.way

    @property
    def curved(self) -> bool:
        """Whether the next answer shall hold second derivatives."""
        return self.bends is None or self.steps + 1 >= self.due

    def tell(self, loss: float, penalised: np.ndarray, bends: np.ndarray | None = None, between: np.ndarray | None = None) -> None:
        """The answer at the tried coefficients; the arrays are taken over."""
        x = self.tried()
        penalised[:-1] += x[:-1]
        loss += x[:-1] @ x[:-1] / 2
        if self.way is not None:
            if loss > self.loss + 1e-4 * self.length * float(np.dot(self.gradient, self.way)) + 1e-13 * abs(self.loss):
                self.length /= 2
                return
            s, y = x - self.x, penalised - self.gradient
            if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs, (s.astype(np.float32), y.astype(np.float32))][-HISTORY:]
            self.steps += 1
        if bends is not None:
            bends[:-1] += 1
            self.bends = np.maximum(bends, 1e-9).astype(np.float32)
            between.flat[::len(between) + 1] += np.append(np.ones(len(self.head) - 1), 1e-9)
            self.inverse = np.linalg.inv(between).astype(np.float32)
            self.due = max(self.due, 2 * self.steps)
        # what is kept of a step is kept in single precision, but for the coefficients
        self.x, self.loss, self.gradient = x, loss, penalised.astype(np.float32)
        self.length, self.way = 1.0, self._way(penalised).astype(np.float32)

    def _way(self, gradient: np.ndarray) -> np.ndarray:
        q, shares = np.negative(gradient, out=gradient), []
        bends = [float(s @ y) for s, y in self.pairs]
        for (s, y), bend in zip(reversed(self.pairs), reversed(bends)):
            shares.append(s @ q / bend)
            q -= shares[-1] * y
        q = self._scaled(q)
        if self.pairs:
            y = self.pairs[-1][1]
            q *= bends[-1] / float(y @ self._scaled(y))
        for (s, y), bend, share in zip(self.pairs, bends, reversed(shares)):
            q += (share - y @ q / bend) * s
        return q

    def _scaled(self, q: np.ndarray) -> np.ndarray:
        out = q / self.bends
        out[self.head] = self.inverse @ q[self.head]
        return out

    @property
    def at_optimum(self) -> bool:
        return self.loss is not None and bool(np.abs(self.gradient).max() <= self.bound)

    @property
    def ended(self) -> bool:
        return self.at_optimum or self.length < SMALLEST_STEP


def text_counts(df: DataFrame, text: str, label: str, fits: Column, buckets: int = BUCKETS, keep: Sequence[str] = ()) -> DataFrame:
    """Staged (at, y, bucket, tf): the training sets of a row, its label, its distinct buckets and their counts, after the columns to keep."""
    rows = df.where(F.col(label).isNotNull()).select(
        *keep, fits.cast("array<int>").alias("at"), F.col(label).cast("double").alias("y"), term_buckets(text, buckets).alias("_g"))
    counted = rows.withColumn("_c", bucket_counts(buckets)("_g")).select(*keep, "at", "y", "_c.bucket", "_c.tf")
    path = fresh_path(df.sparkSession, "text-counts")
    counted.write.option("parquet.writer.version", "v2").parquet(path)     # differences of the ordered buckets: half the size
    return df.sparkSession.read.parquet(path)


def inverse_frequencies(counts: DataFrame, buckets: int = BUCKETS) -> dict[int, tuple[int, int, int, np.ndarray]]:
    """Per training set: rows, positives, buckets in use, idf by bucket."""
    out = {}
    for i, (extra, df) in _added(counts.select("at", "y", "bucket"), _frequencies(buckets), buckets).items():
        n, k = (int(v) for v in extra)
        out[i] = n, k, int((df > 0).sum()), np.log((1.0 + n) / (1.0 + df)) + 1.0
    return out


def _blocks(counts: DataFrame, idf: dict[int, np.ndarray], buckets: int) -> DataFrame:
    """The staged counts once more, packed for the passes: no list element is read one by one, and no text's length is summed again."""
    spark = counts.sparkSession
    shipped, path = spark.sparkContext.broadcast(idf), fresh_path(spark, "text-blocks")
    rows = counts.select("at", "y", "bucket", "tf").sortWithinPartitions("at")     # texts of the same training sets fill whole blocks

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(buckets, shipped.value)(batches)

    # every task sends its sums over all buckets: no more tasks than run at a time, and even ones
    tasks = spark.sparkContext.defaultParallelism
    rows.mapInArrow(pack, PACKED).repartition(tasks).write.parquet(path)
    shipped.destroy()
    return spark.read.parquet(path).coalesce(tasks)


def text_fits(df: DataFrame, text: str, label: str, fits: Column, C: float = 2.0, buckets: int = BUCKETS, tol: float = 1e-7,
              max_steps: int = 1000) -> list[TextFit]:
    """One fit per value found in the integer arrays `fits`, ordered by it. A gradient of at most tol * C * rows ends a fit."""
    counts = text_counts(df, text, label, fits, buckets)
    return _solved(counts, inverse_frequencies(counts, buckets), C, buckets, tol, max_steps)


def _solved(counts: DataFrame, sizes: dict[int, tuple[int, int, int, np.ndarray]], C: float, buckets: int, tol: float, max_steps: int) -> list[TextFit]:
    """Every training set's optimum. A pass takes a step of up to TOGETHER sets; as one ends, the next begins, so the driver holds the
    steps of no more of them."""
    context = counts.sparkSession.sparkContext
    blocks = _blocks(counts, {i: idf for i, (*_, idf) in sizes.items()}, buckets) if sizes else counts
    waiting, held, points, starts, passes, fixed, out = list(sizes), {}, {}, {}, {}, {}, []

    def begin(i: int) -> None:
        n, k, _, idf = sizes[i]
        # buckets without a term in the training set have the largest idf and keep a coefficient of zero
        held[i] = np.append(np.flatnonzero(idf < np.log(1.0 + n) + 1.0), buckets).astype(np.int32)
        head = np.argsort(idf[held[i][:-1]], kind="stable")[:HEAD]
        points[i], passes[i] = _Descent(len(held[i]), tol * C * n, np.append(head, len(held[i]) - 1)), 0
        fixed[i] = context.broadcast((idf, np.array([C * n / (2 * c) if c else C for c in (n - k, k)]), held[i][head]))

    def end(i: int) -> None:
        fixed.pop(i).destroy()
        n, k, terms, idf = sizes[i]
        point = points.pop(i)
        out.append(TextFit(i, n, k, terms, idf, _dense(held.pop(i), point.x, buckets), starts.pop(i), float(np.abs(point.gradient).max()),
                           point.steps, point.at_optimum))

    while waiting or points:
        if waiting and len(points) < TOGETHER:
            begin(waiting.pop(0))
        # one set's second derivatives come with a pass, a beginning set's first
        curved = max((i for i, p in points.items() if p.curved), key=lambda i: points[i].bends is None, default=None)
        shipped = context.broadcast({i: (_dense(held[i], p.tried(), buckets), i == curved) for i, p in points.items()})
        rows = blocks.where(F.arrays_overlap("at", F.array(*map(F.lit, points))))
        found = _added(rows, _slopes(buckets, fixed, shipped), buckets if curved is None else 2 * buckets)
        shipped.destroy()
        for i, point in list(points.items()):
            extra, sums = found.pop(i)
            mine, g = held[i][:-1], sums[:buckets]
            if i not in starts:
                starts[i] = float(np.sqrt(g @ g)), float(np.abs(g).max())
            loss, g, bends, between = extra[0], np.append(g[mine], extra[1]), None, None
            if i == curved:
                between = extra[2:].reshape(len(point.head), -1)
                bends = np.append(sums[buckets:][mine], between[-1, -1])
            del sums
            point.tell(loss, g, bends, between)
            del extra, g, bends, between
            passes[i] += 1
            if point.ended or passes[i] == max_steps:
                end(i)
    return sorted(out, key=lambda f: f.fit)


def stated_fit(sizes: dict[int, tuple[int, int, int, np.ndarray]], coefficients: np.ndarray) -> TextFit:
    """A model of given coefficients, the intercept last, on the document frequencies of the first training set; an empty table has none."""
    buckets = len(coefficients) - 1
    i, (n, k, terms, idf) = next(iter(sizes.items()), (0, (0, 0, 0, np.ones(buckets))))
    return TextFit(i, n, k, terms, idf, coefficients, (0.0, 0.0), float("nan"), 0, False)


# --- scores -----------------------------------------------------------------------------------------------------------


def score(df: DataFrame, text: str, fits: Sequence[TextFit], name: str, at: str | None = None) -> DataFrame:
    """Probability of every whole text by the first fit, or by the fit whose number the column `at` holds (null where none does).

    Only term buckets go to the Arrow function; the models are shipped once per executor and read the same arrays in every task."""
    buckets = len(fits[0].idf)
    probability = _probability(df.sparkSession, fits)

    @F.arrow_udf("double")
    def of_terms(column: pa.Array, fit: pa.Array) -> pa.Array:
        row, bucket, tf = _counted(column, buckets)
        return probability(np.bincount(row, minlength=len(column)), bucket, tf, fit)

    return df.withColumn(name, of_terms(term_buckets(text, buckets), _chosen(fits, at)))


def score_counts(counts: DataFrame, fits: Sequence[TextFit], name: str, at: str | None = None) -> DataFrame:
    """As `score`, from the staged distinct buckets (`bucket`) and their counts (`tf`): no text is split again."""
    probability = _probability(counts.sparkSession, fits)

    @F.arrow_udf("double")
    def of_counts(bucket: pa.Array, tf: pa.Array, fit: pa.Array) -> pa.Array:
        sizes = bucket.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return probability(sizes, *(c.flatten().to_numpy(zero_copy_only=False) for c in (bucket, tf)), fit)

    return counts.withColumn(name, of_counts("bucket", "tf", _chosen(fits, at)))


def _chosen(fits: Sequence[TextFit], at: str | None) -> Column:
    return F.col(at).cast("int") if at else F.lit(fits[0].fit)


def _probability(spark: SparkSession, fits: Sequence[TextFit]):
    shipped = spark.sparkContext.broadcast({f.fit: (f.idf, f.coefficients) for f in fits})

    def probability(sizes: np.ndarray, bucket: np.ndarray, tf: np.ndarray, fit: pa.Array) -> pa.Array:
        which, out = fit.fill_null(-1).to_numpy(zero_copy_only=False), np.full(len(sizes), np.nan)
        for i in np.unique(which):
            if i in shipped.value:
                idf, b = shipped.value[i]
                cells = np.repeat(which == i, sizes)
                c, n = bucket[cells], sizes[which == i]
                x, length, starts = _weights(n, c, _lifted(tf[cells]), idf)
                out[which == i] = np.exp(-np.logaddexp(0, -(_per_row(starts, n, x * b[c]) / length + b[-1])))
        return pa.array(out, from_pandas=True)

    return probability
