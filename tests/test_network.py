"""The barrier-trained network against numpy, and ordered category statistics against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import network as N
from tidewatch.operators.categories import ordered_target_statistics

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] * x[:, 1] > 0.4).astype(int)
    rows = [(i, float(p), float(q), int(t)) for i, ((p, q), t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows + [(900, 1.0, 1.0, None)], "id long, a double, b double, y int").repartition(5)


@pytest.mark.parametrize("masked", [False, True])
def test_gradient_is_the_slope_of_the_loss(masked):
    rng = np.random.default_rng(2)
    sizes, x, y = [3, 4, 2, 1], rng.normal(size=(20, 3)), rng.integers(0, 2, 20)
    masks = [(rng.random((20, n)) > 0.3) / 0.7 for n in (4, 2)] if masked else None
    flat = N.start(sizes, 3)

    def loss(point):
        h = x
        for i, (w, b) in enumerate(N.layers(point, sizes)):
            z = h @ w.T + b
            h = np.maximum(z, 0) * (masks[i] if masks and i < 2 else 1)
        z = z[:, 0]
        return np.sum(np.where(y == 1, 5.0 * np.logaddexp(0, -z), np.logaddexp(0, z)))

    slope = [(loss(flat + e) - loss(flat - e)) / 2e-6 for e in np.eye(len(flat)) * 1e-6]
    assert N.gradient(flat, sizes, x, y, 5.0, masks) == pytest.approx(slope, abs=1e-6)


def test_one_step_equals_all_rows_in_numpy(points):
    x, y, df = points
    got = N.network_fits(df, COLUMNS, "y", "id", F.array(F.lit(7)), (4,), epochs=1, batch=10_000, dropout=0.0, rate=0.01)[7]
    sizes, r = [2, 4, 1], y.mean()
    flat = N.start(sizes, 42)
    want = N.Adam(len(flat), 0.01, 1e-4).step(flat, N.gradient(flat, sizes, x, y, (1 - r) / r) / len(y))
    assert got == pytest.approx(want, abs=1e-12)


def test_reruns_agree_and_fits_do_not_touch_each_other(points):
    _, _, df = points
    settings = dict(hidden=(5, 3), epochs=2, batch=64, dropout=0.0, tasks=3)
    even, every = F.when(F.col("id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))), F.array(F.lit(0))
    both = N.network_fits(df, COLUMNS, "y", "id", even, **settings)
    again = N.network_fits(df.repartition(2, "b"), COLUMNS, "y", "id", even, **settings)
    assert all((both[f] == again[f]).all() for f in (0, 1)) and not (both[0] == both[1]).all()
    alone = N.network_fits(df.where("id % 2 = 0"), COLUMNS, "y", "id", every, **settings)
    assert set(alone) == {0} and len(alone[0]) == len(both[0])
    assert (N.network_fits(df, COLUMNS, "y", "id", every, **settings)[0] == both[1]).all()


def test_tasks_go_on_from_their_mean(spark):
    """On equal rows every task takes the same steps, so any number of tasks ends where one does."""
    df = spark.createDataFrame([(i, 0.3, -1.0, 0) for i in range(50)], "id long, a double, b double, y int")
    one, four = (N.network_fits(df, COLUMNS, "y", "id", F.array(F.lit(0)), (3,), epochs=3, dropout=0.0, tasks=n)[0] for n in (1, 4))
    assert four == pytest.approx(one, abs=1e-12) and abs(one - N.start([2, 3, 1], 42)).max() > 1e-3


def test_network_learns_what_a_line_cannot(points):
    x, y, df = points
    found = N.network_fits(df, COLUMNS, "y", "id", F.array(F.lit(0)), epochs=60, batch=32, rate=0.01, dropout=0.1)[0]
    p = np.array([r.p for r in df.where("y is not null").orderBy("id").select(N.network_probability(COLUMNS, found, (16, 8)).alias("p")).collect()])
    assert np.mean(p[y == 1][:, None] > p[y == 0][None, :]) > 0.95
    hidden = np.maximum(x @ N.layers(found, [2, 16, 8, 1])[0][0].T + N.layers(found, [2, 16, 8, 1])[0][1], 0)
    hidden = np.maximum(hidden @ N.layers(found, [2, 16, 8, 1])[1][0].T + N.layers(found, [2, 16, 8, 1])[1][1], 0)
    w, b = N.layers(found, [2, 16, 8, 1])[2]
    assert p == pytest.approx(1 / (1 + np.exp(-(hidden @ w.T + b)[:, 0])), abs=1e-12)


def test_network_edges(spark, points):
    _, _, df = points
    assert N.network_fits(df.limit(0), COLUMNS, "y", "id", F.array(F.lit(0))) == {}
    odd = spark.createDataFrame([(1, None, float("nan"), 1), (1, 2.0, float("inf"), 1)], "id long, a double, b double, y int")
    one_class = N.network_fits(odd, COLUMNS, "y", "id", F.array(F.lit(0)), (2,), epochs=1, tasks=2)[0]
    assert np.isfinite(one_class).all()


@pytest.mark.parametrize("digits", [1, 3])
def test_target_statistics_by_brute_force(spark, digits):
    rng = np.random.default_rng(4)
    rows = [(i, [None, "hot", "hot", "x", "y"][rng.integers(5)], int(rng.integers(3)), None if i % 9 == 0 else int(rng.integers(2))) for i in range(400)]
    df = spark.createDataFrame([*rows, (1000, "only", 7, None)], "id long, c string, k int, y int").repartition(7)
    got = {r.id: r for r in ordered_target_statistics(df, ["c", "k"], "y", "id", prior_weight=2.0, digits=digits).collect()}
    known = [r for r in rows if r[3] is not None]
    rate = sum(r[3] for r in known) / len(known)
    place = {r[0]: hashlib.md5(f"42|{r[0]}".encode()).hexdigest() for r in rows}
    for i, c, k, y in rows:
        for at, value, code in ((1, c, got[i].c_target), (2, k, got[i].k_target)):
            before = [r[3] for r in known if r[at] == value and (y is None or place[r[0]] < place[i])]
            assert code == pytest.approx((sum(before) + 2 * rate) / (len(before) + 2), abs=1e-12)
    assert got[1000].c_target == pytest.approx(rate) and len(got) == 401


def test_target_statistics_without_rows_or_labels(spark):
    df = spark.createDataFrame([(1, "a", None)], "id long, c string, y int")
    assert [r.c_target for r in ordered_target_statistics(df, ["c"], "y", "id").collect()] == [None]
    assert ordered_target_statistics(df.limit(0), ["c"], "y", "id").count() == 0
