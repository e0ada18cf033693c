import datetime as dt
import random

import pytest

from tidewatch.operators.hourly import (Covered, Events, Intervals, Latest, Seen, Total, hourly_grid, hourly_signals)
from tidewatch.operators.onset import first_time_where
from tidewatch.operators.pairs import pair_within
from pyspark.sql import functions as F

D, H, US = dt.datetime, dt.timedelta(hours=1), dt.timedelta(microseconds=1)
T0 = D(2150, 3, 1)


def grid_frame(spark, points):
    return spark.createDataFrame(points, "k long, t timestamp_ntz")


def event_frame(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, kind string, value double, id long")


def by_point(df):
    return {(r.k, r.t): r for r in df.collect()}


def test_grid_bounds(spark):
    rows = [(1, T0 + H / 2, T0 + 2 * H + H / 3), (2, T0, T0), (3, T0, None), (4, T0 + 2 * H, T0)]
    df = spark.createDataFrame(rows, "k long, s timestamp_ntz, e timestamp_ntz")
    got = sorted((r.k, r.t) for r in hourly_grid(df, "s", "e").collect())
    assert got == [(1, T0), (1, T0 + H), (1, T0 + 2 * H), (2, T0)]


def test_lookback_edges_ties_and_nulls(spark):
    t = T0 + 30 * H
    points = [(k, t) for k in range(1, 8)]
    rows = [
        (1, t, "a", 1.0, 1),                                        # exactly at t counts
        (2, t - 24 * H, "a", 2.0, 2),                               # exactly 24 h back does not
        (3, t - 24 * H + US, "a", 3.0, 3),                          # one microsecond later does
        (4, t - H / 2, "a", 4.0, 4), (4, t - H / 2, "a", 5.0, 9),   # tie: larger id
        (5, t - H, "a", 6.0, 5), (5, t - H / 4, "a", None, 6),      # missing value is no observation
        (6, t + US, "a", 7.0, 7),                                   # later than t
    ]
    ev = Events(event_frame(spark, rows), "ts", "value", "kind", "id")
    got = by_point(hourly_signals(grid_frame(spark, points), ["k"], {"e": ev}, [
        Latest("v", "e", "a"), Total("s", "e", 24, "a"), Seen("x", ("e",), "a")]))
    assert [got[(k, t)].v for k in range(1, 8)] == [1.0, None, 3.0, 5.0, 6.0, None, None]
    assert [got[(k, t)].s for k in range(1, 8)] == [1.0, None, 3.0, 9.0, 6.0, None, None]
    assert [got[(k, t)].x for k in range(1, 8)] == [True, False, True, True, True, False, False]


def test_interval_edges(spark):
    points = [(k, T0 + i * H) for k in (1, 2) for i in range(6)]
    rows = [(1, T0 + H, T0 + 3 * H), (1, T0 + 2 * H, T0 + 2 * H + H / 2), (1, T0 + 4 * H + US, T0 + 5 * H),
            (2, T0 + 3 * H, T0 + 2 * H), (2, T0 + 3 * H, T0 + 3 * H)]
    iv = Intervals(spark.createDataFrame(rows, "k long, s timestamp_ntz, e timestamp_ntz"), "s", "e")
    got = by_point(hourly_signals(grid_frame(spark, points), ["k"], {"i": iv}, [Covered("on", ("i",))]))
    assert [got[(1, T0 + i * H)].on for i in range(6)] == [False, True, True, False, False, False]
    assert not any(got[(2, T0 + i * H)].on for i in range(6))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_one_hot_entity(spark, seed):
    rng = random.Random(seed)
    points = [(k, T0 + i * H) for k in range(4) for i in range(60)]
    rows, spans = [], []
    for i in range(3000):
        k = 0 if rng.random() < 0.6 else rng.randrange(4)
        ts = T0 + dt.timedelta(seconds=rng.randrange(-30 * 3600, 62 * 3600))
        rows.append((k, ts, rng.choice("ab"), rng.choice([None, round(rng.uniform(-5, 50), 3)]), i))
    for i in range(200):
        s = T0 + dt.timedelta(seconds=rng.randrange(-20 * 3600, 60 * 3600))
        spans.append((rng.randrange(4), s, s + dt.timedelta(seconds=rng.randrange(-1000, 4000))))
    ev = Events(event_frame(spark, rows), "ts", "value", "kind", "id")
    iv = Intervals(spark.createDataFrame(spans, "k long, s timestamp_ntz, e timestamp_ntz"), "s", "e")
    got = by_point(hourly_signals(grid_frame(spark, points), ["k"], {"e": ev, "i": iv}, [
        Latest("a", "e", "a", 6), Latest("b", "e", "b", 1), Total("s", "e", 6), Seen("x", ("e",), "b", 2),
        Covered("on", ("i",))]))
    assert len(got) == len(points)
    for k, t in points:
        near = [r for r in rows if r[0] == k and r[1] <= t]

        def latest(kind, h):
            c = [r for r in near if r[2] == kind and r[3] is not None and r[1] > t - h * H]
            return max(c, key=lambda r: (r[1], r[4]))[3] if c else None

        r = got[(k, t)]
        amounts = [x[3] for x in near if x[1] > t - 6 * H and x[3] is not None]
        assert (r.a, r.b) == (latest("a", 6), latest("b", 1))
        assert r.s == (pytest.approx(sum(amounts), abs=1e-9) if amounts else None)
        assert r.x == any(x[2] == "b" and x[1] > t - 2 * H for x in near)
        assert r.on == any(i == k and s <= t < e for i, s, e in spans)


def test_pair_bounds(spark):
    offsets = [-24 * H, -24 * H - US, 0 * H, 72 * H, 72 * H + US]
    a = spark.createDataFrame([(i, T0) for i in range(5)], "k long, a timestamp_ntz")
    b = spark.createDataFrame([(i, T0 + o) for i, o in enumerate(offsets)], "k long, b timestamp_ntz")
    got = {r.k: r.p for r in pair_within(a, b, "k", "a", "b", 72, 24, "p").collect()}
    assert got == {0: T0 - 24 * H, 2: T0, 3: T0}


def test_pairs_against_brute_force(spark):
    rng = random.Random(7)
    draw = lambda n: [(0 if rng.random() < 0.5 else rng.randrange(30),
                       T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 90))) for _ in range(n)]
    ra, rb = draw(120), draw(120)
    got = {r.k: r.t_pair for r in pair_within(
        spark.createDataFrame(ra, "k long, a timestamp_ntz"), spark.createDataFrame(rb, "k long, b timestamp_ntz"),
        "k", "a", "b", 72, 24).collect()}
    want = {}
    for k, a in ra:
        for j, b in rb:
            if k == j and (a <= b <= a + 72 * H or b <= a <= b + 24 * H):
                want[k] = min(want.get(k, a), a, b)
    assert got == want


def test_first_time_keeps_entities_without_anchor(spark):
    hours = spark.createDataFrame([(1, T0, 3), (1, T0 + H, 5), (2, T0, 9)], "k long, t timestamp_ntz, score int")
    anchor = spark.createDataFrame([(1, T0 + 49 * H)], "k long, q timestamp_ntz")
    got = {r.k: r.t_onset for r in first_time_where(hours, ["k"], "t", F.col("score") >= 2, anchor, "k", "q", 48, 24).collect()}
    assert got == {1: T0 + H, 2: None}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    """The grid of a night in which the zone's clocks go forward has all its hours."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stay = spark.createDataFrame([(1, D(2024, 3, 10, 0, 30), D(2024, 3, 10, 5, 30))], "k long, a timestamp_ntz, b timestamp_ntz")
        grid = hourly_grid(stay, "a", "b").select("k", "t")
        ev = Events(event_frame(spark, [(1, D(2024, 3, 10, 2, 10), "a", 2.5, 1)]), "ts", "value", "kind", "id")
        got = {r.t: r.v for r in hourly_signals(grid, ["k"], {"e": ev}, [Latest("v", "e", "a", 2)]).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {D(2024, 3, 10, h): 2.5 if h in (3, 4) else None for h in range(6)}


def test_sums_of_tiny_huge_and_missing_amounts(spark):
    amounts = [1e-7, 1e13, float("nan"), None, 1.2345678]
    rows = [(k, T0 + dt.timedelta(minutes=30), "a", v, 1) for k, v in enumerate(amounts)]
    rows.append((2, T0 + 5 * H, "a", 1 / 7, 2))  # the NaN has left the window by then
    grid = grid_frame(spark, [(k, T0 + i * H) for k in range(5) for i in (1, 6)])
    ev = Events(event_frame(spark, rows), "ts", "value", "kind", "id")
    got = {(r.k, r.t): r.s for r in hourly_signals(grid, ["k"], {"e": ev}, [Total("s", "e", 3)]).collect()}
    first = [got[(k, T0 + H)] for k in range(5)]
    assert first[:2] == [1e-7, 1e13] and first[2] != first[2] and first[3:] == [None, 1.2345678]
    assert got[(2, T0 + 6 * H)] == 1 / 7 and got[(0, T0 + 6 * H)] is None


def test_decimal_amounts_are_summed_exactly(spark):
    ev = spark.createDataFrame([(1, T0)] * 10, "k long, ts timestamp_ntz").withColumn("value", F.expr("CAST(0.1 AS decimal(12,8))"))
    got = hourly_signals(grid_frame(spark, [(1, T0)]), ["k"], {"e": Events(ev, "ts", "value")}, [Total("s", "e", 1)]).first()
    assert got.s == 1.0


def test_sums_of_sevenths_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(2), T0 + dt.timedelta(seconds=rng.randrange(40 * 3600)), "a", rng.randrange(1000) / 7, i) for i in range(500)]
    grid = grid_frame(spark, [(k, T0 + i * H) for k in range(2) for i in range(48)])
    ev = Events(event_frame(spark, rows), "ts", "value", "kind", "id")
    for r in hourly_signals(grid, ["k"], {"e": ev}, [Total("s", "e", 6)]).collect():
        want = [v for k, ts, _, v, _ in rows if k == r.k and r.t - 6 * H < ts <= r.t]
        assert (r.s is None) == (not want) and (not want or r.s == pytest.approx(sum(want), rel=1e-12))


def test_grid_times_off_the_hour_are_refused(spark):
    ev = Events(event_frame(spark, [(1, T0, "a", 1.0, 1)]), "ts", "value", "kind", "id")
    grid = grid_frame(spark, [(1, T0 + dt.timedelta(minutes=30))])
    with pytest.raises(Exception, match="full hours"):
        hourly_signals(grid, ["k"], {"e": ev}, [Total("s", "e", 1)]).collect()


def test_elapsed_hours_sorts_no_grid(spark, tmp_path):
    """Users, not their hours, are joined: no sort or join lies above the explode. Events without a user keep a grid without times."""
    import datetime

    import __spark_entry__ as entry
    day = datetime.datetime(2024, 1, 1)
    rows = [(i, day + datetime.timedelta(minutes=50 * i), u, k, 1.0) for i, (u, k) in enumerate(
        [(1, "view"), (1, "purchase"), (None, "purchase"), (None, "view"), (2, "view"), (1, "click"), (2, "view")])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    df = entry.queries()["elapsed_hours"](spark, str(tmp_path))
    got = sorted(df.collect(), key=lambda r: (r.user_id or 0, r.t))
    assert [r for r in got if r.user_id is None] and all(r.since_start is None and r.since_anchor is None for r in got if r.user_id is None)
    ones = [r for r in got if r.user_id == 1]
    assert [r.since_start for r in ones] == [0.0, 1.0, 2.0, 3.0, 4.0] and ones[0].since_anchor == pytest.approx(-5 / 6)
    assert all(r.since_anchor is None for r in got if r.user_id == 2)
    above = df._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[0]
    assert "Join" not in above and "Sort" not in above
