"""Ordered scans, nearest joins and quantiles against brute force, with one heavy key."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fogline.operators import asof, profile, scan, sequences

BASE = dt.datetime(2026, 1, 1)


def at(s):
    return BASE + dt.timedelta(seconds=s)


def skewed_key(rng):
    return rng.choice(["hot", "hot", "hot", None, "a", "b"])


def test_scan_matches_a_plain_loop(spark):
    rng = random.Random(2)
    data = [(skewed_key(rng), rng.randrange(2000), i, rng.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(data, "k string, o int, i int, v int")
    got = scan.scan_in_segments(
        df, ["k"], ["o", "i"], F.floor(F.col("o") / 50), previous=("v", "prev"), before=("v", "sum_before")
    )
    want, state = {}, {}
    for k, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        prev, total = state.get(k, (None, 0))
        want[i] = (prev, total)
        state[k] = (v, total + v)
    assert {r["i"]: (r["prev"], r["sum_before"]) for r in got.collect()} == want
    assert set(got.columns) == {*df.columns, "prev", "sum_before"}


def test_previous_of_an_order_column(spark):
    df = spark.createDataFrame([(1, 5), (1, 900), (1, 7)], "k int, s int")
    got = scan.scan_in_segments(df, ["k"], ["s"], F.floor(F.col("s") / 256), previous=("s", "p"))
    assert {(r["s"], r["p"]) for r in got.collect()} == {(5, None), (7, 5), (900, 7)}


def test_ordinal_and_sampling(spark):
    rng = random.Random(3)
    data = [(0 if rng.random() < 0.5 else rng.randrange(100), i) for i in range(500)]
    df = spark.createDataFrame(data, "o int, i int").repartition(7)
    order = {i: n + 1 for n, (o, i) in enumerate(sorted(data))}
    assert {r["i"]: r["ordinal"] for r in scan.ordinal(df, ["o", "i"]).collect()} == order
    got = {r["i"] for r in scan.sample_every_k(df, ["o", "i"], 6).collect()}
    assert got == {i for i, n in order.items() if (n - 1) % 6 == 0}
    first = {r["i"] for r in scan.sample_every_k(df, ["o", "i"], 6, first_n=4).collect()}
    assert first == {i for i, n in order.items() if n in (1, 7, 13, 19)}
    with pytest.raises(ValueError):
        scan.sample_every_k(df, ["o"], 0)


def test_sampling_on_an_empty_table(spark):
    assert scan.sample_every_k(spark.createDataFrame([], "o int"), ["o"], 3).count() == 0


def test_asof_within_reach_carries_nothing(spark):
    left = spark.createDataFrame([("k", at(i), i) for i in (0, 59, 60, 61, 200)], "k string, lt timestamp, i int")
    right = spark.createDataFrame([("k", at(i), i, j) for i, j in ((30, 1), (90, 2), (90, 1), (300, 1))], "k string, rt timestamp, n int, m int")

    def found(tolerance):
        got = asof.asof_nearest(left, right, ["k"], "lt", "rt", tolerance, ["m"], 60)
        return {r["i"]: (r["n"], r["m"]) for r in got.collect()}, got._jdf.queryExecution().executedPlan().toString()

    near, plan = found(40)
    assert near == {0: (30, 1), 59: (30, 1), 60: (30, 1), 61: (90, 1), 200: (None, None)}
    far, carrying = found(100)  # farther than a segment: carried through the summaries
    assert far == near | {200: (300, 1)}
    assert plan.count("Exchange hashpartitioning") < carrying.count("Exchange hashpartitioning")


def test_asof_within_reach_shuffles_both_sides_once(spark):
    rng = random.Random(9)
    # Times before 1970, on borders of segments and far from all others; copies on both sides, NULL keys, times and payloads.
    times = [None, at(0), at(240), at(239), at(241), at(-1), *(at(rng.randrange(-900, 900, 15)) for _ in range(40)), at(90_000)]
    times += [dt.datetime(1969, 12, 31, 23, 59, s) for s in (0, 30, 59)]
    left = [(rng.choice(["a", "b", None]), rng.choice(times), rng.randrange(3)) for _ in range(300)]
    right = [(rng.choice(["a", "b", None]), rng.choice(times), rng.choice([None, 1, 2]), rng.randrange(2)) for _ in range(60)]
    left, right = left + left[:40], right + right[:9]
    frames = spark.createDataFrame(left, "k string, lt timestamp, i int"), spark.createDataFrame(right, "k string, rt timestamp, n int, m int")
    got = asof.asof_nearest(*frames, ["k"], "lt", "rt", 60, ["n"], 60)

    def nearest(k, t):
        rank = lambda r: (r[2] is not None, r[2] or 0, r[3])
        near = [r for r in right if r[0] == k and r[1] is not None and abs((t - r[1]).total_seconds()) <= 60]
        back = max((r for r in near if r[1] <= t), key=lambda r: (r[1], rank(r)), default=None)
        ahead = min((r for r in near if r[1] > t), key=lambda r: (r[1], rank(r)), default=None)
        if back is None or ahead is not None and ahead[1] - t < t - back[1]:
            back = ahead
        return (None, None, None, False) if back is None else (back[2], back[3], (t - back[1]).total_seconds(), True)

    want = [(k, t, i, *nearest(k, t)) for k, t, i in left if k is not None and t is not None]
    found = [(r["k"], r["lt"], r["i"], r["n"], r["m"], r["join_time_delta_sec"], r["matched"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0].count("Exchange ") == 1
    # A left side of nothing but key and time.
    bare = asof.asof_nearest(frames[0].select("k", "lt"), frames[1], ["k"], "lt", "rt", 60, ["n"], 60)
    assert bare.where("matched").count() == sum(w[-1] for w in want)


@pytest.mark.parametrize("segment_seconds", [30, 3600, 10**7])
def test_asof_nearest_equals_pandas(spark, segment_seconds):
    rng = random.Random(4)
    # Few distinct times, so ties and duplicates on both sides are common.
    left = [(i, skewed_key(rng), at(rng.randrange(0, 4000, 10))) for i in range(300)]
    right = [(skewed_key(rng), at(rng.randrange(0, 4000, 20)), i) for i in range(200)]
    pl = pd.DataFrame(left, columns=["i", "k", "lt"]).dropna(subset=["k"]).sort_values(["lt", "i"])
    pr = pd.DataFrame(right, columns=["k", "rt", "n"]).dropna(subset=["k"]).sort_values(["rt", "n"])
    tolerance = 25
    want = pd.merge_asof(
        pl, pr, left_on="lt", right_on="rt", by="k", direction="nearest", tolerance=pd.Timedelta(seconds=tolerance)
    )
    expected = {r.i: (None if pd.isna(r.n) else int(r.n)) for r in want.itertuples()}
    got = asof.asof_nearest(
        spark.createDataFrame(left, "i int, k string, lt timestamp"),
        spark.createDataFrame(right, "k string, rt timestamp, n int"),
        ["k"], "lt", "rt", tolerance, ["n"], segment_seconds,
    )
    assert {r["i"]: r["n"] for r in got.collect()} == expected
    row = got.where("matched").first()
    assert row["join_time_delta_sec"] == (row["lt"] - row["rt"]).total_seconds()


def brute_interval(t, executions):
    hits = [e for e in executions if e[0] - dt.timedelta(seconds=120) <= t <= e[1] + dt.timedelta(seconds=300)]
    best = min(hits or executions, key=lambda e: abs((t - e[0]).total_seconds()))
    return best[2], "high" if hits else "low-nearest"


@pytest.mark.parametrize("seed,longest", [(1, 60), (2, 900), (3, 20000), (4, 0)])
def test_interval_nearest_equals_brute_force(spark, seed, longest):
    rng = random.Random(seed)
    executions = []
    for listed in range(60):
        start = at(rng.randrange(0, 40000, 7))
        executions.append((start, start + dt.timedelta(seconds=rng.randrange(longest + 1), microseconds=rng.randrange(2)), listed))
    executions.append((executions[0][0], executions[0][1] + dt.timedelta(seconds=5), 60))
    points = [(i, at(rng.randrange(-2000, 45000)) + dt.timedelta(microseconds=rng.randrange(3))) for i in range(250)]
    # Exactly on the edges of both tolerances.
    edge = executions[7]
    points += [(900, edge[0] - dt.timedelta(seconds=120)), (901, edge[1] + dt.timedelta(seconds=300))]
    points += [(902, edge[0] - dt.timedelta(seconds=120, microseconds=1)), (903, edge[1] + dt.timedelta(seconds=300, microseconds=1))]
    got = asof.interval_nearest(
        spark.createDataFrame(points, "i int, t timestamp"),
        spark.createDataFrame(executions, "s timestamp, e timestamp, listed int"),
        "t", "s", "e", "listed", segment_seconds=1800,
    )
    want = {i: brute_interval(t, executions) for i, t in points}
    assert {r["i"]: (r["listed"], r["confidence"]) for r in got.collect()} == want


def test_crossings_match_a_plain_loop(spark):
    rng = random.Random(6)
    data = []
    for i in range(400):
        snap = rng.randrange(0, 5000, 5)
        data.append(("muni", skewed_key(rng), "2026-01-01", None, rng.choice([None, 1]), 3, "r", f"s{i % 2}", at(snap), at(snap + rng.randrange(-50, 50))))
    data += data[:80]
    columns = "agency_id string, trip_id string, trip_start_date string, trip_start_time string, direction_id int, stop_sequence int, route_id string, stop_id string, snapshot_ts timestamp, arrival_time_predicted timestamp"
    got = sequences.inferred_arrivals(spark.createDataFrame(data, columns), segment_seconds=600)
    previous, first = {}, {}
    for r in sorted({d for d in data if d[1]}, key=lambda d: (d[8], d[9], d[6], d[7])):
        key, horizon = (r[1], r[4]), (r[9] - r[8]).total_seconds()
        if key in previous and previous[key] > 0 >= horizon and key not in first:
            first[key] = (r[8], horizon, previous[key])
        previous[key] = horizon
    found = {
        (r["trip_id"], r["direction_id"]): (r["inferred_arrival_snapshot_ts"], r["horizon_sec"], r["prev_horizon_sec"])
        for r in got.collect()
    }
    assert found == first


def test_sequence_gaps(spark):
    data = [("t", None, s) for s in (1, 2, 5, 5, 600)] + [("u", 0, 4), (None, 0, 1), ("u", 0, None)]
    got = {r["trip_id"]: r for r in sequences.sequence_gaps(spark.createDataFrame(data, "trip_id string, direction_id int, stop_sequence int"), ["trip_id", "direction_id"]).collect()}
    t = got["t"]
    assert (t["n_distinct"], t["min_seq"], t["max_seq"], t["n_missing"], t["max_gap"], t["has_gap"]) == (4, 1, 600, 596, 594, True)
    assert t["fill_ratio"] == 4 / 600
    assert (got["u"]["max_gap"], got["u"]["has_gap"]) == (0, False) and None not in got


def test_stop_patterns_compare_whole_lists(spark):
    trips = {
        "a1": [(1, "A"), (2, "B"), (3, "B"), (4, "A")],
        "a2": [(1, "A"), (2, "B"), (3, "A"), (4, "B")],
        "a3": [(10, "A"), (20, "B"), (30, "B"), (40, "A")],  # same list, other numbers
        "a4": [(1, "A"), (1, "A")],
        "a5": [(1, "A"), (500, "A")],  # same list as a4, across segments
        "a6": [(1, "A")],
    }
    data = [("r", None, trip, s, stop) for trip, stops in trips.items() for s, stop in stops]
    got = sequences.stop_patterns(spark.createDataFrame(data, "route_id string, direction_id int, trip_id string, stop_sequence int, stop_id string")).first()
    assert (got["n_distinct_patterns"], got["n_trips"]) == (4, 6)


def test_describe_equals_pandas(spark):
    rng = random.Random(8)
    values = [rng.choice([7.0, rng.uniform(-5, 50), float(rng.randrange(10))]) for _ in range(401)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = profile.describe(df, "v").first()
    want = pd.Series(values).describe(percentiles=list(profile.QUANTILES))
    for name, label in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"),
                        ("p05", "5%"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("p95", "95%")]:
        assert got[name] == pytest.approx(want[label], rel=1e-12)


def test_histogram_equals_numpy(spark):
    rng = random.Random(9)
    values = [float(rng.randrange(1000)) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = [r["n_rows"] for r in profile.binned_histogram(df, F.col("v"), 48).orderBy("bin").collect()]
    assert got == np.histogram(values, bins=48)[0].tolist()
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["n_rows"] for r in profile.binned_histogram(same, F.col("v"), 5).collect()) == 2


def test_profile_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1), ("b", 2)], "x string, y int")
    assert {r["column_name"]: (r["null_count"], r["null_rate"]) for r in profile.null_profile(df).collect()} == {"x": (1, 0.25), "y": (1, 0.25)}
    assert {r["column_name"]: r["n_distinct"] for r in profile.distinct_counts(df, ["x", "y"]).collect()} == {"x": 2, "y": 2}
    assert [(r["value"], r["n_rows"]) for r in profile.value_counts(df, "x", 2).collect()] == [("a", 2), ("b", 1)]
    assert profile.fd_violations(df, ["x"], "y").count() == 0
    wide = df.union(spark.createDataFrame([("a", 5)], df.schema))
    assert [tuple(r) for r in profile.fd_violations(wide, ["x"], "y").collect()] == [("a", 2)]


def test_one_heavy_key_is_scanned_by_many_tasks(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan.scan_in_segments(rows, ["k"], ["id"], F.floor(F.col("id") / 500), previous=("id", "p"), before=("id", "b"))
        per_task = out.groupBy(F.spark_partition_id().alias("t")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 15_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "__kind" in line]
    assert windows and all("__seg" in w for w in windows)


def test_newest_per_key_shrinks_before_the_shuffle(spark):
    from fogline.operators.latest import latest_per_key

    rows = spark.range(1000).select(F.lit("hot").alias("k"), "id", F.col("id").cast("string").alias("v"))
    plan = latest_per_key(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[max(") < plan.index("Exchange") < plan.index("partial_max(")
