import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from fogline.operators import checks, joins, latest, merge
from fogline.operators.checks import QualityError
from fogline.operators.keys import CANONICAL_KEY, selective_first

KEY_DDL = (
    "agency_id string, trip_id string, trip_start_date string, trip_start_time string, "
    "direction_id int, stop_sequence int"
)
ROW = ("muni", "trip-1", "2026-06-23", None, None, 7)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def T(s):
    return dt.datetime(2026, 6, 23, 0, 0, s)


def test_canonical_key_columns():
    assert CANONICAL_KEY == (
        "agency_id", "trip_id", "trip_start_date", "trip_start_time", "direction_id", "stop_sequence",
    )
    assert sorted(selective_first(CANONICAL_KEY)) == sorted(CANONICAL_KEY)


def test_duplicate_canonical_rows_are_refused_with_null_keys_equal(spark):
    df = spark.createDataFrame([ROW, ROW], KEY_DDL)
    with pytest.raises(QualityError, match="duplicate"):
        checks.require_unique(df, CANONICAL_KEY, "stage")
    checks.require_unique(df.limit(1), CANONICAL_KEY, "stage")


def test_missing_key_column_is_refused(spark):
    with pytest.raises(QualityError, match="stop_sequence"):
        checks.require_unique(spark.createDataFrame([ROW], KEY_DDL).drop("stop_sequence"), CANONICAL_KEY, "stage")


def tu_rows(spark, items):
    ddl = KEY_DDL + (
        ", snapshot_ts timestamp, blob_order bigint, blob_name string, route_id string, stop_id string,"
        " arrival_time_predicted timestamp, departure_time_predicted timestamp, arrival_delay_sec int,"
        " departure_delay_sec int"
    )
    return spark.createDataFrame(items, ddl)


def tu(start_time=None, ts=T(1), order=0, name="a.pb", stop="s1", agency="muni"):
    return (agency, "trip-1", "2026-06-23", start_time, None, 7, ts, order, name, "r", stop, T(9), T(9), 5, 5)


def test_start_times_keep_rows_apart(spark):
    got = latest.latest_trip_updates(tu_rows(spark, [tu("08:00:00"), tu("09:00:00"), tu("09:00:00")]))
    assert got.count() == 2
    assert "latest_snapshot_ts" in got.columns and "blob_name" not in got.columns


@pytest.mark.parametrize(
    "items,winner",
    [
        ([tu(ts=T(1), stop="old"), tu(ts=T(2), stop="new")], "new"),
        ([tu(order=1, stop="old"), tu(order=2, stop="new")], "new"),
        ([tu(name="a", stop="old"), tu(name="b", stop="new")], "new"),
        ([tu(ts=None, order=9, stop="untimed"), tu(ts=T(1), stop="timed")], "timed"),
    ],
)
def test_latest_order(spark, items, winner):
    for permutation in itertools.permutations(items):
        got = latest.latest_trip_updates(tu_rows(spark, list(permutation))).collect()
        assert [r["stop_id"] for r in got] == [winner]


def test_latest_vehicle_positions_need_identity_and_time(spark):
    ddl = KEY_DDL + ", vp_snapshot_ts timestamp, blob_order bigint, blob_name string, vehicle_id string"
    base = ("muni", "trip-1", "2026-06-23")
    df = spark.createDataFrame(
        [
            (*base, "08:00:00", None, 7, T(1), 0, "a", "v1"),
            (*base, "09:00:00", None, 7, T(1), 0, "a", "v2"),
            (*base, "10:00:00", None, None, T(1), 0, "a", "v3"),
            (*base, "11:00:00", None, 7, None, 0, "a", "v4"),
            ("muni", None, "2026-06-23", None, None, 7, T(1), 0, "a", "v5"),
        ],
        ddl,
    )
    assert {r["vehicle_id"] for r in latest.latest_vehicle_positions(df).collect()} == {"v1", "v2"}


def test_narrow_newest_row_is_the_same_row(spark):
    # Equal up to the last column: which one wins is decided behind the order columns.
    data = [(1, 5, "a", "x", 1.0), (1, 5, "a", "y", 0.0), (1, 5, "a", "y", 2.0), (1, 4, "z", "z", 9.0), (None, None, "q", None, 3.0), (None, None, "q", "m", None)]
    df = spark.createDataFrame(data, "k int, o int, p string, v string, w double")
    whole = latest.latest_per_key(df, ["k"], ["o", "p"])
    for columns in ([], ["o"], ["p"], ["v"], ["v", "o"], ["w"]):
        narrow = latest.latest_per_key(df, ["k"], ["o", "p"], columns)
        assert narrow.columns == ["k", *columns]
        assert rows(narrow) == rows(whole.select("k", *columns))
    shuffled = lambda found: found._jdf.queryExecution().optimizedPlan().toString()
    assert "w#" in shuffled(whole.select("k", "v")) and "w#" not in shuffled(latest.latest_per_key(df, ["k"], ["o", "p"], ["v"])).split("Project")[-2]
    assert "HashAggregate" in latest.latest_per_key(df, ["k"], ["o", "p"], ["o"])._jdf.queryExecution().executedPlan().toString()


def test_narrow_transit_day_equals_the_whole(spark):
    from fogline.plans import transit
    from tests.conftest import SF
    from workload.standins import Tables

    t = Tables(spark, SF)
    columns = ["trip_stop_id", "stop_id", "latest_snapshot_ts", "vehicle_id", "tu_vp_snapshot_delta_sec"]
    whole, narrow = transit.transit_day(t.trip_updates, t.vehicle_positions), transit.transit_day(t.trip_updates, t.vehicle_positions, columns)
    assert rows(narrow) == rows(whole.select(columns))
    assert "longitude" in str(whole._jdf.queryExecution().optimizedPlan()) and "longitude" not in str(narrow._jdf.queryExecution().optimizedPlan())


def test_registered_queries_split_wide_views_finely(spark):
    from tests.conftest import SF
    import workload.catalog  # noqa: F401
    from workload.registry import callable_for

    callable_for("latest_vehicle_positions")(spark, SF)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_keep_last_and_first_per_key(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (None, 5, "x"), (None, 6, "y")], "k int, o int, v string")
    assert rows(latest.keep_last(df, ["k"], "o").select("k", "v")) == rows(
        spark.createDataFrame([(1, "c"), (None, "y")], "k int, v string")
    )
    assert {r["v"] for r in latest.first_per_key(df, ["k"], ["o"]).collect()} == {"a", "x"}
    assert {r["v"] for r in latest.first_per_key(df, ["k"], [-F.col("o")]).collect()} == {"c", "y"}


def test_join_keeps_left_rows_and_matches_null_keys(spark):
    base = ("muni", "trip-1", "2026-06-23")
    left = spark.createDataFrame(
        [(*base, None, None, 7, "a"), (*base, "09:00:00", 1, 8, "b"), (*base, "09:00:00", 1, 9, "c")],
        KEY_DDL + ", stop_id string",
    )
    right = spark.createDataFrame(
        [(*base, None, None, 7.0, "vehicle-1"), (*base, "09:00:00", 1.0, 8.0, "vehicle-2")],
        KEY_DDL.replace("int", "double") + ", vehicle_id string",
    )
    joined = joins.join_vehicle_positions(left, right)
    assert {(r["stop_id"], r["vehicle_id"]) for r in joined.collect()} == {
        ("a", "vehicle-1"), ("b", "vehicle-2"), ("c", None),
    }
    stats = joins.join_stats(left, right, joined).first()
    assert stats["left_rows_kept"] and stats["matched_rows"] == 2
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_outcome_counts_equal_a_real_full_join(spark):
    rng = random.Random(5)
    make = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.randrange(2)) for _ in range(n)]
    left = spark.createDataFrame(make(60), "k int, s string, h int")
    right = spark.createDataFrame(make(40) + [(9, "z", 0)], "k int, s string, g int")
    marked_l, marked_r = left.withColumn("l", F.lit(1)), right.withColumn("r", F.lit(1))
    full = marked_l.join(marked_r, joins.null_safe(marked_l, marked_r, ["k", "s"]), "full_outer")
    outcome = F.when(F.col("l").isNull(), "right_only").when(F.col("r").isNull(), "left_only").otherwise("both")
    for by, side in (("h", "left"), ("g", "right")):
        want = {(r["o"], r[by]): r["count"] for r in full.groupBy(outcome.alias("o"), by).count().collect()}
        got = joins.outcome_counts(left, right, ["k", "s"], by=[by], side=side).collect()
        assert {(r["outcome"], r[by]): r["n_rows"] for r in got} == want
    want = {r["o"]: r["count"] for r in full.groupBy(outcome.alias("o")).count().collect()}
    for side in ("left", "right"):
        got = joins.outcome_counts(left, right, ["k", "s"], side=side).collect()
        assert {r["outcome"]: r["n_rows"] for r in got} == want
    keys = joins.key_coverage(left, right, ["k", "s"]).first()
    pairs = lambda df: {tuple(r) for r in df.select("k", "s").collect()}
    l, r = pairs(left), pairs(right)
    assert tuple(keys) == (len(l), len(r), len(l - r), len(r - l))


TIMES = [None, T(1), T(2)]


@pytest.mark.parametrize("target_ts,stage_ts", list(itertools.product(TIMES, TIMES)))
def test_freshness_guard_matrix(spark, target_ts, stage_ts):
    ddl = "k int, ts timestamp, v string"
    target = spark.createDataFrame([(None, target_ts, "target")], ddl)
    stage = spark.createDataFrame([(None, stage_ts, "stage")], ddl)
    update = target_ts is None or (stage_ts is not None and stage_ts >= target_ts)
    got = merge.upsert_latest(target, stage, ["k"], "ts").collect()
    assert [r["v"] for r in got] == ["stage" if update else "target"]


def test_guarded_merge_is_idempotent_and_order_independent(spark):
    rng = random.Random(1)
    ddl = "k int, d string, ts timestamp, v int"
    def batch(n):
        seen = {}
        for _ in range(n):
            seen[(rng.choice([None, *range(8)]), rng.choice([None, "x"]))] = None
        return [(k, d, rng.choice([None, *map(T, range(9))]), rng.randrange(10**6)) for k, d in seen]
    target, one, two = (spark.createDataFrame(batch(12), ddl) for _ in range(3))
    step = lambda t, s: merge.upsert_latest(t, s, ["k", "d"], "ts")
    once = step(target, one)
    assert rows(step(once, one)) == rows(once)
    # Equal times let the later delivery win, so compare times only where they are distinct.
    a = {(r["k"], r["d"]): r["ts"] for r in step(step(target, one), two).collect()}
    b = {(r["k"], r["d"]): r["ts"] for r in step(step(target, two), one).collect()}
    assert a == b


def test_upsert_by_key_updates_inserts_and_keeps_target_duplicates(spark):
    target = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "c", 12), (None, "n", 13)], "id int, v string, fk int")
    stage = spark.createDataFrame([(1, "new"), (3, "ins"), (None, "null-key")], "id int, v string")
    got = rows(merge.upsert_by_key(target, stage, ["id"]))
    want = [(1, "new", 10), (1, "new", 11), (2, "c", 12), (None, "n", 13), (3, "ins", None), (None, "null-key", None)]
    assert got == sorted(want, key=repr)


def test_rental_upsert_can_reopen_an_episode(spark):
    ddl = "rentcast_id string, listed_date timestamp, removed_date timestamp"
    target = spark.createDataFrame([("L1", T(1), T(5))], ddl)
    stage = spark.createDataFrame([("L1", T(1), None)], ddl)
    got = merge.upsert_by_key(target, stage, ["rentcast_id", "listed_date"]).first()
    assert got["removed_date"] is None


def test_close_missing_rules(spark):
    ddl = "rentcast_id string, removed_date timestamp"
    table = spark.createDataFrame([("L1", None), ("L2", None), ("L3", T(1)), (None, None)], ddl)
    active = spark.createDataFrame([("L1",), ("L1",), (None,)], "rentcast_id string")
    previous, today = dt.date(2026, 7, 1), dt.date(2026, 7, 2)
    got = {r["rentcast_id"]: r["removed_date"] for r in merge.close_missing(table, active, today, previous).collect()}
    closed = dt.datetime(2026, 7, 1)
    assert got == {"L1": None, "L2": closed, "L3": T(1), None: closed}
    same_day = merge.close_missing(table, active, previous, previous)
    assert rows(same_day) == rows(table)
    with pytest.raises(QualityError, match="earlier"):
        merge.close_missing(table, active, previous, today)


def test_replace_days_empties_days_without_rows(spark):
    ddl = "id int, day date"
    d = lambda n: dt.date(2026, 3, n)
    target = spark.createDataFrame([(1, d(1)), (2, d(2)), (3, d(3)), (4, None)], ddl)
    incoming = spark.createDataFrame([(20, d(2)), (21, d(2))], ddl)
    got = merge.replace_days(target, incoming, F.col("day"), [d(2), d(3)])
    assert {r["id"] for r in got.collect()} == {1, 4, 20, 21}
    assert rows(merge.replace_days(got, incoming, F.col("day"), [d(2), d(3)])) == rows(got)


def test_update_state_touches_exactly_one_row(spark):
    ddl = "pipeline_name string, last_successful_snapshot_date date, expected_active_count bigint, loaded_active_count bigint, updated_at timestamp"
    state = spark.createDataFrame([("a", dt.date(2026, 1, 1), 1, 1, T(1)), ("b", dt.date(2026, 1, 1), 1, 1, T(1))], ddl)
    args = (dt.date(2026, 1, 2), F.lit(5), F.lit(5), F.lit("2026-01-02").cast("timestamp"))
    got = {r["pipeline_name"]: r["expected_active_count"] for r in merge.update_state(state, "a", *args).collect()}
    assert got == {"a": 5, "b": 1}
    for bad in (state.where("pipeline_name = 'b'"), state.union(state)):
        with pytest.raises(QualityError, match="exactly one"):
            merge.update_state(bad, "a", *args)


def test_foreign_keys_are_overwritten_even_by_null_and_never_inserted(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, fk int")
    assigned = spark.createDataFrame([("a", 9), ("b", None), ("zz", 5)], "id string, fk int")
    assert rows(merge.update_foreign_keys(target, assigned, ["id"], ["fk"])) == [("a", 9), ("b", None), ("c", 3)]


def test_surrogate_key_separates_null_blank_and_shifted_parts(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("a|", ""), ("a", "|")], "x string, y string")
    ids = [r[0] for r in df.select(merge.surrogate_key(["x", "y"])).collect()]
    assert len(set(ids)) == 5
    assert ids == [r[0] for r in df.select(merge.surrogate_key(["x", "y"])).collect()]


def test_snapshot_gates(spark):
    ddl = "id string"
    assert checks.require_complete_snapshot(spark.createDataFrame([("a",), ("b",)], ddl), "id", 2) == 2
    for bad, total in (([], None), ([("a",), ("a",)], None), ([("a",), (None,)], None), ([("a",)], 2)):
        with pytest.raises(QualityError):
            checks.require_complete_snapshot(spark.createDataFrame(bad, ddl), "id", total)


def test_dq_report_severities(spark):
    rules = checks.Rules(
        "m", not_null=("a",), unique=("a",), accepted={"b": ("x",)},
        violations={"positive": F.col("c") <= 0}, warn=("unique(a)",),
    )
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 0), (None, None, 1)], "a int, b string, c int")
    got = {r["check_name"]: (r["severity"], r["failures"]) for r in checks.dq_report(df, rules).collect()}
    assert got == {
        "not_null(a)": ("error", 1), "accepted_values(b)": ("error", 1), "positive": ("error", 1), "unique(a)": ("warn", 1),
    }
    with pytest.raises(QualityError):
        checks.require_passed(checks.dq_report(df, rules))
    checks.require_passed(checks.dq_report(df.where("false"), rules))


def test_empty_like(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert merge.empty_like(df).schema == df.schema and merge.empty_like(df).isEmpty()


def test_counts_are_observed_during_a_write(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    watched, seen = checks.observe_counts(df, "stats", missing=F.col("a").isNull())
    watched.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 3, "missing": 1}


def test_missing_identity_split(spark):
    df = spark.createDataFrame([("t", 1), (None, 1), ("t", None)], "trip_id string, stop_sequence int")
    complete, counts = checks.split_missing_identity(df, ["trip_id", "stop_sequence"])
    assert df.where(complete).count() == 1
    assert tuple(counts.first()) == (3, 1, 2)


def test_latest_carries_columns_that_have_no_order(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, o int, m map<string,int>")
    assert latest.keep_last(df, ["k"], "o").first()["m"] == {"b": 2}


def test_fused_transit_day_equals_newest_then_join(spark):
    from fogline.plans import transit
    from tests.conftest import SF
    from workload.standins import Tables

    t = Tables(spark, SF)
    updates, positions = t.trip_updates, t.vehicle_positions
    apart = joins.join_vehicle_positions(
        latest.latest_trip_updates(updates), latest.latest_vehicle_positions(positions)
    )
    together = transit.newest_joined(updates, positions)
    assert sorted(together.columns) == sorted(apart.columns)
    columns = sorted(apart.columns)
    assert rows(together.select(columns)) == rows(apart.select(columns))
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_upsert_refuses_a_key_staged_twice(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k bigint, v string")
    staged = lambda *rows_: spark.createDataFrame(list(rows_), "k bigint, v string")
    got = merge.upsert_by_key(target, staged((1, "A"), (3, "C"), (None, "x"), (None, "y")), ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "A"), (2, "b"), (3, "C"), (None, "n"), (None, "x"), (None, "y")], key=str)
    for twice in (((1, "A"), (1, "B")), ((9, "A"), (9, "A"))):
        with pytest.raises(Exception, match="staged more than once"):
            merge.upsert_by_key(target, staged(*twice), ["k"]).collect()
