import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fogline.operators.checks import dq_report, require_passed
from fogline.plans import marts, metrics
from fogline.sources.writers import write_mart

EVENT_DDL = (
    "event_id string, event_type string, event_ts_utc timestamp, event_date_pacific date, event_tod_us bigint, "
    "neighborhood_id string, police_district_id string, category string, arrival_delay_sec double"
)


def event(kind, ts, nb="1", pd="1", category=None, delay=None):
    local = ts - dt.timedelta(hours=7)
    tod = ((local.hour * 60 + local.minute) * 60 + local.second) * 10**6 + local.microsecond
    return (f"{kind}:{ts}", kind, ts, local.date(), tod, nb, pd, category, delay)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT_DDL)


def U(*a):
    return dt.datetime(2026, 6, *a)


def one(df, **where):
    for k, v in where.items():
        df = df.where(F.col(k) == v)
    got = df.collect()
    assert len(got) == 1, got
    return got[0]


@pytest.mark.parametrize(
    "spans,expected",
    [
        ({"311": (1, 10), "police": (3, 12), "transit": (5, 20)}, (5, 10)),
        ({"311": (1, 2), "police": (3, 12), "transit": (5, 20)}, (1, 20)),
        ({"311": (1, 10), "police": (3, 12)}, (None, None)),
        ({}, (None, None)),
    ],
)
def test_time_bounds(spark, spans, expected):
    rows = [event(k, U(d)) for k, span in spans.items() for d in span]
    got = metrics.time_bounds(events(spark, rows)).first()
    assert (got["start_ts"], got["end_ts"]) == tuple(None if d is None else U(d) for d in expected)


def test_event_selection_is_half_open_in_time_and_inclusive_in_the_clock(spark):
    rows = [
        event("311", U(10, 7)),  # Pacific midnight that starts the range
        event("311", U(10, 6, 59, 59, 999999)),  # just before
        event("311", U(12, 6, 59)),  # 23:59 on the last day
        event("311", U(12, 6, 59, 0, 1)),  # past 23:59:00
        event("311", U(12, 7)),  # midnight after the range
    ]
    chosen = metrics.select_events(events(spark, rows), "2026-06-10", "2026-06-11")
    assert {r["event_ts_utc"] for r in chosen.collect()} == {U(10, 7), U(12, 6, 59)}


def test_kpis(spark):
    rows = [event("transit", U(10, 12, i), delay=d) for i, d in enumerate([10.0, 301.0, 300.0, None])]
    rows += [event("311", U(10, 12), nb="404"), event("police", U(10, 12), nb=None)]
    df = events(spark, rows)
    for kpis in (metrics.boundary_kpis(df), metrics.boundary_kpis_approx(df)):
        transit = one(kpis, boundary_type="neighborhoods", boundary_id="1")
        assert (transit["transit_arrivals_total"], transit["transit_median_delay_sec"]) == (4, 300.0)
        assert transit["transit_pct_delay_over_300_sec"] == pytest.approx(100 / 3)
        unlocated = one(kpis, boundary_type="neighborhoods", boundary_id="404")
        assert (unlocated["incidents_311_total"], unlocated["transit_pct_delay_over_300_sec"]) == (1, None)
        district = one(kpis, boundary_type="police_districts")
        assert (district["incidents_311_total"], district["police_total"]) == (1, 1)
        assert kpis.where("boundary_id IS NULL").isEmpty() and kpis.count() == 3


def test_median_with_one_heavy_boundary(spark):
    rng = random.Random(3)
    rows = [event("transit", U(10, 12), nb="hot" if rng.random() < 0.8 else str(rng.randrange(5)), delay=float(rng.choice([5, rng.randrange(-300, 900)]))) for _ in range(1500)]
    got = {r["boundary_id"]: r["transit_median_delay_sec"] for r in metrics.boundary_kpis(events(spark, rows)).where("boundary_type = 'neighborhoods'").collect()}
    for boundary in got:
        delays = sorted(r[8] for r in rows if r[5] == boundary)
        assert got[boundary] == delays[(len(delays) + 1) // 2 - 1]


def test_histogram_order_and_top(spark):
    rows = [event("311", U(10, 12, i), category=c) for i, c in enumerate("bbaac")]
    top = metrics.category_top(metrics.category_histogram(events(spark, rows)), 2).where("boundary_type = 'neighborhoods'")
    assert [(r["category"], r["category_count"], r["category_rank"]) for r in top.orderBy("category_rank").collect()] == [("a", 2, 1), ("b", 2, 2)]


RENTAL_DDL = "neighborhood_id string, police_district_id string, bedroom_bucket string, price bigint, listed_date timestamp, removed_date timestamp"


def test_rental_comparison(spark):
    rows = [
        ("1", None, "studio", 1000, U(1), U(10, 7)),  # removed exactly at the start: not selected
        ("1", None, "studio", 2000, U(1), U(10, 7, 0, 1)),
        ("1", None, "studio", 4000, U(12, 7), None),  # listed exactly at the end: current only
        ("1", None, "1bd", 3000, U(1), None),
        ("1", None, "unknown", 9, U(1), None),
        ("2", None, "2bd", 5000, dt.datetime(2027, 1, 1), None),  # not listed yet
    ]
    got = metrics.rental_comparison(
        spark.createDataFrame(rows, RENTAL_DDL), "2026-06-10", "2026-06-11", F.lit("2026-07-01").cast("timestamp"), F.lit("2026-07-01").cast("date")
    ).orderBy("bucket_order").collect()
    assert [(r["bedroom_bucket"], r["selected_average_price"], r["selected_listing_count"], r["current_average_price"], r["current_listing_count"]) for r in got] == [
        ("studio", 2000.0, 1, 4000.0, 1), ("1bd", 3000.0, 1, 3000.0, 1), ("2bd", None, 0, None, 0), ("3bd", None, 0, None, 0), ("4bd+", None, 0, None, 0),
    ]
    assert {(r["boundary_type"], r["boundary_id"]) for r in got} == {("neighborhoods", "1")}


def test_gold_rentals_prefer_closed_episodes_and_positive_prices(spark):
    ddl = "rentcast_id string, listed_date timestamp, removed_date timestamp, neighborhood_id bigint, police_district_id bigint, property_type string, beds double, baths double, square_footage double, price bigint, formatted_address string, lat string, long string"
    base = lambda removed, price, beds=2.0, lat="37.7": ("L", U(1), removed, 1, None, "x", beds, 1.0, 1.0, price, "a", lat, "-122.4")
    rows = [base(None, 100), base(U(5), 200), base(U(9), 0), base(U(3), 300)]
    got = marts.gold_rental_listings(spark.createDataFrame(rows, ddl))
    row = got.first()
    assert got.count() == 1 and (row["price"], row["removed_date"], row["bedroom_bucket"]) == (200, U(5), "2bd")
    assert row["geometry"] == "POINT(-122.4 37.7)" and row["neighborhood_id"] == "1"
    require_passed(dq_report(got, marts.rental_rules()))
    beds = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 3.0, 4.0, 9.0, 1.5, None)], "b double")
    assert [r[0] for r in beds.select(marts.bedroom_bucket(F.col("b"))).collect()] == ["studio", "1bd", "2bd", "3bd", "4bd+", "4bd+", "unknown", "unknown"]


def test_stop_join_uses_the_agency_unless_asked_not_to(spark):
    trip_stops = spark.createDataFrame([("x", "muni", "S1", U(1), 5.0), ("y", "muni", "S1", None, 5.0)], "trip_stop_id string, agency_id string, stop_id string, arrival_time_predicted timestamp, arrival_delay_sec double")
    stops = spark.createDataFrame([("muni", "S1", 1, 2), ("bart", "S1", 3, 4)], "agency_id string, stop_id string, neighborhood_id bigint, police_district_id bigint")
    assert marts.transit_arrivals(trip_stops, stops).count() == 1
    assert marts.transit_arrivals(trip_stops, stops, legacy_stop_join=True).count() == 2


def test_null_incident_id_gives_null_event_id(spark):
    incidents = spark.createDataFrame([(None, 1, 1, U(1), " ")], "311_incident_id bigint, neighborhood_id bigint, police_district_id bigint, requested_datetime timestamp, service_name string")
    staged = marts.stage_311_incidents(incidents)
    assert staged.first()["category"] == "Unknown"


def test_trend_and_top_boundaries(spark):
    rows = [event("police", U(d, 12), nb=n) for d, n in [(1, "1"), (8, "1"), (8, "2"), (14, "2"), (15, "2")]]
    df = events(spark, rows)
    trend = metrics.daily_trend(df, "2026-06-15", 7, exclude_last_days=1)
    assert {(str(r["event_date_pacific"]), r["event_count"]) for r in trend.collect()} == {("2026-06-08", 2), ("2026-06-14", 1)}
    names = spark.createDataFrame([("neighborhoods", "1", "One"), ("neighborhoods", "2", "Two"), ("police_districts", "2", "No")], "boundary_type string, boundary_id string, boundary_name string")
    assert [(r["boundary_name"], r["event_count"]) for r in metrics.top_boundaries(df, names, "police", n=1).collect()] == [("Two", 3)]


def test_features_are_valid_json(spark):
    dim = spark.createDataFrame([(2, 'B "q"', "POLYGON ((0 0, 1 0, 1 1, 0 0))"), (1, None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), (404, "U", None), (None, "x", None)], "id bigint, name string, geometry string")
    features = metrics.boundary_features(marts.gold_boundaries(dim, dim.where("false")))
    got = metrics.feature_collection(features).first()
    doc = json.loads(got["geojson"])
    assert [(f["id"], f["properties"]["name"]) for f in doc["features"]] == [("1", "1"), ("2", 'B "q"')]
    assert got["id_to_name"] == {"1": "1", "2": 'B "q"'}


def test_date_filter_prunes_partitions_of_a_written_mart(spark, tmp_path):
    rows = [event("311", U(d, 12)) for d in range(1, 20)]
    write_mart(events(spark, rows), str(tmp_path / "mart"))
    chosen = metrics.select_events(spark.read.parquet(str(tmp_path / "mart")), "2026-06-10", "2026-06-11")
    scan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "event_date_pacific" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_ts_utc" in scan
    assert len(chosen.inputFiles()) >= 1 and chosen.count() == 2
