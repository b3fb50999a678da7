import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fogline.operators.checks import QualityError
from fogline.plans import jobs, metrics
from fogline.plans.marts import gold_rental_listings
from fogline.schemas import PIPELINE_STATE, STOPS
from fogline.plans.runs import RUNS, recorded
from fogline.sources.tables import FileTable
from tests.test_metrics import U, event, events
from tests.test_sources import add_trip, feed, land, put

DIM_DDL = "id bigint, name string, geometry string"


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([(7, "Mission", "POLYGON ((-1 -1, 1 -1, 1 1, -1 1, -1 -1))")], DIM_DDL)


def test_police_window_is_rebuilt_and_idempotent(spark, tmp_path, dim):
    base, table = tmp_path / "raw", str(tmp_path / "police")

    def deliver(day, *ids):
        records = [
            {"incident_id": i, "incident_datetime": f"{day}T12:00:00.000", "point": {"type": "Point", "coordinates": [0.5, 0.5]} if i != "nowhere" else None}
            for i in ids
        ]
        put(base / f"incident_date={day}" / "r.json", records)

    deliver("2026-03-01", "a")
    deliver("2026-03-02", "b", "b", "nowhere")
    deliver("2026-03-03", "c")
    run = lambda days: jobs.refresh_police(spark, str(base), table, dim, dim, "2026-03-03", days, cell=0.5)
    read = lambda: sorted((r["police_incident_id"], r["neighborhood_id"], str(r["incident_date"])) for r in jobs.police_table(spark, table).read().collect())
    run(3)
    first = read()
    assert first == [("a", 7, "2026-03-01"), ("b", 7, "2026-03-02"), ("b", 7, "2026-03-02"), ("c", 7, "2026-03-03"), ("nowhere", None, "2026-03-02")]
    run(3)
    assert read() == first
    deliver("2026-03-02", "d")
    deliver("2026-03-03")
    deliver("2026-03-01", "changed but outside the window")
    run(2)
    assert read() == [("a", 7, "2026-03-01"), ("d", 7, "2026-03-02")]


def test_311_upsert(spark, tmp_path, dim):
    table = jobs.incidents_table(spark, str(tmp_path / "t"))
    record = lambda i, status: {"service_request_id": i, "status_description": status, "lat": "0", "long": "0"}
    jobs.refresh_311(spark, put(tmp_path / "d1", [record("1", "Open"), record("2", "Open")]), table, dim, dim, cell=0.5)
    jobs.refresh_311(spark, put(tmp_path / "d2", [record("2", "Closed"), record("3", "Open")]), table, dim, dim, cell=0.5)
    assert sorted((r["311_incident_id"], r["status_description"]) for r in table.read().collect()) == [(1, "Open"), (2, "Closed"), (3, "Open")]


def rental(i, listed="2026-06-01T00:00:00.000Z", price=10):
    return {"id": i, "formattedAddress": "a", "latitude": 37.75, "longitude": -122.4, "bedrooms": 1,
            "history": {"2026-06-01": {"event": "Rental Listing", "price": price, "listedDate": listed, "removedDate": None}}}


def test_rental_state_machine(spark, tmp_path, dim):
    listings, state = jobs.listings_table(spark, str(tmp_path / "listings")), FileTable(spark, str(tmp_path / "state"))
    empty = jobs.clean.clean_rentals(
        jobs.read_json_snapshot(spark, put(tmp_path / "none", []), jobs.RAW_RENTAL), dim, dim
    )
    listings.replace(empty)
    state.replace(spark.createDataFrame([("rentcast_active", dt.date(2026, 6, 30), 0, 0, None), ("other", None, 0, 0, None)], PIPELINE_STATE))
    now = F.lit("2026-07-02 09:00:00").cast("timestamp")

    def run(day, records, name="s"):
        jobs.refresh_rentals(spark, put(tmp_path / f"{name}{day}", records), listings, state, dim, dim, dt.date(2026, 7, day), now)

    def table():
        return {r["rentcast_id"]: r["removed_date"] for r in listings.read().collect()}

    run(1, [rental("L1"), rental("L2")])
    assert table() == {"L1": None, "L2": None}
    run(1, [rental("L1")], "retry")  # same day: nothing is closed
    assert table() == {"L1": None, "L2": None}
    run(2, [rental("L1", price=12)])
    assert table() == {"L1": None, "L2": dt.datetime(2026, 7, 1)}
    row = state.read().where("pipeline_name = 'rentcast_active'").first()
    assert (row["last_successful_snapshot_date"], row["loaded_active_count"]) == (dt.date(2026, 7, 2), 1)
    before = listings.versions()
    for day, records in ((1, [rental("L1")]), (3, []), (3, [rental("L1"), rental("L1")])):
        with pytest.raises(QualityError):
            run(day, records, "bad")
    assert listings.versions() == before and state.read().count() == 2
    run(3, [rental("L1"), rental("L2")])  # re-listed under the same episode: open again
    assert table() == {"L1": None, "L2": None}


def test_stops_keep_ids_until_reassigned(spark, tmp_path, dim):
    table = FileTable(spark, str(tmp_path / "stops"))
    table.replace(spark.createDataFrame([("1", "muni", "old", 0.0, 0.0, "POINT(0.0 0.0)", 7, 7), ("9", "bart", "b", 0.0, 0.0, "POINT(0.0 0.0)", 1, 1)], STOPS))
    doc = {"stops": [{"id": "1", "Name": "new", "Location": {"Longitude": 50, "Latitude": 50}}, {"id": "2", "Location": {"Longitude": 0.5, "Latitude": 0.5}}]}
    jobs.refresh_stops(spark.createDataFrame([("muni", json.dumps(doc))], "agency_id string, document string"), table, dim, dim, ["muni"], cell=0.5)
    got = {(r["agency_id"], r["stop_id"]): (r["stop_name"], r["neighborhood_id"]) for r in table.read().collect()}
    assert got == {("muni", "1"): ("new", None), ("muni", "2"): (None, 7), ("bart", "9"): ("b", 1)}


def test_transit_table_is_merged_by_service_date(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), str(tmp_path / "trip_stops")
    for minute in range(2):
        message = feed()
        message.header.timestamp += 60 * minute
        add_trip(message)
        land(tmp_path, f"2026-06-23T00-0{minute}-00.000000Z.pb", message)
    position = feed()
    v = position.entity.add(id="1").vehicle
    v.trip.trip_id, v.trip.start_date, v.current_stop_sequence, v.vehicle.id = "t1", "20260623", 7, "bus-1"
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", position, "VehiclePositions")
    for _ in range(2):
        jobs.refresh_transit_day(spark, raw, table, "muni", "2026-06-23")
    got = jobs.trip_stops_table(spark, table).read().collect()
    assert len(got) == 1 and got[0]["vehicle_id"] == "bus-1" and str(got[0]["trip_start_date"]) == "2026-06-23"


def test_dashboard_of_an_empty_boundary(spark):
    rentals = spark.createDataFrame([], "neighborhood_id string, police_district_id string, bedroom_bucket string, price bigint, listed_date timestamp, removed_date timestamp")
    facts = events(spark, [event("311", U(10, 12), nb="1", category="b"), event("311", U(10, 12), nb="1", category="a")])
    args = ("2026-06-10", "2026-06-10", "00:00", "23:59", F.lit("2026-07-01").cast("timestamp"), F.lit("2026-07-01").cast("date"))
    none = metrics.boundary_metrics(facts, rentals, "neighborhoods", "99", *args)
    row = none["totals"].first()
    assert (row["incidents_311_total"], row["transit_median_delay_sec"], row["transit_pct_delay_over_300_sec"]) == (0, None, None)
    assert [r["bedroom_bucket"] for r in none["rentals"].collect()] == ["studio", "1bd", "2bd", "3bd", "4bd+"]
    some = metrics.boundary_metrics(facts, rentals, "neighborhoods", "1", *args)
    assert [r["category"] for r in some["hist_311"].collect()] == ["a", "b"] and some["hist_police"].count() == 0
    assert some["totals"].count() == 1


def test_default_date_range(spark):
    today = dt.date(2026, 7, 10)
    assert metrics.default_date_range(events(spark, [event("311", U(1))]), today) == ("2026-07-03", "2026-07-10")
    full = [event(k, U(d, 12)) for k in ("311", "police", "transit") for d in (1, 20)]
    assert metrics.default_date_range(events(spark, full), today) == ("2026-06-01", "2026-06-20")


def test_marts_are_written(spark, tmp_path):
    from tests.conftest import SF
    from workload.standins import Tables

    t = Tables(spark, SF)
    args = (t.incidents_311, t.police_incidents, t.trip_stops, t.stops, t.neighborhoods, t.police_districts)
    # Some stand-in listings are removed before they are listed, which the checks refuse.
    with pytest.raises(QualityError, match="removal_after_listing"):
        jobs.build_marts(*args, t.rental_listings, str(tmp_path / "refused"))
    good = t.rental_listings.where("removed_date IS NULL OR removed_date >= listed_date")
    jobs.build_marts(*args, good, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "gold_dashboard_events")).count() == t.gold_events.count()
    assert spark.read.parquet(str(tmp_path / "gold_rental_listings")).count() == gold_rental_listings(good).count()
    assert spark.read.parquet(str(tmp_path / "gold_boundaries")).count() == 135


def test_every_job_leaves_a_row(spark, tmp_path, dim):
    runs = FileTable(spark, str(tmp_path / "runs"))
    put(tmp_path / "raw" / "incident_date=2026-03-01" / "r.json", [{"incident_id": "a", "incident_datetime": "2026-03-01T12:00:00.000", "point": None}])
    jobs.refresh_police(spark, str(tmp_path / "raw"), str(tmp_path / "police"), dim, dim, "2026-03-01", 1, cell=0.5, runs=runs)
    records = [{"service_request_id": i, "status_description": "Open", "lat": "0", "long": "0"} for i in ("1", "2")]
    jobs.refresh_311(spark, put(tmp_path / "d1", records), jobs.incidents_table(spark, str(tmp_path / "t")), dim, dim, cell=0.5, runs=runs)
    listings, state = jobs.listings_table(spark, str(tmp_path / "listings")), FileTable(spark, str(tmp_path / "state"))
    listings.replace(jobs.clean.clean_rentals(jobs.read_json_snapshot(spark, put(tmp_path / "none", []), jobs.RAW_RENTAL), dim, dim))
    state.replace(spark.createDataFrame([("rentcast_active", dt.date(2026, 6, 30), 0, 0, None)], PIPELINE_STATE))
    without = rental("L2") | {"history": {}}
    refresh = lambda day, found: jobs.refresh_rentals(
        spark, put(tmp_path / f"s{day}", found), listings, state, dim, dim, dt.date(2026, 7, day), F.current_timestamp(), runs=runs
    )
    refresh(2, [rental("L1"), without])
    with pytest.raises(QualityError):
        refresh(1, [rental("L1")])
    stops = FileTable(spark, str(tmp_path / "stops"))
    stops.replace(spark.createDataFrame([], STOPS))
    doc = {"stops": [{"id": "2", "Location": {"Longitude": 0.5, "Latitude": 0.5}}]}
    jobs.refresh_stops(spark.createDataFrame([("muni", json.dumps(doc))], "agency_id string, document string"), stops, dim, dim, ["muni"], cell=0.5, runs=runs)
    message = feed()
    add_trip(message)
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", message)
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", feed(), "VehiclePositions")
    jobs.refresh_transit_day(spark, str(tmp_path / "raw"), str(tmp_path / "trip_stops"), "muni", "2026-06-23", runs=runs)
    rows = runs.read().orderBy("started_at").collect()
    assert [(r["job"], r["outcome"]) for r in rows] == [
        ("police", "done"), ("311", "done"), ("rentals", "done"), ("rentals", "failed"), ("stops", "done"), ("transit_day", "done"),
    ]
    assert [r["counts"] for r in rows] == [
        {"cleaned": 1, "cleaned_without_point": 1},
        {"read": 2},
        {"read": 2, "listings": 2, "listings_without_history": 1},
        {},
        {"read": 1},
        {"joined": 1, "joined_with_vehicle": 0},
    ]
    assert "QualityError" in rows[3]["error"] and all(r["finished_at"] >= r["started_at"] for r in rows)


def test_statistics_of_jobs_that_end_together(spark, tmp_path):
    path = str(tmp_path / "runs")
    with recorded(spark, FileTable(spark, path), "outer") as run:
        run.note(a=1)
        with recorded(spark, FileTable(spark, path), "inner"):
            pass
    assert {r["job"] for r in FileTable(spark, path).read().collect()} == {"outer", "inner"}
    assert FileTable(spark, path).read().schema == spark.createDataFrame([], RUNS).schema


def test_transit_files_are_sorted_by_the_key(spark, tmp_path):
    for minute, trips in ((0, ("t9", "t1", "t5")), (1, ("t7", "t3"))):
        message = feed()
        message.header.timestamp += 60 * minute
        for trip in trips:
            add_trip(message, trip_id=trip)
        land(tmp_path, f"2026-06-23T00-0{minute}-00.000000Z.pb", message)
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", feed(), "VehiclePositions")
    jobs.refresh_transit_day(spark, str(tmp_path / "raw"), str(tmp_path / "ts"), "muni", "2026-06-23")
    table = jobs.trip_stops_table(spark, str(tmp_path / "ts"))
    for row in table.files(table.state()).collect():
        trips = [r["trip_id"] for r in spark.read.parquet(f"{table.path}/data/{row['file']}").collect()]
        assert trips == sorted(trips) and (row["least"]["trip_id"], row["greatest"]["trip_id"]) == (trips[0], trips[-1])
