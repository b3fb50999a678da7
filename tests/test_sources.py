import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from fogline.operators import checks
from fogline.operators.checks import QualityError
from fogline.operators.keys import CANONICAL_KEY
from fogline.operators.merge import upsert_latest
from fogline.plans import clean, transit
from fogline.schemas import RAW_311, RAW_POLICE, RAW_RENTAL, TRIP_STOPS, TRIP_STOP_CONTRACT, project_contract
from fogline.sources import files, gtfs, stops, writers


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, bytes):
        path.write_bytes(content)
    else:
        path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


# ---- JSON


def test_json_array_keeps_record_order_and_file(spark, tmp_path):
    path = put(tmp_path / "2026-06-23_311_api_call", "﻿" + json.dumps([{"service_request_id": "1", "lat": 37.7}, {"service_request_id": "1", "lat": "37.8", "extra": 1}]))
    got = files.read_json_snapshot(spark, path, RAW_311).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["service_request_id"], r["lat"]) for r in got] == [(0, "1", "37.7"), (1, "1", "37.8")]
    assert got[0]["source_file"].endswith("_311_api_call")


def test_unreadable_documents_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="unreadable JSON document"):
        files.read_json_snapshot(spark, put(tmp_path / "bad", '[{"service_request_id": '), RAW_311).collect()
    assert files.read_json_snapshot(spark, put(tmp_path / "none", []), RAW_311).count() == 0


def test_json_lines_keep_file_order(spark, tmp_path):
    lines = "\n".join(json.dumps({"service_request_id": str(i), "lat": i}) for i in range(50))
    got = files.read_json_lines(spark, put(tmp_path / "d" / "a.json", lines), RAW_311).orderBy("ordinal").collect()
    assert [r["service_request_id"] for r in got] == [str(i) for i in range(50)] and got[0]["lat"] == "0"


def test_311_pipeline_from_files(spark, tmp_path):
    dim = spark.createDataFrame([(7, "Mission", "POLYGON ((-1 -1, 1 -1, 1 1, -1 1, -1 -1))")], "id bigint, name string, geometry string")
    records = [
        {"service_request_id": "1", "requested_datetime": "2026-06-01T10:00:00.000", "lat": "0.5", "long": "0.5", "status_description": "Open"},
        {"service_request_id": "1", "requested_datetime": "2026-06-01T10:00:00.000", "lat": "0.5", "long": "0.5", "status_description": "Closed", "supervisor_district": "3.0"},
        {"service_request_id": "2", "requested_datetime": None, "address": "Here", "neighborhoods_sffind_boundaries": "MISSION", "police_district": "mission"},
        {"service_request_id": "3", "address": "Not associated with a specific address"},
    ]
    raw = files.read_json_snapshot(spark, put(tmp_path / "f", records), RAW_311)
    codes = spark.createDataFrame([("Here", 0.0, 0.0), ("Not associated with a specific address", 0.0, 0.0)], "address string, lon double, lat double")
    got = {r["311_incident_id"]: r for r in clean.clean_311(raw, dim, dim, geocodes=codes, cell=0.5).collect()}
    assert got[1]["status_description"] == "Closed" and got[1]["supervisor_district"] == 3
    assert got[1]["requested_datetime"] == dt.datetime(2026, 6, 1, 10)
    assert got[2]["geometry"] == "POINT(0.0 0.0)" and got[2]["lat"] is None and got[2]["neighborhood_id"] == 7
    assert (got[3]["neighborhood_id"], got[3]["supervisor_district"], got[3]["status_notes"]) == (404, 404, None)
    assert list(clean.clean_311(raw, dim, dim).columns) == list(clean.INCIDENT_311_COLUMNS)


def test_311_record_without_an_id_is_refused(spark, tmp_path):
    dim = spark.createDataFrame([(7, "Mission", None)], "id bigint, name string, geometry string")
    for records in ([{"service_request_id": "x1"}], [{"lat": "0.5"}]):
        raw = files.read_json_snapshot(spark, put(tmp_path / f"f{len(str(records))}", records), RAW_311)
        with pytest.raises(Exception, match="without a numeric id"):
            clean.clean_311(raw, dim, dim).collect()


def test_history_keeps_document_order(spark, tmp_path):
    entry = lambda price: {"price": price, "listedDate": "2026-01-01T00:00:00.000Z"}
    record = {"id": "L1", "history": {"2026-02-01": entry(1), "2026-01-01": entry(2)}}
    raw = files.read_json_snapshot(spark, put(tmp_path / "s", [record]), RAW_RENTAL)
    assert [r["price"] for r in clean.rental_episodes(raw).collect()] == [2]


def test_police_days_read_only_the_window(spark, tmp_path):
    base = tmp_path / "raw"
    for day in ("2026-03-07", "2026-03-08", "2026-03-09"):
        record = {"incident_id": day, "incident_datetime": f"{day}T12:00:00.000", "report_datetime": "", "latitude": "x",
                  "longitude": "-122.4", "point": {"type": "Point", "coordinates": [-122.4, 37.7]}}
        put(base / f"incident_date={day}" / "reports.json", [record, {**record, "point": {"type": "Line", "coordinates": []}}])
    raw = files.read_day_partitions(spark, str(base), RAW_POLICE, "2026-03-09", 2)
    assert raw.count() == 4
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(incident_date" in plan
    got = clean.clean_police(raw).collect()
    # Noon is 20:00 UTC before the clocks change and 19:00 after.
    assert {r["incident_datetime"] for r in got} == {dt.datetime(2026, 3, 8, 19), dt.datetime(2026, 3, 9, 19)}
    assert {r["point"] for r in got} == {"POINT(-122.4 37.7)", None}
    assert {(r["lat"], r["long"], r["report_datetime"]) for r in got} == {(None, -122.4, None)}


def test_rental_history(spark, tmp_path):
    entry = lambda listed, price, removed=None: {"event": "Rental Listing", "price": price, "listedDate": listed, "removedDate": removed}
    common = {"formattedAddress": "a", "latitude": 37.75, "longitude": -122.4, "price": 1, "listedDate": "x"}
    records = [
        {"id": "L1", **common, "history": {"2026-01-01": entry("2026-01-01T00:00:00.000Z", 10, "2026-01-20T00:00:00.000Z"), "2026-02-01": entry("2026-02-01T00:00:00.000Z", 20)}},
        {"id": "L2", **common, "history": {"2026-01-01": entry("2026-01-01T00:00:00.000Z", 30), "2026-01-09": entry("2026-01-01T00:00:00.000Z", 31)}},
        {"id": "L3", **common, "history": None},
        {"id": "L4", **common, "history": {"2026-01-01": entry("soon", 40)}},
        {"id": None, **common, "history": {"2026-01-01": entry("2026-01-01T00:00:00.000Z", 50)}},
        {"id": "L5", **{**common, "longitude": -121.0}, "history": {"2026-01-01": entry("2026-01-01T00:00:00.000Z", 60)}},
    ]
    raw = files.read_json_snapshot(spark, put(tmp_path / "2026-07-01_rentals_api_call", records), RAW_RENTAL)
    got = clean.rental_episodes(raw).collect()
    assert {(r["rentcast_id"], r["listed_date"].date().isoformat(), r["price"]) for r in got} == {
        ("L1", "2026-01-01", 10), ("L1", "2026-02-01", 20), ("L2", "2026-01-01", 31), ("L5", "2026-01-01", 60),
    }
    dim = spark.createDataFrame([(1, "x", None)], "id bigint, name string, geometry string")
    placed = clean.clean_rentals(raw, dim, dim)
    assert placed.columns == list(clean.RENTAL_COLUMNS)
    assert {r["rentcast_id"] for r in placed.collect()} == {"L1", "L2"}
    codes = spark.createDataFrame([("a", -122.41, 37.76)], "address string, lon double, lat double")
    moved = {r["rentcast_id"]: r["long"] for r in clean.clean_rentals(raw, dim, dim, geocodes=codes).collect()}
    assert moved["L5"] == -122.41 and moved["L1"] == -122.4
    inventory = files.snapshot_inventory(raw, files.file_name_column(), "id", since="2026-06-11").first()
    assert (inventory["snapshot_date"], inventory["api_records"], inventory["distinct_ids"]) == ("2026-07-01", 6, 5)


def test_geojson_dimension(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"district": "SOUTHERN"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"district": "BAYVIEW"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"district": "NOWHERE"}, "geometry": None},
    ]}
    path = put(tmp_path / "d.geojson", doc)
    got = [tuple(r) for r in files.read_geojson(spark, path, "district", ["Southern", "Bayview", "Nowhere"]).orderBy("id").collect()]
    assert [g[:2] for g in got] == [(1, "Southern"), (2, "Bayview"), (3, "Nowhere")]
    assert got[0][2] == "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 1.0, 0.0 0.0))"
    assert got[1][2].startswith("MULTIPOLYGON (((0.0 0.0") and got[1][2].count("((") == 2 and got[2][2] is None
    assert files.read_geojson(spark, path, "district").orderBy("id").first()["name"] == "SOUTHERN"


# ---- stops


def test_stops_at_any_depth(spark):
    muni = {"Contents": {"dataObjects": {"ScheduledStopPoint": [
        {"id": 1, "Name": "One", "Location": {"Longitude": "-122.1", "Latitude": "37.1"}},
        {"ID": "2", "name": "Two", "location": {"LONGITUDE": -122.2, "latitude": 37.2}},
        {"id": "3", "Name": "No latitude", "Location": {"Longitude": "-122.3"}},
        {"id": "4", "Name": "Bad", "Location": {"Longitude": "x", "Latitude": "37"}},
        {"id": "1", "Name": "One again", "Location": {"Longitude": "-122.11", "Latitude": "37.11"}},
        {"Name": "No id", "Location": {"Longitude": "-1", "Latitude": "1"}},
    ]}}}
    bart = [[{"deep": [{"id": "1", "Location": {"Longitude": -1.5, "Latitude": 2.5}}]}]]
    docs = spark.createDataFrame([("muni", "﻿" + json.dumps(muni)), ("bart", json.dumps(bart)), ("bart", None)], "agency_id string, document string")
    got = {(r["agency_id"], r["stop_id"]): (r["stop_name"], r["stop_point"]) for r in stops.extract_stops(docs).collect()}
    assert got == {
        ("muni", "1"): ("One again", "POINT(-122.11 37.11)"), ("muni", "2"): ("Two", "POINT(-122.2 37.2)"),
        ("bart", "1"): (None, "POINT(-1.5 2.5)"),
    }


# ---- GTFS-Realtime


def feed(header=True, version="2.0"):
    message = gtfs.feed_message_class()()
    if header:
        message.header.gtfs_realtime_version = version
        message.header.timestamp = 1_782_172_800
    return message


def add_trip(message, trip_id="t1", start="20260623", stop="s1", seq=7):
    update = message.entity.add(id="e").trip_update
    update.trip.trip_id, update.trip.start_date = trip_id, start
    stu = update.stop_time_update.add()
    if seq is not None:
        stu.stop_sequence = seq
    stu.stop_id = stop
    return update, stu


def land(tmp_path, name, message, feed_name="TripUpdates", agency="muni", day="2026-06-23"):
    content = message if isinstance(message, bytes) else message.SerializePartialToString()
    return put(tmp_path / "raw" / feed_name / agency / day / name, content)


def test_trip_update_presence_rules(spark, tmp_path):
    first = feed()
    update, stu = add_trip(first)
    stu.arrival.time, stu.arrival.delay = 1_782_172_860, -30
    add_trip(first, trip_id="")
    add_trip(first, stop="")
    add_trip(first, seq=None)
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", first)
    second = feed(header=False)
    update, stu = add_trip(second, trip_id="t2", start="nonsense")
    update.trip.direction_id, update.trip.route_id, update.trip.start_time = 0, "", "08:00:00"
    stu.departure.delay = 0
    land(tmp_path, "2026-06-23T00-01-00.500000Z.pb", second)
    land(tmp_path, "notes.txt", b"ignored")
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, str(tmp_path / "raw")))
    assert [(r["feed"], r["agency_id"], str(r["source_date"]), r["blob_order"]) for r in manifest.orderBy("blob_order").collect()] == [
        ("TripUpdates", "muni", "2026-06-23", 0), ("TripUpdates", "muni", "2026-06-23", 1),
    ]
    records = gtfs.decode_trip_updates(manifest)
    got = {r["trip_id"]: r for r in gtfs.trip_update_observations(records).collect()}
    assert set(got) == {"t1", "t2"}
    one, two = got["t1"], got["t2"]
    assert (one["direction_id"], one["route_id"], one["trip_start_time"]) == (None, None, None)
    assert one["arrival_time_predicted"] == dt.datetime(2026, 6, 23, 0, 1) and one["arrival_delay_sec"] == -30
    assert one["departure_time_predicted"] is None and one["snapshot_ts_source"] == "header"
    assert two["direction_id"] == 0 and two["departure_delay_sec"] == 0 and two["arrival_delay_sec"] is None
    assert two["snapshot_ts"] == dt.datetime(2026, 6, 23, 0, 1, 0, 500000) and two["snapshot_ts_source"] == "filename_fallback"
    assert two["trip_start_date"] == dt.date(2026, 6, 23) and one["trip_start_date_raw"] == "20260623"
    report = gtfs.parse_report(records).first()
    assert (report["blobs_total"], report["blobs_failed"], report["rows_skipped_missing_identity"]) == (2, 0, 3)
    assert (report["snapshot_header_count"], report["snapshot_filename_fallback_count"]) == (1, 1)


def test_vehicle_presence_rules(spark, tmp_path):
    message = feed()
    v = message.entity.add(id="1").vehicle
    v.trip.trip_id, v.vehicle.id, v.current_stop_sequence = "t1", "bus-1", 0
    v.current_status, v.position.latitude, v.position.longitude = 0, 37.5, -122.25
    message.entity.add(id="2").vehicle.stop_id = ""
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", message, "VehiclePositions")
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, str(tmp_path / "raw")))
    got = {r["trip_id"]: r for r in gtfs.vehicle_position_observations(gtfs.decode_vehicle_positions(manifest)).collect()}
    assert (got["t1"]["stop_sequence"], got["t1"]["current_status"], got["t1"]["latitude"], got["t1"]["speed"]) == (0, 0, 37.5, None)
    blank = got[None]
    assert (blank["vp_stop_id"], blank["vehicle_id"], blank["latitude"], blank["current_status"], blank["position_timestamp"]) == (None,) * 5


def test_large_file_is_streamed_in_batches(spark, tmp_path):
    message = feed()
    update, _ = add_trip(message)
    for i in range(3 * gtfs.BATCH_ROWS):
        stu = update.stop_time_update.add()
        stu.stop_sequence, stu.stop_id = 100 + i, f"s{i}"
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", message)
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, str(tmp_path / "raw")))
    rows = gtfs.trip_update_observations(gtfs.decode_trip_updates(manifest))
    assert rows.agg(F.count_distinct("stop_sequence")).first()[0] == 3 * gtfs.BATCH_ROWS + 1


def test_one_corrupt_file_rejects_the_day(spark, tmp_path):
    good = feed()
    add_trip(good)
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", good)
    land(tmp_path, "2026-06-23T00-01-00.000000Z.pb", b"\xff")
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, str(tmp_path / "raw")))
    records = gtfs.decode_trip_updates(manifest)
    with pytest.raises(QualityError, match="1 file"):
        checks.require_no_decode_errors(records, "TripUpdates")
    target = spark.createDataFrame([], TRIP_STOPS)
    with pytest.raises(QualityError, match="decode"):
        transit.run_transit_day(manifest, manifest, target)
    with pytest.raises(QualityError, match="no rows"):
        transit.run_transit_day(manifest.where("false"), manifest, target)


def test_transit_day_end_to_end_and_rerun(spark, tmp_path):
    for i, delay in enumerate((10, 400)):
        message = feed()
        message.header.timestamp += 60 * i
        _, stu = add_trip(message)
        stu.arrival.time, stu.arrival.delay = 1_782_172_860 + delay, delay
        land(tmp_path, f"2026-06-23T00-0{i}-00.000000Z.pb", message)
    position = feed()
    v = position.entity.add(id="1").vehicle
    v.trip.trip_id, v.trip.start_date, v.current_stop_sequence, v.vehicle.id = "t1", "20260623", 7, "bus-1"
    land(tmp_path, "2026-06-23T00-00-00.000000Z.pb", position, "VehiclePositions")
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, str(tmp_path / "raw"))).persist()
    updates, positions = (manifest.where(F.col("feed") == f) for f in ("TripUpdates", "VehiclePositions"))
    target = spark.createDataFrame([], TRIP_STOPS)
    once = transit.run_transit_day(updates, positions, target)
    row = once.first()
    assert (row["arrival_delay_sec"], row["vehicle_id"], row["tu_vp_snapshot_delta_sec"]) == (400.0, "bus-1", 60.0)
    assert row["direction_id"] is None and len(row["trip_stop_id"]) == 64
    assert transit.run_transit_day(updates, positions, once).collect() == once.collect()
    older = once.withColumn("latest_snapshot_ts", F.col("latest_snapshot_ts") - F.make_dt_interval(hours=F.lit(1))).withColumn("vehicle_id", F.lit("stale"))
    assert upsert_latest(once, older, CANONICAL_KEY, "latest_snapshot_ts").first()["vehicle_id"] == "bus-1"
    manifest.unpersist()


def test_contract_fills_missing_columns_and_requires_keys(spark):
    df = spark.createDataFrame([("muni", "t", "2026-06-23", None, None, 7, "3")], "agency_id string, trip_id string, trip_start_date string, trip_start_time bigint, direction_id double, stop_sequence int, arrival_delay_sec string")
    row = project_contract(df, TRIP_STOP_CONTRACT, CANONICAL_KEY).first()
    assert row["trip_start_date"] == dt.date(2026, 6, 23) and row["arrival_delay_sec"] == 3.0 and row["vehicle_id"] is None
    with pytest.raises(ValueError, match="stop_sequence"):
        project_contract(df.drop("stop_sequence"), TRIP_STOP_CONTRACT, CANONICAL_KEY)


# ---- parquet, partitions, versions


def test_day_folder_or_single_file(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "muni" / "2026-06-23"))
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "muni" / "2026-06-24.parquet"))
    assert files.read_day_parquet(spark, str(tmp_path), "muni", "2026-06-23").count() == 3
    assert files.read_day_parquet(spark, str(tmp_path), "muni", "2026-06-24").count() == 5
    with pytest.raises(FileNotFoundError):
        files.read_day_parquet(spark, str(tmp_path), "muni", "2026-06-25")


def parquet_files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_rewriting_a_day_leaves_no_stale_shards_and_no_other_day(spark, tmp_path):
    args = (str(tmp_path), writers.Stage.JOINED, writers.Agency.MUNI)
    other = writers.replace_day(spark.range(10), *args, dt.date(2025, 3, 4), shards=3)
    path = writers.replace_day(spark.range(100), *args, dt.date(2025, 3, 5), shards=4)
    assert len(parquet_files(path)) == 4
    assert writers.replace_day(spark.range(20), *args, dt.date(2025, 3, 5), shards=2, sort=["id"]) == path
    assert len(parquet_files(path)) <= 2 and spark.read.parquet(path).count() == 20
    for name in parquet_files(path):
        ids = [r["id"] for r in spark.read.parquet(f"{path}/{name}").collect()]
        assert ids == sorted(ids)
    assert spark.read.parquet(other).count() == 10
    inventory = files.shard_inventory(spark, other).collect()
    assert sum(r["n_rows"] for r in inventory) == 10 and all(r["file_size"] > 0 for r in inventory)


def test_day_folders_have_known_parts_only():
    folder = writers.day_folder("/t/", writers.Stage.TRIP_UPDATES, writers.Agency.BART, dt.date(2025, 1, 2))
    assert folder == "/t/latest/TripUpdates/bart/2025-01-02"
    with pytest.raises(ValueError):
        writers.day_folder("/t", "raw/TripUpdates", writers.Agency.BART, dt.date(2025, 1, 2))
    with pytest.raises(ValueError):
        writers.day_folder("/t", writers.Stage.JOINED, "other", dt.date(2025, 1, 2))


def test_shards_and_chunks(spark, tmp_path):
    writers.write_shards(spark.range(100), str(tmp_path / "s"), shards=5)
    assert len(parquet_files(tmp_path / "s")) == 5
    writers.write_shards(spark.range(100).coalesce(1), str(tmp_path / "c"), chunk_rows=30)
    assert len(parquet_files(tmp_path / "c")) == 4


def test_ndjson_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "nd")
    day = lambda rows: spark.createDataFrame(rows, "id int, incident_date string")
    writers.write_ndjson_days(day([(1, "2026-03-01"), (2, "2026-03-02")]), path)
    writers.write_ndjson_days(day([(3, "2026-03-02")]), path)
    assert {r["id"] for r in spark.read.json(path).collect()} == {1, 3}


def test_mart_days(spark, tmp_path):
    path = str(tmp_path / "mart")
    day = lambda n: dt.date(2026, 3, n)
    ddl = "event_date_pacific date, event_type string, neighborhood_id string, police_district_id string, v int"
    make = lambda rows: spark.createDataFrame([(d, "311", "1", "1", v) for d, v in rows], ddl)
    writers.write_mart(make([(day(1), 1), (day(2), 2), (day(3), 3)]), path)
    pruned = spark.read.parquet(path).where(F.col("event_date_pacific") == day(1))
    assert "PartitionFilters: [isnotnull(event_date_pacific" in pruned._jdf.queryExecution().executedPlan().toString()
    writers.write_mart(make([(day(2), 20)]), path)
    assert {r["v"] for r in spark.read.parquet(path).collect()} == {1, 20, 3}


def test_boundary_dimension_as_csv(spark, tmp_path):
    dim = spark.createDataFrame([(2, "b, c", "POLYGON ((0 0, 1 0, 1 1, 0 0))"), (1, "a", None)], "id bigint, name string, geometry string")
    writers.write_boundary_dimension(dim, str(tmp_path))
    back = spark.read.option("header", True).schema("id bigint, name string, geometry string").csv(str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, dim.collect()))


def test_a_document_is_cleaned_once(spark):
    from fogline.sources.files import parse_json_array

    df = spark.createDataFrame([(1, '\ufeff [{"a": 1}, {"a": "2"}]')], "f int, d string")
    parsed = parse_json_array(df, "d", "a bigint")
    assert [(r["f"], r["ordinal"], r["a"]) for r in parsed.collect()] == [(1, 0, 1), (1, 1, 2)]
    generated = next(x for x in parsed._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate" in x)
    assert "from_json" in generated and "trim(" not in generated


def test_rental_documents_are_parsed_in_one_snapshot_only(spark):
    from tests.conftest import SF
    import workload.catalog  # noqa: F401
    from workload.registry import callable_for

    plan = callable_for("rental_rebuild")(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    scans = [x for x in plan.splitlines() if "Filter" in x and "o_orderpriority" in x]
    assert len(scans) == 2


def test_feed_files_hold_null_fields(spark):
    from workload import feeds

    ddl = "l_shipdate timestamp, l_suppkey bigint, l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string"

    class T:
        lineitem = spark.createDataFrame([(dt.datetime(2024, 1, 3), None, 7, 4, 2, None)], ddl)

    row = feeds.trip_update_files(T).first()
    assert (row["agency_id"], str(row["source_date"]), row["blob_order"]) == ("muni", "2024-01-03", None)
    message = gtfs.feed_message_class()()
    message.ParseFromString(bytes(row["content"]))
    assert message.entity[0].trip_update.trip.trip_id == "T7" and message.entity[0].trip_update.stop_time_update[0].stop_sequence == 2
