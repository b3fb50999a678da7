import datetime as dt

from pyspark.sql import functions as F

from fogline.operators.latest import latest_per_key, latest_trip_updates
from fogline.plans.jobs import trip_stops_table
from fogline.sources import files, gtfs
from fogline.streaming import transit_stream as ts
from tests.test_sources import add_trip, feed, land


def snapshots(tmp_path, minutes, trips=("t1", "t2")):
    for m in minutes:
        message = feed()
        message.header.timestamp += 60 * m
        for trip in trips:
            _, stu = add_trip(message, trip_id=trip, start="20260623" if trip == "t1" else "20260624")
            stu.arrival.time = 1_782_172_800 + 60 * m + 30
        land(tmp_path, f"2026-06-23T00-{m:02d}-00.000000Z.pb", message)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_streamed_table_equals_the_batch_result(spark, tmp_path):
    raw, table, checkpoint = (str(tmp_path / n) for n in ("raw", "table", "checkpoint"))
    snapshots(tmp_path, range(3))
    stops = trip_stops_table(spark, table)
    run = lambda: ts.upsert_latest_stream(ts.snapshot_stream(spark, raw, 2), stops, checkpoint).awaitTermination()
    run()
    snapshots(tmp_path, range(3, 5), trips=("t1", "t3"))
    run()
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, raw))
    batch = latest_trip_updates(gtfs.trip_update_observations(gtfs.decode_trip_updates(manifest)))
    columns = ["trip_id", "latest_snapshot_ts", "arrival_time_predicted"]
    assert rows(stops.read().select(*columns)) == rows(batch.select(*columns))
    assert batch.count() == 3


def stream_of(spark, tmp_path, data, ddl, name):
    path = str(tmp_path / name)
    spark.createDataFrame(data, ddl).coalesce(1).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def drain(df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


DDL = "vp_snapshot_ts timestamp, position_timestamp timestamp, route_id string, vehicle_id string, trip_id string, stop_sequence int"


def observations():
    t0 = dt.datetime(2026, 6, 23)
    out = []
    for i in range(40):
        seen = t0 + dt.timedelta(seconds=15 * i)
        out.append((seen, seen - dt.timedelta(seconds=30 if i % 3 else 200), f"R{i % 2}", f"v{i % 5}", "t" if i % 4 else None, 1))
    # A late closing record moves the watermark past every other window.
    out.append((t0 + dt.timedelta(days=1), t0, "R0", "v0", "t", 1))
    return out


def closed(df):
    return df.where(F.col("window_start") < dt.datetime(2026, 6, 23, 12))


def test_minute_windows_match_the_batch(spark, tmp_path):
    stream = stream_of(spark, tmp_path, observations(), DDL, "vp")
    batch = spark.createDataFrame(observations(), DDL)
    assert rows(closed(drain(ts.active_vehicles(stream), "active"))) == rows(closed(ts.active_vehicles(batch)))
    got = rows(closed(drain(ts.stale_invalid_counts(stream), "stale")))
    assert got == rows(closed(ts.stale_invalid_counts(batch))) and sum(g[2] for g in got) == 14


def test_stream_deduplication(spark, tmp_path):
    stream = stream_of(spark, tmp_path, observations()[:10] + observations()[:10], DDL, "dup")
    assert drain(ts.deduplicated(stream, ["vp_snapshot_ts", "vehicle_id"]), "dedup").count() == 10


def test_decoded_stream_has_the_batch_schema(spark, tmp_path):
    snapshots(tmp_path, range(1))
    raw = str(tmp_path / "raw")
    streamed = drain(ts.stream_trip_updates(spark, raw), "tu").drop("blob_order")
    manifest = files.snapshot_manifest(files.read_binary_snapshots(spark, raw))
    batch = gtfs.trip_update_observations(gtfs.decode_trip_updates(manifest)).drop("blob_order")
    assert rows(streamed) == rows(batch)
    assert ts.stream_vehicle_positions(spark, raw).isStreaming


def test_changes_of_the_newest_row_equal_the_batch(spark, tmp_path):
    import random

    rng = random.Random(6)
    t0 = dt.datetime(2026, 6, 23)
    ddl = "k string, n bigint, seen timestamp, part bigint, v string"
    rows_ = [(rng.choice(["a", "b", None, "c"]), rng.choice([1, None]), t0 + dt.timedelta(minutes=rng.randrange(40)), rng.randrange(-3, 3), rng.choice(["x", "y", None])) for _ in range(120)]
    files_ = [rows_[i : i + 12] for i in range(0, 120, 12)]
    # Shuffled, and some files come twice.
    order = [*range(10), 3, 3, 7]
    rng.shuffle(order)
    path = str(tmp_path / "in")
    for place, i in enumerate(order):
        spark.createDataFrame(files_[i], ddl).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 2).parquet(path)
    changes = ts.newest_changes(stream, ["k", "n"], ["seen", "part"], watermark="1 hour")
    seen = drain(changes, "changes", "update").collect()
    batch = latest_per_key(spark.createDataFrame(rows_, ddl), ["k", "n"], ["seen", "part"])
    final = latest_per_key(spark.createDataFrame(seen, ddl), ["k", "n"], ["seen", "part"])
    assert rows_of(final) == rows_of(batch)
    # Each change is newer than the one before, so none repeats.
    assert len({tuple(r) for r in seen}) == len(seen) < len(set(rows_))


def test_silent_keys_are_forgotten(spark, tmp_path):
    t0 = dt.datetime(2026, 6, 23)
    ddl = "k string, seen timestamp, v string"
    path = str(tmp_path / "in")
    query = lambda: ts.newest_changes(spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path), ["k"], ["seen"], watermark="1 minute", keep_seconds=600)
    checkpoint, out = str(tmp_path / "check"), str(tmp_path / "out")
    progress = []
    for part in ([("a", t0, "1"), ("b", t0, "1")], [("b", t0 + dt.timedelta(minutes=30), "2")], [("b", t0 + dt.timedelta(minutes=31), "3")]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(path)
        run = query().writeStream.foreachBatch(lambda df, _: df.write.mode("append").parquet(out)).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        progress.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert progress[0] == 2 and progress[-1] == 1
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == ["1", "1", "2", "3"]
