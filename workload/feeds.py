"""GTFS-Realtime messages made from lineitem rows, to be decoded again by the library."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from fogline.sources.gtfs import feed_message_class

_FILE = "agency_id string, source_date date, blob_order bigint, blob_name string, content binary"
_FILE_ARROW = pa.schema(
    [
        ("agency_id", pa.string()),
        ("source_date", pa.date32()),
        ("blob_order", pa.int64()),
        ("blob_name", pa.string()),
        ("content", pa.binary()),
    ]
)


_FILLED = ["blob_order", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "ship"]


def _facts(t):
    """One feed file per lineitem row; the file name carries the ship date."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return t.lineitem.select(
        F.lit("muni").alias("agency_id"),
        F.to_date("l_shipdate").alias("source_date"),
        F.col("l_suppkey").alias("blob_order"),
        F.concat(F.lit("raw/feed/muni/"), day, F.lit("/"), day, F.lit("T00-00-00.000000Z.pb")).alias("blob_name"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ship"),
    )


def _encode(facts, fill):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        message_class = feed_message_class()
        for batch in batches:
            out = []
            # Only what a message is made of becomes Python values; the rest of a file stays in its columns.
            columns = [batch.column(c) for c in _FILLED]
            values = [c.to_pylist() if c.null_count or pa.types.is_string(c.type) else c.to_numpy().tolist() for c in columns]
            for row in (dict(zip(_FILLED, v)) for v in zip(*values, strict=True)):
                feed = message_class()
                header = feed.header
                header.gtfs_realtime_version = "2.0"
                if row["l_partkey"] % 3:
                    header.timestamp = row["ship"] + row["l_partkey"]
                fill(feed, row)
                out.append(feed.SerializeToString())
            known = [batch.column(f.name).cast(f.type) for f in _FILE_ARROW if f.name != "content"]
            yield pa.RecordBatch.from_arrays([*known, pa.array(out, pa.binary())], schema=_FILE_ARROW)

    return facts.mapInArrow(run, _FILE)


def _trip(trip, row):
    trip.trip_id = f"T{row['l_orderkey']}"
    trip.route_id = "" if row["l_orderkey"] % 5 == 0 else f"R{row['l_orderkey'] % 50}"
    if row["l_returnflag"] != "N":
        trip.direction_id = 0 if row["l_returnflag"] == "A" else 1
    trip.start_date = "20240102" if row["l_orderkey"] % 2 else "bad"


def trip_update_files(t):
    def fill(feed, row):
        update = feed.entity.add(id="1").trip_update
        _trip(update.trip, row)
        stop = update.stop_time_update.add()
        stop.stop_sequence, stop.stop_id = row["l_linenumber"], f"S{row['l_partkey']}"
        if row["l_partkey"] % 7:
            stop.arrival.time = row["ship"] + row["l_orderkey"]
        stop.arrival.delay = row["l_partkey"] % 100 - 50
        # A stop without an id is not a usable observation.
        update.stop_time_update.add().stop_sequence = 99

    return _encode(_facts(t), fill)


def vehicle_files(t):
    def fill(feed, row):
        vehicle = feed.entity.add(id="1").vehicle
        _trip(vehicle.trip, row)
        vehicle.stop_id = "" if row["l_partkey"] % 6 == 0 else f"S{row['l_partkey']}"
        vehicle.vehicle.id = f"V{row['blob_order']}"
        if row["l_partkey"] % 4:
            vehicle.current_stop_sequence = row["l_linenumber"]
            vehicle.timestamp = row["ship"] - 30
            vehicle.current_status = row["l_partkey"] % 3
        vehicle.position.latitude, vehicle.position.longitude = 37.5, -122.25
        if row["l_partkey"] % 2:
            vehicle.position.speed = row["l_linenumber"] / 4

    return _encode(_facts(t), fill)
