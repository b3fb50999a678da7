"""GTFS-Realtime snapshots -> observation rows.

The files of an Arrow batch are scanned together into columns (``wire``); a file that the scan cannot vouch for goes through
the full parser, which also says what is wrong with it. Rows leave the task in batches. Python only unpacks
messages; times, dates and fallbacks are Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.functions.temporal import epoch_to_ts, snapshot_ts_from_path, yyyymmdd_or
from fogline.sources.wire import Messages, padded, read_messages

BATCH_ROWS = 8_192
SCAN_BYTES = 8 << 20  # files are scanned together up to this many bytes
MAX_EPOCH = 9_223_372_036  # last whole second a nanosecond clock can hold

# Messages of the public GTFS-Realtime specification: (name, number, label, type) per field.
# Fixed values; only the parts read here are listed.
_MESSAGES = {
    "FeedHeader": [("gtfs_realtime_version", 1, "required", "string"), ("timestamp", 3, "optional", "uint64")],
    "TripDescriptor": [
        ("trip_id", 1, "optional", "string"),
        ("start_time", 2, "optional", "string"),
        ("start_date", 3, "optional", "string"),
        ("route_id", 5, "optional", "string"),
        ("direction_id", 6, "optional", "uint32"),
    ],
    "VehicleDescriptor": [("id", 1, "optional", "string"), ("label", 2, "optional", "string")],
    "StopTimeEvent": [("delay", 1, "optional", "int32"), ("time", 2, "optional", "int64")],
    "StopTimeUpdate": [
        ("stop_sequence", 1, "optional", "uint32"),
        ("arrival", 2, "optional", "StopTimeEvent"),
        ("departure", 3, "optional", "StopTimeEvent"),
        ("stop_id", 4, "optional", "string"),
    ],
    "TripUpdate": [
        ("trip", 1, "required", "TripDescriptor"),
        ("stop_time_update", 2, "repeated", "StopTimeUpdate"),
        ("vehicle", 3, "optional", "VehicleDescriptor"),
        ("timestamp", 4, "optional", "uint64"),
    ],
    "Position": [
        ("latitude", 1, "required", "float"),
        ("longitude", 2, "required", "float"),
        ("bearing", 3, "optional", "float"),
        ("speed", 5, "optional", "float"),
    ],
    "VehiclePosition": [
        ("trip", 1, "optional", "TripDescriptor"),
        ("position", 2, "optional", "Position"),
        ("current_stop_sequence", 3, "optional", "uint32"),
        ("current_status", 4, "optional", "enum"),
        ("timestamp", 5, "optional", "uint64"),
        ("stop_id", 7, "optional", "string"),
        ("vehicle", 8, "optional", "VehicleDescriptor"),
    ],
    "FeedEntity": [
        ("id", 1, "required", "string"),
        ("trip_update", 3, "optional", "TripUpdate"),
        ("vehicle", 4, "optional", "VehiclePosition"),
    ],
    "FeedMessage": [("header", 1, "required", "FeedHeader"), ("entity", 2, "repeated", "FeedEntity")],
}
_STOP_STATUS = ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")


@lru_cache(maxsize=1)
def feed_message_class():
    """FeedMessage built at run time from the field list."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as exc:  # pragma: no cover
        raise RuntimeError("decoding GTFS-Realtime needs the protobuf package") from exc

    fd = descriptor_pb2.FieldDescriptorProto
    labels = {"required": fd.LABEL_REQUIRED, "optional": fd.LABEL_OPTIONAL, "repeated": fd.LABEL_REPEATED}
    scalars = {
        "string": fd.TYPE_STRING,
        "uint32": fd.TYPE_UINT32,
        "uint64": fd.TYPE_UINT64,
        "int32": fd.TYPE_INT32,
        "int64": fd.TYPE_INT64,
        "float": fd.TYPE_FLOAT,
    }
    file = descriptor_pb2.FileDescriptorProto(
        name="fogline_transit.proto", package="fogline_transit", syntax="proto2"
    )
    status = file.enum_type.add(name="VehicleStopStatus")
    for number, name in enumerate(_STOP_STATUS):
        status.value.add(name=name, number=number)
    for message, fields in _MESSAGES.items():
        proto = file.message_type.add(name=message)
        for name, number, label, kind in fields:
            field = proto.field.add(name=name, number=number, label=labels[label])
            if kind in scalars:
                field.type = scalars[kind]
            elif kind == "enum":
                field.type = fd.TYPE_ENUM
                field.type_name = ".fogline_transit.VehicleStopStatus"
                field.default_value = "IN_TRANSIT_TO"
            else:
                field.type = fd.TYPE_MESSAGE
                field.type_name = f".fogline_transit.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("fogline_transit.FeedMessage"))


_COMMON = [
    ("kind", pa.string()),
    ("agency_id", pa.string()),
    ("source_date", pa.date32()),
    ("blob_order", pa.int64()),
    ("blob_name", pa.string()),
    ("header_epoch", pa.int64()),
    ("rows_skipped", pa.int64()),
    ("epochs_out_of_range", pa.int64()),
    ("error", pa.string()),
    ("trip_id", pa.string()),
    ("route_id", pa.string()),
    ("direction_id", pa.int64()),
    ("trip_start_date_raw", pa.string()),
    ("trip_start_time", pa.string()),
    ("stop_sequence", pa.int64()),
]
_TRIP_UPDATE_SCHEMA = pa.schema(
    _COMMON
    + [
        ("stop_id", pa.string()),
        ("arrival_epoch", pa.int64()),
        ("departure_epoch", pa.int64()),
        ("arrival_delay_sec", pa.int32()),
        ("departure_delay_sec", pa.int32()),
    ]
)
_VEHICLE_SCHEMA = pa.schema(
    _COMMON
    + [
        ("position_epoch", pa.int64()),
        ("vp_stop_id", pa.string()),
        ("current_status", pa.int32()),
        ("vehicle_id", pa.string()),
        ("vehicle_label", pa.string()),
        ("latitude", pa.float64()),
        ("longitude", pa.float64()),
        ("bearing", pa.float64()),
        ("speed", pa.float64()),
    ]
)
_DDL = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.date32(): "date"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def _present(message, name: str):
    return getattr(message, name) if message.HasField(name) else None


def _epoch(message, name: str, strict: bool) -> int | None:
    value = _present(message, name)
    if value is None or -MAX_EPOCH <= value <= MAX_EPOCH:
        return value
    if strict:
        raise ValueError(f"{name} {value} is outside the representable range")
    return None


def _beyond(message, name: str) -> int:
    """1 where the message has a time that no nanosecond clock can hold, which is then read as none."""
    value = _present(message, name)
    return int(value is not None and not -MAX_EPOCH <= value <= MAX_EPOCH)


def _trip_fields(trip) -> dict:
    return {
        "trip_id": trip.trip_id or None,
        "route_id": trip.route_id or None,
        "direction_id": _present(trip, "direction_id"),
        "trip_start_date_raw": trip.start_date or None,
        "trip_start_time": trip.start_time or None,
    }


def _stop_event(update, name: str) -> tuple[int | None, int | None]:
    if not update.HasField(name):
        return None, None
    event = getattr(update, name)
    return _epoch(event, "time", strict=True), _present(event, "delay")


def _trip_update_rows(entity) -> Iterator[dict | None]:
    if not entity.HasField("trip_update"):
        return
    trip = _trip_fields(entity.trip_update.trip)
    for update in entity.trip_update.stop_time_update:
        sequence, stop = _present(update, "stop_sequence"), update.stop_id or None
        if trip["trip_id"] is None or sequence is None or stop is None:
            yield None
            continue
        arrival, arrival_delay = _stop_event(update, "arrival")
        departure, departure_delay = _stop_event(update, "departure")
        yield {
            **trip,
            "stop_sequence": sequence,
            "stop_id": stop,
            "arrival_epoch": arrival,
            "departure_epoch": departure,
            "arrival_delay_sec": arrival_delay,
            "departure_delay_sec": departure_delay,
        }


def _vehicle_rows(entity) -> Iterator[dict | None]:
    if not entity.HasField("vehicle"):
        return
    v = entity.vehicle
    position = v.position if v.HasField("position") else None
    place = {
        name: None if position is None else _present(position, name)
        for name in ("latitude", "longitude", "bearing", "speed")
    }
    yield {
        **_trip_fields(v.trip),
        "stop_sequence": _present(v, "current_stop_sequence"),
        "position_epoch": _epoch(v, "timestamp", strict=False),
        "epochs_out_of_range": _beyond(v, "timestamp"),
        "vp_stop_id": v.stop_id or None,
        "current_status": _present(v, "current_status"),
        "vehicle_id": v.vehicle.id or None,
        "vehicle_label": v.vehicle.label or None,
        **place,
    }


def _by_message(source: dict, rows_of) -> tuple[dict, list[dict]]:
    """The file record and the rows of one file, by the full parser; an unreadable file has ``error`` and no rows."""
    head = {"kind": "file", **source, "rows_skipped": 0, "epochs_out_of_range": 0}
    content = head.pop("content")
    rows: list[dict] = []
    try:
        feed = feed_message_class()()
        feed.ParseFromString(content)
        if feed.HasField("header"):
            head["header_epoch"] = _epoch(feed.header, "timestamp", strict=False)
            head["epochs_out_of_range"] += _beyond(feed.header, "timestamp")
        common = {**head, "kind": "row", "rows_skipped": None}
        for entity in feed.entity:
            for row in rows_of(entity):
                if row is None:
                    head["rows_skipped"] += 1
                else:
                    head["epochs_out_of_range"] += row.get("epochs_out_of_range", 0)
                    rows.append({**common, **row, "epochs_out_of_range": None})
    except Exception as exc:  # any unreadable file is reported, never dropped
        head["error"] = f"{type(exc).__name__}: {exc}"
        head["epochs_out_of_range"] = 0
        rows = []
    return head, rows


#: What the rows of a feed are made of: per name an Arrow array; the file of each row, which rows have identity, which have a time out of range.
_Columns = tuple[dict[str, pa.Array], np.ndarray, np.ndarray, np.ndarray]


def _signed(messages: Messages, name: str, doubtful: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, present) of a number; files with one outside of low..high are for the full parser to judge."""
    value, has = messages.value(name)
    out = value.view(np.int64)
    doubtful[messages.file[has & ((out < low) | (out > high))]] = True
    return out, has


def _number(values: np.ndarray, has: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(np.where(has, values, 0).astype(kind.to_pandas_dtype()), kind, mask=~has)


def _pick(column: pa.Array, at: np.ndarray) -> pa.Array:
    """Entries of a column, NULL where ``at`` is -1."""
    return column.take(pa.array(at, pa.int64(), mask=at < 0))


def _trip_columns(trips: Messages, data: np.ndarray, doubtful: np.ndarray, at: np.ndarray) -> dict[str, pa.Array]:
    """The trip's part of rows whose trip is at these places."""
    direction = _number(*_signed(trips, "direction_id", doubtful, 0, 2**32 - 1), pa.int64())
    texts = {"trip_id": "trip_id", "route_id": "route_id", "trip_start_date_raw": "start_date", "trip_start_time": "start_time"}
    return {"direction_id": _pick(direction, at)} | {out: _pick(trips.strings(data, name), at) for out, name in texts.items()}


def _trip_update_columns(entities: Messages, data: np.ndarray, doubtful: np.ndarray) -> _Columns:
    updates = entities.children["trip_update"]
    stops = updates.children["stop_time_update"]
    out = _trip_columns(updates.children["trip"], data, doubtful, updates.only("trip")[stops.parent])
    sequence = _signed(stops, "stop_sequence", doubtful, 0, 2**32 - 1)
    out |= {"stop_sequence": _number(*sequence, pa.int64()), "stop_id": stops.strings(data, "stop_id")}
    kept = sequence[1] & out["stop_id"].is_valid().to_numpy(zero_copy_only=False) & out["trip_id"].is_valid().to_numpy(zero_copy_only=False)
    for name in ("arrival", "departure"):
        events, at = stops.children[name], stops.only(name)
        # Times of rows without identity are not looked at; one out of range is then for the full parser, too.
        out[f"{name}_epoch"] = _pick(_number(*_signed(events, "time", doubtful, -MAX_EPOCH, MAX_EPOCH), pa.int64()), at)
        out[f"{name}_delay_sec"] = _pick(_number(*_signed(events, "delay", doubtful, -(2**31), 2**31 - 1), pa.int32()), at)
    return out, stops.file, kept, np.zeros(len(stops), bool)


def _vehicle_columns(entities: Messages, data: np.ndarray, doubtful: np.ndarray) -> _Columns:
    vehicles = entities.children["vehicle"]
    out = _trip_columns(vehicles.children["trip"], data, doubtful, vehicles.only("trip"))
    epoch, has = vehicles.value("timestamp")
    status, stated = _signed(vehicles, "current_status", doubtful, 0, len(_STOP_STATUS) - 1)
    described, place = vehicles.only("vehicle"), vehicles.only("position")
    out |= {
        "stop_sequence": _number(*_signed(vehicles, "current_stop_sequence", doubtful, 0, 2**32 - 1), pa.int64()),
        "position_epoch": _number(epoch.view(np.int64), has & (epoch <= MAX_EPOCH), pa.int64()),
        "vp_stop_id": vehicles.strings(data, "stop_id"),
        "current_status": _number(status, stated, pa.int32()),
        "vehicle_id": _pick(vehicles.children["vehicle"].strings(data, "id"), described),
        "vehicle_label": _pick(vehicles.children["vehicle"].strings(data, "label"), described),
    }
    positions = vehicles.children["position"]
    for name in ("latitude", "longitude", "bearing", "speed"):
        at, present = positions.value(name)
        four = data[at.astype(np.int64)[:, None] + np.arange(4)]
        value = np.ascontiguousarray(four).view("<f4").ravel().astype(np.float64)
        out[name] = _pick(pa.array(value, pa.float64(), mask=~present), place)
    return out, vehicles.file, np.ones(len(vehicles), bool), has & (epoch > MAX_EPOCH)


def _by_column(batch: pa.RecordBatch, schema: pa.Schema, columns_of, rows_of) -> Iterator[pa.RecordBatch]:
    """Records of a batch of files, scanned together; files that the scan cannot vouch for go through the full parser."""
    data, start, end = padded(batch.column("content"))
    doubtful = batch.column("content").is_null().to_numpy(zero_copy_only=False).copy()
    file = np.arange(len(batch))
    feeds = read_messages(_MESSAGES, "FeedMessage", data, start, end, file, doubtful)
    header, at = feeds.children["header"], feeds.only("header")
    stamp, has = header.value("timestamp")
    epochs = _pick(_number(stamp.view(np.int64), has & (stamp <= MAX_EPOCH), pa.int64()), at)
    try:
        columns, of, kept, beyond = columns_of(feeds.children["entity"], data, doubtful)
    except pa.ArrowInvalid:  # a text that is no UTF-8, in whichever file
        columns, of, kept, beyond = {}, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
        doubtful[:] = True
    skipped = np.bincount(of[~kept], minlength=len(batch))
    out_of_range = np.bincount(of[beyond], minlength=len(batch)) + np.bincount(header.file[has & (stamp > MAX_EPOCH)], minlength=len(batch))
    sources = {c: batch.column(c) for c in ("agency_id", "source_date", "blob_order", "blob_name")}

    def records(kind: str, files: np.ndarray, parts: dict[str, pa.Array]) -> pa.RecordBatch:
        at = pa.array(files, pa.int64())
        known = {c: v.take(at) for c, v in sources.items()} | parts
        known |= {"kind": pa.array([kind] * len(files), pa.string()), "header_epoch": epochs.take(at)}
        arrays = [known[f.name].cast(f.type) if f.name in known else pa.nulls(len(files), f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    sound = np.flatnonzero(~doubtful)
    counts = {"rows_skipped": skipped, "epochs_out_of_range": out_of_range}
    yield records("file", sound, {c: pa.array(n[sound], pa.int64()) for c, n in counts.items()})
    rows = np.flatnonzero(kept & ~doubtful[of]) if len(of) else np.zeros(0, np.int64)
    for first in range(0, len(rows), BATCH_ROWS):
        part = rows[first : first + BATCH_ROWS]
        yield records("row", of[part], {c: v.take(pa.array(part, pa.int64())) for c, v in columns.items()})
    pending: list[dict] = []
    for i in np.flatnonzero(doubtful).tolist():
        head, found = _by_message(batch.slice(i, 1).to_pylist()[0], rows_of)
        pending += [head, *found]
        while len(pending) >= BATCH_ROWS:
            yield _as_batch(pending[:BATCH_ROWS], schema)
            pending = pending[BATCH_ROWS:]
    if pending:
        yield _as_batch(pending, schema)


def _as_batch(records: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in records], type=f.type) for f in schema], schema=schema)


def _decode(files: DataFrame, schema: pa.Schema, columns_of, rows_of) -> DataFrame:
    """One ``file`` record per input file and one ``row`` record per stop time or vehicle.

    A file that cannot be read gives only its ``file`` record, with ``error`` filled in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("content")), 0).to_numpy(zero_copy_only=False)
            done = np.cumsum(size, dtype=np.int64)
            at = 0
            while at < len(batch):
                stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + SCAN_BYTES, "right")))
                yield from _by_column(batch.slice(at, stop - at), schema, columns_of, rows_of)
                at = stop

    needed = files.select("agency_id", "source_date", "blob_order", "blob_name", "content")
    return needed.mapInArrow(run, _ddl(schema))


def decode_trip_updates(files: DataFrame) -> DataFrame:
    return _decode(files, _TRIP_UPDATE_SCHEMA, _trip_update_columns, _trip_update_rows)


def decode_vehicle_positions(files: DataFrame) -> DataFrame:
    return _decode(files, _VEHICLE_SCHEMA, _vehicle_columns, _vehicle_rows)


def _with_snapshot_ts(records: DataFrame, out: str) -> DataFrame:
    from_name = snapshot_ts_from_path(F.col("blob_name"))
    from_header = epoch_to_ts(F.col("header_epoch"))
    return records.withColumns(
        {
            out: F.coalesce(from_header, from_name),
            f"{out}_source": F.when(from_header.isNotNull(), F.lit("header")).otherwise(F.lit("filename_fallback")),
            "trip_start_date": yyyymmdd_or(F.col("trip_start_date_raw"), F.col("source_date")),
        }
    )


def trip_update_observations(records: DataFrame) -> DataFrame:
    """Decoded records -> one row per stop-time update, times resolved."""
    rows = _with_snapshot_ts(records.where(F.col("kind") == "row"), "snapshot_ts")
    return rows.select(
        "agency_id",
        "blob_order",
        "blob_name",
        "snapshot_ts",
        "snapshot_ts_source",
        "trip_id",
        "route_id",
        "direction_id",
        "trip_start_date_raw",
        "trip_start_date",
        "trip_start_time",
        "stop_sequence",
        "stop_id",
        epoch_to_ts(F.col("arrival_epoch")).alias("arrival_time_predicted"),
        epoch_to_ts(F.col("departure_epoch")).alias("departure_time_predicted"),
        "arrival_delay_sec",
        "departure_delay_sec",
    )


def vehicle_position_observations(records: DataFrame) -> DataFrame:
    rows = _with_snapshot_ts(records.where(F.col("kind") == "row"), "vp_snapshot_ts")
    return rows.select(
        "agency_id",
        "blob_order",
        "blob_name",
        "vp_snapshot_ts",
        "vp_snapshot_ts_source",
        epoch_to_ts(F.col("position_epoch")).alias("position_timestamp"),
        "trip_id",
        "trip_start_date_raw",
        "trip_start_date",
        "trip_start_time",
        "route_id",
        "direction_id",
        "stop_sequence",
        "vp_stop_id",
        "current_status",
        "vehicle_id",
        "vehicle_label",
        "latitude",
        "longitude",
        "bearing",
        "speed",
    )


def parse_report(records: DataFrame) -> DataFrame:
    """Run statistics of a decode, one row per agency and folder date; times out of range were read as missing."""
    is_file = F.col("kind") == "file"
    ok = is_file & F.col("error").isNull()
    return records.groupBy("agency_id", "source_date").agg(
        F.count_if(is_file).alias("blobs_total"),
        F.count_if(ok).alias("blobs_parsed"),
        F.count_if(is_file & F.col("error").isNotNull()).alias("blobs_failed"),
        F.count_if(~is_file).alias("rows_decoded"),
        F.sum(F.when(ok, F.col("rows_skipped")).otherwise(F.lit(0))).alias("rows_skipped_missing_identity"),
        F.sum(F.when(ok, F.col("epochs_out_of_range")).otherwise(F.lit(0))).alias("epochs_out_of_range"),
        F.count_if(ok & F.col("header_epoch").isNotNull()).alias("snapshot_header_count"),
        F.count_if(ok & F.col("header_epoch").isNull()).alias("snapshot_filename_fallback_count"),
    )
