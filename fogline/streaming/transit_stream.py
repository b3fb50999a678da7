"""Structured Streaming over landed snapshot files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fogline.functions.temporal import seconds_between
from fogline.operators.checks import require_no_decode_errors
from fogline.operators.keys import CANONICAL_KEY
from fogline.operators.latest import latest_trip_updates
from fogline.operators.merge import upsert_latest
from fogline.sources.gtfs import decode_trip_updates, decode_vehicle_positions, trip_update_observations, vehicle_position_observations
from fogline.sources.tables import FileTable


def snapshot_stream(spark: SparkSession, path: str, files_per_trigger: int = 1440) -> DataFrame:
    """New ``<feed>/<agency>/<date>/<ts>.pb`` files as (agency_id, source_date, blob_*, content).

    ``blob_order`` is the file's arrival time, the only order known before a day is complete.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.pb")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )
    parts = F.split("path", "/")
    return files.select(
        F.element_at(parts, -3).alias("agency_id"),
        F.try_to_date(F.element_at(parts, -2), "yyyy-MM-dd").alias("source_date"),
        F.unix_micros("modificationTime").alias("blob_order"),
        F.col("path").alias("blob_name"),
        "content",
    )


def stream_trip_updates(spark: SparkSession, path: str, **options) -> DataFrame:
    return trip_update_observations(decode_trip_updates(snapshot_stream(spark, path, **options)))


def stream_vehicle_positions(spark: SparkSession, path: str, **options) -> DataFrame:
    return vehicle_position_observations(decode_vehicle_positions(snapshot_stream(spark, path, **options)))


def upsert_latest_stream(files: DataFrame, table: FileTable, checkpoint: str) -> StreamingQuery:
    """Keep the newest prediction per canonical key in ``table``, which is partitioned by service date.

    The table is the state, so the key space may grow without bound. Each batch shrinks to
    its newest row per key and rewrites only the service dates it touches; the freshness
    guard makes a repeated batch harmless. A batch with an unreadable file fails.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        records = decode_trip_updates(batch).persist()
        try:
            require_no_decode_errors(records, "stream batch")
            newest = latest_trip_updates(trip_update_observations(records))
            table.merge_partitions(newest, lambda old, new: upsert_latest(old, new, CANONICAL_KEY, "latest_snapshot_ts"))
        finally:
            records.unpersist()

    return (
        files.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_changes(
    observations: DataFrame, keys: Sequence[str], order: Sequence[str], watermark: str = "1 hour", keep_seconds: int = 86_400
) -> DataFrame:
    """Stream of the rows that replace the newest one of their key; ``order`` begins with the event time.

    State per key is the newest row's order and a timer. Of a batch, a key's rows shrink to their greatest ``order``; it is emitted only if
    it is greater than what the state holds, so repeated and older files emit nothing, in whichever order they come. A key that has
    been silent for ``keep_seconds`` of event time is forgotten. Rows later than the watermark are dropped by Spark, so what is forgotten cannot
    come back older: ``watermark`` must not be longer than ``keep_seconds``. NULL keys are one key each; rows without event time
    are left out. Other columns than keys and order are carried along and close the order.
    """
    ts = order[0]
    schema = observations.schema
    names = schema.fieldNames()
    closing = [*order, *[c for c in names if c not in order and c not in keys]]
    state_type = "at timestamp, rank string"

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, held = None, state.get[1] if state.exists else None
        for frame in frames:
            for row in frame.itertuples(index=False):
                rank = _rank(row, closing)
                if (held is None or rank > held) and (best is None or rank > best[0]):
                    best = rank, row
        if best is None:
            return
        at = getattr(best[1], ts)
        state.update((at, best[0]))
        # Never before the watermark, which may be past the row's own time.
        expires = int(at.timestamp() * 1000) + keep_seconds * 1000
        state.setTimeoutTimestamp(max(expires, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([best[1]], columns=names)

    return (
        observations.where(F.col(ts).isNotNull())
        .withWatermark(ts, watermark)
        .groupBy(*keys)
        .applyInPandasWithState(update, schema, state_type, "update", GroupStateTimeout.EventTimeTimeout)
    )


def _rank(row: tuple, columns: Sequence[str]) -> str:
    """The columns as one text that sorts as they do; missing values come first."""
    parts = []
    for c in columns:
        value = getattr(row, c)
        if value is None or value is pd.NaT or value != value:
            parts.append("0")
        elif isinstance(value, pd.Timestamp):
            parts.append(f"1{value.value:020d}")
        elif isinstance(value, (int, float)) and not isinstance(value, bool):
            # Shifted so that negative numbers come before positive ones.
            parts.append(f"1{int(value) + (1 << 63):020d}{value % 1:.17f}")
        else:
            parts.append(f"1{value}")
    return "\x00".join(parts)


def active_vehicles(positions: DataFrame, ts: str = "vp_snapshot_ts", watermark: str = "10 minutes") -> DataFrame:
    """Vehicles per route and minute. Streams count approximately, batches exactly."""
    count = F.approx_count_distinct if positions.isStreaming else F.count_distinct
    source = positions.withWatermark(ts, watermark) if positions.isStreaming else positions
    return (
        source.groupBy(F.window(ts, "1 minute").alias("__w"), "route_id")
        .agg(count("vehicle_id").alias("active_vehicles"))
        .select(F.col("__w.start").alias("window_start"), "route_id", "active_vehicles")
    )


def deduplicated(positions: DataFrame, keys: list[str], ts: str = "vp_snapshot_ts", watermark: str = "10 minutes") -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    return positions.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def stale_invalid_counts(
    positions: DataFrame,
    stale_seconds: int = 90,
    ts: str = "vp_snapshot_ts",
    position_ts: str = "position_timestamp",
    watermark: str = "10 minutes",
    window: str = "1 minute",
) -> DataFrame:
    """Per window: rows, rows whose position is older than ``stale_seconds``, rows without identity."""
    source = positions.withWatermark(ts, watermark) if positions.isStreaming else positions
    age = seconds_between(F.col(ts), F.col(position_ts))
    invalid = F.col("trip_id").isNull() | F.col("stop_sequence").isNull() | F.col("vehicle_id").isNull()
    return (
        source.groupBy(F.window(ts, window).alias("__w"))
        .agg(
            F.count("*").alias("n_records"),
            F.count_if(age > stale_seconds).alias("n_stale"),
            F.count_if(invalid).alias("n_invalid"),
        )
        .select(F.col("__w.start").alias("window_start"), "n_records", "n_stale", "n_invalid")
    )
