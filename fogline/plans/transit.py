"""The transit day: decode, newest per key, join, contract, guarded merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.functions.temporal import seconds_between
from fogline.operators.checks import require_columns, require_no_decode_errors, require_rows, require_unique
from fogline.operators.joins import VEHICLE_COLUMNS, normalise_key_types
from fogline.operators.keys import CANONICAL_KEY, selective_first
from fogline.operators.latest import TRIP_UPDATE_COLUMNS, until_last
from fogline.operators.merge import surrogate_key, upsert_latest
from fogline.schemas import TRIP_STOP_CONTRACT, TRIP_STOP_PK, project_contract
from fogline.session import cut_lineage
from fogline.sources.gtfs import (
    decode_trip_updates,
    decode_vehicle_positions,
    trip_update_observations,
    vehicle_position_observations,
)


def trip_stop_rows(joined: DataFrame) -> DataFrame:
    """Joined observations in the shape of the target table, with a key-derived id."""
    typed = project_contract(joined, TRIP_STOP_CONTRACT, CANONICAL_KEY)
    return typed.select(surrogate_key(CANONICAL_KEY).alias(TRIP_STOP_PK), *TRIP_STOP_CONTRACT)


def newest_joined(trip_updates: DataFrame, positions: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest prediction per key with the newest position of the same key, NULL keys equal.

    Both feeds are reduced by the same key, so one grouped pass over their union does what
    two reductions and a left join would: every observation is shuffled at most once, and
    only after its task has kept one candidate per key and feed. ``columns``: which of the feeds' columns are read beside
    the key, all by default; the others travel only as far as they decide which row is the newest.
    """
    order = {"tu": ["snapshot_ts", "blob_order", "blob_name"], "vp": ["vp_snapshot_ts", "blob_order", "blob_name"]}
    require_columns(trip_updates, [*CANONICAL_KEY, *order["tu"]], "TripUpdates observations")
    require_columns(positions, [*CANONICAL_KEY, *order["vp"]], "VehiclePositions observations")
    # Both snapshot times are always read: the time between them is part of the result.
    read = None if columns is None else {*columns, "snapshot_ts", "vp_snapshot_ts"}
    extra = [c for c in VEHICLE_COLUMNS if c in positions.columns and (read is None or c in read)]
    predicted = [c for c in TRIP_UPDATE_COLUMNS if read is None or c in read]

    def candidate(df: DataFrame, feed: str, columns: list[str]) -> DataFrame:
        rank = list(dict.fromkeys([*order[feed], *columns]))
        rank = rank if read is None else until_last(rank, read)
        return normalise_key_types(df).select(*CANONICAL_KEY, F.struct(*rank).alias(feed))

    known = positions.dropna(subset=["trip_id", "stop_sequence", "vp_snapshot_ts"])
    # The same columns close the order as in ``latest_per_key``: all that are not keys.
    tu = candidate(trip_updates, "tu", list(TRIP_UPDATE_COLUMNS))
    vp = candidate(known, "vp", [c for c in positions.columns if c not in CANONICAL_KEY])
    newest = (
        tu.unionByName(vp, allowMissingColumns=True)
        .groupBy(*selective_first(CANONICAL_KEY))
        .agg(F.max("tu").alias("tu"), F.max("vp").alias("vp"))
        .where(F.col("tu").isNotNull())
    )
    joined = newest.select(
        *CANONICAL_KEY,
        *[F.col(f"tu.{c}").alias("latest_snapshot_ts" if c == "snapshot_ts" else c) for c in predicted],
        *[F.col(f"vp.{c}").alias(c) for c in extra],
    )
    return joined.withColumn(
        "tu_vp_snapshot_delta_sec", seconds_between(F.col("latest_snapshot_ts"), F.col("vp_snapshot_ts"))
    )


def transit_day(trip_updates: DataFrame, positions: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Observations of a day -> rows to merge, or only these ``columns`` of them."""
    if columns is None:
        return trip_stop_rows(newest_joined(trip_updates, positions))
    sources = [TRIP_STOP_CONTRACT[c][1] for c in columns if c in TRIP_STOP_CONTRACT]
    joined = newest_joined(trip_updates, positions, ["snapshot_ts" if c == "latest_snapshot_ts" else c for c in sources])
    return trip_stop_rows(joined).select(*columns)


def stage_transit_day(trip_update_files: DataFrame, position_files: DataFrame) -> DataFrame:
    """Snapshot files (see ``snapshot_manifest``) -> rows to merge, every gate applied.

    The decoded records are kept while the gates look at them, so no file is read twice, and
    the result is written once before anything merges it.
    """
    decoded = {
        "TripUpdates": decode_trip_updates(trip_update_files).persist(),
        "VehiclePositions": decode_vehicle_positions(position_files).persist(),
    }
    try:
        for name, records in decoded.items():
            require_rows(records, f"{name} input")
            require_no_decode_errors(records, name)
        stage = cut_lineage(
            transit_day(
                trip_update_observations(decoded["TripUpdates"]),
                vehicle_position_observations(decoded["VehiclePositions"]),
            )
        )
    finally:
        for records in decoded.values():
            records.unpersist()
    require_rows(stage, "joined day")
    require_unique(stage, CANONICAL_KEY, "joined day")
    return stage


def run_transit_day(trip_update_files: DataFrame, position_files: DataFrame, target: DataFrame) -> DataFrame:
    """Snapshot files -> new contents of the target table."""
    stage = stage_transit_day(trip_update_files, position_files)
    return upsert_latest(target, stage, CANONICAL_KEY, "latest_snapshot_ts")


def prediction_horizon(day: DataFrame, min_minutes: float = 10.0) -> DataFrame:
    """Minutes from snapshot to predicted arrival, where more than ``min_minutes``."""
    minutes = (F.unix_micros("arrival_time_predicted") - F.unix_micros("latest_snapshot_ts")) / F.lit(60e6)
    return day.withColumn("prediction_horizon_min", minutes).where(F.col("prediction_horizon_min") > min_minutes)
