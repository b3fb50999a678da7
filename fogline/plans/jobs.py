"""Scheduled jobs: read what landed, apply the gates, change the tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogline.functions.temporal import lookback_dates
from fogline.operators.checks import (
    QualityError,
    dq_report,
    require_complete_snapshot,
    require_monotonic,
    require_passed,
    require_rows,
)
from fogline.operators.keys import CANONICAL_KEY
from fogline.operators.merge import close_missing, update_foreign_keys, update_state, upsert_by_key, upsert_latest
from fogline.operators.spatial import assign_boundaries
from fogline.plans import clean, marts
from fogline.plans.runs import recorded
from fogline.plans.transit import stage_transit_day
from fogline.schemas import RAW_311, RAW_POLICE, RAW_RENTAL
from fogline.session import cut_lineage
from fogline.sources.files import read_binary_snapshots, read_day_partitions, read_json_snapshot, snapshot_manifest
from fogline.sources.stops import extract_stops
from fogline.sources.tables import FileTable
from fogline.sources.writers import write_mart

# Fixed value: name of the state row.
RENTAL_PIPELINE = "rentcast_active"


def police_table(spark: SparkSession, path: str) -> FileTable:
    return FileTable(spark, path, partition="incident_date")


def incidents_table(spark: SparkSession, path: str) -> FileTable:
    return FileTable(spark, path, keys=["311_incident_id"])


def listings_table(spark: SparkSession, path: str) -> FileTable:
    return FileTable(spark, path, keys=["rentcast_id", "listed_date"])


def trip_stops_table(spark: SparkSession, path: str) -> FileTable:
    """Partitioned by service date; files are sorted by the other columns of the canonical key."""
    return FileTable(spark, path, keys=[k for k in CANONICAL_KEY if k != "trip_start_date"], partition="trip_start_date")


def refresh_police(
    spark: SparkSession,
    raw_base: str,
    table_path: str,
    neighborhoods: DataFrame,
    districts: DataFrame,
    end_date: str,
    days: int = 10,
    cell: float = 0.005,
    runs: FileTable | None = None,
) -> None:
    """Rebuild the look-back window in one commit; a rerun gives the same table.

    The table is partitioned by the landed day, so every delivered row stays in exactly one
    replaceable partition. Boundary ids are assigned per row before the write. Readers see all days of the window
    change at once, or none.
    """
    with recorded(spark, runs, "police") as run:
        raw = read_day_partitions(spark, raw_base, RAW_POLICE, end_date, days)
        rows = run.watch(clean.clean_police(raw, keep=["incident_date"]), "cleaned", without_point=F.col("point").isNull())
        coordinate = lambda i: F.regexp_extract("point", r"POINT\(([^ ]+) ([^)]+)\)", i).try_cast("double")
        placed = assign_boundaries(
            rows.withColumns({"__lon": coordinate(1), "__lat": coordinate(2)}),
            neighborhoods,
            districts,
            lon="__lon",
            lat="__lat",
            unlocated=None,
            cell=cell,
        ).drop("__lon", "__lat")
        first, last = lookback_dates(end_date, days)
        window = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        police_table(spark, table_path).replace_partitions(placed, window)


def refresh_311(
    spark: SparkSession,
    snapshot_path: str,
    table: FileTable,
    neighborhoods: DataFrame,
    districts: DataFrame,
    geocodes: DataFrame | None = None,
    cell: float = 0.005,
    runs: FileTable | None = None,
) -> None:
    """Upsert one landed file by incident id; only files that hold one of its ids are rewritten."""
    with recorded(spark, runs, "311") as run:
        raw = run.watch(read_json_snapshot(spark, snapshot_path, RAW_311), "read")
        staging = cut_lineage(clean.clean_311(raw, neighborhoods, districts, geocodes=geocodes, cell=cell))
        if not table.exists():
            table.replace(staging)
        else:
            table.merge(staging, lambda old, new: upsert_by_key(old, new, ["311_incident_id"]))


def refresh_rentals(
    spark: SparkSession,
    snapshot_path: str,
    listings: FileTable,
    state: FileTable,
    neighborhoods: DataFrame,
    districts: DataFrame,
    snapshot: dt.date,
    updated_at: Column,
    geocodes: DataFrame | None = None,
    cell: float = 0.005,
    runs: FileTable | None = None,
) -> None:
    """Merge a complete snapshot and close what left it in one commit, then advance the state.

    Files without a listing that is in the snapshot or has left it stay as they are. The state moves last: a run that fails
    before is simply repeated, and a repeated day closes nothing.
    """
    with recorded(spark, runs, "rentals") as run:
        known = state.read().where(F.col("pipeline_name") == RENTAL_PIPELINE).select("last_successful_snapshot_date").head(2)
        if len(known) != 1:
            raise QualityError(f"expected one state row for {RENTAL_PIPELINE!r}, found {len(known)}")
        previous = known[0][0]
        newer = bool(require_monotonic(snapshot, previous))
        raw = read_json_snapshot(spark, snapshot_path, RAW_RENTAL)
        loaded = require_complete_snapshot(raw, "id")
        run.note(read=loaded)
        # Listings without a history or a date of listing have no episode; their number is kept.
        dropped = F.coalesce(F.size("history"), F.lit(0)) <= 0
        staging = cut_lineage(
            clean.clean_rentals(run.watch(raw, "listings", without_history=dropped), neighborhoods, districts, geocodes=geocodes, cell=cell)
        )
        active = raw.select(F.col("id").alias("rentcast_id"))

        def changed(old: DataFrame, new: DataFrame) -> DataFrame:
            return close_missing(upsert_by_key(old, new, ["rentcast_id", "listed_date"]), active, snapshot, previous)

        def left_snapshot(rows: DataFrame) -> DataFrame:
            open_rows = rows.where(F.col("removed_date").isNull() & F.lit(newer))
            return open_rows.join(active, "rentcast_id", "left_anti")

        listings.merge(staging, changed, also=left_snapshot)
        count = F.lit(loaded).cast("bigint")
        state.replace(update_state(state.read(), RENTAL_PIPELINE, snapshot, count, count, updated_at))


def refresh_stops(
    documents: DataFrame,
    table: FileTable,
    neighborhoods: DataFrame,
    districts: DataFrame,
    agencies: Sequence[str],
    cell: float = 0.005,
    runs: FileTable | None = None,
) -> None:
    """Upsert names and places of stops, then re-assign boundaries of the given agencies."""
    with recorded(documents.sparkSession, runs, "stops") as run:
        staging = cut_lineage(run.watch(extract_stops(documents), "read"))
        require_rows(staging, "stops")
        key = ["agency_id", "stop_id"]
        merged = cut_lineage(
            upsert_by_key(table.read(), staging, key, update=["stop_name", "lat", "lon", "stop_point"])
        )
        mine = merged.where(F.col("agency_id").isin(*agencies) & F.col("stop_point").isNotNull())
        assigned = clean.assign_stop_boundaries(mine, neighborhoods, districts, cell)
        table.replace(update_foreign_keys(merged, assigned, key, ["neighborhood_id", "police_district_id"]))


def refresh_transit_day(
    spark: SparkSession, raw_base: str, table_path: str, agency: str, date: str, runs: FileTable | None = None
) -> None:
    """Decode one agency's folder day, join the feeds and merge into the table by service date."""
    with recorded(spark, runs, "transit_day") as run:

        def files_of(feed: str) -> DataFrame:
            return snapshot_manifest(read_binary_snapshots(spark, f"{raw_base.rstrip('/')}/{feed}/{agency}/{date}"))

        stage = run.watch(
            stage_transit_day(files_of("TripUpdates"), files_of("VehiclePositions")), "joined", with_vehicle=F.col("vehicle_id").isNotNull()
        )
        trip_stops_table(spark, table_path).merge_partitions(
            stage, lambda old, new: upsert_latest(old, new, CANONICAL_KEY, "latest_snapshot_ts")
        )


def build_marts(
    incidents_311: DataFrame,
    police: DataFrame,
    trip_stops: DataFrame,
    stops: DataFrame,
    neighborhoods: DataFrame,
    districts: DataFrame,
    rentals: DataFrame,
    base: str,
) -> None:
    """Write the three marts under ``base``, then check what was written; a failed check stops the job.

    Checks read the written files, so they hold for what readers see and the views are not computed twice.
    """
    spark = incidents_311.sparkSession
    write_mart(marts.gold_dashboard_events(incidents_311, police, trip_stops, stops), f"{base}/gold_dashboard_events")
    marts.gold_boundaries(neighborhoods, districts).write.mode("overwrite").parquet(f"{base}/gold_boundaries")
    marts.gold_rental_listings(rentals).write.mode("overwrite").parquet(f"{base}/gold_rental_listings")
    for rules in (marts.EVENT_RULES, marts.rental_rules()):
        require_passed(dq_report(spark.read.parquet(f"{base}/{rules.model}"), rules))
