"""Explicit schemas as DDL text: raw records, clean tables and the transit contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Field names and types of the landed records and tables.
RAW_311 = (
    "service_request_id string, requested_datetime string, updated_datetime string, closed_date string, "
    "status_description string, status_notes string, agency_responsible string, service_name string, "
    "service_subtype string, service_details string, supervisor_district string, lat string, long string, "
    "source string, media_url string, address string, neighborhoods_sffind_boundaries string, "
    "police_district string"
)

RAW_POLICE = (
    "incident_id string, incident_datetime string, report_datetime string, report_type_code string, "
    "report_type_description string, incident_code string, incident_category string, "
    "incident_subcategory string, incident_description string, resolution string, latitude string, "
    "longitude string, point struct<type: string, coordinates: array<double>>"
)

RAW_RENTAL = (
    "id string, formattedAddress string, latitude double, longitude double, propertyType string, "
    "bedrooms double, bathrooms double, squareFootage double, status string, price bigint, "
    "listedDate string, removedDate string, "
    "history map<string, struct<event: string, price: bigint, listedDate: string, removedDate: string>>"
)

STOPS = (
    "stop_id string not null, agency_id string not null, stop_name string, lat double not null, "
    "lon double not null, stop_point string, neighborhood_id bigint, police_district_id bigint"
)

PIPELINE_STATE = (
    "pipeline_name string, last_successful_snapshot_date date, expected_active_count bigint, "
    "loaded_active_count bigint, updated_at timestamp"
)

# Target column -> (type, source column) of the joined transit table.
TRIP_STOP_CONTRACT: dict[str, tuple[str, str]] = {
    "agency_id": ("string", "agency_id"),
    "trip_id": ("string", "trip_id"),
    "trip_start_date": ("date", "trip_start_date"),
    "trip_start_time": ("string", "trip_start_time"),
    "route_id": ("string", "route_id"),
    "direction_id": ("bigint", "direction_id"),
    "stop_sequence": ("bigint", "stop_sequence"),
    "stop_id": ("string", "stop_id"),
    "latest_snapshot_ts": ("timestamp", "latest_snapshot_ts"),
    "arrival_time_predicted": ("timestamp", "arrival_time_predicted"),
    "departure_time_predicted": ("timestamp", "departure_time_predicted"),
    "arrival_delay_sec": ("double", "arrival_delay_sec"),
    "departure_delay_sec": ("double", "departure_delay_sec"),
    "vp_snapshot_ts": ("timestamp", "vp_snapshot_ts"),
    "vp_timestamp": ("timestamp", "position_timestamp"),
    "vp_stop_id": ("string", "vp_stop_id"),
    "vehicle_current_status": ("double", "current_status"),
    "vehicle_id": ("string", "vehicle_id"),
    "vehicle_label": ("string", "vehicle_label"),
    "vehicle_latitude": ("double", "latitude"),
    "vehicle_longitude": ("double", "longitude"),
    "vehicle_bearing": ("double", "bearing"),
    "vehicle_speed": ("double", "speed"),
    "tu_vp_snapshot_delta_sec": ("double", "tu_vp_snapshot_delta_sec"),
}
TRIP_STOP_PK = "trip_stop_id"


def project_contract(
    df: DataFrame, contract: dict[str, tuple[str, str]], required: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """Typed target columns; an absent source column becomes a typed NULL unless required."""
    missing = sorted(s for t, (_, s) in contract.items() if t in required and s not in df.columns)
    if missing:
        raise ValueError(f"missing source columns for required targets: {missing}")

    def column(target: str) -> Column:
        kind, source = contract[target]
        value = F.col(source) if source in df.columns else F.lit(None)
        return value.cast(kind).alias(target)

    return df.select(*[column(t) for t in contract])


TRIP_STOPS = f"{TRIP_STOP_PK} string not null, " + ", ".join(
    f"{target} {kind}" for target, (kind, _) in TRIP_STOP_CONTRACT.items()
)

# Fixed values of the marts.
EVENT_TYPES = ("311", "police", "transit")
BOUNDARY_COLUMNS = {"neighborhoods": "neighborhood_id", "police_districts": "police_district_id"}
BEDROOM_BUCKETS = ("studio", "1bd", "2bd", "3bd", "4bd+")
