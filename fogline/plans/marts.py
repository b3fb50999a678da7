"""Staging views and the three marts. Everything is lazy; ``write`` helpers live in sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogline.functions.geo import valid_point_wkt
from fogline.functions.temporal import pacific_date, pacific_tod_us
from fogline.functions.text import category_or_unknown
from fogline.operators.checks import Rules
from fogline.operators.latest import latest_per_key
from fogline.operators.lookup import lookup_join
from fogline.schemas import BEDROOM_BUCKETS, EVENT_TYPES


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _stage_incidents(df: DataFrame, id_col: str, ts: str, category: str) -> DataFrame:
    return df.select(
        F.col(id_col).cast("string").alias("incident_id"),
        _text("neighborhood_id"),
        _text("police_district_id"),
        F.col(ts).alias("event_ts_utc"),
        category_or_unknown(F.col(category)).alias("category"),
    )


def stage_311_incidents(df: DataFrame) -> DataFrame:
    return _stage_incidents(df, "311_incident_id", "requested_datetime", "service_name")


def stage_police_incidents(df: DataFrame) -> DataFrame:
    return _stage_incidents(df, "police_incident_id", "report_datetime", "incident_category")


def stage_boundaries(df: DataFrame) -> DataFrame:
    return df.where(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("boundary_id"),
        F.col("name").alias("boundary_name"),
        "geometry",
        F.col("geometry").isNull().alias("is_unlocated"),
    )


def stage_stops(df: DataFrame) -> DataFrame:
    return df.select("agency_id", "stop_id", _text("neighborhood_id"), _text("police_district_id"))


def stage_trip_stops(df: DataFrame) -> DataFrame:
    return df.where(F.col("arrival_time_predicted").isNotNull()).select(
        "trip_stop_id",
        "agency_id",
        "stop_id",
        F.col("arrival_time_predicted").alias("event_ts_utc"),
        F.col("arrival_delay_sec").cast("double").alias("arrival_delay_sec"),
    )


def stage_rental_listings(df: DataFrame) -> DataFrame:
    lat, long = (F.col(c).cast("string").try_cast("double") for c in ("lat", "long"))
    return df.select(
        "rentcast_id",
        "listed_date",
        "removed_date",
        _text("neighborhood_id"),
        _text("police_district_id"),
        "property_type",
        "beds",
        "baths",
        "square_footage",
        "price",
        "formatted_address",
        lat.alias("lat"),
        long.alias("long"),
        valid_point_wkt(long, lat).alias("geometry"),
    )


def transit_arrivals(trip_stops: DataFrame, stops: DataFrame, legacy_stop_join: bool = False) -> DataFrame:
    """Arrivals with the boundary ids of their stop.

    Stops are unique per (agency, stop); joining on the stop id alone, as the source model
    does, repeats arrivals whose id two agencies share. ``legacy_stop_join`` keeps that.
    """
    arrivals, places = stage_trip_stops(trip_stops), stage_stops(stops)
    if legacy_stop_join:
        joined = lookup_join(arrivals, places.drop("agency_id"), ["stop_id"])
    else:
        joined = lookup_join(arrivals, places, ["agency_id", "stop_id"])
    return joined.select(
        "trip_stop_id", "event_ts_utc", "arrival_delay_sec", "neighborhood_id", "police_district_id"
    )


def _events(df: DataFrame, kind: str, id_col: str, category: Column, delay: Column) -> DataFrame:
    return df.select(
        F.concat(F.lit(f"{kind}:"), F.col(id_col)).alias("event_id"),
        F.lit(kind).alias("event_type"),
        "event_ts_utc",
        pacific_date(F.col("event_ts_utc")).alias("event_date_pacific"),
        pacific_tod_us(F.col("event_ts_utc")).alias("event_tod_us"),
        "neighborhood_id",
        "police_district_id",
        category.cast("string").alias("category"),
        delay.cast("double").alias("arrival_delay_sec"),
        (delay.cast("double") > 300).alias("delayed_over_5_min"),
    )


def gold_dashboard_events(
    incidents_311: DataFrame,
    police: DataFrame,
    trip_stops: DataFrame,
    stops: DataFrame,
    legacy_stop_join: bool = False,
) -> DataFrame:
    """The event fact: one row per 311 request, police report and predicted arrival."""
    none = F.lit(None)
    parts = [
        _events(stage_311_incidents(incidents_311), "311", "incident_id", F.col("category"), none),
        _events(stage_police_incidents(police), "police", "incident_id", F.col("category"), none),
        _events(
            transit_arrivals(trip_stops, stops, legacy_stop_join),
            "transit",
            "trip_stop_id",
            none,
            F.col("arrival_delay_sec"),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def gold_boundaries(neighborhoods: DataFrame, districts: DataFrame) -> DataFrame:
    def tagged(kind: str, df: DataFrame) -> DataFrame:
        return stage_boundaries(df).select(F.lit(kind).alias("boundary_type"), "*")

    return tagged("neighborhoods", neighborhoods).unionByName(tagged("police_districts", districts))


def bedroom_bucket(beds: Column) -> Column:
    return (
        F.when(beds == 0, "studio")
        .when(beds == 1, "1bd")
        .when(beds == 2, "2bd")
        .when(beds == 3, "3bd")
        .when(beds >= 4, "4bd+")
        .otherwise("unknown")
    )


def gold_rental_listings(rentals: DataFrame) -> DataFrame:
    """One row per (rentcast_id, listed_date) with a positive price.

    The latest removal wins and an open episode loses to a closed one; the other columns
    close the order so reruns agree.
    """
    priced = stage_rental_listings(rentals).where(F.col("price") > 0)
    unique = latest_per_key(priced, ["rentcast_id", "listed_date"], ["removed_date"])
    return unique.select(
        "rentcast_id",
        "listed_date",
        "removed_date",
        "neighborhood_id",
        "police_district_id",
        "property_type",
        "beds",
        bedroom_bucket(F.col("beds")).alias("bedroom_bucket"),
        "baths",
        "square_footage",
        "price",
        "formatted_address",
        "lat",
        "long",
        "geometry",
    )


EVENT_RULES = Rules(
    model="gold_dashboard_events",
    not_null=("event_id", "event_type", "event_ts_utc", "event_date_pacific"),
    unique=("event_id",),
    accepted={"event_type": EVENT_TYPES},
    warn=("unique(event_id)",),
)


def rental_rules() -> Rules:
    """Built per call, because the violation conditions are session columns."""
    return Rules(
        model="gold_rental_listings",
        not_null=(
            "rentcast_id", "listed_date", "neighborhood_id", "police_district_id", "bedroom_bucket", "price",
        ),
        unique_combination=(("rentcast_id", "listed_date"),),
        accepted={"bedroom_bucket": (*BEDROOM_BUCKETS, "unknown")},
        violations={
            "price_positive": F.col("price") <= 0,
            "removal_after_listing": F.col("removed_date").isNotNull()
            & (F.col("removed_date") < F.col("listed_date")),
        },
        warn=("not_null(neighborhood_id)", "not_null(police_district_id)"),
    )
