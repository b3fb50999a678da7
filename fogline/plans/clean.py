"""Raw records -> clean tables for 311, police, rentals and stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogline.functions.geo import geojson_point_wkt, in_box, point_wkt
from fogline.functions.temporal import PACIFIC, local_text_to_utc, text_to_utc
from fogline.functions.text import blank_to_null
from fogline.operators.latest import keep_last
from fogline.operators.lookup import geocode_lookup
from fogline.operators.spatial import UNLOCATED, assign_boundaries

# Fixed value: what the 311 source writes where a request has no address.
NO_ADDRESS = "Not associated with a specific address"

# Source field -> police table column.
POLICE_FIELDS = {
    "incident_id": "police_incident_id",
    "incident_datetime": "incident_datetime",
    "report_datetime": "report_datetime",
    "report_type_code": "report_type_code",
    "report_type_description": "report_type_description",
    "incident_code": "incident_code",
    "incident_category": "incident_category",
    "incident_subcategory": "incident_subcategory",
    "incident_description": "incident_description",
    "resolution": "resolution",
    "latitude": "lat",
    "longitude": "long",
}

# Columns of the clean tables in their order.
INCIDENT_311_COLUMNS = (
    "311_incident_id", "neighborhood_id", "police_district_id", "requested_datetime",
    "updated_datetime", "closed_datetime", "status_description", "status_notes",
    "agency_responsible", "service_name", "service_subtype", "service_details",
    "supervisor_district", "lat", "long", "geometry", "source", "media_url",
)

RENTAL_COLUMNS = (
    "rentcast_id", "listed_date", "removed_date", "neighborhood_id", "police_district_id",
    "property_type", "beds", "baths", "square_footage", "status", "price",
    "formatted_address", "lat", "long", "geometry",
)


def clean_police(raw: DataFrame, source_tz: str = PACIFIC, keep: Sequence[str] = ()) -> DataFrame:
    """Renamed, typed police reports; floating times are local, bad numbers become NULL."""

    def value(source: str, target: str) -> Column:
        text = blank_to_null(F.col(source).cast("string"))
        if source in ("incident_datetime", "report_datetime"):
            return local_text_to_utc(text, source_tz)
        if target in ("lat", "long"):
            return text.try_cast("double")
        return text

    columns = [value(s, t).alias(t) for s, t in POLICE_FIELDS.items()]
    if "point" in raw.columns:
        columns.append(geojson_point_wkt(F.col("point")).alias("point"))
    return raw.select(*columns, *keep)


def clean_311(
    raw: DataFrame,
    neighborhoods: DataFrame,
    districts: DataFrame,
    ordinal: str = "ordinal",
    geocodes: DataFrame | None = None,
    cell: float = 0.005,
    name_rule: str = "normalised",
) -> DataFrame:
    """311 requests with boundary ids, one row per id (the last one in the source).

    Source times are UTC as they stand. Addresses are looked up in ``geocodes`` only where
    coordinates are missing and the address is a real one.
    """
    number = F.col("service_request_id").try_cast("bigint")
    refusal = F.concat(F.lit("311 record without a numeric id: "), F.coalesce("service_request_id", F.lit("NULL")))
    typed = raw.withColumns(
        {
            "311_incident_id": F.coalesce(number, F.raise_error(refusal).cast("bigint")),
            "__own_lat": F.col("lat").cast("string").try_cast("double"),
            "__own_long": F.col("long").cast("string").try_cast("double"),
        }
    )
    # De-duplicate before the joins: fewer rows travel and the result is the same.
    unique = keep_last(typed, ["311_incident_id"], ordinal).withColumns(
        {"__glat": F.col("__own_lat"), "__glong": F.col("__own_long")}
    )
    if geocodes is not None:
        wanted = (F.col("__glat").isNull() | F.col("__glong").isNull()) & (F.col("address") != NO_ADDRESS)
        unique = geocode_lookup(unique, geocodes, "address", wanted, "__glong", "__glat")
    placed = assign_boundaries(
        unique,
        neighborhoods,
        districts,
        lon="__glong",
        lat="__glat",
        neighborhood_label="neighborhoods_sffind_boundaries",
        district_label="police_district_label" if "police_district_label" in raw.columns else "police_district",
        cell=cell,
        name_rule=name_rule,
    )
    supervisor = F.coalesce(
        F.col("supervisor_district").cast("string").try_cast("double"), F.lit(float(UNLOCATED))
    ).cast("bigint")
    return placed.select(
        "311_incident_id",
        "neighborhood_id",
        "police_district_id",
        text_to_utc(F.col("requested_datetime")).alias("requested_datetime"),
        text_to_utc(F.col("updated_datetime")).alias("updated_datetime"),
        text_to_utc(F.col("closed_date")).alias("closed_datetime"),
        "status_description",
        "status_notes",
        "agency_responsible",
        "service_name",
        "service_subtype",
        "service_details",
        supervisor.alias("supervisor_district"),
        F.col("__own_lat").alias("lat"),
        F.col("__own_long").alias("long"),
        point_wkt(F.col("__glong"), F.col("__glat")).alias("geometry"),
        "source",
        "media_url",
    )


def explode_history(raw: DataFrame) -> DataFrame:
    """One row per history entry, in document order; its price and dates replace the listing's own."""
    kept = [c for c in raw.columns if c not in ("price", "listedDate", "removedDate", "history")]
    return raw.select(*kept, F.posexplode("history").alias("event_position", "event_date", "__entry")).select(
        *kept,
        "event_position",
        "event_date",
        F.col("__entry.event").alias("event"),
        F.col("__entry.price").alias("price"),
        F.col("__entry.listedDate").alias("listedDate"),
        F.col("__entry.removedDate").alias("removedDate"),
    )


def rental_episodes(raw: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Listing episodes typed and de-duplicated per (rentcast_id, listed_date), last one kept.

    Order is the position of the listing, then of the entry within its history.
    """
    typed = explode_history(raw).select(
        F.col("id").alias("rentcast_id"),
        text_to_utc(F.col("listedDate")).alias("listed_date"),
        text_to_utc(F.col("removedDate")).alias("removed_date"),
        F.col("propertyType").alias("property_type"),
        F.col("bedrooms").cast("double").alias("beds"),
        F.col("bathrooms").cast("double").alias("baths"),
        F.col("squareFootage").cast("double").alias("square_footage"),
        "status",
        F.col("price").cast("bigint").alias("price"),
        F.col("formattedAddress").alias("formatted_address"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("long"),
        F.struct(F.col(ordinal), F.col("event_position")).alias("__position"),
    )
    known = typed.dropna(subset=["rentcast_id", "listed_date"])
    return keep_last(known, ["rentcast_id", "listed_date"], "__position").drop("__position")


def clean_rentals(
    raw: DataFrame,
    neighborhoods: DataFrame,
    districts: DataFrame,
    ordinal: str = "ordinal",
    geocodes: DataFrame | None = None,
    cell: float = 0.005,
) -> DataFrame:
    """Episodes inside the city box with boundary ids (404 where no polygon holds the point).

    Listings are located and checked before their history is unfolded.
    """
    box = in_box(F.col("longitude"), F.col("latitude"))
    listings = raw
    if geocodes is not None:
        listings = geocode_lookup(listings, geocodes, "formattedAddress", ~box, "longitude", "latitude")
    episodes = rental_episodes(listings.where(box), ordinal)
    placed = assign_boundaries(episodes, neighborhoods, districts, cell=cell)
    return placed.withColumn("geometry", point_wkt(F.col("long"), F.col("lat"))).select(*RENTAL_COLUMNS)


def assign_stop_boundaries(stops: DataFrame, neighborhoods: DataFrame, districts: DataFrame, cell: float = 0.005) -> DataFrame:
    """Stops keep NULL where no polygon holds them."""
    return assign_boundaries(stops, neighborhoods, districts, lon="lon", lat="lat", unlocated=None, cell=cell)
