"""Clean tables, merges and state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fogline.functions.temporal import pacific_date
from fogline.operators import checks, merge
from fogline.operators.keys import CANONICAL_KEY
from fogline.operators.latest import latest_trip_updates, latest_vehicle_positions
from fogline.plans import clean, transit
from fogline.schemas import RAW_311, RAW_POLICE, RAW_RENTAL, TRIP_STOP_CONTRACT, project_contract
from fogline.sources.files import parse_json_array
from fogline.sources.stops import extract_stops
from workload.keys import KEY_TEXT, geocodes
from workload.registry import query
from workload.spatial import LABEL_IDS
from workload.sqlviews import KEY, pacific, same_key, ts_text


@query(
    "upsert_by_key",
    """WITH s AS (SELECT l_orderkey + 1000 AS o_orderkey, max(l_returnflag) AS o_orderstatus, max(l_extendedprice) AS o_totalprice
                  FROM lineitem GROUP BY 1)
       SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey,
              CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
              CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
       FROM orders t FULL JOIN s ON t.o_orderkey = s.o_orderkey""",
)
def upsert_by_key(t):
    target = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    staging = t.lineitem.groupBy((F.col("l_orderkey") + 1000).alias("o_orderkey")).agg(
        F.max("l_returnflag").alias("o_orderstatus"), F.max("l_extendedprice").alias("o_totalprice")
    )
    return merge.upsert_by_key(target, staging, ["o_orderkey"])


GUARD_SQL = f"""
    WITH tt AS (SELECT {KEY}, CASE WHEN route_id = 'R7' THEN NULL ELSE latest_snapshot_ts END AS latest_snapshot_ts,
                       stop_id, 'target' AS origin FROM tu_latest),
    ss AS (SELECT {KEY}, CASE WHEN route_id IN ('R7', 'R9') THEN NULL ELSE vp_snapshot_ts END AS latest_snapshot_ts,
                  vp_stop_id AS stop_id, 'staging' AS origin FROM vp_latest),
    m AS (SELECT {', '.join(f'coalesce(t.{c}, s.{c}) AS {c}' for c in KEY.split(', '))},
                 s.agency_id IS NOT NULL AND (t.agency_id IS NULL OR t.latest_snapshot_ts IS NULL
                   OR (s.latest_snapshot_ts IS NOT NULL AND s.latest_snapshot_ts >= t.latest_snapshot_ts)) AS take,
                 t.latest_snapshot_ts AS t_ts, s.latest_snapshot_ts AS s_ts, t.stop_id AS t_stop, s.stop_id AS s_stop
          FROM tt t FULL JOIN ss s ON {same_key('t', 's')})
    SELECT {KEY_TEXT}, {ts_text('CASE WHEN take THEN s_ts ELSE t_ts END')} AS latest_snapshot_ts,
           CASE WHEN take THEN s_stop ELSE t_stop END AS stop_id, CASE WHEN take THEN 'staging' ELSE 'target' END AS origin
    FROM m"""


@query("upsert_freshness_guard", GUARD_SQL)
def upsert_freshness_guard(t):
    target = latest_trip_updates(t.trip_updates, ["route_id", "latest_snapshot_ts", "stop_id"]).select(
        *CANONICAL_KEY,
        F.when(F.col("route_id") != "R7", F.col("latest_snapshot_ts")).alias("latest_snapshot_ts"),
        "stop_id",
        F.lit("target").alias("origin"),
    )
    staging = latest_vehicle_positions(t.vehicle_positions, ["route_id", "vp_snapshot_ts", "vp_stop_id"]).select(
        *CANONICAL_KEY,
        F.when(~F.col("route_id").isin("R7", "R9"), F.col("vp_snapshot_ts")).alias("latest_snapshot_ts"),
        F.col("vp_stop_id").alias("stop_id"),
        F.lit("staging").alias("origin"),
    )
    return merge.upsert_latest(target, staging, CANONICAL_KEY, "latest_snapshot_ts")


@query(
    "close_missing_listings",
    f"""SELECT rentcast_id, {ts_text('listed_date')} AS listed_date, price,
               {ts_text('''CASE WHEN removed_date IS NULL AND NOT EXISTS (
                  SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND 'L' || cast(c.c_custkey AS varchar) = r.rentcast_id)
                  THEN timestamp '2001-06-01 00:00:00' ELSE removed_date END''')} AS removed_date
        FROM rental_listings r""",
)
def close_missing_listings(t):
    active = t.customer.where(F.col("c_acctbal") > 0).select(
        F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("rentcast_id")
    )
    table = t.rental_listings.select("rentcast_id", "listed_date", "price", "removed_date")
    return merge.close_missing(table, active, dt.date(2001, 6, 2), dt.date(2001, 6, 1))


DAY_REPLACE_SQL = f"""SELECT police_incident_id, {ts_text('incident_datetime')} AS incident_datetime, incident_category FROM (
          SELECT police_incident_id, incident_datetime, incident_category FROM police_incidents
          WHERE NOT cast({pacific('incident_datetime')} AS date) BETWEEN date '2024-01-11' AND date '2024-01-20'
          UNION ALL
          SELECT police_incident_id, incident_datetime, 'Redelivered' FROM police_incidents
          WHERE cast({pacific('incident_datetime')} AS date) BETWEEN date '2024-01-11' AND date '2024-01-20'
            AND cast({pacific('incident_datetime')} AS date) <> date '2024-01-15') u"""


@query("day_replace", DAY_REPLACE_SQL)
def day_replace(t):
    days = [dt.date(2024, 1, 11) + dt.timedelta(days=i) for i in range(10)]
    table = t.police_incidents.select("police_incident_id", "incident_datetime", "incident_category")
    day = pacific_date(F.col("incident_datetime"))
    again = table.where(day.between(days[0], days[-1]) & (day != dt.date(2024, 1, 15)))
    return merge.replace_days(table, again.withColumn("incident_category", F.lit("Redelivered")), day, days)


@query(
    "snapshot_state_update",
    """SELECT r_name AS pipeline_name,
              CASE WHEN r_name = 'ASIA' THEN '2026-07-02' ELSE '2026-07-01' END AS last_successful_snapshot_date,
              CASE WHEN r_name = 'ASIA' THEN (SELECT count(*) FROM orders) ELSE 0 END AS expected_active_count,
              CASE WHEN r_name = 'ASIA' THEN (SELECT count(DISTINCT o_orderkey) FROM orders) ELSE 0 END AS loaded_active_count,
              CASE WHEN r_name = 'ASIA' THEN '2026-07-02 09:00:00.000000' ELSE '2026-07-01 00:00:00.000000' END AS updated_at
       FROM region""",
)
def snapshot_state_update(t):
    state = t.region.select(
        F.col("r_name").alias("pipeline_name"),
        F.lit("2026-07-01").cast("date").alias("last_successful_snapshot_date"),
        F.lit(0).cast("bigint").alias("expected_active_count"),
        F.lit(0).cast("bigint").alias("loaded_active_count"),
        F.lit("2026-07-01").cast("timestamp").alias("updated_at"),
    )
    return merge.update_state(
        state,
        "ASIA",
        dt.date(2026, 7, 2),
        t.orders.agg(F.count("*").alias("n")).scalar(),
        t.orders.agg(F.count_distinct("o_orderkey").alias("n")).scalar(),
        F.lit("2026-07-02 09:00:00").cast("timestamp"),
    )


# ---- rentals: landed JSON arrays, one file per order, two listings in each


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def rental_documents(t, orders=None):
    """(ordinal base, JSON text) of all or these orders. The second listing of a file has no usable history."""
    first = F.col("o_orderdate").cast("timestamp")
    key = F.col("o_orderkey")
    after = lambda days: first + F.make_dt_interval(days=F.lit(days))

    def entry(listed, removed, price, event):
        return F.struct(
            F.lit(event).alias("event"),
            price.cast("bigint").alias("price"),
            listed.alias("listedDate"),
            removed.alias("removedDate"),
        )

    price = F.floor(F.col("o_totalprice") / 100)
    history = F.map_from_entries(
        F.array(
            F.struct(F.date_format(first, "yyyy-MM-dd"), entry(_iso(first), _iso(after(20)), price, "Rental Listing")),
            # Same listing date again: a later history entry replaces the earlier one.
            F.struct(
                F.date_format(after(30), "yyyy-MM-dd"),
                entry(F.when(key % 3 != 0, _iso(first)).otherwise(_iso(after(30))), F.lit(None).cast("string"), price + 1, "Rental Listing"),
            ),
            F.struct(
                F.date_format(after(90), "yyyy-MM-dd"),
                entry(F.when(key % 5 != 0, _iso(after(90))).otherwise(F.lit("n/a")), F.lit(None).cast("string"), price + 2, "Rental Listing"),
            ),
        )
    )

    def listing(prefix, hist):
        return F.struct(
            F.concat(F.lit(prefix), key.cast("string")).alias("id"),
            F.concat(F.col("o_custkey").cast("string"), F.lit(" MARKET ST")).alias("formattedAddress"),
            ((F.lit(37700000) + F.pmod(key * 7919, F.lit(140000))) / F.lit(1e6)).alias("latitude"),
            (-((F.lit(122520000) - F.pmod(key * 104729, F.lit(170000))) / F.lit(1e6))).alias("longitude"),
            F.col("o_orderpriority").alias("propertyType"),
            F.pmod(key, F.lit(6)).cast("double").alias("bedrooms"),
            F.lit(1.0).alias("bathrooms"),
            F.lit(700.0).alias("squareFootage"),
            F.lit("Active").alias("status"),
            F.lit(1).cast("bigint").alias("price"),
            F.lit("ignored").alias("listedDate"),
            F.lit("ignored").alias("removedDate"),
            hist.alias("history"),
        )

    empty = F.lit(None).cast("map<string,struct<event:string,price:bigint,listedDate:string,removedDate:string>>")
    # The same whole price spelled 1995, 1995.0 and "1995"; coordinates as numbers and as text.
    document = F.to_json(F.array(listing("L", history), listing("M", empty)))
    spelled = (
        F.when(key % 3 == 0, F.regexp_replace(document, r'"price":(\d+)', '"price":$1.0'))
        .when(key % 3 == 1, F.regexp_replace(document, r'"(price|latitude)":([\d.]+)', '"$1":"$2"'))
        .otherwise(document)
    )
    orders = t.orders if orders is None else orders
    return orders.select((key * 10).alias("file_number"), spelled.alias("document"))


def raw_rentals(t, orders=None):
    parsed = parse_json_array(rental_documents(t, orders), "document", RAW_RENTAL, "position")
    return parsed.withColumn("ordinal", F.col("file_number") + F.col("position")).drop("file_number", "position")


EPISODES_SQL = """
    SELECT 'L' || cast(o_orderkey AS varchar) AS rentcast_id, listed_date, removed_date, o_orderpriority AS property_type,
           cast(o_orderkey % 6 AS double) AS beds, price, cast(o_custkey AS varchar) || ' MARKET ST' AS formatted_address,
           (37700000 + (o_orderkey * 7919) % 140000) / 1e6 AS lat,
           -((122520000 - (o_orderkey * 104729) % 170000) / 1e6) AS long, o_orderkey AS point_id
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey, listed_date ORDER BY entry DESC) AS rn FROM (
            SELECT *, 1 AS entry, o_orderdate AS listed_date, o_orderdate + INTERVAL 20 DAY AS removed_date,
                   cast(floor(o_totalprice / 100) AS bigint) AS price FROM orders
            UNION ALL
            SELECT *, 2, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 30 DAY END, NULL,
                   cast(floor(o_totalprice / 100) AS bigint) + 1 FROM orders
            UNION ALL
            SELECT *, 3, o_orderdate + INTERVAL 90 DAY, NULL, cast(floor(o_totalprice / 100) AS bigint) + 2 FROM orders
            WHERE o_orderkey % 5 <> 0) h) r
    WHERE rn = 1"""


@query(
    "rental_episodes",
    f"""SELECT rentcast_id, {ts_text('listed_date')} AS listed_date, {ts_text('removed_date')} AS removed_date, property_type,
               beds, price, formatted_address, lat, long FROM ({EPISODES_SQL}) e""",
)
def rental_episodes(t):
    return clean.rental_episodes(raw_rentals(t)).drop("baths", "square_footage", "status")


def _brute(points, edges, out):
    from workload.sqlviews import _inside

    return _inside(points, edges, out)


@query(
    "rental_rebuild",
    f"""WITH e AS ({EPISODES_SQL}),
        b AS (SELECT DISTINCT point_id, long, lat FROM e
              WHERE long BETWEEN -122.517 AND -122.355 AND lat BETWEEN 37.704 AND 37.835),
        n AS ({_brute('b', 'nb_edges', 'nb')}), d AS ({_brute('b', 'pd_edges', 'pd')})
        SELECT e.rentcast_id, {ts_text('e.listed_date')} AS listed_date, {ts_text('e.removed_date')} AS removed_date, e.price,
               coalesce(n.nb, 404) AS neighborhood_id, coalesce(d.pd, 404) AS police_district_id
        FROM e JOIN b USING (point_id) LEFT JOIN n USING (point_id) LEFT JOIN d USING (point_id)""",
)
def rental_rebuild(t):
    # Two snapshots, as the source lands them: each document is written into one of them and parsed once.
    inactive = raw_rentals(t, t.orders.where(F.col("o_orderpriority") < "3"))
    active = raw_rentals(t, t.orders.where(F.col("o_orderpriority") >= "3"))
    rebuilt = clean.clean_rentals(inactive.unionByName(active), t.neighborhoods, t.police_districts)
    return rebuilt.select(
        "rentcast_id", "listed_date", "removed_date", "price", "neighborhood_id", "police_district_id"
    )


# ---- transit table


@query(
    "contract_projection",
    f"""SELECT {KEY_TEXT}, route_id, stop_id, {ts_text('latest_snapshot_ts')} AS latest_snapshot_ts,
               cast(arrival_delay_sec AS double) AS arrival_delay_sec, cast(departure_delay_sec AS double) AS departure_delay_sec,
               cast(NULL AS varchar) AS vp_snapshot_ts, cast(NULL AS varchar) AS vehicle_id,
               cast(NULL AS double) AS vehicle_current_status, cast(NULL AS double) AS tu_vp_snapshot_delta_sec
        FROM tu_latest""",
)
def contract_projection(t):
    shaped = project_contract(latest_trip_updates(t.trip_updates), TRIP_STOP_CONTRACT, CANONICAL_KEY)
    return shaped.select(
        *CANONICAL_KEY, "route_id", "stop_id", "latest_snapshot_ts", "arrival_delay_sec", "departure_delay_sec",
        "vp_snapshot_ts", "vehicle_id", "vehicle_current_status", "tu_vp_snapshot_delta_sec",
    )


_TAGGED = ", ".join(
    f"coalesce('v' || cast(length(cast({c} AS varchar)) AS varchar) || ':' || cast({c} AS varchar), 'n')"
    for c in KEY.split(", ")
)


@query(
    "transit_day",
    f"""SELECT sha256(concat_ws('|', {_TAGGED})) AS trip_stop_id, {KEY_TEXT}, stop_id,
               {ts_text('latest_snapshot_ts')} AS latest_snapshot_ts, {ts_text('position_timestamp')} AS vp_timestamp,
               cast(current_status AS double) AS vehicle_current_status, vehicle_id, latitude AS vehicle_latitude,
               (epoch_us(latest_snapshot_ts) - epoch_us(vp_snapshot_ts)) / 1e6 AS tu_vp_snapshot_delta_sec
        FROM joined_day""",
)
def transit_day(t):
    kept = (
        "trip_stop_id", *CANONICAL_KEY, "stop_id", "latest_snapshot_ts", "vp_timestamp", "vehicle_current_status",
        "vehicle_id", "vehicle_latitude", "tu_vp_snapshot_delta_sec",
    )
    return transit.transit_day(t.trip_updates, t.vehicle_positions, kept)


@query(
    "reject_missing_identity",
    """SELECT count(*) AS rows_read,
              count(*) FILTER (trip_id IS NOT NULL AND stop_sequence IS NOT NULL) AS rows_kept,
              count(*) FILTER (trip_id IS NULL OR stop_sequence IS NULL) AS rows_skipped_missing_identity
       FROM vehicle_positions""",
)
def reject_missing_identity(t):
    return checks.split_missing_identity(t.vehicle_positions, ["trip_id", "stop_sequence"])[1]


# ---- police, 311 and stops from landed text


def police_documents(t):
    ts = F.col("ts").cast("timestamp")
    lat = F.when(F.col("event_id") % 23 == 0, F.lit("unknown")).otherwise(
        ((F.lit(37700000) + F.col("event_id")) / F.lit(1e6)).cast("string")
    )
    record = F.struct(
        F.col("event_id").cast("string").alias("incident_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("incident_datetime"),
        F.when(F.col("event_id") % 9 == 0, F.lit("")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("report_datetime"),
        F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.col("event_type")).alias("incident_category"),
        lat.alias("latitude"),
        F.lit("-122.4").alias("longitude"),
        F.struct(
            F.when(F.col("event_id") % 5 == 0, F.lit("Line")).otherwise(F.lit("Point")).alias("type"),
            F.when(F.col("event_id") % 7 == 0, F.array(F.lit(-122.5))).otherwise(F.array(F.lit(-122.5), F.lit(37.75))).alias("coordinates"),
        ).alias("point"),
    )
    return t.events.select("event_id", F.to_json(F.array(record)).alias("document"))


@query(
    "clean_police",
    f"""SELECT cast(event_id AS varchar) AS police_incident_id,
               {ts_text("(date_trunc('milliseconds', ts) AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC')")} AS incident_datetime,
               CASE WHEN event_id % 9 <> 0
                    THEN {ts_text("(date_trunc('second', ts) AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC')")} END AS report_datetime,
               CASE WHEN event_id % 4 <> 0 THEN event_type END AS incident_category,
               CASE WHEN event_id % 23 <> 0 THEN (37700000 + event_id) / 1e6 END AS lat, cast(-122.4 AS double) AS long,
               CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN 'POINT(-122.5 37.75)' END AS point
        FROM events""",
)
def clean_police(t):
    raw = parse_json_array(police_documents(t), "document", RAW_POLICE)
    return clean.clean_police(raw).select(
        "police_incident_id", "incident_datetime", "report_datetime", "incident_category", "lat", "long", "point"
    )


def documents_311(t):
    """One landed file per point; the record appears twice and the second version counts."""
    ts = F.col("seen_at")

    def record(status):
        return F.struct(
            F.col("point_id").cast("string").alias("service_request_id"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("requested_datetime"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("updated_datetime"),
            F.lit(status).alias("status_description"),
            F.when(F.col("point_id") % 6 != 0, F.pmod("point_id", F.lit(11)).cast("string")).alias("supervisor_district"),
            F.col("lat").cast("string").alias("lat"),
            F.col("long").cast("string").alias("long"),
            "address",
            F.col("neighborhood_label").alias("neighborhoods_sffind_boundaries"),
            F.col("district_label").alias("police_district"),
        )

    return t.points.select("point_id", F.to_json(F.array(record("Open"), record("Closed"))).alias("document"))


@query(
    "clean_311",
    f"""WITH g AS (SELECT p.point_id, CASE WHEN p.long IS NULL AND c.c_custkey % 7 <> 0 THEN -((122400000 + c.c_custkey) / 1e6) ELSE p.long END AS long,
                          CASE WHEN p.long IS NULL AND c.c_custkey % 7 <> 0 THEN (37750000 + c.c_custkey) / 1e6 ELSE p.lat END AS lat
                   FROM points p LEFT JOIN customer c ON p.address = cast(c.c_custkey AS varchar) || ' MARKET ST'),
        n AS ({_brute('g', 'nb_edges', 'nb')}), d AS ({_brute('g', 'pd_edges', 'pd')})
        SELECT p.point_id AS "311_incident_id", coalesce(n.nb, l.nb_name, 404) AS neighborhood_id,
               coalesce(d.pd, l.pd_name, 404) AS police_district_id,
               {ts_text("date_trunc('milliseconds', p.seen_at)")} AS requested_datetime, 'Closed' AS status_description,
               CASE WHEN p.point_id % 6 <> 0 THEN p.point_id % 11 ELSE 404 END AS supervisor_district, p.lat, p.long,
               CASE WHEN g.long IS NOT NULL THEN 'POINT(' || cast(g.long AS varchar) || ' ' || cast(g.lat AS varchar) || ')' END AS geometry
        FROM points p JOIN g USING (point_id) LEFT JOIN n USING (point_id) LEFT JOIN d USING (point_id)
        LEFT JOIN ({LABEL_IDS}) l USING (point_id)""",
)
def clean_311(t):
    raw = parse_json_array(documents_311(t), "document", RAW_311)
    return clean.clean_311(raw, t.neighborhoods, t.police_districts, geocodes=geocodes(t)).select(
        "311_incident_id", "neighborhood_id", "police_district_id", "requested_datetime", "status_description",
        "supervisor_district", "lat", "long", "geometry",
    )


def stop_documents(t):
    """One document per customer: nested, mixed-case keys, a stop given twice, one without latitude."""
    key = F.col("c_custkey")
    lon, lat = (-((F.lit(122400000) + key) / F.lit(1e6))), ((F.lit(37750000) + key) / F.lit(1e6))
    stop = lambda name, lat_value: F.struct(
        key.alias("ID"),
        name.alias("Name"),
        F.struct(lon.cast("string").alias("longitude"), lat_value.alias("LATITUDE")).alias("location"),
    )
    half = F.struct(
        F.concat(F.lit("half-"), key.cast("string")).alias("id"), F.struct(lon.alias("Longitude")).alias("Location")
    )
    document = F.to_json(
        F.struct(
            F.struct(
                F.array(stop(F.lit("old"), lat), stop(F.col("c_name"), lat)).alias("ScheduledStopPoint"),
                F.struct(half.alias("inner")).alias("deeper"),
            ).alias("Contents")
        )
    )
    agency = F.when(key % 2 == 0, F.lit("muni")).otherwise(F.lit("bart"))
    return t.customer.select(agency.alias("agency_id"), F.concat(F.lit("﻿"), document).alias("document"))


@query(
    "stops_extract",
    """SELECT cast(c_custkey AS varchar) AS stop_id, CASE WHEN c_custkey % 2 = 0 THEN 'muni' ELSE 'bart' END AS agency_id,
              c_name AS stop_name, (37750000 + c_custkey) / 1e6 AS lat, -((122400000 + c_custkey) / 1e6) AS lon,
              'POINT(' || cast(-((122400000 + c_custkey) / 1e6) AS varchar) || ' '
                || cast((37750000 + c_custkey) / 1e6 AS varchar) || ')' AS stop_point
       FROM customer""",
)
def stops_extract(t):
    return extract_stops(stop_documents(t))
