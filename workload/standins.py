"""Civic-shaped views over the driver's tables, as SQL text that both engines run.

The test tables hold no civic data. Each view below derives one input table from a whole
driver table, row by row, with the same expressions on both sides. Only these inputs are
shared: the operators under test and the SQL that checks them are written separately.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



class SparkDialect:
    def quote(self, name):
        return f"`{name}`"

    def idiv(self, a, b):
        return f"(({a}) div ({b}))"

    def seconds(self, ts, n):
        return f"timestampadd(SECOND, {n}, {ts})"

    def ts(self, c):
        return f"cast({c} as timestamp)"

    def day(self, first, n):
        return f"date_add(date '{first}', cast({n} as int))"

    def json(self, c, key):
        return f"get_json_object({c}, '$.{key}')"

    def iso(self, ts):
        return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss\")"

    def each(self, n):
        return f"explode(sequence(0, {n} - 1))"


class DuckDialect:
    def quote(self, name):
        return f'"{name}"'

    def idiv(self, a, b):
        return f"(({a}) // ({b}))"

    def seconds(self, ts, n):
        return f"({ts} + to_seconds({n}))"

    def ts(self, c):
        return f"cast({c} as timestamp)"

    def day(self, first, n):
        return f"(date '{first}' + cast({n} as integer))"

    def json(self, c, key):
        return f"json_extract_string({c}, '$.{key}')"

    def iso(self, ts):
        return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"

    def each(self, n):
        return f"unnest(range({n}))"


def _west(d, offset):
    """Micro-degrees east of the city's west border -> longitude text."""
    n = f"(122517000 - ({offset}))"
    return f"'-' || cast({d.idiv(n, 1000000)} as string) || '.' || lpad(cast({n} % 1000000 as string), 6, '0')"


def _south(d, offset):
    n = f"(37704000 + ({offset}))"
    return f"cast({d.idiv(n, 1000000)} as string) || '.' || lpad(cast({n} % 1000000 as string), 6, '0')"


def _ring(d, points):
    return "'(' || " + " || ', ' || ".join(f"{_west(d, x)} || ' ' || {_south(d, y)}" for x, y in points) + " || ')'"


def _square(x, y, w, h):
    return [(x, y), (f"{x} + {w}", y), (f"{x} + {w}", f"{y} + {h}"), (x, f"{y} + {h}"), (x, y)]


def neighborhoods(d):
    hexagon = [
        ("x", "y + 7250"), ("x + q", "y"), ("x + 3 * q", "y"), ("x + 4 * q", "y + 7250"),
        ("x + 3 * q", "y + 14500"), ("x + q", "y + 14500"), ("x", "y + 7250"),
    ]
    outer = _ring(d, hexagon)
    hole = _ring(d, _square("x + 2 * q - 1500", "y + 5250", 3000, 4000))
    islet = _ring(d, _square("x", "y + 12500", 1500, 1500))
    return f"""
    SELECT cast(CASE WHEN n = 125 THEN 404 ELSE n END AS bigint) AS id,
           CASE WHEN n % 10 = 0 THEN 'St. Mary''s ' || cast(n AS string) ELSE 'Area ' || cast(n AS string) END AS name,
           CASE WHEN n = 125 THEN NULL
                WHEN n = 13 THEN 'POLYGON ((broken'
                WHEN n % 11 = 0 THEN 'MULTIPOLYGON ((' || outline || '), (' || islet || '))'
                WHEN n % 7 = 0 THEN 'POLYGON (' || outline || ', ' || hole || ')'
                ELSE 'POLYGON (' || outline || ')' END AS geometry
    FROM (SELECT n, {outer} AS outline, {hole} AS hole, {islet} AS islet
          FROM (SELECT n, ((n - 1) % 14) * 11500 AS x, {d.idiv("n - 1", 14)} * 14500 AS y,
                       CASE WHEN n % 9 = 0 THEN 3738 ELSE 2875 END AS q
                FROM (SELECT cast(n_nationkey * 5 + j + 1 AS bigint) AS n
                      FROM (SELECT n_nationkey, {d.each(5)} AS j FROM {{nation}}) a) b) c) r"""


def police_districts(d):
    box = _ring(d, _square("x - back", "y", "32400 + back", 65500))
    return f"""
    SELECT cast(n AS bigint) AS id, 'District ' || cast(n AS string) AS name, 'POLYGON (' || {box} || ')' AS geometry
    FROM (SELECT n, ((n - 1) % 5) * 32400 AS x, {d.idiv("n - 1", 5)} * 65500 AS y,
                 CASE WHEN n % 5 = 0 THEN 2000 ELSE 0 END AS back
          FROM (SELECT cast(r_regionkey * 2 + j + 1 AS bigint) AS n
                FROM (SELECT r_regionkey, {d.each(2)} AS j FROM {{region}}) a) b) c"""


def _k(d):
    return f"cast({d.json('props', 'k')} AS bigint)"


def points(d):
    """One located record per event, with the source's own labels."""
    return f"""
    SELECT event_id AS point_id, {d.ts('ts')} AS seen_at,
           CASE WHEN event_id % 23 = 0 THEN NULL
                ELSE -((122520000 - (event_id * 7919 + user_id * 37) % 168000) / 1e6) END AS long,
           CASE WHEN event_id % 23 = 0 THEN NULL
                ELSE (37700000 + (event_id * 104729 + user_id * 101) % 140000) / 1e6 END AS lat,
           CASE WHEN event_id % 4 = 0 THEN NULL
                WHEN user_id % 10 = 0 THEN 'ST. MARYS ' || cast(user_id % 130 AS string)
                ELSE 'area ' || cast(user_id % 130 AS string) END AS neighborhood_label,
           CASE WHEN event_id % 5 = 0 THEN NULL
                ELSE 'DISTRICT ' || cast(user_id % 12 AS string) END AS district_label,
           CASE WHEN event_id % 46 = 0 THEN 'Not associated with a specific address'
                ELSE cast(user_id AS string) || ' MARKET ST' END AS address
    FROM {{events}}"""


def incidents_311(d):
    q = d.quote
    return f"""
    SELECT event_id AS {q('311_incident_id')},
           cast(CASE WHEN user_id % 50 = 0 THEN 404 ELSE user_id % 117 + 1 END AS bigint) AS neighborhood_id,
           cast(user_id % 10 + 1 AS bigint) AS police_district_id,
           {d.ts('ts')} AS requested_datetime,
           {d.seconds(d.ts('ts'), '(event_id % 72) * 3600')} AS updated_datetime,
           CASE WHEN {_k(d)} % 7 = 0 THEN '   ' WHEN {_k(d)} % 7 = 1 THEN '  Street Cleaning '
                WHEN {_k(d)} % 7 = 2 THEN NULL ELSE 'Service ' || cast({_k(d)} % 12 AS string) END AS service_name
    FROM {{events}} WHERE event_type IN ('click', 'error')"""


def police_incidents(d):
    return f"""
    SELECT cast({d.idiv('event_id', 3)} AS string) AS police_incident_id,
           cast(CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id % 117 + 1 END AS bigint) AS neighborhood_id,
           cast(CASE WHEN user_id % 13 = 0 THEN NULL ELSE user_id % 10 + 1 END AS bigint) AS police_district_id,
           {d.seconds(d.ts('ts'), '-(event_id % 48) * 3600')} AS incident_datetime,
           {d.ts('ts')} AS report_datetime,
           CASE WHEN {_k(d)} % 5 = 0 THEN NULL WHEN {_k(d)} % 5 = 1 THEN ''
                ELSE 'Category ' || cast({_k(d)} % 9 AS string) END AS incident_category
    FROM {{events}} WHERE event_type IN ('view', 'signup')"""


def trip_stops(d):
    return f"""
    SELECT 'ts-' || cast(event_id AS string) AS trip_stop_id,
           CASE WHEN user_id % 3 = 0 AND event_id % 2 = 0 THEN 'bart' ELSE 'muni' END AS agency_id,
           'S' || cast(user_id AS string) AS stop_id,
           CASE WHEN event_id % 17 = 0 THEN NULL ELSE {d.ts('ts')} END AS arrival_time_predicted,
           cast(CASE WHEN event_id % 11 = 0 THEN NULL ELSE floor(value * 10) - 200 END AS double) AS arrival_delay_sec
    FROM {{events}} WHERE event_type = 'purchase'"""


def stops(d):
    """Two agencies share the stop ids that divide by three."""
    return f"""
    SELECT CASE WHEN j = 0 THEN 'muni' ELSE 'bart' END AS agency_id, 'S' || cast(c_custkey AS string) AS stop_id,
           c_name AS stop_name,
           cast(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_custkey + j) % 117 + 1 END AS bigint) AS neighborhood_id,
           cast(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_custkey + j) % 10 + 1 END AS bigint) AS police_district_id
    FROM (SELECT c_custkey, c_name, {d.each("CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END")} AS j FROM {{customer}}) a"""


def rental_listings(d):
    listed = "date_trunc('month', o_orderdate)"
    return f"""
    SELECT 'L' || cast(o_custkey AS string) AS rentcast_id,
           {d.ts(listed)} AS listed_date,
           CASE WHEN o_orderstatus = 'O' THEN NULL
                ELSE {d.seconds(d.ts(listed), '(o_orderkey % 120 - 3) * 86400')} END AS removed_date,
           cast(CASE WHEN o_custkey % 50 = 0 THEN 404 ELSE o_custkey % 117 + 1 END AS bigint) AS neighborhood_id,
           cast(o_custkey % 10 + 1 AS bigint) AS police_district_id,
           o_orderpriority AS property_type,
           cast(CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE o_orderkey % 7 END AS double) AS beds,
           cast(o_orderkey % 3 + 1 AS double) AS baths,
           cast(o_orderkey % 900 + 300 AS double) AS square_footage,
           CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Inactive' END AS status,
           cast(floor(o_totalprice / 100) AS bigint) - 100 AS price,
           cast(o_custkey AS string) || ' Mission St' AS formatted_address,
           CASE WHEN o_orderkey % 19 = 0 THEN 'n/a' ELSE '37.7' || cast(o_custkey % 90 + 10 AS string) END AS lat,
           CASE WHEN o_orderkey % 29 = 0 THEN '-222.4' ELSE '-122.4' || cast(o_custkey % 90 + 10 AS string) END AS long
    FROM {{orders}}"""


def _trip_key():
    """Six key columns; three of them are NULL for some rows, and the key repeats."""
    return """CASE WHEN l_orderkey % 3 = 0 THEN 'bart' ELSE 'muni' END AS agency_id,
           'T' || cast(l_orderkey AS string) AS trip_id,
           {start} AS trip_start_date,
           CASE WHEN l_orderkey % 4 = 0 THEN NULL
                ELSE lpad(cast(l_orderkey % 24 AS string), 2, '0') || ':00:00' END AS trip_start_time,
           cast(CASE l_returnflag WHEN 'N' THEN NULL WHEN 'A' THEN 0 ELSE 1 END AS bigint) AS direction_id"""


def trip_updates(d):
    snap = d.seconds(d.ts("l_shipdate"), "(l_suppkey * 37) % 86400")
    return f"""
    SELECT {_trip_key().format(start=d.day('2024-01-01', 'l_orderkey % 365'))},
           cast(l_linenumber AS bigint) AS stop_sequence,
           l_suppkey AS blob_order,
           'raw/TripUpdates/' || cast(l_suppkey AS string) || '-' || cast(l_partkey AS string) || '-'
             || cast(cast(floor(l_extendedprice * 100) AS bigint) AS string) || '.pb' AS blob_name,
           {snap} AS snapshot_ts,
           'R' || cast(l_orderkey % 50 AS string) AS route_id,
           'S' || cast(l_partkey AS string) AS stop_id,
           CASE WHEN l_partkey % 29 = 0 THEN NULL
                ELSE {d.seconds(snap, '(l_partkey * 13) % 1800 - 600')} END AS arrival_time_predicted,
           {d.seconds(snap, '(l_partkey * 13) % 1800 - 570')} AS departure_time_predicted,
           cast(CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE l_quantity * 20 - 300 END AS int) AS arrival_delay_sec,
           cast(l_quantity * 20 - 270 AS int) AS departure_delay_sec
    FROM {{lineitem}}"""


def vehicle_positions(d):
    snap = d.seconds(d.ts("l_shipdate"), "(l_suppkey * 53) % 86400")
    return f"""
    SELECT {_trip_key().format(start=d.day('2024-01-01', 'l_orderkey % 365')).replace(
        "'T' || cast(l_orderkey AS string) AS trip_id",
        "CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'T' || cast(l_orderkey AS string) "
        "ELSE 'X' || cast(l_orderkey AS string) END AS trip_id")},
           cast(CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_linenumber END AS bigint) AS stop_sequence,
           l_suppkey AS blob_order,
           'raw/VehiclePositions/' || cast(l_suppkey AS string) || '-' || cast(l_partkey AS string) || '-'
             || cast(cast(floor(l_extendedprice * 100) AS bigint) AS string) || '.pb' AS blob_name,
           {snap} AS vp_snapshot_ts,
           CASE WHEN l_partkey % 41 = 0 THEN NULL
                ELSE {d.seconds(snap, '-cast(l_quantity * 5 AS int)')} END AS position_timestamp,
           'R' || cast(l_orderkey % 50 AS string) AS route_id,
           'S' || cast(l_partkey AS string) AS vp_stop_id,
           cast(l_partkey % 3 AS int) AS current_status,
           CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE 'V' || cast(l_suppkey AS string) END AS vehicle_id,
           'bus ' || cast(l_suppkey AS string) AS vehicle_label,
           (37700000 + l_partkey) / 1e6 AS latitude,
           -((122400000 + l_partkey) / 1e6) AS longitude,
           cast(l_quantity AS double) AS bearing,
           cast(l_discount AS double) AS speed
    FROM {{lineitem}}"""


STANDINS = {
    f.__name__: f
    for f in (
        neighborhoods, police_districts, points, incidents_311, police_incidents, trip_stops, stops,
        rental_listings, trip_updates, vehicle_positions,
    )
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

@dataclass(frozen=True)
class Tables:
    """Attribute access to driver tables and to the views above."""

    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in STANDINS:
            text = STANDINS[name](SparkDialect())
            used = {t: getattr(self, t) for t in BASE_TABLES if f"{{{t}}}" in text}
            return self.spark.sql(text, **used)
        raise AttributeError(f"no table or view named {name}")

    @cached_property
    def gold_events(self) -> DataFrame:
        from fogline.plans.marts import gold_dashboard_events

        return gold_dashboard_events(self.incidents_311, self.police_incidents, self.trip_stops, self.stops)

    @cached_property
    def gold_boundaries(self) -> DataFrame:
        from fogline.plans.marts import gold_boundaries

        return gold_boundaries(self.neighborhoods, self.police_districts)

    @cached_property
    def gold_rentals(self) -> DataFrame:
        from fogline.plans.marts import gold_rental_listings

        return gold_rental_listings(self.rental_listings)


TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(df: DataFrame) -> DataFrame:
    """Times and dates as text, whole numbers as bigint: one spelling on both engines."""

    def spelled(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("bigint" if field.dataType.scale == 0 else "double")
        return c.alias(field.name)

    return df.select(*[spelled(f) for f in df.schema.fields])
