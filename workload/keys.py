"""Newest-per-key, joins and their diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fogline.operators import asof, checks, joins, latest, lookup
from fogline.operators.keys import CANONICAL_KEY
from fogline.operators.sequences import inferred_arrivals
from fogline.plans.transit import newest_joined
from workload.registry import query
from workload.sqlviews import KEY, same_key, ts_text

BASIC = ("agency_id", "trip_id", "direction_id", "stop_sequence")
KEY_TEXT = KEY.replace("trip_start_date", "strftime(trip_start_date, '%Y-%m-%d') AS trip_start_date")
MONTH = 30 * 86_400


@query(
    "latest_per_key",
    f"""SELECT {KEY_TEXT}, route_id, stop_id, {ts_text('latest_snapshot_ts')} AS latest_snapshot_ts,
               {ts_text('arrival_time_predicted')} AS arrival_time_predicted,
               {ts_text('departure_time_predicted')} AS departure_time_predicted,
               cast(arrival_delay_sec AS bigint) AS arrival_delay_sec,
               cast(departure_delay_sec AS bigint) AS departure_delay_sec
        FROM tu_latest""",
)
def latest_per_key(t):
    return latest.latest_trip_updates(t.trip_updates)


@query(
    "latest_vehicle_positions",
    f"""SELECT {KEY_TEXT}, blob_order, blob_name, {ts_text('vp_snapshot_ts')} AS vp_snapshot_ts,
               {ts_text('position_timestamp')} AS position_timestamp, route_id, vp_stop_id,
               cast(current_status AS bigint) AS current_status, vehicle_id, vehicle_label, latitude, longitude,
               bearing, speed
        FROM vp_latest""",
)
def latest_vehicle_positions(t):
    return latest.latest_vehicle_positions(t.vehicle_positions)


@query(
    "dedupe_keep_last",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) r
       WHERE rn = 1""",
)
def dedupe_keep_last(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return latest.keep_last(rows, ["o_custkey"], "o_orderkey")


@query(
    "nullsafe_left_join",
    f"""SELECT {KEY_TEXT}, route_id, stop_id, {ts_text('latest_snapshot_ts')} AS latest_snapshot_ts,
               {ts_text('vp_snapshot_ts')} AS vp_snapshot_ts, {ts_text('position_timestamp')} AS position_timestamp,
               vp_stop_id, cast(current_status AS bigint) AS current_status, vehicle_id, vehicle_label, latitude,
               longitude, bearing, speed,
               (epoch_us(latest_snapshot_ts) - epoch_us(vp_snapshot_ts)) / 1e6 AS tu_vp_snapshot_delta_sec
        FROM joined_day""",
)
def nullsafe_left_join(t):
    return newest_joined(t.trip_updates, t.vehicle_positions, ["route_id", "stop_id", "snapshot_ts", *joins.VEHICLE_COLUMNS])


@query(
    "nullsafe_join_stats",
    """SELECT (SELECT count(*) FROM tu_latest) AS tripupdates_rows, (SELECT count(*) FROM vp_latest) AS vehiclepositions_rows,
              count(*) AS joined_rows, count(vehicle_id) AS matched_rows,
              count(vehicle_id) / cast(count(*) AS double) AS vehicle_match_rate,
              count(*) = (SELECT count(*) FROM tu_latest) AS left_rows_kept
       FROM joined_day""",
)
def nullsafe_join_stats(t):
    updates = latest.latest_trip_updates(t.trip_updates, [])
    positions = latest.latest_vehicle_positions(t.vehicle_positions, ["vehicle_id"])
    return joins.join_stats(updates, positions, joins.join_vehicle_positions(updates, positions))


FULL_JOIN = f"""
    SELECT t.latest_snapshot_ts, v.vp_snapshot_ts,
           CASE WHEN v.trip_id IS NULL AND v.agency_id IS NULL THEN 'left_only'
                WHEN t.agency_id IS NULL THEN 'right_only' ELSE 'both' END AS outcome
    FROM tu_latest t FULL JOIN vp_latest v ON {same_key('t', 'v', BASIC)}"""


@query(
    "outer_join_diagnostics",
    f"""SELECT outcome, count(*) AS n_rows, count(*) / cast((SELECT count(*) FROM ({FULL_JOIN}) a) AS double) AS rate
        FROM ({FULL_JOIN}) f GROUP BY outcome""",
)
def outer_join_diagnostics(t):
    counts = joins.outcome_counts(
        latest.latest_trip_updates(t.trip_updates), latest.latest_vehicle_positions(t.vehicle_positions), BASIC
    )
    return joins.outcome_rates(counts)


OUTER_ROWS = f"""
    SELECT CASE WHEN t.__l IS NULL THEN v.agency_id ELSE t.agency_id END AS agency_id,
           CASE WHEN t.__l IS NULL THEN v.trip_id ELSE t.trip_id END AS trip_id,
           CASE WHEN t.__l IS NULL THEN v.direction_id ELSE t.direction_id END AS direction_id,
           CASE WHEN t.__l IS NULL THEN v.stop_sequence ELSE t.stop_sequence END AS stop_sequence,
           t.route_id AS left_route_id, v.route_id AS right_route_id, t.latest_snapshot_ts, v.vp_snapshot_ts, v.vehicle_id,
           CASE WHEN v.__r IS NULL THEN 'left_only' WHEN t.__l IS NULL THEN 'right_only' ELSE 'both' END AS outcome
    FROM (SELECT *, true AS __l FROM tu_latest) t FULL JOIN (SELECT *, true AS __r FROM vp_latest) v
      ON {same_key('t', 'v', BASIC)}"""


def _outer_rows(t):
    return joins.outer_join_rows(
        latest.latest_trip_updates(t.trip_updates, ["route_id", "latest_snapshot_ts"]).select(*BASIC, "route_id", "latest_snapshot_ts"),
        latest.latest_vehicle_positions(t.vehicle_positions, ["route_id", "vp_snapshot_ts", "vehicle_id"]).select(
            *BASIC, "route_id", "vp_snapshot_ts", "vehicle_id"
        ),
        BASIC,
    )


@query(
    "outer_join_rows",
    f"""SELECT agency_id, trip_id, direction_id, stop_sequence, left_route_id, right_route_id,
               {ts_text('latest_snapshot_ts')} AS latest_snapshot_ts, {ts_text('vp_snapshot_ts')} AS vp_snapshot_ts, vehicle_id, outcome
        FROM ({OUTER_ROWS}) o""",
)
def outer_join_rows(t):
    return _outer_rows(t)


def _profile_sql(columns):
    text = lambda c: ts_text(c) if c.endswith("_ts") else f"cast({c} AS varchar)"
    melted = " UNION ALL ".join(f"SELECT outcome, '{c}' AS column_name, {text(c)} AS value FROM o" for c in columns)
    return f"""WITH o AS ({OUTER_ROWS}),
       counted AS (SELECT outcome, column_name, value, count(*) AS n FROM ({melted}) m GROUP BY ALL),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY outcome, column_name ORDER BY n DESC, value NULLS LAST) AS place FROM counted)
       SELECT outcome, column_name, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::BIGINT AS n_null,
              min(value) AS least, max(value) AS greatest, coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::DOUBLE / sum(n)::DOUBLE AS null_rate,
              string_agg(coalesce(value, '~') || '=' || n, ',' ORDER BY place) FILTER (WHERE place <= 10) AS top_values
       FROM ranked GROUP BY outcome, column_name"""


PROFILED = ("trip_id", "stop_sequence", "left_route_id", "latest_snapshot_ts", "vp_snapshot_ts", "vehicle_id")


@query("unmatched_profile", _profile_sql(PROFILED))
def unmatched_profile(t):
    listed = lambda v: F.concat(F.coalesce(v["value"], F.lit("~")), F.lit("="), v["n_rows"].cast("string"))
    found = joins.unmatched_profile(_outer_rows(t), PROFILED)
    return found.withColumn("top_values", F.array_join(F.transform("top_values", listed), ","))


def _hourly_sql(ts, only):
    return f"""SELECT {ts_text(f"date_trunc('hour', {ts})")} AS hour, count(*) FILTER (outcome = 'both') AS "both",
                      count(*) FILTER (outcome = '{only}') AS {only}
               FROM ({FULL_JOIN}) f WHERE {ts} IS NOT NULL GROUP BY 1"""


@query("hourly_outcome_pivot", _hourly_sql("latest_snapshot_ts", "left_only"))
def hourly_outcome_pivot(t):
    return joins.hourly_outcomes(
        latest.latest_trip_updates(t.trip_updates, ["latest_snapshot_ts"]),
        latest.latest_vehicle_positions(t.vehicle_positions, []),
        BASIC,
        "latest_snapshot_ts",
    )


@query("hourly_outcome_pivot_vehicles", _hourly_sql("vp_snapshot_ts", "right_only"))
def hourly_outcome_pivot_vehicles(t):
    return joins.hourly_outcomes(
        latest.latest_trip_updates(t.trip_updates, []),
        latest.latest_vehicle_positions(t.vehicle_positions, ["vp_snapshot_ts"]),
        BASIC,
        "vp_snapshot_ts",
        side="right",
    )


@query(
    "key_coverage",
    f"""SELECT count(*) FILTER (l) AS left_keys, count(*) FILTER (r) AS right_keys,
               count(*) FILTER (r IS NULL) AS left_only_keys, count(*) FILTER (l IS NULL) AS right_only_keys
        FROM (SELECT DISTINCT {', '.join(BASIC)}, true AS l FROM trip_updates) a
        FULL JOIN (SELECT DISTINCT {', '.join(BASIC)}, true AS r FROM vehicle_positions) b
          ON {same_key('a', 'b', BASIC)}""",
)
def key_coverage(t):
    return joins.key_coverage(t.trip_updates, t.vehicle_positions, BASIC)


@query(
    "key_match_rate",
    f"""SELECT count(*) AS joined_rows, count(v.vehicle_id) AS matched_rows,
               count(v.vehicle_id) / cast(count(*) AS double) AS match_rate,
               count(*) FILTER (v.vehicle_id IS NULL AND k.stop_sequence = 1)
                 / cast(count(*) FILTER (v.vehicle_id IS NULL) AS double) AS unmatched_first_stop_share
        FROM (SELECT DISTINCT {', '.join(BASIC)} FROM tu_latest) k
        LEFT JOIN vp_latest v ON {same_key('k', 'v', BASIC)}""",
)
def key_match_rate(t):
    return joins.key_match_rate(
        latest.latest_trip_updates(t.trip_updates, []),
        latest.latest_vehicle_positions(t.vehicle_positions, ["vehicle_id"]),
        BASIC,
        "vehicle_id",
        "stop_sequence",
    )


@query(
    "inferred_key_coverage",
    """WITH steps AS (
         SELECT agency_id, trip_id, snapshot_ts, arrival_time_predicted,
                epoch_us(arrival_time_predicted) - epoch_us(snapshot_ts) AS h,
                lag(epoch_us(arrival_time_predicted) - epoch_us(snapshot_ts)) OVER (PARTITION BY agency_id, trip_id
                  ORDER BY snapshot_ts, arrival_time_predicted, route_id, stop_id) AS p
         FROM (SELECT DISTINCT agency_id, trip_id, snapshot_ts, arrival_time_predicted, route_id, stop_id FROM trip_updates
               WHERE arrival_time_predicted IS NOT NULL) d),
       k AS (SELECT DISTINCT agency_id, trip_id FROM tu_latest),
       i AS (SELECT DISTINCT agency_id, trip_id FROM steps WHERE p > 0 AND h <= 0)
       SELECT (SELECT count(*) FROM k) AS left_keys, (SELECT count(*) FROM i) AS right_keys,
              (SELECT count(*) FROM (FROM k EXCEPT FROM i)) AS left_only_keys,
              (SELECT count(*) FROM (FROM i EXCEPT FROM k)) AS right_only_keys""",
)
def inferred_key_coverage(t):
    inferred = inferred_arrivals(t.trip_updates, ["agency_id", "trip_id"], 6 * MONTH)
    return joins.key_coverage(latest.latest_trip_updates(t.trip_updates), inferred, ["agency_id", "trip_id"])


@query(
    "duplicate_keys",
    f"""SELECT {KEY_TEXT}, count(*) AS key_count FROM trip_updates GROUP BY {KEY} HAVING count(*) > 1""",
)
def duplicate_keys(t):
    return checks.duplicate_keys(t.trip_updates, CANONICAL_KEY)


@query(
    "key_audit",
    f"""SELECT agency_id, cast(sum(n) AS bigint) AS row_count, count(*) FILTER (n > 1) AS duplicate_key_group_count
        FROM (SELECT {KEY}, count(*) AS n FROM trip_updates GROUP BY {KEY}) g GROUP BY agency_id""",
)
def key_audit(t):
    return checks.key_audit(t.trip_updates, CANONICAL_KEY, "agency_id")


# Every pair within a key, ranked: distance, then the earlier side, then the tie columns.
ASOF_SQL = f"""
    WITH l AS (SELECT row_number() OVER () AS lid, trip_id, stop_sequence, vp_snapshot_ts, blob_name, vehicle_id
               FROM vehicle_positions
               WHERE trip_id IS NOT NULL AND stop_sequence IS NOT NULL AND vp_snapshot_ts IS NOT NULL),
    m AS (SELECT l.lid, u.stop_id, u.direction_id, u.latest_snapshot_ts,
                 row_number() OVER (PARTITION BY l.lid ORDER BY
                   abs(epoch_us(l.vp_snapshot_ts) - epoch_us(u.latest_snapshot_ts)),
                   CASE WHEN u.latest_snapshot_ts <= l.vp_snapshot_ts THEN 0 ELSE 1 END,
                   CASE WHEN u.latest_snapshot_ts <= l.vp_snapshot_ts THEN u.stop_id END DESC,
                   CASE WHEN u.latest_snapshot_ts <= l.vp_snapshot_ts THEN u.direction_id END DESC NULLS LAST,
                   u.stop_id, u.direction_id NULLS FIRST) AS rn
          FROM l JOIN tu_latest u ON l.trip_id = u.trip_id AND l.stop_sequence = u.stop_sequence
          WHERE abs(epoch_us(l.vp_snapshot_ts) - epoch_us(u.latest_snapshot_ts)) <= 45 * 86400000000)
    SELECT l.trip_id, l.stop_sequence, {ts_text('l.vp_snapshot_ts')} AS vp_snapshot_ts, l.blob_name, l.vehicle_id,
           m.stop_id AS tu_stop_id, m.direction_id AS tu_direction_id, {ts_text('m.latest_snapshot_ts')} AS latest_snapshot_ts,
           m.lid IS NOT NULL AS matched,
           (epoch_us(l.vp_snapshot_ts) - epoch_us(m.latest_snapshot_ts)) / 1e6 AS join_time_delta_sec
    FROM l LEFT JOIN m ON l.lid = m.lid AND m.rn = 1"""


@query("asof_nearest", ASOF_SQL)
def asof_nearest(t):
    left = t.vehicle_positions.select("trip_id", "stop_sequence", "vp_snapshot_ts", "blob_name", "vehicle_id")
    right = latest.latest_trip_updates(t.trip_updates, ["stop_id", "latest_snapshot_ts"]).select(
        "trip_id",
        "stop_sequence",
        F.col("stop_id").alias("tu_stop_id"),
        F.col("direction_id").alias("tu_direction_id"),
        "latest_snapshot_ts",
    )
    return asof.asof_nearest(
        left,
        right,
        ["trip_id", "stop_sequence"],
        "vp_snapshot_ts",
        "latest_snapshot_ts",
        tolerance_seconds=45 * 86_400,
        tie_order=["tu_stop_id", "tu_direction_id"],
        segment_seconds=2 * MONTH,
    )


INTERVAL_SQL = f"""
    WITH p AS (SELECT event_id AS folder_id, ts + to_seconds((user_id * 97) % 7200 - 3600) AS folder_ts FROM events),
    x AS (SELECT event_id AS execution_id, ts AS created_at, ts + to_seconds(cast(floor(value * 2) AS bigint)) AS completed_at
          FROM events),
    hit AS (SELECT p.folder_id, x.execution_id,
                   row_number() OVER (PARTITION BY p.folder_id
                     ORDER BY abs(epoch_us(p.folder_ts) - epoch_us(x.created_at)), x.execution_id) AS rn
            FROM p JOIN x ON x.created_at <= p.folder_ts + INTERVAL 2 MINUTE
                         AND x.completed_at >= p.folder_ts - INTERVAL 5 MINUTE),
    hits AS (SELECT folder_id, execution_id FROM hit WHERE rn = 1),
    rest AS (SELECT p.* FROM p LEFT JOIN hits h USING (folder_id) WHERE h.folder_id IS NULL),
    back AS (SELECT r.folder_id, x.execution_id, epoch_us(r.folder_ts) - epoch_us(x.created_at) AS gap
             FROM rest r ASOF JOIN x ON r.folder_ts >= x.created_at),
    ahead AS (SELECT r.folder_id, x.execution_id, epoch_us(x.created_at) - epoch_us(r.folder_ts) AS gap
              FROM rest r ASOF JOIN x ON r.folder_ts <= x.created_at),
    near AS (SELECT folder_id, execution_id,
                    row_number() OVER (PARTITION BY folder_id ORDER BY gap, execution_id) AS rn
             FROM (FROM back UNION ALL FROM ahead) u)
    SELECT p.folder_id, {ts_text('p.folder_ts')} AS folder_ts, coalesce(h.execution_id, n.execution_id) AS execution_id,
           CASE WHEN h.execution_id IS NOT NULL THEN 'high' ELSE 'low-nearest' END AS confidence
    FROM p LEFT JOIN hits h USING (folder_id) LEFT JOIN (SELECT * FROM near WHERE rn = 1) n USING (folder_id)"""


@query("interval_nearest", INTERVAL_SQL)
def interval_nearest(t):
    ts = F.col("ts").cast("timestamp")
    shift = F.pmod(F.col("user_id") * 97, F.lit(7200)) - 3600
    seconds = lambda n: F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    folders = t.events.select(F.col("event_id").alias("folder_id"), (ts + seconds(shift)).alias("folder_ts"))
    executions = t.events.select(
        F.col("event_id").alias("execution_id"),
        ts.alias("created_at"),
        (ts + seconds(F.floor(F.col("value") * 2))).alias("completed_at"),
    )
    return asof.interval_nearest(
        folders, executions, "folder_ts", "created_at", "completed_at", "execution_id"
    ).select("folder_id", "folder_ts", "execution_id", "confidence")


@query(
    "name_lookup",
    """SELECT p.point_id, p.neighborhood_label, n.id AS neighborhood_id
       FROM points p LEFT JOIN neighborhoods n
         ON lower(replace(p.neighborhood_label, '''', '')) = lower(replace(n.name, '''', ''))""",
)
def name_lookup(t):
    rows = t.points.select("point_id", "neighborhood_label")
    return lookup.name_to_id(rows, t.neighborhoods, "neighborhood_label", "neighborhood_id")


@query(
    "unmatched_labels",
    """SELECT lower(neighborhood_label) AS label, count(*) AS n_rows FROM points
       WHERE neighborhood_label IS NOT NULL
         AND lower(neighborhood_label) NOT IN (SELECT lower(name) FROM neighborhoods)
       GROUP BY 1""",
)
def unmatched_labels(t):
    return lookup.unmatched_labels(t.points, "neighborhood_label", t.neighborhoods)


@query(
    "geocode_lookup",
    """SELECT p.point_id, CASE WHEN g.lon IS NOT NULL AND g.lat IS NOT NULL THEN g.lon ELSE p.long END AS long,
              CASE WHEN g.lon IS NOT NULL AND g.lat IS NOT NULL THEN g.lat ELSE p.lat END AS lat
       FROM points p
       LEFT JOIN (SELECT cast(c_custkey AS varchar) || ' MARKET ST' AS address,
                         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE -((122400000 + c_custkey) / 1e6) END AS lon,
                         (37750000 + c_custkey) / 1e6 AS lat FROM customer) g
         ON p.address = g.address AND p.long IS NULL AND p.address <> 'Not associated with a specific address'""",
)
def geocode_lookup(t):
    wanted = F.col("long").isNull() & (F.col("address") != "Not associated with a specific address")
    placed = lookup.geocode_lookup(t.points, geocodes(t), "address", wanted, "long", "lat")
    return placed.select("point_id", "long", "lat")


def geocodes(t):
    return t.customer.select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(" MARKET ST")).alias("address"),
        F.when(F.col("c_custkey") % 7 != 0, -((F.lit(122400000) + F.col("c_custkey")) / F.lit(1e6))).alias("lon"),
        ((F.lit(37750000) + F.col("c_custkey")) / F.lit(1e6)).alias("lat"),
    )
