"""Sequences, profiles, inventories, decoded feeds and quality reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fogline.functions import temporal as tm
from fogline.functions import text as tx
from fogline.functions.geo import wkt_rings
from fogline.operators import checks, profile, sequences
from fogline.operators.keys import CANONICAL_KEY
from fogline.operators.latest import latest_trip_updates
from fogline.operators.scan import sample_every_k
from fogline.plans import marts, transit
from fogline.sources import files, gtfs
from fogline.streaming.transit_stream import active_vehicles, stale_invalid_counts
from workload import feeds
from workload.keys import MONTH
from workload.registry import query
from workload.sqlviews import KEY, pacific, ts_text

CROSSING_SQL = f"""
    WITH steps AS (
      SELECT *, lag(h) OVER (PARTITION BY agency_id, trip_id ORDER BY snapshot_ts, arrival_time_predicted, route_id, stop_id) AS p
      FROM (SELECT DISTINCT agency_id, trip_id, route_id, stop_id, snapshot_ts, arrival_time_predicted,
                   (epoch_us(arrival_time_predicted) - epoch_us(snapshot_ts)) / 1e6 AS h
            FROM trip_updates WHERE arrival_time_predicted IS NOT NULL) d),
    hits AS (SELECT *, row_number() OVER (PARTITION BY agency_id, trip_id
               ORDER BY snapshot_ts, arrival_time_predicted, route_id, stop_id) AS rn
             FROM steps WHERE p > 0 AND h <= 0)
    SELECT agency_id, trip_id, route_id, stop_id, {ts_text('snapshot_ts')} AS inferred_arrival_snapshot_ts,
           {ts_text('arrival_time_predicted')} AS inferred_arrival_time_predicted, h AS horizon_sec, p AS prev_horizon_sec
    FROM hits WHERE rn = 1"""


@query("arrival_crossing", CROSSING_SQL)
def arrival_crossing(t):
    return sequences.inferred_arrivals(t.trip_updates, ["agency_id", "trip_id"], 6 * MONTH)


GAPS_SQL = """
    SELECT trip_id, direction_id, count(*) AS n_distinct, min(s) AS min_seq, max(s) AS max_seq,
           coalesce(max(s - p - 1), 0) AS max_gap, max(s) - min(s) + 1 AS expected_contiguous,
           max(s) - min(s) + 1 - count(*) AS n_missing, count(*) / cast(max(s) - min(s) + 1 AS double) AS fill_ratio,
           max(s) - min(s) + 1 - count(*) > 0 AS has_gap
    FROM (SELECT trip_id, direction_id, stop_sequence AS s,
                 lag(stop_sequence) OVER (PARTITION BY trip_id, direction_id ORDER BY stop_sequence) AS p
          FROM (SELECT DISTINCT trip_id, direction_id, stop_sequence FROM vehicle_positions
                WHERE trip_id IS NOT NULL AND stop_sequence IS NOT NULL) d) w
    GROUP BY trip_id, direction_id"""


@query("sequence_gaps", GAPS_SQL)
def sequence_gaps(t):
    return sequences.sequence_gaps(t.vehicle_positions, ["trip_id", "direction_id"])


@query(
    "gap_summary",
    f"""SELECT count(*) AS n_trips, count(*) FILTER (n_distinct >= 2) AS n_analyzable,
               avg(CASE WHEN has_gap THEN 1 ELSE 0 END) FILTER (n_distinct >= 2) AS ratio_with_gaps,
               avg(CASE WHEN max_gap <= 2 THEN 1 ELSE 0 END) FILTER (n_distinct >= 2) AS small_gap_share,
               cast(sum(n_missing) FILTER (n_distinct >= 2) AS bigint) AS n_missing
        FROM ({GAPS_SQL}) g""",
)
def gap_summary(t):
    return sequences.gap_summary(sequences.sequence_gaps(t.vehicle_positions, ["trip_id", "direction_id"]))


@query(
    "stop_patterns",
    """SELECT route_id, direction_id, count(DISTINCT pattern) AS n_distinct_patterns, count(*) AS n_trips
       FROM (SELECT route_id, direction_id, trip_id, list(stop_id ORDER BY stop_sequence, stop_id) AS pattern
             FROM trip_updates GROUP BY 1, 2, 3) p
       GROUP BY 1, 2""",
)
def stop_patterns(t):
    return sequences.stop_patterns(t.trip_updates)


@query(
    "stop_patterns_short",
    """SELECT route_id, direction_id, count(DISTINCT pattern) AS n_distinct_patterns, count(*) AS n_trips
       FROM (SELECT route_id, direction_id, trip_id,
                    list('S' || cast(blob_order % 2 AS varchar) ORDER BY stop_sequence, 'S' || cast(blob_order % 2 AS varchar)) AS pattern
             FROM trip_updates GROUP BY 1, 2, 3) p
       GROUP BY 1, 2""",
)
def stop_patterns_short(t):
    few = F.concat(F.lit("S"), (F.col("blob_order") % 2).cast("string"))
    return sequences.stop_patterns(t.trip_updates.withColumn("stop_id", few))


@query(
    "stop_dim_candidate",
    "SELECT DISTINCT route_id, direction_id, stop_sequence, stop_id FROM trip_updates",
)
def stop_dim_candidate(t):
    return sequences.stop_dimension_candidate(t.trip_updates)


def _consistency_sql(by):
    return f"""SELECT {by}, count(*) AS n_trips, min(m) AS min_last_stop, max(m) AS max_last_stop,
                      count(DISTINCT m) AS n_distinct_last_stop
               FROM (SELECT route_id, direction_id, trip_id, max(stop_sequence) AS m FROM trip_updates GROUP BY 1, 2, 3) x
               GROUP BY {by}"""


@query("route_consistency", _consistency_sql("route_id"))
def route_consistency(t):
    return sequences.route_consistency(t.trip_updates)


@query("route_direction_consistency", _consistency_sql("route_id, direction_id"))
def route_direction_consistency(t):
    return sequences.route_consistency(t.trip_updates, ("route_id", "direction_id"))


@query(
    "fd_violations",
    """SELECT route_id, direction_id, stop_sequence, count(DISTINCT stop_id) AS n_stop_ids FROM trip_updates
       WHERE direction_id IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT stop_id) > 1""",
)
def fd_violations(t):
    return profile.fd_violations(
        t.trip_updates, ["route_id", "direction_id", "stop_sequence"], "stop_id", "n_stop_ids"
    )


@query(
    "fd_violations_trip_key",
    f"""SELECT count(*) AS n_keys, cast(sum(n) AS bigint) AS n_values FROM (
          SELECT count(DISTINCT stop_id) AS n FROM trip_updates GROUP BY {KEY} HAVING count(DISTINCT stop_id) > 1) g""",
)
def fd_violations_trip_key(t):
    bad = profile.fd_violations(t.trip_updates, CANONICAL_KEY, "stop_id", "n", drop_null_keys=False)
    return bad.agg(F.count("*").alias("n_keys"), F.sum("n").alias("n_values"))


STALENESS = "(epoch_us(position_timestamp) - epoch_us(vp_snapshot_ts)) / 1e6"


def _staleness():
    return tm.seconds_between(F.col("position_timestamp"), F.col("vp_snapshot_ts"))


def _histogram_sql(value, source, bins):
    return f"""
        WITH v AS (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL),
        e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
        c AS (SELECT least(cast(floor((v - lo) / ((hi - lo) / {bins})) AS int), {bins - 1}) AS bin, count(*) AS n
              FROM v, e GROUP BY 1)
        SELECT cast(r.bin AS bigint) AS bin, lo + r.bin * ((hi - lo) / {bins}) AS bin_start, coalesce(n, 0) AS n_rows
        FROM (SELECT unnest(range({bins})) AS bin) r CROSS JOIN e LEFT JOIN c ON c.bin = r.bin"""


@query("binned_histogram", _histogram_sql(STALENESS, "vehicle_positions", 80))
def binned_histogram(t):
    return profile.binned_histogram(t.vehicle_positions, _staleness(), 80)


@query(
    "snapshot_histogram",
    _histogram_sql("cast(epoch_us(latest_snapshot_ts) AS double)", "tu_latest", 48),
)
def snapshot_histogram(t):
    return profile.binned_histogram(
        latest_trip_updates(t.trip_updates), F.unix_micros("latest_snapshot_ts"), 48
    )


HORIZON = "(epoch_us(arrival_time_predicted) - epoch_us(latest_snapshot_ts)) / 60e6"


@query(
    "prediction_horizon_histogram",
    _histogram_sql(f"CASE WHEN {HORIZON} > 10 THEN {HORIZON} END", "tu_latest", 80),
)
def prediction_horizon_histogram(t):
    day = transit.prediction_horizon(latest_trip_updates(t.trip_updates))
    return profile.binned_histogram(day, F.col("prediction_horizon_min"), 80)


def _describe_sql(value, source):
    q = ", ".join(f"round(quantile_cont(v, {p}), 6) AS p{round(p * 100):02d}" for p in profile.QUANTILES)
    return f"""SELECT count(*) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, {q}, max(v) AS max
               FROM (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL) x"""


def _rounded(df):
    names = ["mean", "std", *[f"p{round(q * 100):02d}" for q in profile.QUANTILES]]
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("describe_quantiles", _describe_sql(STALENESS, "vehicle_positions"))
def describe_quantiles(t):
    return _rounded(profile.describe(t.vehicle_positions.withColumn("v", _staleness()), "v"))


@query("describe_prices", _describe_sql("l_extendedprice", "lineitem"))
def describe_prices(t):
    return _rounded(profile.describe(t.lineitem, "l_extendedprice"))


PROFILED = ("trip_id", "direction_id", "stop_sequence", "vehicle_id", "position_timestamp", "route_id")


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_count,
                   (count(*) - count({c})) / cast(count(*) AS double) AS null_rate FROM vehicle_positions"""
        for c in PROFILED
    ),
)
def null_profile(t):
    return profile.null_profile(t.vehicle_positions, PROFILED)


@query(
    "distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM vehicle_positions"
        for c in ("trip_id", "vehicle_id", "route_id")
    ),
)
def distinct_counts(t):
    return profile.distinct_counts(t.vehicle_positions, ["trip_id", "vehicle_id", "route_id"])


@query(
    "value_counts",
    """SELECT vehicle_id AS value, count(*) AS n_rows FROM vehicle_positions GROUP BY 1
       ORDER BY n_rows DESC, value NULLS LAST LIMIT 20""",
)
def value_counts(t):
    return profile.value_counts(t.vehicle_positions, "vehicle_id", 20)


@query(
    "snapshot_inventory",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS snapshot_date, count(*) AS api_records,
              count(DISTINCT CASE WHEN o_orderkey % 31 <> 0 THEN o_custkey END) AS distinct_ids
       FROM orders WHERE o_orderdate >= timestamp '1998-06-11' AND o_orderstatus <> 'P' GROUP BY 1""",
)
def snapshot_inventory(t):
    suffix = F.when(F.col("o_orderstatus") != "P", F.lit("_rentals_api_call")).otherwise(F.lit("_other_call"))
    records = t.orders.select(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), suffix).alias("file_name"),
        F.when(F.col("o_orderkey") % 31 != 0, F.col("o_custkey")).alias("id"),
    )
    return files.snapshot_inventory(records, F.col("file_name"), "id", since="1998-06-11")


def _catalog_sql():
    tables = {
        "gold_boundaries": ("gold_bounds", ["boundary_type:string", "boundary_id:string", "boundary_name:string",
                                            "geometry:string", "is_unlocated:boolean"]),
        "gold_dashboard_events": ("gold_events", ["event_id:string", "event_type:string", "event_ts_utc:timestamp",
                                                  "event_date_pacific:date", "event_tod_us:bigint", "neighborhood_id:string",
                                                  "police_district_id:string", "category:string", "arrival_delay_sec:double",
                                                  "delayed_over_5_min:boolean"]),
    }
    parts = []
    for table, (view, columns) in tables.items():
        for i, c in enumerate(columns):
            name, kind = c.split(":")
            parts.append(
                f"SELECT '{table}' AS table_name, {i + 1} AS ordinal_position, '{name}' AS column_name, "
                f"'{kind}' AS data_type, (SELECT count(*) FROM {view}) AS row_count"
            )
    return "SELECT table_name, cast(ordinal_position AS bigint) AS ordinal_position, column_name, data_type, row_count FROM (" + (
        " UNION ALL ".join(parts)
    ) + ") c"


@query("catalog_profile", _catalog_sql())
def catalog_profile(t):
    tables = {"gold_dashboard_events": t.gold_events, "gold_boundaries": t.gold_boundaries}
    return profile.catalog_profile(tables).select(
        "table_name", "ordinal_position", "column_name", "data_type", "row_count"
    )


# ---- decoded feeds

SNAPSHOT = "CASE WHEN l_partkey % 3 <> 0 THEN l_shipdate + to_seconds(l_partkey) ELSE date_trunc('day', l_shipdate) END"
TRIP_SQL = """'T' || cast(l_orderkey AS varchar) AS trip_id,
    CASE WHEN l_orderkey % 5 <> 0 THEN 'R' || cast(l_orderkey % 50 AS varchar) END AS route_id,
    cast(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END AS bigint) AS direction_id,
    strftime(CASE WHEN l_orderkey % 2 = 1 THEN date '2024-01-02' ELSE cast(l_shipdate AS date) END, '%Y-%m-%d') AS trip_start_date"""


@query(
    "feed_trip_updates",
    f"""SELECT {TRIP_SQL}, {ts_text(SNAPSHOT)} AS snapshot_ts,
               CASE WHEN l_partkey % 3 <> 0 THEN 'header' ELSE 'filename_fallback' END AS snapshot_ts_source,
               cast(l_linenumber AS bigint) AS stop_sequence, 'S' || cast(l_partkey AS varchar) AS stop_id,
               CASE WHEN l_partkey % 7 <> 0 THEN {ts_text('l_shipdate + to_seconds(l_orderkey)')} END AS arrival_time_predicted,
               l_partkey % 100 - 50 AS arrival_delay_sec
        FROM lineitem""",
)
def feed_trip_updates(t):
    return gtfs.trip_update_observations(gtfs.decode_trip_updates(feeds.trip_update_files(t))).select(
        "trip_id", "route_id", "direction_id", "trip_start_date", "snapshot_ts", "snapshot_ts_source", "stop_sequence",
        "stop_id", "arrival_time_predicted", "arrival_delay_sec",
    )


@query(
    "feed_vehicle_positions",
    f"""SELECT {TRIP_SQL}, {ts_text(SNAPSHOT)} AS vp_snapshot_ts,
               cast(CASE WHEN l_partkey % 4 <> 0 THEN l_linenumber END AS bigint) AS stop_sequence,
               CASE WHEN l_partkey % 4 <> 0 THEN {ts_text('l_shipdate - INTERVAL 30 SECOND')} END AS position_timestamp,
               CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 3 END AS current_status,
               CASE WHEN l_partkey % 6 <> 0 THEN 'S' || cast(l_partkey AS varchar) END AS vp_stop_id,
               'V' || cast(l_suppkey AS varchar) AS vehicle_id, cast(37.5 AS double) AS latitude,
               cast(-122.25 AS double) AS longitude, CASE WHEN l_partkey % 2 = 1 THEN l_linenumber / 4e0 END AS speed
        FROM lineitem""",
)
def feed_vehicle_positions(t):
    records = gtfs.decode_vehicle_positions(feeds.vehicle_files(t))
    return gtfs.vehicle_position_observations(records).select(
        "trip_id", "route_id", "direction_id", "trip_start_date", "vp_snapshot_ts", "stop_sequence", "position_timestamp",
        "current_status", "vp_stop_id", "vehicle_id", "latitude", "longitude", "speed",
    )


@query(
    "run_stats",
    """SELECT 'muni' AS agency_id, strftime(l_shipdate, '%Y-%m-%d') AS source_date, count(*) AS blobs_total, count(*) AS blobs_parsed,
              cast(0 AS bigint) AS blobs_failed, count(*) AS rows_decoded, count(*) AS rows_skipped_missing_identity,
              cast(0 AS bigint) AS epochs_out_of_range, count(*) FILTER (l_partkey % 3 <> 0) AS snapshot_header_count,
              count(*) FILTER (l_partkey % 3 = 0) AS snapshot_filename_fallback_count
       FROM lineitem GROUP BY 2""",
)
def run_stats(t):
    return gtfs.parse_report(gtfs.decode_trip_updates(feeds.trip_update_files(t)))


@query(
    "timestamp_fallback",
    f"""SELECT CASE WHEN user_id % 4 = 0 THEN 'filename_fallback' ELSE 'header' END AS source,
               count(*) AS n_files,
               {ts_text("min(CASE WHEN user_id % 4 = 0 THEN ts ELSE date_trunc('second', ts) END)")} AS first_ts,
               {ts_text("max(CASE WHEN user_id % 4 = 0 THEN ts ELSE date_trunc('second', ts) END)")} AS last_ts
        FROM events GROUP BY 1""",
)
def timestamp_fallback(t):
    ts = F.col("ts").cast("timestamp")
    name = F.concat(F.lit("raw/TripUpdates/muni/2024-01-01/"), F.date_format(ts, "yyyy-MM-dd'T'HH-mm-ss.SSSSSS"), F.lit("Z.pb"))
    snaps = t.events.select(
        name.alias("blob_name"), F.when(F.col("user_id") % 4 != 0, F.unix_seconds(ts)).alias("header_epoch")
    )
    header = tm.epoch_to_ts(F.col("header_epoch"))
    resolved = snaps.select(
        F.coalesce(header, tm.snapshot_ts_from_path(F.col("blob_name"))).alias("snapshot_ts"),
        F.when(header.isNotNull(), F.lit("header")).otherwise(F.lit("filename_fallback")).alias("source"),
    )
    return resolved.groupBy("source").agg(
        F.count("*").alias("n_files"), F.min("snapshot_ts").alias("first_ts"), F.max("snapshot_ts").alias("last_ts")
    )


@query(
    "snapshot_manifest",
    f"""SELECT CASE WHEN event_type = 'click' THEN 'TripUpdates' ELSE 'VehiclePositions' END AS feed,
               CASE WHEN user_id % 2 = 0 THEN 'muni' ELSE 'bart' END AS agency_id, strftime(ts, '%Y-%m-%d') AS source_date,
               {ts_text('ts')} AS filename_snapshot_ts,
               row_number() OVER (PARTITION BY event_type = 'click', user_id % 2 = 0, cast(ts AS date) ORDER BY ts) - 1 AS blob_order
        FROM events""",
)
def snapshot_manifest(t):
    ts = F.col("ts").cast("timestamp")
    path = F.concat_ws(
        "/",
        F.lit("raw"),
        F.when(F.col("event_type") == "click", F.lit("TripUpdates")).otherwise(F.lit("VehiclePositions")),
        F.when(F.col("user_id") % 2 == 0, F.lit("muni")).otherwise(F.lit("bart")),
        F.date_format(ts, "yyyy-MM-dd"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH-mm-ss.SSSSSS"), F.lit("Z.pb")),
    )
    return files.snapshot_manifest(t.events.select(path.alias("path"))).select(
        "feed", "agency_id", "source_date", "filename_snapshot_ts", "blob_order"
    )


@query(
    "sample_every_k",
    """SELECT event_id, user_id FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events) n
       WHERE (pos - 1) % 7 = 0""",
)
def sample_every_k_query(t):
    ordered = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return sample_every_k(ordered, ["ts", "event_id"], 7).select("event_id", "user_id")


@query(
    "polling_slots",
    """SELECT count(*) FILTER ((epoch_us(ts) // 60000000) % 1 = 0) AS n_1_min,
              count(*) FILTER ((epoch_us(ts) // 60000000) % 5 = 0) AS n_5_min,
              count(*) FILTER ((epoch_us(ts) // 60000000) % 2 = 0) AS n_90_sec FROM events""",
)
def polling_slots(t):
    ts = F.col("ts").cast("timestamp")
    return t.events.agg(
        F.count_if(tm.on_slot(ts, 0)).alias("n_1_min"),
        F.count_if(tm.on_slot(ts, 300)).alias("n_5_min"),
        F.count_if(tm.on_slot(ts, 90)).alias("n_90_sec"),
    )


@query(
    "valid_source_dates",
    """SELECT day, try_cast(day AS date) IS NOT NULL AND try_cast(day AS date) < date '2024-01-20' AS usable, count(*) AS n
       FROM (SELECT CASE WHEN user_id % 9 = 0 THEN 'not-a-date' WHEN user_id % 9 = 1 THEN '2024-02-30'
                         ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events) d
       GROUP BY 1, 2""",
)
def valid_source_dates(t):
    day = (
        F.when(F.col("user_id") % 9 == 0, F.lit("not-a-date"))
        .when(F.col("user_id") % 9 == 1, F.lit("2024-02-30"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    usable = tm.is_past_date(F.col("day"), F.lit("2024-01-20").cast("date"))
    return t.events.select(day.alias("day")).groupBy("day", usable.alias("usable")).agg(F.count("*").alias("n"))


@query(
    "lookback_window",
    f"""SELECT strftime(d.day, '%Y-%m-%d') AS day, count(e.event_id) AS n_rows
        FROM (SELECT unnest(generate_series(timestamp '2024-01-25', timestamp '2024-02-03', INTERVAL 1 DAY)) AS day) d
        LEFT JOIN events e ON cast({pacific('e.ts')} AS date) = cast(d.day AS date)
        GROUP BY 1""",
)
def lookback_window(t):
    return files.lookback_window(t.events, tm.pacific_date(F.col("ts").cast("timestamp")), "2024-02-03", 10)


@query(
    "incremental_slice",
    f"""SELECT "311_incident_id", {ts_text('updated_datetime')} AS updated_datetime FROM incidents_311
        WHERE updated_datetime >= timestamp '2024-01-23 00:00:00'""",
)
def incremental_slice(t):
    return files.updated_since(t.incidents_311, "updated_datetime", dt.date(2024, 1, 25)).select(
        "311_incident_id", "updated_datetime"
    )


@query(
    "sanitised_names",
    r"""SELECT c_mktsegment, n, CASE WHEN regexp_matches(base, '^[0-9]') THEN 'x_' || base ELSE base END AS identifier
        FROM (SELECT c_mktsegment, n, coalesce(nullif(regexp_replace(regexp_replace(trim(raw), '[^A-Za-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'agency') AS base
              FROM (SELECT c_mktsegment, n, CASE n % 3 WHEN 0 THEN n || ' ' || c_mktsegment || '!' WHEN 1 THEN ' ' || c_mktsegment || '-x' ELSE '--' END AS raw
                    FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) g) r) b""",
)
def sanitised_names(t):
    segments = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    raw = (
        F.when(F.col("n") % 3 == 0, F.concat(F.col("n").cast("string"), F.lit(" "), "c_mktsegment", F.lit("!")))
        .when(F.col("n") % 3 == 1, F.concat(F.lit(" "), "c_mktsegment", F.lit("-x")))
        .otherwise(F.lit("--"))
    )
    return segments.select("c_mktsegment", "n", tx.sanitise_identifier(raw, "agency").alias("identifier"))


# ---- quality


def _dq_sql():
    def row(model, name, condition, source, severity="error"):
        return (
            f"SELECT '{model}' AS model, '{name}' AS check_name, '{severity}' AS severity, "
            f"count(*) FILTER ({condition}) AS failures, count(*) FILTER ({condition}) = 0 AS passed FROM {source}"
        )

    e, r = "gold_dashboard_events", "gold_rental_listings"
    parts = [row(e, f"not_null({c})", f"{c} IS NULL", "gold_events") for c in ("event_id", "event_type", "event_ts_utc", "event_date_pacific")]
    parts.append(row(e, "accepted_values(event_type)", "event_type NOT IN ('311', 'police', 'transit')", "gold_events"))
    parts.append(row(e, "unique(event_id)", "n > 1", "(SELECT count(*) AS n FROM gold_events GROUP BY event_id) g", "warn"))
    for c in ("rentcast_id", "listed_date", "neighborhood_id", "police_district_id", "bedroom_bucket", "price"):
        severity = "warn" if c.endswith("hood_id") or c.endswith("district_id") else "error"
        parts.append(row(r, f"not_null({c})", f"{c} IS NULL", "gold_rental", severity))
    parts.append(row(r, "accepted_values(bedroom_bucket)", "bedroom_bucket NOT IN ('studio', '1bd', '2bd', '3bd', '4bd+', 'unknown')", "gold_rental"))
    parts.append(row(r, "price_positive", "price <= 0", "gold_rental"))
    parts.append(row(r, "removal_after_listing", "removed_date IS NOT NULL AND removed_date < listed_date", "gold_rental"))
    parts.append(row(r, "unique(rentcast_id, listed_date)", "n > 1", "(SELECT count(*) AS n FROM gold_rental GROUP BY rentcast_id, listed_date) g"))
    return " UNION ALL ".join(parts)


@query("dq_report", _dq_sql())
def dq_report(t):
    events = checks.dq_report(t.gold_events, marts.EVENT_RULES)
    return events.unionByName(checks.dq_report(t.gold_rentals, marts.rental_rules()))


# ---- batch twins of the streams


@query(
    "active_per_minute",
    f"""SELECT {ts_text("date_trunc('minute', vp_snapshot_ts)")} AS window_start, route_id,
               count(DISTINCT vehicle_id) AS active_vehicles
        FROM vehicle_positions GROUP BY 1, 2""",
)
def active_per_minute(t):
    return active_vehicles(t.vehicle_positions)


@query(
    "stale_invalid_counts",
    f"""SELECT {ts_text("date_trunc('hour', vp_snapshot_ts)")} AS window_start, count(*) AS n_records,
               count(*) FILTER (epoch_us(vp_snapshot_ts) - epoch_us(position_timestamp) > 90000000) AS n_stale,
               count(*) FILTER (trip_id IS NULL OR stop_sequence IS NULL OR vehicle_id IS NULL) AS n_invalid
        FROM vehicle_positions GROUP BY 1""",
)
def stale_invalid(t):
    return stale_invalid_counts(t.vehicle_positions, window="1 hour")


# ---- polygon dimension from GeoJSON features: one feature per customer


@query(
    "geojson_polygons",
    """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_name AS name,
              cast(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS bigint) AS ring_count, -((122400000 + c_custkey) / 1e6) AS first_x,
              CASE WHEN c_custkey % 3 = 0 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind
       FROM customer""",
)
def geojson_polygons(t):
    key = F.col("c_custkey")
    x, y = -((F.lit(122400000) + key) / F.lit(1e6)), (F.lit(37750000) + key) / F.lit(1e6)
    ring = F.array(F.array(x, y), F.array(x + 0.5, y), F.array(x + 0.5, y + 0.5), F.array(x, y))
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    multi = F.to_json(
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring), F.array(ring)).alias("coordinates"))
    )
    features = t.customer.select(
        key.alias("ordinal"),
        F.create_map(F.lit("name"), F.col("c_name")).alias("properties"),
        F.from_json(F.when(key % 3 == 0, multi).otherwise(polygon), "type string, coordinates string").alias("geometry"),
    )
    dim = files.polygons_from_features(features, F.col("properties")["name"])
    return dim.select("id", "name", "geometry", wkt_rings(F.col("geometry")).alias("r")).select(
        "id",
        "name",
        F.size("r").cast("bigint").alias("ring_count"),
        F.element_at(F.element_at("r", 1), 1)["x"].alias("first_x"),
        F.regexp_extract("geometry", "^[A-Z]+", 0).alias("kind"),
    )
