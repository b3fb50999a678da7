"""Marts and boundary metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fogline.functions import text as tx
from fogline.functions.temporal import pacific_range_to_utc
from fogline.operators.profile import capped
from fogline.plans import marts, metrics
from fogline.schemas import BOUNDARY_COLUMNS
from workload.registry import query
from workload.sqlviews import END_UTC, START_UTC, ts_text

START, END = "2024-01-05", "2024-01-20"
TIMES = ("06:00", "22:00")
AS_OF = "2024-01-25"


def _chosen(t):
    return metrics.select_events(t.gold_events, START, END, *TIMES)


@query(
    "gold_events",
    f"""SELECT event_id, event_type, {ts_text('event_ts_utc')} AS event_ts_utc,
               strftime(event_date_pacific, '%Y-%m-%d') AS event_date_pacific, event_tod_us, neighborhood_id,
               police_district_id, category, arrival_delay_sec, delayed_over_5_min
        FROM gold_events""",
)
def gold_events(t):
    return t.gold_events


@query(
    "gold_events_legacy_stop_join",
    """SELECT event_type, neighborhood_id, count(*) AS n FROM (
         SELECT event_type, neighborhood_id FROM gold_events WHERE event_type <> 'transit'
         UNION ALL
         SELECT 'transit', cast(s.neighborhood_id AS varchar) FROM trip_stops t LEFT JOIN stops s ON t.stop_id = s.stop_id
         WHERE t.arrival_time_predicted IS NOT NULL) u
       GROUP BY event_type, neighborhood_id""",
)
def gold_events_legacy_stop_join(t):
    events = marts.gold_dashboard_events(
        t.incidents_311, t.police_incidents, t.trip_stops, t.stops, legacy_stop_join=True
    )
    return events.groupBy("event_type", "neighborhood_id").agg(F.count("*").alias("n"))


USE_SQL = """
    SELECT boundary_type, boundary_id, count(*) AS n_events
    FROM (SELECT 'neighborhoods' AS boundary_type, neighborhood_id AS boundary_id FROM gold_events
          UNION ALL SELECT 'police_districts', police_district_id FROM gold_events) u
    WHERE boundary_id IS NOT NULL GROUP BY 1, 2"""


def _use(t):
    """Events per boundary."""
    return metrics.by_boundary(t.gold_events.select(*BOUNDARY_COLUMNS.values())).groupBy(*metrics.BOUNDARY).agg(
        F.count("*").alias("n_events")
    )


@query(
    "gold_boundaries",
    f"""SELECT b.boundary_type, b.boundary_id, b.boundary_name, b.geometry, b.is_unlocated, coalesce(u.n_events, 0) AS n_events
        FROM gold_bounds b LEFT JOIN ({USE_SQL}) u USING (boundary_type, boundary_id)""",
)
def gold_boundaries(t):
    return t.gold_boundaries.join(_use(t), list(metrics.BOUNDARY), "left").na.fill(0, ["n_events"])


@query(
    "gold_rentals",
    f"""SELECT rentcast_id, {ts_text('listed_date')} AS listed_date, {ts_text('removed_date')} AS removed_date,
               neighborhood_id, police_district_id, property_type, beds, bedroom_bucket, baths, square_footage, price,
               formatted_address, lat, long, geometry
        FROM gold_rental""",
)
def gold_rentals(t):
    return t.gold_rentals


KPI_SQL = """
    SELECT boundary_type, boundary_id,
           count(*) FILTER (event_type = '311') AS incidents_311_total,
           count(*) FILTER (event_type = 'police') AS police_total,
           count(*) FILTER (event_type = 'transit') AS transit_arrivals_total,
           quantile_disc(arrival_delay_sec, 0.5) AS transit_median_delay_sec,
           CASE WHEN count(arrival_delay_sec) > 0
                THEN count(*) FILTER (arrival_delay_sec > 300) / cast(count(arrival_delay_sec) AS double) * 100 END
             AS transit_pct_delay_over_300_sec
    FROM chosen_by_boundary GROUP BY boundary_type, boundary_id"""


@query("boundary_kpis", KPI_SQL)
def boundary_kpis(t):
    return metrics.boundary_kpis(_chosen(t))


@query("boundary_kpis_approx", KPI_SQL)
def boundary_kpis_approx(t):
    return metrics.boundary_kpis_approx(_chosen(t))


@query(
    "time_bounds",
    f"""WITH ends AS (
          SELECT min(event_ts_utc) FILTER (event_type = '311') AS a0, max(event_ts_utc) FILTER (event_type = '311') AS a9,
                 min(event_ts_utc) FILTER (event_type = 'police') AS b0, max(event_ts_utc) FILTER (event_type = 'police') AS b9,
                 min(event_ts_utc) FILTER (event_type = 'transit') AS c0, max(event_ts_utc) FILTER (event_type = 'transit') AS c9
          FROM gold_events),
        ranges AS (
          SELECT CASE WHEN a0 IS NOT NULL AND b0 IS NOT NULL AND c0 IS NOT NULL THEN least(a0, b0, c0) END AS g0,
                 CASE WHEN a9 IS NOT NULL AND b9 IS NOT NULL AND c9 IS NOT NULL THEN greatest(a9, b9, c9) END AS g9,
                 CASE WHEN a0 IS NOT NULL AND b0 IS NOT NULL AND c0 IS NOT NULL THEN greatest(a0, b0, c0) END AS o0,
                 CASE WHEN a9 IS NOT NULL AND b9 IS NOT NULL AND c9 IS NOT NULL THEN least(a9, b9, c9) END AS o9
          FROM ends)
        SELECT {ts_text('g0')} AS global_min_ts, {ts_text('g9')} AS global_max_ts, {ts_text('o0')} AS overlap_min_ts,
               {ts_text('o9')} AS overlap_max_ts,
               {ts_text('CASE WHEN o0 <= o9 THEN o0 ELSE g0 END')} AS start_ts,
               {ts_text('CASE WHEN o0 <= o9 THEN o9 ELSE g9 END')} AS end_ts
        FROM ranges""",
)
def time_bounds(t):
    return metrics.time_bounds(t.gold_events)


HISTOGRAM_SQL = """
    SELECT boundary_type, boundary_id, event_type, category, count(*) AS category_count
    FROM chosen_by_boundary WHERE event_type IN ('311', 'police')
    GROUP BY boundary_type, boundary_id, event_type, category"""


@query("category_histogram", HISTOGRAM_SQL)
def category_histogram(t):
    return metrics.category_histogram(_chosen(t))


@query(
    "category_top10",
    f"""SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY boundary_type, boundary_id, event_type
                                       ORDER BY category_count DESC, category) AS category_rank
          FROM ({HISTOGRAM_SQL}) h) r
        WHERE category_rank <= 10""",
)
def category_top10(t):
    return metrics.category_top(metrics.category_histogram(_chosen(t)))


@query(
    "rental_comparison",
    f"""WITH rows_ AS (
          SELECT 'neighborhoods' AS boundary_type, neighborhood_id AS boundary_id, * FROM gold_rental WHERE neighborhood_id IS NOT NULL
          UNION ALL
          SELECT 'police_districts', police_district_id, * FROM gold_rental WHERE police_district_id IS NOT NULL),
        buckets AS (SELECT unnest(['studio', '1bd', '2bd', '3bd', '4bd+']) AS bedroom_bucket, unnest(range(5)) AS bucket_order),
        sel AS (SELECT boundary_type, boundary_id, bedroom_bucket, avg(price) AS p, count(*) AS n FROM rows_
                WHERE listed_date < timestamp '1998-03-02 08:00:00'
                  AND (removed_date IS NULL OR removed_date > timestamp '1998-01-01 08:00:00')
                GROUP BY ALL),
        cur AS (SELECT boundary_type, boundary_id, bedroom_bucket, avg(price) AS p, count(*) AS n FROM rows_
                WHERE removed_date IS NULL AND listed_date <= timestamp '2000-06-01 00:00:00' GROUP BY ALL),
        spine AS (SELECT * FROM (SELECT boundary_type, boundary_id FROM sel WHERE bedroom_bucket <> 'unknown'
                                 UNION SELECT boundary_type, boundary_id FROM cur WHERE bedroom_bucket <> 'unknown') b, buckets)
        SELECT s.boundary_type, s.boundary_id, s.bucket_order, s.bedroom_bucket, sel.p AS selected_average_price,
               coalesce(sel.n, 0) AS selected_listing_count, cur.p AS current_average_price,
               coalesce(cur.n, 0) AS current_listing_count, '2000-06-01' AS current_as_of
        FROM spine s LEFT JOIN sel USING (boundary_type, boundary_id, bedroom_bucket)
             LEFT JOIN cur USING (boundary_type, boundary_id, bedroom_bucket)""",
)
def rental_comparison(t):
    return metrics.rental_comparison(
        t.gold_rentals,
        "1998-01-01",
        "1998-03-01",
        F.lit("2000-06-01 00:00:00").cast("timestamp"),
        F.lit("2000-06-01").cast("date"),
    )


@query(
    "top_boundaries",
    """SELECT b.boundary_id, b.boundary_name, c.n AS event_count
       FROM (SELECT neighborhood_id, count(*) AS n FROM gold_events
             WHERE event_type = 'police' AND neighborhood_id IS NOT NULL GROUP BY 1) c
       JOIN gold_bounds b ON b.boundary_type = 'neighborhoods' AND b.boundary_id = c.neighborhood_id
       ORDER BY c.n DESC, b.boundary_name, b.boundary_id LIMIT 10""",
)
def top_boundaries(t):
    return metrics.top_boundaries(t.gold_events, t.gold_boundaries, "police")


@query(
    "last_n_days_trend",
    f"""SELECT strftime(event_date_pacific, '%Y-%m-%d') AS event_date_pacific, event_type, count(*) AS event_count
        FROM gold_events
        WHERE event_date_pacific >= date '{AS_OF}' - 14 AND event_date_pacific <= date '{AS_OF}' - 2
        GROUP BY 1, 2""",
)
def last_n_days_trend(t):
    return metrics.daily_trend(t.gold_events, AS_OF, 14, exclude_last_days=2)


@query(
    "boundary_day_rollup",
    """SELECT boundary_type, boundary_id, strftime(event_date_pacific, '%Y-%m-%d') AS event_date_pacific,
              count(*) FILTER (event_type = '311') AS incidents_311, count(*) FILTER (event_type = 'police') AS police,
              count(*) FILTER (event_type = 'transit') AS transit_arrivals, count(arrival_delay_sec) AS transit_with_delay,
              count(*) FILTER (arrival_delay_sec > 300) AS transit_delayed_over_5_min
       FROM (SELECT 'neighborhoods' AS boundary_type, neighborhood_id AS boundary_id, * FROM gold_events
             UNION ALL SELECT 'police_districts', police_district_id, * FROM gold_events) u
       WHERE boundary_id IS NOT NULL GROUP BY 1, 2, 3""",
)
def boundary_day_rollup(t):
    return metrics.boundary_day_rollup(t.gold_events)


# The check rebuilds the coordinate text with list functions; the operator uses WKT rings.
FEATURES_SQL = """
    SELECT boundary_type, boundary_id AS id, coalesce(boundary_name, boundary_id) AS name,
           CASE WHEN geometry LIKE 'MULTI%' THEN '{"type":"MultiPolygon","coordinates":[[' || array_to_string(rings, '],[') || ']]}'
                ELSE '{"type":"Polygon","coordinates":[' || array_to_string(rings, ',') || ']}' END AS geojson
    FROM (SELECT *, list_transform(regexp_extract_all(geometry, '\\(([^()]+)\\)', 1),
             lambda r: '[' || array_to_string(list_transform(string_split(r, ','),
               lambda p: '[' || cast(cast(split_part(trim(p), ' ', 1) AS double) AS varchar) || ','
                             || cast(cast(split_part(trim(p), ' ', 2) AS double) AS varchar) || ']'), ',') || ']') AS rings
          FROM gold_bounds WHERE geometry LIKE '%))') g"""


@query(
    "boundary_features",
    f"""SELECT f.boundary_type, f.id, f.name, f.geojson, coalesce(u.n_events, 0) AS n_events
        FROM ({FEATURES_SQL}) f LEFT JOIN ({USE_SQL}) u ON f.boundary_type = u.boundary_type AND f.id = u.boundary_id""",
)
def boundary_features(t):
    used = _use(t).withColumnRenamed("boundary_id", "id")
    return metrics.boundary_features(t.gold_boundaries).join(used, ["boundary_type", "id"], "left").na.fill(0, ["n_events"])


@query(
    "feature_collection",
    f"""SELECT boundary_type,
               '{{"type":"FeatureCollection","features":[' || string_agg(
                 '{{"type":"Feature","id":"' || id || '","properties":{{"id":"' || id || '","name":"' || name
                 || '"}},"geometry":' || geojson || '}}', ',' ORDER BY name, id) || ']}}' AS geojson,
               count(*) AS n_names
        FROM ({FEATURES_SQL}) f WHERE (boundary_type, id) IN (SELECT boundary_type, boundary_id FROM ({USE_SQL}) u)
        GROUP BY boundary_type""",
)
def feature_collection(t):
    used = _use(t).withColumnRenamed("boundary_id", "id")
    drawn = metrics.boundary_features(t.gold_boundaries).join(used, ["boundary_type", "id"], "left_semi")
    layers = metrics.feature_collection(drawn)
    return layers.select("boundary_type", "geojson", F.size("id_to_name").cast("bigint").alias("n_names"))


@query(
    "stage_category",
    """SELECT event_type, category, count(*) AS n FROM gold_events WHERE event_type <> 'transit' GROUP BY 1, 2""",
)
def stage_category(t):
    tagged = [
        marts.stage_311_incidents(t.incidents_311).withColumn("event_type", F.lit("311")),
        marts.stage_police_incidents(t.police_incidents).withColumn("event_type", F.lit("police")),
    ]
    return tagged[0].unionByName(tagged[1]).groupBy("event_type", "category").agg(F.count("*").alias("n"))


@query(
    "row_cap",
    """SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 1000""",
)
def row_cap(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    return capped(per_part.orderBy(F.desc("n"), "l_partkey"), 1000)


def _parity_sql(kind, source, ts):
    return f"""
        SELECT coalesce(s.boundary_type, m.boundary_type) AS boundary_type, coalesce(s.boundary_id, m.boundary_id) AS boundary_id,
               '{kind}' AS event_type, coalesce(s.n, 0) AS source_rows, coalesce(m.n, 0) AS mart_rows,
               coalesce(s.n, 0) = coalesce(m.n, 0) AS equal
        FROM (SELECT boundary_type, boundary_id, count(*) AS n FROM (
                SELECT 'neighborhoods' AS boundary_type, cast(neighborhood_id AS varchar) AS boundary_id, {ts} AS ts FROM {source}
                UNION ALL SELECT 'police_districts', cast(police_district_id AS varchar), {ts} FROM {source}) u
              WHERE boundary_id IS NOT NULL AND ts >= {START_UTC} AND ts < {END_UTC} GROUP BY 1, 2) s
        FULL JOIN (SELECT boundary_type, boundary_id, count(*) AS n FROM (
                SELECT 'neighborhoods' AS boundary_type, neighborhood_id AS boundary_id, * FROM gold_events
                UNION ALL SELECT 'police_districts', police_district_id, * FROM gold_events) u
              WHERE boundary_id IS NOT NULL AND event_type = '{kind}'
                AND event_ts_utc >= {START_UTC} AND event_ts_utc < {END_UTC} GROUP BY 1, 2) m
        ON s.boundary_type = m.boundary_type AND s.boundary_id = m.boundary_id"""


@query(
    "mart_parity",
    _parity_sql("311", "incidents_311", "requested_datetime")
    + " UNION ALL "
    + _parity_sql("police", "police_incidents", "report_datetime"),
)
def mart_parity(t):
    start, end = pacific_range_to_utc(START, END)
    parts = [
        metrics.incident_parity(t.gold_events, t.incidents_311, "311", "requested_datetime", start, end),
        metrics.incident_parity(t.gold_events, t.police_incidents, "police", "report_datetime", start, end),
    ]
    return parts[0].unionByName(parts[1])


@query(
    "mart_parity_transit",
    f"""SELECT boundary_id, count(*) AS transit_arrivals_total, avg(arrival_delay_sec) AS transit_avg_delay_sec
        FROM (SELECT cast(s.neighborhood_id AS varchar) AS boundary_id, t.arrival_delay_sec
              FROM trip_stops t JOIN stops s ON t.stop_id = s.stop_id AND t.agency_id = s.agency_id
              WHERE s.neighborhood_id IS NOT NULL AND t.arrival_time_predicted >= {START_UTC}
                AND t.arrival_time_predicted < {END_UTC}) x
        GROUP BY boundary_id""",
)
def mart_parity_transit(t):
    start, end = pacific_range_to_utc(START, END)
    rows = t.gold_events.where(
        (F.col("event_type") == "transit")
        & F.col("neighborhood_id").isNotNull()
        & (F.col("event_ts_utc") >= start)
        & (F.col("event_ts_utc") < end)
    )
    return rows.groupBy(F.col("neighborhood_id").alias("boundary_id")).agg(
        F.count("*").alias("transit_arrivals_total"), F.avg("arrival_delay_sec").alias("transit_avg_delay_sec")
    )


@query(
    "kpi_labels",
    f"""SELECT boundary_type, boundary_id, format('{{:,}}', incidents_311_total) AS incidents_label,
               CASE WHEN transit_median_delay_sec IS NULL THEN 'N/A'
                    WHEN abs(transit_median_delay_sec) < 0.5 THEN '0.0 min on time'
                    ELSE format('{{:.1f}} min ', abs(transit_median_delay_sec) / 60.0)
                         || CASE WHEN transit_median_delay_sec > 0 THEN 'late' ELSE 'early' END END AS delay_label,
               CASE WHEN transit_pct_delay_over_300_sec IS NULL THEN 'N/A'
                    ELSE format('{{:.1f}}%', transit_pct_delay_over_300_sec) END AS percent_label
        FROM ({KPI_SQL}) k""",
)
def kpi_labels(t):
    return metrics.boundary_kpis(_chosen(t)).select(
        "boundary_type",
        "boundary_id",
        tx.count_label(F.col("incidents_311_total")).alias("incidents_label"),
        tx.delay_label(F.col("transit_median_delay_sec")).alias("delay_label"),
        tx.percent_label(F.col("transit_pct_delay_over_300_sec")).alias("percent_label"),
    )


@query(
    "rental_labels",
    """SELECT rentcast_id, strftime(listed_date, '%Y-%m-%d') AS listed_day,
              '$' || format('{:,}', price) AS price_label,
              strftime(listed_date, '%b %-d, %Y') AS listed_label,
              coalesce(strftime(removed_date, '%b %-d, %Y'), 'today') AS removed_label
       FROM gold_rental""",
)
def rental_labels(t):
    return t.gold_rentals.select(
        "rentcast_id",
        F.to_date("listed_date").alias("listed_day"),
        tx.currency_label(F.col("price")).alias("price_label"),
        tx.date_label(F.col("listed_date")).alias("listed_label"),
        tx.date_label(F.col("removed_date")).alias("removed_label"),
    )


@query(
    "boundary_id_normalised",
    """SELECT raw_id, CASE WHEN trim(raw_id) = '' OR lower(trim(raw_id)) = 'none' THEN NULL
                           WHEN trim(raw_id) LIKE 'B%' THEN trim(raw_id)
                           WHEN trim(raw_id) LIKE '%.5' THEN trim(raw_id)
                           ELSE regexp_replace(trim(raw_id), '\\.0$', '') END AS boundary_id, n
       FROM (SELECT CASE user_id % 5 WHEN 0 THEN cast(user_id AS varchar) || '.0' WHEN 1 THEN ' ' || cast(user_id AS varchar)
                         WHEN 2 THEN 'None' WHEN 3 THEN 'B' || cast(user_id AS varchar)
                         ELSE cast(user_id AS varchar) || '.5' END AS raw_id, count(*) AS n
             FROM events GROUP BY 1) r""",
)
def boundary_id_normalised(t):
    raw = (
        F.when(F.col("user_id") % 5 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".0")))
        .when(F.col("user_id") % 5 == 1, F.concat(F.lit(" "), F.col("user_id").cast("string")))
        .when(F.col("user_id") % 5 == 2, F.lit("None"))
        .when(F.col("user_id") % 5 == 3, F.concat(F.lit("B"), F.col("user_id").cast("string")))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5")))
    )
    counted = t.events.groupBy(raw.alias("raw_id")).agg(F.count("*").alias("n"))
    return counted.select("raw_id", tx.normalise_boundary_id(F.col("raw_id")).alias("boundary_id"), "n")


@query(
    "dashboard_totals",
    f"""SELECT 'neighborhoods' AS boundary_type, '5' AS boundary_id, count(*) FILTER (event_type = '311') AS incidents_311_total,
               count(*) FILTER (event_type = 'police') AS police_total,
               count(*) FILTER (event_type = 'transit') AS transit_arrivals_total,
               quantile_disc(arrival_delay_sec, 0.5) AS transit_median_delay_sec,
               CASE WHEN count(arrival_delay_sec) > 0
                    THEN count(*) FILTER (arrival_delay_sec > 300) / cast(count(arrival_delay_sec) AS double) * 100 END
                 AS transit_pct_delay_over_300_sec
        FROM chosen_events WHERE neighborhood_id = '5'""",
)
def dashboard_totals(t):
    return metrics.boundary_totals(_chosen(t), "neighborhoods", "5")


def _dashboard(t, boundary_id):
    return metrics.boundary_metrics(
        t.gold_events,
        t.gold_rentals,
        "neighborhoods",
        boundary_id,
        START,
        END,
        *TIMES,
        F.lit("2024-06-01 00:00:00").cast("timestamp"),
        F.lit("2024-06-01").cast("date"),
    )


@query(
    "dashboard_histograms",
    """SELECT event_type, category, count(*) AS category_count FROM chosen_events
       WHERE neighborhood_id = '7' AND event_type IN ('311', 'police') GROUP BY 1, 2""",
)
def dashboard_histograms(t):
    parts = _dashboard(t, "7")
    return (
        parts["hist_311"].withColumn("event_type", F.lit("311"))
        .unionByName(parts["hist_police"].withColumn("event_type", F.lit("police")))
    )


@query(
    "dashboard_rentals",
    f"""SELECT 'neighborhoods' AS boundary_type, '7' AS boundary_id, b.bucket_order, b.bedroom_bucket,
               avg(price) FILTER (listed_date < {END_UTC} AND (removed_date IS NULL OR removed_date > {START_UTC})) AS selected_average_price,
               count(rentcast_id) FILTER (listed_date < {END_UTC} AND (removed_date IS NULL OR removed_date > {START_UTC})) AS selected_listing_count,
               avg(price) FILTER (removed_date IS NULL AND listed_date <= timestamp '2024-06-01') AS current_average_price,
               count(rentcast_id) FILTER (removed_date IS NULL AND listed_date <= timestamp '2024-06-01') AS current_listing_count,
               '2024-06-01' AS current_as_of
        FROM (SELECT unnest(['studio', '1bd', '2bd', '3bd', '4bd+']) AS bedroom_bucket, unnest(range(5)) AS bucket_order) b
        LEFT JOIN gold_rental r ON r.bedroom_bucket = b.bedroom_bucket AND r.neighborhood_id = '7'
        GROUP BY ALL""",
)
def dashboard_rentals(t):
    return _dashboard(t, "7")["rentals"]
