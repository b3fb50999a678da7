"""Intermediate results in DuckDB SQL, used by several check statements."""

START_UTC, END_UTC = "timestamp '2024-01-05 08:00:00'", "timestamp '2024-01-21 08:00:00'"


def pacific(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')"


def ts_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


KEY = "agency_id, trip_id, trip_start_date, trip_start_time, direction_id, stop_sequence"
KEY_COLUMNS = KEY.split(", ")


def same_key(a: str, b: str, columns=KEY_COLUMNS) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in columns)


def _edges(table: str) -> str:
    return f"""
    SELECT id, x1, y1, x2, y2 FROM (
      SELECT id, ring, i, x AS x1, y AS y1,
             lead(x) OVER (PARTITION BY id, ring ORDER BY i) AS x2,
             lead(y) OVER (PARTITION BY id, ring ORDER BY i) AS y2
      FROM (SELECT id, ring, i, cast(split_part(trim(p), ' ', 1) AS double) AS x,
                   cast(split_part(trim(p), ' ', 2) AS double) AS y
            FROM (SELECT id, ring, unnest(string_split(txt, ',')) AS p,
                         unnest(range(len(string_split(txt, ',')))) AS i
                  FROM (SELECT id, unnest(regexp_extract_all(geometry, '\\(([^()]+)\\)', 1)) AS txt,
                               unnest(range(len(regexp_extract_all(geometry, '\\(([^()]+)\\)', 1)))) AS ring
                        FROM {table}
                        WHERE geometry LIKE '%))' AND id IS NOT NULL) r) s) p) e
    WHERE x2 IS NOT NULL"""


def _inside(points: str, edges: str, out: str) -> str:
    """Brute force: every point against every polygon whose bounding box holds it."""
    return f"""
    SELECT point_id, min(id) AS {out} FROM (
      SELECT p.point_id, e.id
      FROM {points} p
      JOIN (SELECT id, min(least(x1, x2)) AS x0, max(greatest(x1, x2)) AS x9,
                   min(least(y1, y2)) AS y0, max(greatest(y1, y2)) AS y9 FROM {edges} GROUP BY id) b
        ON p.long BETWEEN b.x0 AND b.x9 AND p.lat BETWEEN b.y0 AND b.y9
      JOIN {edges} e ON e.id = b.id
      WHERE (e.y1 > p.lat) <> (e.y2 > p.lat)
        AND p.long < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
      GROUP BY p.point_id, e.id HAVING count(*) % 2 = 1) h
    GROUP BY point_id"""


def _gold_part(kind: str, source: str, id_col: str, ts: str, category: str) -> str:
    return f"""
    SELECT '{kind}:' || cast({id_col} AS varchar) AS event_id, '{kind}' AS event_type, {ts} AS event_ts_utc,
           cast(neighborhood_id AS varchar) AS neighborhood_id,
           cast(police_district_id AS varchar) AS police_district_id,
           coalesce(nullif(trim({category}), ''), 'Unknown') AS category, cast(NULL AS double) AS arrival_delay_sec
    FROM {source}"""


VIEWS: dict[str, str] = {
    "gold_events": f"""
    SELECT *, cast({pacific('event_ts_utc')} AS date) AS event_date_pacific,
           epoch_us({pacific('event_ts_utc')}) % 86400000000 AS event_tod_us,
           arrival_delay_sec > 300 AS delayed_over_5_min
    FROM ({_gold_part('311', 'incidents_311', '"311_incident_id"', 'requested_datetime', 'service_name')}
      UNION ALL
      {_gold_part('police', 'police_incidents', 'police_incident_id', 'report_datetime', 'incident_category')}
      UNION ALL
      SELECT 'transit:' || t.trip_stop_id, 'transit', t.arrival_time_predicted,
             cast(s.neighborhood_id AS varchar), cast(s.police_district_id AS varchar), NULL, t.arrival_delay_sec
      FROM trip_stops t LEFT JOIN stops s ON t.agency_id = s.agency_id AND t.stop_id = s.stop_id
      WHERE t.arrival_time_predicted IS NOT NULL) u""",
    "gold_bounds": """
    SELECT 'neighborhoods' AS boundary_type, cast(id AS varchar) AS boundary_id, name AS boundary_name, geometry,
           geometry IS NULL AS is_unlocated FROM neighborhoods WHERE id IS NOT NULL
    UNION ALL
    SELECT 'police_districts', cast(id AS varchar), name, geometry, geometry IS NULL
    FROM police_districts WHERE id IS NOT NULL""",
    "gold_rental": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT rentcast_id, listed_date, removed_date, cast(neighborhood_id AS varchar) AS neighborhood_id,
             cast(police_district_id AS varchar) AS police_district_id, property_type, beds,
             CASE WHEN beds = 0 THEN 'studio' WHEN beds = 1 THEN '1bd' WHEN beds = 2 THEN '2bd' WHEN beds = 3 THEN '3bd'
                  WHEN beds >= 4 THEN '4bd+' ELSE 'unknown' END AS bedroom_bucket,
             baths, square_footage, price, formatted_address, try_cast(lat AS double) AS lat,
             try_cast(long AS double) AS long,
             CASE WHEN try_cast(lat AS double) BETWEEN -90 AND 90 AND try_cast(long AS double) BETWEEN -180 AND 180
                  THEN 'POINT(' || cast(try_cast(long AS double) AS varchar) || ' ' || cast(try_cast(lat AS double) AS varchar) || ')'
             END AS geometry,
             row_number() OVER (PARTITION BY rentcast_id, listed_date
               ORDER BY removed_date DESC NULLS LAST, neighborhood_id DESC NULLS LAST, police_district_id DESC NULLS LAST,
                        property_type DESC NULLS LAST, beds DESC NULLS LAST, baths DESC NULLS LAST,
                        square_footage DESC NULLS LAST, price DESC) AS rn
      FROM rental_listings WHERE price > 0) r
    WHERE rn = 1""",
    "chosen_events": f"""
    SELECT * FROM gold_events
    WHERE event_ts_utc >= {START_UTC} AND event_ts_utc < {END_UTC}
      AND event_tod_us BETWEEN 6 * 3600000000 AND 22 * 3600000000""",
    "chosen_by_boundary": """
    SELECT 'neighborhoods' AS boundary_type, neighborhood_id AS boundary_id, * FROM chosen_events
    WHERE neighborhood_id IS NOT NULL
    UNION ALL
    SELECT 'police_districts', police_district_id, * FROM chosen_events WHERE police_district_id IS NOT NULL""",
    "gold_by_boundary": """
    SELECT 'neighborhoods' AS boundary_type, neighborhood_id AS boundary_id, * FROM gold_events
    WHERE neighborhood_id IS NOT NULL
    UNION ALL
    SELECT 'police_districts', police_district_id, * FROM gold_events WHERE police_district_id IS NOT NULL""",
    "nb_edges": _edges("neighborhoods"),
    "pd_edges": _edges("police_districts"),
    "in_nb": _inside("points", "nb_edges", "nb"),
    "in_pd": _inside("points", "pd_edges", "pd"),
    "tu_latest": f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT {KEY}, route_id, stop_id, snapshot_ts AS latest_snapshot_ts, arrival_time_predicted,
             departure_time_predicted, arrival_delay_sec, departure_delay_sec,
             row_number() OVER (PARTITION BY {KEY} ORDER BY snapshot_ts DESC, blob_order DESC, blob_name DESC) AS rn
      FROM trip_updates) t
    WHERE rn = 1""",
    "vp_latest": f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY vp_snapshot_ts DESC, blob_order DESC, blob_name DESC) AS rn
      FROM vehicle_positions
      WHERE trip_id IS NOT NULL AND stop_sequence IS NOT NULL AND vp_snapshot_ts IS NOT NULL) v
    WHERE rn = 1""",
    "joined_day": f"""
    SELECT t.*, v.vp_snapshot_ts, v.position_timestamp, v.vp_stop_id, v.current_status, v.vehicle_id,
           v.vehicle_label, v.latitude, v.longitude, v.bearing, v.speed
    FROM tu_latest t LEFT JOIN vp_latest v ON {same_key('t', 'v')}""",
}
