"""Point-in-polygon joins and what hangs on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fogline.functions import geo
from fogline.operators import merge, spatial
from workload.registry import query

LABEL_IDS = """
    SELECT p.point_id, n.id AS nb_name, d.id AS pd_name
    FROM points p
    LEFT JOIN neighborhoods n ON lower(replace(p.neighborhood_label, '''', '')) = lower(replace(n.name, '''', ''))
    LEFT JOIN police_districts d ON lower(replace(p.district_label, '''', '')) = lower(replace(d.name, '''', ''))"""


@query(
    "assign_boundaries",
    f"""SELECT p.point_id, coalesce(a.nb, l.nb_name, 404) AS neighborhood_id, coalesce(b.pd, l.pd_name, 404) AS police_district_id
        FROM points p LEFT JOIN in_nb a USING (point_id) LEFT JOIN in_pd b USING (point_id)
        LEFT JOIN ({LABEL_IDS}) l USING (point_id)""",
)
def assign_boundaries(t):
    placed = spatial.assign_boundaries(
        t.points,
        t.neighborhoods,
        t.police_districts,
        neighborhood_label="neighborhood_label",
        district_label="district_label",
    )
    return placed.select("point_id", "neighborhood_id", "police_district_id")


@query(
    "assign_boundaries_null_policy",
    """SELECT p.point_id, a.nb AS neighborhood_id, b.pd AS police_district_id
       FROM points p LEFT JOIN in_nb a USING (point_id) LEFT JOIN in_pd b USING (point_id)""",
)
def assign_boundaries_null_policy(t):
    placed = spatial.assign_boundaries(t.points, t.neighborhoods, t.police_districts, unlocated=None)
    return placed.select("point_id", "neighborhood_id", "police_district_id")


@query(
    "fk_assign_merge",
    """SELECT p.point_id, CASE WHEN p.long IS NULL THEN -1 ELSE a.nb END AS neighborhood_id,
              CASE WHEN p.long IS NULL THEN -1 ELSE b.pd END AS police_district_id
       FROM points p LEFT JOIN in_nb a USING (point_id) LEFT JOIN in_pd b USING (point_id)""",
)
def fk_assign_merge(t):
    loaded = t.points.select(
        "point_id",
        F.lit(-1).cast("bigint").alias("neighborhood_id"),
        F.lit(-1).cast("bigint").alias("police_district_id"),
    )
    located = t.points.where(F.col("long").isNotNull() & F.col("lat").isNotNull()).select("point_id", "long", "lat")
    assigned = spatial.assign_boundaries(located, t.neighborhoods, t.police_districts, unlocated=None)
    return merge.update_foreign_keys(
        loaded, assigned, ["point_id"], ["neighborhood_id", "police_district_id"]
    )


@query(
    "label_mismatch",
    """SELECT p.point_id, p.neighborhood_label, n.name AS spatial_label
       FROM points p LEFT JOIN in_nb a USING (point_id) LEFT JOIN neighborhoods n ON n.id = a.nb
       WHERE lower(p.neighborhood_label) IS DISTINCT FROM lower(n.name)
          OR p.neighborhood_label IS NULL""",
)
def label_mismatch(t):
    rows = t.points.select("point_id", "neighborhood_label", "long", "lat")
    return spatial.label_mismatches(rows, t.neighborhoods, "neighborhood_label", "long", "lat").select(
        "point_id", "neighborhood_label", "spatial_label"
    )


@query(
    "bbox_filter",
    """SELECT point_id, long, lat FROM points
       WHERE long BETWEEN -122.517 AND -122.355 AND lat BETWEEN 37.704 AND 37.835""",
)
def bbox_filter(t):
    return t.points.where(geo.in_box(F.col("long"), F.col("lat"))).select("point_id", "long", "lat")


@query(
    "point_text",
    """SELECT point_id, CASE WHEN long IS NOT NULL AND lat IS NOT NULL
              THEN 'POINT(' || cast(long AS varchar) || ' ' || cast(lat AS varchar) || ')' END AS wkt FROM points""",
)
def point_text(t):
    point = F.struct(F.lit("Point").alias("type"), F.array("long", "lat").alias("coordinates"))
    return t.points.select("point_id", geo.geojson_point_wkt(point).alias("wkt"))


@query(
    "map_label_points",
    """SELECT c.id, c.lon, c.lat, coalesce(n.n_points, 0) AS n_points
       FROM (SELECT id, round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 4) AS lon,
                    round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 4) AS lat
             FROM nb_edges GROUP BY id) c
       LEFT JOIN (SELECT nb AS id, count(*) AS n_points FROM in_nb GROUP BY 1) n USING (id)""",
)
def map_label_points(t):
    labels = (
        spatial.polygon_edges(t.neighborhoods)
        .select("id", geo.centroid(F.col("edges")).alias("c"))
        .select("id", F.round("c.lon", 4).alias("lon"), F.round("c.lat", 4).alias("lat"))
    )
    located = spatial.assign_polygon(t.points, spatial.build_cover(t.neighborhoods), "long", "lat", "id")
    counts = located.where(F.col("id").isNotNull()).groupBy("id").agg(F.count("*").alias("n_points"))
    return labels.join(counts, "id", "left").na.fill(0, ["n_points"])
