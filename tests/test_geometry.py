import math
import random

import pytest
from pyspark.sql import functions as F

from fogline.functions import geo
from fogline.operators import lookup, spatial

SQUARE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
HOLED = "POLYGON ((20 0, 30 0, 30 10, 20 10, 20 0), (22 2, 28 2, 28 8, 22 8, 22 2))"
MULTI = "MULTIPOLYGON (((40 0, 45 0, 45 5, 40 5, 40 0)), ((47 0, 49 0, 49 5, 47 5, 47 0), (47.5 1, 48.5 1, 48.5 4, 47.5 4, 47.5 1)))"
OVERLAP = "POLYGON ((5 5, 15 5, 15 15, 5 15, 5 5))"
DIM = [(1, "A", SQUARE), (2, "B", HOLED), (3, "C", MULTI), (4, "D", OVERLAP), (404, "Unknown", None), (5, "Bad", "POLYGON ((broken"), (6, "Open", "POLYGON ((0 0, 1 0, 1 1))")]


def rings(text):
    import re

    return [[tuple(map(float, p.split())) for p in r.split(",")] for r in re.findall(r"\(([^()]+)\)", text)]


def brute(x, y):
    for pid, _, text in DIM[:4]:
        odd = False
        for ring in rings(text):
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
        if odd:
            return pid
    return None


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(DIM, "id bigint, name string, geometry string")


@pytest.mark.parametrize("cell", [0.7, 3.0, 100.0])
def test_assignment_equals_brute_force(spark, dim, cell):
    rng = random.Random(1)
    pts = [(i, rng.uniform(-5, 55), rng.uniform(-5, 20)) for i in range(400)]
    # On edges, on vertices, in holes, outside, and unlocated.
    pts += [(500, 0.0, 5.0), (501, 10.0, 5.0), (502, 5.0, 0.0), (503, 5.0, 10.0), (504, 10.0, 10.0), (505, 25.0, 5.0), (506, 48.0, 2.0), (507, 7.0, 7.0), (508, None, 5.0), (509, 5.0, None)]
    points = spark.createDataFrame(pts, "i int, x double, y double")
    got = spatial.assign_polygon(points, spatial.build_cover(dim, cell=cell), "x", "y", "pid")
    want = {i: None if x is None or y is None else brute(x, y) for i, x, y in pts}
    assert {r["i"]: r["pid"] for r in got.collect()} == want
    assert want[507] == 1 and want[505] is None and want[506] is None


def test_salted_join_gives_the_same_rows_without_broadcast(spark, dim):
    rng = random.Random(2)
    points = spark.createDataFrame(
        [(i, *(rng.choice([(5.0, 5.0), (None, None), (25.0, 1.0)]) if i % 3 else (rng.uniform(0, 50), 3.0))) for i in range(300)],
        "i int, x double, y double",
    ).repartition(6)
    cover = spatial.build_cover(dim, cell=3.0)
    huge = spatial.Cover(cover.cells, cover.cell, 10**12)
    small = spatial.assign_polygon(points, cover, "x", "y", "pid")
    large = spatial.assign_polygon(points, huge, "x", "y", "pid")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    optimised = large._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in optimised and "__salt" in optimised
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


def test_points_are_not_shuffled_when_the_cover_is_small(spark, dim):
    points = spark.range(1000).select((F.col("id") / 20).alias("x"), (F.col("id") % 10).cast("double").alias("y"))
    cover = spatial.build_cover(dim, cell=3.0)
    out = spatial.assign_polygon(points, cover, "x", "y", "pid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    left_side = plan.split("BroadcastExchange")[0]
    assert "hashpartitioning" not in left_side and "NestedLoop" not in plan


def test_unlocated_policies_and_name_fallback(spark, dim):
    points = spark.createDataFrame(
        [(1, 5.0, 2.0, "b", "zzz"), (2, 99.0, 99.0, "a", "d"), (3, None, None, "c", None), (4, 99.0, 99.0, None, "nobody's")],
        "i int, long double, lat double, nb string, pd string",
    )
    labelled = spatial.assign_boundaries(points, dim, dim, neighborhood_label="nb", district_label="pd", cell=3.0)
    assert {r["i"]: (r["neighborhood_id"], r["police_district_id"]) for r in labelled.collect()} == {
        1: (1, 1), 2: (1, 4), 3: (3, 404), 4: (404, 404),
    }
    plain = spatial.assign_boundaries(points, dim, dim, unlocated=None, cell=3.0)
    assert {r["i"]: r["neighborhood_id"] for r in plain.collect()} == {1: 1, 2: None, 3: None, 4: None}


def test_source_name_rule_is_exact_for_neighborhoods_and_capitalised_for_districts(spark):
    empty = "id bigint, name string, geometry string"
    neighborhoods = spark.createDataFrame([(1, "St. Marys", None)], empty)
    districts = spark.createDataFrame([(2, "Southern", None)], empty)
    rows = spark.createDataFrame([("St. Marys", "SOUTHERN", None, None), ("st. marys", "southern", None, None)], "nb string, pd string, long double, lat double")
    got = spatial.assign_boundaries(rows, neighborhoods, districts, neighborhood_label="nb", district_label="pd", name_rule="source")
    assert {(r["nb"], r["neighborhood_id"], r["police_district_id"]) for r in got.collect()} == {("St. Marys", 1, 2), ("st. marys", 404, 2)}


def test_label_mismatch_counts_null_as_different(spark, dim):
    rows = spark.createDataFrame([("a", 5.0, 2.0), ("b", 5.0, 2.0), (None, 5.0, 2.0), ("a", 99.0, 99.0)], "label string, x double, y double")
    got = spatial.label_mismatches(rows, dim, "label", "x", "y", cell=3.0)
    assert {(r["label"], r["x"]) for r in got.collect()} == {("b", 5.0), (None, 5.0), ("a", 99.0)}


def test_lookup_join_salts_heavy_and_null_keys(spark):
    fact = spark.range(500).select(F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.when(F.col("id") % 2 == 0, F.lit("cold"))).alias("k"), "id").repartition(5)
    dim = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    want = sorted(map(tuple, fact.join(dim, ["k"], "left").collect()), key=repr)
    assert sorted(map(tuple, lookup.lookup_join(fact, dim, ["k"], dim_bytes=10**12).collect()), key=repr) == want
    assert sorted(map(tuple, lookup.lookup_join(fact, dim, ["k"]).collect()), key=repr) == want


def test_wkt_is_parsed_safely(spark, dim):
    sizes = {r["name"]: r["n"] for r in dim.select("name", F.size(geo.wkt_rings(F.col("geometry"))).alias("n")).collect()}
    assert {k: (None if v in (None, -1) else v) for k, v in sizes.items()} == {"A": 1, "B": 2, "C": 3, "D": 1, "Unknown": None, "Bad": None, "Open": None}


def test_geojson_groups_holes_with_their_part(spark, dim):
    import json

    parsed = dim.select("id", "geometry", geo.wkt_rings(F.col("geometry")).alias("r"))
    got = {r["id"]: json.loads(r["j"]) for r in parsed.where("r is not null").select("id", geo.rings_geojson(F.col("geometry"), F.col("r")).alias("j")).collect()}
    assert got[2]["type"] == "Polygon" and [len(r) for r in got[2]["coordinates"]] == [5, 5]
    assert got[3]["type"] == "MultiPolygon" and [len(p) for p in got[3]["coordinates"]] == [1, 2]
    assert got[1]["coordinates"][0][1] == [10.0, 0.0]


def test_centroid_of_square_and_holed_polygon(spark, dim):
    got = {r["id"]: r["c"] for r in spatial.polygon_edges(dim).select("id", geo.centroid(F.col("edges")).alias("c")).collect()}
    assert (got[1]["lon"], got[1]["lat"]) == (5.0, 5.0)
    assert math.isclose(got[4]["lon"], 10.0) and math.isclose(got[4]["lat"], 10.0)


def test_points_as_text(spark):
    df = spark.createDataFrame(
        [("Point", [1.5, 2.5]), ("Point", [1.5]), ("Line", [1.5, 2.5]), (None, None), ("Point", [None, 2.0])],
        "type string, coordinates array<double>",
    )
    got = [r[0] for r in df.select(geo.geojson_point_wkt(F.struct("type", "coordinates"))).collect()]
    assert got == ["POINT(1.5 2.5)", None, None, None, None]
    coords = spark.createDataFrame([(-122.4, 37.7), (-222.4, 37.7), (None, 1.0), (-122.355, 37.835), (-122.3549, 37.8)], "x double, y double")
    assert [r[0] for r in coords.select(geo.valid_point_wkt(F.col("x"), F.col("y"))).collect()] == ["POINT(-122.4 37.7)", None, None, "POINT(-122.355 37.835)", "POINT(-122.3549 37.8)"]
    assert [r[0] for r in coords.select(geo.in_box(F.col("x"), F.col("y"))).collect()] == [False, False, False, True, False]


def test_unmatched_labels_and_geocodes(spark, dim):
    rows = spark.createDataFrame([("A",), ("a",), ("q",), ("Q",), (None,)], "label string")
    assert [tuple(r) for r in lookup.unmatched_labels(rows, "label", dim).collect()] == [("q", 2)]
    places = spark.createDataFrame([("x", None, None), ("y", 1.0, 2.0), ("z", None, None)], "address string, long double, lat double")
    codes = spark.createDataFrame([("x", 7.0, 8.0), ("y", 9.0, 9.0), ("z", None, 3.0)], "address string, lon double, lat double")
    got = lookup.geocode_lookup(places, codes, "address", F.col("long").isNull(), "long", "lat")
    assert {tuple(r) for r in got.collect()} == {("x", 7.0, 8.0), ("y", 1.0, 2.0), ("z", None, None)}


def test_texts_that_compress_well_are_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(200).selectExpr("id AS k", "repeat('x', 200000) AS v").write.parquet(path)
    dim = spark.read.parquet(path)
    assert lookup.measured_bytes(dim) > 40_000_000 > lookup.BROADCAST_LIMIT
    joined = lookup.lookup_join(spark.range(5).selectExpr("id AS k"), dim, ["k"], dim_bytes=lookup.measured_bytes(dim))
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 5


def test_lookups_keep_to_the_rows_of_the_fact(spark):
    fact, dim = spark.range(3).selectExpr("id AS k"), spark.range(2).selectExpr("id AS k", "id AS v")
    for how in ("right", "full_outer", "cross"):
        with pytest.raises(ValueError):
            lookup.lookup_join(fact, dim, ["k"], how=how)


def test_rings_that_are_none_give_no_geometry(spark):
    from fogline.functions.geo import geojson_rings, ring_edges

    shapes = [("Polygon", "[[[1, 2]]]"), ("Polygon", "[[]]"), ("Polygon", "[]"), ("Polygon", "[[[0],[1,0],[1,1],[0]]]"), ("Polygon", "[[[0,0],[1,0],[1,1],[0,0]]]"), ("Point", "[1,2]")]
    df = spark.createDataFrame([(s,) for s in shapes], "g struct<type:string,coordinates:string>")
    got = [r[0] for r in df.select(F.size(ring_edges(geojson_rings(F.col("g"))))).collect()]
    assert got == [None, None, None, None, 3, None]


def test_cover_of_a_polygon_with_many_edges_is_small(spark):
    import time

    ring = [(0.05 + 0.05 * math.cos(a), 0.04 + (0.04 + 0.001 * math.sin(40 * a)) * math.sin(a)) for a in (2 * math.pi * i / 4000 for i in range(4000))]
    text = "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))"
    dim = spark.createDataFrame([(1, "round", text)], "id bigint, name string, geometry string")
    spatial.build_cover(dim, cell=0.02)
    began = time.time()
    cover = spatial.build_cover(dim, cell=0.005)
    assert time.time() - began < 30 and cover.bytes < 1_000_000
    rng = random.Random(3)
    points = [(i, rng.uniform(-0.01, 0.11), rng.uniform(-0.01, 0.09)) for i in range(300)] + [(300 + i, *ring[i * 40]) for i in range(100)]
    got = spatial.assign_polygon(spark.createDataFrame(points, "i int, x double, y double"), cover, "x", "y", "pid").collect()

    def holds(x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    assert {r["i"]: r["pid"] == 1 for r in got} == {i: holds(x, y) for i, x, y in points}


def test_building_an_assignment_starts_no_job(spark, dim):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    try:
        points = spark.range(3).select(F.col("id").cast("double").alias("long"), F.lit(1.0).alias("lat"))
        spatial.assign_boundaries(points, dim, dim, cell=3.0)
        assert len(tracker.getJobIdsForGroup("building")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_edges_are_parsed_as_in_spark(spark):
    import numpy as np

    texts = [t for _, _, t in DIM] + [
        " polygon((0 0,1 0 ,1 1, 0 0)) ", "POLYGON ((0 0, 1 0, 1 1, 0 0), (x 1, 2 2, 3 3, x 1))", "POLYGON ((0 0 9, 1e1 0 9, 1 -1.5 9, 0 0 9))",
        "POLYGON EMPTY", "", "POINT (1 2)", "POLYGON ((0 0, 1 0, 1 1, 0 1))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)),((5 5, 6 5, 6 6, 5 5)))",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, geometry string")
    known = {r["id"]: [tuple(e) for e in r["edges"]] for r in spatial.polygon_edges(df).collect()}
    for i, text in enumerate(texts):
        edges = spatial.edges_of(text)
        assert (None if edges is None else [tuple(e) for e in edges.tolist()]) == known.get(i), text
    assert spatial.edges_of(None) is None and np.asarray(spatial.edges_of(SQUARE)).shape == (4, 4)


def test_cells_are_cut_only_where_edges_are():
    import numpy as np

    rng = np.random.default_rng(3)
    angle = np.sort(rng.uniform(0, 2 * np.pi, 4000))
    ring = np.column_stack([np.cos(angle) * (1 + 0.2 * np.sin(9 * angle)), np.sin(angle)])
    edges = np.hstack([ring, np.roll(ring, -1, axis=0)])
    count, kept = {}, {}
    for cell in (0.02, 0.005, 0.001):
        cells = list(spatial.cut_polygon(edges, cell))
        count[cell] = len(cells)
        kept[cell] = sum(len(c.near) + len(c.turns) for c in cells)
        places = {(c.level, c.cx, c.cy) for c in cells}
        assert len(places) == len(cells)
        # No cell lies inside another one.
        assert not any((up, x // 8 ** (up - level), y // 8 ** (up - level)) in places for level, x, y in places for up in range(level + 1, spatial.LEVELS))
        assert all(c.level == 0 or len(c.near) <= spatial.FEW_EDGES for c in cells)
    assert 64 * max(count.values()) + 48 * max(kept.values()) < 4_000_000
    # A resolution twenty times finer does not give four hundred times the cells.
    assert count[0.001] < 8 * count[0.02]


def test_points_in_a_star_of_many_edges(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    angle = np.linspace(0, 2 * np.pi, 401)[:-1]
    radius = 1 + 0.5 * np.sin(23 * angle)
    ring = [(float(r * np.cos(a)), float(r * np.sin(a))) for r, a in zip(radius, angle)]
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + "))"
    dim = spark.createDataFrame([(3, "star", text), (7, "box", "POLYGON ((-2 -2, 2 -2, 2 2, -2 2, -2 -2))")], "id bigint, name string, geometry string")
    points = [(i, *map(float, rng.uniform(-2.2, 2.2, 2))) for i in range(500)] + [(1000 + i, x, y) for i, (x, y) in enumerate(ring[:40])]

    def inside(x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    want = {i: 3 if inside(x, y) else 7 if -2 <= x < 2 and -2 <= y < 2 else None for i, x, y in points}
    df = spark.createDataFrame(points, "i int, x double, y double")
    for cell in (0.003, 0.05, 1.0):
        got = spatial.assign_polygon(df, spatial.build_cover(dim, cell=cell), "x", "y", "pid")
        assert {r["i"]: r["pid"] for r in got.collect()} == want


def test_covers_are_kept_with_their_dimensions(spark, dim, tmp_path):
    points = spark.createDataFrame([(1, 5.0, 2.0), (2, 99.0, 99.0), (3, 7.0, 7.0), (4, None, 1.0)], "i int, long double, lat double")
    spatial.write_cover(dim, str(tmp_path / "cover"), cell=0.5)
    cover = spatial.read_cover(spark, str(tmp_path / "cover"))
    assert cover.cell == 0.5 and cover.bytes == spatial.build_cover(dim, cell=0.5).bytes
    kept = spatial.assign_boundaries(points, dim, dim, covers=(cover, cover))
    made = spatial.assign_boundaries(points, dim, dim, cell=0.5)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, made.collect()))
    spatial.write_cover(dim.limit(0), str(tmp_path / "none"))
    none = spatial.assign_polygon(points, spatial.read_cover(spark, str(tmp_path / "none")), "long", "lat", "pid")
    assert none.where("pid IS NOT NULL").count() == 0


def test_a_small_polygon_shares_its_cells_with_its_neighbours_only(spark):
    squares = [(i, -122.5 + 0.0115 * (i % 12), 37.70 + 0.0115 * (i // 12)) for i in range(144)]
    wkt = lambda x, y: f"POLYGON (({x} {y}, {x + 0.0115} {y}, {x + 0.0115} {y + 0.0115}, {x} {y + 0.0115}, {x} {y}))"
    frame = spark.createDataFrame([(i, wkt(x, y)) for i, x, y in squares], "id bigint, geometry string")
    cells = spatial.build_cells(frame).selectExpr("size(__candidates) AS n").collect()
    assert max(r["n"] for r in cells) <= 9 and len(cells) < 144 * 16  # 144 in one cell before
    points = spark.createDataFrame([(i, x + 0.004, y + 0.007) for i, x, y in squares], "i bigint, long double, lat double")
    found = spatial.assign_polygon(points, spatial.plain_cover(frame), "long", "lat", "at").collect()
    assert all(r["at"] == r["i"] for r in found)
