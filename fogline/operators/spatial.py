"""Point-in-polygon joins through cells of several sizes.

A polygon is cut like a quadtree with eight by eight children: from cells of 64 times ``cell`` a cell is cut again only where more
than ``FEW_EDGES`` edges are near it, down to ``cell``. So the parts far from the border are few wide cells, and the size of a cover follows
the number of edges, not the resolution. A cell keeps the edges near it; edges farther east, which every ray from the cell meets when they
reach its height, shrink to the heights at which their number changes between even and odd. Two edges that share a vertex
cancel there, so a chain of far edges leaves its two ends at most, and a cell wholly inside a polygon keeps one bit.

A polygon's cells do not overlap, so a point lies in one of them at most, on one level. Cells of a level are unique: per level a point meets at most
one row, and the whole containment test runs inside it. No pairs are emitted, no regrouping of points follows, and with
the cover broadcast the points are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fogline.functions.geo import inside, ring_edges, wkt_rings
from fogline.operators.lookup import lookup_join, name_to_id
from fogline.session import cut_lineage

CELL_DEGREES = 0.005
UNLOCATED = 404
#: Part of a cell by which neighbourhoods of cells are widened.
SLACK = 1 / 64
#: Sizes of cells: the finest, and how many times wider each of the others is. Cells with few edges are not cut.
LEVELS, FACTOR, FEW_EDGES = 3, 8, 8
#: Cells times edges that are compared at a time.
COMPARED = 1 << 20

_HEADED = re.compile(r"\s*(MULTI)?POLYGON\s*\(\s*\(.*\)\s*\)\s*", re.I | re.S)
_RING = re.compile(r"\(([^()]+)\)")


@dataclass(frozen=True)
class Cover:
    """Cells of a polygon dimension; ``bytes`` is their measured size, None where nothing was measured."""

    cells: DataFrame
    cell: float
    bytes: int | None = None


def polygon_edges(polygons: DataFrame, wkt: str = "geometry", id_col: str = "id") -> DataFrame:
    """(id, geometry WKT) -> (id, edges); rows without a usable geometry are left out."""
    return (
        polygons.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), ring_edges(wkt_rings(F.col(wkt))).alias("edges"))
        .where(F.col("edges").isNotNull())
    )


def edges_of(wkt: str | None) -> np.ndarray | None:
    """Edges (x1, y1, x2, y2) of a polygon or multipolygon text; None on anything malformed, as ``wkt_rings`` has it."""
    if wkt is None or not _HEADED.fullmatch(wkt):
        return None
    edges = []
    for ring in _RING.findall(wkt):
        try:
            points = np.array([p.split()[:2] for p in ring.split(",")], dtype=np.float64)
        except ValueError:
            return None
        if points.ndim != 2 or points.shape[1] != 2 or len(points) < 4 or not np.isfinite(points).all() or (points[0] != points[-1]).any():
            return None
        edges.append(np.hstack([points[:-1], points[1:]]))
    return np.concatenate(edges) if edges else None


@dataclass(frozen=True)
class _Cell:
    level: int
    cx: int
    cy: int
    near: np.ndarray
    odd: bool
    turns: np.ndarray


def _cells_at(level: int, cell: float, cx: np.ndarray, cy: np.ndarray, above: _Cell) -> Iterator[_Cell]:
    """The cells with these numbers, from the edges, parity and turns of the cell they lie in; empty ones are left out."""
    size = cell * FACTOR**level
    # Some slack on every side, so rounding of cell numbers cannot drop an edge that counts.
    slack = size * SLACK
    x1, y1, x2, y2 = above.near.T
    step = max(1, COMPARED // max(1, len(above.near)))
    for at in range(0, len(cx), step):
        x, y = cx[at : at + step, None], cy[at : at + step, None]
        south, north = y * size - slack, (y + 1) * size + slack
        far = np.minimum(x1, x2) >= (x + 1) * size + slack
        near = ~far & (np.maximum(x1, x2) >= x * size - slack) & (np.maximum(y1, y2) >= south) & (np.minimum(y1, y2) <= north)
        over = (far & (y1 > north)).sum(axis=1) + (far & (y2 > north)).sum(axis=1) + (above.turns > north).sum(axis=1)
        first, second = far & (y1 >= south) & (y1 <= north), far & (y2 >= south) & (y2 <= north)
        kept = (above.turns >= south) & (above.turns <= north)
        for i in range(len(x)):
            heights = np.concatenate([above.turns[kept[i]], y1[first[i]], y2[second[i]]])
            values, times = np.unique(heights, return_counts=True) if len(heights) else (heights, heights)
            found = _Cell(level, int(x[i, 0]), int(y[i, 0]), above.near[near[i]], bool((above.odd + over[i]) % 2), values[times % 2 == 1])
            if len(found.near) or found.odd or len(found.turns):
                yield found


def cut_polygon(edges: np.ndarray, cell: float) -> Iterator[_Cell]:
    """The cells of a polygon, of different sizes, none inside another.

    No cell is larger than the polygon if a smaller size is at hand, so a point meets the polygons around it and not all of a city.
    """
    widest = cell * FACTOR ** (LEVELS - 1)
    index = lambda v: int(np.floor(v / widest))
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    cx, cy = np.meshgrid(np.arange(index(xs.min()), index(xs.max()) + 1), np.arange(index(ys.min()), index(ys.max()) + 1))
    extent = max(np.ptp(xs), np.ptp(ys))
    whole = _Cell(LEVELS, 0, 0, edges, False, np.zeros(0))
    todo = list(_cells_at(LEVELS - 1, cell, cx.ravel(), cy.ravel(), whole))
    child = np.arange(FACTOR)
    dx, dy = (d.ravel() for d in np.meshgrid(child, child))
    while todo:
        now = todo.pop()
        if now.level == 0 or (len(now.near) <= FEW_EDGES and cell * FACTOR**now.level <= extent):
            yield now
        else:
            todo += _cells_at(now.level - 1, cell, now.cx * FACTOR + dx, now.cy * FACTOR + dy, now)


_EDGE = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])


def _ragged(parts: list[np.ndarray], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32()), values)


def build_cells(polygons: DataFrame, wkt: str = "geometry", id_col: str = "id", cell: float = CELL_DEGREES) -> DataFrame:
    """(__level, __cx, __cy, __candidates): per cell and polygon the near edges, a parity and the heights where it turns.

    Rows without an id or a usable geometry are left out. Each polygon is cut in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column("wkt").to_pylist()):
                edges = edges_of(text)
                cells = [] if edges is None else list(cut_polygon(edges, cell))
                if not cells:
                    continue
                near, turns = [c.near for c in cells], [c.turns for c in cells]
                flat = np.concatenate(near)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c.level for c in cells], pa.int32()),
                        pa.array([c.cx for c in cells], pa.int64()),
                        pa.array([c.cy for c in cells], pa.int64()),
                        batch.column("id").take(pa.array([row] * len(cells))),
                        _ragged(near, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(4)], fields=list(_EDGE))),
                        pa.array([c.odd for c in cells], pa.bool_()),
                        _ragged(turns, pa.array(np.concatenate(turns))),
                    ],
                    ["__level", "__cx", "__cy", "id", "edges", "odd", "turns"],
                )

    named = polygons.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(wkt).cast("string").alias("wkt"))
    kind = dict(named.dtypes)["id"]
    cells = named.mapInArrow(
        run,
        f"__level int, __cx bigint, __cy bigint, id {kind}, edges array<struct<x1: double, y1: double, x2: double, y2: double>>, "
        "odd boolean, turns array<double>",
    )
    return cells.groupBy("__level", "__cx", "__cy").agg(
        F.collect_list(F.struct("id", "edges", "odd", "turns")).alias("__candidates")
    )


def _measured(cells: DataFrame, cell: float) -> Cover:
    n_edges = F.aggregate("__candidates", F.lit(0), lambda acc, c: acc + F.size(c["edges"]) + F.size(c["turns"]))
    size = cells.agg(F.count("*").alias("cells"), F.sum(n_edges).alias("edges")).first()
    return Cover(cells, cell, 64 * size["cells"] + 48 * (size["edges"] or 0))


def build_cover(polygons: DataFrame, wkt: str = "geometry", id_col: str = "id", cell: float = CELL_DEGREES) -> Cover:
    """Cells plus their measured size, which decides whether the cover may be broadcast.

    For a dimension that is used again: the polygons are parsed once, and every later join reads the same copy.
    """
    return _measured(cut_lineage(build_cells(polygons, wkt, id_col, cell)), cell)


def plain_cover(polygons: DataFrame, cell: float = CELL_DEGREES) -> Cover:
    """A cover for one join: no job runs, and Spark sizes it like any other frame."""
    return Cover(build_cells(polygons, cell=cell), cell)


def write_cover(polygons: DataFrame, path: str, wkt: str = "geometry", id_col: str = "id", cell: float = CELL_DEGREES) -> None:
    """The cover of a dimension as Parquet, to be written whenever the dimension is."""
    build_cells(polygons, wkt, id_col, cell).withColumn("__cell", F.lit(float(cell))).write.mode("overwrite").parquet(path)


def read_cover(spark: SparkSession, path: str) -> Cover:
    """A written cover, measured: one small job over its cells."""
    cells = spark.read.parquet(path)
    first = cells.select("__cell").first()
    return _measured(cells.drop("__cell"), CELL_DEGREES if first is None else first[0])


def assign_polygon(points: DataFrame, cover: Cover, lon: str, lat: str, out: str) -> DataFrame:
    """Left join: ``out`` is the smallest id of the polygons holding the point, else NULL."""
    turned = lambda c: F.size(F.filter(c["turns"], lambda y: y > F.col(lat))) % 2 == 1
    held = lambda c: (c["odd"] != turned(c)) != inside(c["edges"], F.col(lon), F.col(lat))
    found, hits = points, []
    for level in range(LEVELS):
        size = F.lit(cover.cell * FACTOR**level)
        cells = cover.cells.where(F.col("__level") == level).drop("__level")
        located = found.withColumns({"__cx": F.floor(F.col(lon) / size), "__cy": F.floor(F.col(lat) / size)})
        joined = lookup_join(located, cells, ["__cx", "__cy"], dim_bytes=cover.bytes)
        hits.append(f"__hit{level}")
        least = F.array_min(F.transform(F.filter("__candidates", held), lambda c: c["id"]))
        found = joined.withColumn(hits[-1], least).drop("__cx", "__cy", "__candidates")
    return found.withColumn(out, F.least(*hits)).drop(*hits)


def assign_boundaries(
    points: DataFrame,
    neighborhoods: DataFrame,
    districts: DataFrame,
    lon: str = "long",
    lat: str = "lat",
    neighborhood_label: str | None = None,
    district_label: str | None = None,
    unlocated: int | None = UNLOCATED,
    cell: float = CELL_DEGREES,
    name_rule: str = "normalised",
    covers: tuple[Cover, Cover] | None = None,
) -> DataFrame:
    """Add neighborhood_id and police_district_id.

    ``covers``: those of the neighborhoods and the districts where they are kept with the dimensions; else they are made here.

    Spatial match first, then the source's own label if one is named, then ``unlocated``
    (404 for 311 and rentals, None for police and stops). ``name_rule='source'`` compares
    neighborhood labels exactly and district labels after capitalising them.
    """
    out = points
    for place, dim, column, label, rule in (
        (1, districts, "police_district_id", district_label, "capitalised" if name_rule == "source" else name_rule),
        (0, neighborhoods, "neighborhood_id", neighborhood_label, "exact" if name_rule == "source" else name_rule),
    ):
        cover = covers[place] if covers else plain_cover(dim, cell)
        out = assign_polygon(out, cover, lon, lat, column)
        value: Column = F.col(column)
        if label is not None:
            out = name_to_id(out, dim, label, "__by_name", rule)
            value = F.coalesce(value, F.col("__by_name"))
        if unlocated is not None:
            value = F.coalesce(value, F.lit(unlocated))
        out = out.withColumn(column, value.cast("bigint")).drop("__by_name")
    return out


def label_mismatches(df: DataFrame, dim: DataFrame, label: str, lon: str, lat: str, cell: float = CELL_DEGREES) -> DataFrame:
    """Rows whose own label differs from the spatial one; NULL on either side differs too."""
    located = assign_polygon(df, plain_cover(dim, cell), lon, lat, "__id")
    names = dim.select(F.col("id").alias("__id"), F.col("name").alias("spatial_label"))
    named = lookup_join(located, names, ["__id"]).drop("__id")
    same = F.coalesce(F.lower(label) == F.lower("spatial_label"), F.lit(False))
    return named.where(~same)
