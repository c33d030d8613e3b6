"""Polygons as edges: boundary-inclusive containment, buffers, area, centroid, disks.

A region is a list of polygons, a polygon a list of rings (holes after the outer
ring), a ring a list of (x, y), closed or not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]
Region = list[list[Ring]]
ON_EDGE = 1e-12


def edges(region: Region) -> list[tuple[float, float, float, float]]:
    out = []
    for polygon in region:
        for ring in polygon:
            points = ring if ring[0] == ring[-1] else [*ring, ring[0]]
            out += [(*map(float, a), *map(float, b)) for a, b in zip(points, points[1:], strict=False) if a != b]
    return out


def bounds(region: Region) -> tuple[float, float, float, float]:
    points = [p for polygon in region for ring in polygon for p in ring]
    return min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points)


def edge_array(region: Region) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(e, ("x1", "y1", "x2", "y2"), strict=True)]) for e in edges(region)])


def edge_table(spark: SparkSession, region: Region) -> DataFrame:
    """One row for each edge with its ring; outer rings run against the clock, holes with it, so that sums come out right."""
    rows = []
    for p, polygon in enumerate(region):
        for r, ring in enumerate(polygon):
            own = edges([[ring]])
            turn = sum(x1 * y2 - x2 * y1 for x1, y1, x2, y2 in own)
            if (turn < 0) != (r > 0):
                own = [(x2, y2, x1, y1) for x1, y1, x2, y2 in reversed(own)]
            rows += [(p, r, k, *e) for k, e in enumerate(own)]
    return spark.createDataFrame(rows, "polygon int, ring int, k int, x1 double, y1 double, x2 double, y2 double")


def covers(x: Column, y: Column, own: Column) -> Column:
    """Even-odd rule; places on an edge count."""
    return inside(x, y, own) | (segment_distance2(x, y, own) <= ON_EDGE)


def inside(x: Column, y: Column, own: Column) -> Column:
    """Even-odd rule with half-open spans: of two regions that share an edge, one has the places on it."""
    crossed = F.size(F.filter(own, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])))
    return crossed % 2 == 1


def segment_distance2(x: Column, y: Column, own: Column) -> Column:
    """Squared distance to the nearest edge."""

    def one(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / (dx * dx + dy * dy)))
        qx, qy = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
        return qx * qx + qy * qy

    return F.array_min(F.transform(own, one))


def buffer_covers(x: Column, y: Column, own: Column, r: Column | float) -> Column:
    """Inside, or at most ``r`` from an edge (an exact buffer, not a polygon inscribed in it)."""
    r = F.lit(r) if isinstance(r, (int, float)) else r
    return covers(x, y, own) | (segment_distance2(x, y, own) <= r * r)


def in_box(x: Column, y: Column, box: tuple[float, float, float, float], margin: float = 0.0) -> Column:
    """The cheap test before the exact one; reaches the scan."""
    return x.between(box[0] - margin, box[2] + margin) & y.between(box[1] - margin, box[3] + margin)


def area_and_centroid(table: DataFrame, *keys: str) -> DataFrame:
    """Shoelace sums over an edge table, one row for each of the keys; holes count against."""
    c = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    s = table.groupBy(*keys).agg(F.sum(c).alias("c"), F.sum((F.col("x1") + F.col("x2")) * c).alias("cx"), F.sum((F.col("y1") + F.col("y2")) * c).alias("cy"))
    return s.select(*keys, (F.col("c") / 2).alias("area"), (F.col("cx") / (3 * F.col("c"))).alias("centroid_x"), (F.col("cy") / (3 * F.col("c"))).alias("centroid_y"))


def disk(x: float, y: float, r: float, per_quarter: int = 64) -> Ring:
    """The polygon inscribed in a circle."""
    n = 4 * per_quarter
    return [(x + r * math.cos(2 * math.pi * k / n), y - r * math.sin(2 * math.pi * k / n)) for k in range(n)]


def disk_points(x: Column, y: Column, r: Column, per_quarter: int = 64) -> Column:
    """The same polygon as an array of structs (x, y), for circles in rows."""
    n = 4 * per_quarter
    turn = lambda k: k * (2 * math.pi / n)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct((x + r * F.cos(turn(k))).alias("x"), (y - r * F.sin(turn(k))).alias("y")))
