"""Queries over tables of polygons made from the density cells."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as G
from .operators import arcs as A
from .operators import polygons as P
from .queries import PLANE, REGION, SEGMENT, XY, _plane, circles, num, query, samples
from .views import view

CORNERS = 12
#: A star of twelve corners around each cell, and in every third a square hole.
STARS = PLANE + f""", stars AS (SELECT id, {XY[0].replace('lng', 'lon_center')} AS x, {XY[1].replace('lat', 'lat_center')} AS y, 120e0 + id * 37 % 400 AS r FROM cells),
corners AS (SELECT id, k, x + CASE WHEN k % 2 = 0 THEN r ELSE 0.55e0 * r END * cos(k * {num(2 * math.pi / CORNERS)}) AS x, y + CASE WHEN k % 2 = 0 THEN r ELSE 0.55e0 * r END * sin(k * {num(2 * math.pi / CORNERS)}) AS y FROM stars, generate_series(0, {CORNERS - 1}) g(k)),
edges AS (SELECT a.id AS polygon, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corners a JOIN corners b ON a.id = b.id AND b.k = (a.k + 1) % {CORNERS}
 UNION ALL SELECT id, x + a * 0.2e0 * r, y + b * 0.2e0 * r, x + c * 0.2e0 * r, y + d * 0.2e0 * r FROM stars, (VALUES (-1, -1, -1, 1), (-1, 1, 1, 1), (1, 1, 1, -1), (1, -1, -1, -1)) v(a, b, c, d) WHERE id % 3 = 0)"""
JUDGED = STARS + f""", t AS (SELECT p.place_id, e.*, px AS x, py AS y FROM samples p JOIN stars s ON abs(px - s.x) <= s.r + 100 AND abs(py - s.y) <= s.r + 100 JOIN edges e ON e.polygon = s.id),
d AS (SELECT *, {SEGMENT} AS t FROM t),
judged AS (SELECT place_id, polygon, sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS inside,
 min((x - (x1 + t * (x2 - x1))) * (x - (x1 + t * (x2 - x1))) + (y - (y1 + t * (y2 - y1))) * (y - (y1 + t * (y2 - y1)))) AS d2 FROM d GROUP BY 1, 2)"""


def star_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(polygon, x1, y1, x2, y2) of the stars and their holes."""
    c = _plane(view(spark, sf_dir, "cells"), "s", "lat_center", "lon_center").select("id", F.col("sx").alias("x"), F.col("sy").alias("y"), (F.lit(120.0) + F.col("id") * 37 % 400).alias("r"))

    def corner(k):
        r = F.when(k % 2 == 0, F.col("r")).otherwise(0.55 * F.col("r"))
        return F.struct((F.col("x") + r * F.cos(k * F.lit(2 * math.pi / CORNERS))).alias("x"), (F.col("y") + r * F.sin(k * F.lit(2 * math.pi / CORNERS))).alias("y"))

    outer = F.transform(F.sequence(F.lit(0), F.lit(CORNERS - 1)), lambda k: F.struct(corner(k).alias("a"), corner((k + 1) % CORNERS).alias("b")))
    place = lambda a, b: F.struct((F.col("x") + a * 0.2 * F.col("r")).alias("x"), (F.col("y") + b * 0.2 * F.col("r")).alias("y"))
    turns = [(-1, -1), (-1, 1), (1, 1), (1, -1)]
    hole = F.array(*[F.struct(place(*a).alias("a"), place(*b).alias("b")) for a, b in zip(turns, [*turns[1:], turns[0]], strict=True)])
    e = c.select(F.col("id").alias("polygon"), F.explode(F.when(F.col("id") % 3 == 0, F.concat(outer, hole)).otherwise(outer)).alias("e"))
    return e.select("polygon", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


@query(JUDGED + " SELECT place_id, polygon FROM judged WHERE inside OR d2 <= 1e-12")
def places_in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place with all polygons that hold it."""
    return P.containing(samples(spark, sf_dir), star_edges(spark, sf_dir), "place_id", "px", "py")


@query(JUDGED + " SELECT place_id, polygon FROM judged WHERE inside OR d2 <= 625")
def places_near_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within 25 m of a polygon."""
    return P.containing(samples(spark, sf_dir), star_edges(spark, sf_dir), "place_id", "px", "py", 25.0)


TURN = num(2 * math.pi)
#: Areas by arcs, from c (circle, x, y, r) without repeats and edges (polygon, x1, y1, x2, y2).
ARCS = f"""near AS (SELECT a.circle, a.x, a.y, a.r, b.x AS ox, b.y AS oy, b.r AS o_r, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM c a JOIN c b ON a.circle <> b.circle),
half AS (SELECT *, acos(greatest(-1e0, least(1e0, (d * d + r * r - o_r * o_r) / (2 * greatest(d, 1e-300) * r)))) AS h, atan2(oy - y, ox - x) AS t FROM near WHERE d < r + o_r AND d > r - o_r),
lows AS (SELECT *, CASE WHEN t - h < 0 THEN t - h + {TURN} ELSE t - h END AS low FROM half),
hidden AS (SELECT circle, 0e0 AS lo, {TURN} AS hi FROM lows WHERE d <= o_r - r UNION ALL SELECT circle, low, least({TURN}, low + 2 * h) FROM lows WHERE d > o_r - r
 UNION ALL SELECT circle, 0e0, low + 2 * h - {TURN} FROM lows WHERE d > o_r - r AND low + 2 * h > {TURN} UNION ALL SELECT circle, {TURN}, {TURN} FROM c),
run AS (SELECT *, greatest(0e0, coalesce(max(hi) OVER (PARTITION BY circle ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0)) AS a FROM hidden),
arcs AS (SELECT c.*, run.a, run.lo AS b FROM run JOIN c USING (circle) WHERE lo > a)"""
SWEPT = "(r * r * (b - a) + x * r * (sin(b) - sin(a)) - y * r * (cos(b) - cos(a))) / 2"
UNCOVERED = f"""{ARCS}, e AS (SELECT row_number() OVER () AS edge, *, (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) AS l2 FROM edges),
lines AS (SELECT e.*, c.*, (x1 - x) * (x2 - x1) + (y1 - y) * (y2 - y1) AS p, (x1 - x) * (x1 - x) + (y1 - y) * (y1 - y) - r * r AS q FROM e, c WHERE abs(greatest(least(x1, x2), least(greatest(x1, x2), x)) - x) <= r AND abs(greatest(least(y1, y2), least(greatest(y1, y2), y)) - y) <= r),
met AS (SELECT *, (-p - sqrt(p * p - l2 * q)) / l2 AS t1, (-p + sqrt(p * p - l2 * q)) / l2 AS t2 FROM lines WHERE p * p - l2 * q > 0),
held AS (SELECT edge, greatest(0e0, t1) AS lo, least(1e0, t2) AS hi FROM met WHERE greatest(0e0, t1) < least(1e0, t2) UNION ALL SELECT edge, 1e0, 1e0 FROM e),
erun AS (SELECT *, greatest(0e0, coalesce(max(hi) OVER (PARTITION BY edge ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0)) AS a FROM held),
stretches AS (SELECT e.polygon, (x1 * y2 - x2 * y1) * (lo - a) / 2 AS part FROM erun JOIN e USING (edge) WHERE lo > a),
cuts AS (SELECT circle, atan2(y1 + t * (y2 - y1) - y, x1 + t * (x2 - x1) - x) AS w FROM (SELECT *, unnest([t1, t2]) AS t FROM met) WHERE t BETWEEN 0 AND 1),
events AS (SELECT circle, CASE WHEN w < 0 THEN w + {TURN} ELSE w END AS ang, 0 AS turn FROM cuts UNION ALL SELECT circle, a, 1 FROM arcs UNION ALL SELECT circle, b, -1 FROM arcs),
swept AS (SELECT circle, ang, sum(turn) OVER (PARTITION BY circle ORDER BY ang, turn ROWS UNBOUNDED PRECEDING) AS opened, lead(ang) OVER (PARTITION BY circle ORDER BY ang, turn) AS upto FROM events),
pieces AS (SELECT c.*, ang AS a, upto AS b, x + r * cos((ang + upto) / 2) AS mx, y + r * sin((ang + upto) / 2) AS my, row_number() OVER () AS piece FROM swept JOIN c USING (circle) WHERE opened > 0 AND upto > ang),
box AS (SELECT polygon, min(least(x1, x2)) AS bx1, max(greatest(x1, x2)) AS bx2, min(least(y1, y2)) AS by1, max(greatest(y1, y2)) AS by2 FROM e GROUP BY 1),
holding AS (SELECT p.piece, e.polygon FROM pieces p JOIN box b ON mx BETWEEN bx1 AND bx2 AND my BETWEEN by1 AND by2 JOIN e ON e.polygon = b.polygon
 GROUP BY 1, 2 HAVING sum(CASE WHEN (y1 > my) <> (y2 > my) AND mx < (x2 - x1) * (my - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1),
rims AS (SELECT w.polygon, -{SWEPT} AS part FROM holding w JOIN pieces USING (piece)),
bare AS (SELECT polygon, sum(part) AS uncovered FROM (SELECT * FROM stretches UNION ALL SELECT * FROM rims) GROUP BY 1),
whole AS (SELECT polygon, sum(x1 * y2 - x2 * y1) / 2 AS area FROM e GROUP BY 1)
SELECT polygon, round(area, 2) AS area_m2, abs(round(coalesce(uncovered, 0), 2)) AS uncovered_m2 FROM whole LEFT JOIN bare USING (polygon)"""


def _oriented_region() -> str:
    rows = []
    for p, polygon in enumerate(REGION):
        for k, ring in enumerate(polygon):
            own = G.edges([[ring]])
            turn = sum(x1 * y2 - x2 * y1 for x1, y1, x2, y2 in own)
            rows += [f"({p}, {', '.join(num(v) for v in (e if (turn > 0) == (k == 0) else (*e[2:], *e[:2])))})" for e in own]
    return "edges(polygon, x1, y1, x2, y2) AS (VALUES " + ", ".join(rows) + ")"


SHIFTED = PLANE + ", c AS (SELECT min(circle) AS circle, sx + 4000e0 AS x, sy + 3500e0 AS y, sr AS r FROM circles GROUP BY 2, 3, 4)"
PLAIN = STARS + ", c AS (SELECT min(circle) AS circle, sx AS x, sy AS y, sr * 0.4e0 AS r FROM circles GROUP BY 2, 3, 4)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("polygon", F.round("area", 2).alias("area_m2"), F.abs(F.round("uncovered", 2)).alias("uncovered_m2"))


@query(f"{SHIFTED}, {_oriented_region()}, {UNCOVERED}")
def union_disk_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the seeds' circles leave uncovered of the region's polygons."""
    c = circles(spark, sf_dir).select("circle", (F.col("sx") + 4000).alias("x"), (F.col("sy") + 3500).alias("y"), F.col("sr").alias("r"))
    return _rounded(A.uncovered(G.edge_table(spark, REGION), c))


@query(f"{PLAIN}, {UNCOVERED}")
def uncovered_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What smaller circles of the seeds leave uncovered of every star."""
    c = circles(spark, sf_dir).select("circle", F.col("sx").alias("x"), F.col("sy").alias("y"), (F.col("sr") * 0.4).alias("r"))
    return _rounded(A.uncovered(star_edges(spark, sf_dir), c))


@query(f"{SHIFTED}, {ARCS} SELECT round(sum({SWEPT}), 1) AS area_m2 FROM arcs")
def union_area_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area that the seeds' circles cover together."""
    c = circles(spark, sf_dir).select("circle", (F.col("sx") + 4000).alias("x"), (F.col("sy") + 3500).alias("y"), F.col("sr").alias("r"))
    return A.union_area(c).select(F.round("area", 1).alias("area_m2"))


@query(STARS + """, s AS (SELECT polygon, sum(x1 * y2 - x2 * y1) AS c, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS cx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS cy FROM edges GROUP BY 1)
SELECT polygon, round(c / 2, 3) AS area, round(cx / (3 * c), 3) + 0e0 AS centroid_x, round(cy / (3 * c), 3) + 0e0 AS centroid_y FROM s""")
def polygon_area_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = G.area_and_centroid(star_edges(spark, sf_dir), "polygon")
    return r.select("polygon", F.round("area", 3).alias("area"), (F.round("centroid_x", 3) + 0.0).alias("centroid_x"), (F.round("centroid_y", 3) + 0.0).alias("centroid_y"))
