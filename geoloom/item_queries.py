"""Queries over single rules: validity, ids, texts, boxes, zones, disks, lattices, best rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dynamic as D
from .functions import geometry as G
from .functions import scalars as S
from .functions import text as T
from .operators import aggregates as A
from .operators import generators as E
from .operators import joins as J
from .operators import overlay as O
from .operators import validity as V
from .operators import windows as W
from .queries import D2, PLANE, SQL, XY, _near_node, circles, num, query, samples
from .session import cut
from .sources.tables import coordinate_box
from .views import LAT0, LNG0, WITH, table, view


@query(f"""{WITH}, bad AS (SELECT input_index, CASE WHEN input_index % 13 = 0 THEN 90.0001e0 WHEN input_index % 17 = 0 THEN CAST('nan' AS DOUBLE) ELSE lat END AS lat, CASE WHEN input_index % 19 = 0 THEN NULL ELSE lng END AS lng,
 CASE WHEN input_index % 11 = 0 THEN CAST('nan' AS DOUBLE) WHEN input_index % 23 = 0 THEN 0e0 WHEN input_index % 5 = 0 THEN 60000e0 ELSE CAST(radius AS DOUBLE) END AS radius, CASE WHEN input_index % 7 = 0 THEN NULL ELSE collected END AS collected FROM seeds)
SELECT input_index, radius FROM bad WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND radius > 0 AND NOT isnan(radius) AND NOT isnan(lat) AND collected IS NOT NULL""")
def circle_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid circles: any positive radius, ``collected`` given."""
    i = F.col("input_index")
    bad = view(spark, sf_dir, "seeds").select(
        i, F.when(i % 13 == 0, 90.0001).when(i % 17 == 0, float("nan")).otherwise(F.col("lat")).alias("lat"), F.when(i % 19 == 0, None).otherwise(F.col("lng")).alias("lng"),
        F.when(i % 11 == 0, float("nan")).when(i % 23 == 0, 0.0).when(i % 5 == 0, 60000.0).otherwise(F.col("radius").cast("double")).alias("radius"), F.when(i % 7 == 0, None).otherwise(F.col("collected")).alias("collected"),
    )
    return bad.where(V.circle_valid(F.col("lat"), F.col("lng"), F.col("radius"), F.col("collected"))).select("input_index", "radius")


@query(f"""{WITH}, bad AS (SELECT id, CASE WHEN id % 7 = 0 THEN CAST('nan' AS DOUBLE) WHEN id % 11 = 0 THEN CAST('inf' AS DOUBLE) WHEN id % 13 = 0 THEN -density - 1 WHEN id % 17 = 0 THEN NULL ELSE density END AS density,
 CASE WHEN id % 19 = 0 THEN -90.5e0 ELSE lat_center END AS lat, lon_center AS lng FROM cells)
SELECT CAST(count(*) AS BIGINT) AS n, round(sum(density), 3) AS total FROM bad WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND NOT isnan(density) AND NOT isinf(density) AND density >= 0""")
def density_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    density = F.when(i % 7 == 0, float("nan")).when(i % 11 == 0, float("inf")).when(i % 13 == 0, -F.col("density") - 1).when(i % 17 == 0, None).otherwise(F.col("density"))
    bad = view(spark, sf_dir, "cells").select(density.alias("density"), F.when(i % 19 == 0, -90.5).otherwise(F.col("lat_center")).alias("lat"), F.col("lon_center").alias("lng"))
    return bad.where(V.density_valid(F.col("lat"), F.col("lng"), F.col("density"))).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("density"), 3).alias("total"))


@query("SELECT c_custkey, url_encode(c_name || ' a/b~*+-_.é' || c_mktsegment) AS encoded FROM customer")
def percent_encoded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", T.percent_encode(F.concat("c_name", F.lit(" a/b~*+-_.é"), "c_mktsegment")).alias("encoded"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE c_name END AS place_id FROM customer""")
def normalised_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, blanks, nulls and objects are no ids; texts are stripped."""
    k = F.col("c_custkey")
    quoted = F.concat(F.lit('"'), "c_name", F.lit('"'))
    doc = F.when(k % 6 == 0, k.cast("string")).when(k % 6 == 1, F.lit('" \\t"')).when(k % 6 == 2, F.lit("null")).when(k % 6 == 3, F.concat(F.lit('{"id": '), quoted, F.lit("}"))).when(k % 6 == 4, quoted).otherwise(F.concat(F.lit('" '), "c_name", F.lit('\\n "')))
    return table(spark, sf_dir, "customer").select(k, D.place_id(F.try_parse_json(doc)).alias("place_id"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN 'own ' || o_orderstatus WHEN 2 THEN '' ELSE o_orderpriority END AS text FROM orders")
def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text, or the original one where it is missing or blank."""
    k = F.col("o_orderkey") % 4
    own, original = F.concat(F.lit('"text": {"text": " own '), "o_orderstatus", F.lit('"}')), F.concat(F.lit('"originalText": {"text": "'), "o_orderpriority", F.lit('"}'))
    blank = F.lit('"text": {"text": "  "}')
    doc = F.when(k == 0, F.concat_ws(", ", blank, original)).when(k == 1, F.concat_ws(", ", own, original)).when(k == 2, blank).otherwise(original)
    return table(spark, sf_dir, "orders").select("o_orderkey", D.review_text(F.try_parse_json(F.concat(F.lit("{"), doc, F.lit("}")))).alias("text"))


@query(f"""{WITH} SELECT input_index, CASE WHEN input_index % 10 <> 0 THEN lng END AS min_lng, CASE WHEN input_index % 10 <> 0 THEN lat - 0.5e0 END AS min_lat, CASE WHEN input_index % 10 <> 0 THEN lng + 0.25e0 END AS max_lng, CASE WHEN input_index % 10 <> 0 THEN lat END AS max_lat FROM seeds""")
def coordinate_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of nested coordinates of any depth; places out of range and those of three numbers don't count."""
    pair = lambda x, y: F.array(x, y)
    lat, lng, out = F.col("lat"), F.col("lng"), F.array(F.lit(180.5), F.col("lat"))
    ring = F.array(pair(lng, lat), pair(lng + 0.25, lat - 0.5), out, F.array(lng, F.lit(91.0)), F.array(lng - 1, lat, F.lit(5.0)))
    none = F.array(out, F.array(lng, lat, F.lit(1.0)))
    shape = F.when(F.col("input_index") % 10 == 0, F.to_json(F.array(none))).when(F.col("input_index") % 2 == 0, F.to_json(F.array(F.array(ring), F.array(none)))).otherwise(F.to_json(F.array(ring)))
    return view(spark, sf_dir, "seeds").select("input_index", coordinate_box(shape).alias("b")).select("input_index", *[F.col(f"b.{c}").alias(c) for c in ("min_lng", "min_lat", "max_lng", "max_lat")])


@query(f"""{WITH} SELECT input_index, CAST(s AS INT) AS spacing, CAST((s - 600) / 25 + 1 AS BIGINT) AS place FROM (SELECT input_index, least(3000, greatest(600, round_even(sqrt(3e0) * radius / 25, 0) * 25)) AS s FROM seeds)""")
def hex_spacings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapped spacing of each seed's radius, and its place in the range of all spacings."""
    rows = view(spark, sf_dir, "seeds").select("input_index", S.hex_spacing_of(F.col("radius"), 600, 3000, 25).alias("spacing"))
    return rows.withColumn("place", F.array_position(S.spacing_range(600, 3000, 25), F.col("spacing")).cast("long"))


@query(f"{WITH} SELECT place_id, round({XY[0]}, 3) + 0e0 AS x, round({XY[1]}, 3) + 0e0 AS y, round(lat, 8) AS lat, round(lng, 8) AS lng FROM places")
def plane_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = S.project(F.col("lat"), F.col("lng"), LAT0, LNG0)
    lat, lng = S.unproject(F.col("x"), F.col("y"), LAT0, LNG0)
    return view(spark, sf_dir, "places").select("place_id", x.alias("x"), y.alias("y")).select("place_id", (F.round("x", 3) + 0.0).alias("x"), (F.round("y", 3) + 0.0).alias("y"), F.round(lat, 8).alias("lat"), F.round(lng, 8).alias("lng"))


@query(PLANE + f" SELECT circle, CAST(256 AS INT) AS n_points, round(128 * sr * sr * sin({num(2 * math.pi / 256)}), 2) AS area, round(sx - sr, 3) AS min_x, round(sy + sr, 3) AS max_y FROM circles")
def disk_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disks as polygons of 256 points, with the clock: their area and extent."""
    p = F.col("p")
    c = circles(spark, sf_dir).withColumn("p", G.disk_points(F.lit(0.0), F.lit(0.0), F.col("sr")))
    after = F.concat(F.slice(p, 2, 255), F.slice(p, 1, 1))
    area = F.aggregate(F.zip_with(p, after, lambda a, b: b["x"] * a["y"] - a["x"] * b["y"]), F.lit(0.0), lambda t, v: t + v) / 2
    return c.select("circle", F.size("p").alias("n_points"), F.round(area, 2).alias("area"), F.round(F.col("sx") + F.array_min(F.transform(p, lambda q: q["x"])), 3).alias("min_x"), F.round(F.col("sy") + F.array_max(F.transform(p, lambda q: q["y"])), 3).alias("max_y"))


#: Rectangles (west, south, east, north) whose edges no place lies on, and the anchor of the supplement.
CITY, HILL, DISTRICT = (98.90005, 18.76005, 98.99005, 18.83005), (98.86005, 18.78005, 98.91005, 18.81005), (98.95005, 18.75005, 99.03005, 18.80005)
ANCHOR, WEST = (99.02, 18.77), 98.96005


def _in(r: tuple[float, float, float, float]) -> str:
    return f"(lng BETWEEN {num(r[0])} AND {num(r[2])} AND lat BETWEEN {num(r[1])} AND {num(r[3])})"


_EXTRA = f"({_in(DISTRICT)} AND NOT {_in(CITY)} AND NOT {_in(HILL)})"


@query(f"""{WITH} SELECT place_id, {_EXTRA} AS in_supplement, {_in(CITY)} OR {_in(HILL)} OR {_EXTRA} AS in_border, {_in(CITY)} OR ({_EXTRA} AND lng > {num(WEST)}) AS in_small, lng <= {num(WEST)} AS west FROM places""")
def zone_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in the supplement around an anchor, in the merged border, in the zone of small circles, and west of a meridian."""
    layers = [(0, k, *map(float, e)) for k, (w, so, ea, n) in enumerate((CITY, HILL, DISTRICT)) for e in ((w, so, ea, so), (ea, so, ea, n), (ea, n, w, n), (w, n, w, so))]
    cells = cut(O.cells(spark.createDataFrame(layers, "zone int, layer int, x1 double, y1 double, x2 double, y2 double")))
    # the supplement: what the district has besides city and hill, of that the part with the anchor
    extra = O.anchored(O.parts(cells.where("mask = 4")), *ANCHOR)
    chosen = cut(cells.where("mask & 3 <> 0").unionByName(extra.select(*cells.columns)).withColumn("cell", F.monotonically_increasing_id()))
    p = view(spark, sf_dir, "places").select("place_id", "lng", "lat")
    in_any = O.holding(p, chosen, "place_id", "lng", "lat").groupBy("place_id").agg(F.bool_or(F.expr("mask = 4")).alias("e"), F.bool_or(F.expr("mask & 1 <> 0")).alias("c"))
    west = F.col("lng") <= WEST
    found = p.join(in_any, "place_id", "left")
    e, c = F.coalesce("e", F.lit(False)), F.coalesce("c", F.lit(False))
    return found.select("place_id", e.alias("in_supplement"), F.col("e").isNotNull().alias("in_border"), (c | (e & ~west)).alias("in_small"), west.alias("west"))


@query(PLANE + """, r AS (SELECT circle AS zone, l, sx + a * sr AS w, sx + b * sr AS e, sy + c * sr AS s, sy + d * sr AS n FROM circles, (VALUES (0, -1, 1, -1, 1), (1, 0.25, 1.5, -0.5, 1.75), (2, -0.5, 0.5, -1.25, 1.25)) v(l, a, b, c, d)),
xs AS (SELECT zone, x AS x0, lead(x) OVER (PARTITION BY zone ORDER BY x) AS x1 FROM (SELECT zone, w AS x FROM r UNION SELECT zone, e FROM r)), ys AS (SELECT zone, y AS y0, lead(y) OVER (PARTITION BY zone ORDER BY y) AS y1 FROM (SELECT zone, s AS y FROM r UNION SELECT zone, n FROM r)),
k AS (SELECT xs.zone, x0, y0, any_value((x1 - x0) * (y1 - y0)) AS area, sum(1 << l) AS mask FROM xs JOIN ys USING (zone) JOIN r ON r.zone = xs.zone AND w <= x0 AND x1 <= e AND s <= y0 AND y1 <= n GROUP BY 1, 2, 3)
SELECT zone, CAST(mask AS BIGINT) AS mask, round(sum(area), 4) AS area FROM k GROUP BY 1, 2""")
def zone_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping rectangles around each seed: the area of every combination of them."""
    box = F.array(*[F.struct(F.lit(k).alias("l"), *[F.lit(float(v)).alias(n) for n, v in zip("abcd", b, strict=True)]) for k, b in enumerate(((-1, 1, -1, 1), (0.25, 1.5, -0.5, 1.75), (-0.5, 0.5, -1.25, 1.25)))])
    r = circles(spark, sf_dir).select("circle", "sx", "sy", "sr", F.explode(box).alias("v")).selectExpr("circle AS zone", "v.l AS layer", "sx + v.a * sr AS w", "sx + v.b * sr AS e", "sy + v.c * sr AS s", "sy + v.d * sr AS n")
    sides = r.selectExpr("zone", "layer", "stack(4, w, s, e, s, e, s, e, n, e, n, w, n, w, n, w, s) AS (x1, y1, x2, y2)")
    return O.cells(sides).groupBy("zone", "mask").agg(F.round(F.sum(O.area()), 4).alias("area"))


@query(f"{WITH} SELECT input_index, input_index % 4 IN (0, 1) AS near, input_index % 4 <> 3 AS finite FROM seeds")
def close_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("input_index") % 4
    a = F.col("radius").cast("double")
    b = F.when(k == 0, a).when(k == 1, a * (1 + 5e-10)).when(k == 2, a * (1 + 5e-9)).otherwise(float("inf"))
    return view(spark, sf_dir, "seeds").select("input_index", F.when(S.is_finite(b), S.is_close(a, b)).otherwise(False).alias("near"), S.is_finite(b).alias("finite"))


@query(PLANE + """, k AS (SELECT round(floor(px / 500) * 500 + place % 3 * 0.0001e0, 3) AS kx, round(floor(py / 500) * 500 - place % 3 * 0.0001e0, 3) AS ky, place FROM (SELECT px, py, p.k AS place FROM samples JOIN places p USING (place_id)))
SELECT kx + 0e0 AS kx, ky + 0e0 AS ky, min(place) AS first_place, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY ALL""")
def seen_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places that coincide to a millimetre: the first of each, and how many there are."""
    s = samples(spark, sf_dir).join(view(spark, sf_dir, "places").select("place_id", F.col("k").alias("first_place")), "place_id")
    x, y = F.floor(F.col("px") / 500) * 500 + F.col("first_place") % 3 * 0.0001, F.floor(F.col("py") / 500) * 500 - F.col("first_place") % 3 * 0.0001
    keyed = s.select("first_place", S.metre_key(x, y).alias("key"))
    first = W.first_seen(keyed, ["key"], ["first_place"])
    n = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return first.join(n, "key").select((F.col("key.kx") + 0.0).alias("kx"), (F.col("key.ky") + 0.0).alias("ky"), "first_place", "n")


@query(f"{WITH} SELECT input_index, radius FROM seeds ORDER BY radius % 7, collected, radius // 100 DESC, input_index LIMIT 1")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row by several keys, the order of testing last."""
    r = F.col("radius")
    return A.best(view(spark, sf_dir, "seeds"), r % 7, F.col("collected"), F.floor(r / 100).desc(), F.col("input_index")).select("input_index", "radius")


_BAND_BOX, _PHASE, _SCALE = (0.0, 0.0, 9000.0, 7000.0), (0.25, 0.5), 0.94


@query(f"""{WITH}, bands AS (SELECT radius AS band_high, {num(E.ROOT3)} * CAST(radius AS DOUBLE) * {num(_SCALE)} AS spacing FROM seeds GROUP BY radius),
b AS (SELECT *, spacing * {num(E.ROOT3 / 2)} AS row_step, {num(_PHASE[0])} * spacing AS ox, {num(_PHASE[1])} * (spacing * {num(E.ROOT3 / 2)}) AS oy FROM bands),
r AS (SELECT b.*, unnest(generate_series(CAST(floor((0 - oy) / row_step) AS BIGINT) - 1, CAST(ceil((7000 - oy) / row_step) AS BIGINT) + 1)) AS "row" FROM b), l AS (SELECT *, ox + (("row" % 2) + 2) % 2 * spacing / 2 AS left0 FROM r),
c AS (SELECT *, unnest(generate_series(CAST(floor((0 - left0) / spacing) AS BIGINT) - 1, CAST(ceil((9000 - left0) / spacing) AS BIGINT) + 1)) AS col FROM l)
SELECT band_high, CAST("row" AS INT) AS "row", CAST(col AS INT) AS col, round(left0 + col * spacing, 3) AS x, round(oy + "row" * row_step, 3) AS y FROM c""")
def band_lattice_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the shifted lattice of each radius that seeds have, in a box, with one ring around."""
    of = E.band_lattice(view(spark, sf_dir, "seeds").select(F.col("radius").alias("band_high")).distinct(), _BAND_BOX, _SCALE, _PHASE)
    return E.lattice_nodes(of, _BAND_BOX).select("band_high", "row", "col", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(PLANE + f""" SELECT place_id, CAST(count(CASE WHEN {D2} <= sr * sr + 1e-9 THEN 1 END) AS BIGINT) AS n_cover, round(min(sqrt({D2})), 6) AS nearest FROM samples, circles GROUP BY 1""")
def cover_and_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circles over each place, and the distance to the nearest centre of all."""
    out = J.coverage_and_nearest(samples(spark, sf_dir), circles(spark, sf_dir).select("circle", "sx", "sy", "sr"), "place_id", "circle")
    return out.select("place_id", "n_cover", F.round("nearest", 6).alias("nearest"))


_NODES = SQL["lattice_nearest_node"].split("SELECT place_id, CAST(\"row\" AS INT)")[0]


@query(_NODES + """ SELECT round(1 / greatest(quantile_cont(dist, 0.75), 1e-6), 9) AS regularity, CAST(count(CASE WHEN dist > 250 THEN 1 END) AS BIGINT) AS off_lattice
FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY dist, k) AS rn FROM e) WHERE rn = 1""")
def lattice_regularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regularity of the places against a lattice, and how many lie off it."""
    found, off = A.regularity(_near_node(spark, sf_dir), F.col("n.dist"), 250.0)
    return spark.createDataFrame([(round(found, 9), off)], "regularity double, off_lattice long")
