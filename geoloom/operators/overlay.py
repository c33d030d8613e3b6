"""Boolean overlays of layers of polygons as tables: cells between edges, their areas and connected parts.

Layers are tables of edges, (zone, layer, x1, y1, x2, y2); layers of one zone are
overlaid, layer numbers are bits (0 to 62), all rings of a layer together by the
even-odd rule.  A zone is cut into slabs at every end and crossing of its edges.
In a slab edges don't cross, so sorted by height they bound cells, and the parity
of each layer along the slab says which layers a cell lies in.  Cells connect
within a slab where they touch along an edge, and over a slab's border where their
spans overlap.  Every step is a join by cell or slab, a window or a sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from . import polygons as P

#: Spans that overlap by less don't connect; sides closer than that are one.
TOUCH = 1e-9


def crossings(edges: DataFrame) -> DataFrame:
    """(zone, x): where edges (zone, edge, x1, y1, x2, y2) of a zone cross; candidates meet in a grid's cells."""
    own = P.sized(edges.withColumnRenamed("zone", "polygon"))
    near = cut(P.border(own, keep=("polygon", "edge")))
    a = near.select("polygon", "level", "cx", "cy", *[F.col(c).alias(f"a_{c}") for c in ("edge", "x1", "y1", "x2", "y2")])
    b = near.select("polygon", "level", "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in ("edge", "x1", "y1", "x2", "y2")])
    pairs = a.join(b, ["polygon", "level", "cx", "cy"]).where("a_edge < b_edge")
    return pairs.selectExpr("polygon AS zone", "a_x1", "a_x2 - a_x1 AS ux", "a_y2 - a_y1 AS uy", "b_x2 - b_x1 AS vx", "b_y2 - b_y1 AS vy", "b_x1 - a_x1 AS wx", "b_y1 - a_y1 AS wy").withColumn("d", F.expr("ux * vy - uy * vx")).where(
        "d <> 0 AND (wx * vy - wy * vx) / d BETWEEN 0 AND 1 AND (wx * uy - wy * ux) / d BETWEEN 0 AND 1"
    ).selectExpr("zone", "a_x1 + (wx * vy - wy * vx) / d * ux AS x").distinct()


def cells(edges: DataFrame) -> DataFrame:
    """(zone, slab, k, mask, x0, x1, low0, low1, high0, high1): cells with the layers they lie in as bits; those in no layer are left out.

    low and high: heights of the lower and upper side at both borders of the slab.
    """
    e = cut(edges.select("zone", "layer", *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).withColumn("edge", F.monotonically_increasing_id()))
    ends = e.select("zone", F.explode(F.array("x1", "x2")).alias("x")).unionByName(crossings(e)).distinct()
    row = Window.partitionBy("zone").orderBy("x")
    slabs = cut(ends.select("zone", F.col("x").alias("x0"), F.lead("x").over(row).alias("x1"), F.row_number().over(row).alias("slab")))
    sloped = e.where("x1 <> x2").selectExpr("zone", "layer", "edge", "least(x1, x2) AS a", "greatest(x1, x2) AS b", "CASE WHEN x1 < x2 THEN y1 ELSE y2 END AS ya", "CASE WHEN x1 < x2 THEN y2 ELSE y1 END AS yb")
    first, last = slabs.select("zone", F.col("x0").alias("a"), F.col("slab").alias("s0")), slabs.select("zone", F.col("x0").alias("b"), F.col("slab").alias("s1"))
    dealt = sloped.join(first, ["zone", "a"]).join(last, ["zone", "b"]).withColumn("slab", F.explode(F.expr("sequence(s0, s1 - 1)")))
    dealt = dealt.join(slabs, ["zone", "slab"])
    height = lambda x: f"CASE WHEN {x} = a THEN ya WHEN {x} = b THEN yb ELSE ya + ({x} - a) / (b - a) * (yb - ya) END"
    dealt = dealt.select("zone", "slab", "layer", "x0", "x1", F.expr(height("x0")).alias("low0"), F.expr(height("x1")).alias("low1"))
    up = Window.partitionBy("zone", "slab").orderBy(F.expr("low0 + low1"), "low0", "layer")
    state = F.bit_xor(F.expr("shiftleft(1L, layer)")).over(up.rowsBetween(Window.unboundedPreceding, 0))
    out = dealt.withColumns({"mask": state, "high0": F.lead("low0").over(up), "high1": F.lead("low1").over(up), "k": F.row_number().over(up)})
    return out.where("mask <> 0 AND high0 IS NOT NULL AND high0 + high1 > low0 + low1").select("zone", "slab", "k", "mask", "x0", "x1", "low0", "low1", "high0", "high1")


def area() -> Column:
    """Area of a cell."""
    return F.expr("(x1 - x0) * (high0 - low0 + high1 - low1) / 2")


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected group of links (a, b); a round hooks groups to the least they touch and doubles pointers."""
    labels = nodes.select("node", F.col("node").alias("root"))
    both = cut(links.select("a", "b").union(links.select("b", "a")))
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("root").alias("other"))
        least = both.join(of, "b").groupBy("a").agg(F.min("other").alias("other"))
        hooked = labels.join(least, F.col("node") == F.col("a"), "left").select("node", "root", F.least("root", F.coalesce("other", "root")).alias("next"))
        # a root follows the least that any of its nodes touches
        best = hooked.groupBy("root").agg(F.min("next").alias("to"))
        moved = labels.join(best, "root").select("node", "root", "to")
        jump = moved.select(F.col("node").alias("to"), F.col("to").alias("far"))
        after = cut(moved.join(jump, "to").select("node", "root", F.least("far", "to").alias("new")))
        labels = after.select("node", F.col("new").alias("root"))
        if after.where("new <> root").isEmpty():
            return labels


def parts(chosen: DataFrame) -> DataFrame:
    """``chosen`` cells with a number ``cell`` and ``part``, the least number of their connected part; numbers differ from run to run."""
    c = cut(chosen.withColumn("cell", F.monotonically_increasing_id()))
    side = Window.partitionBy("zone", "slab").orderBy("k")
    # cells without height between two others are left out, so it is heights that tell whether these touch
    touch = F.greatest(F.abs(F.lead("low0").over(side) - F.col("high0")), F.abs(F.lead("low1").over(side) - F.col("high1"))) <= TOUCH
    inside = c.select(F.col("cell").alias("a"), F.lead("cell").over(side).alias("b"), touch.alias("touch")).where("touch")
    # along each border of slabs, the cells to its left and right that were opened last, and how far up they reach
    events = None
    for name, border, low, high in (("left", "slab", "low1", "high1"), ("right", "slab - 1", "low0", "high0")):
        open_here = c.where(f"{high} > {low}")
        for y, opens in ((low, f"struct(cell, {high} AS upto)"), (high, "NULL")):
            more = open_here.selectExpr("zone", f"{border} AS border", f"{y} AS y", f"'{name}' AS side", f"CAST({opens} AS STRUCT<cell: LONG, upto: DOUBLE>) AS open")
            events = more if events is None else events.unionByName(more)
    at = Window.partitionBy("zone", "border").orderBy("y", F.col("open").isNotNull())
    now = lambda s: F.last(F.when(F.col("side") == s, F.col("open")), ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0))
    over = events.select("y", now("left").alias("l"), now("right").alias("r"), F.lead("y").over(at).alias("next"))
    over = over.where(f"least(next, l.upto, r.upto) - y > {TOUCH}").select(F.col("l.cell").alias("a"), F.col("r.cell").alias("b"))
    links = inside.select("a", "b").unionByName(over).distinct()
    return c.join(_roots(c.select(F.col("cell").alias("node")), links).withColumnsRenamed({"node": "cell", "root": "part"}), "cell")


def part_areas(labelled: DataFrame) -> DataFrame:
    """(zone, part, area, n_cells, x, y): areas of parts with a place inside each, the middle of its largest cell."""
    a = labelled.withColumn("_a", area())
    big = F.max_by(F.expr("struct((x0 + x1) / 2 AS x, (low0 + low1 + high0 + high1) / 4 AS y)"), F.struct("_a", (-F.col("cell")).alias("c")))
    return a.groupBy("zone", "part").agg(F.sum("_a").alias("area"), F.count(F.lit(1)).alias("n_cells"), big.alias("b")).select("zone", "part", "area", "n_cells", "b.x", "b.y")


def anchored(labelled: DataFrame, x: float, y: float) -> DataFrame:
    """The parts that cover a place."""
    t = f"({x!r}D - x0) / (x1 - x0)"
    here = labelled.where(f"{x!r}D BETWEEN x0 AND x1 AND {y!r}D BETWEEN low0 + {t} * (low1 - low0) AND high0 + {t} * (high1 - high0)")
    return labelled.join(here.select("zone", "part").distinct(), ["zone", "part"], "left_semi")


def as_polygons(numbered: DataFrame) -> DataFrame:
    """Edges (polygon, x1, y1, x2, y2) of cells, named by their numbers, for joins with points."""
    corners = "array(struct(x0 AS x, low0 AS y), struct(x1 AS x, low1 AS y), struct(x1 AS x, high1 AS y), struct(x0 AS x, high0 AS y))"
    ring = numbered.selectExpr("cell AS polygon", f"{corners} AS c").select("polygon", "c", F.expr("posexplode(c) AS (i, p)"))
    return ring.selectExpr("polygon", "p.x AS x1", "p.y AS y1", "c[(i + 1) % 4].x AS x2", "c[(i + 1) % 4].y AS y2").where("x1 <> x2 OR y1 <> y2")


def holding(points: DataFrame, numbered: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Points with the cells that hold them, all columns of these; a point on a side that cells share is in both."""
    return P.containing(points, as_polygons(numbered), key, x, y).withColumnRenamed("polygon", "cell").join(numbered, "cell")
