"""Joins of points with a table of polygons, by a cover index.

Polygons are tables of edges, (polygon, x1, y1, x2, y2): all rings together, by the
even-odd rule; a boundary belongs to its polygon.  Each polygon is covered by
cells of a grid whose width is a power of two that suits its extent and its number
of edges.  Cells that no edge comes near lie inside or outside as a whole; border
cells hold the edges near them.  Points look up their cell in each width that
occurs: an inner cell is a hit, a border cell needs tests against its own edges.

A border cell knows the parity of its middle.  For a point of the cell the
crossings of a ray to the right are those of the cell's own edges, and of edges
far to the right.  The latter form chains that begin and end at ends of the cell's
own edges, or above or below the cell's row; so their parity changes from the
middle's height to the point's only with the own edges' ends that lie to the
right, and needs no other edge.  With half-open spans that holds exactly, also
where points are level with corners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import ON_EDGE
from ..session import cut

#: Cells across a polygon: one for so many edges, between these bounds.
EDGES_A_CELL, FEWEST, MOST = 8, 8, 256
#: Beyond what rounding can move a crossing by.
MARGIN = 1e-5


def _index(v: Column, size: Column) -> Column:
    return F.floor(v / size).cast("long")


def _crossing(x1: Column, y1: Column, x2: Column, y2: Column, y: Column) -> Column:
    """Where an edge that isn't level meets the height y."""
    return (x2 - x1) * (y - y1) / (y2 - y1) + x1


def distance2(x: Column, y: Column) -> Column:
    """Squared distance to the edge in the columns x1, y1, x2, y2."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / length))).otherwise(0.0)
    qx, qy = x - (F.col("x1") + t * dx), y - (F.col("y1") + t * dy)
    return qx * qx + qy * qy


def sized(edges: DataFrame, reach: float = 0.0) -> DataFrame:
    """The edges with ``level`` and ``size``, the width of their polygon's cells, 2 ** level."""
    box = edges.groupBy("polygon").agg(
        F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("extent"), F.count(F.lit(1)).alias("n")
    )
    across = F.least(F.lit(MOST), F.greatest(F.lit(FEWEST), F.ceil(F.col("n") / EDGES_A_CELL)))
    width = F.greatest(F.col("extent") / across, F.lit(max(reach, 64 * MARGIN)))
    level = F.ceil(F.log2(width)).cast("int")
    return edges.join(box.select("polygon", level.alias("level")), "polygon").withColumn("size", F.pow(F.lit(2.0), F.col("level")))


def border(edges: DataFrame, reach: float | Column = 0.0, keep: tuple[str, ...] = ("polygon",)) -> DataFrame:
    """(level, cx, cy, size, the columns to keep, the edge): every edge with the cells that it comes near to."""
    m = reach + MARGIN if isinstance(reach, Column) else F.lit(reach + MARGIN)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(_index(low - m, F.col("size")), _index(high + m, F.col("size")))))
    # the part of the edge beside this row of cells
    bottom, top = F.col("cy") * F.col("size") - m, (F.col("cy") + 1) * F.col("size") + m
    dy = F.col("y2") - F.col("y1")

    def at(y: Column) -> Column:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / dy))
        return F.when(dy == 0, F.col("x1")).otherwise(F.col("x1") + t * (F.col("x2") - F.col("x1")))

    a, b = F.when(dy == 0, F.col("x1")).otherwise(at(bottom)), F.when(dy == 0, F.col("x2")).otherwise(at(top))
    columns = F.sequence(_index(F.least(a, b) - m, F.col("size")), _index(F.greatest(a, b) + m, F.col("size")))
    return rows.withColumn("cx", F.explode(columns)).select(*keep, "level", "size", "cx", "cy", "x1", "y1", "x2", "y2")


def cover(edges: DataFrame, reach: float = 0.0) -> tuple[DataFrame, DataFrame, list[int]]:
    """(inner, border, levels): inner cells (polygon, level, cx, cy), border cells with an edge in each row and ``odd``, the parity of the cell's middle without its own edges' part, and the levels of cells that occur."""
    own = cut(sized(edges, reach))
    near = cut(border(own, reach))
    # crossings of the line through the middles of each row of cells
    first, last = _index(F.least("y1", "y2"), F.col("size")), _index(F.greatest("y1", "y2"), F.col("size"))
    lines = own.where(F.col("y1") != F.col("y2")).withColumn("cy", F.explode(F.sequence(first, last))).withColumn("y", (F.col("cy") + 0.5) * F.col("size"))
    lines = lines.where((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))).withColumn("x", _crossing(*map(F.col, ("x1", "y1", "x2", "y2")), F.col("y")))
    middles = near.select("polygon", "level", "size", "cx", "cy").distinct()
    events = lines.select("polygon", "level", "size", "cy", "x", F.lit(1).alias("hit"), F.lit(None).cast("long").alias("cx"))
    events = events.unionByName(middles.select("polygon", "level", "size", "cy", ((F.col("cx") + 0.5) * F.col("size")).alias("x"), F.lit(0).alias("hit"), "cx"))
    row = Window.partitionBy("polygon", "level", "size", "cy").orderBy(F.desc("x"), "hit")
    counted = events.withColumn("right", F.coalesce(F.sum("hit").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parity = counted.where("hit = 0").select("polygon", "level", "cx", "cy", (F.col("right") % 2).cast("int").alias("parity"))
    # a middle's parity, without what the cell's own edges add there
    x, y = (F.col("cx") + 0.5) * F.col("size"), (F.col("cy") + 0.5) * F.col("size")
    share = near.groupBy("polygon", "level", "cx", "cy").agg((F.sum(_own(x, y)) % 2).cast("int").alias("own"))
    odd = share.join(parity, ["polygon", "level", "cx", "cy"]).select("polygon", "level", "cx", "cy", ((F.col("own") + F.col("parity")) % 2).alias("odd"))
    # inner cells: between an odd crossing and the next, away from the border
    spans = counted.where("hit = 1").withColumn("next", F.lead("x").over(Window.partitionBy("polygon", "level", "size", "cy").orderBy(F.desc("x"), "right")))
    spans = spans.where(F.col("next").isNotNull() & (F.col("right") % 2 == 0))
    low, high = _index(F.col("next"), F.col("size")), _index(F.col("x"), F.col("size"))
    inner = spans.withColumn("cx", F.explode(F.sequence(low, high))).where(((F.col("cx") + 0.5) * F.col("size")).between(F.col("next"), F.col("x")))
    inner = inner.select("polygon", "level", "cx", "cy").join(middles, ["polygon", "level", "cx", "cy"], "left_anti")
    return inner, near.join(odd, ["polygon", "level", "cx", "cy"]), sorted(r[0] for r in own.select("level").distinct().collect())


def _own(x: Column, y: Column) -> Column:
    """What one of a border cell's edges adds to the parity at a point of the cell."""
    x1, y1, x2, y2 = map(F.col, ("x1", "y1", "x2", "y2"))
    right = (F.col("cx") + 1) * F.col("size")
    crosses = ((y1 > y) != (y2 > y)) & (x < _crossing(x1, y1, x2, y2, y))
    ends = [((a > right) & (b > y)).cast("int") for a, b in ((x1, y1), (x2, y2))]
    return F.when((y1 > y) != (y2 > y), crosses.cast("int")).otherwise(0) + ends[0] + ends[1]


def containing(points: DataFrame, edges: DataFrame, key: str, x: str = "x", y: str = "y", reach: float = 0.0, boundary: bool = True) -> DataFrame:
    """(key, polygon): polygons that hold each point, or come within ``reach`` of it; their boundary belongs to them unless ``boundary`` is false.

    Points of one place are looked up once, and polygons beyond the box of all points
    not at all.  Points come from small files and give a row for each level, so
    their side isn't left to be broadcast by its size.  A cell with very many points
    or edges is one key of inner joins, which adaptive execution splits.
    """
    px, py = F.col("px"), F.col("py")
    every = points.select(key, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"))
    places = cut(every.select("px", "py").distinct())
    inner, near, levels = cover(_beside(edges, places, reach + MARGIN), reach)
    p = places.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))).withColumn("size", F.pow(F.lit(2.0), F.col("level")))
    p = p.withColumns({"cx": _index(px, F.col("size")), "cy": _index(py, F.col("size"))}).drop("size").hint("merge")
    cell = ["level", "cx", "cy"]
    hits = p.join(inner, cell).select("px", "py", "polygon")
    tested = p.join(near, cell).groupBy("px", "py", "polygon").agg(((F.sum(_own(px, py)) + F.first("odd")) % 2 == 1).alias("inside"), F.min(distance2(px, py)).alias("d2"))
    within = F.col("inside") | (F.col("d2") <= max(reach * reach, ON_EDGE)) if boundary or reach else F.col("inside")
    found = hits.unionByName(tested.where(within).select("px", "py", "polygon"))
    return every.hint("merge").join(found, ["px", "py"]).select(key, "polygon")


def _beside(edges: DataFrame, places: DataFrame, margin: float) -> DataFrame:
    """Edges of the polygons whose box meets that of the places (px, py)."""
    low_x, high_x, low_y, high_y = places.agg(F.min("px"), F.max("px"), F.min("py"), F.max("py")).first()
    if low_x is None:
        return edges.limit(0)
    box = edges.groupBy("polygon").agg(F.min(F.least("x1", "x2")).alias("a"), F.max(F.greatest("x1", "x2")).alias("b"), F.min(F.least("y1", "y2")).alias("c"), F.max(F.greatest("y1", "y2")).alias("d"))
    meets = (F.col("a") <= high_x + margin) & (F.col("b") >= low_x - margin) & (F.col("c") <= high_y + margin) & (F.col("d") >= low_y - margin)
    return edges.join(box.where(meets).select("polygon"), "polygon", "left_semi")
