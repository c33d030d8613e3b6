"""Exact areas of unions of disks, and of what disks leave uncovered of polygons, by arcs.

On every circle the others hide intervals of angles; sorted, with a running
maximum, they leave the exposed arcs.  In the same way disks cover intervals of
each edge of a polygon.  Green's theorem gives areas as sums over exposed arcs and
uncovered stretches, so nothing is cut into pieces or held together but one row at
a time; the steps are joins of neighbours, windows and sums.

Circles are (circle, x, y, r); equal ones count once, those without a positive
radius not at all.  Polygons are tables of edges, (polygon, x1, y1, x2, y2), with
the inside on the left: outer rings against the clock, holes with it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from . import polygons as P

TURN = 2 * math.pi
#: Ends of edges count as crossings a little beyond; needless cuts of an arc do no harm.
NEAR = 1e-9
#: Where a piece of an arc is tested; not the middle, which touches an edge in symmetric plans.
WITHIN = 0.4142
#: Cells of middles to the largest radius, where circles in larger ones are looked for.
ACROSS = 12


def distinct_circles(circles: DataFrame, circle: str = "circle", x: str = "x", y: str = "y", r: str = "r") -> DataFrame:
    c = circles.select(F.col(circle).alias("circle"), *[F.col(v).cast("double").alias(n) for v, n in ((x, "x"), (y, "y"), (r, "r"))])
    return c.where(F.col("r") > 0).groupBy("x", "y", "r").agg(F.min("circle").alias("circle"))


def outer_circles(circles: DataFrame) -> DataFrame:
    """Distinct circles without such that lie in a larger one: those that share a middle with it, and those that the largest of a cell of middles holds.

    They add nothing to a union.  A circle that only one without a cell's largest radius holds stays, to be hidden by its arcs.
    """
    c = cut(distinct_circles(circles).groupBy("x", "y").agg(F.max("r").alias("r"), F.min("circle").alias("circle")).select("x", "y", "r", "circle"))
    most = c.agg(F.max("r")).first()[0]
    if most is None:
        return c
    width, reach = most / ACROSS, F.lit(most) - F.col("r")
    cell = lambda v: F.floor(v / width).cast("long")
    best = c.groupBy(cell(F.col("x")).alias("cx"), cell(F.col("y")).alias("cy")).agg(F.max(F.struct(F.col("r").alias("o_r"), F.col("x").alias("ox"), F.col("y").alias("oy"))).alias("o")).select("cx", "cy", "o.*")
    looks = c.where(reach > 0)
    for name, v in (("cx", F.col("x")), ("cy", F.col("y"))):
        looks = looks.withColumn(name, F.explode(F.sequence(cell(v - reach), cell(v + reach))))
    d = F.sqrt((F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")))
    held = looks.join(best, ["cx", "cy"]).where((F.col("o_r") > F.col("r")) & (d <= F.col("o_r") - F.col("r"))).select("circle").distinct()
    return c.join(held, "circle", "left_anti").select("x", "y", "r", "circle")


def _levels(circles: DataFrame) -> DataFrame:
    """With the power of two, at least the radius, whose cells the circle's middle is looked up in."""
    level = F.ceil(F.log2("r")).cast("int")
    return circles.withColumn("level", level).withColumn("size", F.pow(F.lit(2.0), "level"))


def neighbours(circles: DataFrame) -> DataFrame:
    """(circle, x, y, r, ox, oy, o_r, d): circles with the others that meet them.

    A circle visits the cells of each width that occurs; smaller circles than itself
    are found from their side.
    """
    c = _levels(circles)
    levels = sorted(r[0] for r in c.select("level").distinct().collect())
    wide = c.withColumn("at", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))).where(F.col("at") >= F.col("level"))
    w = F.pow(F.lit(2.0), F.col("at"))
    reach = F.col("r") + w
    span = lambda v: F.sequence(F.floor((F.col(v) - reach) / w).cast("long"), F.floor((F.col(v) + reach) / w).cast("long"))
    looks = wide.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y"))).select("circle", "x", "y", "r", F.col("at").alias("level"), "cx", "cy")
    cell = lambda v: F.floor(F.col(v) / F.col("size")).cast("long")
    other = c.select(F.col("circle").alias("oc"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("r").alias("o_r"), "level", cell("x").alias("cx"), cell("y").alias("cy"), F.col("level").alias("ol"))
    d = F.sqrt((F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")))
    met = looks.join(other, ["level", "cx", "cy"]).where(F.col("circle") != F.col("oc")).withColumn("d", d).where(F.col("d") < F.col("r") + F.col("o_r"))
    one = ["circle", "x", "y", "r", "oc", "ox", "oy", "o_r", "d"]
    # pairs of unequal widths were met from the smaller side only
    own_level = F.ceil(F.log2("r")).cast("int")
    back = met.where(F.col("ol") > own_level).select(F.col("oc").alias("circle"), F.col("ox").alias("x"), F.col("oy").alias("y"), F.col("o_r").alias("r"), F.col("circle").alias("oc"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("r").alias("o_r"), "d")
    return met.select(*one).unionByName(back).select(*[c for c in one if c != "oc"])


def _gaps(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, a, b): what intervals (lo, hi) leave of the range up to their sentinels, which begin at its end."""
    before = Window.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    run = intervals.withColumn("a", F.greatest(F.lit(0.0), F.coalesce(F.max("hi").over(before), F.lit(0.0))))
    return run.where(F.col("lo") > F.col("a")).select(*keys, "a", F.col("lo").alias("b"))


def exposed(circles: DataFrame) -> DataFrame:
    """(circle, x, y, r, a, b): arcs, from angle a to b of 0 to 2 pi, that lie in no other disk."""
    near = neighbours(circles)
    cosine = (F.col("d") * F.col("d") + F.col("r") * F.col("r") - F.col("o_r") * F.col("o_r")) / (2 * F.col("d") * F.col("r"))
    half = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    to = F.atan2(F.col("oy") - F.col("y"), F.col("ox") - F.col("x"))
    hidden = near.where(F.col("d") > F.col("r") - F.col("o_r"))
    whole = F.array(F.struct(F.lit(0.0).alias("lo"), F.lit(TURN).alias("hi")))
    low = F.pmod(to - half, F.lit(TURN))
    high = low + 2 * half
    piece = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
    parts = F.when(F.col("d") <= F.col("o_r") - F.col("r"), whole).when(high > TURN, F.array(piece(low, F.lit(TURN)), piece(F.lit(0.0), high - TURN))).otherwise(F.array(piece(low, high)))
    own = ["circle", "x", "y", "r"]
    rows = hidden.select(*own, F.explode(parts).alias("p")).select(*own, "p.lo", "p.hi")
    return _gaps(rows.unionByName(circles.select(*own, F.lit(TURN).alias("lo"), F.lit(TURN).alias("hi"))), own)


def _swept(a: Column | str, b: Column | str) -> Column:
    """Half the integral of x dy - y dx along the arc from a to b, against the clock."""
    a, b, x, y, r = (F.col(c) if isinstance(c, str) else c for c in (a, b, "x", "y", "r"))
    return (r * r * (b - a) + x * r * (F.sin(b) - F.sin(a)) - y * r * (F.cos(b) - F.cos(a))) / 2


def union_area(circles: DataFrame) -> DataFrame:
    """One row, ``area``: the area of the union of disks (circle, x, y, r)."""
    return exposed(cut(outer_circles(circles))).agg(F.coalesce(F.sum(_swept("a", "b")), F.lit(0.0)).alias("area"))


def meetings(circles: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with circles that cross their line near them: all columns of both, and the two places t1 < t2 along the edge (0 to 1).

    A circle visits the cells that it reaches, at most nine, an edge those that it
    touches; of the cells where both are, the one with the edge's nearest place counts.
    """
    c = _levels(circles)
    levels = sorted(r[0] for r in c.select("level").distinct().collect())
    e = edges.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))).withColumn("size", F.pow(F.lit(2.0), F.col("level")))
    cells = P.border(e, keep=("polygon", "edge")).drop("size")
    reach = f"(r + {2 * P.MARGIN!r}D)"
    for name, v in (("cx", "x"), ("cy", "y")):
        c = c.withColumn(name, F.expr(f"explode(sequence(cast(floor(({v} - {reach}) / size) AS BIGINT), cast(floor(({v} + {reach}) / size) AS BIGINT)))"))
    pairs = c.join(cells, ["level", "cx", "cy"]).withColumns({
        "a": F.expr("(x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)"), "b": F.expr("(x1 - x) * (x2 - x1) + (y1 - y) * (y2 - y1)"),
        "c": F.expr("(x1 - x) * (x1 - x) + (y1 - y) * (y1 - y) - r * r"),
    }).where("a > 0 AND b * b - a * c > 0").withColumn("t", F.expr("greatest(0D, least(1D, -b / a))"))
    own = pairs.where("cx = floor((x1 + t * (x2 - x1)) / size) AND cy = floor((y1 + t * (y2 - y1)) / size)")
    met = own.withColumns({"t1": F.expr("(-b - sqrt(b * b - a * c)) / a"), "t2": F.expr("(-b + sqrt(b * b - a * c)) / a")})
    return met.where((F.col("t2") > -NEAR) & (F.col("t1") < 1 + NEAR)).drop("a", "b", "c", "t", "size")


def uncovered(edges: DataFrame, circles: DataFrame) -> DataFrame:
    """(polygon, area, uncovered): area of each polygon, and of what no disk covers of it.

    Exposed arcs are cut where they cross any edge; a place of each piece tells the
    polygons that it lies in.
    """
    c = cut(outer_circles(circles))
    e = cut(edges.select("polygon", *[F.col(v).cast("double").alias(v) for v in ("x1", "y1", "x2", "y2")]).withColumn("edge", F.monotonically_increasing_id()))
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    area = e.groupBy("polygon").agg((F.sum(cross) / 2).alias("area"))
    met = cut(meetings(c, e))
    # stretches of edges
    own = ["polygon", "edge", "x1", "y1", "x2", "y2"]
    held = met.select(*own, F.greatest(F.lit(0.0), "t1").alias("lo"), F.least(F.lit(1.0), "t2").alias("hi")).where(F.col("lo") < F.col("hi"))
    bare = _gaps(held.unionByName(e.select(*own, F.lit(1.0).alias("lo"), F.lit(1.0).alias("hi"))), own)
    stretches = bare.select("polygon", (cross * (F.col("b") - F.col("a")) / 2).alias("part"))
    # arcs
    point = lambda t: (F.col("x1") + t * (F.col("x2") - F.col("x1")) - F.col("x"), F.col("y1") + t * (F.col("y2") - F.col("y1")) - F.col("y"))
    angle = lambda p: F.pmod(F.atan2(p[1], p[0]), F.lit(TURN))
    cuts = met.select("circle", "x", "y", "r", F.explode(F.array(*[F.when(F.col(t).between(-NEAR, 1 + NEAR), angle(point(F.col(t)))) for t in ("t1", "t2")])).alias("at")).where(F.col("at").isNotNull())
    arcs = exposed(c)
    events = cuts.select("circle", "x", "y", "r", "at", F.lit(0).alias("turn"))
    for v, turn in (("a", 1), ("b", -1)):
        events = events.unionByName(arcs.select("circle", "x", "y", "r", F.col(v).alias("at"), F.lit(turn).alias("turn")))
    w = Window.partitionBy("circle", "x", "y", "r").orderBy("at", "turn")
    pieces = events.withColumns({"open": F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, 0)), "to": F.lead("at").over(w)})
    pieces = cut(pieces.where((F.col("open") > 0) & (F.col("to") > F.col("at"))).select("x", "y", "r", "at", "to", F.monotonically_increasing_id().alias("piece")))
    place = F.col("at") + WITHIN * (F.col("to") - F.col("at"))
    points = pieces.select("piece", (F.col("x") + F.col("r") * F.cos(place)).alias("mx"), (F.col("y") + F.col("r") * F.sin(place)).alias("my"))
    inside = P.containing(points, e, "piece", "mx", "my", boundary=False)
    rims = inside.join(pieces.select("piece", (-_swept("at", "to")).alias("part")), "piece").select("polygon", "part")
    left = stretches.unionByName(rims).groupBy("polygon").agg(F.sum("part").alias("uncovered"))
    return area.join(left, "polygon", "left").select("polygon", "area", F.coalesce("uncovered", F.lit(0.0)).alias("uncovered"))
