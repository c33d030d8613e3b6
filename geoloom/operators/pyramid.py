"""Hierarchical cell counts: nearest neighbours and coverage that follow the density of a table.

A square around all rows is level 0; a cell of one level has 4 x 4 cells of the
next.  A row's place on the finest level, shifted, names its cell on every level.
Cells of the level ``start`` hold at most ``cap`` rows on average; those that hold
over ``DENSE`` times as many are split further, so that no leaf has more rows,
however dense its surroundings are.  (Only rows that share a place to within
2 ** -26 of the square can be more.)

Searches walk down the cells for all rows at once.  A round joins the children of
the cells that are still open with the counts and drops what can't matter; rows
are read at the end, from the leaves that are left.  There are at most ``DEPTH``
rounds, whatever the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import EPS, squared
from ..session import cut

#: Levels below the square, each of which halves a cell's side twice.
DEPTH, HALVINGS = 13, 2
#: A cell is split further from so many times the rows that cells shall have; rounds between two cuts of the lineage.
DENSE, ROUNDS = 4, 2
SIDE = 1 << (DEPTH * HALVINGS)
CELL = ["level", "cx", "cy"]


@dataclass(frozen=True)
class Grid:
    """The square of level 0; ``slack``: what rounding can move a place by."""

    x0: float
    y0: float
    size: float

    @property
    def slack(self) -> float:
        return 1e-12 * (self.size + abs(self.x0) + abs(self.y0))

    # SQL text: a search builds these many times, and a text costs the driver one call
    @property
    def width(self) -> str:
        """Width of a cell of the column level."""
        return f"({self.size!r}D / pow(4D, level))"

    def index(self, v: str, origin: float, cells: str = "cast(pow(4D, level) AS BIGINT)") -> str:
        """Number of the cell of the column level that a coordinate lies in; the nearest for one outside."""
        return f"greatest(0L, least({cells} - 1, cast(floor(({v} - {origin!r}D) / {self.width}) AS BIGINT)))"

    def finest(self, rows: DataFrame, x: str, y: str) -> DataFrame:
        """With _x and _y, the cell on the finest level."""
        cell = [self.index(v, o).replace("level", str(DEPTH)) for v, o in ((f"`{x}`", self.x0), (f"`{y}`", self.y0))]
        return rows.withColumns({"_x": F.expr(cell[0]), "_y": F.expr(cell[1])})

    def bounds2(self, x: str, y: str) -> tuple[str, str]:
        """Least and greatest squared distance from a place to the cell in the columns level, cx and cy."""
        out = []
        for v, origin, c in ((x, self.x0, "cx"), (y, self.y0, "cy")):
            low = f"({origin!r}D + {c} * {self.width} - {self.slack!r}D)"
            high = f"({origin!r}D + ({c} + 1) * {self.width} + {self.slack!r}D)"
            out.append((f"greatest({low} - {v}, {v} - {high}, 0D)", f"greatest({v} - {low}, {high} - {v})"))
        return tuple(f"(pow({out[0][k]}, 2) + pow({out[1][k]}, 2))" for k in range(2))


def _up(x: str = "_x", y: str = "_y", of: str = str(DEPTH)) -> dict[str, Column]:
    """The cell of the column level that holds a cell of a finer one."""
    return {c: F.expr(f"shiftright({v}, cast({HALVINGS} * ({of} - level) AS INT))") for c, v in (("cx", x), ("cy", y))}


@dataclass(frozen=True)
class Pyramid:
    """``counts``: (level, cx, cy, n) of the cells, ``leaves``: of the leaves; ``rows``: the table's columns with level, cx and cy of their leaf."""

    grid: Grid
    start: int
    most: int
    total: int
    counts: DataFrame
    leaves: DataFrame
    rows: DataFrame

    @property
    def open_cells(self) -> str:
        """Cells that have children to look at."""
        return f"(level < {self.start} OR (n > {self.most} AND level < {DEPTH}))"

    def opened(self, cells: DataFrame, which: str) -> DataFrame:
        """Cells (level, cx, cy, n, and other columns) with those of ``which`` replaced by their children that hold rows."""
        others = [c for c in cells.columns if c not in (*CELL, "n")]
        below = "transform(sequence(0, 15), i -> struct(level + 1 AS level, cx * 4 + i div 4 AS cx, cy * 4 + i % 4 AS cy))"
        now = cells.select(*others, F.expr(f"explode(CASE WHEN {which} THEN {below} ELSE array(struct(level, cx, cy)) END) AS _cell"))
        return now.select(*others, "_cell.*").join(self.counts, CELL)


def build(rows: DataFrame, x: str, y: str, cap: int, also: DataFrame | None = None, also_x: str = "", also_y: str = "") -> Pyramid | None:
    """Pyramid over the places of ``rows``, in a square that holds those of ``also`` too; None of an empty table."""
    box = [F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.sum("n")]
    places = rows.select(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(1).alias("n"))
    if also is not None:
        places = places.unionByName(also.select(F.col(also_x).alias("x"), F.col(also_y).alias("y"), F.lit(0).alias("n")))
    r = places.agg(*box).first()
    if not r[4]:
        return None
    grid = Grid(float(r[0]), float(r[2]), max(float(r[1] - r[0]), float(r[3] - r[2]), 1e-6) * (1 + 1e-9))
    total = int(r[4])
    start = min(DEPTH, max(0, math.ceil(math.log(max(1.0, total / cap), 16))))
    keyed = grid.finest(rows, x, y)
    level = F.col("level")

    def counted(df: DataFrame, first: int, last: int) -> DataFrame:
        each = df.select("_x", "_y", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("level")).withColumns(_up())
        return each.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))

    coarse = cut(counted(keyed, 0, start))
    at_start, most = keyed.withColumn("level", F.lit(start)).withColumns(_up()), DENSE * cap
    even = coarse.where((level == start) & (F.col("n") <= most))
    heavy = coarse.where((level == start) & (F.col("n") > most)).select(*CELL)
    if start == DEPTH or heavy.isEmpty():
        return Pyramid(grid, start, most, total, coarse, coarse.where(level == start), at_start.drop("_x", "_y"))
    dense = at_start.join(heavy, CELL, "left_semi").drop(*CELL)
    fine = cut(counted(dense, start + 1, DEPTH))
    counts = coarse.unionByName(fine)
    above = counts.select((level + 1).alias("level"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("n").alias("_n"))
    # a leaf: few enough rows, or the finest level, below a cell that was split
    split = fine.withColumns({"_cx": F.shiftright("cx", HALVINGS), "_cy": F.shiftright("cy", HALVINGS)}).join(above, ["level", "_cx", "_cy"]).where(F.col("_n") > most)
    leaves = cut(split.where((F.col("n") <= most) | (level == DEPTH)).select(*CELL, "n"))
    down = dense.withColumn("level", F.explode(F.sequence(F.lit(start + 1), F.lit(DEPTH)))).withColumns(_up()).join(leaves.drop("n"), CELL)
    rest = at_start.join(heavy, CELL, "left_anti")
    return Pyramid(grid, start, most, total, counts, even.unionByName(leaves), rest.unionByName(down).drop("_x", "_y"))


def nearest_leaves(points: DataFrame, pyramid: Pyramid, k: int, key: str) -> DataFrame:
    """(key, px, py, level, cx, cy, n): leaves that can hold one of the ``k`` nearest rows of a point (key, px, py).

    A point begins at the finest level up to ``start`` where its own cell has ``k``
    rows, with the cells around that are no farther than that cell reaches.
    """
    grid, wanted = pyramid.grid, min(k, pyramid.total)
    levels = grid.finest(points.select(key, "px", "py"), "px", "py").withColumn("level", F.expr(f"explode(sequence(0, {pyramid.start}))")).withColumns(_up())
    enough = levels.join(pyramid.counts.where(F.col("n") >= wanted), CELL)
    own = enough.groupBy(key, "px", "py").agg(F.max("level").alias("level"))
    # the square holds all points, so their cells are those that they lie in
    at = own.withColumns({"cx": F.expr(grid.index("px", grid.x0)), "cy": F.expr(grid.index("py", grid.y0)), "_d": F.expr("explode(sequence(0, 24))")})
    at = at.withColumns({"cx": F.expr("cx + _d div 5 - 2"), "cy": F.expr("cy + _d % 5 - 2")}).where("cx >= 0 AND cy >= 0 AND cx < pow(4D, level) AND cy < pow(4D, level)")
    now = at.select(key, "px", "py", *CELL).join(pyramid.counts, CELL)
    low, high = grid.bounds2("px", "py")
    own_rows = Window.partitionBy(key)
    by_reach = own_rows.orderBy("_high", *CELL).rowsBetween(Window.unboundedPreceding, 0)

    def pruned(cells: DataFrame) -> DataFrame:
        """Without cells farther than a reach within which there are enough rows."""
        reach = F.min(F.when(F.col("_sum") >= wanted, F.col("_high"))).over(own_rows)
        cells = cells.withColumn("_high", F.expr(high)).withColumn("_sum", F.sum("n").over(by_reach)).withColumn("_reach", reach)
        return cells.where(f"{low} <= _reach").drop("_high", "_sum", "_reach")

    now, done = pruned(now), None
    while True:
        for _ in range(ROUNDS):
            now = pruned(pyramid.opened(now, pyramid.open_cells))
        now = cut(now.withColumn("_more", F.max(F.expr(pyramid.open_cells)).over(own_rows)))
        settled, now = now.where("NOT _more").drop("_more"), now.where("_more").drop("_more")
        done = settled if done is None else done.unionByName(settled)
        if now.isEmpty():
            return done


def knn(points: DataFrame, sites: DataFrame, k: int, key: str, order: str) -> DataFrame:
    """The ``k`` nearest sites (sx, sy) of each point (px, py), with ``d2`` and ``rank``; ties go to the lower ``order`` of the site.

    A leaf holds at most ``4 * k`` sites (16 at least); of sites at one place only the
    first ``k`` in order can be among a point's nearest.
    """
    pyramid = build(sites, "sx", "sy", max(4, k), points, "px", "py")
    if pyramid is None:
        return points.crossJoin(sites.limit(0)).withColumns({"d2": F.lit(0.0), "rank": F.lit(1)})
    rows = pyramid.rows
    first = Window.partitionBy("sx", "sy").orderBy(order)
    piled = rows.where(F.col("level") == DEPTH).withColumn("_first", F.row_number().over(first)).where(F.col("_first") <= k).drop("_first")
    rows = rows.where(F.col("level") < DEPTH).unionByName(piled)
    near = nearest_leaves(points.select(key, "px", "py"), pyramid, k, key)
    pairs = near.drop("n").join(rows, CELL).drop(*CELL).withColumn("d2", squared(F.col("px"), F.col("py"), F.col("sx"), F.col("sy")))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("d2", order))).where(F.col("rank") <= k)
    more = [c for c in points.columns if c not in (key, "px", "py")]
    return pairs.join(points.select(key, *more), key) if more else pairs


@dataclass(frozen=True)
class Cover:
    """``inside``: (circle, level, cx, cy, n) cells wholly in a circle; ``border``: leaves that a circle's border may cross, with its sx, sy, sr."""

    pyramid: Pyramid
    inside: DataFrame
    border: DataFrame


def covered_cells(pyramid: Pyramid, circles: DataFrame, circle: str) -> Cover:
    """Cells that circles (sx, sy, sr) hold or cross.  A circle begins with cells about as wide as its radius, at most nine."""
    grid = pyramid.grid
    c = circles.select(circle, *[F.col(v).cast("double").alias(v) for v in ("sx", "sy", "sr")]).where(F.col("sr") >= 0)
    fit = f"floor(log2({grid.size!r}D / greatest(sr, {grid.size / SIDE!r}D)) / {HALVINGS})"
    c = c.withColumn("level", F.expr(f"cast(greatest(0, least({pyramid.start}, {fit})) AS INT)"))
    margin = f"(sr + {grid.slack + EPS!r}D)"
    for name, v, o in (("cx", "sx", grid.x0), ("cy", "sy", grid.y0)):
        c = c.withColumn(name, F.expr(f"explode(sequence({grid.index(f'{v} - {margin}', o)}, {grid.index(f'{v} + {margin}', o)}))"))
    low, high = grid.bounds2("sx", "sy")
    met = lambda cells: cells.where(f"{low} <= sr * sr + {EPS!r}D").withColumn("_in", F.expr(f"{high} <= sr * sr"))
    now = met(c.select(circle, "sx", "sy", "sr", *CELL).join(pyramid.counts, CELL))
    still, done = f"(NOT _in AND {pyramid.open_cells})", None
    while True:
        for _ in range(ROUNDS):
            now = met(pyramid.opened(now, still))
        now = cut(now)
        over = now.where(f"NOT {still}")
        done = over if done is None else done.unionByName(over)
        now = now.where(still)
        if now.isEmpty():
            return Cover(pyramid, done.where("_in").select(circle, *CELL, "n"), done.where("NOT _in").drop("_in"))


def _leaf_sums(cover: Cover, circle: str) -> DataFrame:
    """(level, cx, cy, leaf_n, inner, one): rows of each leaf, circles that hold it wholly, and the least of these."""
    held = cover.inside.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"), F.min(circle).alias("_c"))
    leaves = cover.pyramid.leaves.withColumnRenamed("n", "leaf_n")
    named = leaves.select(*[F.col(c).alias(f"_{c}") for c in CELL])
    up = named.withColumn("level", F.expr("explode(sequence(0, _level))")).withColumns(_up("_cx", "_cy", "_level"))
    sums = up.join(held, CELL).groupBy(*[F.col(f"_{c}").alias(c) for c in CELL]).agg(F.sum("_n").alias("inner"), F.min("_c").alias("one"))
    return leaves.join(sums, CELL, "left").withColumn("inner", F.coalesce("inner", F.lit(0).cast("long")))


def _border_hits(cover: Cover) -> DataFrame:
    """Rows of the border leaves with each circle that holds them."""
    pairs = cover.border.drop("n").join(cover.pyramid.rows, CELL)
    return pairs.where(squared(F.col("px"), F.col("py"), F.col("sx"), F.col("sy")) <= F.col("sr") * F.col("sr") + EPS)


def coverage(samples: DataFrame, circles: DataFrame, key: str, cap: int = 16) -> DataFrame:
    """(key, n_cover): circles (sx, sy, sr) over each sample (px, py), zero included.  ``key`` is unique."""
    places = by_place(samples, key)
    cover = _covered(places, circles, key, cap)
    if cover is None:
        return samples.select(key).withColumn("n_cover", F.lit(0).cast("long"))
    sums, hits = _leaf_sums(cover, "_c"), _border_hits(cover).groupBy(key).agg(F.count(F.lit(1)).alias("_hits"))
    out = cover.pyramid.rows.select(key, "px", "py", *CELL).join(sums, CELL).join(hits, key, "left")
    out = out.select("px", "py", (F.col("inner") + F.coalesce("_hits", F.lit(0))).cast("long").alias("n_cover"))
    return samples.select(key, "px", "py").join(out, ["px", "py"]).select(key, "n_cover")


def by_place(rows: DataFrame, key: str, x: str = "px", y: str = "py") -> DataFrame:
    """One row for each place: the least key of those there."""
    return cut(rows.groupBy(x, y).agg(F.min(key).alias(key)))


def _covered(samples: DataFrame, circles: DataFrame, key: str, cap: int) -> Cover | None:
    pyramid = build(samples.select(key, "px", "py"), "px", "py", cap)
    return covered_cells(pyramid, circles.select(F.lit(0).alias("_c"), "sx", "sy", "sr"), "_c") if pyramid else None


def coverage_histogram(samples: DataFrame, circles: DataFrame, key: str, cap: int = 16) -> DataFrame:
    """(n_cover, n): samples by the number of circles over them.  Leaves that no border crosses count as a whole."""
    cover = _covered(samples, circles, key, cap)
    if cover is None:
        return samples.sparkSession.createDataFrame([], "n_cover long, n long")
    sums, opened = _leaf_sums(cover, "_c"), cover.border.select(*CELL).distinct()
    whole = sums.join(opened, CELL, "left_anti").select(F.col("inner").alias("n_cover"), F.col("leaf_n").alias("n"))
    hits = _border_hits(cover).groupBy(key).agg(F.count(F.lit(1)).alias("_hits"))
    single = cover.pyramid.rows.select(key, *CELL).join(opened, CELL, "left_semi").join(sums, CELL).join(hits, key, "left")
    single = single.select((F.col("inner") + F.coalesce("_hits", F.lit(0))).alias("n_cover"), F.lit(1).cast("long").alias("n"))
    return whole.unionByName(single).groupBy("n_cover").agg(F.sum("n").alias("n"))


def unique_support(samples: DataFrame, circles: DataFrame, key: str, circle: str, cap: int = 16) -> DataFrame:
    """(circle, n_unique, n_covered): samples that only this circle covers, and all that it covers."""
    pyramid = build(samples.select(key, "px", "py"), "px", "py", cap)
    zero = F.lit(0).cast("long")
    if pyramid is None:
        return circles.select(circle).withColumns({"n_unique": zero, "n_covered": zero})
    cover = covered_cells(pyramid, circles.select(circle, "sx", "sy", "sr"), circle)
    sums, opened = _leaf_sums(cover, circle), cover.border.select(*CELL).distinct()
    hits = cut(_border_hits(cover).select(key, *CELL, circle))
    covered = cover.inside.select(circle, "n").unionByName(hits.select(circle, F.lit(1).cast("long").alias("n"))).groupBy(circle).agg(F.sum("n").alias("n_covered"))
    whole = sums.join(opened, CELL, "left_anti").where(F.col("inner") == 1).select(F.col("one").alias(circle), F.col("leaf_n").alias("n"))
    by_row = hits.groupBy(key).agg(F.count(F.lit(1)).alias("_hits"), F.min(circle).alias("_own"))
    rows = pyramid.rows.select(key, *CELL).join(opened, CELL, "left_semi").join(sums, CELL).join(by_row, key, "left")
    rows = rows.where(F.col("inner") + F.coalesce("_hits", F.lit(0)) == 1).select(F.coalesce("_own", "one").alias(circle), F.lit(1).cast("long").alias("n"))
    unique = whole.unionByName(rows).groupBy(circle).agg(F.sum("n").alias("n_unique"))
    out = circles.select(circle).join(unique, circle, "left").join(covered, circle, "left")
    return out.select(circle, *[F.coalesce(c, zero).alias(c) for c in ("n_unique", "n_covered")])
