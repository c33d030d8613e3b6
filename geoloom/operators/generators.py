"""Generators of rows: hex lattices, sample grids, radius bands, spirals, raster windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import EPS

ROOT3 = math.sqrt(3.0)


def lattices(rows: DataFrame, box: tuple[Column, Column, Column, Column], spacing: Column) -> DataFrame:
    """Each row with the nodes (row, col, x, y) of a hex lattice in its box; odd rows are shifted by half a spacing, and places are made by multiplication, so errors don't add up."""
    x0, y0, x1, y1 = box
    step, row = spacing * (ROOT3 / 2), F.col("row")
    shift = (row % 2) * (spacing / 2)
    out = rows.withColumn("row", F.explode(F.sequence(F.lit(0), F.floor((y1 - y0 + EPS) / step).cast("int"))))
    out = out.withColumn("_n", F.floor((x1 - x0 + EPS - shift) / spacing).cast("int")).where("_n >= 0")
    out = out.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("_n")))).drop("_n")
    return out.withColumns({"x": x0 + shift + F.col("col") * spacing, "y": y0 + row * step})


def hex_lattice(spark: SparkSession, box: tuple[float, float, float, float], spacing: float) -> DataFrame:
    """(row, col, x, y) of one lattice."""
    return lattices(spark.range(1), tuple(F.lit(float(v)) for v in box), F.lit(float(spacing))).select("row", "col", "x", "y")


def grids(rows: DataFrame, box: tuple[Column, Column, Column, Column], step: float) -> DataFrame:
    """Each row with the multiples (i, j, x, y) of a step around its box."""
    at = lambda lo, hi: F.sequence(F.floor(lo / step).cast("long"), F.ceil(hi / step).cast("long"))
    out = rows.withColumn("j", F.explode(at(box[1], box[3]))).withColumn("i", F.explode(at(box[0], box[2])))
    return out.withColumns({"x": (F.col("i") * step).cast("double"), "y": (F.col("j") * step).cast("double")})


def sample_grid(spark: SparkSession, box: tuple[float, float, float, float], step: float) -> DataFrame:
    """(idx, x, y) of one grid, row by row from below."""
    i0, j0, i1 = math.floor(box[0] / step), math.floor(box[1] / step), math.ceil(box[2] / step)
    out = grids(spark.range(1), tuple(F.lit(float(v)) for v in box), step)
    return out.select(((F.col("j") - j0) * (i1 - i0 + 1) + F.col("i") - i0).alias("idx"), "x", "y")


def radius_bands(least: int, most: int, step: int) -> list[tuple[int, int, int]]:
    """(index, low, high) from the largest radius down; the last band is the least radius alone or down to it."""
    highs = [*range(most, least, -step), least]
    return [(k, highs[k + 1] + 1 if k + 1 < len(highs) else least, h) for k, h in enumerate(highs)]


def bands(rows: DataFrame, least: Column, most: Column, step: int) -> DataFrame:
    """Each row with the same bands (band_idx, band_low, band_high) between its own least and largest radius."""
    highs = F.concat(F.when(most > least, F.sequence(most, least + 1, F.lit(-step))).otherwise(F.array().cast("array<int>")), F.array(least))
    out = rows.withColumn("_highs", highs).select("*", F.posexplode("_highs").alias("band_idx", "band_high"))
    return out.withColumn("band_low", F.coalesce(F.get("_highs", F.col("band_idx") + 1) + 1, least)).drop("_highs")


def bands_table(spark: SparkSession, least: int, most: int, step: int) -> DataFrame:
    """The bands of one range."""
    return bands(spark.range(1), F.lit(least), F.lit(most), step).select("band_idx", "band_low", "band_high")


def band_lattice(of: DataFrame, box: tuple[float, float, float, float], scale: float, phase: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Adds spacing, row_step and origin of each band's lattice."""
    spacing = ROOT3 * F.col("band_high").cast("double") * scale
    out = of.withColumns({"spacing": spacing, "row_step": spacing * (ROOT3 / 2)})
    return out.withColumns({"origin_x": box[0] + phase[0] * F.col("spacing"), "origin_y": box[1] + phase[1] * F.col("row_step")})


def lattice_nodes(of: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Nodes of each band's lattice inside the box, and one ring around it."""
    index = lambda lo, hi, step: F.sequence((F.floor(lo / step) - 1).cast("int"), (F.ceil(hi / step) + 1).cast("int"))
    rows = of.withColumn("row", F.explode(index(box[1] - F.col("origin_y"), box[3] - F.col("origin_y"), F.col("row_step"))))
    left = F.col("origin_x") + F.pmod(F.col("row"), F.lit(2)) * F.col("spacing") / 2
    out = rows.withColumn("_left", left).withColumn("col", F.explode(index(box[0] - F.col("_left"), box[2] - F.col("_left"), F.col("spacing"))))
    return out.withColumns({"x": F.col("_left") + F.col("col") * F.col("spacing"), "y": F.col("origin_y") + F.col("row") * F.col("row_step")}).drop("_left")


def nearest_node(x: Column, y: Column, origin_x: Column, origin_y: Column, spacing: Column, row_step: Column) -> Column:
    """Struct (dist, k, row, col) of the nearest lattice node: of the nearest row and its two neighbours, the first of equals."""
    row0 = F.rint((y - origin_y) / row_step).cast("int")

    def option(k: int) -> Column:
        row = row0 + (k - 1)
        left = origin_x + F.pmod(row, F.lit(2)) * spacing / 2
        col = F.rint((x - left) / spacing).cast("int")
        return F.struct(F.hypot(left + col * spacing - x, origin_y + row * row_step - y).alias("dist"), F.lit(k).alias("k"), row.alias("row"), col.alias("col"))

    return F.array_min(F.array(*[option(k) for k in range(3)]))


def hex_neighbors(row: Column, col: Column) -> Column:
    """The six neighbours of a node; which columns they have depends on the row's parity."""
    odd = F.pmod(row, F.lit(2))
    pairs = [(row, col - 1), (row, col + 1), (row - 1, col - 1 + odd), (row - 1, col + odd), (row + 1, col - 1 + odd), (row + 1, col + odd)]
    return F.array(*[F.struct(r.alias("row"), c.alias("col")) for r, c in pairs])


def spiral(most: int = 2000, step: int = 100, angles: int = 16) -> Column:
    """Offsets (order, dx, dy): none, then each distance with its angles in turn."""
    rings = F.sequence(F.lit(0), F.lit(most // step * angles - 1))

    def at(i: Column) -> Column:
        d = (F.floor(i / angles) + 1) * float(step)
        a = (i % angles) * (2 * math.pi / angles)
        return F.struct((i + 1).alias("order"), (d * F.cos(a)).alias("dx"), (d * F.sin(a)).alias("dy"))

    none = F.struct(F.lit(0).alias("order"), F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy"))
    return F.concat(F.array(none), F.transform(rings, at))


def cell_bounds(row: Column, col: Column, origin_lon: float, origin_lat: float, width: float, height: float) -> dict[str, Column]:
    """Edges and centre of a raster cell."""
    left, top = origin_lon + col * width, origin_lat - row * height
    return {"lon_center": (left + left + width) / 2, "lat_center": (top + top - height) / 2, "lon_left": left, "lon_right": left + width, "lat_bottom": top - height, "lat_top": top}
