"""Aggregates: percentiles, density scale, coverage metrics, boxes, centroids, best candidate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut


def percentile(c: Column, p: float) -> Column:
    """Linear between neighbours; at or below 0 the least, at or above 1 the greatest.

    A group's distinct values lie in one task; for whole columns use ``quantiles``.
    """
    return F.percentile(c, F.lit(min(1.0, max(0.0, p))))


def quantiles(rows: DataFrame, value: Column, *at: float) -> list[float | None]:
    """Exact percentiles of a whole column, linear between neighbours; nulls don't count; without values all are null.

    Distinct values with their counts are sorted by range, so no task holds a
    column and a repeated value is one row.  The driver gets a count for each
    partition, and the two values at either side of each percentile.
    """
    counted = rows.select(value.cast("double").alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    sorted_ = cut(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    parts = sorted_.groupBy("part").agg(F.sum("n").alias("n"), F.min("v").alias("lo")).orderBy("lo").collect()
    total = sum(p["n"] for p in parts)
    if not total:
        return [None] * len(at)
    places = [min(1.0, max(0.0, p)) * (total - 1) for p in at]
    wanted, before = [], 0
    ranks = sorted({r for x in places for r in (math.floor(x), math.ceil(x))})
    for p in parts:
        wanted += [(p["part"], r - before, r) for r in ranks if before <= r < before + p["n"]]
        before += p["n"]
    asked = rows.sparkSession.createDataFrame(wanted, "part int, k long, rank long")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    near = sorted_.where(F.col("part").isin([w[0] for w in wanted])).withColumn("upto", upto)
    hit = near.join(F.broadcast(asked), "part").where((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
    found = {r["rank"]: r["v"] for r in hit.select("rank", "v").collect()}
    return [found[math.floor(x)] + (x - math.floor(x)) * (found[math.ceil(x)] - found[math.floor(x)]) for x in places]


def log_scale(rows: DataFrame, density: Column) -> list[float | None]:
    """Percentiles 5 and 95 of the logarithm of a density."""
    return quantiles(rows, F.log1p(F.greatest(density, F.lit(0.0))), 0.05, 0.95)


def regularity(rows: DataFrame, error: Column, tolerance: float) -> tuple[float, int]:
    """(regularity, off_lattice): one over percentile 75 of the placement errors, and how many exceed the tolerance; without rows (0, 0)."""
    (p75,) = quantiles(rows, error, 0.75)
    off = rows.where(error > tolerance).count()
    return (0.0 if p75 is None else 1.0 / max(p75, 1e-6)), off


def auto_max_radius(q10: Column, q90: Column, least: int = 500) -> Column:
    """Largest radius by the spread of densities: fixed steps, clamped, to fifties (halves to even)."""
    ratio = q90 / F.greatest(q10, F.lit(1.0))
    more = F.when(ratio >= 60, 1400).when(ratio >= 30, 1200).when(ratio >= 15, 1000).when(ratio >= 8, 800).otherwise(600)
    raw = F.least(F.lit(2500), F.greatest(F.lit(least + 200), F.lit(least) + more))
    return (F.rint(raw / 50.0) * 50).cast("int")


def color_range(values: DataFrame, c: str) -> DataFrame:
    """Percentiles 2 and 98; all values' range for fewer than five or where those coincide; never of length zero."""
    a, b = (F.lit(v).cast("double") for v in quantiles(values, F.col(c), 0.02, 0.98))
    s = values.agg(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).withColumns({"a": a, "b": b})
    robust = (F.col("n") >= 5) & (F.col("b") > F.col("a"))
    s = s.select("lo", F.when(robust, F.col("a")).otherwise(F.col("lo")).alias("x"), F.when(robust, F.col("b")).otherwise(F.col("hi")).alias("y"))
    flat = F.abs(F.col("x") - F.col("y")) <= 1e-9 * F.greatest(F.abs("x"), F.abs("y"))
    return s.select(F.when(flat, F.col("lo")).otherwise(F.col("x")).alias("scale_min"), F.when(flat, F.col("lo") + 1.0).otherwise(F.col("y")).alias("scale_max"))


def cover_metrics(counts: DataFrame, c: str = "n_cover", n: str | None = None) -> DataFrame:
    """(overlap_ratio, mean_multiplicity, uncovered); without samples (1, 0, 0).  ``n``: how many samples a row stands for, one if left out."""
    n = F.col(n) if n else F.lit(1)
    total = F.nullif(F.sum(n).cast("double"), F.lit(0.0))
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col(c) >= 2, n).otherwise(0)) / total, F.lit(1.0)).alias("overlap_ratio"),
        F.coalesce(F.sum(F.col(c) * n) / total, F.lit(0.0)).alias("mean_multiplicity"),
        F.coalesce(F.sum(F.when(F.col(c) == 0, n).otherwise(0)), F.lit(0)).cast("long").alias("uncovered"),
    )


def center_and_box(rows: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    return rows.agg(F.avg(lat).alias("center_lat"), F.avg(lng).alias("center_lng"), F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"), F.min(lng).alias("min_lng"), F.max(lng).alias("max_lng"))


def best(candidates: DataFrame, *keys: Column) -> DataFrame:
    """The first candidate by these keys (the last key should be the order of testing)."""
    return candidates.orderBy(*keys).limit(1)
