"""Which rows are usable, and why others aren't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SEARCH_RADIUS = 50_000.0


def _outside(c: Column, most: float) -> Column:
    return F.isnan(c) | ~c.between(-most, most)


def seed_reason(is_object: Column, lat: Column, lng: Column, radius: Column) -> Column:
    """The first reason to reject a seed, in the order of the tests; null where it is valid."""
    return (
        F.when(~is_object, "not_object").when(lat.isNull() | lng.isNull() | radius.isNull(), "missing").when(_outside(lat, 90.0), "lat_range")
        .when(_outside(lng, 180.0), "lng_range").when(F.isnan(radius) | (radius <= 0) | (radius > MAX_SEARCH_RADIUS), "radius_range")
    )


def point_valid(lat: Column, lng: Column) -> Column:
    return F.coalesce(~_outside(lat, 90.0) & ~_outside(lng, 180.0), F.lit(False))


def circle_valid(lat: Column, lng: Column, radius: Column, collected: Column) -> Column:
    """No upper bound on the radius; ``collected`` must be a boolean."""
    return point_valid(lat, lng) & F.coalesce(~F.isnan(radius) & (radius > 0), F.lit(False)) & collected.isNotNull()


def density_valid(lat: Column, lng: Column, density: Column) -> Column:
    return point_valid(lat, lng) & F.coalesce(~F.isnan(density) & (density >= 0) & (density != float("inf")), F.lit(False))


def reason_counts(rows: DataFrame, reason: str = "reason") -> DataFrame:
    return rows.groupBy(F.coalesce(reason, F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
