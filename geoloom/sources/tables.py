"""Scans of seeds, circles, boundaries, cells and places, with the checks that each needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dynamic as D
from ..operators.validity import circle_valid, density_valid, seed_reason


class InputError(ValueError):
    """An input that can't be used at all."""


def json_array(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """(input_index, item) of a file that holds one JSON array; ``tolerant``: anything else gives no row."""
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    good = doc.where(F.col("v").isNotNull() & D.kind(F.col("v")).startswith("ARRAY"))
    if not tolerant and good.isEmpty():
        raise InputError(f"{path}: not a JSON array")
    return good.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select((F.col("pos") + 1).alias("input_index"), F.col("value").alias("item"))


def _field(name: str) -> Column:
    return F.try_variant_get(F.col("item"), f"$.{name}", "variant")


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """(input_index, lat, lng, radius, reason); ``reason`` is null for valid seeds."""
    rows = json_array(spark, path).withColumn("is_object", D.kind(F.col("item")).startswith("OBJECT"))
    rows = rows.select("input_index", "is_object", *[D.to_float(_field(c)).alias(c) for c in ("lat", "lng", "radius")])
    return rows.withColumn("reason", seed_reason(F.col("is_object"), F.col("lat"), F.col("lng"), F.col("radius"))).drop("is_object")


def circles(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Valid circles (input_index, lat, lng, radius, collected, population_density)."""
    rows = json_array(spark, path, tolerant).where(D.kind(F.col("item")).startswith("OBJECT"))
    rows = rows.select("input_index", *[D.to_float(_field(c)).alias(c) for c in ("lat", "lng", "radius")], D.to_bool(_field("collected")).alias("collected"), D.to_float(_field("population_density")).alias("population_density"))
    return rows.where(circle_valid(F.col("lat"), F.col("lng"), F.col("radius"), F.col("collected")))


def csv_table(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """All columns as text; a byte order mark doesn't stick to the first name; line feeds inside quotes are kept."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    if missing := set(required) - set(df.columns):
        raise InputError(f"{path}: no column {', '.join(sorted(missing))}")
    return df


def cell_rows(spark: SparkSession, path: str) -> DataFrame:
    """(lon_center, lat_center, population_density) of all rows, null where a text is no number."""
    names = ("lon_center", "lat_center", "population_density")
    return csv_table(spark, path, names).select(*[D.text_to_float(F.col(c)).alias(c) for c in names])


def cells(spark: SparkSession, path: str) -> DataFrame:
    """Density cells (lon_center, lat_center, population_density); malformed ones go, none left is fatal."""
    df = cell_rows(spark, path)
    df = df.where(density_valid(F.col("lat_center"), F.col("lon_center"), F.col("population_density")))
    if df.isEmpty():
        raise InputError(f"{path}: no valid cell")
    return df


def places(spark: SparkSession, path: str) -> DataFrame:
    df = csv_table(spark, path, ("lat", "lon"))
    return df.withColumns({c: D.text_to_float(F.col(c)) for c in ("lat", "lon")})


def boundary(spark: SparkSession, path: str) -> list:
    """Region (polygons of rings of (x, y)) of the first feature of a GeoJSON feature collection.

    A boundary is configuration of bounded size: its coordinates come to the driver.
    """
    row = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v")).select(
        F.try_variant_get("v", "$.type", "string").alias("type"), F.try_variant_get("v", "$.features[0].geometry.type", "string").alias("kind"),
        F.to_json(F.try_variant_get("v", "$.features[0].geometry.coordinates", "variant")).alias("coordinates"),
    ).first()
    return region_of(row["type"], row["kind"], row["coordinates"], path)


def region_of(kind: str | None, geometry: str | None, coordinates: str | None, path: str = "") -> list:
    import json

    if kind != "FeatureCollection" or geometry not in ("Polygon", "MultiPolygon") or not coordinates:
        raise InputError(f"{path}: not a feature collection whose first feature is a polygon")
    found = json.loads(coordinates)
    polygons = [found] if geometry == "Polygon" else found
    out = [[[(float(p[0]), float(p[1])) for p in ring] for ring in polygon] for polygon in polygons if polygon]
    if not out:
        raise InputError(f"{path}: the boundary is empty")
    return out


def relations(spark: SparkSession, path: str, required: list[int]) -> dict[int, list]:
    """Regions by relation id from JSON rows (osm_type, osm_id, geojson); fatal if a required one is missing."""
    import json

    rows = json_array(spark, path).where((F.try_variant_get("item", "$.osm_type", "string") == "relation") & (D.kind(_field("osm_id")) == "BIGINT")).select(
        F.try_variant_get("item", "$.osm_id", "long").alias("id"), F.try_variant_get("item", "$.geojson.type", "string").alias("kind"), F.to_json(_field("geojson.coordinates")).alias("c")
    )
    rows = rows.where(F.col("id").isin(required) & F.col("kind").isin("Polygon", "MultiPolygon")).collect()
    found = {r["id"]: region_of("FeatureCollection", r["kind"], r["c"], path) for r in rows if json.loads(r["c"])}
    if missing := [i for i in required if i not in found]:
        raise InputError(f"{path}: no relation {missing}")
    return found


def coordinate_box(geojson: Column) -> Column:
    """Struct (min_lng, min_lat, max_lng, max_lat) of all pairs in nested coordinates given as JSON text; pairs have exactly two numbers in range."""
    pair = r"\[\s*(-?[0-9.eE+-]+)\s*,\s*(-?[0-9.eE+-]+)\s*\]"
    xs = F.transform(F.regexp_extract_all(geojson, F.lit(pair), F.lit(1)), lambda v: v.try_cast("double"))
    ys = F.transform(F.regexp_extract_all(geojson, F.lit(pair), F.lit(2)), lambda v: v.try_cast("double"))
    both = F.filter(F.zip_with(xs, ys, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: p["x"].between(-180, 180) & p["y"].between(-90, 90))
    x, y = F.transform(both, lambda p: p["x"]), F.transform(both, lambda p: p["y"])
    return F.when(F.size(both) > 0, F.struct(F.array_min(x).alias("min_lng"), F.array_min(y).alias("min_lat"), F.array_max(x).alias("max_lng"), F.array_max(y).alias("max_lat")))
