"""Geographic views derived from the driver's tables, the same in both SQL dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEEDS = """SELECT CAST(s_suppkey + 1 AS INT) AS input_index, 18.75e0 + ((s_suppkey * 37) % 97) / 1000e0 AS lat,
 98.86e0 + ((s_suppkey * 53) % 173) / 1000e0 AS lng, CAST(500 + 25 * (s_suppkey % 57) AS INT) AS radius, s_suppkey % 3 = 0 AS collected FROM supplier"""
PLACES = """SELECT c_name AS place_id, c_custkey AS k, 18.74e0 + ((c_custkey * 7919) % 1200) / 10000e0 AS lat,
 98.85e0 + ((c_custkey * 104729) % 2000) / 10000e0 AS lng, 1e0 + (c_custkey % 41) / 10e0 AS rating FROM customer"""
CELLS = """SELECT p_partkey AS id, 98.855e0 + (p_partkey % 50) * 0.004e0 AS lon_center, 18.745e0 + ((p_partkey - p_partkey % 50) / 50) * 0.003e0 AS lat_center,
 (p_retailprice - 899e0) * 80e0 AS density FROM part WHERE p_partkey % 29 <> 0"""
#: Put before the text of a query.
WITH = f"WITH seeds AS ({SEEDS}), places AS ({PLACES}), cells AS ({CELLS})"

LAT0, LNG0 = 18.795, 98.95


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, text = {"seeds": ("supplier", SEEDS), "places": ("customer", PLACES), "cells": ("part", CELLS)}[name]
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))
