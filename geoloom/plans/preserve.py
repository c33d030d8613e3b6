"""Carrying the ``collected`` flag over from an earlier plan: exact keys first, then nearest one-to-one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import project, round6
from ..operators.joins import greedy_match, pairs_on_plane
from ..operators.windows import first_seen


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_klat": round6(F.col("lat")), "_klng": round6(F.col("lng"))})


def merged_flags(old: DataFrame) -> DataFrame:
    """One row for each key: collected if any of its rows was."""
    return _keyed(old).groupBy("_klat", "_klng").agg(F.bool_or("collected").alias("collected")).select(F.col("_klat").alias("lat"), F.col("_klng").alias("lng"), "collected")


def exact_flags(new: DataFrame, old: DataFrame) -> DataFrame:
    """New rows whose rounded place is an old key; several new rows may share one."""
    m = merged_flags(old).select(F.col("lat").alias("_klat"), F.col("lng").alias("_klng"), "collected")
    return _keyed(new).join(m, ["_klat", "_klng"]).select(*new.columns, "collected")


def preserve(new: DataFrame, old: DataFrame, limit_m: float, lat0: float, lng0: float) -> DataFrame:
    """``new`` (new_id, lat, lng) with ``collected`` and ``match`` (exact, nearest, none).

    Rows without an exact key are matched one to one by ascending distance to the
    old keys that no new row has, within ``limit_m``; a nearest match takes the
    flag of the first old row of its key.  ``old`` needs an ordinal.
    """
    exact = exact_flags(new, old).select("new_id", "collected")
    rest = new.join(exact.select("new_id"), "new_id", "left_anti")
    first = first_seen(_keyed(old), ["_klat", "_klng"], ["ordinal"])
    free = first.join(_keyed(new).select("_klat", "_klng").distinct(), ["_klat", "_klng"], "left_anti")
    near = new.select("new_id").limit(0).withColumns({"collected": F.lit(False)})
    if limit_m > 0:
        px, py = project(F.col("lat"), F.col("lng"), lat0, lng0)
        a = rest.select("new_id", px.alias("px"), py.alias("py"))
        b = free.select(F.col("ordinal").alias("old_id"), px.alias("sx"), py.alias("sy"))
        matched = greedy_match(pairs_on_plane(a, b, limit_m).select("new_id", "old_id", "d2"))
        near = matched.join(free.select(F.col("ordinal").alias("old_id"), "collected"), "old_id").select("new_id", "collected")
    flags = exact.withColumn("match", F.lit("exact")).unionByName(near.withColumn("match", F.lit("nearest")))
    return new.join(flags, "new_id", "left").withColumns({"collected": F.coalesce("collected", F.lit(False)), "match": F.coalesce("match", F.lit("none"))})
