"""Order-dependent rules as windows: first seen, first success, top of a seed, repeated tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_seen(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top(rows: DataFrame, keys: list[str], order: list[Column | str], n: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def attempts(rows: DataFrame, key: str, order: list[str], success: str = "success") -> DataFrame:
    """``outcome`` of each row: written (first success), duplicate (after one), error."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col(success).cast("int")).over(w), F.lit(0))
    return rows.withColumn("outcome", F.when(before > 0, "duplicate").when(F.col(success), "written").otherwise("error"))


def before_repeated_token(rows: DataFrame, keys: list[str], page: str = "page", token: str = "next_token") -> DataFrame:
    """Rows of the pages up to the first whose token is empty or that of the page before; all rows of a page have its token."""
    before = Window.partitionBy(*keys).orderBy(page).rangeBetween(Window.unboundedPreceding, -1)
    last = F.coalesce(F.nullif(F.trim(token), F.lit("")), F.lit("")) == ""
    flagged = rows.withColumn("_stop", last | F.col(token).eqNullSafe(F.last(token).over(before)))
    return flagged.withColumn("_stops", F.coalesce(F.max("_stop").over(before), F.lit(False))).where("NOT _stops").drop("_stop", "_stops")
