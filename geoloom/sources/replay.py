"""Search and detail services replayed from tables, so that collection runs without a network.

A live connector has the same shape: a function from a batch of requests to rows
of the log.  Requests are dealt to ``lanes`` partitions; with a pause in each, the
rate is lanes over pause.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.spots import dealt, first_places, listed
from ..session import cut

LOG = "seed_index int, source string, page int, pos int, place_id string, lat double, lng double, next_token string"
PAGE = 20


def nearby(seeds: DataFrame, places: DataFrame, most: int = PAGE) -> DataFrame:
    """Strict circle, the first ``most`` places by their order ``k``."""
    found = first_places(seeds, places, most)
    return found.select(F.col("input_index").alias("seed_index"), *_nearby(F.col("rank")))


def text_search(seeds: DataFrame, places: DataFrame, cap: int = 60, page: int = PAGE, reach_factor: float = 2.0) -> DataFrame:
    """Paged search that prefers the circle but isn't held to it: places inside first, then those around it, each by their order ``k``.

    A page has a token for the next one as long as there is more; the service ends at ``cap`` results.
    """
    found = _numbered(_around(seeds, places, cap, reach_factor))
    return found.select(F.col("input_index").alias("seed_index"), *_paged(page))


def searches(seeds: DataFrame, places: DataFrame, cap: int = 60, most: int = PAGE, page: int = PAGE, reach_factor: float = 2.0) -> DataFrame:
    """The log of both searches, ``nearby`` and ``text_search``, from one ranking.

    Both rank the places inside the circle by their order, so the nearby answers are
    the first of the text search's that lie inside.
    """
    if most > cap:
        return nearby(seeds, places, most).unionByName(text_search(seeds, places, cap, page, reach_factor))
    found = _numbered(_around(seeds, places, cap, reach_factor))
    both = F.when((F.col("rank") <= most) & ~F.col("before"), F.array(F.struct(*_paged(page)), F.struct(*_nearby(F.col("rank"))))).otherwise(F.array(F.struct(*_paged(page))))
    return found.select(F.col("input_index").alias("seed_index"), F.inline(both))


def _around(seeds: DataFrame, places: DataFrame, cap: int, reach_factor: float) -> DataFrame:
    """The first ``cap`` places of each seed, inside the circle first; only seeds with fewer inside look around it."""
    lists = cut(listed(places, cap))
    inside = cut(first_places(seeds, places, cap, lists=lists))
    rest = seeds.join(inside.groupBy("input_index").agg(F.count(F.lit(1)).alias("_n")), "input_index", "left").where(F.coalesce("_n", F.lit(0)) < cap)
    rest = cut(rest.select("input_index", "lat", "lng", "radius", F.coalesce("_n", F.lit(0)).cast("int").alias("_n")))
    around = first_places(rest.drop("_n"), places, cap, reach_factor, within=F.col("distance") > F.col("radius"), lists=lists)
    around = around.join(rest.select("input_index", "_n"), "input_index").where(F.col("rank") + F.col("_n") <= cap)
    around = around.withColumns({"rank": F.col("rank") + F.col("_n"), "before": F.lit(True)}).drop("_n")
    return inside.unionByName(around)


def _numbered(found: DataFrame) -> DataFrame:
    return dealt(found, "input_index").withColumn("last", F.max("rank").over(Window.partitionBy("input_index")))


def _nearby(rank: Column) -> list[Column]:
    """The columns of the log after the seed's, of a nearby answer."""
    return [F.lit("nearby").alias("source"), F.lit(0).alias("page"), rank.alias("pos"), F.col("place_id"), F.col("s_lat").alias("lat"), F.col("s_lng").alias("lng"), F.lit(None).cast("string").alias("next_token")]


def _paged(size: int) -> list[Column]:
    """The columns of the log after the seed's, of a text search's answer."""
    page = F.floor((F.col("rank") - 1) / size).cast("int")
    token = F.when(F.col("last") > (page + 1) * size, F.concat(F.lit("t"), (page + 1).cast("string")))
    return [F.lit("text").alias("source"), page.alias("page"), (F.col("rank") - page * size).cast("int").alias("pos"), F.col("place_id"), F.col("s_lat").alias("lat"), F.col("s_lng").alias("lng"), token.alias("next_token")]


def requested(requests: DataFrame, call: Callable[[dict], list[dict]], schema: str = LOG, lanes: int = 4, pause_s: float = 0.2) -> DataFrame:
    """Rows that a service gives for each request, with ``error`` null.

    A request that fails gives one row that has only those columns that the
    request has too, and the error's text, so that failures can be counted; an
    empty answer gives no row.  The pause follows every request, failed ones too.
    Credentials come from ``call``'s own configuration.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                try:
                    rows += [{**a, "error": None} for a in call(r) or []]
                except (OSError, ValueError) as e:
                    rows.append({**{c: r.get(c) for c in names}, "error": f"{type(e).__name__}: {e}"})
                time.sleep(pause_s)
            if rows:
                yield pd.DataFrame(rows, columns=[*names, "error"])

    return requests.repartition(lanes).mapInPandas(run, f"{schema}, error string")


def request_counts(answers: DataFrame) -> DataFrame:
    """One row: rows answered, requests failed."""
    return answers.agg(F.count_if(F.col("error").isNull()).alias("answered"), F.count("error").alias("failed"))
