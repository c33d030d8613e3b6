"""Collection as set operations over a log of discoveries.

A log row is one place that a seed's search returned: (seed_index, source, page,
pos, place_id, lat, lng).  Per seed, nearby results come before text pages, text
results must lie within the radius, ids are taken once, and text stops at the
cap.  Over all seeds in order, an id is asked for until its details succeed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dynamic as D
from ..functions.scalars import haversine
from ..functions.text import earliest_date
from ..operators.windows import attempts, before_repeated_token
from ..session import cut

SEED_CAP, REVIEW_SLOTS = 60, 5
#: Columns of the places table, in order.
PLACE_COLUMNS = ("place_id", "name", "lat", "lon", "average_rating", "total_review_count", "earliest_available_review_date", *[f"review_{i}_text" for i in range(1, REVIEW_SLOTS + 1)])


def discovered(log: DataFrame, seeds: DataFrame, cap: int = SEED_CAP) -> DataFrame:
    """(seed_index, ord, place_id): ids of each seed in order of discovery.

    The nearby search is strict on the service's side; text results are filtered
    here, as the service only prefers the circle.  The cap holds for the text stage.
    """
    # the log is read once and dealt by seeds once; pages and places in them are numbers from 0
    rows = log.withColumn("stage", F.when(F.col("source") == "nearby", 0).when(F.col("source") == "text", 1)).where("stage IS NOT NULL")
    token = F.when(F.col("stage") == 1, F.col("next_token")).otherwise(F.concat(F.lit("t"), F.col("page").cast("string")))
    rows = before_repeated_token(rows.withColumn("_token", token), ["seed_index", "stage"], token="_token")
    own = seeds.select(F.col("input_index").alias("seed_index"), F.col("lat").alias("_la"), F.col("lng").alias("_ln"), "radius")
    inside = haversine(F.col("_la"), F.col("_ln"), F.col("lat"), F.col("lng")) <= F.col("radius")
    rows = rows.join(own, "seed_index", "left").where((F.col("stage") == 0) | inside)
    rows = rows.withColumn("place_id", D.blank_to_null(F.col("place_id"))).where(F.col("place_id").isNotNull())
    at = F.shiftleft(F.shiftleft(F.col("stage").cast("long"), 31) + F.col("page"), 31) + F.col("pos")
    once = rows.groupBy("seed_index", "place_id").agg(F.min(at).alias("_at"))
    ranked = once.withColumn("ord", F.row_number().over(Window.partitionBy("seed_index").orderBy("_at")))
    return ranked.where((F.col("_at") < 1 << 62) | (F.col("ord") <= cap)).select("seed_index", "ord", "place_id")


def review_columns(texts: Column) -> list[Column]:
    """The first review texts as columns, empty where there is none."""
    return [F.coalesce(F.get(texts, F.lit(i)), F.lit("")).alias(f"review_{i + 1}_text") for i in range(REVIEW_SLOTS)]


def place_row(payload: Column, queried_id: Column) -> list[Column]:
    """The twelve columns of a place from its details (VARIANT); a missing or blank id is the queried one."""
    get = lambda p: F.try_variant_get(payload, p, "variant")
    own = F.when(D.kind(get("$.id")) == "STRING", F.try_variant_get(payload, "$.id", "string"))
    # five reviews first, then those that are objects
    listed = F.when(D.kind(get("$.reviews")).startswith("ARRAY"), F.try_variant_get(payload, "$.reviews", "array<variant>"))
    reviews = F.filter(F.slice(F.coalesce(listed, F.array().cast("array<variant>")), 1, REVIEW_SLOTS), lambda r: D.kind(r).startswith("OBJECT"))
    times = F.filter(F.transform(reviews, lambda r: F.when(D.kind(F.try_variant_get(r, "$.publishTime", "variant")) == "STRING", F.try_variant_get(r, "$.publishTime", "string"))), lambda t: t.isNotNull())
    return [
        F.coalesce(F.when(D.blank_to_null(own).isNotNull(), own), queried_id).alias("place_id"),
        D.localized_text(get("$.displayName")).alias("name"),
        F.when(D.kind(get("$.location.latitude")).rlike(D.NUMBER_KINDS), F.try_variant_get(payload, "$.location.latitude", "double")).alias("lat"),
        F.when(D.kind(get("$.location.longitude")).rlike(D.NUMBER_KINDS), F.try_variant_get(payload, "$.location.longitude", "double")).alias("lon"),
        F.when(D.kind(get("$.rating")).rlike(D.NUMBER_KINDS), F.try_variant_get(payload, "$.rating", "double")).alias("average_rating"),
        D.to_count(get("$.userRatingCount")).alias("total_review_count"),
        earliest_date(times).alias("earliest_available_review_date"),
        *review_columns(F.transform(reviews, D.review_text)),
    ]


def _answers(ids: DataFrame, details: DataFrame) -> DataFrame:
    """(place_id, v): answers for the ids asked for that are objects; only those are made and parsed."""
    asked = cut(details.join(ids, "place_id", "left_semi"))
    answers = asked.withColumn("v", F.try_parse_json("payload")).where(F.col("v").isNotNull() & D.kind(F.col("v")).startswith("OBJECT"))
    return answers.select("place_id", "v").dropDuplicates(["place_id"])


def tried(found: DataFrame, details: DataFrame) -> DataFrame:
    """(seed_index, ord, place_id, success): what each request for details of ``discovered`` ids gives.  ``details``: (place_id, payload as JSON text); an id fails where it has none or it isn't an object."""
    answers = _answers(found.select("place_id").distinct(), details).select("place_id", F.lit(True).alias("success"))
    return found.join(answers, "place_id", "left").withColumn("success", F.coalesce("success", F.lit(False)))


def outcomes(found: DataFrame, details: DataFrame) -> DataFrame:
    """(seed_index, ord, place_id, outcome) of ``discovered`` ids."""
    return attempts(tried(found, details), "place_id", ["seed_index", "ord"]).select("seed_index", "ord", "place_id", "outcome")


def written(found: DataFrame, details: DataFrame) -> DataFrame:
    """(seed_index, ord, the places' columns): places that are written, with the try that does it.

    An id's details are the same at each try, so its first try writes it or none does: answers meet ids, not tries.
    """
    first = cut(found.groupBy("place_id").agg(F.min("seed_index").alias("seed_index"), F.min_by("ord", "seed_index").alias("ord")))
    answers = _answers(first.select("place_id"), details)
    return first.join(answers, "place_id").select("seed_index", "ord", *place_row(F.col("v"), F.col("place_id")))


def collected(log: DataFrame, seeds: DataFrame, details: DataFrame, cap: int = SEED_CAP) -> tuple[DataFrame, DataFrame]:
    """(places, outcomes)."""
    found = cut(discovered(log, seeds, cap))
    return written(found, details), outcomes(found, details)


def summary(outcomes: DataFrame) -> DataFrame:
    """One row of counters."""
    n = lambda k: F.count_if(F.col("outcome") == k)
    return outcomes.agg(F.count(F.lit(1)).alias("discovered"), n("written").alias("written"), n("duplicate").alias("duplicates"), n("error").alias("details_errors"))
