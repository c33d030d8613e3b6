"""Distance joins on the sphere by the spots that rows share.

Seeds and places repeat their coordinates, so a distance is one of a pair of spots,
not of each pair of rows.  A spot knows how many rows it has and the first of them
in order; rows themselves are read for answers only.  The work grows with the
pairs of spots and of seeds with spots, not with the pairs of seeds and places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from .joins import pairs_on_sphere
from .windows import top

AT = ["s_lat", "s_lng"]


def dealt(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows over all partitions of a shuffle: they come from few files, and each of them gives many more."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def placed(places: DataFrame, *columns: str) -> DataFrame:
    """The places' columns, with s_lat and s_lng."""
    return places.select(*columns, F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng"))


def reached(seeds: DataFrame, spots: DataFrame, factor: float = 1.0) -> DataFrame:
    """(input_index, radius, distance, the spots' columns): spots (s_lat, s_lng) within ``factor`` radiuses of each seed."""
    return _met(seeds, spots, factor).drop("p_lat", "p_lng")


def _met(seeds: DataFrame, spots: DataFrame, factor: float) -> DataFrame:
    """``reached`` with the seeds' own spots (p_lat, p_lng), by which its rows are dealt."""
    own = seeds.select("input_index", "radius", F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    sites = dealt(own, "p_lat", "p_lng").groupBy("p_lat", "p_lng").agg(F.max("radius").alias("_most"))
    reach = float(seeds.agg(F.max("radius")).first()[0] or 1) * factor
    # spots are few rows, each of which meets many sites: left to their bytes, one task would measure all pairs
    near = pairs_on_sphere(sites.withColumn("_most", F.col("_most") * factor), dealt(spots), reach, own="_most").drop("_most")
    return near.join(dealt(own, "p_lat", "p_lng").hint("merge"), ["p_lat", "p_lng"]).where(F.col("distance") <= F.col("radius") * factor)


def listed(places: DataFrame, most: int, order: str = "k") -> DataFrame:
    """(s_lat, s_lng, _ks): the first ``most`` places of each spot in their order, as structs (order, place_id)."""
    rows = top(dealt(placed(places, "place_id", order), *AT), AT, [order, "place_id"], most, "i")
    return rows.groupBy(*AT).agg(F.array_sort(F.collect_list(F.struct(order, "place_id"))).alias("_ks"))


def first_places(seeds: DataFrame, places: DataFrame, most: int, factor: float = 1.0, before: Column | None = None, order: str = "k", within: Column | None = None, lists: DataFrame | None = None) -> DataFrame:
    """(input_index, radius, distance, before, order, place_id, s_lat, s_lng, rank): the first ``most`` places in reach of each seed, by ``before`` (of radius and distance), then ``order``.

    ``within`` (of radius and distance) narrows the reach; ``lists``: what ``listed``
    gives for the places, if it is there already.  The first ``most`` spots by their
    first places hold all that count.  If these are m spots of j places at least, and
    m times j is ``most`` or more, no place after the last of their j-th ones counts;
    so few places are read beyond those, and a seed that needs none but the spots'
    first places has its answer in these spots' order.  An input_index has one spot.
    """
    lists = cut(listed(places, most, order)) if lists is None else lists
    head = F.get("_ks", F.lit(0))
    first = lists.select(*AT, head[order].alias("_k"), head["place_id"].alias("place_id"), F.get("_ks", F.lit(1))[order].alias("_second"))
    met = _met(seeds, first, factor).where(F.lit(True) if within is None else within)
    # a seed's rows are together already, by its spot
    seed = ["input_index", "p_lat", "p_lng"]
    spots = top(met.withColumn("before", F.lit(False) if before is None else before), seed, ["before", "_k"], most, "_spot")
    each = Window.partitionBy(*seed)
    spots = spots.withColumns({"_n": F.count(F.lit(1)).over(each), "_last": F.max(F.struct("before", F.col("_k").alias("k"))).over(each)})
    # m times j with j = 1: only second places up to the last spot's first one count besides
    again = F.col("_second").isNotNull() & ((F.col("_n") < most) | (F.struct("before", F.col("_second").alias("k")) <= F.col("_last")))
    own = ["input_index", "radius", "distance", "before", *AT]
    spots = cut(spots.select(*own, "_k", "place_id", "_spot", "_n", F.max(again).over(each).alias("_more")))
    # few seeds are left; each of their spots meets the list of its places: for its j-th place first, so that no list is shuffled by seeds
    each, x = Window.partitionBy("input_index"), F.col("_x")
    more = spots.where("_more").withColumn("_j", F.ceil(F.lit(most) / F.col("_n")).cast("int"))
    more = more.join(lists, AT).select(*own, F.get("_ks", F.col("_j") - 1)[order].alias("k"))
    last = F.when(F.count("k").over(each) == F.count(F.lit(1)).over(each), F.max(F.struct("before", "k")).over(each))
    more = more.withColumn("_last", last).join(lists, AT).select(*own, "_last", F.explode("_ks").alias("_x")).where(F.col("_last").isNull() | (F.struct("before", x[order].alias("k")) <= F.col("_last")))
    more = more.select(*own, x[order].alias(order), x["place_id"].alias("place_id"))
    best = top(more, ["input_index"], ["before", order], most)
    return best.unionByName(spots.where("NOT _more").select(*own, F.col("_k").alias(order), "place_id", F.col("_spot").alias("rank")))
