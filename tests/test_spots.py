"""Rows that share spots: each pair of spots is measured once, and the answers are those of all pairs of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.operators import spots as O


def test_copies_at_few_spots(spark):
    """900 million pairs of rows, of 36 spots."""
    seeds = spark.range(3000).select(F.col("id").alias("input_index"), F.lit(1000).alias("radius"), (18.0 + F.col("id") % 6 / 1e4).alias("lat"), F.lit(98.0).alias("lng"))
    places = spark.range(300_000).select(F.concat(F.lit("p"), "id").alias("place_id"), F.col("id").alias("k"), (18.0 + F.col("id") % 6 / 1e4).alias("lat"), F.lit(98.0).alias("lng"))
    met = O.reached(seeds, O.placed(places).groupBy(*O.AT).agg(F.count(F.lit(1)).alias("n")))
    n = met.groupBy("input_index").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("spots"))
    assert [tuple(r) for r in n.groupBy("n", "spots").count().collect()] == [(300_000, 6, 3000)]
    first = O.first_places(seeds, places, 9)
    assert [(r["rank"], r["k"], r["count"]) for r in first.groupBy("rank", "k").count().orderBy("rank").collect()] == [(i + 1, i, 3000) for i in range(9)]


def test_first_places_against_all_pairs(spark):
    """Spots of one to many places, fewer and more spots than are asked for, an order that mixes them."""
    import random

    from geoloom.operators.joins import pairs_on_sphere

    rnd = random.Random(5)
    at = [(18 + rnd.random() / 20, 98 + rnd.random() / 20) for _ in range(40)]
    places = [(f"p{k}", k, *at[min(int(rnd.expovariate(0.2)), 39)]) for k in rnd.sample(range(5000), 600)]
    seeds = [(i, rnd.choice((300, 900, 2000)), *at[rnd.randrange(40)]) for i in range(60)]
    p = spark.createDataFrame(places, "place_id string, k long, lat double, lng double")
    s = spark.createDataFrame(seeds, "input_index int, radius int, lat double, lng double")
    every = pairs_on_sphere(s.select("input_index", "radius", F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng")), O.placed(p, "place_id", "k"), 4000.0)
    rows = [tuple(r) for r in every.where("distance <= 2 * radius").select("input_index", F.col("distance") > F.col("radius"), "k", "place_id").collect()]
    for most in (3, 25):
        want = {i: [r[3] for r in sorted(r for r in rows if r[0] == i)[:most]] for i in {r[0] for r in rows}}
        got = O.first_places(s, p, most, 2.0, F.col("distance") > F.col("radius")).orderBy("input_index", "rank").collect()
        assert {i: [r["place_id"] for r in got if r["input_index"] == i] for i in {r["input_index"] for r in got}} == want


def test_steps_by_place(spark):
    """Copies at a place, circles in larger ones and polygons far away cost no rows of their own."""
    from geoloom.operators import arcs, joins, polygons

    copies = spark.range(20_000).select("id", (F.col("id") % 4).cast("double").alias("px"), F.lit(0.0).alias("py"))
    circles = spark.range(20_000).select(F.col("id").alias("c"), (F.col("id") % 2).cast("double").alias("sx"), F.lit(0.0).alias("sy"), (1.0 + F.col("id") % 5).alias("sr"))
    got = joins.coverage_and_nearest(copies, circles, "id", "c").groupBy("nearest").count()
    assert sorted(map(tuple, got.collect())) == [(0.0, 10_000), (1.0, 5000), (2.0, 5000)]
    outer = arcs.outer_circles(circles.select(F.col("c").alias("circle"), F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("sr").alias("r")))
    assert sorted((r["x"], r["r"]) for r in outer.collect()) == [(0.0, 5.0), (1.0, 5.0)]
    near = joins.nearest_norm(circles.select("c", F.col("sx").alias("px"), F.col("sy").alias("py"), F.col("sr").alias("pr")), circles.withColumnRenamed("c", "o"), "c", "o")
    assert [tuple(r) for r in near.groupBy("nn").count().collect()] == [(0.0, 20_000)]
    square = [(0.0, -1.0, 2.5, -1.0), (2.5, -1.0, 2.5, 1.0), (2.5, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, -1.0)]
    edges = spark.createDataFrame([(p, a + 100 * p, b, c + 100 * p, d) for p in range(50) for a, b, c, d in square], "polygon int, x1 double, y1 double, x2 double, y2 double")
    places = copies.select("px", "py").distinct()
    assert [r[0] for r in polygons._beside(edges, places, 0.1).select("polygon").distinct().collect()] == [0]
    assert polygons.containing(copies, edges, "id", "px", "py").count() == 15_000
