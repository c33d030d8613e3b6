"""The collection at size: one ranking for both searches, distances by all tasks, little state in the stream."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from geoloom.operators import spots as O
from geoloom.operators.windows import before_repeated_token
from geoloom.plans import collect
from geoloom.sources import replay
from geoloom.streaming.places import FirstSuccess


def test_both_searches_from_one_ranking(spark):
    rnd = random.Random(9)
    at = [(18 + rnd.random() / 20, 98 + rnd.random() / 20) for _ in range(50)]
    places = spark.createDataFrame([(f"p{k}", k, *at[min(int(rnd.expovariate(0.1)), 49)]) for k in rnd.sample(range(5000), 500)], "place_id string, k long, lat double, lng double")
    seeds = spark.createDataFrame([(i, rnd.choice((100, 900, 2500)), *at[rnd.randrange(50)]) for i in range(40)], "input_index int, radius int, lat double, lng double")
    both = replay.searches(seeds, places, 30, 7, 10)
    apart = replay.nearby(seeds, places, 7).unionByName(replay.text_search(seeds, places, 30, 10))
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    # against all spots of the old way: inside first, then around, by k
    whole = O.first_places(seeds, places, 30, 2.0, F.col("distance") > F.col("radius")).select("input_index", "rank", "place_id")
    text = both.where("source = 'text'").select("seed_index", (F.col("page") * 10 + F.col("pos")).alias("rank"), "place_id")
    assert sorted(map(tuple, text.collect())) == sorted(map(tuple, whole.collect()))


def test_distances_by_all_tasks(spark):
    """Few spots that meet many sites: no task measures more than its share."""
    seeds = spark.range(400).select(F.col("id").cast("int").alias("input_index"), F.lit(3000).alias("radius"), (18 + F.col("id") / 1e5).alias("lat"), F.lit(98.0).alias("lng"))
    sites = spark.range(400).select((18 + F.col("id") / 1e5).alias("s_lat"), F.lit(98.0).alias("s_lng"))
    met = O.reached(seeds, sites.coalesce(1))
    assert met.count() == 160_000
    assert "REPARTITION_BY_NUM" in O.reached(seeds, sites)._jdf.queryExecution().executedPlan().toString().split("_most", 1)[1]


def test_places_meet_answers_not_tries(spark):
    """Answers don't go through a window of all tries; each place comes with its first try, and pages end where their token does."""
    rnd = random.Random(4)
    log = [(i, "text", p, n, f"p{rnd.randrange(300)}", 0.0, 0.0, f"t{p + (p < 4)}") for i in range(50) for p in range(6) for n in range(9)]
    log += [(i, "nearby", 0, n, f"p{rnd.randrange(300)}", 9.0, 9.0, None) for i in range(60) for n in range(5)]
    log = spark.createDataFrame(rnd.sample(log, len(log)), replay.LOG)
    seeds = spark.createDataFrame([(i, 0.0, 0.0, 900 if i % 7 else 0, i % 5) for i in range(50)], "input_index int, lat double, lng double, radius int, x int")
    details = spark.createDataFrame([(f"p{i}", "{}" if i % 3 else "[]") for i in range(290)], "place_id string, payload string")
    places, outcomes = collect.collected(log, seeds, details, 20)
    plan = places._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert sorted(tuple(r)[:3] for r in places.collect()) == sorted(tuple(r)[:3] for r in outcomes.where("outcome = 'written'").collect())
    # by hand: page 5 has the token of page 4, so nothing comes after it; ids once, nearby first, the cap for texts
    want = []
    for i in range(60):
        own = sorted((r for r in log.collect() if r.seed_index == i), key=lambda r: (r.source, r.page, r.pos)) if i < 3 else []
        seen = list(dict.fromkeys((r.place_id) for r in own))
        near = len({r.place_id for r in own if r.source == "nearby"})
        want += [(i, n, p) for n, p in enumerate(seen, 1) if n <= max(near, 20)]
    assert sorted(tuple(r)[:3] for r in outcomes.where("seed_index < 3").collect()) == sorted(want)
    pages = spark.createDataFrame([(1, p, n, t) for p, t in enumerate(["a", "b", "b", "c"]) for n in range(3)], "s int, page int, pos int, next_token string")
    assert sorted(r.page for r in before_repeated_token(pages, ["s"]).collect()) == [0, 0, 0, 1, 1, 1, 2, 2, 2]


class _State:
    def __init__(self):
        self.v, self.calls = None, 0

    def get(self):
        return self.v if not isinstance(self.v, list) else iter(self.v)

    def update(self, v):
        self.v = v

    def appendList(self, v):  # noqa: N802
        self.v = (self.v or []) + v

    def clear(self):
        self.v = None


class _Handle:
    def __init__(self, now=0):
        self.timers, self.now = [], now

    def getListState(self, *_):  # noqa: N802
        return _State()

    getValueState = getListState

    def registerTimer(self, t):  # noqa: N802
        self.timers.append(t)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.now


def test_duplicates_leave_the_stream_at_once():
    h, p = _Handle(), FirstSuccess(1000)
    p.init(h)
    t = lambda s: dt.datetime.fromtimestamp(s)
    out = list(p.handleInputRows(("a",), iter([(5, 1, "a", True, t(1)), (7, 1, "a", False, t(2)), (3, 1, "a", False, t(1))]), h))
    assert [tuple(r) for r in out] == [(7, 1, "a", "duplicate")]
    out = list(p.handleInputRows(("a",), iter([(4, 2, "a", True, t(9)), (4, 3, "a", True, t(9))]), h))
    assert sorted(tuple(r) for r in out) == [(4, 3, "a", "duplicate"), (5, 1, "a", "duplicate")]
    assert h.timers == [3000]
    h.now = 3000
    assert not list(p.handleExpiredTimer(("a",), h, None)) and h.timers == [3000, 10_000]
    h.now = 10_000
    assert sorted(tuple(r) for r in p.handleExpiredTimer(("a",), h, None)) == [(3, 1, "a", "error"), (4, 2, "a", "written")]
    assert p.known.get() is None and p.failed.get() is None
