"""Polygon joins, hierarchical searches, areas by arcs and greedy matching against brute force, with skew."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from geoloom.operators import aggregates as A
from geoloom.operators import arcs, joins, polygons, pyramid


def ring(points):
    return [(*a, *b) for a, b in zip(points, [*points[1:], points[0]], strict=True)]


def brute_covers(x, y, edges, reach=0.0):
    odd, near = False, math.inf
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
        d2 = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = max(0.0, min(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / d2)) if d2 else 0.0
        near = min(near, (x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2)
    return odd or near <= max(reach * reach, 1e-12)


def shapes(rng):
    """Lattice polygons (corners level with points), stars, slivers, a hole, two parts, one of very many edges, some of very unlike sizes."""
    out = {}
    for p in range(40):
        x, y, r = rng.randint(-20, 20), rng.randint(-20, 20), rng.choice([1, 2, 3, 8])
        n = rng.randint(3, 9)
        out[p] = ring([(x + rng.randint(-r, r), y + rng.randint(-r, r)) for _ in range(n)])
    out[100] = ring([(-20, -20), (20, -20), (20, 20), (-20, 20)]) + ring([(-10, -10), (-10, 10), (10, 10), (10, -10)]) + ring([(-5, -5), (5, -5), (5, 5), (-5, 5)])
    out[101] = ring([(0.1 * math.cos(k / 50 * math.tau) * (1 + k % 2) + 3, 0.1 * math.sin(k / 50 * math.tau) * (1 + k % 2) + 3) for k in range(50)])
    out[102] = ring([(30 * math.cos(k / 700 * math.tau) * (1 + 0.3 * (k % 2)), 30 * math.sin(k / 700 * math.tau) * (1 + 0.3 * (k % 2))) for k in range(700)])
    out[103] = ring([(-1000, 0), (1000, 0.001), (1000, 0.002)])
    out[104] = ring([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)])
    return {p: [e for e in own if e[:2] != e[2:]] for p, own in out.items()}


@pytest.mark.parametrize("reach", [0.0, 0.75])
def test_points_in_a_table_of_polygons(spark, reach):
    rng = random.Random(7)
    own = shapes(rng)
    places = [(float(rng.randint(-25, 25)), float(rng.randint(-25, 25))) for _ in range(150)] + [(rng.uniform(-40, 40), rng.uniform(-40, 40)) for _ in range(150)]
    places += [((x1 + x2) / 2, (y1 + y2) / 2) for e in own.values() for x1, y1, x2, y2 in e[:3]] + [(e[0][0], e[0][1]) for e in own.values()]
    points = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(places)], "k int, x double, y double")
    edges = spark.createDataFrame([(p, *map(float, e)) for p, es in own.items() for e in es], "polygon int, x1 double, y1 double, x2 double, y2 double")
    got = [tuple(r) for r in polygons.containing(points, edges, "k", reach=reach).collect()]
    want = {(k, p) for k, (x, y) in enumerate(places) for p, e in own.items() if brute_covers(x, y, e, reach)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500


def test_polygons_of_nothing(spark):
    none = spark.createDataFrame([], "polygon int, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 0.0, 0.0)], "k int, x double, y double")
    assert polygons.containing(points, none, "k").count() == 0
    assert polygons.containing(points.limit(0), spark.createDataFrame([(1, *map(float, e)) for e in ring([(0, 0), (1, 0), (0, 1)])], none.schema), "k").count() == 0


def skewed(rng, n):
    """Half of the places in a millionth of the square, some exactly together, the rest anywhere."""
    dense = [(500 + rng.uniform(0, 1e-3), 500 + rng.uniform(0, 1e-3)) for _ in range(n // 2)]
    return dense + [(500.0005, 500.0005)] * (n // 8) + [(rng.uniform(0, 1000), rng.uniform(0, 1000)) for _ in range(n - n // 2 - n // 8)]


def test_knn_under_skew(spark):
    rng = random.Random(11)
    sites = [(i, x, y) for i, (x, y) in enumerate(skewed(rng, 6000))]
    rng.shuffle(sites)
    points = [(k, *p) for k, p in enumerate([(500.0005, 500.0005), (499.99, 500.0), (0.0, 0.0), (1500.0, -300.0), *[(rng.uniform(499.999, 500.002), rng.uniform(499.999, 500.002)) for _ in range(25)], *[(rng.uniform(0, 1000), rng.uniform(0, 1000)) for _ in range(25)]])]
    p, s = spark.createDataFrame(points, "p int, px double, py double"), spark.createDataFrame(sites, "s int, sx double, sy double")
    have = {(r["p"], r["rank"]): r["s"] for r in joins.knn(p, s, 5, "p", "s").collect()}
    for k, x, y in points:
        want = sorted(sites, key=lambda t: ((x - t[1]) * (x - t[1]) + (y - t[2]) * (y - t[2]), t[0]))[:5]
        assert [have[k, r + 1] for r in range(5)] == [t[0] for t in want]
    # the pairs that are looked at don't grow with the dense cell
    tree = pyramid.build(s, "sx", "sy", 5, p, "px", "py")
    near = pyramid.nearest_leaves(p, tree, 5, "p")
    each = near.where(F.col("level") < pyramid.DEPTH).groupBy("p").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    assert each <= 40 * 5
    assert tree.rows.count() == len(sites) and tree.leaves.agg(F.sum("n")).first()[0] == len(sites)
    assert tree.leaves.where(F.col("level") < pyramid.DEPTH).agg(F.max("n")).first()[0] <= tree.most


def test_knn_of_few_sites(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], "p int, px double, py double")
    s = spark.createDataFrame([(7, 1.0, 1.0), (8, 1.0, 1.0)], "s int, sx double, sy double")
    assert sorted((r["p"], r["rank"], r["s"]) for r in joins.knn(p, s, 4, "p", "s").collect()) == [(1, 1, 7), (1, 2, 8), (2, 1, 7), (2, 2, 8)]
    assert joins.knn(p, s.limit(0), 4, "p", "s").count() == 0 and joins.knn(p.limit(0), s, 4, "p", "s").count() == 0


def test_coverage_under_skew(spark):
    rng = random.Random(13)
    samples = [(k, x, y) for k, (x, y) in enumerate(skewed(rng, 3000))]
    circles = [(i, rng.uniform(0, 1000), rng.uniform(0, 1000), rng.choice([0.0, 5.0, 60.0, 250.0])) for i in range(40)] + [(50, 500.0005, 500.0005, 2e-4), (51, 500.0005, 500.0005, 0.0), (52, -3000.0, 0.0, 100.0), (53, 500.0, 500.0, 5000.0)]
    s, c = spark.createDataFrame(samples, "k int, px double, py double"), spark.createDataFrame(circles, "circle int, sx double, sy double, sr double")
    over = {k: [i for i, cx, cy, r in circles if (x - cx) * (x - cx) + (y - cy) * (y - cy) <= r * r + 1e-9] for k, x, y in samples}
    assert {r["k"]: r["n_cover"] for r in joins.coverage(s, c, "k").collect()} == {k: len(v) for k, v in over.items()}
    counts = [len(v) for v in over.values()]
    assert {r["n_cover"]: r["n"] for r in joins.coverage_histogram(s, c, "k").collect()} == {n: counts.count(n) for n in set(counts)}
    got = {r["circle"]: (r["n_unique"], r["n_covered"]) for r in joins.unique_support(s, c, "k", "circle").collect()}
    assert got == {i: (sum(v == [i] for v in over.values()), sum(i in v for v in over.values())) for i, *_ in circles}
    assert {r["n_cover"] for r in joins.coverage(s, c.limit(0), "k").collect()} == {0}
    m = A.cover_metrics(joins.coverage_histogram(s.limit(0), c, "k"), n="n").first()
    assert tuple(m) == (1.0, 0.0, 0)


def test_denser_samples_open_few_more_leaves(spark):
    """A table of 16 times the samples opens about 4 times the border leaves, not 16 times the pairs."""
    rng = random.Random(17)
    circles = spark.createDataFrame([(i, rng.uniform(0, 1000), rng.uniform(0, 1000), 150.0) for i in range(12)], "circle int, sx double, sy double, sr double")
    opened = []
    for n in (1000, 16000):
        s = spark.range(n).select(F.col("id").alias("k"), (F.rand(3) * 1000).alias("px"), (F.rand(4) * 1000).alias("py"))
        cover = pyramid.covered_cells(pyramid.build(s, "px", "py", 16), circles, "circle")
        opened.append(cover.border.agg(F.sum("n")).first()[0])
    assert opened[1] < 7 * opened[0]


def union_by_slabs(circles, box, n=4000):
    """Area of a union of disks in a box, by lines."""
    x0, y0, x1, y1 = box
    total, step = 0.0, (x1 - x0) / n
    for k in range(n):
        x = x0 + (k + 0.5) * step
        spans = sorted((max(y0, cy - h), min(y1, cy + h)) for cx, cy, r in circles if abs(x - cx) < r for h in [math.sqrt(r * r - (x - cx) ** 2)])
        at = y0
        for a, b in spans:
            if b > at:
                total += (b - max(a, at)) * step
                at = b
    return total


def test_areas_by_arcs(spark):
    rng = random.Random(19)
    circles = [(i, rng.uniform(0, 100), rng.uniform(0, 100), rng.choice([3.0, 7.0, 15.0, 40.0])) for i in range(25)]
    circles += [(90, 50.0, 50.0, 1.0), (91, 50.0, 50.0, 1.0), (92, 50.0, 50.0, 2.0), (93, 300.0, 300.0, 5.0), (94, 310.0, 300.0, 5.0), (95, 0.0, 0.0, -1.0)]
    c = spark.createDataFrame(circles, "circle int, x double, y double, r double")
    disks = [t[1:] for t in circles if t[3] > 0]
    assert arcs.union_area(c).first()["area"] == pytest.approx(union_by_slabs(disks, (-60, -60, 400, 400), 20000), rel=2e-4)
    assert arcs.union_area(c.where("circle = 93")).first()["area"] == pytest.approx(25 * math.pi)
    assert arcs.union_area(c.limit(0)).first()["area"] == 0.0
    boxes = {1: (0, 0, 100, 100), 2: (20, 20, 30, 40), 3: (295, 295, 305, 305), 4: (500, 500, 501, 501), 5: (49.9, 49.9, 50.1, 50.1)}
    rows = [(p, *map(float, e)) for p, (a, b, x, y) in boxes.items() for e in ring([(a, b), (x, b), (x, y), (a, y)])]
    rows += [(6, *map(float, e)) for e in ring([(0, 0), (90, 0), (90, 90), (0, 90)]) + ring([(30, 30), (30, 60), (60, 60), (60, 30)])]
    got = {r["polygon"]: (r["area"], r["uncovered"]) for r in arcs.uncovered(spark.createDataFrame(rows, "polygon int, x1 double, y1 double, x2 double, y2 double"), c).collect()}
    for p, (a, b, x, y) in boxes.items():
        assert got[p][0] == pytest.approx((x - a) * (y - b)) and got[p][1] == pytest.approx((x - a) * (y - b) - union_by_slabs(disks, (a, b, x, y)), abs=2e-3 * (x - a) * (y - b) + 1e-9)
    left = 8100 - 900 - union_by_slabs(disks, (0, 0, 90, 90)) + union_by_slabs(disks, (30, 30, 60, 60))
    assert got[6][0] == pytest.approx(7200) and got[6][1] == pytest.approx(left, abs=8)


def sequential(pairs):
    used, out = set(), set()
    for d, n, o in sorted((d, n, o) for n, o, d in pairs):
        if ("n", n) not in used and ("o", o) not in used:
            used |= {("n", n), ("o", o)}
            out.add((n, o))
    return out


def test_a_long_chain_is_matched_in_few_rounds(spark):
    chain = [(k // 2 + k % 2, k // 2, float(k)) for k in range(10_000)]
    got = joins.greedy_match(spark.createDataFrame(chain, "new_id int, old_id int, d2 double"))
    assert {(r["new_id"], r["old_id"]) for r in got.collect()} == sequential(chain) and got.rounds <= 20


@pytest.mark.parametrize("seed", range(4))
def test_greedy_match_of_tangled_pairs(spark, seed):
    rng = random.Random(seed)
    pairs = [(a, b, float(rng.randint(0, 30))) for a, b in itertools.product(range(25), range(20)) if rng.random() < 0.25]
    pairs += [(100 + k // 2 + k % 2, 100 + k // 2, float(k % 7)) for k in range(60)] + pairs[:5] + [(0, 0, 99.0), (0, 0, 1.0)]
    got = joins.greedy_match(spark.createDataFrame(pairs, "new_id int, old_id int, d2 double"))
    rows = [(r["new_id"], r["old_id"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == sequential(pairs)
