"""Overlays of layers against a fine raster, and their connected parts."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.operators import overlay


def ring(points):
    return [(*map(float, a), *map(float, b)) for a, b in zip(points, [*points[1:], points[0]], strict=True)]


def inside(x, y, edges):
    odd = np.zeros(x.shape, bool)
    for x1, y1, x2, y2 in edges:
        if y1 != y2:
            odd ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


def brute_parts(mask):
    """Sizes of the connected groups of true cells of a raster."""
    left, out = set(zip(*np.nonzero(mask), strict=True)), []
    while left:
        todo, n = [left.pop()], 0
        while todo:
            i, j = todo.pop()
            n += 1
            for q in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                if q in left:
                    left.discard(q)
                    todo.append(q)
        out.append(n)
    return sorted(out)


def layers():
    rng = random.Random(23)
    out = {(1, k): ring([(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(7)]) for k in range(4)}  # they cross themselves and each other
    out |= {(2, 0): ring([(0, 0), (10, 0), (10, 10), (0, 10)]) + ring([(2, 2), (2, 8), (8, 8), (8, 2)]), (2, 1): ring([(4, -1), (6, -1), (6, 11), (4, 11)]), (2, 2): ring([(0, 4), (10, 4), (10, 6), (0, 6)]), (2, 3): ring([(10, 0), (10, 10), (0, 10), (0, 0)])}
    out |= {(3, 0): ring([(0, 0), (5, 0), (5, 5)]), (3, 1): ring([(5, 5), (9, 5), (9, 9)]), (3, 2): ring([(0, 9), (1, 9), (1, 10)]), (3, 3): ring([(0, 0), (5, 0), (5, 5)])}
    return out


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(z, k, *e) for (z, k), own in layers().items() for e in own]
    got = overlay.cells(spark.createDataFrame(rows, "zone int, layer int, x1 double, y1 double, x2 double, y2 double").repartition(5))
    return spark.createDataFrame(got.collect(), got.schema)


@pytest.mark.parametrize("zone", [1, 2, 3])
def test_areas_of_every_combination(cells, zone):
    n = 1400  # lines of whole numbers lie between its cells
    at = (np.arange(n) + 0.5) / n * 14 - 2
    x, y = np.meshgrid(at, at)
    mask = sum(inside(x, y, own).astype(int) << k for (z, k), own in layers().items() if z == zone)
    got = {r["mask"]: r["a"] for r in cells.where(F.col("zone") == zone).groupBy("mask").agg(F.sum(overlay.area()).alias("a")).collect() if r["a"] > 1e-9}
    want = {int(m): (mask == m).sum() * (14 / n) ** 2 for m in np.unique(mask) if m}
    assert all(got.get(m, 0) == pytest.approx(want.get(m, 0), abs=0.05) for m in got.keys() | want.keys()) and sum(got.values()) == pytest.approx(sum(want.values()), abs=0.05)


@pytest.mark.parametrize(("zone", "rule", "test"), [(1, "mask & 5 <> 0", lambda m: m & 5 != 0), (2, "mask & 1 <> 0 AND mask & 2 = 0", lambda m: (m & 1 != 0) & (m & 2 == 0)), (2, "mask & 7 = 0 OR mask & 7 = 7", lambda m: (m != 0) & ((m & 7 == 0) | (m & 7 == 7))), (3, "mask & 7 <> 0", lambda m: m & 7 != 0)])
def test_connected_parts(cells, zone, rule, test):
    n = 2800 if zone == 1 else 700  # necks of crossing rings are narrow
    at = (np.arange(n) + 0.5) / n * 14 - 2
    x, y = np.meshgrid(at, at)
    mask = test(sum(inside(x, y, own).astype(int) << k for (z, k), own in layers().items() if z == zone))
    whole, least, near = mask.copy(), 0.02, 0.06
    if zone == 1:  # parts that meet in a point alone are two: a raster sees that once its rim is taken off
        for axis, step in itertools.product((0, 1), (1, -1)):
            mask = mask & np.roll(mask, step, axis)
        least, near = 0.2, 0.4
    chosen = cells.where(F.col("zone") == zone).where(rule)
    labelled = overlay.parts(chosen)
    got = sorted(r["area"] for r in overlay.part_areas(labelled).collect() if r["area"] > least)
    want = [k * (14 / n) ** 2 for k in brute_parts(mask) if k * (14 / n) ** 2 > least]
    assert got == pytest.approx(want, abs=near)
    for r in overlay.part_areas(labelled).where("area > 0.5").collect():  # the place of a part lies in it
        j, i = (int((v + 2) / 14 * n) for v in (r["x"], r["y"]))
        assert whole[i, j]


def test_points_in_parts_and_nothing(spark, cells):
    labelled = overlay.parts(cells.where("zone = 3 AND mask & 7 <> 0"))
    points = spark.createDataFrame([(1, 4.0, 1.0), (2, 8.5, 7.0), (3, 2.0, 8.0), (4, 0.9, 9.5)], "k int, x double, y double")
    hits = {r["k"]: r["part"] for r in overlay.holding(points, labelled, "k", "x", "y").collect()}
    assert set(hits) == {1, 2, 4} and len(set(hits.values())) == 3
    assert overlay.parts(cells.limit(0)).count() == 0
    assert overlay.cells(spark.createDataFrame([], "zone int, layer int, x1 double, y1 double, x2 double, y2 double")).count() == 0
