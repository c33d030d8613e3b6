"""Regions, covers and planners against closed forms and brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.config import AdaptiveConfig, ConfigError, FixedConfig, number_list
from geoloom.functions import geometry as G
from geoloom.operators import generators as E
from geoloom.operators import region as R
from geoloom.plans import adaptive, fixed

SQUARE = np.array(G.edges([[[(0, 0), (10, 0), (10, 10), (0, 10)]]]), float)
HOLED = [[[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]]


def test_area_of_square_hole_and_disk():
    assert R.area(SQUARE) == pytest.approx(100)
    assert R.area(np.array(G.edges(HOLED), float)) == pytest.approx(96)
    assert R.uncovered(SQUARE, np.array([[5, 5, 3.0]]))[0] == pytest.approx(100 - 9 * math.pi)


def test_boolean_combinations():
    other = SQUARE + 5.0
    for rule, want in ((lambda f: f[0] & f[1], 25), (lambda f: f[0] | f[1], 175), (lambda f: f[0] & ~f[1], 75)):
        assert R.area(R.combined([SQUARE, other], rule)) == pytest.approx(want)


def test_uncovered_against_sampling():
    rng = np.random.default_rng(1)
    c = np.stack([rng.uniform(0, 10, 9), rng.uniform(0, 10, 9), rng.uniform(0.5, 3, 9)], axis=1)
    area, parts = R.uncovered(SQUARE, c)
    p = rng.uniform(0, 10, (200_000, 2))
    open_ = ~((((p[:, None] - c[None, :, :2]) ** 2).sum(axis=2)) <= c[:, 2] ** 2).any(axis=1)
    assert area == pytest.approx(open_.mean() * 100, abs=0.5)
    for q in parts:  # the place of a piece is inside it
        assert R.inside(np.array([q.x]), np.array([q.y]), SQUARE)[0] and (((c[:, :2] - [q.x, q.y]) ** 2).sum(axis=1) > c[:, 2] ** 2).all()


def test_covers_counts_the_boundary(spark):
    pts = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (4.0, 5.0), (11.0, 5.0), (2.0, 2.0)], "x double, y double")
    got = [r[0] for r in pts.select(G.covers(F.col("x"), F.col("y"), G.edge_array(HOLED))).collect()]
    assert got == [True, True, False, True, False, True]


def test_disk_polygon_is_inscribed():
    a = R.area(np.array(G.edges([[G.disk(0, 0, 1.0)]]), float))
    assert a == pytest.approx(256 / 2 * math.sin(2 * math.pi / 256)) and a < math.pi


def test_radius_bands():
    assert E.radius_bands(500, 800, 100) == [(0, 701, 800), (1, 601, 700), (2, 501, 600), (3, 500, 500)]


BORDER = np.array(G.edges([[[(0, 0), (5000, 0), (5000, 3000), (2500, 3000), (2500, 4500), (0, 4500)]]]), float)


def test_fixed_plan_keeps_its_invariants(spark):
    zones = fixed.Zones.of(BORDER, np.array(G.edges([[[(-100, -100), (2000, -100), (2000, 2000), (-100, 2000)]]]), float))
    c = fixed.plan(spark, zones).toPandas()[["x", "y", "radius"]].to_numpy(float)
    assert fixed.valid(zones, c, FixedConfig(), fixed.sample_points(BORDER, 100.0))
    assert set(c[:, 2]) == {500.0, 1000.0}


def test_adaptive_plan_covers(spark):
    rng = np.random.default_rng(2)
    cells = np.stack([rng.uniform(0, 5000, 60), rng.uniform(0, 4500, 60), rng.uniform(10, 8000, 60)], axis=1)
    config = AdaptiveConfig(coverage_step=250.0, scales=(0.94,), band_steps=(100,), phases=(0.0,), phase_budget=0)
    c = adaptive.plan(spark, BORDER, cells, config).toPandas()[["x", "y", "radius"]].to_numpy(float)
    assert R.uncovered(BORDER, c)[0] <= 1.0
    assert ((c[:, 2] % 25) == 0).all() and c[:, 2].min() >= 500


def test_settings_are_checked():
    assert number_list("2, 1,2") == (1.0, 2.0)
    for bad in (lambda: number_list(","), lambda: FixedConfig(mode="slow"), lambda: AdaptiveConfig(min_radius=0), lambda: AdaptiveConfig(max_radius=400)):
        with pytest.raises(ConfigError):
            bad()


def box_edges(x0, y0, x1, y1):
    return np.array(G.edges([[[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]]), float)


def test_zones_by_boolean_algebra():
    from geoloom.plans import zones as Z

    city, hill, district = box_edges(0, 0, 4, 4), box_edges(-3, 0, 0, 4), box_edges(-5, -2, 6, 6)
    ring = R.combined([district, city, hill], lambda f: f[0] & ~(f[1] | f[2]))
    assert [R.area(p) for p in Z.polygons(ring)] == pytest.approx([88 - 28])  # one piece with a hole
    split = R.combined([box_edges(-5, 1, 6, 2), city], lambda f: f[0] & ~f[1])
    assert sorted(R.area(p) for p in Z.polygons(split)) == pytest.approx([2, 5])
    assert R.area(Z.anchored(split, (5, 1.5))) == pytest.approx(2)
    extra = Z.supplement(box_edges(-5, 1, 6, 2), city, hill, (5, 1.5))
    border = Z.merged_border(city, hill, extra)
    assert R.area(border) == pytest.approx(16 + 12 + 2)
    assert R.area(Z.small_zone(city, extra, border, 5.0)) == pytest.approx(16 + 1)
    doc = Z.geojson(ring)
    shape = doc["features"][0]["geometry"]["coordinates"]
    assert len(shape) == 1 and len(shape[0]) == 2
    with pytest.raises(ValueError):
        Z.supplement(box_edges(-5, 1, 6, 2), city, hill, (100, 100))
