"""Percentiles, zone algebra, services that fail, the command line and pages."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom import __main__ as command
from geoloom.config import AdaptiveConfig, ConfigError, usable_key
from geoloom.functions import geometry as G
from geoloom.operators import aggregates as A
from geoloom.operators import joins as J
from geoloom.operators import region as R
from geoloom.plans import render
from geoloom.sources import replay


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [5.0] * 40 + [7.0], "many"])
def test_quantiles(spark, values):
    rng = random.Random(3)
    if values == "many":
        values = [rng.choice([None, 2.5, rng.gauss(0, 9)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    at = (-1.0, 0.0, 0.02, 0.25, 0.5, 0.98, 1.0, 2.0)
    got, own = A.quantiles(df, F.col("v"), *at), [v for v in values if v is not None]
    want = np.percentile(own, [100 * min(1, max(0, p)) for p in at]).tolist() if own else [None] * len(at)
    assert got == want if not own else got == pytest.approx(want)


def test_color_range_of_nothing_and_of_one_value(spark):
    assert tuple(A.color_range(spark.createDataFrame([], "d double"), "d").first()) == (None, None)
    assert tuple(A.color_range(spark.createDataFrame([(4.0,)] * 6, "d double"), "d").first()) == (4.0, 5.0)


def test_shared_upright_edges_count_once():
    def box(w, s, e, n):
        return np.array(G.edges([[[(w, s), (e, s), (e, n), (w, n)]]]), float)

    both = R.combined([box(0, 0, 2, 2), box(2, 1, 4, 3)], lambda f: f[0] | f[1])
    turned = R.combined([box(0, 0, 2, 2), box(0, 0, 2, 2)[:, [2, 3, 0, 1]]], lambda f: f[0] & f[1])
    assert len({tuple(sorted((tuple(e[:2]), tuple(e[2:])))) for e in both.tolist()}) == len(both)
    assert len(turned) == 4
    assert R.area(both) == pytest.approx(8.0) and R.area(turned) == pytest.approx(4.0)
    x, y = np.array([1.0, 3.0, 1.0, 3.0]), np.array([1.0, 2.0, 2.5, 0.5])
    assert R.covers(x, y, both).tolist() == [True, True, False, False]


def test_nearest_without_circles(spark):
    s = spark.createDataFrame([("a", 0.0, 0.0)], "id string, px double, py double")
    none = spark.createDataFrame([], "c int, sx double, sy double, sr double")
    r = J.coverage_and_nearest(s, none, "id", "c").first()
    assert (r["n_cover"], r["nearest"]) == (0, math.inf)


def test_failed_requests_are_rows(spark):
    def call(r):
        if r["seed_index"] == 2:
            raise ValueError("not JSON")
        return [] if r["seed_index"] == 3 else [{"seed_index": r["seed_index"], "place_id": "p"}]

    got = replay.requested(spark.createDataFrame([(1,), (2,), (3,)], "seed_index int"), call, "seed_index int, place_id string", pause_s=0.0)
    assert sorted(map(tuple, got.collect())) == [(1, "p", None), (2, None, "ValueError: not JSON")]
    assert tuple(replay.request_counts(got).first()) == (1, 1)


def test_command_line(capsys, tmp_path):
    parse = command.parser().parse_args
    fixed = ["fixed", "--border", "b", "--small", "s", "--output", "o"]
    assert command.config_of(parse(fixed)).mode == "fast" and command.config_of(parse([*fixed, "--fast-local"])).mode == "fast-local"
    with pytest.raises(SystemExit):
        parse([*fixed, "--fast", "--auto"])
    adaptive = ["adaptive", "--border", "b", "--cells", "c", "--output", "o"]
    assert command.config_of(parse(adaptive)) == AdaptiveConfig()
    got = command.config_of(parse([*adaptive, "--scales", "1,0.9,1", "--phases", "1.25", "--min-radius", "400", "--patch-factor", "1.5"]))
    assert (got.scales, got.phases, got.min_radius, got.patch_factor) == ((0.9, 1.0), (0.25,), 400, 1.5)
    assert command.main([*adaptive, "--min-radius", "0"]) == 1 and "geoloom:" in capsys.readouterr().err
    for bad in (None, " ", "YOUR_API_KEY_HERE"):
        with pytest.raises(ConfigError):
            usable_key(bad)
    assert usable_key(" k ") == "k"


def test_fixed_plan_from_the_command_line(spark, tmp_path):
    import json

    def write(name, w, s, e, n):
        ring = [[w, s], [e, s], [e, n], [w, n], [w, s]]
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
        return str(tmp_path / name)

    border, small = write("b.json", 98.90, 18.70, 98.95, 18.74), write("s.json", 98.89, 18.69, 98.92, 18.75)
    assert command.main(["fixed", "--border", border, "--small", small, "--output", str(tmp_path / "o.json")]) == 0
    rows = json.loads((tmp_path / "o.json").read_text())
    assert len(rows) > 5 and {r["radius"] for r in rows} == {500, 1000} and not any(r["collected"] for r in rows)


def test_pages_draw_their_rows(spark, tmp_path):
    c = spark.createDataFrame([(1.0, 2.0, 500, True)], "lat double, lng double, radius int, collected boolean")
    assert render.write_html(render.circle_layer(c), str(tmp_path / "m.html"), "a<b", render.CIRCLE_LEGEND) == 1
    page = (tmp_path / "m.html").read_text()
    assert "a&lt;b" in page and "Not collected" in page and "createElementNS" in page and page.count("{{") == 0
