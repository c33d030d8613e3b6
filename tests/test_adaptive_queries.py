"""The registered covers run the whole search over the cells that the table holds."""

from __future__ import annotations

from geoloom import queries as Q
from geoloom.config import AdaptiveConfig
from geoloom.functions import geometry as G
from geoloom.plans import adaptive


def test_whole_search(spark, sf_dir, monkeypatch):
    seen = []

    def plan(session, border, cells, config=None):
        seen.append((cells, config))
        return session.createDataFrame([], "x double, y double, radius int, density double")

    monkeypatch.setattr(adaptive, "plan", plan)
    Q.queries()["cover_adaptive_plan"](spark, sf_dir).collect()
    cells, config = seen[0]
    assert config == AdaptiveConfig() and len(config.scales) * len(config.band_steps) + config.phase_budget == 240
    box = G.bounds(Q.REGION)
    c = Q._plane(Q.view(spark, sf_dir, "cells"), "s", "lat_center", "lon_center").collect()
    inside = [r for r in c if box[0] - 3000 <= r["sx"] + 4000 <= box[2] + 3000 and box[1] - 3000 <= r["sy"] + 3500 <= box[3] + 3000]
    assert sorted(cells[:, 2].tolist()) == sorted(float(r["density"]) for r in inside)


def test_pruned_cover_is_registered():
    assert "pruned_cover" in Q.queries()
