"""Joins, matching, dates, sources, sinks and streams on small cases."""

from __future__ import annotations

import json
import math
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from geoloom.functions import text as T
from geoloom.operators import joins as J
from geoloom.plans import collect, preserve, render
from geoloom.sources import raster, replay, sinks, tables
from geoloom.streaming import places as stream


def test_knn_is_exact_with_ties(spark):
    rng = random.Random(3)
    sites = [(i, float(rng.randint(0, 20)), float(rng.randint(0, 20)), float(i)) for i in range(60)]
    points = [(i, float(rng.randint(-30, 50)), float(rng.randint(-30, 50))) for i in range(25)]
    got = J.knn(spark.createDataFrame(points, "p int, px double, py double"), spark.createDataFrame(sites, "s int, sx double, sy double, v double"), 4, "p", "s")
    have = {(r["p"], r["rank"]): r["s"] for r in got.collect()}
    for p, x, y in points:
        want = sorted(sites, key=lambda s: ((s[1] - x) ** 2 + (s[2] - y) ** 2, s[0]))[:4]
        assert [have[p, k + 1] for k in range(4)] == [s[0] for s in want]


def test_sphere_pairs_cross_the_date_line_and_poles(spark):
    a = spark.createDataFrame([(1, 10.0, 179.999), (2, 89.999, 0.0)], "a int, p_lat double, p_lng double")
    b = spark.createDataFrame([(1, 10.0, -179.999), (2, 89.999, 180.0), (3, 0.0, 0.0)], "b int, s_lat double, s_lng double")
    got = {(r["a"], r["b"]) for r in J.pairs_on_sphere(a, b, 1000.0).collect()}
    assert got == {(1, 1), (2, 2)}


def test_greedy_match_is_the_sequential_one(spark):
    rng = random.Random(5)
    pairs = [(i, 100 + j, float(rng.randint(0, 9))) for i in range(12) for j in range(9) if rng.random() < 0.5]
    used, want = set(), set()
    for d, n, o in sorted((d, n, o) for n, o, d in pairs):
        if n not in used and o not in used:
            used |= {n, o}
            want.add((n, o))
    got = J.greedy_match(spark.createDataFrame(pairs, "new_id int, old_id int, d2 double"))
    assert {(r["new_id"], r["old_id"]) for r in got.collect()} == want


def test_preserve(spark):
    old = spark.createDataFrame([(1, 10.0, 20.0, False), (2, 10.0, 20.0, True), (3, 10.001, 20.0, False)], "ordinal int, lat double, lng double, collected boolean")
    new = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0011, 20.0), (3, 11.0, 20.0)], "new_id int, lat double, lng double")
    got = {r["new_id"]: (r["collected"], r["match"]) for r in preserve.preserve(new, old, 300.0, 10.0, 20.0).collect()}
    assert got == {1: (True, "exact"), 2: (False, "nearest"), 3: (False, "none")}


def test_earliest_date(spark):
    cases = [(["2024-01-02T23:30:00-05:00", "2024-01-03T05:00:00Z"], "2024-01-02"), (["2024", "2023-05"], "2023-05"), ([], ""), (["bad Time", " "], "bad "), (["2024-03-01T00:00:00.123456789Z"], "2024-03-01")]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t array<string>")
    assert [r[0] for r in df.select(T.earliest_date(F.col("t"))).collect()] == [w for _, w in cases]


def test_collection(spark):
    seeds = spark.createDataFrame([(1, 0.0, 0.0, 1000.0), (2, 0.0, 0.0, 1000.0)], "input_index int, lat double, lng double, radius double")
    log = [(1, "nearby", 0, 1, "a", 0.0, 0.0, None), (1, "text", 0, 1, "a", 0.0, 0.0, "t"), (1, "text", 0, 2, " b ", 0.001, 0.0, "t"), (1, "text", 0, 3, "far", 5.0, 0.0, "t"), (1, "text", 1, 1, "c", 0.0, 0.0, "t"), (1, "text", 2, 1, "late", 0.0, 0.0, "u"), (2, "nearby", 0, 1, "b", 0.0, 0.0, None), (2, "nearby", 0, 2, "d", 0.0, 0.0, None), (2, "nearby", 0, 3, "c", 0.0, 0.0, None)]
    review = {"text": {"text": " good "}, "publishTime": "2024-01-01T00:00:00Z"}
    details = [("a", json.dumps({"id": " ", "displayName": {"text": "A"}, "location": {"latitude": 1, "longitude": 2.5}, "rating": 4.5, "userRatingCount": "12", "reviews": [review, 5, {"text": "", "originalText": {"text": "o"}}]})), ("b", "[]"), ("c", "{}")]
    got, outcomes = collect.collected(spark.createDataFrame(log, replay.LOG), seeds, spark.createDataFrame(details, "place_id string, payload string"))
    rows = {r["place_id"]: r for r in got.collect()}
    assert set(rows) == {"a", "c"} and tuple(got.columns[2:]) == collect.PLACE_COLUMNS
    a = rows["a"]
    assert (a["name"], a["lat"], a["lon"], a["total_review_count"], a["earliest_available_review_date"], a["review_1_text"], a["review_2_text"]) == ("A", 1.0, 2.5, 12, "2024-01-01", "good", "o")
    s = collect.summary(outcomes).first()
    assert (s["discovered"], s["written"], s["duplicates"], s["details_errors"]) == (6, 2, 1, 3)


def tiff(path, values, nodata=b"-99\0", compression=1, strip=2, scale=True):
    rows, cols = len(values), len(values[0])
    strips = [b"".join(struct.pack(f"<{cols}f", *r) for r in values[i : i + strip]) for i in range(0, rows, strip)]
    strips = [zlib.compress(s) if compression == 8 else s for s in strips]
    blobs, tags, at = b"", [], 8
    offsets = []
    for s in strips:
        offsets.append(at + len(blobs))
        blobs += s

    def ext(data):
        nonlocal blobs
        o = at + len(blobs)
        blobs += data
        return o

    n = len(strips)
    tags = [(256, 3, 1, cols), (257, 3, 1, rows), (258, 3, 1, 32), (259, 3, 1, compression), (273, 4, n, ext(struct.pack(f"<{n}I", *offsets)) if n > 1 else offsets[0]), (277, 3, 1, 1), (278, 3, 1, strip), (279, 4, n, ext(struct.pack(f"<{n}I", *map(len, strips))) if n > 1 else len(strips[0])), (339, 3, 1, 3)]
    if scale:
        tags += [(33550, 12, 3, ext(struct.pack("<3d", 0.5, 0.25, 0))), (33922, 12, 6, ext(struct.pack("<6d", 0, 0, 0, 10, 50, 0)))]
    if nodata:
        tags.append((42113, 2, len(nodata), int.from_bytes(nodata.ljust(4, b"\0"), "little") if len(nodata) <= 4 else ext(nodata)))
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", *t) for t in sorted(tags)) + bytes(4)
    path.write_bytes(b"II" + struct.pack("<HI", 42, at + len(blobs)) + blobs + ifd)


@pytest.mark.parametrize("compression", [1, 8])
def test_raster(spark, tmp_path, compression):
    p = tmp_path / "r.tif"
    tiff(p, [[1, 2, 3], [4, -99, 6], [7, math.nan, 9]], compression=compression)
    every = {(r["row"], r["col"]): r["value"] for r in raster.read_raster(spark, str(p)).collect()}
    assert len(every) == 9 and every[2, 0] == 7
    got = raster.valid_cells(spark, str(p), (10.0, 49.3, 11.0, 49.9)).collect()
    assert sorted((r["row"], r["col"]) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert [r["lon_center"] for r in got if (r["row"], r["col"]) == (0, 1)] == [10.75]
    tiff(p, [[1.0]], scale=False)
    with pytest.raises(raster.RasterError):
        raster.header(str(p))
    assert raster.parse_nodata(b" -1.5\0") == -1.5 and raster.parse_nodata("x") is None


def test_json_and_csv_sources(spark, tmp_path):
    p = tmp_path / "seeds.json"
    p.write_text(json.dumps([{"lat": 1, "lng": "2", "radius": "1_000"}, 5, {"lat": True, "lng": 1, "radius": 1}, {"lat": 90.0001, "lng": 0, "radius": 1}, {"lat": 0, "lng": 0, "radius": 50000.1}, {"lat": 0, "lng": 0, "radius": "1d"}]))
    got = [(r["input_index"], r["radius"], r["reason"]) for r in tables.seeds(spark, str(p)).orderBy("input_index").collect()]
    assert got[0] == (1, 1000.0, None) and [g[2] for g in got[1:]] == ["not_object", "missing", "lat_range", "radius_range", "missing"]
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(tables.InputError):
        tables.seeds(spark, str(tmp_path / "bad.json"))
    assert tables.circles(spark, str(tmp_path / "bad.json"), tolerant=True).count() == 0
    (tmp_path / "p.csv").write_text('﻿place_id,lat,lon,review_1_text\r\na,1.5,2,"x, ""y""\nz"\r\n', encoding="utf-8")
    r = tables.places(spark, str(tmp_path / "p.csv")).first()
    assert (r["place_id"], r["lat"], r["review_1_text"].replace("\r", "")) == ("a", 1.5, 'x, "y"\nz')
    (tmp_path / "c.csv").write_text("lon_center,lat_center,population_density\n1,2,3\n1,2,-3\n1,x,3\n1,2,nan\n")
    assert tables.cells(spark, str(tmp_path / "c.csv")).count() == 1
    (tmp_path / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}))
    assert tables.boundary(spark, str(tmp_path / "b.json")) == [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]]


def test_sinks_and_layers(spark, tmp_path):
    c = spark.createDataFrame([(1.0, 2.0, 500, True), (95.0, 2.0, 500, True)], "lat double, lng double, radius int, collected boolean")
    assert sinks.circles_document(c.limit(1), str(tmp_path / "c.json")) == 1
    assert json.loads((tmp_path / "c.json").read_text()) == [{"lat": 1.0, "lng": 2.0, "radius": 500, "collected": True}]
    layer = render.circle_layer(c)
    assert layer.count() == 1 and "<td style='padding:2px 0;'>500.00</td>" in layer.first()["popup"]
    assert render.write_html(layer, str(tmp_path / "m.html")) == 1
    made = []
    make = lambda: made.append(1) or {"type": "x"}
    for settings in ({"a": 1}, {"a": 1}, {"a": 2}):
        sinks.cached_boundary(str(tmp_path / "b.json"), settings, make)
    assert len(made) == 2


def test_streaming_takes_each_place_once(spark, tmp_path):
    src = tmp_path / "log"
    src.mkdir()
    for i in range(2):
        (src / f"{i}.json").write_text("\n".join(json.dumps({"seed_index": i, "place_id": p, "lat": 0, "lng": 0, "seen_at": "2024-01-01T00:00:00Z"}) for p in ("a", "b")))
    q = stream.first_seen(stream.log_stream(spark, str(src))).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r["place_id"] for r in spark.table("seen").collect()) == ["a", "b"]
