"""Writers with commit and abort, and raster scans with pushed filters."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from geoloom.plans import render
from geoloom.session import cut, new_folder, sweep
from geoloom.sources import raster, sinks


def test_documents_written_by_tasks(spark, tmp_path):
    rows = [(float(i), -float(i), 25 * i, i % 2 == 0, f"</é{i}\n") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "lat double, lng double, radius int, collected boolean, note string")
    want = json.dumps([dict(zip(df.columns, r, strict=True)) for r in rows], indent=2) + "\n"
    for parts in (1, 5):
        assert sinks.circles_document(df.repartitionByRange(parts, "lat").sortWithinPartitions("lat"), str(tmp_path / "c.json")) == 39
        assert (tmp_path / "c.json").read_text() == want
    assert sinks.circles_document(df.limit(0), str(tmp_path / "c.json")) == 0 and (tmp_path / "c.json").read_text() == "[]\n"
    assert sinks.circles_documents(df.repartitionByRange(4, "lat"), str(tmp_path / "docs")) == 39
    manifest = json.loads((tmp_path / "docs" / "_manifest.json").read_text())
    assert manifest["rows"] == 39 and sum(len(json.loads((tmp_path / "docs" / p["name"]).read_text())) for p in manifest["parts"]) == 39
    assert sorted(os.listdir(tmp_path)) == ["c.json", "docs"]


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    df = spark.range(0, 40, 1, 4).select(F.col("id").alias("lat"), F.when(F.col("id") == 37, F.raise_error(F.lit("broken"))).cast("string").alias("lng"))
    sinks.circles_document(spark.range(1).select("id"), str(tmp_path / "old.json"))
    before = (tmp_path / "old.json").read_text()
    for write in (sinks.circles_document, sinks.circles_documents):
        with pytest.raises(Exception, match="broken"):
            write(df, str(tmp_path / "old.json"))
    assert os.listdir(tmp_path) == ["old.json"] and (tmp_path / "old.json").read_text() == before


def test_pages_written_by_tasks(spark, tmp_path):
    layer = spark.createDataFrame([(1.0, 2.0, "</script>"), (3.0, 4.0, "b")], "lat double, lng double, popup string").repartition(2)
    assert render.write_html(layer, str(tmp_path / "m.html"), "t", render.CIRCLE_LEGEND) == 2
    page = (tmp_path / "m.html").read_text()
    body = page.split("const layer = [", 1)[1].split("];\nconst NS", 1)[0]
    assert sorted(r["lat"] for r in json.loads(f"[{body.replace('<\\/', '</')}]")) == [1.0, 3.0] and page.count("</script>") == 1
    assert render.write_html(layer.limit(0), str(tmp_path / "e.html")) == 0 and "const layer = [\n];" in (tmp_path / "e.html").read_text()


def test_raster_written_and_scanned(spark, tmp_path):
    rng = random.Random(2)
    values = {(r, c): rng.uniform(-5, 5) for r in range(23) for c in range(17) if rng.random() < 0.8 and r not in (8, 9, 10, 11)}
    cells = spark.createDataFrame([(*k, v) for k, v in values.items()], "row int, col int, value double")
    path = str(tmp_path / "r.tif")
    assert raster.write_raster(cells, path, 17, 23, (10.0, 50.0), (0.5, 0.25), rows_per_strip=4) == len(values)
    head = raster.header(path)
    assert (head.width, head.height, head.rows_per_strip, head.origin_lon, head.origin_lat, head.nodata, len(head.sizes)) == (17, 23, 4, 10.0, 50.0, -9999.0, 6)
    whole = raster.read_raster(spark, path)
    assert {(r["row"], r["col"]): r["value"] for r in whole.where("value <> -9999").collect()} == values
    assert whole.count() == 17 * 23 and whole.rdd.getNumPartitions() == 6
    every = {(r["row"], r["col"]): r for r in whole.collect()}
    for condition, keep, strips in (
        ("row = 5", lambda r: r["row"] == 5, 1), ("row > 3 AND row <= 8", lambda r: 3 < r["row"] <= 8, 2), ("lat > 48.9 AND lat < 49.2", lambda r: 48.9 < r["lat"] < 49.2, 2), ("row IN (1, 2)", lambda r: r["row"] in (1, 2), 1),
        ("lon >= 12.25 AND col < 9", lambda r: r["lon"] >= 12.25 and r["col"] < 9, 6), ("row = 1 OR col = 2", lambda r: r["row"] == 1 or r["col"] == 2, 6), ("row > 40", lambda r: False, 1),
    ):
        got = raster.scan(spark, path, condition)
        assert {(r["row"], r["col"]) for r in got.collect()} == {k for k, r in every.items() if keep(r)} and got.rdd.getNumPartitions() == strips
    a, b = raster.scan(spark, path, "row = 1"), raster.scan(spark, path, "row >= 20")
    both = {r["row"] for r in a.union(b).union(whole.where("row = 12")).union(b.where("row = 21")).collect()}
    assert both == {1, 12, 20, 21, 22}


def test_intermediate_tables_can_be_deleted(spark):
    sweep(spark)
    folder = new_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    held = cut(spark.range(5))
    assert held.count() == 5 and sweep(spark) == 2 and sweep(spark) == 0
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        spark.read.parquet(folder).count()
