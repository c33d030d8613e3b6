"""Map layers: Spark computes the rows of a layer, a small writer puts them into an HTML page."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import RAMP, ramp_color
from ..functions.text import circle_popup, fixed, place_popup
from ..operators.aggregates import color_range
from ..operators.validity import circle_valid, density_valid, point_valid

#: Colours of circles.
COLLECTED, NOT_COLLECTED = "#2ca02c", "#1f77b4"


def status_color(collected: Column) -> Column:
    return F.when(collected, COLLECTED).otherwise(NOT_COLLECTED)


def circle_layer(circles: DataFrame, adaptive: bool = False) -> DataFrame:
    ok = circles.where(circle_valid(F.col("lat"), F.col("lng"), F.col("radius").cast("double"), F.col("collected")))
    density = F.col("population_density") if adaptive else None
    return ok.select("lat", "lng", F.col("radius").cast("double").alias("radius"), status_color(F.col("collected")).alias("color"), circle_popup(F.col("lat"), F.col("lng"), F.col("radius"), F.col("collected"), density).alias("popup"))


def marker_layer(places: DataFrame) -> DataFrame:
    ok = places.where(point_valid(F.col("lat"), F.col("lon")))
    named = [("Name", F.col("name")), ("Place ID", F.col("place_id")), ("Average Rating", F.col("average_rating")), ("Total Review Count", F.col("total_review_count")), ("Earliest Available Review Date", F.col("earliest_available_review_date"))]
    return ok.select("lat", F.col("lon").alias("lng"), place_popup(F.col("lat"), F.col("lon"), named, [F.col(f"review_{i}_text") for i in range(1, 6)]).alias("popup"))


def cell_layer(cells: DataFrame) -> DataFrame:
    d = F.col("population_density")
    ok = cells.where(density_valid(F.col("lat_center"), F.col("lon_center"), d))
    tip = F.concat(F.lit("Density: "), fixed(d, 2, True), F.lit(" people/km^2<br>Cell center: "), fixed(F.col("lat_center"), 5), F.lit(", "), fixed(F.col("lon_center"), 5))
    return ok.join(F.broadcast(color_range(ok, "population_density"))).select("lat_bottom", "lat_top", "lon_left", "lon_right", ramp_color(d, F.col("scale_min"), F.col("scale_max")).alias("color"), tip.alias("tooltip"))


_PAGE = """<!DOCTYPE html>
<html><head><meta charset="utf-8"><title>{title}</title>
<style>body{{margin:0;font-family:Arial,sans-serif}} svg{{width:100vw;height:100vh;background:#eef}} #legend,#tip{{position:fixed;background:#fff;padding:6px 10px;border:1px solid #999;font-size:12px}} #legend{{right:10px;top:10px}} #tip{{left:10px;bottom:10px;display:none}}</style></head>
<body><svg id="map"></svg><div id="legend">{legend}</div><div id="tip"></div><script>const layer = [
"""
#: Draws circles (radius), cells (lat_bottom) and markers (the rest), north up; a click shows a row's popup or tooltip.
_DRAW = """];
const NS = "http://www.w3.org/2000/svg", map = document.getElementById("map"), tip = document.getElementById("tip"), M = 111320;
const lats = layer.flatMap(r => "lat_bottom" in r ? [r.lat_bottom, r.lat_top] : [r.lat]);
const mid = (Math.min(...lats.slice(0, 1e5)) + Math.max(...lats.slice(0, 1e5))) / 2, kx = M * Math.cos(mid * Math.PI / 180);
let box = [Infinity, Infinity, -Infinity, -Infinity];
const grow = (x0, y0, x1, y1) => { box = [Math.min(box[0], x0), Math.min(box[1], y0), Math.max(box[2], x1), Math.max(box[3], y1)]; };
for (const r of layer) {
  let e;
  if ("lat_bottom" in r) {
    const x = r.lon_left * kx, y = -r.lat_top * M, w = (r.lon_right - r.lon_left) * kx, h = (r.lat_top - r.lat_bottom) * M;
    e = document.createElementNS(NS, "rect");
    for (const [k, v] of Object.entries({x, y, width: w, height: h, fill: r.color, "fill-opacity": 0.7})) e.setAttribute(k, v);
    grow(x, y, x + w, y + h);
  } else {
    const x = r.lng * kx, y = -r.lat * M, d = r.radius || 40;
    e = document.createElementNS(NS, "circle");
    for (const [k, v] of Object.entries({cx: x, cy: y, r: d, fill: r.color || "#d62728", stroke: r.color || "#d62728", "fill-opacity": r.radius ? 0.2 : 0.9, "stroke-width": 8})) e.setAttribute(k, v);
    grow(x - d, y - d, x + d, y + d);
  }
  e.addEventListener("click", () => { tip.innerHTML = r.popup || r.tooltip || ""; tip.style.display = "block"; });
  map.appendChild(e);
}
if (layer.length) map.setAttribute("viewBox", [box[0], box[1], box[2] - box[0], box[3] - box[1]].join(" "));
</script></body></html>
"""


def legend(entries: list[tuple[str, str]]) -> str:
    """Rows of (colour, label)."""
    return "".join(f"<div><span style='color:{c}'>&#9632;</span> {html.escape(t)}</div>" for c, t in entries)


#: Legends of the three kinds of layers.
CIRCLE_LEGEND = ((COLLECTED, "Collected"), (NOT_COLLECTED, "Not collected"))
CELL_LEGEND = tuple((f"#{c}", t) for c, t in zip(RAMP, ("lowest density", "", "", "", "highest density"), strict=True))


def write_html(layer: DataFrame, path: str, title: str = "map", entries: tuple[tuple[str, str], ...] = ()) -> int:
    """One page that draws the layer's rows, with a legend; tasks write the rows, the commit joins them.  Returns how many there were."""
    from ..sources.staged import DocumentSource, save

    head = _PAGE.format(title=html.escape(title), legend=legend(list(entries)))
    return save(layer, DocumentSource, path, single="true", head=head, between="\n,", tail="\n" + _DRAW, empty=_DRAW, escape="true")
