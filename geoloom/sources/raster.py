"""GeoTIFF as a Spark data source: rows (row, col, value, lon, lat), one input partition for each strip.

Reads single-band images of 8 to 64 bit numbers without compression or with
deflate; anything else fails with the name of what isn't supported.  ``scan``
pushes filters on row, col and the middles' coordinates lon and lat, and reads only
the strips and columns that they leave; Spark tests them again.  Written images are of 64-bit numbers with deflate: tasks compress strips
in parallel, the commit puts a header before them.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..operators.generators import cell_bounds
from .staged import Part, StagedWriter, save, store_of

#: TIFF tags and the sizes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PREDICTOR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 317, 339
PIXEL_SCALE, TIEPOINT, NODATA = 33550, 33922, 42113
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


class RasterError(ValueError):
    """A file that can't be read as a raster."""


def parse_nodata(v) -> float | None:
    """A number from a text or bytes with spaces and NULs around it, else none."""
    if isinstance(v, bytes):
        v = v.decode("ascii", "ignore")
    try:
        return float(str(v).strip(" \0\t\r\n"))
    except ValueError:
        return None


@dataclass(frozen=True)
class Raster:
    width: int
    height: int
    kind: str
    compression: int
    rows_per_strip: int
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    origin_lon: float
    origin_lat: float
    pixel_width: float
    pixel_height: float
    nodata: float | None


def header(path: str) -> Raster:
    """What the first page of a file says."""
    store, name = store_of(path)
    with store.open_input_file(name) as f:
        mark = f.read(8)
        order = {b"II": "<", b"MM": ">"}.get(mark[:2])
        if order is None or struct.unpack(order + "H", mark[2:4])[0] != 42:
            raise RasterError("not a TIFF file")
        f.seek(struct.unpack(order + "I", mark[4:])[0])
        entries = f.read(12 * struct.unpack(order + "H", f.read(2))[0])
        tags = {}
        for i in range(0, len(entries), 12):
            tag, kind, n = struct.unpack(order + "HHI", entries[i : i + 8])
            code = _TYPES.get(kind)
            if code is None:
                continue
            size = n if code == "s" else n * struct.calcsize(code)
            raw = entries[i + 8 : i + 12]
            if size > 4:
                f.seek(struct.unpack(order + "I", raw)[0])
                raw = f.read(size)
            tags[tag] = raw[:size] if code == "s" else struct.unpack(f"{order}{n}{code}", raw[:size])
    one = lambda t, d=None: tags[t][0] if t in tags else d
    if PIXEL_SCALE not in tags or TIEPOINT not in tags:
        raise RasterError("no pixel scale or tiepoint")
    sx, sy = tags[PIXEL_SCALE][:2]
    if sx <= 0 or sy <= 0:
        raise RasterError("the pixel scale must be positive")
    if one(SAMPLES, 1) != 1:
        raise RasterError("more than one band")
    if STRIPS not in tags:
        raise RasterError("tiled images aren't supported")
    if one(COMPRESSION, 1) not in (1, 8, 32946) or one(PREDICTOR, 1) != 1:
        raise RasterError(f"compression {one(COMPRESSION, 1)} or predictor {one(PREDICTOR, 1)} isn't supported")
    kind = f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[one(FORMAT, 1)] }{one(BITS, 8) // 8}"
    i, j, _, x, y = tags[TIEPOINT][:5]
    return Raster(one(WIDTH), one(HEIGHT), kind, one(COMPRESSION, 1), one(ROWS_PER_STRIP, one(HEIGHT)), tuple(tags[STRIPS]), tuple(tags[STRIP_BYTES]), x - i * sx, y + j * sy, sx, sy, parse_nodata(tags[NODATA]) if NODATA in tags else None)


@dataclass
class Strip(InputPartition):
    first_row: int
    offset: int
    size: int


class RasterReader(DataSourceReader):
    """Options: path, and row_min, row_max, col_min, col_max, which prune strips before they are read, as filters do."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.raster = header(self.path)
        get = lambda k, d: int(options.get(k, d))
        self.rows = get("row_min", 0), get("row_max", self.raster.height - 1)
        self.cols = get("col_min", 0), get("col_max", self.raster.width - 1)

    def partitions(self) -> list[InputPartition]:
        r = self.raster
        every = [Strip(k * r.rows_per_strip, o, n) for k, (o, n) in enumerate(zip(r.offsets, r.sizes, strict=True))]
        return [s for s in every if s.first_row <= self.rows[1] and s.first_row + r.rows_per_strip - 1 >= self.rows[0] and self.cols[0] <= self.cols[1]] or [Strip(0, 0, 0)]

    def read(self, partition: Strip) -> Iterator[pa.RecordBatch]:
        r = self.raster
        if not partition.size:
            return
        store, name = store_of(self.path)
        with store.open_input_file(name) as f:
            f.seek(partition.offset)
            data = f.read(partition.size)
        if r.compression != 1:
            data = zlib.decompress(data)
        n = min(r.rows_per_strip, r.height - partition.first_row)
        values = np.frombuffer(data, r.kind, n * r.width).reshape(n, r.width)
        cols = np.arange(max(0, math.ceil(self.cols[0])), min(r.width - 1, math.floor(self.cols[1])) + 1)
        for k in range(n):
            row = partition.first_row + k
            if self.rows[0] <= row <= self.rows[1] and len(cols):
                lon = r.origin_lon + (cols + 0.5) * r.pixel_width
                lat = np.full(len(cols), r.origin_lat - (row + 0.5) * r.pixel_height)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cols), row, np.int32)), pa.array(cols.astype(np.int32)), pa.array(values[k, cols].astype(np.float64)), pa.array(lon), pa.array(lat)], ["row", "col", "value", "lon", "lat"])


class PushedReader(RasterReader):
    """Takes filters; only for tables that ``scan`` loads."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrows the window; every filter goes back to Spark, as bounds of coordinates are widened to whole cells."""
        r = self.raster
        for f in filters:
            name = getattr(f, "attribute", ("",))[0]
            if name not in ("row", "col", "lon", "lat"):
                yield f
                continue
            low, high = -math.inf, math.inf
            if isinstance(f, EqualTo):
                low = high = f.value
            elif isinstance(f, In) and (known := [v for v in f.value if v is not None]):
                low, high = min(known), max(known)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                low = f.value if isinstance(f, GreaterThanOrEqual) else math.nextafter(f.value, math.inf)
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                high = f.value if isinstance(f, LessThanOrEqual) else math.nextafter(f.value, -math.inf)
            if name == "lat":
                low, high = (r.origin_lat - high) / r.pixel_height - 1, (r.origin_lat - low) / r.pixel_height
            elif name == "lon":
                low, high = (low - r.origin_lon) / r.pixel_width - 1, (high - r.origin_lon) / r.pixel_width
            if name in ("row", "lat"):
                self.rows = max(self.rows[0], low), min(self.rows[1], high)
            elif name in ("col", "lon"):
                self.cols = max(self.cols[0], low), min(self.cols[1], high)
            yield f


class RasterWriter(StagedWriter):
    """Rows (row, col, value) that come by strips.  Options: path, width, height, origin_lon, origin_lat, pixel_width, pixel_height, nodata, rows_per_strip."""

    def _strip(self, values: np.ndarray) -> bytes:
        return zlib.compress(np.ascontiguousarray(values, "<f8").tobytes())

    def _shape(self, strip: int) -> tuple[int, int]:
        o = self.options
        per = int(o["rows_per_strip"])
        return min(per, int(o["height"]) - strip * per), int(o["width"])

    def put(self, out, rows: Iterator) -> tuple[int, list]:
        per, nodata = int(self.options["rows_per_strip"]), float(self.options["nodata"])
        notes, now, values, n, at = [], None, None, 0, 0

        def close() -> int:
            data = self._strip(values)
            out.write(data)
            notes.append((now, at, len(data)))
            return at + len(data)

        for r in rows:
            if r["row"] // per != now:
                if now is not None:
                    at = close()
                now = r["row"] // per
                values = np.full(self._shape(now), nodata)
            values[r["row"] - now * per, r["col"]] = r["value"]
            n += 1
        if now is not None:
            close()
        return n, notes

    def join(self, store, staging: str, parts: list[Part], out) -> None:
        o = self.options
        width, height, per = (int(o[k]) for k in ("width", "height", "rows_per_strip"))
        strips = -(-height // per)
        made = {k: (p.name, at, size) for p in parts for k, at, size in p.notes}
        bare = {shape: self._strip(np.full(shape, float(o["nodata"]))) for shape in {self._shape(k) for k in range(strips) if k not in made}}
        sizes = [made[k][2] if k in made else len(bare[self._shape(k)]) for k in range(strips)]
        tags = {WIDTH: ("I", [width]), HEIGHT: ("I", [height]), BITS: ("H", [64]), COMPRESSION: ("H", [8]), 262: ("H", [1]), STRIPS: ("I", [0] * strips), SAMPLES: ("H", [1]), ROWS_PER_STRIP: ("I", [per]), STRIP_BYTES: ("I", sizes), FORMAT: ("H", [3])}
        tags |= {PIXEL_SCALE: ("d", [float(o["pixel_width"]), float(o["pixel_height"]), 0.0]), TIEPOINT: ("d", [0.0, 0.0, 0.0, float(o["origin_lon"]), float(o["origin_lat"]), 0.0]), NODATA: ("s", o["nodata"].encode() + b"\0")}
        codes = {v: k for k, v in _TYPES.items()}
        size = lambda code, v: len(v) if code == "s" else len(v) * struct.calcsize("<" + code)
        begin = 8 + 2 + 12 * len(tags) + 4  # the header's long values lie behind its entries, the strips behind those
        body = begin + sum(size(*t) for t in tags.values() if size(*t) > 4)
        if body + sum(sizes) >= 1 << 32:
            raise RasterError("a file of this form ends at 4 GB")
        tags[STRIPS] = ("I", [body + sum(sizes[:k]) for k in range(strips)])
        entries, long = b"", b""
        for tag, (code, v) in sorted(tags.items()):
            raw = bytes(v) if code == "s" else struct.pack(f"<{len(v)}{code}", *v)
            place = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", begin + len(long))
            long += raw if len(raw) > 4 else b""
            entries += struct.pack("<HHI", tag, codes[code], len(v)) + place
        out.write(b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(tags)) + entries + bytes(4) + long)
        for k in range(strips):
            if k in made:
                self.copy(store, f"{staging}/{made[k][0]}", out, *made[k][1:])
            else:
                out.write(bare[self._shape(k)])


class RasterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return "row int, col int, value double, lon double, lat double"

    def reader(self, schema) -> RasterReader:
        o = dict(self.options)
        return (PushedReader if o.get("push") == "true" else RasterReader)(o)

    def writer(self, schema, overwrite: bool) -> RasterWriter:
        return RasterWriter(dict(self.options))


def write_raster(cells: DataFrame, path: str, width: int, height: int, origin: tuple[float, float], pixel: tuple[float, float], nodata: float = -9999.0, rows_per_strip: int = 16) -> int:
    """One GeoTIFF of cells (row, col, value) inside width and height; cells that are missing get ``nodata``.  ``origin``: (lon, lat) of the upper left corner."""
    strip = F.expr(f"row div {rows_per_strip}")
    dealt = cells.select("row", "col", "value").repartition(strip).sortWithinPartitions(strip)
    numbers = dict(zip(("width", "height", "origin_lon", "origin_lat", "pixel_width", "pixel_height", "nodata", "rows_per_strip"), (width, height, *origin, *pixel, nodata, rows_per_strip), strict=True))
    return save(dealt, RasterSource, path, single="true", **{k: repr(v) for k, v in numbers.items()})


def read_raster(spark: SparkSession, path: str, **window: int | str) -> DataFrame:
    spark.dataSource.register(RasterSource)
    reader = spark.read.format("geotiff").option("path", path)
    for k, v in window.items():
        reader = reader.option(k, v)
    return reader.load()


def scan(spark: SparkSession, path: str, condition: str) -> DataFrame:
    """The cells for which a condition holds; its comparisons of row, col, lon and lat with constants prune strips and columns.

    Spark remembers for a loaded table what was pushed to it last, for all its
    uses.  So each call loads the table anew, and later filters stay above a sample
    of everything, which they can't pass.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return read_raster(spark, path, push="true").where(condition).sample(1.0)


def valid_cells(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Cells of the window that a box needs, without nodata, NaN and infinite values, with their bounds."""
    r = header(path)
    cols = max(0, math.floor((box[0] - r.origin_lon) / r.pixel_width)), min(r.width - 1, math.ceil((box[2] - r.origin_lon) / r.pixel_width) - 1)
    rows = max(0, math.floor((r.origin_lat - box[3]) / r.pixel_height)), min(r.height - 1, math.ceil((r.origin_lat - box[1]) / r.pixel_height) - 1)
    if cols[0] > cols[1] or rows[0] > rows[1]:
        raise RasterError("the box lies outside the raster")
    v = F.col("value")
    ok = ~F.isnan(v) & (F.abs(v) != float("inf"))
    if r.nodata is not None:
        ok = ok & (v != r.nodata)
    cells = read_raster(spark, path, row_min=rows[0], row_max=rows[1], col_min=cols[0], col_max=cols[1]).where(ok).drop("lon", "lat")
    return cells.withColumns(cell_bounds(F.col("row"), F.col("col"), r.origin_lon, r.origin_lat, r.pixel_width, r.pixel_height)).withColumnRenamed("value", "population_density")
