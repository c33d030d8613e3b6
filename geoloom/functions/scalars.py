"""Scalar expressions: distances, projection, density and radius models, rounding, grid indices."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE = 111_320.0
EPS = 1e-9


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres on the sphere."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


def unit_vector(lat: Column, lng: Column) -> tuple[Column, Column, Column]:
    """Place on a sphere of radius EARTH_RADIUS_M; straight distances never exceed those along the sphere."""
    p, m = F.radians(lat), F.radians(lng)
    return EARTH_RADIUS_M * F.cos(p) * F.cos(m), EARTH_RADIUS_M * F.cos(p) * F.sin(m), EARTH_RADIUS_M * F.sin(p)


def squared(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def project(lat: Column, lng: Column, lat0: float, lng0: float) -> tuple[Column, Column]:
    """Local plane in metres: x to the east, y to the north of (lat0, lng0)."""
    k = METRES_PER_DEGREE * math.cos(math.radians(lat0))
    return (lng - lng0) * k, (lat - lat0) * METRES_PER_DEGREE


def unproject(x: Column, y: Column, lat0: float, lng0: float) -> tuple[Column, Column]:
    """(lat, lng) of a place on the local plane."""
    k = METRES_PER_DEGREE * math.cos(math.radians(lat0))
    return y / METRES_PER_DEGREE + lat0, x / k + lng0


def density_norm(density: Column, lo: Column, hi: Column) -> Column:
    """Log density between its low and high percentiles, clipped to 0..1; 1 where they coincide."""
    v = F.log1p(F.greatest(density, F.lit(0.0)))
    return F.when(hi <= lo, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (v - lo) / (hi - lo))))


def radius_of_norm(norm: Column, least: Column | int, most: Column | int, step: int = 25) -> Column:
    """Dense places get small circles: snapped to ``step``, halves to even, clamped."""
    least, most = (F.lit(float(v)) if isinstance(v, (int, float)) else v.cast("double") for v in (least, most))
    snapped = F.rint((most - norm * (most - least)) / step) * step
    return F.least(most, F.greatest(least, snapped)).cast("int")


def hex_spacing(radius: float, least: int, most: int, step: int) -> int:
    """Lattice spacing at which circles of a radius just cover the plane, snapped and clamped."""
    return int(min(most, max(least, round(math.sqrt(3.0) * radius / step) * step)))


def hex_spacing_of(radius: Column, least: int, most: int, step: int) -> Column:
    """The same for radii in rows."""
    return F.least(F.lit(most), F.greatest(F.lit(least), (F.rint(math.sqrt(3.0) * radius / step) * step).cast("int")))


def spacing_range(least: int, most: int, step: int) -> Column:
    return F.sequence(F.lit(least), F.lit(most), F.lit(step))


def round6(c: Column) -> Column:
    return F.round(c, 6)


def metre_key(x: Column, y: Column) -> Column:
    """Places that coincide to a millimetre."""
    return F.struct(F.round(x, 3).alias("kx"), F.round(y, 3).alias("ky"))


def index_window(lo: Column, hi: Column, origin: Column, pixel: Column, size: Column) -> tuple[Column, Column]:
    """First and last index of the pixels that a range touches, inside 0..size-1."""
    first = F.greatest(F.lit(0), F.floor((lo - origin) / pixel).cast("int"))
    last = F.least(size - 1, (F.ceil((hi - origin) / pixel) - 1).cast("int"))
    return first, last


def is_close(a: Column, b: Column, rel: float = 1e-9) -> Column:
    return F.abs(a - b) <= rel * F.greatest(F.abs(a), F.abs(b))


def is_finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != float("inf"))


#: The five stops of the density colours.
RAMP = ("f7fcf0", "ccebc5", "7bccc4", "2b8cbe", "084081")


def ramp_color(value: Column, lo: Column, hi: Column) -> Column:
    """Colour of a value, linear between the stops, clamped at both ends."""
    n = len(RAMP) - 1
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - lo) / (hi - lo))) * n
    i = F.least(F.lit(n - 1), F.floor(t).cast("int"))
    f = t - i

    def channel(k: int) -> Column:
        stops = F.array(*[F.lit(int(c[2 * k : 2 * k + 2], 16)) for c in RAMP])
        v = F.get(stops, i) + f * (F.get(stops, i + 1) - F.get(stops, i))
        return F.lpad(F.lower(F.hex(F.floor(v + 0.5).cast("long"))), 2, "0")

    return F.concat(F.lit("#"), channel(0), channel(1), channel(2))
