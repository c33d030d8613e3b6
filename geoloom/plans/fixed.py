"""Cover of a border by circles of two fixed radii.

A candidate is a pair of lattice spacings; candidates are rows, each evaluated in
a task of its own by ``applyInPandas``, as its patches depend on one another in
order.  The driver only sees the candidates' scores and the winner's circles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FixedConfig
from ..functions.scalars import EPS, hex_spacing
from ..operators import region as R

SMALL, LARGE = 500.0, 1000.0
#: Fixed values of the search: least, greatest spacing; coarse range and step; fine window and step; local window.
BOUNDS = {SMALL: (650, 950), LARGE: (1300, 1900)}
COARSE = {SMALL: (700, 900, 25), LARGE: (1400, 1800, 25)}
FINE = {SMALL: (25, 5), LARGE: (50, 25)}
LOCAL = {SMALL: 25, LARGE: 25}
SHIFT_STEP, SHIFT_MOST, SHIFT_ANGLES = 100.0, 2000.0, 16


@dataclass(frozen=True)
class Zones:
    """Edges of the border and of the parts for small and for large circles, in metres."""

    border: np.ndarray
    small: np.ndarray
    large: np.ndarray

    @classmethod
    def of(cls, border: np.ndarray, small: np.ndarray) -> Zones:
        """The small zone is cut to the border; the large one is the rest."""
        own = R.combined([border, small], lambda f: f[0] & f[1])
        rest = R.combined([border, small], lambda f: f[0] & ~f[1])
        if not len(own) or not len(rest):
            raise ValueError("a zone is empty")
        return cls(border, own, rest)


def box(e: np.ndarray, margin: float = 0.0) -> tuple[float, float, float, float]:
    x, y = e[:, [0, 2]], e[:, [1, 3]]
    return x.min() - margin, y.min() - margin, x.max() + margin, y.max() + margin


def lattice(bounds: tuple[float, float, float, float], spacing: float) -> np.ndarray:
    """Staggered nodes (x, y), row by row."""
    x0, y0, x1, y1 = bounds
    step = spacing * math.sqrt(3.0) / 2
    out = []
    for row in range(int((y1 - y0 + EPS) // step) + 1):
        left = x0 + (spacing / 2 if row % 2 else 0.0)
        n = int((x1 + EPS - left) // spacing) + 1
        if n > 0:
            out.append(np.stack([left + spacing * np.arange(n), np.full(n, y0 + row * step)], axis=1))
    return np.concatenate(out) if out else np.empty((0, 2))


def sample_points(e: np.ndarray, step: float) -> np.ndarray:
    """Multiples of the step inside the region, row by row."""
    x0, y0, x1, y1 = box(e)
    xs, ys = np.arange(math.floor(x0 / step), math.ceil(x1 / step) + 1) * step, np.arange(math.floor(y0 / step), math.ceil(y1 / step) + 1) * step
    p = np.stack([np.tile(xs, len(ys)), np.repeat(ys, len(xs))], axis=1)
    return p[R.covers(p[:, 0], p[:, 1], e)]


def admissible(p: np.ndarray, zones: Zones, small: np.ndarray) -> np.ndarray:
    """Places for a large circle: near the large zone, outside the small one, not within 500 m of a small centre."""
    ok = R.buffer_covers(p[:, 0], p[:, 1], zones.large, LARGE) & ~R.covers(p[:, 0], p[:, 1], zones.small)
    if len(small):
        d2 = ((p[:, None, :] - small[None, :, :]) ** 2).sum(axis=2).min(axis=1)
        ok &= d2 > SMALL * SMALL + EPS
    return ok


def bare(p: np.ndarray, circles: np.ndarray) -> np.ndarray:
    if not len(circles):
        return np.ones(len(p), bool)
    out = np.ones(len(p), bool)
    for i in range(0, len(p), 4096):
        q = p[i : i + 4096]
        out[i : i + 4096] = ~((((q[:, None, :] - circles[None, :, :2]) ** 2).sum(axis=2)) <= circles[:, 2] ** 2 + EPS).any(axis=1)
    return out


_ANGLES = 2 * math.pi * np.arange(SHIFT_ANGLES) / SHIFT_ANGLES
_SPIRAL = np.concatenate([np.zeros((1, 2)), *[np.stack([d * np.cos(_ANGLES), d * np.sin(_ANGLES)], axis=1) for d in np.arange(SHIFT_STEP, SHIFT_MOST + EPS, SHIFT_STEP)]])


class Cover:
    """Circles so far: small and large centres, each place once."""

    def __init__(self, zones: Zones, small: np.ndarray, large: np.ndarray) -> None:
        self.zones, self.small, self.large = zones, [tuple(p) for p in small], [tuple(p) for p in large]
        self.keys = {self.key(p, SMALL) for p in self.small} | {self.key(p, LARGE) for p in self.large}

    @staticmethod
    def key(p, r: float) -> tuple[float, float, float]:
        return round(p[0], 3), round(p[1], 3), r

    def circles(self) -> np.ndarray:
        return np.array([(*p, SMALL) for p in self.small] + [(*p, LARGE) for p in self.large]).reshape(-1, 3)

    def add(self, p, r: float) -> bool:
        k = self.key(p, r)
        if k in self.keys:
            return False
        self.keys.add(k)
        (self.small if r == SMALL else self.large).append((float(p[0]), float(p[1])))
        return True

    def patch(self, p: np.ndarray) -> bool:
        """Covers a place: a small circle in the small zone, else the first admissible large one around it, else a small one."""
        if not R.buffer_covers(p[:1], p[1:], self.zones.small, SMALL)[0]:
            options = p + _SPIRAL
            good = np.flatnonzero(admissible(options, self.zones, np.array(self.small).reshape(-1, 2)))
            for k in good[:1]:
                if ((options[k] - p) ** 2).sum() <= LARGE * LARGE and self.add(options[k], LARGE):
                    return True
        return self.add(p, SMALL)


def evaluate(zones: Zones, spacing_small: int, spacing_large: int, config: FixedConfig, samples: np.ndarray) -> tuple[np.ndarray, int] | None:
    """(circles, exact patches) of a candidate, or None where it isn't valid."""
    s = lattice(box(zones.small, SMALL), spacing_small)
    s = s[R.buffer_covers(s[:, 0], s[:, 1], zones.small, SMALL)]
    g = lattice(box(zones.large, LARGE), spacing_large)
    g = g[R.buffer_covers(g[:, 0], g[:, 1], zones.large, LARGE)]
    cover = Cover(zones, s, g[admissible(g, zones, s)] if len(g) else g)
    added = 0
    for _ in range(config.rounds):
        left = samples[bare(samples, cover.circles())]
        if not len(left):
            break
        for p in left:
            if bare(p[None], cover.circles())[0]:
                if not cover.patch(p):
                    return None
                added += 1
                if added > config.additions:
                    return None
    patches = 0
    for _ in range(config.exact_patches + 1):
        missing, rest = R.uncovered(zones.border, cover.circles())
        if missing <= config.tolerance_m2 + EPS:
            break
        if patches == config.exact_patches or not any(cover.patch(np.array([q.x, q.y])) for q in rest):
            return None
        patches += 1
    circles = cover.circles()
    return (circles, patches) if valid(zones, circles, config, samples) else None


def valid(zones: Zones, circles: np.ndarray, config: FixedConfig, samples: np.ndarray) -> bool:
    """Nothing missing, no sample bare, no large centre within 500 m of a small one."""
    small, large = circles[circles[:, 2] == SMALL, :2], circles[circles[:, 2] == LARGE, :2]
    if len(small) and len(large) and (((small[:, None] - large[None]) ** 2).sum(axis=2) <= SMALL * SMALL + EPS).any():
        return False
    return not bare(samples, circles).any() and R.uncovered(zones.border, circles)[0] <= config.tolerance_m2 + EPS


def spacings(config: FixedConfig, stage: str, around: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """Candidates of a stage, in the order of testing."""
    out = []
    for k, (r, step) in enumerate(((SMALL, 5), (LARGE, 25))):
        lo, hi = BOUNDS[r]
        base = hex_spacing(r, lo, hi, step)
        if stage == "coarse":
            a, b, s = COARSE[r]
            out.append(list(range(a, b + 1, s)))
        elif stage == "fine":
            d, s = FINE[r]
            out.append(list(range(max(lo, around[k] - d), min(hi, around[k] + d) + 1, s)))
        elif config.mode == "fast-local":
            out.append(sorted({min(hi, max(lo, base + d)) for d in (-LOCAL[r], 0, LOCAL[r])}))
        else:
            out.append([base])
    return [(a, b) for a in out[0] for b in out[1]]


CANDIDATE = "test int, spacing_small int, spacing_large int, n int, n_small int, patches int, circles array<struct<x: double, y: double, radius: double>>"


def candidates(spark: SparkSession, zones: Zones, config: FixedConfig, tries: list[tuple[int, int]]) -> DataFrame:
    """Valid candidates with their circles; one group for each."""
    samples = sample_points(zones.border, config.coverage_step)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t, a, b in pdf.itertuples(index=False):
            found = evaluate(zones, int(a), int(b), config, samples)
            if found:
                c, patches = found
                rows.append((t, a, b, len(c), int((c[:, 2] == SMALL).sum()), patches, [{"x": x, "y": y, "radius": r} for x, y, r in c.tolist()]))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in ("test", "spacing_small", "spacing_large", "n", "n_small", "patches", "circles")])

    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(tries)], "test int, spacing_small int, spacing_large int")
    return table.repartition(max(1, len(tries)), "test").groupBy("test").applyInPandas(run, CANDIDATE)


def best(found: DataFrame) -> DataFrame:
    """Fewest circles, then exact patches, then small circles; wider spacings win ties."""
    return found.orderBy("n", "patches", "n_small", F.desc("spacing_small"), F.desc("spacing_large"), "test").limit(1)


def plan(spark: SparkSession, zones: Zones, config: FixedConfig | None = None) -> DataFrame:
    """Circles (x, y, radius) of the best candidate."""
    config = config or FixedConfig()
    first = best(candidates(spark, zones, config, spacings(config, "coarse" if config.mode == "auto" else "fast")))
    if config.mode == "auto":
        row = first.first()
        if row is None:
            raise RuntimeError("no valid candidate")
        fine = candidates(spark, zones, config, spacings(config, "fine", (row["spacing_small"], row["spacing_large"])))
        coarse = spark.createDataFrame([row], first.schema).withColumn("test", F.lit(-1))
        first = best(coarse.unionByName(fine))
    return first.select(F.explode("circles").alias("c")).select("c.x", "c.y", F.col("c.radius").cast("int").alias("radius")).orderBy("radius", "y", "x")
