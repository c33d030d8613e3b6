"""Cover of a border by circles whose radius follows population density.

Candidates are rows (scale, band step, phase), each evaluated in a task of its
own: seeding, patching and pruning depend on their order.  A number of candidates
takes the place of a wall clock, so results repeat.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import AdaptiveConfig
from ..functions.scalars import EPS
from ..operators import region as R
from ..operators.generators import ROOT3, radius_bands
from ..session import cut
from .fixed import bare, box, sample_points

SEED_NORM = 0.40
#: Least normalised distances that a patch tries in turn, and the one it would like.
LADDER, WANTED_NORM = (0.50, 0.45, 0.40, 0.35, 0.25, 0.0), 0.55
FOCUS = 24


def baseline_grid(spark: SparkSession, config: AdaptiveConfig) -> DataFrame:
    """(order, scale, band): the middle of the ranges first."""
    s = spark.createDataFrame([(x,) for x in config.scales], "scale double")
    b = spark.createDataFrame([(x,) for x in config.band_steps], "band int")
    w = Window.orderBy(F.abs(F.col("scale") - 0.94), F.abs(F.col("band") - 100), "scale", "band")
    return s.join(F.broadcast(b)).withColumn("order", F.row_number().over(w))


def phase_grid(spark: SparkSession, config: AdaptiveConfig) -> DataFrame:
    """(order, px, py): no shift first."""
    p = spark.createDataFrame([(x,) for x in config.phases], "px double")
    w = Window.orderBy(((F.col("px") != 0) | (F.col("py") != 0)).cast("int"), F.abs(F.col("px") - 0.5) + F.abs(F.col("py") - 0.25), "px", "py")
    return p.join(F.broadcast(p.withColumnRenamed("px", "py"))).withColumn("order", F.row_number().over(w))


class Density:
    """Interpolated density of places, and the radius that it asks for."""

    def __init__(self, cells: np.ndarray, least: int, most: int) -> None:
        self.xy, self.d, self.least, self.most = cells[:, :2], cells[:, 2], least, most
        v = np.log1p(np.maximum(0, self.d))
        self.lo, self.hi = np.percentile(v, 5), np.percentile(v, 95)
        self.known: dict[tuple[float, float], tuple[float, int]] = {}

    def at(self, p: np.ndarray) -> np.ndarray:
        """Mean of the four nearest cells by inverse squared distance."""
        out = np.empty(len(p))
        for i, q in enumerate(p):
            d2 = ((self.xy - q) ** 2).sum(axis=1)
            k = np.argsort(d2, kind="stable")[:4]
            w = 1 / np.maximum(d2[k], 1e-12)
            out[i] = self.d[k[0]] if d2[k[0]] <= 1e-12 else float((self.d[k] * w).sum() / w.sum())
        return out

    def radius(self, density: np.ndarray) -> np.ndarray:
        n = np.ones(len(density)) if self.hi <= self.lo else np.clip((np.log1p(np.maximum(0, density)) - self.lo) / (self.hi - self.lo), 0, 1)
        return np.clip(np.rint((self.most - n * (self.most - self.least)) / 25) * 25, self.least, self.most)

    def both(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = [(round(float(x), 3), round(float(y), 3)) for x, y in p]
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            d = self.at(p[new])
            for i, a, r in zip(new, d, self.radius(d), strict=True):
                self.known[keys[i]] = (float(a), int(r))
        return np.array([self.known[k][0] for k in keys]), np.array([self.known[k][1] for k in keys], float)


class Bands:
    """Lattices of all radius bands."""

    def __init__(self, bounds, least: int, most: int, step: int, scale: float, phase: tuple[float, float]) -> None:
        self.low_high = [(lo, hi) for _, lo, hi in radius_bands(least, most, step)]
        self.spacing = np.array([ROOT3 * hi * scale for _, hi in self.low_high])
        self.row = self.spacing * ROOT3 / 2
        self.x0, self.y0 = bounds[0] + phase[0] * self.spacing, bounds[1] + phase[1] * self.row

    def node(self, k: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        return np.stack([self.x0[k] + (row % 2) * self.spacing[k] / 2 + col * self.spacing[k], self.y0[k] + row * self.row[k]], axis=-1)

    def within(self, k: int, bounds) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(math.floor((bounds[1] - self.y0[k]) / self.row[k]) - 1, math.ceil((bounds[3] - self.y0[k]) / self.row[k]) + 2)
        out_r, out_c = [], []
        for r in rows.tolist():
            left = self.x0[k] + (r % 2) * self.spacing[k] / 2
            c = np.arange(math.floor((bounds[0] - left) / self.spacing[k]) - 1, math.ceil((bounds[2] - left) / self.spacing[k]) + 2)
            out_r.append(np.full(len(c), r))
            out_c.append(c)
        return np.concatenate(out_r), np.concatenate(out_c)

    def near(self, k: int, p: np.ndarray, ring: int, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes around the node nearest to a place (rows, columns, distances), nearest first; that node alone if none is in reach."""
        row0 = round((p[1] - self.y0[k]) / self.row[k])
        options = []
        for r in (row0 - 1, row0, row0 + 1):
            c = round((p[0] - self.x0[k] - (r % 2) * self.spacing[k] / 2) / self.spacing[k])
            options.append((float(np.hypot(*(self.node(k, np.array(r), np.array(c)) - p))), r, c))
        best = min(options, key=lambda o: o[0])
        r, c = (g.ravel() for g in np.meshgrid(np.arange(best[1] - ring, best[1] + ring + 1), np.arange(best[2] - ring, best[2] + ring + 1), indexing="ij"))
        d = np.hypot(*(self.node(k, r, c) - p).T)
        ok = d <= reach
        if not ok.any():
            return np.array([best[1]]), np.array([best[2]]), np.array([best[0]])
        order = np.argsort(d[ok], kind="stable")
        return r[ok][order], c[ok][order], d[ok][order]

    def band_of(self, radius: float) -> int:
        """The band whose radius is nearest; the first of equals."""
        return int(np.argmin([abs(hi - radius) for _, hi in self.low_high]))


def norm_to(p: np.ndarray, r: np.ndarray, circles: np.ndarray) -> np.ndarray:
    """Least distance over the sum of radii."""
    if not len(circles):
        return np.full(len(p), np.inf)
    return (np.hypot(p[:, None, 0] - circles[None, :, 0], p[:, None, 1] - circles[None, :, 1]) / (r[:, None] + circles[None, :, 2])).min(axis=1)


class Candidate:
    """One configuration's circles: rows x, y, radius, density, band, row, column."""

    def __init__(self, border: np.ndarray, samples: np.ndarray, density: Density, bands: Bands, config: AdaptiveConfig) -> None:
        self.border, self.samples, self.density, self.bands, self.config = border, samples, density, bands, config
        self.rows: list[tuple] = []
        self.keys: set[tuple[float, float]] = set()
        self.count = np.zeros(len(samples), np.int64)
        self.gap = np.full(len(samples), np.inf)

    @property
    def circles(self) -> np.ndarray:
        return np.array(self.rows, float).reshape(-1, 7)

    def add(self, p: np.ndarray, r: float, d: float, band: int, row: int, col: int) -> None:
        self.keys.add((round(float(p[0]), 3), round(float(p[1]), 3)))
        self.rows.append((float(p[0]), float(p[1]), float(r), float(d), band, int(row), int(col)))
        d2 = ((self.samples - p) ** 2).sum(axis=1)
        self.count += d2 <= r * r + EPS
        self.gap = np.minimum(self.gap, d2)

    def seed(self) -> None:
        """Large bands first; a node is taken whose own radius lies in its band, if no circle covers it or is too near."""
        for k, (lo, hi) in enumerate(self.bands.low_high):
            row, col = self.bands.within(k, box(self.border, float(hi)))
            p = self.bands.node(k, row, col)
            ok = R.buffer_covers(p[:, 0], p[:, 1], self.border, float(hi))
            row, col, p = row[ok], col[ok], p[ok]
            if not len(p):
                continue
            d, r = self.density.both(p)
            for i in np.flatnonzero((r >= lo) & (r <= hi)):
                c = self.circles
                if not bare(p[i : i + 1], c[:, :3])[0] or norm_to(p[i : i + 1], r[i : i + 1], c)[0] < SEED_NORM:
                    continue
                if (round(float(p[i, 0]), 3), round(float(p[i, 1]), 3)) not in self.keys:
                    self.add(p[i], r[i], d[i], k, row[i], col[i])

    def options(self, p: np.ndarray, least: float):
        """Lattice nodes that may patch a place, with what a score needs."""
        _, want = self.density.both(p[None])
        k = self.bands.band_of(want[0])
        reach = self.config.patch_factor * want[0]
        row, col, dist = self.bands.near(k, p, self.config.ring, reach)
        q = self.bands.node(k, row, col)
        d, r = self.density.both(q)
        nn = norm_to(q, r, self.circles)
        fresh = np.array([(round(float(x), 3), round(float(y), 3)) not in self.keys for x, y in q])
        ok = fresh & (nn >= least)
        ok &= np.array([R.buffer_covers(q[i, :1], q[i, 1:], self.border, float(r[i]))[0] if ok[i] else False for i in range(len(q))])
        hit = ((self.samples[None] - q[:, None]) ** 2).sum(axis=2) <= r[:, None] ** 2 + EPS
        new, over = (hit & (self.count == 0)).sum(axis=1), (hit & (self.count > 0)).sum(axis=1)
        return k, row, col, q, d, r, nn, dist / max(reach, EPS), new, over, ok

    def score(self, new, over, dist, nn):
        c = self.config
        return c.count_penalty / new + c.regularity_weight * dist + c.overlap_penalty * over / new + np.maximum(0, WANTED_NORM - nn)

    def patch_samples(self) -> bool:
        added = 0
        while (self.count == 0).any():
            left = np.flatnonzero(self.count == 0)
            focus = left[np.argsort(-self.gap[left], kind="stable")][:FOCUS]
            pick = None
            for least in LADDER:
                for s in focus.tolist():
                    k, row, col, q, d, r, nn, dist, new, over, ok = self.options(self.samples[s], least)
                    for i in np.flatnonzero(ok & (new > 0)).tolist():
                        rank = (float(self.score(new[i], over[i], dist[i], nn[i])), -int(new[i]), float(dist[i]), -float(nn[i]))
                        if pick is None or rank < pick[0]:
                            pick = (rank, q[i], r[i], d[i], k, row[i], col[i])
                if pick:
                    break
            added += 1
            if pick is None or added > self.config.gap_patches:
                return False
            self.add(*pick[1:])
        return True

    def patch_exact(self) -> bool:
        for _ in range(self.config.exact_patches + 1):
            missing, rest = R.uncovered(self.border, self.circles[:, :3])
            if missing <= self.config.tolerance_m2 + EPS:
                return True
            p = np.array([rest[0].x, rest[0].y])
            pick = None
            for least in LADDER:
                k, row, col, q, d, r, nn, dist, new, over, ok = self.options(p, least)
                for i in np.flatnonzero(ok & (((q - p) ** 2).sum(axis=1) < r * r)).tolist():
                    area = R.uncovered(self.border, np.vstack([self.circles[:, :3], [*q[i], r[i]]]))[0]
                    aux = float(self.score(max(1, new[i]), over[i], dist[i], nn[i]))
                    if pick is None or area < pick[0] - 1e-9 or abs(area - pick[0]) <= 1e-9 and aux < pick[1]:
                        pick = (area, aux, q[i], r[i], d[i], k, row[i], col[i])
                if pick and pick[0] < missing - 1e-9:
                    break
            if pick is None or pick[0] >= missing - 1e-9:
                # no node of the lattice helps: a circle at the place itself
                d, r = self.density.both(p[None])
                if (round(float(p[0]), 3), round(float(p[1]), 3)) in self.keys:
                    return False
                self.add(p, r[0], d[0], self.bands.band_of(r[0]), 0, 0)
            else:
                self.add(*pick[2:])
        return False

    def prune(self) -> None:
        """Drops circles that neither a sample nor the exact area needs; those inside full hexagons last."""
        for _ in range(self.config.prune_passes):
            c = self.circles
            hit = ((self.samples[None] - c[:, None, :2]) ** 2).sum(axis=2) <= c[:, 2:3] ** 2 + EPS
            count = hit.sum(axis=0)
            nodes = {(int(b), int(r), int(k)) for b, r, k in c[:, 4:]}

            def protected(b: int, r: int, k: int, nodes=nodes) -> bool:
                o = r % 2
                return all((b, *n) in nodes for n in ((r, k - 1), (r, k + 1), (r - 1, k - 1 + o), (r - 1, k + o), (r + 1, k - 1 + o), (r + 1, k + o)))

            order = sorted(range(len(c)), key=lambda i: (protected(*map(int, c[i, 4:])), int((hit[i] & (count == 1)).sum()), int(hit[i].sum()), c[i, 2]))
            active = np.ones(len(c), bool)
            for i in order:
                if (count[hit[i]] <= 1).any():
                    continue
                active[i] = False
                near = np.hypot(c[:, 0] - c[i, 0], c[:, 1] - c[i, 1]) < c[:, 2] + c[i, 2]
                # only the disk that goes can open a gap: its own area is measured against its neighbours
                if gap_inside(self.border, c[i, :3], c[active & near, :3]) <= self.config.tolerance_m2 + EPS and R.uncovered(self.border, c[active, :3])[0] <= self.config.tolerance_m2 + EPS:
                    count -= hit[i]
                else:
                    active[i] = True
            if active.all():
                break
            self.rows = [r for r, a in zip(self.rows, active.tolist(), strict=True) if a]
            self.count = count

    def result(self) -> dict:
        c = self.circles
        nn = np.array([norm_to(c[i : i + 1, :2], c[i : i + 1, 2], np.delete(c, i, axis=0))[0] for i in range(len(c))])
        return {
            "n": len(c), "p25": float(np.percentile(nn, 25)) if len(c) > 1 else 0.0, "overlap": float((self.count >= 2).mean()), "mean_count": float(self.count.mean()),
            "circles": [{"x": r[0], "y": r[1], "radius": int(r[2]), "density": r[3]} for r in self.rows],
        }


def gap_inside(border: np.ndarray, disk: np.ndarray, others: np.ndarray) -> float:
    """A quick lower look: share of a ring of places in a disk that the border has and no other disk covers, as an area."""
    a = 2 * math.pi * np.arange(24) / 24
    p = np.concatenate([disk[None, :2], *[disk[:2] + f * disk[2] * np.stack([np.cos(a), np.sin(a)], axis=1) for f in (0.35, 0.7, 0.95)]])
    open_ = bare(p, others) & R.inside(p[:, 0], p[:, 1], border)
    return float(open_.mean() * math.pi * disk[2] ** 2)


CANDIDATE = "test int, scale double, band int, px double, py double, n int, p25 double, overlap double, mean_count double, circles array<struct<x: double, y: double, radius: int, density: double>>"


def evaluated(spark: SparkSession, border: np.ndarray, cells: np.ndarray, config: AdaptiveConfig, most: int, tries: list[tuple[float, int, float, float]], first: int = 0) -> DataFrame:
    """Valid candidates, each made in a group of its own."""
    samples = sample_points(border, config.coverage_step)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for t, scale, band, px, py in pdf.itertuples(index=False):
            bands = Bands(box(border), config.min_radius, most, int(band), float(scale), (float(px), float(py)))
            c = Candidate(border, samples, Density(cells, config.min_radius, most), bands, config)
            c.seed()
            if c.patch_samples() and c.patch_exact():
                c.prune()
                out.append({"test": t, "scale": scale, "band": band, "px": px, "py": py} | c.result())
        return pd.DataFrame(out, columns=[x.split()[0] for x in ("test", "scale", "band", "px", "py", "n", "p25", "overlap", "mean_count", "circles")])

    table = spark.createDataFrame([(first + i, *t) for i, t in enumerate(tries)], "test int, scale double, band int, px double, py double")
    return table.repartition(max(1, len(tries)), "test").groupBy("test").applyInPandas(run, CANDIDATE)


def best(found: DataFrame) -> DataFrame:
    """Fewest circles, widest spacing, least overlap; the first tested of equals."""
    return found.orderBy("n", F.desc("p25"), "overlap", "mean_count", "test").limit(1)


def largest_radius(cells: np.ndarray, config: AdaptiveConfig) -> int:
    """The configured one, or the larger the more the densities differ."""
    q10, q90 = np.percentile(cells[:, 2], [10, 90])
    more = next((m for at, m in ((60, 1400), (30, 1200), (15, 1000), (8, 800)) if q90 / max(q10, 1.0) >= at), 600)
    return config.max_radius or int(round(min(2500, max(config.min_radius + 200, config.min_radius + more)) / 50) * 50)


def pruned(spark: SparkSession, border: np.ndarray, cells: np.ndarray, config: AdaptiveConfig | None = None) -> DataFrame:
    """Circles (x, y, radius, density, kept) of the first valid candidate of the baseline, as patched, and whether pruning keeps them."""
    config = config or AdaptiveConfig()
    most, samples = largest_radius(cells, config), sample_points(border, config.coverage_step)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for order, scale, band in pdf[["order", "scale", "band"]].itertuples(index=False):
            bands = Bands(box(border), config.min_radius, most, int(band), float(scale), (0.0, 0.0))
            c = Candidate(border, samples, Density(cells, config.min_radius, most), bands, config)
            c.seed()
            if c.patch_samples() and c.patch_exact():
                before = list(c.rows)
                c.prune()
                left = set(c.rows)
                out += [(order, r[0], r[1], int(r[2]), r[3], r in left) for r in before]
        return pd.DataFrame(out, columns=["order", "x", "y", "radius", "density", "kept"])

    grid = baseline_grid(spark, config)
    found = cut(grid.repartition(len(config.scales) * len(config.band_steps), "order").groupBy("order").applyInPandas(run, "order int, x double, y double, radius int, density double, kept boolean"))
    return found.join(F.broadcast(found.agg(F.min("order").alias("order"))), "order").drop("order").orderBy("y", "x", "radius")


def plan(spark: SparkSession, border: np.ndarray, cells: np.ndarray, config: AdaptiveConfig | None = None) -> DataFrame:
    """Circles (x, y, radius, density) of the best candidate: all spacings and bands, then shifted lattices of the best ones."""
    config = config or AdaptiveConfig()
    most = largest_radius(cells, config)
    combos = [(r["scale"], r["band"]) for r in baseline_grid(spark, config).orderBy("order").collect()]
    phases = [(r["px"], r["py"]) for r in phase_grid(spark, config).orderBy("order").collect()]
    base = cut(evaluated(spark, border, cells, config, most, [(*c, 0.0, 0.0) for c in combos]))
    shifted = [p for p in phases if p != (0.0, 0.0)]
    if config.phase_budget and shifted:
        done = [(r["scale"], r["band"]) for r in base.drop("circles").orderBy("n", F.desc("p25"), "overlap", "mean_count", "test").collect()]
        ordered = done + [c for c in combos if c not in done]
        tries = [(*c, *p) for c in ordered for p in shifted][: config.phase_budget]
        base = base.unionByName(evaluated(spark, border, cells, config, most, tries, len(combos)))
    return best(base).select(F.explode("circles").alias("c")).select("c.*").orderBy("y", "x", "radius")
