"""Plane regions without a geometry library: predicates in numpy, Boolean boundaries, exact uncovered area.

Regions are edge arrays (n, 4); a Boolean combination of regions is a rule over
their containment flags.  The area that disks leave uncovered is swept in slabs
between the places where the order of the boundary curves changes; inside a slab
the area between two curves is integrated in closed form.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

Rule = Callable[[list[np.ndarray]], np.ndarray]


def inside(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Even-odd containment without the boundary rule."""
    x, y = np.atleast_1d(x)[:, None], np.atleast_1d(y)[:, None]
    up = (e[:, 1] > y) != (e[:, 3] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0]
    return (up & (x < at)).sum(axis=1) % 2 == 1


def edge_distance2(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    if not len(e):
        return np.full(np.atleast_1d(x).shape, np.inf)
    x, y = np.atleast_1d(x)[:, None], np.atleast_1d(y)[:, None]
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    t = np.clip(((x - e[:, 0]) * dx + (y - e[:, 1]) * dy) / (dx * dx + dy * dy), 0, 1)
    return ((x - e[:, 0] - t * dx) ** 2 + (y - e[:, 1] - t * dy) ** 2).min(axis=1)


def covers(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    return inside(x, y, e) | (edge_distance2(x, y, e) <= 1e-12)


def buffer_covers(x: np.ndarray, y: np.ndarray, e: np.ndarray, r: float) -> np.ndarray:
    return inside(x, y, e) | (edge_distance2(x, y, e) <= r * r + 1e-9)


def combined(layers: Sequence[np.ndarray], rule: Rule) -> np.ndarray:
    """Edges of the region for which ``rule`` holds: parts of the layers' edges with it on one side only."""
    pieces = []
    every = np.concatenate(layers)
    for e in every:
        cuts = {0.0, 1.0}
        d = e[2:] - e[:2]
        f = every[:, 2:] - every[:, :2]
        cross = d[0] * f[:, 1] - d[1] * f[:, 0]
        w = every[:, :2] - e[:2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[:, 0] * f[:, 1] - w[:, 1] * f[:, 0]) / cross
            u = (w[:, 0] * d[1] - w[:, 1] * d[0]) / cross
        ok = (np.abs(cross) > 1e-12) & (t > 1e-9) & (t < 1 - 1e-9) & (u > -1e-9) & (u < 1 + 1e-9)
        cuts |= set(t[ok].tolist())
        size = float(d @ d)
        for p in (every[:, :2], every[:, 2:]):  # edges along this one
            s = ((p - e[:2]) @ d) / size
            off = np.abs((p[:, 0] - e[0]) * d[1] - (p[:, 1] - e[1]) * d[0]) / math.sqrt(size)
            cuts |= set(s[(off < 1e-9) & (s > 1e-9) & (s < 1 - 1e-9)].tolist())
        at = sorted(cuts)
        pieces += [(*(e[:2] + a * d), *(e[:2] + b * d)) for a, b in zip(at, at[1:], strict=False)]
    p = np.unique(np.array(pieces).round(9), axis=0)
    p = p[(p[:, :2] != p[:, 2:]).any(axis=1)]
    mid, d = (p[:, :2] + p[:, 2:]) / 2, p[:, 2:] - p[:, :2]
    n = np.stack([-d[:, 1], d[:, 0]], axis=1) / np.linalg.norm(d, axis=1, keepdims=True) * 1e-6
    left, right = (rule([inside(*(mid + s * n).T, e) for e in layers]) for s in (1, -1))
    kept = p[left != right]
    ends = np.concatenate([kept[:, 2:], kept[:, :2]], axis=1)
    forward = (kept[:, 0] < kept[:, 2]) | ((kept[:, 0] == kept[:, 2]) & (kept[:, 1] < kept[:, 3]))
    first = np.where(forward[:, None], kept, ends)  # the same edge of two layers counts once, upright ones too
    return np.unique(first.round(9), axis=0)


@dataclass
class Cell:
    """What is left between two curves in one slab."""

    x0: float
    x1: float
    low0: float
    high0: float
    low1: float
    high1: float
    area: float


def _arc_integral(c: np.ndarray, a: float, b: float) -> float:
    """Area between a circle's upper half and its centre line."""
    x, r = c[0], c[2]

    def f(t: float) -> float:
        u = min(r, max(-r, t - x))
        return 0.5 * (u * math.sqrt(max(0.0, r * r - u * u)) + r * r * math.asin(min(1.0, max(-1.0, u / r))))

    return f(b) - f(a)


def uncovered_cells(e: np.ndarray, circles: np.ndarray) -> list[Cell]:
    """Cells of the region minus the disks (rows x, y, r)."""
    if len(circles):
        x0, y0, x1, y1 = min(e[:, 0].min(), e[:, 2].min()), min(e[:, 1].min(), e[:, 3].min()), max(e[:, 0].max(), e[:, 2].max()), max(e[:, 1].max(), e[:, 3].max())
        near = (circles[:, 0] + circles[:, 2] > x0) & (circles[:, 0] - circles[:, 2] < x1) & (circles[:, 1] + circles[:, 2] > y0) & (circles[:, 1] - circles[:, 2] < y1)
        circles = circles[near]
    cuts = [e[:, 0], e[:, 2]]
    n = len(circles)
    if n:
        x, y, r = circles.T
        cuts += [x - r, x + r]
        i, j = np.triu_indices(n, 1)
        dx, dy = x[j] - x[i], y[j] - y[i]
        d = np.hypot(dx, dy)
        ok = (d > 1e-12) & (d < r[i] + r[j]) & (d > np.abs(r[i] - r[j]))
        i, j, dx, dy, d = i[ok], j[ok], dx[ok], dy[ok], d[ok]
        a = (d * d + r[i] ** 2 - r[j] ** 2) / (2 * d)
        h = np.sqrt(np.maximum(0, r[i] ** 2 - a * a))
        cuts += [x[i] + (a * dx - s * h * dy) / d for s in (1, -1)]
        for ex in e:
            ux, uy = ex[2] - ex[0], ex[3] - ex[1]
            size = ux * ux + uy * uy
            b = ((ex[0] - x) * ux + (ex[1] - y) * uy) / size
            c = ((ex[0] - x) ** 2 + (ex[1] - y) ** 2 - r * r) / size
            root = b * b - c
            good = root > 0
            for s in (1, -1):
                t = -b[good] + s * np.sqrt(root[good])
                cuts.append(ex[0] + t[(t > 0) & (t < 1)] * ux)
    xs = np.unique(np.concatenate(cuts).round(9))
    xs = xs[(xs >= min(e[:, 0].min(), e[:, 2].min())) & (xs <= max(e[:, 0].max(), e[:, 2].max()))]
    xs = xs[np.concatenate([[True], np.diff(xs) > 1e-9])]
    lo, hi = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    out = []
    for a, b in zip(xs[:-1].tolist(), xs[1:].tolist(), strict=True):
        m = (a + b) / 2
        own = e[(lo < m) & (hi > m)]
        line = lambda ed, t: ed[1] + (ed[3] - ed[1]) * (t - ed[0]) / (ed[2] - ed[0])
        ys = sorted((line(ed, m), k) for k, ed in enumerate(own))
        spans = [(ys[k][0], ("e", own[ys[k][1]]), ys[k + 1][0], ("e", own[ys[k + 1][1]])) for k in range(0, len(ys) - 1, 2)]
        if n and spans:
            h2 = circles[:, 2] ** 2 - (circles[:, 0] - m) ** 2
            act = np.flatnonzero(h2 > 0)
            half = np.sqrt(h2[act])
            bottoms = circles[act, 1] - half
            order = np.argsort(bottoms)
            holes: list[list] = []  # merged disks' spans
            for k in order.tolist():
                c, yl, yh = circles[act[k]], bottoms[k], bottoms[k] + 2 * half[k]
                if holes and yl <= holes[-1][2]:
                    if yh > holes[-1][2]:
                        holes[-1][2:] = [yh, c]
                else:
                    holes.append([yl, c, yh, c])
            rest = []
            for yl, cl, yh, ch in spans:
                for hl, hc_low, hh, hc_high in holes:
                    if hh <= yl:
                        continue
                    if hl >= yh:
                        break
                    if hl > yl:
                        rest.append((yl, cl, hl, ("l", hc_low)))
                    yl, cl = hh, ("u", hc_high)
                    if yl >= yh:
                        break
                if yl < yh:
                    rest.append((yl, cl, yh, ch))
            spans = rest

        def at(curve, t: float) -> float:
            k, c = curve
            if k == "e":
                return line(c, t)
            s = math.sqrt(max(0.0, c[2] ** 2 - (t - c[0]) ** 2))
            return c[1] + s if k == "u" else c[1] - s

        def integral(curve, a: float = a, b: float = b) -> float:
            k, c = curve
            if k == "e":
                return (line(c, a) + line(c, b)) / 2 * (b - a)
            return c[1] * (b - a) + (1 if k == "u" else -1) * _arc_integral(c, a, b)

        for _, cl, _, ch in spans:
            area = integral(ch) - integral(cl)
            if area > 0:
                out.append(Cell(a, b, at(cl, a), at(ch, a), at(cl, b), at(ch, b), area))
    return out


@dataclass
class Part:
    """A connected piece with a place inside it."""

    area: float
    x: float
    y: float


def parts(cells: list[Cell]) -> list[Part]:
    """Connected pieces, largest first; the place is the middle of a piece's largest cell."""
    root = list(range(len(cells)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by_left: dict[float, list[int]] = {}
    for i, c in enumerate(cells):
        by_left.setdefault(round(c.x0, 9), []).append(i)
    for i, c in enumerate(cells):
        for j in by_left.get(round(c.x1, 9), ()):
            d = cells[j]
            if min(c.high1, d.high0) > max(c.low1, d.low0) + 1e-9:
                root[find(i)] = find(j)
    groups: dict[int, list[Cell]] = {}
    for i, c in enumerate(cells):
        groups.setdefault(find(i), []).append(c)
    out = []
    for own in groups.values():
        big = max(own, key=lambda c: c.area)
        out.append(Part(sum(c.area for c in own), (big.x0 + big.x1) / 2, (big.low0 + big.high0 + big.low1 + big.high1) / 4))
    return sorted(out, key=lambda p: -p.area)


def uncovered(e: np.ndarray, circles: np.ndarray) -> tuple[float, list[Part]]:
    """Area of the region that no disk covers, and its pieces."""
    cells = uncovered_cells(e, circles)
    return sum(c.area for c in cells), parts(cells)


def area(e: np.ndarray) -> float:
    return uncovered(e, np.empty((0, 3)))[0]
