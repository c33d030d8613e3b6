"""Zones from boundaries: pieces of Boolean combinations, pieces that hold an anchor, the merged border.

All take and give edge arrays in one plane (degrees or metres: the map between
them is affine, so Boolean results are the same in both).
"""

from __future__ import annotations

import numpy as np

from ..operators.region import combined, covers, inside


def rings(e: np.ndarray) -> list[list[tuple[float, float]]]:
    """Closed rings of an edge set; where rings touch, the sharpest turn to the left keeps them apart."""
    at: dict[tuple[float, float], list[int]] = {}
    key = lambda p: (round(float(p[0]), 6), round(float(p[1]), 6))
    for i, (a, b) in enumerate(zip(e[:, :2], e[:, 2:], strict=True)):
        at.setdefault(key(a), []).append(i)
        at.setdefault(key(b), []).append(i)
    free, out = set(range(len(e))), []
    while free:
        i = min(free)
        free.discard(i)
        path = [tuple(e[i, :2].tolist()), tuple(e[i, 2:].tolist())]
        while key(path[-1]) != key(path[0]):
            here, before = np.array(path[-1]), np.array(path[-2])
            options = [j for j in at[key(here)] if j in free]
            if not options:
                break

            def turn(j: int, here=here, before=before) -> float:
                other = e[j, 2:] if key(e[j, :2]) == key(here) else e[j, :2]
                a, b = before - here, other - here
                return float(np.arctan2(a[0] * b[1] - a[1] * b[0], a @ b) % (2 * np.pi))

            j = min(options, key=turn)
            free.discard(j)
            path.append(tuple((e[j, 2:] if key(e[j, :2]) == key(here) else e[j, :2]).tolist()))
        if len(path) > 3:
            out.append(path)
    return out


def polygons(e: np.ndarray) -> list[np.ndarray]:
    """Connected pieces as edge arrays: an outer ring with the holes right inside it."""
    every = rings(e)
    arrays = [np.array([(*a, *b) for a, b in zip(r, r[1:], strict=False)]) for r in every]
    depth, owner = [], []
    for i, r in enumerate(every):
        p = (np.array(r[0]) + np.array(r[1])) / 2
        around = [j for j in range(len(every)) if j != i and inside(p[:1], p[1:], arrays[j])[0]]
        depth.append(len(around))
        owner.append(around)
    out = []
    for i in range(len(every)):
        if depth[i] % 2 == 0:
            holes = [arrays[j] for j in range(len(every)) if depth[j] == depth[i] + 1 and i in owner[j]]
            out.append(np.concatenate([arrays[i], *holes]))
    return out


def anchored(e: np.ndarray, anchor: tuple[float, float]) -> np.ndarray:
    """The pieces that cover an anchor."""
    kept = [p for p in polygons(e) if covers(np.array([anchor[0]]), np.array([anchor[1]]), p)[0]]
    return np.concatenate(kept) if kept else np.empty((0, 4))


def supplement(district: np.ndarray, city: np.ndarray, hill: np.ndarray, anchor: tuple[float, float]) -> np.ndarray:
    """What the district has besides city and hill, around the anchor; it must exist."""
    out = anchored(combined([district, city, hill], lambda f: f[0] & ~(f[1] | f[2])), anchor)
    if not len(out):
        raise ValueError("no part of the district holds the anchor")
    return out


def merged_border(city: np.ndarray, hill: np.ndarray, extra: np.ndarray) -> np.ndarray:
    return combined([city, hill, extra], lambda f: f[0] | f[1] | f[2])


def half_plane(box: tuple[float, float, float, float], east: float) -> np.ndarray:
    """Everything of a box up to a meridian."""
    x0, y0, _, y1 = box
    p = [(x0, y0), (east, y0), (east, y1), (x0, y1)]
    return np.array([(*a, *b) for a, b in zip(p, [*p[1:], p[0]], strict=True)])


def small_zone(city: np.ndarray, extra: np.ndarray, border: np.ndarray, west_limit: float) -> np.ndarray:
    """City and supplement inside the border, without the supplement's part west of a meridian."""
    x, y = border[:, [0, 2]], border[:, [1, 3]]
    west = half_plane((x.min() - 1, y.min() - 1, x.max() + 1, y.max() + 1), west_limit)
    out = combined([city, extra, border, west], lambda f: ((f[0] | f[1]) & f[2]) & ~(f[1] & f[3]))
    if not len(out):
        raise ValueError("the zone is empty")
    return out


def geojson(e: np.ndarray, properties: dict | None = None) -> dict:
    """A feature collection with one MultiPolygon."""
    shapes = []
    for p in polygons(e):
        own = sorted(rings(p), key=lambda r: -abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False))))
        shapes.append([[list(q) for q in r] for r in own])
    return {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": properties or {}, "geometry": {"type": "MultiPolygon", "coordinates": shapes}}]}
