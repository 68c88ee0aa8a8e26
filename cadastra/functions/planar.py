"""Exact tests of polygons over whole Arrow batches: points inside, distances to sides, common areas.

A ring may be closed or open. Polygons with holes or parts are arrays of rings; a point is inside where it is in an odd number
of them, so holes and parts need no order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

NO_EDGES = (np.zeros(0, np.int64), np.zeros((0, 4)))


def ring_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and (ax, ay, bx, by) of each side of a column of rings (list<struct<x, y>>); null rings have none."""
    if not len(column):
        return NO_EDGES
    size = np.asarray(column.value_lengths().fill_null(0), np.int64)
    points = column.flatten()
    if not len(points):
        return NO_EDGES
    xy = np.stack([np.asarray(points.field(0), float), np.asarray(points.field(1), float)], 1)
    row = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    after = np.arange(1, len(xy) + 1)
    last = (begin + size - 1)[size > 0]
    after[last] = begin[size > 0]
    return row, np.concatenate([xy, xy[after]], 1)


def polygon_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ring_edges, for columns of polygons (list<list<struct<x, y>>>) too."""
    if not pa.types.is_list(column.type.value_type) and not pa.types.is_large_list(column.type.value_type):
        return ring_edges(column)
    size = np.asarray(column.value_lengths().fill_null(0), np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    row, edges = ring_edges(column.flatten())
    return (owner[row], edges) if len(row) else NO_EDGES


def inside(row: np.ndarray, edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether point i is in polygon i, by ray casting; nan is in nothing."""
    ax, ay, bx, by = edges.T
    px, py = x[row], y[row]
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
    return np.bincount(row[cross], minlength=len(x)) % 2 == 1


def side_distance(row: np.ndarray, edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of point i from the nearest side of polygon i; infinite without sides."""
    ax, ay, bx, by = edges.T
    dx, dy = bx - ax, by - ay
    n2 = dx * dx + dy * dy
    t = np.clip(((x[row] - ax) * dx + (y[row] - ay) * dy) / np.where(n2 > 0, n2, 1), 0, 1) * (n2 > 0)
    out = np.full(len(x), np.inf)
    np.minimum.at(out, row, np.hypot(x[row] - ax - t * dx, y[row] - ay - t * dy))
    return out


def farthest_corner(row: np.ndarray, edges: np.ndarray, other: np.ndarray, sides: np.ndarray, n: int) -> np.ndarray:
    """For each row the largest distance of a corner of its polygon from the other's sides; infinite where that has none."""
    size = np.bincount(other, minlength=n)[row]
    k = np.repeat(np.arange(len(row)), size)
    at = np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size) + np.searchsorted(other, row)[k]
    out = np.zeros(n)
    np.maximum.at(out, row, side_distance(k, sides[at], edges[:, 0], edges[:, 1]))
    return out


def area(row: np.ndarray, edges: np.ndarray, n: int) -> np.ndarray:
    """Shoelace area of each ring of a column of single rings."""
    ax, ay, bx, by = edges.T
    return np.abs(np.bincount(row, ax * by - bx * ay, n)) / 2


def _spans(edges: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each pair and level y the x of the sides (pairs, sides, 4) that cross it, in order, padded with infinity."""
    ax, ay, bx, by = (edges[:, None, :, k] for k in range(4))
    y = y[:, :, None]
    hit = (np.minimum(ay, by) <= y) & (y < np.maximum(ay, by))
    with np.errstate(divide="ignore", invalid="ignore"):
        x = ax + (y - ay) * ((bx - ax) / (by - ay))
    x = np.sort(np.where(hit, x, np.inf), axis=2)
    return x[:, :, : max(2, int(hit.sum(2).max(initial=0)))]


def common_area(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Areas that polygons have in common, pair by pair, given by their sides (pairs, sides, 4); exact for any simple polygons,
    holes and parts included.

    Between neighbouring levels of corners and crossings no two sides cross, so what is common there is as long at mid-height as
    on average."""
    low = np.maximum(a[:, :, [1, 3]].min((1, 2)), b[:, :, [1, 3]].min((1, 2)))
    high = np.maximum(low, np.minimum(a[:, :, [1, 3]].max((1, 2)), b[:, :, [1, 3]].max((1, 2))))
    d, e = (a[:, :, 2:] - a[:, :, :2])[:, :, None], (b[:, :, 2:] - b[:, :, :2])[:, None]
    gap = b[:, None, :, :2] - a[:, :, None, :2]
    cross = lambda p, q: p[..., 0] * q[..., 1] - p[..., 1] * q[..., 0]
    det = cross(d, e)
    with np.errstate(divide="ignore", invalid="ignore"):
        s, t = cross(gap, e) / det, cross(gap, d) / det
        meet = np.where((s > 0) & (s < 1) & (t > 0) & (t < 1), a[:, :, None, 1] + s * d[..., 1], low[:, None, None])
    if len(a) == 1:
        meet = meet[meet > low[0]][None]
    levels = np.concatenate([a[:, :, 1], b[:, :, 1], meet.reshape(len(a), -1), low[:, None], high[:, None]], 1)
    levels = np.sort(np.clip(levels, low[:, None], high[:, None]), axis=1)
    height, mid = np.diff(levels), (levels[:, 1:] + levels[:, :-1]) / 2
    p, q = _spans(a, mid), _spans(b, mid)
    total = np.zeros(mid.shape)
    for u in range(0, p.shape[2] - 1, 2):
        for v in range(0, q.shape[2] - 1, 2):
            with np.errstate(invalid="ignore"):
                both = np.minimum(p[:, :, u + 1], q[:, :, v + 1]) - np.maximum(p[:, :, u], q[:, :, v])
            total += np.where(np.isfinite(both), np.maximum(both, 0), 0)
    return (total * height).sum(1)


def common_areas(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int, most: int = 2_000_000) -> np.ndarray:
    """common_area of each row's two polygons; pairs with equal numbers of sides go together, at most about `most` numbers at
    once."""
    out = np.zeros(n)
    m, k = np.bincount(left[0], minlength=n), np.bincount(right[0], minlength=n)
    begin = [np.searchsorted(side[0], np.arange(n)) for side in (left, right)]
    for p, q in np.unique(np.stack([m, k], 1), axis=0).tolist():
        if not p or not q:
            continue
        rows = np.flatnonzero((m == p) & (k == q))
        step = max(1, most // ((p + q + p * q) * (p + q)))
        for at in range(0, len(rows), step):
            r = rows[at : at + step]
            out[r] = common_area(left[1][begin[0][r][:, None] + np.arange(p)], right[1][begin[1][r][:, None] + np.arange(q)])
    return out
