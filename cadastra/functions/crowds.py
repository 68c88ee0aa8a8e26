"""Points of one tile against many shapes or many other points, in numpy: what is well inside is counted by cells, only what lies near a
shape's outline is tested. So a shape costs its outline, not its points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Numbers that a batch holds at once: rows of cells, points tested, and counts by cell and value.
ROWS, TESTED, TABLE = 50_000, 2_000_000, 8_000_000


def runs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range and the position, for all positions of the ranges begin .. end - 1."""
    size = np.maximum(end - begin, 0)
    k = np.repeat(np.arange(len(size)), size)
    return k, np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size) + begin[k]


def batches(size: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of rows whose sizes add up to about most."""
    part = np.cumsum(size) // most
    at = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(size)]]) if len(size) else np.zeros(0, int)
    yield from (slice(a, b) for a, b in zip(at[:-1], at[1:], strict=True))


class Grid:
    """Points in the order of cells, row by row, and by x within a row. Numbers of columns and rows never fall as x and y grow, so a point in
    a cell beyond that of a bound is beyond the bound, whatever rounds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, cells: float):
        self.ox, self.oy, width, height = x.min(), y.min(), x.max() - x.min(), y.max() - y.min()
        self.side = max(np.sqrt(width * height / cells), width / cells, height / cells) or 1.0
        self.nx, self.ny = int(width / self.side) + 2, int(height / self.side) + 2
        row = self.row(y)
        self.order = np.lexsort((x, row))
        self.x, self.y = x[self.order], y[self.order]
        self.cell = row[self.order] * self.nx + self.col(self.x)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(self.cell, minlength=self.nx * self.ny))])
        self.slack = 1e-9 * (1.0 + max(abs(self.ox), abs(self.oy)) + width + height)

    def col(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((x - self.ox) / self.side), -1, self.nx).astype(np.int64)

    def row(self, y: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((y - self.oy) / self.side), -1, self.ny).astype(np.int64)


def holds(x: np.ndarray, y: np.ndarray, box: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Whether point i is in shape i: the box without its upper sides (reach is nan), what is within reach of it, or what is in it and
    farther than -reach from its sides."""
    x0, y0, x1, y1 = box.T
    if len(reach) and np.isnan(reach).all():
        return (x >= x0) & (x < x1) & (y >= y0) & (y < y1)
    if len(reach) and (reach >= 0).all():
        dx, dy = np.maximum(np.maximum(x0 - x, x - x1), 0), np.maximum(np.maximum(y0 - y, y - y1), 0)
        return np.sqrt(dx * dx + dy * dy) <= reach
    out = np.minimum(np.minimum(x - x0, x1 - x), np.minimum(y - y0, y1 - y)) > -reach
    for kind in (np.isnan(reach), reach >= 0):
        if kind.any():
            out[kind] = holds(x[kind], y[kind], box[kind], reach[kind])
    return out


def spans(g: Grid, box: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Batches of (shape, a, p, q, d): in a row of cells the points in cells a .. p - 1 and q .. d - 1 may be in the shape, those in p .. q - 1
    are; cells are numbered through all rows."""
    x0, y0, x1, y1 = box.T
    flat, deep = ~(reach >= 0), np.where(reach < 0, -reach, 0.0)
    slack = np.where(np.isnan(reach), 0.0, g.slack)
    most = np.where(flat, slack - deep, reach + slack)
    low, high = np.maximum(g.row(y0 - most), 0), np.minimum(g.row(y1 + most), g.ny - 1)
    for some in batches(np.maximum(high - low + 1, 0), ROWS):
        k, row = runs(low[some], high[some] + 1)
        k += some.start
        flat_k, r, e = flat[k], np.where(flat, 0.0, reach)[k], slack[k]
        bottom, top = g.oy + row * g.side - e, g.oy + (row + 1) * g.side + e
        near, far = np.maximum(np.maximum(y0[k] - top, bottom - y1[k]), 0), np.maximum(np.maximum(y0[k] - bottom, top - y1[k]), 0)
        wide = np.where(flat_k, most[k], np.sqrt(np.maximum(r * r - near * near, 0)) + e)
        sure = np.where(flat_k, -deep[k] - e, np.sqrt(np.maximum(r * r - far * far, 0)) - e)
        whole = np.where(flat_k, (row > g.row(y0[k] + deep[k] + e)) & (row < g.row(y1[k] - deep[k] - e)), far < r)
        a, d = np.maximum(g.col(x0[k] - wide), 0), np.minimum(g.col(x1[k] + wide), g.nx - 1) + 1
        p, q = np.maximum(g.col(x0[k] - sure) + 1, 0), np.minimum(g.col(x1[k] + sure), g.nx)
        none = ~whole | (p >= q)
        p, q = np.where(none, d, p), np.where(none, d, q)
        some_cells = (a < d) & (near <= r + e)
        yield k[some_cells], *((v + row * g.nx)[some_cells] for v in (a, p, q, d))


def counted(x: np.ndarray, y: np.ndarray, code: np.ndarray, n_codes: int, box: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Batches of (shape, code, n): how often each code comes among the points in each shape; a shape may come in two batches.

    Counts are kept by cell and code where there are few codes; of many all points in a shape are read."""
    few = n_codes <= 256
    g = Grid(x, y, max(1.0, min(len(x) / 4, TABLE / n_codes)))
    code = code[g.order]
    if few:
        size = g.nx * g.ny
        table = np.zeros((size + 1, n_codes), np.int32)
        np.cumsum(np.bincount(g.cell * n_codes + code, minlength=size * n_codes).reshape(size, n_codes), axis=0, out=table[1:])
    for k, a, p, q, d in spans(g, box, reach):
        if not len(k):
            continue
        if not few:
            p = q = d
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        shape, at = k[first], np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(k)]])))
        total = np.add.reduceat(table[q] - table[p], first).astype(np.int64) if few else None
        at, begin, end = np.concatenate([at, at]), g.start[np.concatenate([a, q])], g.start[np.concatenate([p, d])]
        for some in batches(end - begin, TESTED):
            own, pos = runs(begin[some], end[some])
            own = at[some][own]
            hit = holds(g.x[pos], g.y[pos], box[shape[own]], reach[shape[own]])
            key = own[hit] * n_codes + code[pos[hit]]
            if few:
                total += np.bincount(key, minlength=total.size).reshape(total.shape)
            else:
                key, n = np.unique(key, return_counts=True)
                yield shape[key // n_codes], key % n_codes, n
        if few:
            own, c = np.nonzero(total)
            yield shape[own], c, total[own, c]


def nearest(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """For each point the index of the nearest right point within radius (-1 without any; ties to the least index) and its distance.

    Cells hold about two right points; a point searches as far as a cell is wide, then twice as far, until one is known to be nearest."""
    g = Grid(rx, ry, max(1.0, len(rx) / 2))
    best, dist, todo, reach = np.full(len(x), -1), np.full(len(x), np.inf), np.arange(len(x)), min(g.side, radius)
    while len(todo):
        far = reach + g.slack
        low, high = np.maximum(g.row(y[todo] - far), 0), np.minimum(g.row(y[todo] + far), g.ny - 1)
        a, d = np.maximum(g.col(x[todo] - far), 0), np.minimum(g.col(x[todo] + far), g.nx - 1) + 1
        for some in batches(np.maximum(high - low + 1, 0), ROWS):
            k, row = runs(low[some], high[some] + 1)
            k += some.start
            begin, end = (g.start[row * g.nx + np.maximum(v[k], 0)] for v in (a, np.maximum(a, d)))
            for few in batches(end - begin, TESTED):
                own, pos = runs(begin[few], end[few])
                if not len(own):
                    continue
                own = todo[k[few][own]]
                dx, dy = x[own] - g.x[pos], y[own] - g.y[pos]
                off = np.sqrt(dx * dx + dy * dy)
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                least, at = np.minimum.reduceat(off, first), own[first]
                index = np.minimum.reduceat(np.where(off == np.repeat(least, np.diff(np.append(first, len(own)))), g.order[pos], len(rx)), first)
                # A point's rows of cells may lie in two batches.
                nearer = (least < dist[at]) | ((least == dist[at]) & (index < best[at]))
                dist[at[nearer]], best[at[nearer]] = least[nearer], index[nearer]
        if reach >= radius:
            break
        todo, reach = todo[dist[todo] > reach], min(2 * reach, radius)
    best[dist > radius], dist[dist > radius] = -1, np.inf
    return best, dist


def best_overlaps(box: np.ndarray, other: np.ndarray, least: float, digits: int) -> tuple[np.ndarray, ...]:
    """For each box: how many of the others share more than `least` area with it, the largest shared area, rounded, the index of the first
    other that has it (-1 without any), and how many have it."""
    n, most, index, ties = np.zeros(len(box), np.int64), np.zeros(len(box)), np.full(len(box), -1), np.zeros(len(box), np.int64)
    centre = (other[:, :2] + other[:, 2:]) / 2
    g, half = Grid(centre[:, 0], centre[:, 1], max(1.0, len(other) / 4)), (other[:, 2:] - other[:, :2]).max(0) / 2 + 1e-6
    low, high = np.maximum(g.row(box[:, 1] - half[1]), 0), np.minimum(g.row(box[:, 3] + half[1]), g.ny - 1)
    a, d = np.maximum(g.col(box[:, 0] - half[0]), 0), np.minimum(g.col(box[:, 2] + half[0]), g.nx - 1) + 1
    other = other[g.order]
    for some in batches(np.maximum(high - low + 1, 0), ROWS):
        k, row = runs(low[some], high[some] + 1)
        k += some.start
        begin, end = (g.start[row * g.nx + np.maximum(v[k], 0)] for v in (a, np.maximum(a, d)))
        for few in batches(end - begin, TESTED):
            own, pos = runs(begin[few], end[few])
            own = k[few][own]
            size = np.minimum(box[own, 2:], other[pos, 2:]) - np.maximum(box[own, :2], other[pos, :2])
            area = np.maximum(size[:, 0], 0) * np.maximum(size[:, 1], 0)
            hit = area > least
            own, pos, area = own[hit], pos[hit], np.round(area[hit], digits)
            if not len(own):
                continue
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            count, at = np.diff(np.append(first, len(own))), own[first]
            top = np.maximum.reduceat(area, first)
            same = area == np.repeat(top, count)
            one, alike = np.minimum.reduceat(np.where(same, g.order[pos], len(other)), first), np.add.reduceat(same.astype(np.int64), first)
            # A box's rows of cells may lie in two batches.
            more, equal = top > most[at], top == most[at]
            n[at] += count
            index[at] = np.where(more | (index[at] < 0), one, np.where(equal, np.minimum(one, index[at]), index[at]))
            ties[at] = np.where(more, alike, np.where(equal, alike + ties[at], ties[at]))
            most[at] = np.maximum(top, most[at])
    return n, most, index, ties
