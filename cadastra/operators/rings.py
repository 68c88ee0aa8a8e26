"""Rings from points and cells, and meshes from rings: hulls, outlines, simplification, terrain faces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as G

from . import spatial_join as J

RING = f"array<{G.POINT}>"


def convex_hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Counter-clockwise hull of points as rows (x, y), by the monotone chain; fewer than three rows if it is flat."""
    p = sorted(set(zip(x.tolist(), y.tolist(), strict=True)))
    if len(p) < 3:
        return np.array(p, float).reshape(-1, 2)

    def half(points: list) -> list:
        out: list = []
        for u, v in points:
            while len(out) > 1:
                (a, b), (c, d) = out[-2:]
                if (c - a) * (v - b) - (d - b) * (u - a) > 0:
                    break
                out.pop()
            out.append((u, v))
        return out

    return np.array(half(p)[:-1] + half(p[::-1])[:-1])


def _outer(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The hull of points; those well inside the octagon of their extremes in eight directions are left out first."""
    if len(x) > 16:
        at = [v.argmax() for v in (x, x + y, y, y - x, -x, -x - y, -y, x - y)]
        cx, cy = x[at], y[at]
        inner = np.ones(len(x), bool)
        for i, j in zip(range(8), (*range(1, 8), 0), strict=True):
            if at[i] != at[j]:
                dx, dy = cx[j] - cx[i], cy[j] - cy[i]
                inner &= dx * (y - cy[i]) - dy * (x - cx[i]) > 1e-9 * (abs(dx) + abs(dy)) ** 2
        inner[at] = False
        x, y = x[~inner], y[~inner]
    return convex_hull(x, y)


def _parts(key: str, kind: str) -> str:
    return f"{key} {kind}, xs array<double>, ys array<double>, n long"


def _part_rows(key: str, found: list) -> pd.DataFrame:
    return pd.DataFrame({key: [k for k, _, _ in found], "xs": [h[:, 0] for _, h, _ in found], "ys": [h[:, 1] for _, h, _ in found], "n": [n for _, _, n in found]})


def _point_parts(points: DataFrame, key: str) -> DataFrame:
    """Hulls of each task's points of a key."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
            yield _part_rows(key, [(k, _outer(x[at], y[at]), len(at)) for k, at in pdf.groupby(key, sort=False).indices.items()])

    good = points.where(F.col(key).isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull())
    return good.select(key, "x", "y").mapInPandas(partial, _parts(key, dict(points.dtypes)[key]))


def _tasks(df: DataFrame) -> int:
    """Parts for all cores: what a task does here is more than its bytes tell."""
    session = df.sparkSession
    return max(int(session.conf.get("spark.sql.shuffle.partitions")), 3 * session.sparkContext.defaultParallelism)


def _box_parts(points: DataFrame, boxes: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """Hulls of the points in each box (its upper sides left out), tile by tile: points and boxes of a tile meet once and no pair of them is
    a row. Tiles hold some 4,000 points, but are twice as wide as boxes are in the mean; those with more than `most` points are dealt over parts."""
    p = points.select("x", "y").where("x IS NOT NULL AND y IS NOT NULL")
    s = p.agg(F.count("*").alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in "xy")).first()
    wide = boxes.agg(F.avg(F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")))).first()[0]
    kind = dict(boxes.dtypes)[key]
    if not s["n"] or wide is None:
        return boxes.limit(0).select(key, *(F.array().cast("array<double>").alias(c) for c in ("xs", "ys")), F.lit(0).cast("long").alias("n"))
    area = (s["max_x"] - s["min_x"]) * (s["max_y"] - s["min_y"])
    side = max((4000.0 * area / s["n"]) ** 0.5, 2 * wide) or 1.0
    tiled = p.withColumns({"_cx": J.cell(F.col("x"), side), "_cy": J.cell(F.col("y"), side)})
    parts = tiled.groupBy("_cx", "_cy").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    tiled = tiled.join(parts.hint("merge"), ["_cx", "_cy"]).withColumn("_part", F.pmod(F.xxhash64("x", "y"), F.col("parts")).cast("int")).drop("parts")
    span = lambda c: F.sequence(J.cell(F.greatest(F.col(f"_{c}0"), F.lit(s[f"min_{c}"])), side), J.cell(F.least(F.col(f"_{c}1"), F.lit(s[f"max_{c}"])), side))
    near = boxes.where(F.col(key).isNotNull() & (F.col("_x0") <= s["max_x"]) & (F.col("_x1") >= s["min_x"]) & (F.col("_y0") <= s["max_y"]) & (F.col("_y1") >= s["min_y"]))
    near = near.select(key, "_x0", "_y0", "_x1", "_y1", F.explode(span("x")).alias("_cx"), span("y").alias("_ys")).withColumn("_cy", F.explode("_ys")).drop("_ys")
    near = near.join(parts.hint("merge"), ["_cx", "_cy"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def meet(p: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("x")
        x, y, found = p["x"].to_numpy(), p["y"].to_numpy(), []
        lows, highs = np.searchsorted(x, b["_x0"].to_numpy()), np.searchsorted(x, b["_x1"].to_numpy())
        for k, y0, y1, i, j in zip(b[key].tolist(), b["_y0"].tolist(), b["_y1"].tolist(), lows, highs, strict=True):
            at = y[i:j]
            at = np.flatnonzero((at >= y0) & (at < y1)) + i
            if len(at):
                found.append((k, _outer(x[at], y[at]), len(at)))
        return _part_rows(key, found)

    at, n = ["_cx", "_cy", "_part"], _tasks(points)
    return tiled.repartition(n, *at).groupBy(*at).cogroup(near.repartition(n, *at).groupBy(*at)).applyInPandas(meet, _parts(key, kind))


def _merged_hulls(parts: DataFrame, key: str, least_area: float) -> DataFrame:
    kind = dict(parts.dtypes)[key]
    met = parts.groupBy(key).agg(F.flatten(F.collect_list("xs")).alias("xs"), F.flatten(F.collect_list("ys")).alias("ys"), F.sum("n").alias("n_points"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rings = [_outer(x, y) for x, y in zip(pdf["xs"], pdf["ys"], strict=True)]
            yield pd.DataFrame({key: pdf[key], "xs": [r[:, 0] for r in rings], "ys": [r[:, 1] for r in rings], "n_points": pdf["n_points"]})

    hulls = met.repartition(_tasks(parts), key).mapInPandas(merge, f"{key} {kind}, xs array<double>, ys array<double>, n_points long")
    ring = F.zip_with("xs", "ys", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    hulls = hulls.select(key, ring.alias("ring"), "n_points")
    return hulls.where(F.size("ring") >= 3).withColumn("area_m2", G.area(F.col("ring"))).where(F.col("area_m2") >= least_area).select(key, "ring", "area_m2", "n_points")


def cluster_hulls(points: DataFrame, key: str, least_area: float = 9.0) -> DataFrame:
    """(key, ring, area_m2, n_points) of the hulls with the least area or more.

    First each task reduces its own points of a key to their hull, then the hulls' corners meet: what a key brings together is
    its tasks' corners, not its points."""
    return _merged_hulls(_point_parts(points, key), key, least_area)


def hulls_in_polygons(points: DataFrame, polygons: DataFrame, key: str, ring: str = "ring", least_area: float = 9.0) -> DataFrame:
    """cluster_hulls() of the points in each polygon. Points meet rectangles along the axes tile by tile; pairs are made for other polygons only."""
    boxed = J._boxed(polygons.select(key, ring), ring).withColumn("_plain", J._rectangle(polygons, ring))
    kinds = {r[0] for r in boxed.select("_plain").distinct().collect()}  # two at most
    parts = _box_parts(points, boxed.where("_plain"), key)
    if False in kinds:
        other = J.points_in_polygons(points.select("x", "y"), boxed.where("NOT _plain").select(key, ring), ring)
        parts = parts.unionByName(_point_parts(other, key))
    return _merged_hulls(parts, key, least_area)


def chain_edges(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray) -> list[list[tuple[int, int]]]:
    """Closed rings from directed unit edges; at a corner that four edges share the ring turns left."""
    after: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b in sorted(zip(zip(ax.tolist(), ay.tolist(), strict=True), zip(bx.tolist(), by.tolist(), strict=True), strict=True)):
        after.setdefault(a, []).append(b)
    rings = []
    while after:
        start = min(after)
        ring, at, last = [start], start, None
        while True:
            options = after[at]
            if last is not None and len(options) > 1:
                d = (at[0] - last[0], at[1] - last[1])
                options.sort(key=lambda b: -(d[0] * (b[1] - at[1]) - d[1] * (b[0] - at[0])))
            nxt = options.pop(0)
            if not options:
                del after[at]
            last, at = at, nxt
            if at == start:
                break
            ring.append(at)
        straight = [p for k, p in enumerate(ring) if (p[0] - ring[k - 1][0]) * (ring[(k + 1) % len(ring)][1] - p[1]) != (p[1] - ring[k - 1][1]) * (ring[(k + 1) % len(ring)][0] - p[0])]
        rings.append(straight)
    return rings


def cell_rings(cells: DataFrame, size: float) -> DataFrame:
    """(key, rings) of the outlines of occupied cells (key, row, col): edges that one cell alone has, chained. Outer rings are
    counter-clockwise, holes clockwise; what a key gathers is its outline."""
    r, c = F.col("row"), F.col("col")
    side = lambda x1, y1, x2, y2: F.struct(x1.alias("ax"), y1.alias("ay"), x2.alias("bx"), y2.alias("by"))
    sides = F.array(side(c, r, c + 1, r), side(c + 1, r, c + 1, r + 1), side(c + 1, r + 1, c, r + 1), side(c, r + 1, c, r))
    e = cells.select("key", F.explode(sides).alias("e")).select("key", "e.*")
    ordered = e.withColumn("k", F.struct(F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"), F.greatest("ay", "by")))
    outline = ordered.groupBy("key", "k").agg(F.count("*").alias("n"), *(F.first(x).alias(x) for x in ("ax", "ay", "bx", "by"))).where("n = 1")
    kind = dict(cells.dtypes)["key"]

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = chain_edges(*(pdf[x].to_numpy(int) for x in ("ax", "ay", "bx", "by")))
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "rings": [[[{"x": a * size, "y": b * size} for a, b in ring] for ring in rings]]})

    return outline.select("key", "ax", "ay", "bx", "by").groupBy("key").applyInPandas(chain, f"key {kind}, rings array<{RING}>")


def simplify(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Indices that Douglas-Peucker keeps of an open line."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        n = np.hypot(dx, dy)
        d = np.abs(dx * (y[a + 1 : b] - y[a]) - dy * (x[a + 1 : b] - x[a])) / n if n else np.hypot(x[a + 1 : b] - x[a], y[a + 1 : b] - y[a])
        k = int(d.argmax())
        if d[k] > tolerance:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return np.flatnonzero(keep)


def simplified(polygons: DataFrame, tolerance: float, ring: str = "ring") -> DataFrame:
    """polygons with each ring simplified; rings that would fall under three vertices stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.column(ring).to_pylist():
                if r is None or len(r) < 4:
                    out.append(r)
                    continue
                x, y = (np.array([p[k] for p in [*r, r[0]]], float) for k in ("x", "y"))
                k = simplify(x, y, tolerance)[:-1]
                out.append([r[i] for i in k] if len(k) >= 3 else r)
            at = batch.schema.get_field_index(ring)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return polygons.mapInArrow(run, polygons.schema)


def terrain_faces(grid: DataFrame) -> DataFrame:
    """(ix, iy, face, a, b, c) of two triangles for each quad whose four corners (ix, iy, z) are there; corners as ix:iy."""
    probe = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), (F.col("ix") - i).alias("qx"), (F.col("iy") - j).alias("qy")) for k, (i, j) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1))))))
    quads = grid.select("ix", "iy", probe.alias("p")).groupBy("p.qx", "p.qy").agg(F.count("*").alias("n")).where("n = 4")
    name = lambda i, j: F.concat_ws(":", (F.col("qx") + i).cast("string"), (F.col("qy") + j).cast("string"))
    tri = lambda k, *c: F.struct(F.lit(k).alias("face"), *(name(*p).alias(n) for n, p in zip("abc", c, strict=True)))
    faces = F.explode(F.array(tri(0, (0, 0), (1, 0), (1, 1)), tri(1, (0, 0), (1, 1), (0, 1))))
    return quads.select(F.col("qx").alias("ix"), F.col("qy").alias("iy"), faces.alias("f")).select("ix", "iy", "f.*")
