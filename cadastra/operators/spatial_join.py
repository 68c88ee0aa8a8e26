"""Proximity joins as cell-keyed equi joins: one side is exploded to the cells that it may touch, the pairs of equal cells are
refined by the exact predicate. Spark plans, spills and splits these like any other join; there is no nested loop. Sides that grow by
cells are never broadcast: Spark takes their size for that of the files, so the driver would hold all cells and one task all pairs.

Ties go to the least id. Null coordinates match nothing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions import geometry as G
from cadastra.functions import planar


def cell(v: Column, size: float | Column) -> Column:
    return F.floor(v / size)


def distance(x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """The root of the squares' sum as SQL rounds it; hypot differs in the last bit, which decides ties."""
    dx, dy = x - rx, y - ry
    return F.sqrt(dx * dx + dy * dy)


def _around(df: DataFrame, x: str, y: str, size: float | Column, rings: int = 1) -> DataFrame:
    span = F.sequence(F.lit(-rings), F.lit(rings))
    cells = F.flatten(F.transform(span, lambda i: F.transform(span, lambda j: F.struct((cell(F.col(x), size) + i).alias("_cx"), (cell(F.col(y), size) + j).alias("_cy")))))
    return df.withColumn("_c", F.explode(cells)).select("*", "_c._cx", "_c._cy").drop("_c")


def _keyed(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    return df.withColumns({"_cx": cell(F.col(x), size), "_cy": cell(F.col(y), size)})


def radius_join(left: DataFrame, right: DataFrame, radius: float, lx="x", ly="y", rx="rx", ry="ry", on: list[str] | None = None) -> DataFrame:
    """All pairs within radius (inclusive), with their distance `dist`. Column names of the sides must differ, but for `on`.

    The right side, which should be the smaller, is exploded to nine cells."""
    joined = _keyed(left, lx, ly, radius).join(_around(right, rx, ry, radius).hint("merge"), ["_cx", "_cy", *(on or [])])
    dist = distance(F.col(lx), F.col(ly), F.col(rx), F.col(ry))
    return joined.withColumn("dist", dist).where(F.col("dist") <= radius).drop("_cx", "_cy")


def _reach(df: DataFrame, x: str, y: str, rows: float, most: float) -> float:
    """The radius of a circle that holds about `rows` rows at their mean density; most where that is more or there is no area."""
    s = df.agg(F.count("*").alias("n"), F.min(x).alias("a"), F.max(x).alias("b"), F.min(y).alias("c"), F.max(y).alias("d")).first()
    if not s["n"] or s["a"] is None or s["c"] is None:
        return most
    area = float(s["b"] - s["a"]) * float(s["d"] - s["c"])
    reach = math.sqrt(area * rows / (math.pi * s["n"])) if math.isfinite(area) and area > 0 else most
    return reach if 0 < reach < most else most


def nearest_join(left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str, lx="x", ly="y", rx="rx", ry="ry", on: list[str] | None = None) -> DataFrame:
    """left with the columns of its nearest right row within radius and `dist`; null where there is none.

    Where the right side is dense, a row searches the least of radius, radius / 2, radius / 4, ... (down to one that holds about eight right
    rows) within which a right row is known to lie, as one shares its cell; so the pairs grow with the rows, not with their product."""
    on = on or []
    taken = [c for c in right.columns if c not in on]
    short = radius if on else _reach(right, rx, ry, 8.0, radius)
    todo = left.select(left_id, lx, ly, *on)
    if 2 * short < radius:
        reaches = [radius / 2**k for k in range(int(math.log2(radius / short)) + 1)]
        pairs = _least_reach_pairs(todo, right, reaches, left_id, lx, ly, rx, ry)
    else:
        pairs = radius_join(todo, right, radius, lx, ly, rx, ry, on)
    best = pairs.groupBy(left_id, *on).agg(F.min_by(F.struct("dist", *taken), F.struct("dist", right_id)).alias("_b"))
    return left.join(best, [left_id, *on], "left").select(*left.columns, "_b.*").select(*left.columns, *taken, "dist")


def _least_reach_pairs(left: DataFrame, right: DataFrame, reaches: list[float], left_id: str, lx: str, ly: str, rx: str, ry: str) -> DataFrame:
    """Pairs within reaches[0] that hold each left row's nearest: of reaches, each half of the one before, a row takes the last one whose
    square cell with that diagonal has a right row in it too, and meets the right rows in nine cells as wide as that."""
    at = lambda x, y, k, side: F.struct(F.lit(k).alias("_l"), cell(F.col(x), side).alias("_cx"), cell(F.col(y), side).alias("_cy"))
    own = lambda x, y: F.explode(F.array(*(at(x, y, k, r / math.sqrt(2) * (1 - 1e-9)) for k, r in enumerate(reaches) if k)))
    keys = ["_l", "_cx", "_cy"]
    held = right.select(own(rx, ry).alias("_k")).select("_k.*").distinct()
    probes = left.select(left_id, own(lx, ly).alias("_k")).select(left_id, "_k.*")
    level = probes.join(held.hint("merge"), keys, "left_semi").groupBy(left_id).agg(F.max("_l").alias("_l"))
    side = F.element_at(F.array(*map(F.lit, reaches)), F.col("_l") + 1)
    searched = left.join(level.hint("merge"), left_id, "left").withColumn("_l", F.coalesce("_l", F.lit(0))).withColumn("_s", side)
    near = _around(searched, lx, ly, F.col("_s"))
    keyed = right.withColumn("_k", F.explode(F.array(*(at(rx, ry, k, r) for k, r in enumerate(reaches))))).select(*right.columns, "_k.*")
    dist = distance(F.col(lx), F.col(ly), F.col(rx), F.col(ry))
    return near.join(keyed.hint("merge"), keys).withColumn("dist", dist).where(F.col("dist") <= F.col("_s")).drop(*keys, "_s")


def knn_join(left: DataFrame, right: DataFrame, k: int, size: float, left_id: str, right_id: str, cut, lx="x", ly="y", rx="rx", ry="ry", exclude_same: bool = False, most_rounds: int = 12) -> DataFrame:
    """(left_id, right_id, dist, rank) of the k nearest right rows of each left row.

    Rings of cells grow by doubling; a row is done when its k-th distance is within the searched reach, and only unfinished
    rows go on. Rows end with fewer than k when all of the right side is nearer than that. Cells begin with `size`, or, where the
    right side is dense, with a reach that holds about 2 k of its rows; most_rounds counts from `size`."""
    span = right.agg(F.min(rx).alias("a"), F.max(rx).alias("b"), F.min(ry).alias("c"), F.max(ry).alias("d"))
    both = left.agg(F.min(lx).alias("e"), F.max(lx).alias("f"), F.min(ly).alias("g"), F.max(ly).alias("h")).join(F.broadcast(span)).first()
    if both["a"] is None or both["e"] is None:
        return left.select(left_id).limit(0).join(right.select(right_id).limit(0), F.lit(True)).withColumns({"dist": F.lit(0.0), "rank": F.lit(0)})
    whole = math.hypot(max(both["b"], both["f"]) - min(both["a"], both["e"]), max(both["d"], both["h"]) - min(both["c"], both["g"])) + size
    whole_size, size = size, _reach(right, rx, ry, 2.0 * (k + exclude_same), size)
    most_rounds += math.ceil(math.log2(whole_size / size))
    todo, done, rings = left.select(left_id, lx, ly), None, 1
    order = W.partitionBy(left_id).orderBy("dist", right_id)
    for _ in range(most_rounds):
        reach = size * rings
        pairs = _around(todo, lx, ly, size, rings).join(_keyed(right, rx, ry, size).hint("merge"), ["_cx", "_cy"]) if rings <= 4 else _keyed(todo, lx, ly, reach).transform(lambda d, r=reach: _around(d.drop("_cx", "_cy"), lx, ly, r)).join(_keyed(right, rx, ry, reach).hint("merge"), ["_cx", "_cy"])
        if exclude_same:
            pairs = pairs.where(F.col(left_id) != F.col(right_id))
        pairs = pairs.withColumn("dist", distance(F.col(lx), F.col(ly), F.col(rx), F.col(ry)))
        ranked = pairs.select(left_id, right_id, "dist", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
        ranked = cut(ranked, "knn")
        closed = ranked.where((F.col("rank") == k) & (F.col("dist") <= reach)).select(left_id) if reach < whole else todo.select(left_id)
        part = ranked.join(closed, left_id, "left_semi")
        done = part if done is None else done.unionByName(part)
        if reach >= whole:
            return done
        todo = cut(todo.join(closed, left_id, "left_anti"), "knn")
        if todo.isEmpty():
            return done
        rings *= 2
    raise RuntimeError("neighbours are farther than the allowed rounds reach; choose a larger cell")


def polygon_cells(polygons: DataFrame, ring: str, size: float, pad: float | Column = 0.0) -> DataFrame:
    """polygons exploded to the cells of their padded bounding boxes."""
    pad = pad if isinstance(pad, Column) else F.lit(float(pad))
    boxed = polygons.withColumn("_b", G.bbox(F.col(ring)))
    xs = F.sequence(cell(F.col("_b.xmin") - pad, size), cell(F.col("_b.xmax") + pad, size))
    ys = F.sequence(cell(F.col("_b.ymin") - pad, size), cell(F.col("_b.ymax") + pad, size))
    return boxed.withColumn("_cx", F.explode(xs)).withColumn("_cy", F.explode(ys))


def _boxed(polygons: DataFrame, ring: str, pad: float = 0.0) -> DataFrame:
    """polygons with _x0, _y0, _x1, _y1, the padded box of a ring or of an array of rings; null and empty ones are dropped."""
    nested = dict(polygons.dtypes)[ring].startswith("array<array")
    all_ = F.flatten(F.col(ring)) if nested else F.col(ring)
    boxed = polygons.withColumn("_box", G.bbox(all_)).where("_box.xmin IS NOT NULL AND _box.ymin IS NOT NULL")
    return boxed.withColumns({"_x0": F.col("_box.xmin") - pad, "_y0": F.col("_box.ymin") - pad, "_x1": F.col("_box.xmax") + pad, "_y1": F.col("_box.ymax") + pad}).drop("_box")


def _level(size: float) -> Column:
    """Boxes up to twice `size` have level 0, up to eight times 1, and so on by fours; cells of a level are size * 4 ** level."""
    side = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    return F.greatest(F.lit(0), F.ceil(F.log(side / (2 * size)) / math.log(4))).cast("int")


def _grid(xs: Column, ys: Column, level: int) -> Column:
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(F.lit(level).alias("_l"), i.alias("_cx"), j.alias("_cy")))))


def _box_keys(boxed: DataFrame, size: float, levels: list[int]) -> DataFrame:
    """boxed, once for each cell (_l, _cx, _cy) that the box touches at its own level and at those above it."""
    keys = []
    for l_ in levels:
        side = size * 4**l_
        xs, ys = F.sequence(cell(F.col("_x0"), side), cell(F.col("_x1"), side)), F.sequence(cell(F.col("_y0"), side), cell(F.col("_y1"), side))
        keys.append(F.when(F.col("_level") <= l_, _grid(xs, ys, l_)))
    return boxed.withColumn("_k", F.explode(F.flatten(F.array_compact(F.array(*keys))))).select(*boxed.columns, "_k.*")


def _levels(boxed: DataFrame) -> list[int]:
    """The levels there are: one for each fourfold size, so a handful."""
    return sorted(r[0] for r in boxed.select("_level").distinct().collect())


def _rectangle(polygons: DataFrame, ring: str) -> Column:
    """Whether a ring is an open one of four corners with sides along the axes, so that its box tells all; not so for arrays of rings."""
    return F.lit(False) if dict(polygons.dtypes)[ring].startswith("array<array") else is_rectangle(F.col(ring))


def is_rectangle(ring: Column) -> Column:
    p = [F.get(ring, F.lit(k)) for k in range(4)]
    same = lambda c, *pairs: F.lit(True) & (p[pairs[0]][c] == p[pairs[1]][c]) & (p[pairs[2]][c] == p[pairs[3]][c])
    turned = (same("x", 0, 3, 1, 2) & same("y", 0, 1, 2, 3)) | (same("y", 0, 3, 1, 2) & same("x", 0, 1, 2, 3))
    return F.coalesce((F.size(ring) == 4) & turned, F.lit(False))


def _candidates(points: DataFrame, boxed: DataFrame, size: float, x: str, y: str, half_open: bool = False) -> DataFrame:
    """Pairs with the point in the padded box; half_open leaves out its upper sides. Points have a row for each level of boxes, boxes a few cells at their own."""
    boxed = boxed.withColumn("_level", _level(size))
    levels = _levels(boxed) or [0]
    at = F.explode(F.array(*(F.struct(F.lit(k).alias("_l"), cell(F.col(x), size * 4**k).alias("_cx"), cell(F.col(y), size * 4**k).alias("_cy")) for k in levels)))
    keyed = points.withColumn("_k", at).select(*points.columns, "_k.*")
    own = _box_keys(boxed, size, levels).where("_l = _level").drop("_level")
    joined = keyed.join(own.hint("merge"), ["_l", "_cx", "_cy"]).where(F.col(x).between(F.col("_x0"), F.col("_x1")) & F.col(y).between(F.col("_y0"), F.col("_y1")))
    if half_open:
        joined = joined.where((F.col(x) < F.col("_x1")) & (F.col(y) < F.col("_y1")))
    return joined.drop("_l", "_cx", "_cy", "_x0", "_y0", "_x1", "_y1")


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).cast(pa.float64()).fill_null(np.nan), float)


def points_in_polygons(points: DataFrame, polygons: DataFrame, ring: str = "ring", size: float = 10.0, x="x", y="y") -> DataFrame:
    """All (point, polygon) pairs with the point inside; ring is a ring or an array of rings (holes, parts).

    Boxes are joined by cells of their own size class. Rectangles need no other test; of what is left the exact test runs over Arrow batches."""
    boxed = _boxed(polygons, ring).withColumn("_plain", _rectangle(polygons, ring))
    kinds = {r[0] for r in boxed.select("_plain").distinct().collect()}  # two at most
    plain = _candidates(points, boxed.where("_plain").drop("_plain"), size, x, y, half_open=True) if True in kinds else None
    if kinds == {True}:
        return plain
    pairs = _candidates(points, boxed.where("NOT _plain").drop("_plain"), size, x, y)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(planar.inside(*planar.polygon_edges(b.column(ring)), _numbers(b, x), _numbers(b, y))))

    other = pairs.mapInArrow(test, pairs.schema)
    return other if plain is None else plain.unionByName(other)


def points_in_circles(points: DataFrame, circles: DataFrame, size: float = 10.0, x="x", y="y", cx="rx", cy="ry", r="r") -> DataFrame:
    """All (point, circle) pairs within the circle's own radius, with `dist`."""
    c, d = (F.col(cx), F.col(cy)), F.col(r)
    boxed = circles.withColumns({"_x0": c[0] - d, "_y0": c[1] - d, "_x1": c[0] + d, "_y1": c[1] + d}).where("_x0 IS NOT NULL AND _y0 IS NOT NULL")
    dist = distance(F.col(x), F.col(y), F.col(cx), F.col(cy))
    return _candidates(points, boxed, size, x, y).withColumn("dist", dist).where(F.col("dist") <= F.col(r))


def points_near_polygons(points: DataFrame, polygons: DataFrame, reach: float, ring: str = "ring", size: float = 10.0, x="x", y="y") -> DataFrame:
    """Pairs with the point outside the polygon but within reach of its sides, with `edge_dist`."""
    pairs = _candidates(points, _boxed(polygons, ring, reach), size, x, y)
    schema = T.StructType([*pairs.schema.fields, T.StructField("edge_dist", T.DoubleType())])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges, px, py = planar.polygon_edges(b.column(ring)), _numbers(b, x), _numbers(b, y)
            dist = planar.side_distance(*edges, px, py)
            near = (dist <= reach) & ~planar.inside(*edges, px, py)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dist)], names=[*b.schema.names, "edge_dist"]).filter(pa.array(near))

    return pairs.mapInArrow(test, schema)


def box_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_ring: str, right_ring: str, size: float = 10.0, touching: bool = False) -> DataFrame:
    """(left_id, right_id) of the pairs whose boxes overlap by more than a side, or with touching at all, each once: in the cell, at
    the level of the larger box, of the boxes' common lower corner."""
    side = lambda d, i, r: _boxed(d.select(i, r), r).withColumn("_level", _level(size)).drop(r)
    a, b = side(left, left_id, left_ring), side(right, right_id, right_ring)
    levels = sorted({*_levels(a), *_levels(b)}) or [0]
    other = {c: c.replace("_", "_r", 1) for c in ("_x0", "_y0", "_x1", "_y1", "_level")}
    pairs = _box_keys(a, size, levels).join(_box_keys(b, size, levels).withColumnsRenamed(other).hint("merge"), ["_l", "_cx", "_cy"])
    less = "<=" if touching else "<"
    pairs = pairs.where(f"_l = greatest(_level, _rlevel) AND _x0 {less} _rx1 AND _rx0 {less} _x1 AND _y0 {less} _ry1 AND _ry0 {less} _y1")
    scale = F.lit(size) * F.pow(F.lit(4.0), F.col("_l"))
    return pairs.where((F.col("_cx") == F.floor(F.greatest("_x0", "_rx0") / scale)) & (F.col("_cy") == F.floor(F.greatest("_y0", "_ry0") / scale))).select(left_id, right_id)


def polygon_overlay(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_ring: str, right_ring: str, size: float = 10.0, pairs: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id, shared, left_fraction, right_fraction) of pairs with positive common area; touching is no match.

    Any simple polygons will do: rings, or arrays of rings with holes and parts. Ids are unique on each side. Boxes and ids are
    joined first (or pairs given), then polygons are looked up and their common area is computed over Arrow batches; that of two
    rectangles along the axes is that of their boxes, so their rings stay behind."""
    pairs = box_pairs(left, right, left_id, right_id, left_ring, right_ring, size) if pairs is None else pairs
    side = lambda d, i, r, p: d.select(i, r, _polygon_area(d, r).alias(f"_{p}a"), _rectangle(d, r).alias(f"_{p}plain"), G.bbox(F.col(r) if not dict(d.dtypes)[r].startswith("array<array") else F.flatten(r)).alias(f"_{p}box")).hint("merge")
    both = pairs.join(side(left, left_id, left_ring, "l"), left_id).join(side(right, right_id, right_ring, "r"), right_id)
    width = lambda a, b: F.least(f"_lbox.{b}", f"_rbox.{b}") - F.greatest(f"_lbox.{a}", f"_rbox.{a}")
    shared_box = F.when(F.col("_lplain") & F.col("_rplain"), F.greatest(width("xmin", "xmax"), F.lit(0.0)) * F.greatest(width("ymin", "ymax"), F.lit(0.0)))
    both = both.select(left_id, right_id, F.when(shared_box.isNull(), F.col(left_ring)).alias(left_ring), F.when(shared_box.isNull(), F.col(right_ring)).alias(right_ring), "_la", "_ra", shared_box.alias("_box"))
    schema = T.StructType([both.schema[left_id], both.schema[right_id], *(T.StructField(c, T.DoubleType()) for c in ("shared", "left_fraction", "right_fraction"))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = _numbers(b, "_box").copy()
            rest = b.filter(pa.array(np.isnan(shared)))
            if rest.num_rows:
                shared[np.isnan(shared)] = planar.common_areas(planar.polygon_edges(rest.column(left_ring)), planar.polygon_edges(rest.column(right_ring)), rest.num_rows)
            with np.errstate(divide="ignore", invalid="ignore"):
                parts = [shared, shared / _numbers(b, "_la"), shared / _numbers(b, "_ra")]
            yield pa.RecordBatch.from_arrays([b.column(left_id), b.column(right_id), *map(pa.array, parts)], names=schema.names).filter(pa.array(shared > 0))

    return both.mapInArrow(measure, schema)


def _polygon_area(df: DataFrame, ring: str) -> Column:
    """Area of a ring; of rings whose direction tells holes from outlines, the absolute sum."""
    nested = dict(df.dtypes)[ring].startswith("array<array")
    return F.abs(F.aggregate(F.col(ring), F.lit(0.0), lambda s, r: s + G.signed_area(r))) if nested else G.area(F.col(ring))
