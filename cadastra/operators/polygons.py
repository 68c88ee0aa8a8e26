"""Polygons as geometry over Arrow batches: repair, buffers, clipping by sides, and outlines of what many polygons cover together.

Results are arrays of polygons, each an array of rings, the outline first; the largest polygon comes first, and of equal ones that
of the least corner. Null, empty and not finite rings give no polygons."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions import geometry as G
from cadastra.functions import overlay as O
from cadastra.functions import planar

from . import spatial_join as J
from .graph import connected_components

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"
SIDES = "array<struct<ax:double,ay:double,bx:double,by:double>>"


def polygon_area(rings: Column) -> Column:
    """Area of an outline without its holes; of null null."""
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s - G.area(r)) + 2 * G.area(F.get(rings, F.lit(0)))


def _encoded(results: list[list[list[np.ndarray]]]) -> pa.Array:
    ordered = [sorted(r, key=lambda p: -O.polygon_area(p)) if len(r) > 1 else r for r in results]
    rings = [ring for polygons in ordered for p in polygons for ring in p]
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    nest = lambda sizes, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    return nest([len(r) for r in ordered], nest([len(p) for r in ordered for p in r], nest([len(r) for r in rings], points)))


def _sides(column: pa.Array, n: int, edges: Callable = planar.polygon_edges) -> list[np.ndarray]:
    """The sides of each row; none where a side isn't finite."""
    row, e = edges(column)
    good = ~np.isin(row, row[~np.isfinite(e).all(1)])
    row, e = row[good], e[good]
    at = np.searchsorted(row, np.arange(n + 1))
    return [e[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _with_polygons(df: DataFrame, out: str, make: Callable[[pa.RecordBatch], list]) -> DataFrame:
    names = [c for c in df.columns if c != out]
    schema = df.select(*names).withColumn(out, F.lit(None).cast(POLYGONS)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), _encoded(make(b))], names=[*names, out])

    return spread(df).mapInArrow(run, schema)


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over all cores: a small file is read by one task, but its polygons are work for all."""
    session = df.sparkSession
    return df.repartition(max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism))


def pair_measures(df: DataFrame, left: str, right: str) -> DataFrame:
    """df with the common area `shared` of two polygons of each row, and `hausdorff`, the largest distance of a corner of either from
    the other's sides; null where one has no sides."""
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in ("shared", "hausdorff"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (planar.polygon_edges(b.column(name)) for name in (left, right))
            far = np.maximum(planar.farthest_corner(*a, *c, b.num_rows), planar.farthest_corner(*c, *a, b.num_rows))
            known = pa.array(np.isfinite(far) & np.isin(np.arange(b.num_rows), a[0]) & np.isin(np.arange(b.num_rows), c[0]))
            values = (pa.array(planar.common_areas(a, c, b.num_rows)), pa.array(far))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pc.if_else(known, v, None) for v in values)], names=schema.names)

    return spread(df).mapInArrow(run, schema)


def repaired(df: DataFrame, polygon: str = "rings", out: str = "polygons") -> DataFrame:
    """df with the valid polygons that a ring, or rings, enclose: what lies inside an odd number of times. Bow ties fall apart, parts
    that double back vanish, holes are put in their outlines; a valid polygon stays as it is, but for corners on straight sides."""
    return _with_polygons(df, out, lambda b: O.overlays(_sides(b.column(polygon), b.num_rows)))


def buffered(df: DataFrame, distance: float, polygon: str = "rings", out: str = "polygons") -> DataFrame:
    """df with polygons grown by distance, or shrunk if it's negative, after repair; corners are round. What is narrower than twice a
    negative distance is gone, and parts come apart there."""

    def make(b: pa.RecordBatch) -> list:
        return O.overlays(O.offsets(O.overlays(_sides(b.column(polygon), b.num_rows)), distance), rule="positive")

    return _with_polygons(df, out, make)


def _closed(sides: np.ndarray, odd: bool, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Sides of a polygon in a window, closed below it so that rays down see what they would see of the whole polygon. odd is whether
    the window's lower left corner is inside."""
    if len(sides):
        a, d = sides[:, :2], sides[:, 2:] - sides[:, :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.stack([(np.array([x0, y0]) - a) / d, (np.array([x1, y1]) - a) / d])
        t = np.where(d[None] == 0, np.where((a >= [x0, y0]) & (a <= [x1, y1]), np.array([-np.inf, np.inf])[:, None, None], np.nan), t)
        enter, leave = np.maximum(t.min(0).max(1), 0), np.minimum(t.max(0).min(1), 1)
        line = (sides[:, 1] <= y0) != (sides[:, 3] <= y0)
        with np.errstate(divide="ignore", invalid="ignore"):
            xs = a[line, 0] + (y0 - a[line, 1]) * d[line, 0] / d[line, 1]
        xs = np.sort(xs[(xs > x0) & (xs < x1)])
        in_ = enter <= leave
        sides = np.concatenate([a[in_] + enter[in_, None] * d[in_], a[in_] + leave[in_, None] * d[in_]], 1)
    else:
        xs = np.zeros(0)
    ends = np.concatenate([[x0] if odd else [], xs, [x1]])
    ends = ends[: len(ends) // 2 * 2].reshape(-1, 2)
    floor = np.full(len(ends), y0 - 1)
    return np.concatenate([sides, np.stack([ends[:, 0], floor, ends[:, 1], floor], 1)])


def clipped(df: DataFrame, polygon: str, sides: str, odd: str, x0: str, y0: str, out: str = "polygons") -> DataFrame:
    """df with what polygons share with others of which only the sides near them are known, and whether the point (x0, y0), to the
    lower left of the polygon, is inside these. Sides must hold all that pass the box from there to the polygon's upper right."""

    def make(b: pa.RecordBatch) -> list:
        own = _sides(b.column(polygon), b.num_rows)
        flat = b.column(sides).flatten()
        e = np.stack([np.asarray(flat.field(k), float) for k in range(4)], 1)
        size = np.asarray(b.column(sides).value_lengths().fill_null(0), np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        corner = zip(b.column(odd).to_pylist(), b.column(x0).to_pylist(), b.column(y0).to_pylist(), strict=True)
        other = [_closed(e[at[k] : at[k + 1]], inside, x, y, *(own[k].reshape(-1, 2).max(0) + 1)) if len(own[k]) else O.NONE for k, (inside, x, y) in enumerate(corner)]
        return O.overlays(own, other, "intersection")

    return _with_polygons(df, out, make)


def box_sides(box: Column) -> Column:
    """The four sides of a box, for clipped."""
    corners = [(box["xmin"], box["ymin"]), (box["xmax"], box["ymin"]), (box["xmax"], box["ymax"]), (box["xmin"], box["ymax"])]
    return F.array(*(F.struct(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)))


#: A cell of the grid of a level; and how far, in units, sides must stay away from a cell that a polygon covers.
AT = ["_l", "_cx", "_cy"]
_APART = 2 * O.NEAR


def _cell_states(row: np.ndarray, e: np.ndarray, of: np.ndarray, x: np.ndarray, y: np.ndarray, half: np.ndarray, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Whether sides of polygon of[k] come near cell k, given by its middle and half its side, and whether it covers the cell."""
    begin, m = np.searchsorted(row, of, "left"), np.searchsorted(row, of, "right") - np.searchsorted(row, of, "left")
    end = np.cumsum(m)
    passed, odd = np.zeros(len(of), bool), np.zeros(len(of), bool)
    at = 0
    while at < len(of):
        to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + most, "right")))
        k = np.repeat(np.arange(to - at), m[at:to])
        j = np.arange(len(k)) - np.repeat(end[at:to] - m[at:to] - (end[at - 1] if at else 0), m[at:to]) + begin[at:to][k]
        (ax, ay, bx, by), px, py, h = e[j].T, x[at:to][k], y[at:to][k], half[at:to][k] + _APART
        near = (np.minimum(ax, bx) <= px + h) & (np.maximum(ax, bx) >= px - h) & (np.minimum(ay, by) <= py + h) & (np.maximum(ay, by) >= py - h)
        near &= np.abs((bx - ax) * (py - ay) - (by - ay) * (px - ax)) <= h * (np.abs(bx - ax) + np.abs(by - ay))
        with np.errstate(divide="ignore", invalid="ignore"):
            right = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
        passed[at:to] = np.bincount(k[near], minlength=to - at) > 0
        odd[at:to] = np.bincount(k[right], minlength=to - at) % 2 == 1
        at = to
    return passed, odd & ~passed


def polygon_grid(polygons: DataFrame, key: str, polygon: str, size: float) -> DataFrame:
    """(key, _l, _cx, _cy, own, passed, covers): cells that the box of a polygon touches, with whether its sides come near (passed) and
    whether it holds all of the cell (covers). Cells of level l have the side size * 4 ** l; a polygon has at most some 17 * 17 of its
    own level, and is told by its box in those of the levels above that others have."""
    boxed = J._boxed(polygons.select(key, polygon), polygon).withColumn("_level", J._level(8 * size)).where("_x1 - _x0 < 1e300 AND _y1 - _y0 < 1e300")
    levels = J._levels(boxed)
    schema = T.StructType([polygons.schema[key], T.StructField("_l", T.IntegerType()), T.StructField("_cx", T.LongType()), T.StructField("_cy", T.LongType()), *(T.StructField(c, T.BooleanType()) for c in ("own", "passed", "covers"))])

    def cells(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, e = planar.polygon_edges(b.column(polygon))
        good = ~np.isin(row, row[~np.isfinite(e).all(1)])
        row, e = row[good], e[good]
        x0, y0, x1, y1, own = (np.asarray(b.column(c)) for c in ("_x0", "_y0", "_x1", "_y1", "_level"))
        real = np.isin(np.arange(b.num_rows), row)
        for level in levels:
            n, side = np.flatnonzero(real & (own <= level)), size * 4.0**level
            low, high = ([np.floor((v[n] + pad) / side).astype(np.int64) for v in vs] for vs, pad in (((x0, y0), -_APART), ((x1, y1), _APART)))
            wide, tall = high[0] - low[0] + 1, high[1] - low[1] + 1
            k = np.repeat(np.arange(len(n)), wide * tall)
            place = np.arange(len(k)) - np.repeat(np.cumsum(wide * tall) - wide * tall, wide * tall)
            cx, cy, mine = low[0][k] + place // tall[k], low[1][k] + place % tall[k], own[n][k] == level
            passed, covers = np.ones(len(k), bool), np.zeros(len(k), bool)
            passed[mine], covers[mine] = _cell_states(row, e, n[k[mine]], (cx[mine] + 0.5) * side, (cy[mine] + 0.5) * side, np.full(int(mine.sum()), side / 2))
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(n[k])), pa.array(np.full(len(k), level, np.int32)), *map(pa.array, (cx, cy, mine, passed, covers))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                yield from cells(b.slice(at, 500))

    return spread(boxed).mapInArrow(run, schema)


def overlap_components(polygons: DataFrame, grid: DataFrame, key: str, polygon: str, cut: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(key, component) of the polygons of a grid: the least key that is reachable by common areas.

    Polygons that cover one cell are one component. Only where a cell is touched by several of these components do polygons meet, and
    there, if one of them covers the cell, they meet that one, as no two have an area there without it. So pairs grow with the
    polygons, but where many lie in cells that none covers, in components of their own."""
    cover = grid.where("covers")
    heads = cut(cover.groupBy(*AT).agg(F.min(key).alias("_head")), "heads")
    sure = cover.join(heads.hint("merge"), AT).where(F.col(key) != F.col("_head")).select(F.col(key).alias("u"), F.col("_head").alias("v")).distinct()
    first = connected_components(sure, cut).withColumnRenamed("node", key)
    named = cut(grid.select(key, *AT, "own").join(first.hint("merge"), key, "left").withColumn("component", F.coalesce("component", key)), "named")
    several = named.groupBy(*AT).agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a != _b").select(*AT)
    rest = cut(named.join(several.hint("merge"), AT, "left_semi").join(heads.hint("merge"), AT, "left"), "several")
    other = rest.select(*AT, F.col(key).alias("_other"), F.col("component").alias("_component"), F.col("own").alias("_own"), F.col("_head").alias("_first"))
    covered = rest.where("_head IS NOT NULL").drop("own").join(other.where("_other = _first").hint("merge"), AT).where("component != _component")
    bare = rest.where("_head IS NULL").join(other.where("_first IS NULL").hint("merge"), AT).where((F.col("component") != F.col("_component")) & (F.col(key) < F.col("_other")) & (F.col("own") | F.col("_own")))
    both = covered.select(key, "_other").unionByName(bare.select(key, "_other"))
    both = both.select(F.least(key, "_other").alias(key), F.greatest(key, "_other").alias("_other")).distinct()
    box = lambda k, p: J._boxed(polygons.select(F.col(key).alias(k), polygon), polygon).select(k, *(F.col(c).alias(p + c) for c in ("_x0", "_y0", "_x1", "_y1"))).hint("merge")
    near = both.join(box(key, "l"), key).join(box("_other", "r"), "_other").where("l_x0 < r_x1 AND r_x0 < l_x1 AND l_y0 < r_y1 AND r_y0 < l_y1").select(key, "_other")
    theirs = polygons.select(F.col(key).alias("_other"), F.col(polygon).alias("_theirs"))
    met = J.polygon_overlay(polygons.select(key, polygon), theirs, key, "_other", polygon, "_theirs", pairs=spread(near)).select(key, "_other")
    node = named.select(key, "component").distinct()
    links = met.join(node.withColumnRenamed("component", "u").hint("merge"), key).join(node.select(F.col(key).alias("_other"), F.col("component").alias("v")).hint("merge"), "_other").select("u", "v").distinct()
    last = connected_components(links, cut).select(F.col("node").alias("component"), F.col("component").alias("_last"))
    return node.join(last, "component", "left").select(key, F.coalesce("_last", "component").alias("component"))


def outline_sides(polygons: DataFrame, key: str, group: str, polygon: str = "rings", size: float = 20.0, grid: DataFrame | None = None) -> DataFrame:
    """(group, key, ax, ay, bx, by): the outline of what the polygons of each group cover together, as directed sides with the inside
    on their left. Of a polygon's sides the parts remain that no other covers, and of sides that several share in one direction those
    of the least key. Areas and lengths of a group are sums of its sides. Keys are unique and not null.

    A cell of a grid that one polygon of a group covers holds none of its outline: polygons whose sides come near no other cell are left
    out, and the others meet the coverers of such cells and all polygons in the rest. n polygons that pass one cell
    which none of them covers make n * n pairs; of a stack of equal ones take different ones first. grid is polygon_grid() of the
    polygons; without one cells are a tenth of size."""
    grid = polygon_grid(polygons, key, polygon, size / 10) if grid is None else grid
    cells = grid.join(polygons.select(key, F.struct(group).alias("_group")).hint("merge"), key)
    at = ["_group", *AT]
    heads = cells.where("covers").groupBy(*at).agg(F.min(key).alias("_head"))
    cells = cells.join(heads.hint("merge"), at, "left")
    outer = cells.where("own AND passed AND _head IS NULL").select(key).distinct()
    mine = cells.where("passed").join(outer.hint("merge"), key, "left_semi")
    covered = mine.where("_head IS NOT NULL").select(key, F.col("_head").alias("_other"))
    other = cells.where("_head IS NULL").select(*at, F.col(key).alias("_other"), F.col("own").alias("_own"))
    bare = mine.where("_head IS NULL").join(other.hint("merge"), at).where("own OR _own").select(key, "_other")
    near = covered.unionByName(bare).unionByName(outer.select(key, F.col(key).alias("_other"))).distinct()
    theirs = polygons.select(F.col(key).alias("_other"), F.col(polygon).alias("_theirs"))
    met = near.join(polygons.select(key, group).hint("merge"), key).join(theirs.hint("merge"), "_other")
    met = met.groupBy(key, group).agg(F.collect_list(F.struct((F.col("_other") < F.col(key)).alias("earlier"), (F.col("_other") == F.col(key)).alias("own"), "_theirs")).alias("_near"))
    ends = [T.StructField(c, T.DoubleType()) for c in ("ax", "ay", "bx", "by")]

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.asarray(b.column("_near").value_lengths(), np.int64)
            flat = b.column("_near").flatten()
            earlier, own = (np.asarray(flat.field(k).cast(pa.int8())) > 0 for k in (0, 1))
            edges = [O.edges_of([r for p in polygons for r in p]) for polygons in O.overlays(_sides(flat.field(2), len(flat)))]
            found = []
            for a, n in zip(np.cumsum(size) - size, size, strict=True):
                others = [k for k in range(a, a + n) if not own[k] and len(edges[k])]
                me = next(k for k in range(a, a + n) if own[k])
                found.append(O.outer_parts(edges[me], [(not earlier[k], edges[k]) for k in others]) if len(edges[me]) else O.NONE)
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            values = np.concatenate(found) if found else O.NONE
            yield pa.RecordBatch.from_arrays([b.column(group).take(rows), b.column(key).take(rows), *(pa.array(np.ascontiguousarray(values[:, c])) for c in range(4))], names=[group, key, "ax", "ay", "bx", "by"])

    return spread(met).mapInArrow(trace, T.StructType([polygons.schema[group], polygons.schema[key], *ends]))


def sides_area(ax: str = "ax", ay: str = "ay", bx: str = "bx", by: str = "by") -> Column:
    """Aggregate: the area that directed sides enclose, holes left out."""
    return F.sum(F.col(ax) * F.col(by) - F.col(bx) * F.col(ay)) / 2


def dissolved(polygons: DataFrame, key: str, group: str, polygon: str = "rings", size: float = 20.0, grid: DataFrame | None = None) -> DataFrame:
    """(group, polygons): what the polygons of each group cover together, as polygons. Only what is left of their sides, the outline,
    meets in a task. Corners nearer than 0.2 mm (in metres) become one. Keys are unique and not null; a null group is one."""
    sides = outline_sides(polygons, key, group, polygon, size, grid)
    gathered = sides.groupBy(group).agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("_sides"))

    def make(b: pa.RecordBatch) -> list:
        flat = b.column("_sides").flatten()
        e = np.stack([np.asarray(flat.field(k), float) for k in range(4)], 1)
        at = np.concatenate([[0], np.cumsum(np.asarray(b.column("_sides").value_lengths(), np.int64))])
        return [O.overlay(O.joined_ends(e[i:j]), rule="positive") for i, j in zip(at[:-1], at[1:], strict=True)]

    return _with_polygons(gathered, "polygons", make).drop("_sides")


def building_blocks(buildings: DataFrame, key: str, height: str, reach: float, cut: Callable[[DataFrame, str], DataFrame], polygon: str = "rings", size: float = 50.0) -> DataFrame:
    """(block_id, n, polygons, area_m2, height_max, height_p90, height_median): buildings grown by reach that overlap form a block, named
    by its least key; its outline is what they cover together, shrunk by half of reach, or left as it is where nothing would stay.

    Any reach and any polygons will do; buildings without a valid polygon form no block. Keys are unique and not null. Percentiles of
    one block meet in one task, and so does its outline, not its buildings."""
    grown = buffered(buildings.select(key, height, polygon), reach, polygon).where(F.size("polygons") > 0)
    grown = cut(grown.select(key, height, F.flatten("polygons").alias("_grown")), "blocks-grown")
    # what is grown holds a whole cell of this size, but for the chords of its arcs
    cell = max(0.7 * reach, 100 * _APART) if reach > 0 else size / 16
    grid = cut(polygon_grid(grown, key, "_grown", cell), "blocks-grid")
    block = overlap_components(grown, grid, key, "_grown", cut)
    member = cut(grown.join(block, key, "left").withColumn("block_id", F.coalesce("component", key)).drop("component"), "blocks-members")
    outline = cut(dissolved(member, key, "block_id", "_grown", grid=grid), "blocks-outlines")
    shrunk = buffered(outline.withColumn("_whole", F.flatten("polygons")), -reach / 2, "_whole", "_shrunk")
    kept = shrunk.select("block_id", F.when(F.size("_shrunk") > 0, F.col("_shrunk")).otherwise(F.col("polygons")).alias("polygons"))
    area = F.aggregate("polygons", F.lit(0.0), lambda s, p: s + polygon_area(p))
    p = F.percentile(height, F.array(F.lit(0.9), F.lit(0.5)))
    heights = member.groupBy("block_id").agg(F.count("*").alias("n"), F.max(height).alias("height_max"), p.alias("_p"))
    out = kept.withColumn("area_m2", area).join(heights, "block_id")
    return out.select("block_id", "n", "polygons", "area_m2", "height_max", F.get("_p", F.lit(0)).alias("height_p90"), F.get("_p", F.lit(1)).alias("height_median"))
