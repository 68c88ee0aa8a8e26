"""Cover of large polygons by cells: a boundary of any number of corners becomes a table of cells, so that no pair of a join, and no
key, ever holds the whole of it.

A cell that sides cross keeps those sides and whether its lower left corner is inside; a cell that none crosses is there if it's
inside, without sides. Both follow from the crossings of sides with the grid's lines: a corner is inside if an odd number of
crossings lie to its left. The grid is moved by a part of a cell, so that its lines don't run along sides at round coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadastra.functions import geometry as G

_MOVED = 0.3819660112501051
_SIDE = "struct<ax:double,ay:double,bx:double,by:double>"


def cell_of(v: Column, size: float) -> Column:
    return F.floor(v / size - _MOVED)


def corner_of(i: Column, size: float) -> Column:
    return (i + _MOVED) * size


def polygon_sides(polygons: DataFrame, place: str, rings: str) -> DataFrame:
    """(place, side) of each side of polygons that are arrays of rings; sides without length or with null ends are left out."""
    ring = polygons.select(F.col(place).alias("place"), F.explode(rings).alias("ring"))
    at = ring.select("place", F.explode(G.edges(F.col("ring"))).alias("e"))
    side = F.struct(F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))
    return at.select("place", side.cast(_SIDE).alias("side")).where("side.ax + side.ay + side.bx + side.by IS NOT NULL AND (side.ax != side.bx OR side.ay != side.by)")


def _x_at(side: Column, y: Column) -> Column:
    return side["ax"] + (y - side["ay"]) * (side["bx"] - side["ax"]) / (side["by"] - side["ay"])


def _y_at(side: Column, x: Column) -> Column:
    return side["ay"] + (x - side["ax"]) * (side["by"] - side["ay"]) / (side["bx"] - side["ax"])


def polygon_cover(polygons: DataFrame, size: float, place: str = "place", rings: str = "rings") -> DataFrame:
    """(place, cx, cy, odd, sides) of the cells inside polygons and on their sides, holes and parts included.

    odd is whether the cell's lower left corner is inside. A side comes once for each cell that it passes; size should leave a few
    in a cell. A polygon without rings has no cells."""
    s = F.col("side")
    sides = polygon_sides(polygons, place, rings)
    low, high = F.least(s["ay"], s["by"]), F.greatest(s["ay"], s["by"])
    rows = sides.withColumn("cy", F.explode(F.sequence(cell_of(low, size), cell_of(high, size))))
    below, above = F.greatest(low, corner_of(F.col("cy"), size)), F.least(high, corner_of(F.col("cy") + 1, size))
    ends = F.when(low == high, F.array(s["ax"], s["bx"])).otherwise(F.array(_x_at(s, below), _x_at(s, above)))
    passed = rows.withColumn("_x", ends).withColumn("cx", F.explode(F.sequence(cell_of(F.array_min("_x"), size), cell_of(F.array_max("_x"), size))))
    border = passed.groupBy("place", "cy", "cx").agg(F.collect_list("side").alias("sides"))
    line = corner_of(F.col("cy"), size)
    crossed = rows.where((s["ay"] <= line) != (s["by"] <= line)).select("place", "cy", _x_at(s, line).alias("x"), F.lit(None).cast("long").alias("cx"), F.lit(None).cast(f"array<{_SIDE}>").alias("sides"))
    both = crossed.unionByName(border.select("place", "cy", corner_of(F.col("cx"), size).alias("x"), "cx", "sides"))
    along = W.partitionBy("place", "cy").orderBy("x", F.col("cx").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    known = both.withColumn("odd", F.count_if(F.col("cx").isNull()).over(along) % 2 == 1).where("cx IS NOT NULL")
    known = known.withColumn("_last", F.lag("cx").over(W.partitionBy("place", "cy").orderBy("cx")))
    gap = F.when(F.col("odd") & (F.col("cx") - F.col("_last") > 1), F.sequence(F.col("_last") + 1, F.col("cx") - 1))
    inner = known.where(gap.isNotNull()).select("place", F.explode(gap).alias("cx"), "cy", F.lit(True).alias("odd"), F.array().cast(f"array<{_SIDE}>").alias("sides"))
    return known.select("place", "cx", "cy", "odd", "sides").unionByName(inner)


def inside_cell(odd: Column, sides: Column, cx: Column, cy: Column, x: Column, y: Column, size: float) -> Column:
    """Whether a point of a cell is inside: from the cell's corner up, then right, each side crossed turns it over."""
    x0, y0 = corner_of(cx, size), corner_of(cy, size)
    up = lambda e: ((e["ax"] <= x0) != (e["bx"] <= x0)) & (_y_at(e, x0) > y0) & (_y_at(e, x0) <= y)
    right = lambda e: ((e["ay"] <= y) != (e["by"] <= y)) & (_x_at(e, y) > x0) & (_x_at(e, y) <= x)
    turns = F.aggregate(sides, odd.cast("int"), lambda n, e: n + F.coalesce(up(e), F.lit(False)).cast("int") + F.coalesce(right(e), F.lit(False)).cast("int"))
    return turns % 2 == 1


def points_in_cover(points: DataFrame, cover: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """points with the place of each polygon they are in; a point on a side is in one of the polygons that share it. A pair holds a
    cell's sides only, and Spark tests it where it is joined."""
    keyed = points.withColumns({"_cx": cell_of(F.col(x), size), "_cy": cell_of(F.col(y), size)})
    c = cover.withColumnsRenamed({"cx": "_cx", "cy": "_cy", "odd": "_odd", "sides": "_sides"})
    test = inside_cell(F.col("_odd"), F.col("_sides"), F.col("_cx"), F.col("_cy"), F.col(x), F.col(y), size)
    return keyed.join(c, ["_cx", "_cy"]).where(test).select(*points.columns, "place")


def passes(side: Column, box: Column) -> Column:
    """Whether a side runs through the inside of a box: some of it is left when it's cut to the box, and not along its edge."""
    dx, dy = side["bx"] - side["ax"], side["by"] - side["ay"]
    cut = lambda d, a, low, high: (
        F.when(d == 0, F.when((a > low) & (a < high), 0.0)).otherwise(F.least((low - a) / d, (high - a) / d)),
        F.when(d == 0, F.when((a > low) & (a < high), 1.0)).otherwise(F.greatest((low - a) / d, (high - a) / d)),
    )
    (ix, ox), (iy, oy) = cut(dx, side["ax"], box["xmin"], box["xmax"]), cut(dy, side["ay"], box["ymin"], box["ymax"])
    missed = ix.isNull() | iy.isNull()
    return ~missed & (F.greatest(ix, iy, F.lit(0.0)) < F.least(ox, oy, F.lit(1.0)))


def boxes_in_cover(boxes: DataFrame, cover: DataFrame, size: float, box: str = "box") -> DataFrame:
    """boxes that share area with a polygon, with its place, each once: a side runs through them, or their middle is inside."""
    b = F.col(box)
    keyed = boxes.withColumn("_cx", F.explode(F.sequence(cell_of(b["xmin"], size), cell_of(b["xmax"], size))))
    keyed = keyed.withColumn("_cy", F.explode(F.sequence(cell_of(b["ymin"], size), cell_of(b["ymax"], size))))
    c = cover.withColumnsRenamed({"cx": "_cx", "cy": "_cy", "odd": "_odd", "sides": "_sides"})
    mx, my = (b["xmin"] + b["xmax"]) / 2, (b["ymin"] + b["ymax"]) / 2
    here = (F.col("_cx") == cell_of(mx, size)) & (F.col("_cy") == cell_of(my, size))
    middle = here & inside_cell(F.col("_odd"), F.col("_sides"), F.col("_cx"), F.col("_cy"), mx, my, size)
    hit = keyed.join(c, ["_cx", "_cy"]).where(middle | F.exists("_sides", lambda e: passes(e, b)))
    return hit.select(*boxes.columns, "place").distinct()
