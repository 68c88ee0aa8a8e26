"""Queries on boundaries, clipping, cell footprints and comparisons of segmentations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import boundary as B
from cadastra.operators import cluster as C
from cadastra.operators import polygons as P

from .clusters import cut
from .derived import footprints, points, tiles
from .evidence_queries import c10_neck_segments
from .registry import query


def _rings(*boxes):
    ring = lambda b: F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in b))
    return F.array(*map(ring, boxes))


def _place(spark, *rings):
    return spark.range(1).select(F.lit("The Place").alias("name"), _rings(*rings).alias("rings"))


def _boxes(spark, sf_dir):
    return tiles(spark, sf_dir).select("tile_id", F.struct("xmin", "ymin", "xmax", "ymax").alias("box"))


@query("""SELECT cluster_id, round(greatest(0, least(cx + hw, 600) - greatest(cx - hw, 200)) * greatest(0, least(cy + hh, 600) - greatest(cy - hh, 200)), 4) AS area,
  CASE WHEN least(cx + hw, 600) - greatest(cx - hw, 200) > 0 AND least(cy + hh, 600) - greatest(cy - hh, 200) > 0 THEN 'positive' ELSE 'touch_only' END AS kind FROM footprints WHERE cx + hw >= 200 AND cx - hw <= 600 AND cy + hh >= 200 AND cy - hh <= 600""")
def j15_study_candidates(spark, sf_dir):
    out = B.study_candidates(footprints(spark, sf_dir).select("cluster_id", "ring"), "cluster_id", "ring", (200.0, 200.0, 600.0, 600.0))
    return out.select("cluster_id", F.round("area", 4).alias("area"), "kind")


@query("""WITH b AS (SELECT * FROM (VALUES (0, 0, 400, 1100), (600, 0, 900, 700)) b(bx0, by0, bx1, by1)),
c AS (SELECT cluster_id, greatest(cx - hw, bx0) AS x0, least(cx + hw, bx1) AS x1, greatest(cy - hh, by0) AS y0, least(cy + hh, by1) AS y1 FROM footprints, b),
d AS (SELECT cluster_id, t.tile_id, least(x1, xmax) - greatest(x0, xmin) AS w, least(y1, ymax) - greatest(y0, ymin) AS h FROM c, tiles t WHERE x1 > x0 AND y1 > y0)
SELECT cluster_id, tile_id, round(w * h, 2) AS area_m2 FROM d WHERE w > 1e-9 AND h > 1e-9 AND round(w * h, 2) BETWEEN 9 AND 200000""")
def j16_clip_footprints(spark, sf_dir):
    """Footprints cut to a boundary of two parts and then to tiles."""
    place = _place(spark, [(0, 0), (400, 0), (400, 1100), (0, 1100)], [(600, 0), (900, 0), (900, 700), (600, 700)])
    out = B.clip_footprints(footprints(spark, sf_dir).select("cluster_id", "ring"), _boxes(spark, sf_dir), B.boundary_of(place, " the place"), "cluster_id", cut=cut)
    return out.select("cluster_id", "tile_id", "area_m2")


@query("""WITH b AS (SELECT * FROM (VALUES (0, 0, 400, 1100), (600, 0, 900, 700)) b(bx0, by0, bx1, by1)),
d AS (SELECT f.cluster_id, t.tile_id, greatest(cx - hw, bx0, xmin) AS x0, least(cx + hw, bx1, xmax) AS x1, greatest(cy - hh, by0, ymin) AS y0, least(cy + hh, by1, ymax) AS y1, cx, cy FROM footprints f, tiles t, b),
e AS (SELECT cluster_id, tile_id, (x1 - x0) * (y1 - y0) - greatest(0, x1 - greatest(x0, cx)) * greatest(0, y1 - greatest(y0, cy)) AS area FROM d WHERE x1 - x0 > 1e-9 AND y1 - y0 > 1e-9)
SELECT cluster_id, tile_id, round(area, 2) AS area_m2 FROM e WHERE round(area, 2) BETWEEN 9 AND 200000""")
def j16_clip_concave(spark, sf_dir):
    """The same for footprints without their upper right quarter, as polygons."""
    place = _place(spark, [(0, 0), (400, 0), (400, 1100), (0, 1100)], [(600, 0), (900, 0), (900, 700), (600, 700)])
    at = lambda i, j: F.struct((F.col("cx") + i * F.col("hw")).alias("x"), (F.col("cy") + j * F.col("hh")).alias("y"))
    f = footprints(spark, sf_dir).select("cluster_id", F.array(F.array(*(at(i, j) for i, j in ((-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (-1, 1))))).alias("rings"))
    out = B.clip_footprints(f, _boxes(spark, sf_dir), B.boundary_of(place, "The Place"), "cluster_id", "rings", cut=cut)
    return out.select("cluster_id", "tile_id", "area_m2")


@query("""SELECT cluster_id, CASE WHEN cluster_id % 3 = 2 THEN 2 ELSE 1 END AS n, round(CASE cluster_id % 3 WHEN 0 THEN 4 * hw * hh WHEN 1 THEN 3 * hw * hh ELSE 2 * hw * hh / 2 END, 3) AS area FROM footprints""")
def g7_repaired(spark, sf_dir):
    """Valid footprints, some whose ring runs back along itself, and bow ties, which fall apart; the area of the largest part."""
    at = lambda i, j: F.struct((F.col("cx") + i * F.col("hw")).alias("x"), (F.col("cy") + j * F.col("hh")).alias("y"))
    shapes = [((-1, -1), (1, -1), (1, 1), (-1, 1)), ((-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (0, 2), (0, 1), (-1, 1)), ((-1, -1), (1, 1), (1, -1), (-1, 1))]
    rings = [F.array(*(at(i, j) for i, j in shape)) for shape in shapes]
    k = F.col("cluster_id") % 3
    f = footprints(spark, sf_dir).select("cluster_id", F.when(k == 0, rings[0]).when(k == 1, rings[1]).otherwise(rings[2]).alias("ring"))
    out = P.repaired(f, "ring")
    return out.select("cluster_id", F.size("polygons").alias("n"), F.round(P.polygon_area(F.get("polygons", F.lit(0))), 3).alias("area"))


@query("SELECT cluster_id, round((2 * hw - 1) * (2 * hh - 1) - CASE WHEN cluster_id % 2 = 1 THEN 3 + 4 * sin(pi() / 16) ELSE 0 END, 3) AS area FROM footprints")
def g19_inset(spark, sf_dir):
    """Footprints, half of them with a courtyard of a metre, shrunk by half a metre; its corners become eight chords."""
    yard = F.array(*(F.struct((F.col("cx") + i).alias("x"), (F.col("cy") + j).alias("y")) for i, j in ((-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5), (0.5, -0.5))))
    f = footprints(spark, sf_dir).select("cluster_id", F.when(F.col("cluster_id") % 2 == 1, F.array("ring", yard)).otherwise(F.array("ring")).alias("rings"))
    out = P.buffered(f, -0.5)
    return out.select("cluster_id", F.round(P.polygon_area(F.get("polygons", F.lit(0))), 3).alias("area"))


@query("SELECT tile_id FROM tiles WHERE xmin + ymin < 900")
def j17_tiles_in_boundary(spark, sf_dir):
    """Tiles that share area with a triangle."""
    place = _place(spark, [(0, 0), (900, 0), (0, 900)])
    return B.tiles_in(_boxes(spark, sf_dir), B.boundary_of(place, "THE PLACE")).select("tile_id")


@query("""SELECT tile_id, concat_ws(',', CASE WHEN xmin <= 500 AND ymin <= 400 THEN 'west' END, CASE WHEN xmax >= 600 AND ymin <= 1000 THEN 'east' END, CASE WHEN ymax >= 700 THEN 'north' END) AS regions FROM tiles""")
def j18_regions(spark, sf_dir):
    out = B.regions_of(_boxes(spark, sf_dir), {"west": (0.0, 0.0, 500.0, 400.0), "east": (600.0, -10.0, 2000.0, 1000.0), "north": (-10.0, 700.0, 2000.0, 2000.0)})
    return out.select("tile_id", F.array_join("regions", ",").alias("regions"))


@query("""WITH s AS (SELECT tile_id, xmin + t * (xmax - xmin) AS x, ymin + t * (ymax - ymin) AS y, xmin, xmax, ymin, ymax, t FROM tiles, (SELECT unnest(range(65)) / CAST(64 AS DOUBLE) AS t))
SELECT tile_id, round(max(greatest(x * (1000 - x) + ymax, x * (1000 - x) + ymin, xmin * (1000 - xmin) + y, xmax * (1000 - xmax) + y)), 4) AS dense, round(max(CASE WHEN t IN (0, 1) THEN x * (1000 - x) + ymax END), 4) AS corners FROM s GROUP BY 1""")
def g2_g3_boxes(spark, sf_dir):
    """Boxes in other coordinates by their corners, and by points along their sides."""
    bend = lambda x, y: F.struct((x * (1000 - x) + y).alias("x"), y.alias("y"))
    b = _boxes(spark, sf_dir)
    return b.select("tile_id", F.round(B.dense_box(F.col("box"), bend)["xmax"], 4).alias("dense"), F.round(B.corner_box(F.col("box"), bend)["xmax"], 4).alias("corners"))


@query("""SELECT cluster_id, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS components, CAST(p_size % 3 = 0 AS INTEGER) AS holes, round(4 * hw * hh, 4) AS area FROM footprints""")
def g7_g17_parts(spark, sf_dir):
    """Largest part of polygons with parts and holes; how many of each they have."""
    f, s = footprints(spark, sf_dir), F.col("p_size")
    scaled = lambda k: F.transform("ring", lambda p: F.struct((p["x"] * k).alias("x"), (p["y"] * k).alias("y")))
    outline = F.when(s % 3 == 0, F.array(F.col("ring"), scaled(0.5))).otherwise(F.array(F.col("ring")))
    parts = F.when(s % 2 == 0, F.array(F.array(scaled(0.3)), outline)).otherwise(F.array(outline))
    n = B.part_counts(parts)
    return f.select("cluster_id", n["components"].alias("components"), n["holes"].alias("holes"), F.round(G.area(B.largest_part(parts)[0]), 4).alias("area"))


@query()
def c9_grid_footprints(spark, sf_dir):
    """The largest component of the closed cells of each tile's buildings."""
    return C.grid_footprints(points(spark, sf_dir).where("classification = 6"), 6.0, "tile_id", cut)


@query()
def g19_shrunk_footprints(spark, sf_dir):
    """The same, a cell further in; inward buffers exist as cells only."""
    return C.shrunk(c9_grid_footprints(spark, sf_dir).select("key", "row", "col"), cut)


@query("""WITH c AS (SELECT DISTINCT tile_id AS key, floor(x / 6) AS i, floor(y / 6) AS j FROM points WHERE classification = 6) SELECT key, count(*) AS n_cells, count(*) AS n_assigned, 0 AS n_repeated, 0 AS n_foreign, TRUE AS ok FROM c GROUP BY 1""")
def c10_conservation(spark, sf_dir):
    """Neck segmentation keeps every cell, once."""
    cells = C.occupancy(points(spark, sf_dir).where("classification = 6"), 6.0, "tile_id")
    return C.conserved(cells, c10_neck_segments(spark, sf_dir))


@query("""WITH c AS (SELECT DISTINCT tile_id, floor(x / 6) AS i, floor(y / 6) AS j FROM points WHERE classification = 6) SELECT p.tile_id, count(*) AS n, CAST(count_if(c.i IS NULL) AS BIGINT) AS n_outside FROM points p LEFT JOIN c ON c.tile_id = p.tile_id AND c.i = floor(p.x / 6) AND c.j = floor(p.y / 6) GROUP BY 1""")
def c12_points_of_children(spark, sf_dir):
    """Points by their cell's segment; how many are outside all."""
    p = C.to_children(points(spark, sf_dir), c10_neck_segments(spark, sf_dir), 6.0, "tile_id")
    return p.groupBy("tile_id").agg(F.count("*").alias("n"), F.count_if(F.col("component").isNull()).alias("n_outside"))


_COUNTS = """n AS (SELECT tile_id AS key, count(DISTINCT p_size) AS r1, count(DISTINCT p_size % 20) AS r2, count(*) AS m FROM footprints GROUP BY 1), e AS (SELECT key, CASE WHEN m > 100 THEN 30 END AS least, m <= 100 AS single, r1, r2 FROM n)"""


def _compared(spark, sf_dir):
    f = footprints(spark, sf_dir).groupBy(F.col("tile_id").alias("key"))
    n = f.agg(F.count_distinct("p_size").alias("r1"), F.count_distinct(F.col("p_size") % 20).alias("r2"), F.count("*").alias("m"))
    counts = n.select("key", F.explode(F.create_map(F.lit("r1"), "r1", F.lit("r2"), "r2")).alias("method", "n_children"))
    return C.compare_methods(counts, ["r1", "r2"], n.select("key", F.when(F.col("m") > 100, 30).alias("least"), (F.col("m") <= 100).alias("single")))


@query(f"WITH {_COUNTS} SELECT key, r1, r2, r2 - r1 AS delta, round(r1 / CAST(least AS DOUBLE), 6) AS r1_fraction, r2 >= least AS r2_met FROM e")
def a47_methods(spark, sf_dir):
    return _compared(spark, sf_dir).select("key", "r1", "r2", "delta", F.round("r1_fraction", 6).alias("r1_fraction"), "r2_met")


@query(f"WITH {_COUNTS}, x AS (SELECT 'r1' AS method, r1 AS r, * FROM e UNION ALL SELECT 'r2', r2, * FROM e) SELECT method, count(least) AS n_known, CAST(count_if(r >= least) AS BIGINT) AS n_met, CAST(count_if(single) AS BIGINT) AS n_single, CAST(count_if(single AND r > 1) AS BIGINT) AS n_false_splits FROM x GROUP BY 1")
def a48_scorecard(spark, sf_dir):
    return C.scorecard(_compared(spark, sf_dir), ["r1", "r2"])
