"""Queries on clustering, thinning and grids."""

from __future__ import annotations

import tempfile

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadastra.operators import cluster as C

from .derived import points
from .registry import query


def cut(df, label: str):
    """checkpoint() in the session's shared folder, which is set here only where none is named."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


@query("SELECT min(point_id) AS point_id, CAST(floor(x / 2) AS BIGINT) AS cx, CAST(floor(y / 2) AS BIGINT) AS cy FROM points GROUP BY 2, 3")
def c3_thin(spark, sf_dir):
    t = C.thin(points(spark, sf_dir), 2.0)
    return t.select("point_id", F.floor(F.col("x") / 2).alias("cx"), F.floor(F.col("y") / 2).alias("cy"))


@query("""WITH b AS (SELECT * FROM points WHERE classification = 6 AND tile_id IN ('0_0', '1_1')),
c AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS r FROM (SELECT p.point_id AS a, q.point_id AS b, p.tile_id, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) AS d FROM b p JOIN b q ON p.point_id <> q.point_id AND abs(p.x - q.x) < 150 AND abs(p.y - q.y) < 150)),
m AS (SELECT a, tile_id, sum(d) / count(*) AS md FROM c WHERE r <= 12 GROUP BY 1, 2), l AS (SELECT tile_id, avg(md) + 2.2 * stddev_pop(md) AS lv FROM m GROUP BY 1)
SELECT a AS point_id, round(md, 5) AS mean_dist, md > lv AS outlier FROM m JOIN l USING (tile_id)""")
def c2_statistical_outliers(spark, sf_dir):
    p = points(spark, sf_dir).where("classification = 6 AND tile_id IN ('0_0', '1_1')")
    out = C.statistical_outliers(p, cut)
    return out.select("point_id", F.round("mean_dist", 5).alias("mean_dist"), "outlier")


@query()
def c2_all_statistical_outliers(spark, sf_dir):
    """The whole of C2: all building points. c2_statistical_outliers is the slice of two tiles that its SQL can check."""
    out = C.statistical_outliers(points(spark, sf_dir).where("classification = 6"), cut)
    return out.select("point_id", F.round("mean_dist", 5).alias("mean_dist"), "outlier")


@query()
def c1_dbscan(spark, sf_dir):
    return C.dbscan(points(spark, sf_dir).where("classification = 6"), cut, 6.0, 4)


@query("""WITH c AS (SELECT DISTINCT tile_id AS key, CAST(floor(y / 4) AS BIGINT) AS row, CAST(floor(x / 4) AS BIGINT) AS col FROM points WHERE classification = 6),
s AS (SELECT unnest([-1, 0, 1]) AS i), d AS (SELECT DISTINCT key, row + a.i AS row, col + b.i AS col FROM c, s a, s b),
e AS (SELECT key, row + a.i AS row, col + b.i AS col FROM d, s a, s b) SELECT key, row, col FROM e GROUP BY ALL HAVING count(*) = 9""")
def c5_closing(spark, sf_dir):
    return C.closing(C.occupancy(points(spark, sf_dir).where("classification = 6"), 4.0, "tile_id"))


@query("""WITH c AS (SELECT DISTINCT tile_id AS key, CAST(floor(y / 8) AS BIGINT) AS row, CAST(floor(x / 8) AS BIGINT) AS col FROM points WHERE classification <> 2),
s AS (SELECT unnest([-1, 0, 1]) AS i), e AS (SELECT key, row + a.i AS row, col + b.i AS col FROM c, s a, s b), f AS (SELECT key, row, col FROM e GROUP BY ALL HAVING count(*) = 9),
o AS (SELECT DISTINCT key, row + a.i AS row, col + b.i AS col FROM f, s a, s b) SELECT o.* FROM o JOIN c USING (key, row, col)""")
def c6_opening(spark, sf_dir):
    return C.opening(C.occupancy(points(spark, sf_dir).where("classification <> 2"), 8.0, "tile_id"))


@query("""WITH c AS (SELECT tile_id AS key, CAST(floor(y / 10) AS BIGINT) AS row, CAST(floor(x / 10) AS BIGINT) AS col, quantile_cont(z, 0.5) AS z_med FROM points GROUP BY 1, 2, 3)
SELECT a.key, a.row, a.col, b.row AS row2, b.col AS col2, round(abs(a.z_med - b.z_med), 6) AS step, abs(a.z_med - b.z_med) > 2 AS is_cut
FROM c a JOIN c b ON a.key = b.key AND ((b.row = a.row AND b.col = a.col + 1) OR (b.row = a.row + 1 AND b.col = a.col))""")
def j24_height_steps(spark, sf_dir):
    """Median height of each cell, steps to the neighbours, and which of them are cut."""
    cells = points(spark, sf_dir).groupBy(F.col("tile_id").alias("key"), F.floor(F.col("y") / 10).alias("row"), F.floor(F.col("x") / 10).alias("col")).agg(F.percentile("z", F.lit(0.5)).alias("z_med"))
    return C.adjacency(cells, "z_med").select("key", "row", "col", "row2", "col2", F.round("step", 6).alias("step"), (F.col("step") > 2).alias("is_cut"))


@query()
def c11_height_segments(spark, sf_dir):
    """Height-discontinuity segmentation: cells joined to neighbours at most 2 m higher or lower."""
    cells = points(spark, sf_dir).groupBy(F.col("tile_id").alias("key"), F.floor(F.col("y") / 10).alias("row"), F.floor(F.col("x") / 10).alias("col")).agg(F.percentile("z", F.lit(0.5)).alias("z_med"))
    cells = cut(cells, "cells")
    return C.cell_components(cells, cut, C.adjacency(cells, "z_med").where("step <= 2"))


@query("""WITH b AS (SELECT CASE WHEN s <= 0.5 THEN 0 WHEN s <= 1 THEN 1 WHEN s <= 2 THEN 2 WHEN s <= 5 THEN 3 WHEN s <= 10 THEN 4 ELSE 5 END AS bin FROM (
 WITH c AS (SELECT tile_id AS key, floor(y / 10) AS row, floor(x / 10) AS col, quantile_cont(z, 0.5) AS z_med FROM points GROUP BY 1, 2, 3)
 SELECT abs(a.z_med - b.z_med) AS s FROM c a JOIN c b ON a.key = b.key AND ((b.row = a.row AND b.col = a.col + 1) OR (b.row = a.row + 1 AND b.col = a.col))))
SELECT r.bin, count(b.bin) AS n FROM (SELECT CAST(unnest(range(6)) AS INTEGER) AS bin) r LEFT JOIN b USING (bin) GROUP BY 1""")
def a46_step_histogram(spark, sf_dir):
    cells = points(spark, sf_dir).groupBy(F.col("tile_id").alias("key"), F.floor(F.col("y") / 10).alias("row"), F.floor(F.col("x") / 10).alias("col")).agg(F.percentile("z", F.lit(0.5)).alias("z_med"))
    steps = C.adjacency(cells, "z_med")
    bins = F.when(F.col("step") <= 0.5, 0).when(F.col("step") <= 1, 1).when(F.col("step") <= 2, 2).when(F.col("step") <= 5, 3).when(F.col("step") <= 10, 4).otherwise(5)
    counted = steps.groupBy(bins.alias("bin")).agg(F.count("*").alias("n"))
    return spark.range(6).select(F.col("id").cast("int").alias("bin")).join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT CAST(floor(x / 5) AS BIGINT) AS ix, CAST(floor(y / 5) AS BIGINT) AS iy, max(z) AS z, max_by(point_id, (z, point_id)) AS point_id FROM points WHERE classification = 1 GROUP BY 1, 2")
def a31_canopy(spark, sf_dir):
    p = points(spark, sf_dir).where("classification = 1")
    return p.groupBy(F.floor(F.col("x") / 5).alias("ix"), F.floor(F.col("y") / 5).alias("iy")).agg(F.max("z").alias("z"), F.max_by("point_id", F.struct("z", "point_id")).alias("point_id"))


@query("""WITH g AS (SELECT CAST(floor(x / 15) AS BIGINT) AS ix, CAST(floor(y / 15) AS BIGINT) AS iy, avg(z) AS z, count(*) AS n FROM points WHERE classification = 2 GROUP BY 1, 2)
SELECT ix, iy, round(z, 6) AS mean_z, n FROM g""")
def a32_terrain_grid(spark, sf_dir):
    p = points(spark, sf_dir).where("classification = 2")
    return p.groupBy(F.floor(F.col("x") / 15).alias("ix"), F.floor(F.col("y") / 15).alias("iy")).agg(F.round(F.avg("z"), 6).alias("mean_z"), F.count("*").alias("n"))


@query("""WITH q AS (SELECT tile_id, quantile_cont(z, 0.25) AS q1, quantile_cont(z, 0.75) AS q3 FROM points GROUP BY 1)
SELECT tile_id, min(z) FILTER (z >= q1 - 1.5 * (q3 - q1)) AS robust_min, CAST(count_if(z < q1 - 1.5 * (q3 - q1)) AS BIGINT) AS n_rejected, round(quantile_cont(z, 0.01), 6) AS floor_p1 FROM points JOIN q USING (tile_id) GROUP BY 1""")
def a33_robust_minimum(spark, sf_dir):
    p = points(spark, sf_dir)
    q = p.groupBy("tile_id").agg(F.percentile("z", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    low = F.col("q")[0] - 1.5 * (F.col("q")[1] - F.col("q")[0])
    return p.join(q, "tile_id").groupBy("tile_id").agg(F.min(F.when(F.col("z") >= low, F.col("z"))).alias("robust_min"), F.count_if(F.col("z") < low).alias("n_rejected"), F.round(F.percentile("z", F.lit(0.01)), 6).alias("floor_p1"))


@query("""SELECT tile_id, cluster_id, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, min(z) AS zmin, max(z) AS zmax, round((max(x) - min(x)) * (max(y) - min(y)), 6) AS bbox_area, round(quantile_cont(z, 0.9), 6) AS z_p90
FROM inside GROUP BY 1, 2""")
def a1_cluster_summary(spark, sf_dir):
    from cadastra.operators.spatial_join import points_in_polygons

    from .derived import footprints

    p = points_in_polygons(points(spark, sf_dir), footprints(spark, sf_dir).select("cluster_id", "ring"))
    return p.groupBy("tile_id", "cluster_id").agg(
        F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("cx"), F.round(F.avg("y"), 6).alias("cy"), F.min("z").alias("zmin"), F.max("z").alias("zmax"),
        F.round((F.max("x") - F.min("x")) * (F.max("y") - F.min("y")), 6).alias("bbox_area"), F.round(F.percentile("z", F.lit(0.9)), 6).alias("z_p90"),
    )


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY point_id) AS i, count(*) OVER (PARTITION BY tile_id) AS m FROM points)
SELECT point_id, tile_id FROM r WHERE (i - 1) % greatest(1, m // 50) = 0""")
def o8_systematic_sample(spark, sf_dir):
    """About 50 evenly spaced rows of each tile."""
    w = W.partitionBy("tile_id")
    r = points(spark, sf_dir).select("point_id", "tile_id", F.row_number().over(w.orderBy("point_id")).alias("i"), F.count("*").over(w).alias("m"))
    return r.where((F.col("i") - 1) % F.greatest(F.lit(1), F.floor(F.col("m") / 50)) == 0).select("point_id", "tile_id")
