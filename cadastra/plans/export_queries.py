"""Queries on rows that leave the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import records as R

from .derived import footprints, points
from .registry import query


def _masses(spark, sf_dir):
    s = F.col("p_size")
    quality = F.when(s % 7 == 0, "empty").when(s % 5 == 0, "fallback").when(s % 3 != 0, "good")
    return footprints(spark, sf_dir).select("cluster_id", "tile_id", "cx", "cy", "ring", s.alias("p_size"), F.when(s % 4 != 0, s * 0.5).alias("estimated_height"), quality.alias("source_quality"), (s % 2 == 0).alias("metric"), "area_m2", "method")


_MASSES = "WITH m AS (SELECT *, CASE WHEN p_size % 4 <> 0 THEN p_size * CAST(0.5 AS DOUBLE) END AS eh, CASE WHEN p_size % 7 = 0 THEN 'empty' WHEN p_size % 5 = 0 THEN 'fallback' WHEN p_size % 3 <> 0 THEN 'good' END AS q FROM footprints)"


@query(_MASSES + " SELECT cluster_id, coalesce(q NOT IN ('empty', 'fallback'), true) AS lod0_included, coalesce(q <> 'empty', true) AS lod1_included, CASE WHEN p_size % 2 = 0 THEN eh END AS estimated_height_m FROM m")
def p23_lod_and_metric_twins(spark, sf_dir):
    """P23, P25."""
    m = R.with_metric_twins(R.with_lod(_masses(spark, sf_dir)), ("estimated_height",), F.col("metric"))
    return m.select("cluster_id", "lod0_included", "lod1_included", "estimated_height_m")


@query("SELECT tile_id, CAST(count_if(z >= 10) AS BIGINT) AS n_land, CAST(count_if(z < 10) AS BIGINT) AS n_water, CAST(count_if(x BETWEEN 100 AND 300 AND y BETWEEN 150 AND 450) AS BIGINT) AS n_place FROM points GROUP BY 1")
def p22_land_and_places(spark, sf_dir):
    """P22, P24."""
    p = R.land_and_water(points(spark, sf_dir), 10.0).withColumn("place", R.in_place(F.col("x"), F.col("y"), (100.0, 150.0, 300.0, 450.0)))
    return p.groupBy("tile_id").agg(F.count_if("is_land").alias("n_land"), F.count_if(~F.col("is_land")).alias("n_water"), F.count_if("place").alias("n_place"))


@query(_MASSES + " SELECT cluster_id AS id, round(coalesce(eh, 0), 2) AS h, round(cx - 500, 2) AS cx, round(cy - 400, 2) AS cy, coalesce(q, 'unknown') AS quality, coalesce(q NOT IN ('empty', 'fallback'), true) AS lod0 FROM m")
def p26_export_records(spark, sf_dir):
    m = R.with_lod(_masses(spark, sf_dir))
    return R.export_records(m.drop("ring"), m.select("cluster_id", "ring"), 500.0, 400.0)


@query(_MASSES + """, f AS (SELECT cluster_id, method FROM footprints WHERE p_size % 6 <> 0), n AS (SELECT * FROM m WHERE p_size % 11 <> 0)
SELECT coalesce(f.cluster_id, n.cluster_id) AS id, round(coalesce(nullif(n.eh, 0), 6.0), 1) AS height_m, round(coalesce(n.area_m2, 0), 1) AS area_m2, coalesce(f.method, '') AS county_type, coalesce(n.q, '') AS quality, f.cluster_id IS NOT NULL AS placed FROM f FULL JOIN n ON f.cluster_id = n.cluster_id""")
def j32_enrichment_records(spark, sf_dir):
    m = _masses(spark, sf_dir)
    at = G.to_utm(F.lit(-80.2), F.lit(25.8), 17)
    f = m.where("p_size % 6 != 0").select("cluster_id", (at["x"] + F.col("cx")).alias("cx"), (at["y"] + F.col("cy")).alias("cy"), F.lit(None).cast("double").alias("county_height_m"), F.col("method").alias("bld_type"), F.lit(None).cast("int").alias("year_update"))
    n = m.where("p_size % 11 != 0").select("cluster_id", F.col("estimated_height").alias("height_m"), F.col("area_m2").alias("footprint_area_m2"), F.col("source_quality").alias("quality"))
    out = R.enrichment_records(f, n, "city", 17)
    return out.select("id", "height_m", "area_m2", "county_type", "quality", F.coalesce(F.col("lat").between(25, 26) & F.col("lon").between(-81, -79), F.lit(False)).alias("placed"))


@query(_MASSES + " SELECT a.cluster_id, b.q AS quality FROM m a LEFT JOIN (SELECT * FROM m WHERE tile_id = '1_1' AND p_size % 2 = 0) b USING (cluster_id)")
def j40_tile_enrichment(spark, sf_dir):
    """The enriched rows of one tile, by cluster."""
    m = _masses(spark, sf_dir)
    e = m.where("p_size % 2 = 0").select("tile_id", "cluster_id", "source_quality")
    return R.with_enrichment(m.select("cluster_id"), e, "1_1").select("cluster_id", F.col("enriched.source_quality").alias("quality"))
