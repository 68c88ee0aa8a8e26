"""Queries on audits, certification and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import audit as A
from cadastra.operators import spatial_join as J

from .derived import addresses, footprints, points, read, tiles
from .registry import query


@query("""WITH c AS (SELECT t.tile_id, count(DISTINCT f.cluster_id) AS n, count(DISTINCT a.address_id) AS m FROM tiles t LEFT JOIN footprints f USING (tile_id) LEFT JOIN addresses a ON a.rx >= xmin AND a.rx < xmax AND a.ry >= ymin AND a.ry < ymax GROUP BY 1)
SELECT tile_id, greatest(n, m) AS building_count, CASE WHEN starts_with(tile_id, '0') AND greatest(n, m) > 0 THEN 'false_zero' WHEN greatest(n, m) = 0 THEN 'expected_zero' ELSE 'consistent' END AS consistency FROM c""")
def a12_zero_buildings(spark, sf_dir):
    """Manifests that say zero against the counts."""
    n = footprints(spark, sf_dir).groupBy("tile_id").agg(F.count_distinct("cluster_id").alias("n"))
    a = addresses(spark, sf_dir).select(F.concat_ws("_", F.floor(F.col("rx") / 250).cast("string"), F.floor(F.col("ry") / 250).cast("string")).alias("tile_id"), "address_id").groupBy("tile_id").agg(F.count("*").alias("m"))
    j = tiles(spark, sf_dir).select("tile_id").join(n, "tile_id", "left").join(a, "tile_id", "left")
    return j.select("tile_id", F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0))).alias("building_count"), A.zero_building([F.col("n"), F.col("m")], F.col("tile_id").startswith("0")).alias("consistency"))


@query("""WITH c AS (SELECT count(*) AS n, count(DISTINCT tile_id) AS t, count_if(area_m2 < 60) AS small FROM footprints)
SELECT 'tiles' AS check, CASE WHEN t < 10 THEN 'FAIL' WHEN t < 20 THEN 'WARN' ELSE 'PASS' END AS status FROM c UNION ALL SELECT 'structures', CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END FROM c UNION ALL SELECT 'small', CASE WHEN small = n THEN 'FAIL' WHEN small > 0 THEN 'WARN' ELSE 'PASS' END FROM c""")
def a20_city_audit(spark, sf_dir):
    """One status row for each check."""
    c = footprints(spark, sf_dir).agg(F.count("*").alias("n"), F.count_distinct("tile_id").alias("t"), F.count_if(F.col("area_m2") < 60).alias("small"))
    no = F.lit(False)
    return A.checks(c, {"tiles": (F.col("t") < 10, F.col("t") < 20), "structures": (F.col("n") == 0, no), "small": (F.col("small") == F.col("n"), F.col("small") > 0)})


@query("""WITH a AS (SELECT doc_id AS k, sha256(coalesce(text, '')) AS h FROM documents WHERE doc_id % 10 <> 0), b AS (SELECT doc_id AS k, sha256(CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE coalesce(text, '') END) AS h FROM documents WHERE doc_id % 10 <> 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_a' WHEN a.k IS NULL THEN 'only_b' WHEN a.h = b.h THEN 'same' ELSE 'differs' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def j28_run_comparison(spark, sf_dir):
    """Two runs file by file."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    a = d.where("k % 10 != 0").select("k", F.sha2("text", 256).alias("h"))
    b = d.where("k % 10 != 1").select("k", F.sha2(F.when(F.col("k") % 7 == 0, "x").otherwise(F.col("text")), 256).alias("h"))
    return A.compare_runs(a, b, "k", "h")


@query("""WITH a AS (SELECT tile_id, count(*) AS n, avg(z) AS z FROM points GROUP BY 1), b AS (SELECT tile_id, count(*) AS n, avg(z) AS z FROM points WHERE classification <> 1 GROUP BY 1)
SELECT a.tile_id, 'n' AS field, a.n = b.n AS ok FROM a JOIN b USING (tile_id) UNION ALL SELECT a.tile_id, 'z', abs(a.z - b.z) <= 0.2 FROM a JOIN b USING (tile_id)""")
def c23_tile_comparison(spark, sf_dir):
    p = points(spark, sf_dir)
    of = lambda d: d.groupBy("tile_id").agg(F.count("*").alias("n"), F.avg("z").alias("z"))
    return A.compare_numbers(of(p), of(p.where("classification != 1")), "tile_id", ["n", "z"], {"z": 0.2}).select("tile_id", "field", "ok")


@query("SELECT event_id, '$.' || k AS path, CAST(json_extract_string(props, '$.' || k) AS VARCHAR) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def f23_json_leaves(spark, sf_dir):
    return A.json_leaves(read(spark, sf_dir, "events").select("event_id", "props"), "event_id", "props", 2)


@query("""WITH t AS (SELECT tile_id, xmin, ymin, xmax, ymax FROM tiles) SELECT cluster_id, list_aggregate(list_sort(list(t.tile_id)), 'string_agg', ',') AS context, count(*) AS n FROM footprints JOIN t ON cx + hw + 10 >= xmin AND cx - hw - 10 <= xmax AND cy + hh + 10 >= ymin AND cy - hh - 10 <= ymax GROUP BY 1""")
def j22_context_tiles(spark, sf_dir):
    """Tiles that a footprint's 10 m surroundings touch."""
    t = tiles(spark, sf_dir).select("tile_id", J.cell(F.col("xmin") + 1, 250.0).alias("_cx"), J.cell(F.col("ymin") + 1, 250.0).alias("_cy"), F.struct("xmin", "ymin", "xmax", "ymax").alias("tb"))
    f = J.polygon_cells(footprints(spark, sf_dir).select("cluster_id", "ring"), "ring", 250.0, 10.5)
    pad = F.struct((F.col("_b.xmin") - 10).alias("xmin"), (F.col("_b.ymin") - 10).alias("ymin"), (F.col("_b.xmax") + 10).alias("xmax"), (F.col("_b.ymax") + 10).alias("ymax"))
    j = f.join(t, ["_cx", "_cy"]).where(G.boxes_overlap(pad, F.col("tb")))
    return j.groupBy("cluster_id").agg(F.array_join(F.sort_array(F.collect_set("tile_id")), ",").alias("context"), F.count("*").alias("n"))


@query("""SELECT tile_id, CASE WHEN bool_or(near) THEN 'hit' ELSE 'miss' END AS status FROM (SELECT f.tile_id, a.address_id IS NOT NULL AS near FROM footprints f LEFT JOIN addresses a ON abs(cx - rx) <= 5 AND abs(cy - ry) <= 5 AND sqrt((cx - rx) ** 2 + (cy - ry) ** 2) <= 5 AND a.address_id <> f.cluster_id) GROUP BY 1""")
def j19_hit_or_miss(spark, sf_dir):
    """Which tiles have a footprint within 5 m of another parcel's address."""
    f = footprints(spark, sf_dir).select("cluster_id", "tile_id", "cx", "cy")
    hit = J.radius_join(f, addresses(spark, sf_dir), 5.0, "cx", "cy").where("address_id != cluster_id").select("tile_id").distinct().withColumn("h", F.lit(True))
    return f.select("tile_id").distinct().join(hit, "tile_id", "left").select("tile_id", F.when(F.col("h"), "hit").otherwise("miss").alias("status"))


@query("""WITH a AS (SELECT cluster_id, cx, cy, area_m2 FROM footprints WHERE cluster_id % 2 = 0), b AS (SELECT cluster_id AS other, cx AS ox, cy AS oy, area_m2 AS oa FROM footprints WHERE cluster_id % 2 = 1),
n AS (SELECT cluster_id, min_by(other, (sqrt((cx - ox) ** 2 + (cy - oy) ** 2), other)) AS other FROM a JOIN b ON abs(cx - ox) <= 20 AND abs(cy - oy) <= 20 WHERE sqrt((cx - ox) ** 2 + (cy - oy) ** 2) <= 20 GROUP BY 1)
SELECT a.cluster_id, n.other, round(a.area_m2 / b.oa, 6) AS area_ratio FROM a LEFT JOIN n USING (cluster_id) LEFT JOIN b ON b.other = n.other""")
def j20_two_layers(spark, sf_dir):
    """Each building of one layer and its nearest of the other within 20 m."""
    f = footprints(spark, sf_dir)
    b = f.where("cluster_id % 2 = 1").select(F.col("cluster_id").alias("other"), F.col("cx").alias("rx"), F.col("cy").alias("ry"), F.col("area_m2").alias("oa"))
    out = J.nearest_join(f.where("cluster_id % 2 = 0").select("cluster_id", "cx", "cy", "area_m2"), b, 20.0, "cluster_id", "other", "cx", "cy")
    return out.select("cluster_id", "other", F.round(F.col("area_m2") / F.col("oa"), 6).alias("area_ratio"))
