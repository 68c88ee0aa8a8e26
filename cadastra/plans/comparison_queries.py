"""Queries on two layers, boxes, companion files and claim histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import comparisons as P

from .derived import addresses, footprints, read
from .registry import query

_LAYERS = """WITH a AS (SELECT cluster_id AS left_id, cx, cy, p_retailprice AS h, area_m2 FROM footprints WHERE cluster_id % 2 = 0), b AS (SELECT cluster_id AS right_id, cx AS ox, cy AS oy, p_size AS rh, area_m2 AS oa FROM footprints WHERE cluster_id % 2 = 1),
n AS (SELECT left_id, min_by(right_id, (sqrt((cx - ox) ** 2 + (cy - oy) ** 2), right_id)) AS right_id FROM a JOIN b ON abs(cx - ox) <= 20 AND abs(cy - oy) <= 20 WHERE sqrt((cx - ox) ** 2 + (cy - oy) ** 2) <= 20 GROUP BY 1),
c AS (SELECT left_id, right_id, CASE WHEN right_id IS NULL THEN 'no_match' ELSE 'matched' END AS status, round(h - rh, 2) AS height_diff, round(area_m2 / oa, 3) AS area_ratio FROM a LEFT JOIN n USING (left_id) LEFT JOIN b USING (right_id)
  UNION ALL SELECT NULL, right_id, 'right_only', NULL, NULL FROM b WHERE right_id NOT IN (SELECT right_id FROM n))"""


def _compared(spark, sf_dir):
    f = footprints(spark, sf_dir)
    left = f.where("cluster_id % 2 = 0").select(F.col("cluster_id").alias("left_id"), F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("p_retailprice").alias("height"), F.col("area_m2").alias("area"))
    right = f.where("cluster_id % 2 = 1").select(F.col("cluster_id").alias("right_id"), F.col("cx").alias("rx"), F.col("cy").alias("ry"), F.col("p_size").alias("right_height"), F.col("area_m2").alias("right_area"))
    return P.compare_layers(left, right)


@query(_LAYERS + " SELECT * FROM c")
def j20_compare_layers(spark, sf_dir):
    """Both sides of two layers, with differences of heights and ratios of areas."""
    return _compared(spark, sf_dir).drop("dist")


@query(_LAYERS + " SELECT CAST(count_if(status = 'matched') AS BIGINT) AS n_matched, CAST(count_if(status = 'no_match') AS BIGINT) AS n_no_match, CAST(count_if(status = 'right_only') AS BIGINT) AS n_right_only, min(height_diff) AS least_diff, max(height_diff) AS greatest_diff FROM c")
def a39_layer_summary(spark, sf_dir):
    return P.comparison_summary(_compared(spark, sf_dir)).drop("mean_diff")


@query("SELECT source, count(*) AS n, round(min(rx), 6) AS xmin, round(min(ry), 6) AS ymin, round(max(rx), 6) AS xmax, round(max(ry), 6) AS ymax FROM addresses GROUP BY 1")
def a44_layer_boxes(spark, sf_dir):
    """A44."""
    return P.layer_box(addresses(spark, sf_dir), "rx", "ry", ["source"]).select("source", "n", "box.*")


def _files(spark, sf_dir):
    ends = F.array(*map(F.lit, (".shp", ".SHX", ".dbf", ".prj", ".copc.laz")))
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(F.concat(F.lit("raw/d"), (k % 3).cast("string"), F.lit("/S"), F.floor(k / 9).cast("string"), F.element_at(ends, (F.col("p_size") % 5 + 1).cast("int"))).alias("path"))


_FILES = "WITH p AS (SELECT 'raw/d' || (p_partkey % 3) AS folder, 's' || (p_partkey // 9) AS stem, (['.shp', '.shx', '.dbf', '.prj', '.laz'])[p_size % 5 + 1] AS suffix FROM part)"


@query(_FILES + """, s AS (SELECT folder, stem, count(DISTINCT CASE WHEN suffix IN ('.shp', '.shx', '.dbf') THEN suffix END) AS n, bool_or(suffix = '.prj') AS prj, bool_or(suffix = '.shp') AS shp FROM p WHERE suffix <> '.laz' GROUP BY 1, 2)
SELECT folder, stem, CAST(3 - n AS INTEGER) AS n_missing, CASE WHEN prj THEN 1 ELSE 2 END AS n_recommended, n = 3 AS ok FROM s WHERE shp""")
def a56_companions(spark, sf_dir):
    """Shape files and what is missing beside them."""
    out = P.companion_sets(_files(spark, sf_dir))
    return out.select("folder", "stem", F.size("missing_required").alias("n_missing"), F.size("missing_recommended").alias("n_recommended"), "ok")


@query(_FILES + " SELECT suffix AS kind, count(*) AS n FROM p GROUP BY 1")
def a56_files_by_kind(spark, sf_dir):
    return P.files_by_kind(_files(spark, sf_dir))


@query("""WITH v AS (SELECT event_id % 40 AS structure_id, event_id, ts, CASE event_type WHEN 'click' THEN 'released' WHEN 'purchase' THEN 'revoked' ELSE event_type END AS status FROM events),
h AS (SELECT *, lag(status) OVER w AS previous_status, row_number() OVER w AS n FROM v WINDOW w AS (PARTITION BY structure_id ORDER BY ts, event_id))
SELECT structure_id, event_id, status, previous_status, CASE WHEN n = 1 THEN 'created' WHEN status IN ('released', 'revoked') THEN status ELSE 'status_changed' END AS event_type FROM h WHERE n = 1 OR status IS DISTINCT FROM previous_status""")
def t3_claim_versions(spark, sf_dir):
    """The history that versions of claims leave."""
    status = F.when(F.col("event_type") == "click", "released").when(F.col("event_type") == "purchase", "revoked").otherwise(F.col("event_type"))
    v = read(spark, sf_dir, "events").select((F.col("event_id") % 40).alias("structure_id"), "event_id", "ts", status.alias("status"))
    return P.claim_history(v, "structure_id", ["ts", "event_id"]).drop("ts")
