"""Queries on surveys, the status of cities and their packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import scalars as S
from cadastra.operators import audit as A
from cadastra.operators import campaigns as C
from cadastra.operators import checks as K
from cadastra.operators import crowds as X
from cadastra.operators import spatial_join as J

from .clusters import cut
from .derived import footprints, read
from .registry import query

CITY = C.City(terms=("brand", "lower", "zebra"), keywords=("brand2",), sample_project="mi_brand3", avoid=("brand4", "legacy"))
_FILES = """f AS (SELECT p_partkey, 'MI_' || replace(p_brand, '#', '') AS campaign_group, 'MI_' || replace(p_brand, '#', '') || '_' || CAST(2000 + p_size % 20 AS VARCHAR) || '_A' || CAST(p_size % 3 AS VARCHAR) AS detailed_prefix,
    'USGS_LPC_MI_' || replace(p_brand, '#', '') || '_' || CAST(2000 + p_size % 20 AS VARCHAR) || '_A' || CAST(p_size % 3 AS VARCHAR) || '_' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || CASE WHEN p_size % 2 = 0 THEN '.laz' ELSE '.las' END AS filename,
    CAST(p_size AS BIGINT) * 1000 AS size_bytes, CASE WHEN p_partkey % 977 = 3 THEN '1899-12-30' ELSE CAST(2001 + p_size % 15 AS VARCHAR) || '-05-01' END AS publication_date, p_size > 2 AS has_box, p_partkey % 50 = 0 AS on_disk FROM part)"""
_GROUPS = """g AS (SELECT campaign_group, count(*) AS tile_count, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(count_if(on_disk) AS BIGINT) AS on_disk_count, bool_or(ends_with(filename, '.laz')) AS has_laz,
    round(100.0 * count_if(has_box) / count(*), 1) AS bbox_percent, list_sort(list(DISTINCT publication_date)) AS dates, list_sort(list(DISTINCT filename))[1:3] AS samples, count(DISTINCT detailed_prefix) AS n_prefixes,
    lower(campaign_group || ' ' || array_to_string(list_sort(list(DISTINCT detailed_prefix)), ' ') || '  ' || array_to_string(list_sort(list(DISTINCT filename))[1:3], ' ')) AS hay FROM f GROUP BY 1)"""
_SCORES = """y AS (SELECT *, list_max(list_transform(dates, lambda d: CAST(d[1:4] AS INTEGER))) AS year, CAST(contains(hay, 'brand') AS INTEGER) + CAST(contains(hay, 'lower') AS INTEGER) + CAST(contains(hay, 'zebra') AS INTEGER) AS terms FROM g),
s AS (SELECT *, (year - 2000) * 2.5 + CASE WHEN terms > 0 THEN least(40, 12 + 4 * terms) ELSE 0 END + CASE WHEN contains(hay, 'brand2') THEN 30 ELSE 0 END + CASE WHEN contains(hay, 'mi_brand3') THEN 50 ELSE 0 END
   - CASE WHEN contains(hay, 'brand4') OR contains(hay, 'legacy') THEN 25 ELSE 0 END + CASE WHEN tile_count BETWEEN 30 AND 3000 THEN 10 WHEN tile_count < 5 THEN -20 ELSE 0 END + CASE WHEN has_laz THEN 5 ELSE 0 END + least(on_disk_count, 25)
   + CASE WHEN bbox_percent >= 95 THEN 8 WHEN bbox_percent = 0 THEN -15 ELSE 0 END - CASE WHEN len(list_filter(dates, lambda d: starts_with(d, '1899'))) > 0 THEN 40 ELSE 0 END AS score FROM y)"""


def files(spark, sf_dir):
    p, size = read(spark, sf_dir, "part"), F.col("p_size")
    name = F.concat(F.lit("USGS_LPC_MI_"), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("_"), (2000 + size % 20).cast("string"), F.lit("_A"), (size % 3).cast("string"), F.lit("_"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.when(size % 2 == 0, ".laz").otherwise(".las"))
    date = F.when(F.col("p_partkey") % 977 == 3, "1899-12-30").otherwise(F.concat((2001 + size % 15).cast("string"), F.lit("-05-01")))
    return p.select("p_partkey", name.alias("filename"), (size.cast("long") * 1000).alias("size_bytes"), date.alias("publication_date"), (size > 2).alias("has_box"), (F.col("p_partkey") % 50 == 0).alias("on_disk"), F.lit(None).cast("string").alias("title"))


@query(f"WITH {_FILES} SELECT p_partkey, campaign_group, detailed_prefix, 'MI_' || split_part(detailed_prefix, '_', 2) || '_' || split_part(detailed_prefix, '_', 3) || '_' || split_part(detailed_prefix, '_', 4) AS project FROM f")
def f3_f4_survey_names(spark, sf_dir):
    """campaign, prefix and project in file names."""
    c = S.campaign(F.col("filename"))
    return files(spark, sf_dir).select("p_partkey", c["campaign_group"].alias("campaign_group"), c["detailed_prefix"].alias("detailed_prefix"), S.project(F.col("filename")).alias("project"))


@query(f"WITH {_FILES}, {_GROUPS} SELECT campaign_group, tile_count, bytes, on_disk_count, has_laz, bbox_percent, n_prefixes, array_to_string(dates, ',') AS dates, array_to_string(samples, ',') AS samples FROM g")
def a13_campaigns(spark, sf_dir):
    g = C.rollup(files(spark, sf_dir))
    return g.select("campaign_group", "tile_count", "bytes", "on_disk_count", "has_laz", "bbox_percent", F.size("prefixes").cast("long").alias("n_prefixes"), F.array_join("dates", ",").alias("dates"), F.array_join("samples", ",").alias("samples"))


@query(f"WITH {_FILES}, {_GROUPS}, {_SCORES} SELECT campaign_group, CAST(score AS DOUBLE) AS score FROM s")
def a14_campaign_scores(spark, sf_dir):
    return C.scores(C.rollup(files(spark, sf_dir)), CITY).select("campaign_group", "score")


@query(f"WITH {_FILES}, {_GROUPS}, {_SCORES}, b AS (SELECT * FROM s ORDER BY score DESC, campaign_group LIMIT 1) SELECT (SELECT count(*) FROM s) AS n_campaigns, (SELECT CAST(sum(tile_count) AS BIGINT) FROM s) AS n_files, campaign_group AS recommended, 'review_campaign,download' AS steps, FALSE AS ready FROM b")
def a52_onboarding(spark, sf_dir):
    """What a new city lacks; the recommendation is a top-1 report."""
    r = C.readiness(C.scores(C.rollup(files(spark, sf_dir)), CITY), "MI_Other", True, True)
    return r.select("n_campaigns", "n_files", "recommended", F.array_join("steps", ",").alias("steps"), "ready")


@query(f"WITH {_FILES} SELECT detailed_prefix AS project, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(count_if(on_disk) AS BIGINT) AS n_selected, CAST(coalesce(sum(CASE WHEN on_disk THEN size_bytes END), 0) AS BIGINT) AS bytes_selected FROM f GROUP BY 1")
def a15_projects(spark, sf_dir):
    return C.projects(files(spark, sf_dir), F.col("on_disk"))


_KIND = {"src1": "open_county", "src2": "osm", "src3": "microsoft_ml"}
_P14 = "CASE source WHEN 'src1' THEN 'open_county_footprint' WHEN 'src2' THEN 'osm_footprint' ELSE 'unknown_unsafe_source' END"


@query(f"SELECT doc_id, {_P14} AS provenance FROM documents")
def p14_provenance_labels(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.provenance_class(S.lookup(F.col("source"), _KIND, "other")).alias("provenance"))


_CITY = """c AS (SELECT o_orderkey, o_custkey % 5 AS raw, o_orderkey % 7 > 0 AS mok, o_custkey % 4 AS man, o_custkey % 3 + 1 AS dirs, o_custkey % 3 + CAST(o_orderkey % 3 > 0 AS INTEGER) AS done,
    CASE o_orderkey % 5 WHEN 0 THEN 'microsoft_ml' WHEN 1 THEN 'osm' ELSE 'open_county' END AS kind, CASE o_custkey % 4 WHEN 0 THEN 'odc_unconfirmed' ELSE 'odc' END AS lic, o_custkey % 2 = 0 AS allowed, CAST(o_orderkey % 6 = 0 AS INTEGER) AS miss,
    o_orderkey % 11 > 0 AS mesh, CAST(o_orderkey % 8 = 0 AS INTEGER) AS stale, CAST(o_custkey % 9 = 0 AS INTEGER) AS unproven, o_orderkey % 4 > 0 AS manifest FROM orders)"""


@query(f"""WITH {_CITY} SELECT o_orderkey, CASE WHEN raw = 0 AND dirs = 0 AND NOT mok THEN 'not_started' WHEN raw > 0 AND dirs = 0 AND NOT mok THEN 'raw_data_ready' WHEN dirs < (CASE WHEN man > 0 THEN man ELSE dirs END) OR done < dirs THEN 'processed_partial'
  WHEN kind = 'microsoft_ml' THEN 'blocked_unsafe_source' WHEN lic = 'odc_unconfirmed' THEN 'blocked_license' WHEN miss > 0 THEN 'blocked_missing_outputs' WHEN dirs = 0 THEN 'raw_data_ready' WHEN NOT mesh THEN 'processed_complete' WHEN stale > 0 THEN 'blocked_stale_glb'
  WHEN unproven > 0 THEN 'blocked_missing_provenance' WHEN allowed AND manifest THEN 'production_ready' WHEN manifest THEN 'viewer_ready' ELSE 'processed_complete' END AS status,
  CASE WHEN kind = 'microsoft_ml' THEN 'HIGH' WHEN lic = 'odc_unconfirmed' THEN 'MEDIUM' ELSE 'LOW' END AS risk,
  CAST(kind = 'microsoft_ml' AS INTEGER) + CAST(lic = 'odc_unconfirmed' AS INTEGER) + CAST(NOT allowed AS INTEGER) AS n_errors FROM c""")
def a18_city_status(spark, sf_dir):
    """Status, legal risk and production errors of cities."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.when(k % 5 == 0, "microsoft_ml").when(k % 5 == 1, "osm").otherwise("open_county")
    errors = A.production_errors(kind, F.when(c % 4 == 0, "odc_unconfirmed").otherwise("odc"), c % 2 == 0)
    o = read(spark, sf_dir, "orders").withColumn("errors", errors)
    zero = F.lit(0)
    fields = {
        "n_raw": c % 5, "manifest_ok": k % 7 > 0, "n_manifest": c % 4, "n_dirs": c % 3 + 1, "n_processed": c % 3 + (k % 3 > 0).cast("int"), "errors": F.col("errors"), "n_unsafe": zero, "n_missing": (k % 6 == 0).cast("int"),
        "has_mesh": k % 11 > 0, "n_orphaned": zero, "n_stale": (k % 8 == 0).cast("int"), "n_unproven": (c % 9 == 0).cast("int"), "has_manifest": k % 4 > 0,
    }
    return o.select("o_orderkey", A.city_status(fields).alias("status"), A.legal_risk(F.col("errors"), zero).alias("risk"), F.size("errors").alias("n_errors"))


@query("""WITH t AS (SELECT c_nationkey AS city_id, CASE WHEN c_custkey % 40 = 0 THEN 1 ELSE 0 END AS x, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 9 END AS n0 FROM customer),
g AS (SELECT city_id, count(*) AS tiles_attempted, CAST(count_if(x = 0) AS BIGINT) AS tiles_ok, CAST(sum(coalesce(n0, 0)) AS BIGINT) AS buildings_lod0, bool_and(x = 0) AS all_tiles_passed FROM t GROUP BY 1)
SELECT *, CASE WHEN city_id % 6 = 0 THEN 'missing_address_source' WHEN buildings_lod0 = 0 THEN 'no_structures' WHEN city_id % 5 = 0 THEN 'no_address_matches' ELSE 'complete' END AS package FROM g""")
def a17_city_packages(spark, sf_dir):
    k = F.col("c_custkey")
    t = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("city_id"), k.alias("tile_id"), F.when(k % 40 == 0, 1).otherwise(0).alias("exit_code"), F.when(k % 5 > 0, k % 9).alias("lod0"), F.lit(0).alias("lod1"), F.lit(0).alias("n_clusters"))
    g = A.city_totals(t).drop("buildings_lod1", "clusters")
    return g.withColumn("package", A.package_status(F.col("city_id") % 6 != 0, F.col("buildings_lod0"), F.col("city_id") % 5))


@query("""SELECT c, count(*) AS n FROM (SELECT CASE WHEN p_size % 4 > 0 AND p_size % 3 > 0 THEN 'ok' WHEN p_partkey % 7 = 0 THEN 's03_fail' WHEN p_partkey % 5 = 0 THEN 's04_error' WHEN p_partkey % 6 = 0 THEN 's01_error' WHEN p_size % 2 = 0 AND p_partkey % 4 = 0 THEN 'no_footprints' WHEN p_size % 5 = 0 THEN 's04_skipped' ELSE 'unknown' END AS c FROM part) GROUP BY 1""")
def a42_tile_categories(spark, sf_dir):
    s, k = F.col("p_size"), F.col("p_partkey")
    fields = {
        "has_lod0": s % 4 > 0, "has_lod1": s % 3 > 0, "s03_ok": k % 7 != 0, "s04_error": F.when(k % 5 == 0, "x"), "s01_error": F.when(k % 6 == 0, "x"), "terrain_only": s % 2 == 0, "n_footprints": k % 4,
        "s04_status": F.when(s % 5 == 0, "skipped: none").otherwise("done"),
    }
    return read(spark, sf_dir, "part").groupBy(A.tile_category(fields).alias("c")).agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT a.cluster_id AS objectid, b.cluster_id, round((least(a.cx + a.hw, b.cx + b.hw) - greatest(a.cx - a.hw, b.cx - b.hw)) * (least(a.cy + a.hh, b.cy + b.hh) - greatest(a.cy - a.hh, b.cy - b.hh)), 6) AS area
  FROM footprints a JOIN footprints b ON a.cluster_id % 2 = 1 AND b.cluster_id % 2 = 0 AND abs(a.cx - b.cx) < a.hw + b.hw AND abs(a.cy - b.cy) < a.hh + b.hh),
r AS (SELECT *, row_number() OVER (PARTITION BY objectid ORDER BY area DESC, cluster_id) AS k, count(*) OVER (PARTITION BY objectid) AS c FROM o WHERE area > 1e-6)
SELECT count(*) AS n_rows, CAST(count_if(k = 1) AS BIGINT) AS n_primary, CAST(count_if(k > 1) AS BIGINT) AS n_secondary, count(DISTINCT CASE WHEN c > 1 THEN objectid END) AS n_ambiguous,
  (SELECT count(*) FROM footprints WHERE cluster_id % 2 = 1) - count(DISTINCT objectid) AS n_unassigned, 0 AS n_problems FROM r""")
def a30_association_summary(spark, sf_dir):
    """Counts of associations, and five sums that must agree."""
    f = footprints(spark, sf_dir)
    a = f.where("cluster_id % 2 = 1").select(F.col("cluster_id").alias("objectid"), F.col("ring").alias("left_ring"))
    b = f.where("cluster_id % 2 = 0").select("cluster_id", F.col("ring").alias("right_ring"))
    best = X.primary_overlaps(a, b, "objectid", "cluster_id", "left_ring", "right_ring")
    if best is None:
        o = J.polygon_overlay(a, b, "objectid", "cluster_id", "left_ring", "right_ring").where("shared > 1e-6").select("objectid", "cluster_id", F.round("shared", 6).alias("area"))
        s = A.association_summary(K.primary_assignments(o), b, a)
    else:
        s = A.association_summary_of_objects(cut(best, "associations"), b, a)
    return s.select("n_rows", "n_primary", "n_secondary", "n_ambiguous", "n_unassigned", F.size("problems").alias("n_problems"))
