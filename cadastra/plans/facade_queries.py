"""Queries on materials and facades."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import facades as FA
from cadastra.operators import materials as M

from .derived import footprints, read
from .registry import query

_CLUES = """k AS (SELECT o_orderkey AS i, CAST(o_orderkey AS VARCHAR) AS clue_id, o_custkey AS b, o_orderkey % 8 AS m, (o_orderkey % 53 + 1) / CAST(53.7 AS DOUBLE) AS c, CASE WHEN o_orderkey % 8 = 7 AND o_orderkey % 3 = 0 THEN 'unknown' ELSE 'observed' END AS st, ((o_orderkey // 8) % 11) / 10.0 AS ratio FROM orders),
b AS (SELECT c_custkey AS b, c_mktsegment = 'BUILDING' AS home, c_custkey % 60 AS h, c_custkey % 6 + 1 AS fl, c_custkey % 7 = 0 AS st, c_custkey % 4 > 0 AS known FROM customer),
w AS (SELECT b, bool_or(m IN (1, 2)) AS weak, min_by(c, (-c, clue_id)) FILTER (m = 4) AS shape, max(c) FILTER (m = 5) AS sheet FROM k GROUP BY 1),
p AS (SELECT b, 'envelope' AS s, 'brick' AS mat, 0.95 * c AS score, 2 AS rk FROM k WHERE m = 0 UNION ALL SELECT b, 'envelope', 'generic_masonry', 0.95 * c * 0.18, 1 FROM k WHERE m = 0
  UNION ALL SELECT b, 'envelope', 'stucco', 0.28 * c, 1 FROM k WHERE m = 1 UNION ALL SELECT b, 'envelope', 'painted_concrete', 0.28 * 0.72 * c, 1 FROM k WHERE m = 1
  UNION ALL SELECT b, 'envelope', 'stucco', 0.18 * c, 1 FROM k WHERE m = 2 UNION ALL SELECT b, 'envelope', 'painted_concrete', 0.18 * 0.9 * c, 1 FROM k WHERE m = 2
  UNION ALL SELECT b, 'roof', 'membrane', 0.95 * c, 2 FROM k WHERE m = 3 UNION ALL SELECT b, 'envelope', 'stone', 0.98 * c, 3 FROM k WHERE m = 7 AND st = 'observed'
  UNION ALL SELECT b, 'glazing', CASE WHEN ratio >= 0.75 THEN 'curtain_wall' WHEN ratio >= 0.5 THEN 'high' WHEN ratio >= 0.2 THEN 'moderate' ELSE 'low' END, c * CASE WHEN ratio >= 0.75 THEN 0.72 WHEN ratio >= 0.5 THEN 0.68 ELSE 0.65 END, 1 FROM k WHERE m = 6 AND ratio <= 1
  UNION ALL SELECT b, 'glazing', CASE WHEN ratio >= 0.75 THEN 'high' WHEN ratio >= 0.5 THEN 'curtain_wall' WHEN ratio >= 0.2 THEN 'low' ELSE 'moderate' END, 0.3 * c * CASE WHEN ratio >= 0.75 THEN 0.72 WHEN ratio >= 0.5 THEN 0.68 ELSE 0.65 END, 1 FROM k WHERE m = 6 AND ratio <= 1
  UNION ALL SELECT b, 'envelope', 'stucco', 0.95 * 0.8, 2 FROM b WHERE st AND known UNION ALL SELECT b, 'envelope', 'stucco', 0.16 * 0.8, 1 FROM b JOIN w USING (b) WHERE weak AND known AND home AND fl <= 4
  UNION ALL SELECT b, 'roof', x.mat, x.f * 0.42 * least(shape, 0.8, sheet), 1 FROM b JOIN w USING (b), (VALUES ('membrane', 1.0), ('gravel', 0.5), ('concrete', 0.4)) x(mat, f) WHERE known AND h >= 30 AND shape IS NOT NULL AND sheet IS NOT NULL),
g AS (SELECT b, s, mat, min(rk) AS rk, max(least(score, 0.99)) AS top, sum(least(score, 0.99)) AS total FROM p GROUP BY 1, 2, 3),
q AS (SELECT b, s, mat, rk, round(CASE WHEN rk = 1 THEN least(0.75, t) ELSE t END, 4) AS confidence FROM (SELECT *, least(0.99, top + 0.2 * (1 - top) * (total - top)) AS t FROM g))"""


def clues(spark, sf_dir):
    i = F.col("o_orderkey")
    kinds = [
        ("envelope", "material", "brick veneer", "municipal_record"), ("envelope", "surface_finish", "Smooth  finish", "aerial_imagery"), ("envelope", "color_character", "light_neutral", "aerial_imagery"), ("roof", "roof_material", "built up", "building_inventory"),
        ("roof", "roof_geometry", "flat", "lidar"), ("roof", "roof_surface_character", "continuous", "aerial_imagery"), ("glazing", "glazing_ratio", "", "street_view"), ("envelope", "material", "stone", "street_view"),
    ]
    pick = lambda k: F.element_at(F.array(*(F.lit(x[k]) for x in kinds)), (i % 8 + 1).cast("int"))
    value = F.when(i % 8 == 6, (F.expr("(o_orderkey div 8) % 11") * 10).cast("string")).otherwise(pick(2))
    status = F.when((i % 8 == 7) & (i % 3 == 0), "unknown").otherwise("observed")
    return read(spark, sf_dir, "orders").select(i.cast("string").alias("clue_id"), F.col("o_custkey").alias("building_id"), pick(0).alias("surface_type"), pick(1).alias("observation_type"), value.alias("value"), F.lit("percent").alias("unit"), pick(3).alias("source_type"), ((i % 53 + 1) / 53.7).alias("confidence"), status.alias("provenance_status"))


def buildings(spark, sf_dir):
    k = F.col("c_custkey")
    known = F.when(k % 4 > 0, F.struct(F.lit("municipal_record").alias("source_type"), F.lit("observed").alias("provenance_status"), F.lit(0.8).alias("confidence")))
    return read(spark, sf_dir, "customer").select(
        k.alias("building_id"), F.when(F.col("c_mktsegment") == "BUILDING", "Residential").otherwise("office").alias("building_use"), (k % 60).cast("double").alias("height_m"), (k % 6 + 1).cast("int").alias("floors_est"), F.lit(None).cast("string").alias("roof_geometry_class"),
        F.when(k % 7 == 0, "stucco finish").alias("municipal_construction_type"), F.lit(None).cast("string").alias("municipal_roof_type"), known.alias("metadata_provenance"),
    )


@query(f"WITH {_CLUES} SELECT b AS building_id, s AS surface_type, mat AS material, CAST(confidence AS DOUBLE) AS confidence, (['inferred', 'record_derived', 'observed'])[rk] AS status, CAST(row_number() OVER (PARTITION BY b, s ORDER BY confidence DESC, mat) AS INTEGER) AS rank, CAST(count(*) OVER (PARTITION BY b, s) - 1 AS INTEGER) AS n_alternatives FROM q")
def m8_material_candidates(spark, sf_dir):
    """Materials from clues, records, finishes, roofs and glazing, combined and ranked."""
    out = M.candidates(M.contributions(clues(spark, sf_dir), buildings(spark, sf_dir)))
    return out.select("building_id", "surface_type", "material", "confidence", "status", "rank", F.size("alternatives").alias("n_alternatives"))


@query("""WITH n AS (SELECT o_custkey AS b, count(*) AS n, min(CAST(o_orderkey AS VARCHAR)) AS lo FROM orders GROUP BY 1), m AS (SELECT c_custkey AS b, 3 + CAST(c_custkey % 7 = 0 AS INTEGER) AS n FROM customer WHERE c_custkey % 4 > 0)
SELECT coalesce(n.b, m.b) AS building_id, coalesce(n.n, 0) + coalesce(m.n, 0) AS n, coalesce(lo, 'building_metadata:building_use') AS first FROM n FULL JOIN m ON n.b = m.b""")
def m9_evidence_lists(spark, sf_dir):
    e = M.evidence_list(clues(spark, sf_dir), buildings(spark, sf_dir), ("building_use", "floors_est", "height_m", "municipal_construction_type"))
    return e.select("building_id", F.size("evidence").cast("long").alias("n"), F.col("evidence")[0]["evidence_id"].alias("first"))


def records(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    use = F.element_at(F.array(*map(F.lit, ("Hotel", "office", "Mixed_Use", "parking", "warehouse", "residential", "industrial", "civic", "farm"))), (k % 9 + 1).cast("int"))
    source = F.struct((s / 50.0).alias("confidence"), F.when(k % 10 == 3, "unknown").otherwise("observed").alias("provenance_status"))
    # Every fifth building has a second record with another use.
    p = read(spark, sf_dir, "part").withColumn("second", F.explode(F.when(k % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return p.select(k.alias("building_id"), F.when(F.col("second") == 1, "civic").otherwise(use).alias("building_use"), F.when(s % 2 == 0, s).alias("floor_count"), F.when(s % 3 == 0, F.lit(2)).alias("podium_levels"), F.create_map(F.lit("building_use"), source, F.lit("floor_count"), source).alias("field_provenance"), "second")


_USE = "(['hotel', 'office', 'mixed_use', 'parking', 'warehouse', 'residential', 'industrial', 'civic', 'farm'])[p_partkey % 9 + 1]"


@query("""SELECT p_partkey AS building_id, f AS evidence_id, CASE WHEN f = 'building_metadata:floor_count' THEN 'floors' END AS unit, count(*) AS n FROM part, (SELECT unnest(['building_metadata:building_use', 'building_metadata:floor_count']) AS f), (SELECT unnest([0, 1]) AS second)
WHERE (second = 0 OR p_partkey % 5 = 0) AND (f = 'building_metadata:building_use' OR p_size % 2 = 0) GROUP BY 1, 2, 3""")
def m10_metadata_evidence(spark, sf_dir):
    e = FA.metadata_evidence(records(spark, sf_dir))
    return e.groupBy("building_id", "evidence_id", "unit").agg(F.count("*").alias("n"))


@query(f"""WITH u AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 10 <> 3 THEN {_USE} END AS u, p_partkey % 5 = 0 AS two, CASE WHEN p_size % 4 = 0 THEN 'high' END AS gl FROM part),
n AS (SELECT *, CASE WHEN u = 'farm' OR u IS NULL THEN NULL ELSE u END AS a, two AND u IS NOT NULL AS more FROM u),
t AS (SELECT *, CASE WHEN more AND (a IS NULL OR a = 'civic') THEN 'civic' WHEN NOT more THEN a END AS one, more AND a IS NOT NULL AND a <> 'civic' AS conflict FROM n)
SELECT p_partkey AS building_id, conflict, CASE WHEN conflict OR one IS NULL THEN 'unknown' WHEN one = 'hotel' THEN CASE WHEN p_size % 2 = 0 THEN 'hotel_bay_rhythm' ELSE 'unknown' END WHEN one = 'office' THEN CASE WHEN gl = 'high' THEN 'curtain_wall_candidate' ELSE 'office_grid' END
  WHEN one = 'mixed_use' THEN CASE WHEN p_size % 3 = 0 THEN 'mixed_use_podium_tower' ELSE 'unknown' END WHEN one = 'parking' THEN 'parking_structure_openings' WHEN one = 'warehouse' THEN 'warehouse_bays' WHEN one = 'residential' THEN 'repetitive_residential_bays'
  WHEN one = 'industrial' THEN 'industrial_panelized' ELSE 'civic_monumental' END AS typology FROM t""")
def m12_facade_typology(spark, sf_dir):
    """One use decides; different uses conflict."""
    return _typology(spark, sf_dir).select("building_id", "conflict", "typology")


def _typology(spark, sf_dir):
    r = records(spark, sf_dir)
    facts = r.where("second = 0").select("building_id", "floor_count", "podium_levels")
    glazing = facts.select("building_id").join(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("building_id"), F.when(F.col("p_size") % 4 == 0, "high").alias("glazing"), F.lit(0.7).alias("glazing_strength")), "building_id")
    return FA.typology(FA.metadata_evidence(r), facts, glazing)


@query(f"""WITH t AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 10 <> 3 THEN {_USE} END AS u FROM part WHERE p_partkey % 5 > 0), f AS (SELECT t.*, 2 * hw AS len, CAST(p_partkey % 60 + 3 AS DOUBLE) AS h, CASE WHEN t.p_size % 2 = 0 THEN t.p_size END AS fl FROM t JOIN footprints ON cluster_id = p_partkey),
g AS (SELECT *, CAST(coalesce(CASE WHEN fl > 0 THEN fl END, greatest(1, round_even(h / 3.2, 0))) AS INTEGER) AS floors, CASE u WHEN 'warehouse' THEN 8.0 WHEN 'parking' THEN 8.0 WHEN 'office' THEN CASE WHEN p_size % 4 = 0 THEN 1.5 ELSE 3.6 END ELSE 3.6 END AS target FROM f)
SELECT p_partkey AS building_id, floors, round(least(6.0, greatest(2.4, h / floors)), 6) AS floor_height, CAST(greatest(1, round_even(len / target, 0)) AS INTEGER) AS bays FROM g""")
def m13_recipes(spark, sf_dir):
    """Recipes by the registered grammar, from records and edges joined to buildings."""
    f = footprints(spark, sf_dir)
    edges = f.select(F.col("cluster_id").alias("building_id"), F.lit(0).alias("edge_id"), (2 * F.col("hw")).alias("length"))
    facts = records(spark, sf_dir).where("second = 0 AND building_id % 5 > 0").select("building_id", "floor_count", (F.col("building_id") % 60 + 3).cast("double").alias("height_m"))
    profiles, _ = FA.with_sidecars(facts.join(_typology(spark, sf_dir).select("building_id", "typology"), "building_id"), edges=edges)
    out = FA.recipes(profiles)
    return out.select("building_id", "floors", F.round("floor_height", 6).alias("floor_height"), F.col("edges")[0]["bays"].alias("bays"))


@query("""SELECT 'edges' AS sidecar, count(*) AS n FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'left', count(*) FROM part WHERE p_partkey % 2 = 1 AND p_partkey % 3 = 0 UNION ALL SELECT 'right', count(*) FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0""")
def j25_j27_missing_sides(spark, sf_dir):
    """Sidecar rows without a building, and keys that only one of two tables has."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("building_id"))
    _, orphans = FA.with_sidecars(p.where("building_id % 3 != 0"), edges=p.withColumn("x", F.lit(1)))
    _, missing = FA.paired(p.where("building_id % 2 = 0").withColumn("a", F.lit(1)), p.where("building_id % 3 = 0").withColumn("b", F.lit(1)), "building_id")
    return orphans.groupBy("sidecar").agg(F.count("*").alias("n")).unionByName(missing.groupBy(F.col("missing").alias("sidecar")).agg(F.count("*").alias("n")))


@query("""WITH e AS (SELECT cluster_id, 2 * hw AS dx, 2 * hh * (p_size % 3) AS dy, CASE p_size % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' WHEN 2 THEN 'left' END AS side, CASE WHEN p_size % 5 > 0 THEN 2.0 END AS g, CASE WHEN p_size % 7 = 0 THEN 0.0 ELSE p_size * 1.0 END AS h, 2 * hw * CASE WHEN p_size % 11 = 0 THEN 1.5 ELSE 1 END AS claim FROM footprints)
SELECT cluster_id, round(sqrt(dx * dx + dy * dy), 6) AS length, round(CASE side WHEN 'left' THEN dy WHEN 'right' THEN -dy END / sqrt(dx * dx + dy * dy), 6) + 0.0 AS nx,
  CASE WHEN side IS NULL THEN 'no_outward_normal' WHEN g IS NULL THEN 'no_ground' WHEN h <= 0 THEN 'no_height' WHEN abs(sqrt(dx * dx + dy * dy) - claim) > greatest(1e-4, 1e-5 * greatest(sqrt(dx * dx + dy * dy), claim)) THEN 'length_mismatch' END AS reject FROM e""")
def g28_edge_frames(spark, sf_dir):
    """Length, outward normal and vertical support of facade edges, and the first reason to reject one."""
    s, at = F.col("p_size"), lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    e = footprints(spark, sf_dir).select(
        "cluster_id", at(F.col("cx"), F.col("cy")).alias("start"), at(F.col("cx") + 2 * F.col("hw"), F.col("cy") + 2 * F.col("hh") * (s % 3)).alias("end"), F.when(s % 4 == 0, "left").when(s % 4 == 1, "right").when(s % 4 == 2, "left").alias("interior_side"),
        F.when(s % 5 > 0, 2.0).alias("ground_z"), F.lit(None).cast("double").alias("top_z"), F.when(s % 7 == 0, 0.0).otherwise(s * 1.0).alias("height_m"), (2 * F.col("hw") * F.when(s % 11 == 0, 1.5).otherwise(1.0)).alias("claimed_length"),
    )
    return FA.edge_frame(e).select("cluster_id", F.round("length", 6).alias("length"), (F.round("nx", 6) + 0.0).alias("nx"), "reject")
