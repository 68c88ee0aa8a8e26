"""Queries on evidence of runs, contracts and social state."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import audit as A
from cadastra.operators import runs as R

from .derived import footprints, points, read, tiles
from .registry import query


@query("""WITH l AS (SELECT event_id, '$.' || k AS path, CAST(json_extract_string(props, '$.' || k) AS VARCHAR) AS v FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)), a AS (SELECT * FROM l WHERE event_id % 9 > 0),
b AS (SELECT event_id, path, CASE WHEN event_id % 5 = 0 THEN 'x' WHEN event_id % 7 = 0 THEN CAST(TRY_CAST(v AS DOUBLE) + 0.5 AS VARCHAR) ELSE v END AS v FROM l WHERE event_id % 8 > 0),
s AS (SELECT coalesce(a.event_id, b.event_id) AS event_id, coalesce(a.path, b.path) AS path, CASE WHEN b.event_id IS NULL THEN 'only_a' WHEN a.event_id IS NULL THEN 'only_b' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'same' WHEN abs(TRY_CAST(a.v AS DOUBLE) - TRY_CAST(b.v AS DOUBLE)) <= 0.5 THEN 'within' ELSE 'differs' END AS status FROM a FULL JOIN b ON a.event_id = b.event_id AND a.path = b.path)
SELECT * FROM s WHERE status <> 'same'""")
def c22_document_comparison(spark, sf_dir):
    """Leaves of two versions of JSON documents, with tolerances by path."""
    leaves = A.json_leaves(read(spark, sf_dir, "events").select("event_id", "props"), "event_id", "props", 1)
    k, v = F.col("event_id"), F.col("value")
    other = F.when(k % 5 == 0, "x").when(k % 7 == 0, (v.try_cast("double") + 0.5).cast("string")).otherwise(v)
    return R.compare_leaves(leaves.where("event_id % 9 > 0"), leaves.where("event_id % 8 > 0").withColumn("value", other), "event_id", ["generated_at"], [(r"^\$\.", 0.5)])


@query("SELECT CAST(count_if(tile_id = '0_0') AS BIGINT) AS only_a, CAST(count_if(tile_id = '1_1') AS BIGINT) AS only_b, CAST(count_if(tile_id = '2_2') AS BIGINT) AS sources_differ, TRUE AS same_runtime, FALSE AS same_commit, FALSE AS comparable FROM tiles")
def c24_run_identity(spark, sf_dir):
    t = tiles(spark, sf_dir).select("tile_id", F.sha2("tile_id", 256).alias("source_sha256"), F.lit("spark").alias("runtime"), F.lit("a1").alias("commit"))
    b = t.where("tile_id != '0_0'").withColumns({"source_sha256": F.when(F.col("tile_id") == "2_2", "other").otherwise(F.col("source_sha256")), "commit": F.lit("b2")})
    return R.compare_identity(t.where("tile_id != '1_1'"), b)


def _run(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    name = F.when(k % 101 == 0, "/home/x.json").when(k % 103 == 0, F.concat(F.lit("notes/"), k.cast("string"))).otherwise(F.concat(F.lit("tiles/"), k.cast("string"), F.lit(".json")))
    files = read(spark, sf_dir, "part").select(name.alias("path"), s.alias("size_bytes"), F.lit("").alias("sha256"))
    expected = spark.createDataFrame([("^tiles/", "required")], "pattern string, standing string")
    m = read(spark, sf_dir, "part").select(k.alias("tile_id"), F.when(k % 31 == 0, "{").otherwise("{}").alias("contract"), (k % 37 == 0).alias("production"), F.when(k % 41 == 0, "../x").when(k % 43 == 0, "/x").otherwise("x").alias("path"))
    return R.run_inventory(files, expected, r"\.pem$"), m.where("tile_id % 29 > 0").unionByName(m.where("tile_id = 1")), m.where("tile_id % 17 > 0").select("tile_id")


@query("""SELECT code, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 101 = 0 THEN 'prohibited_file' WHEN p_partkey % 103 = 0 THEN 'unexpected_file' END AS code FROM part UNION ALL SELECT * FROM (VALUES ('required_file_missing'), ('tile_duplicate')) UNION ALL
 SELECT 'tile_unauthorized' FROM part WHERE p_partkey % 29 > 0 AND p_partkey % 17 = 0 UNION ALL SELECT 'tile_missing' FROM part WHERE p_partkey % 29 = 0 AND p_partkey % 17 > 0 UNION ALL SELECT 'contract_unparsable' FROM part WHERE p_partkey % 31 = 0 AND p_partkey % 29 > 0
 UNION ALL SELECT 'production_flag_set' FROM part WHERE p_partkey % 37 = 0 AND p_partkey % 29 > 0 UNION ALL SELECT 'path_traversal' FROM part WHERE p_partkey % 41 = 0 AND p_partkey % 29 > 0 UNION ALL SELECT 'local_path' FROM part WHERE p_partkey % 43 = 0 AND p_partkey % 41 > 0 AND p_partkey % 29 > 0) WHERE code IS NOT NULL GROUP BY 1""")
def q13_run_findings(spark, sf_dir):
    """A run's inventory and manifest against what was authorized."""
    inventory, manifest, authorized = _run(spark, sf_dir)
    return R.run_findings(inventory, manifest, authorized, ["^tiles/", "^manifest.json$"]).groupBy("code").agg(F.count("*").alias("n"))


@query("SELECT 'FAIL' AS verdict, CAST(count_if(p_partkey % 103 = 0 AND p_partkey % 101 > 0) + count_if(p_partkey % 43 = 0 AND p_partkey % 41 > 0 AND p_partkey % 29 > 0) AS BIGINT) AS non_blocking FROM part")
def q13_run_verdict(spark, sf_dir):
    inventory, manifest, authorized = _run(spark, sf_dir)
    return R.verdict(R.run_findings(inventory, manifest, authorized, ["^tiles/", "^manifest.json$"])).select("verdict", "non_blocking")


@query("""SELECT p_partkey, concat_ws(',', CASE WHEN p_size % 4 = 0 THEN 'no_unit' WHEN p_size % 4 = 3 THEN 'unknown_unit' END, CASE WHEN p_partkey % 5 = 0 THEN 'no_crs' WHEN p_partkey % 5 = 1 THEN 'wrong_crs' END, CASE WHEN p_partkey % 3 = 0 THEN 'no_factor' END,
  CASE WHEN p_size % 4 = 1 AND p_partkey % 3 = 1 THEN 'wrong_factor' END, CASE WHEN p_size % 4 = 2 AND p_partkey % 3 = 2 THEN 'converted_twice' END, CASE WHEN p_partkey % 7 = 0 THEN 'no_version' END) AS problems, TRUE AS mixed_units FROM part""")
def q5_q19_contracts(spark, sf_dir):
    """Source contracts of tiles, and units that don't agree."""
    k, s = F.col("p_partkey"), F.col("p_size")
    unit = F.element_at(F.array(*map(F.lit, ("Unknown", "US survey foot", "metre", "cubit"))), (s % 4 + 1).cast("int"))
    t = read(spark, sf_dir, "part").select(
        k.alias("tile_id"), unit.alias("unit"), F.when(k % 5 == 0, "").when(k % 5 == 1, "EPSG:9").otherwise("epsg:2236").alias("crs"), F.when(k % 3 == 1, 1.0).when(k % 3 == 2, 0.3048006096012192).alias("factor"), F.when(k % 7 > 0, "v1").alias("version")
    )
    return R.contract_problems(t, "EPSG:2236", 0.3048006096012192).select(F.col("tile_id").alias("p_partkey"), F.array_join("problems", ",").alias("problems"), "mixed_units")


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 4 = 0 THEN 'no_city_id' END, CASE WHEN c_custkey % 6 = 0 THEN 'inverted_bbox' END) AS errors, CASE WHEN c_custkey % 3 = 0 THEN 'no_license' WHEN c_custkey % 5 = 0 THEN 'license_unconfirmed' ELSE '' END AS warnings FROM customer""")
def q6_configs(spark, sf_dir):
    k = F.col("c_custkey")
    box = F.struct(F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.when(k % 6 == 0, -1.0).otherwise(1.0).alias("xmax"), F.lit(1.0).alias("ymax"))
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 > 0, F.col("c_name")).alias("city_id"), box.alias("bbox"), F.when(k % 3 == 0, "").when(k % 5 == 0, "cc0_unconfirmed").otherwise("cc0").alias("license"))
    out = R.config_problems(c, ["city_id"])
    return out.select("c_custkey", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_custkey % 10 = 0 THEN 'orphaned' WHEN o_orderkey % 1000 < o_custkey % 10 * 50 THEN 'stale' ELSE 'current' END AS status FROM orders) GROUP BY 1")
def q7_stale_artefacts(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    files = o.select(F.col("o_orderkey").alias("path"), (F.col("o_custkey") % 10).alias("tile_id"), F.lit("glb").alias("kind"), (F.col("o_orderkey") % 1000).alias("modified"))
    manifests = o.select((F.col("o_custkey") % 10).alias("tile_id")).where("tile_id > 0").distinct().withColumn("generated", F.col("tile_id") * 50)
    return R.stale_artefacts(files, manifests).groupBy("status").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT tile_id, count(*) AS n, quantile_cont(z, 0.99) AS q, count_if(z BETWEEN 5 AND 28) AS ok, max(x) AS hx FROM points WHERE tile_id <> '3_3' GROUP BY 1)
SELECT t.tile_id, coalesce(n, 0) AS n, round(q, 6) AS z_high, concat_ws(',', CASE WHEN n IS NULL THEN 'no_points' END, CASE WHEN hx - (xmax - CASE WHEN t.tile_id = '1_1' THEN 50 ELSE 0 END) > 1 THEN 'out_of_bounds' END, CASE WHEN 2 * ok < n THEN 'implausible_z' END) AS reject FROM tiles t LEFT JOIN p USING (tile_id)""")
def q9_tile_gate(spark, sf_dir):
    t = tiles(spark, sf_dir).withColumn("xmax", F.col("xmax") - F.when(F.col("tile_id") == "1_1", 50.0).otherwise(0.0))
    out = R.tile_gate(points(spark, sf_dir).where("tile_id != '3_3'"), t, 5.0, 28.0)
    return out.select("tile_id", "n", F.round("z_high", 6).alias("z_high"), F.array_join("reject", ",").alias("reject"))


@query("""SELECT cluster_id, concat_ws(',', CASE WHEN p_size % 2 = 0 THEN 'not_supported' END, CASE WHEN p_size < 30 THEN 'coverage' END, CASE WHEN p_size % 5 = 0 THEN 'rmse' END, CASE WHEN p_size % 3 = 0 THEN 'confidence' END) AS reject FROM footprints""")
def q17_roof_eligibility(spark, sf_dir):
    s = F.col("p_size")
    f = footprints(spark, sf_dir).select("cluster_id", F.when(s % 2 == 0, "classification_only").otherwise("reconstruction_supported").alias("outcome"), (s / 50.0).alias("coverage"), F.when(s % 5 == 0, 0.5).otherwise(0.1).alias("rmse"), F.when(s % 3 > 0, 0.7).alias("confidence"), F.size("ring").alias("n_corners"))
    return f.select("cluster_id", F.array_join(R.roof_eligibility(f), ",").alias("reject"))


_POSTS = "p AS (SELECT event_id AS id, user_id, event_id % 40 AS s, event_id % 6 AS t, (['public', 'unlisted', 'private'])[event_id % 3 + 1] AS vis, ts FROM events)"


@query(f"WITH {_POSTS}, a AS (SELECT 'post' AS kind, id FROM p WHERE (vis <> 'private' OR user_id = 7) AND (s = 5 OR t = 2) ORDER BY ts DESC, id DESC LIMIT 50), b AS (SELECT 'claim' AS kind, id FROM p WHERE s = 5 ORDER BY ts DESC, id DESC LIMIT 25) SELECT * FROM a UNION ALL SELECT * FROM b")
def j34_social_state(spark, sf_dir):
    """The latest 50 posts and 25 claim events of a place (limits of the report)."""
    k = F.col("event_id")
    p = read(spark, sf_dir, "events").select(k.alias("id"), "user_id", (k % 40).alias("structure_id"), (k % 6).alias("tile_id"), F.element_at(F.array(*map(F.lit, ("public", "unlisted", "private"))), (k % 3 + 1).cast("int")).alias("visibility"), F.col("ts").alias("created_at"))
    posts, history = R.social_state(p, p, 7, 5, 2)
    return posts.select(F.lit("post").alias("kind"), "id").unionByName(history.select(F.lit("claim").alias("kind"), "id"))


@query("SELECT o_orderkey AS structure_id FROM orders WHERE o_custkey % 50 = 3")
def j35_owned(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("structure_id"), (F.col("o_custkey") % 50).alias("claimed_by"), F.col("o_orderdate").alias("claimed_at"))
    return R.owned_by(o, 3).select("structure_id")
