"""Queries on enrichment, tile lists, viewer manifests and meshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import enrich as E
from cadastra.operators import tiles as T

from .clusters import cut
from .derived import addresses, footprints, points, read, tiles
from .registry import query

_NEAR = """b AS (SELECT cluster_id, CASE WHEN p_size <> 13 THEN cx END AS cx, cy, tile_id FROM footprints), a AS (SELECT * FROM addresses WHERE address_id % 2 = 0),
m AS (SELECT cluster_id, min_by(address_id, (d, address_id)) AS address_id, min(d) AS d FROM (SELECT cluster_id, address_id, sqrt((cx - rx) ** 2 + (cy - ry) ** 2) AS d FROM b JOIN a ON abs(cx - rx) <= 15 AND abs(cy - ry) <= 15) WHERE d <= 15 GROUP BY 1)"""


def _addressed(spark, sf_dir, dx=0.0, dy=0.0):
    f = footprints(spark, sf_dir).select("cluster_id", F.when(F.col("p_size") != 13, F.col("cx")).alias("cx"), "cy", "tile_id")
    a = addresses(spark, sf_dir).where("address_id % 2 = 0").withColumns({"house_number": F.col("address_id").cast("string"), "street": F.col("source")})
    return E.addressed(E.shifted(f, "cx", "cy", dx, dy), E.shifted(a, "rx", "ry", dx, dy), 15.0)


@query(f"WITH {_NEAR} SELECT cluster_id, address_id, CAST(address_id AS VARCHAR) AS house_number, round(d, 6) AS dist, CASE WHEN cx IS NULL THEN 'error' WHEN address_id IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status FROM b LEFT JOIN m USING (cluster_id)")
def j4_addressed(spark, sf_dir):
    return _addressed(spark, sf_dir).select("cluster_id", "address_id", "house_number", F.round("address_dist", 6).alias("dist"), "match_status")


@query(f"WITH {_NEAR} SELECT match_status, count(*) AS n FROM (SELECT CASE WHEN cx IS NULL THEN 'error' WHEN address_id IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status FROM b LEFT JOIN m USING (cluster_id)) GROUP BY 1")
def j5_addressed_locally(spark, sf_dir):
    """The same in the coordinates of a scene."""
    return _addressed(spark, sf_dir, 256.0, 512.0).groupBy("match_status").agg(F.count("*").alias("n"))


@query(f"""WITH {_NEAR}, t AS (SELECT address_id, count(*) AS n FROM m GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, address_id LIMIT 5)
SELECT (SELECT count(*) FROM b) AS n, count(*) AS n_matched, round(100.0 * count(*) / (SELECT count(*) FROM b), 4) AS percent, round(quantile_cont(d, 0.9), 6) AS p90, (SELECT string_agg(CAST(address_id AS VARCHAR), ',' ORDER BY n DESC, address_id) FROM t) AS repeated FROM m""")
def a38_match_report(spark, sf_dir):
    """Coverage, distances and addresses used more than once (a top-5 report)."""
    r = E.match_report(_addressed(spark, sf_dir), cut)
    return r.select("n", "n_matched", "percent", F.round(F.col("percentiles")[1], 6).alias("p90"), F.nullif(F.array_join(F.transform("repeated", lambda x: x["id"].cast("string")), ","), F.lit("")).alias("repeated"))


_LAYERS = """l AS (SELECT * FROM (VALUES ('AUTOMOBILE', 5.0), ('BUILDING', 10.0), ('FURNITURE', 20.0), ('HOUSEHOLD', 40.0), ('NONE', 3.0)) l(layer_id, radius)),
x AS (SELECT f.cluster_id, l.layer_id, min_by(address_id, (sqrt((cx - rx) ** 2 + (cy - ry) ** 2), address_id)) AS a FROM footprints f JOIN addresses a ON abs(cx - rx) <= 40 AND abs(cy - ry) <= 40 AND a.address_id % 3 = 0 JOIN l ON l.layer_id = a.source WHERE sqrt((cx - rx) ** 2 + (cy - ry) ** 2) <= radius GROUP BY 1, 2)"""


def _layers(spark, sf_dir):
    layers = spark.createDataFrame([("AUTOMOBILE", 5.0), ("BUILDING", 10.0), ("FURNITURE", 20.0), ("HOUSEHOLD", 40.0), ("NONE", 3.0)], "layer_id string, radius double")
    features = addresses(spark, sf_dir).where("address_id % 3 = 0").select(F.col("source").alias("layer_id"), F.col("address_id").alias("feature_id"), "rx", "ry", F.concat(F.lit("v"), (F.col("address_id") % 3).cast("string"), F.lit("_"), F.col("address_id").cast("string")).alias("value"))
    return layers, E.layer_matches(footprints(spark, sf_dir), features, layers, 40.0)


@query(f"WITH {_LAYERS} SELECT cluster_id, CAST(count(layer_id) AS INTEGER) AS n, max(CASE WHEN layer_id = 'BUILDING' THEN 'v0_' || CAST(a AS VARCHAR) END) AS portal_BUILDING, max(CASE WHEN layer_id = 'HOUSEHOLD' THEN 'v0_' || CAST(a AS VARCHAR) END) AS portal_HOUSEHOLD FROM footprints LEFT JOIN x USING (cluster_id) GROUP BY 1")
def j6_portal_layers(spark, sf_dir):
    """The nearest feature of each layer within its own radius, as an array and as columns."""
    _, m = _layers(spark, sf_dir)
    return E.with_layers(footprints(spark, sf_dir).select("cluster_id"), m, ["BUILDING", "HOUSEHOLD"]).select("cluster_id", F.size("enrichments").alias("n"), "portal_BUILDING", "portal_HOUSEHOLD")


@query(f"WITH {_LAYERS} SELECT l.layer_id, CAST(radius AS DOUBLE) AS radius, count(DISTINCT cluster_id) AS matched, (SELECT count(*) FROM footprints) - count(DISTINCT cluster_id) AS unmatched FROM l LEFT JOIN x USING (layer_id) GROUP BY 1, 2")
def a51_layer_report(spark, sf_dir):
    layers, m = _layers(spark, sf_dir)
    return E.layer_report(footprints(spark, sf_dir), m, layers).drop("percent")


@query("SELECT user_id AS cluster_id, event_type AS layer_id, max(event_id) AS seq FROM events GROUP BY 1, 2")
def w7_latest_of_layer(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("cluster_id"), F.col("event_type").alias("layer_id"), F.col("event_id").alias("seq"), "props")
    return E.latest_of_layer(e).drop("props")


@query("SELECT tile_id, 'found' AS kind FROM tiles WHERE substr(tile_id, 1, 1) IN ('0', '2') UNION ALL SELECT * FROM (VALUES ('9_9', 'missing'))")
def p12_requested_tiles(spark, sf_dir):
    t = tiles(spark, sf_dir).select("tile_id")
    wanted = t.where("substr(tile_id, 1, 1) in ('0', '2')").unionByName(t.limit(1).select(F.lit("9_9").alias("tile_id")))
    found, missing = E.requested(t, wanted)
    return found.select("tile_id", F.lit("found").alias("kind")).unionByName(missing.select("tile_id", F.lit("missing").alias("kind")))


@query("SELECT address_id FROM addresses WHERE rx BETWEEN 190 AND 410 AND ry BETWEEN 290 AND 510")
def s15_in_box(spark, sf_dir):
    """Addresses in a box with a margin."""
    return E.in_box(addresses(spark, sf_dir), (200.0, 300.0, 400.0, 500.0), 10.0, "rx", "ry").select("address_id")


@query("SELECT cluster_id, CAST(row_number() OVER (ORDER BY round(area_m2 / p_retailprice, 9), hw DESC, cluster_id) AS INTEGER) AS rank FROM footprints ORDER BY 2 LIMIT 10")
def w2_worst_ten(spark, sf_dir):
    """The ten worst (a report)."""
    f = footprints(spark, sf_dir).withColumn("iou", F.round(F.col("area_m2") / F.col("p_retailprice"), 9))
    return E.ranked_worst(f, [F.col("iou"), F.desc("hw"), F.col("cluster_id")]).select("cluster_id", "rank")


@query("""WITH t AS (SELECT tile_id, row_number() OVER (ORDER BY tile_id) - 1 AS i FROM tiles), s AS (SELECT tile_id, count(*) AS n FROM footprints GROUP BY 1), m AS (SELECT tile_id, count(*) AS n FROM points WHERE classification = 6 GROUP BY 1)
SELECT tile_id, substr(tile_id, 1, 1) <> '1' AS inferred, CASE WHEN substr(tile_id, 1, 1) = '1' THEN -5.0 ELSE (i % 10) * 1523.5 END AS xmin, greatest(coalesce(s.n, 0), coalesce(m.n, 0), CASE WHEN tile_id = '0_0' THEN 100000 ELSE 0 END) AS building_count FROM t LEFT JOIN s USING (tile_id) LEFT JOIN m USING (tile_id)""")
def j39_viewer_manifest(spark, sf_dir):
    """Tiles in order with their assets, counts and bounds."""
    t = tiles(spark, sf_dir).select("tile_id", F.when(F.col("tile_id") == "0_0", 100000).cast("long").alias("n_manifest"))
    assets = t.where("substr(tile_id, 1, 1) = '1'").select("tile_id", *(F.lit(v).alias(k) for k, v in (("xmin", -5.0), ("xmax", 5.0), ("zmin", -5.0), ("zmax", 5.0))))
    count = lambda d, name: d.groupBy("tile_id").agg(F.count("*").alias(name))
    out = T.viewer_manifest(t, assets, count(footprints(spark, sf_dir), "n_structures"), count(points(spark, sf_dir).where("classification = 6"), "n_masses"), cut)
    return out.select("tile_id", "inferred", "xmin", "building_count")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders) WHERE r % 7 = 0")
def o9_every_seventh(spark, sf_dir):
    """Every k-th row in order, numbered over ranges."""
    return T.every(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7, cut)


@query("""WITH a AS (SELECT o_orderkey AS k, 'main' AS tile_id, o_totalprice AS v FROM orders WHERE o_orderkey % 3 = 0), b AS (SELECT o_orderkey AS k, 'extra' AS tile_id, -o_totalprice AS v FROM orders WHERE o_orderkey % 2 = 0) SELECT * FROM a UNION ALL SELECT * FROM b WHERE k NOT IN (SELECT k FROM a)""")
def u3_primary_wins(spark, sf_dir):
    """Rows of several tiles with the tile's name, the primary one's first."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    return T.all_tiles({"main": o.where("k % 3 = 0"), "extra": o.where("k % 2 = 0").withColumn("v", -F.col("v"))}, {"main": 0, "extra": 1}, "k")


@query("SELECT 'USGS_' || p_brand || '.laz' AS filename, count(*) AS n, min('u' || lpad(CAST(p_partkey AS VARCHAR), 9, '0')) FILTER (p_size > 49) AS url, count_if(p_size > 49) > 0 AS resolved FROM part GROUP BY 1")
def j31_urls(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.concat(F.lit("USGS_"), "p_brand", F.lit(".laz")).alias("filename"), F.concat(F.lit("u"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("url"), "p_size")
    t = p.groupBy("filename").agg(F.count("*").alias("n"))
    return T.resolved_urls(t, p.where("p_size > 49"))


@query("""WITH c AS (SELECT cluster_id, cy - hh AS lo, cy + hh AS hi, p_size FROM footprints), x AS (SELECT cluster_id FROM c WHERE 400 BETWEEN lo AND hi ORDER BY p_size DESC, cluster_id LIMIT 1) SELECT cluster_id, TRUE AS crosses FROM x""")
def j38_crossing_cluster(spark, sf_dir):
    """The largest cluster across a seam (a top-1 report)."""
    c = footprints(spark, sf_dir).select("cluster_id", (F.col("cy") - F.col("hh")).alias("min_y"), (F.col("cy") + F.col("hh")).alias("max_y"), F.col("p_size").alias("point_count"), "cx", "cy")
    return T.crossing_cluster(c, 400.0, 500.0, 400.0)


@query("SELECT tile_id, abs((xmin + xmax) / 2 - 300) <= 300 AND abs((ymin + ymax) / 2 - 300) <= 300 AS ok FROM tiles")
def p7_near_city(spark, sf_dir):
    box = F.struct("xmin", "ymin", "xmax", "ymax")
    city = F.struct(F.lit(200.0).alias("xmin"), F.lit(200.0).alias("ymin"), F.lit(400.0).alias("xmax"), F.lit(400.0).alias("ymax"))
    return tiles(spark, sf_dir).select("tile_id", T.near_city(box, city, 300.0)["ok"].alias("ok"))


@query("""WITH c AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 3 > 0), d AS (SELECT p_partkey AS k, p_size * 1048576 AS s FROM part WHERE p_partkey % 4 > 0), i AS (SELECT p_partkey AS k, 0.5 AS mb FROM part WHERE p_partkey % 5 = 0)
SELECT 'f' || CAST(coalesce(c.k, d.k) AS VARCHAR) AS tile_id, d.k IS NOT NULL AS on_disk, c.k IS NOT NULL AS in_catalog, CAST(coalesce(mb, round(s / 1048576, 2)) AS DOUBLE) AS size_mb FROM c FULL JOIN d ON c.k = d.k LEFT JOIN i ON i.k = coalesce(c.k, d.k)""")
def j1_p19_manifest_rows(spark, sf_dir):
    """Catalog and disk in one manifest, sizes from the inventory first."""
    p = read(spark, sf_dir, "part").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string"), F.lit(".laz")).alias("filename"), "p_partkey", "p_size")
    catalog = p.where("p_partkey % 3 > 0").select("filename", F.lit(None).cast("string").alias("tile_id"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("box"))
    out = T.manifest_rows(catalog, p.where("p_partkey % 4 > 0").select("filename", (F.col("p_size") * 1048576).alias("size_bytes")), p.where("p_partkey % 5 = 0").select("filename", F.lit(0.5).alias("size_mb")))
    return out.select("tile_id", "on_disk", "in_catalog", "size_mb")


@query("SELECT cluster_id, CAST(t AS INTEGER) AS triangle, round(4 * hw * hh / 2, 4) AS area, 1.0 AS nz FROM footprints, (SELECT unnest([1, 2]) AS t)")
def g24_fans(spark, sf_dir):
    """Faces as triangles with the face's normal."""
    f = footprints(spark, sf_dir).select("cluster_id", F.transform("ring", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(3.0).alias("z"))).alias("corners"))
    t = T.fans(f, ["cluster_id"])
    area = F.abs((F.col("b.x") - F.col("a.x")) * (F.col("c.y") - F.col("a.y")) - (F.col("c.x") - F.col("a.x")) * (F.col("b.y") - F.col("a.y"))) / 2
    return t.select("cluster_id", "triangle", F.round(area, 4).alias("area"), F.round("normal.z", 6).alias("nz"))


@query("""WITH v AS (SELECT cluster_id AS object_id, 3 + p_size % 3 AS n FROM footprints), o AS (SELECT object_id, n, coalesce(sum(n) OVER (ORDER BY object_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM v)
SELECT object_id, CAST(off AS BIGINT) AS first, CAST(off + n - 1 AS BIGINT) AS last, CAST(off + 2 AS BIGINT) AS corner FROM o""")
def g25_merged_meshes(spark, sf_dir):
    """Many objects as one mesh, indices raised by the vertices before."""
    s = footprints(spark, sf_dir).select(F.col("cluster_id").alias("object_id"), (3 + F.col("p_size") % 3).alias("n"))
    v = s.select("object_id", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"))).alias("v"))
    faces = s.select("object_id", F.lit(0).alias("f"), F.array(*(F.lit(k).cast("long") for k in range(3))).alias("indices"))
    v, faces = T.merged_meshes(v, faces, cut)
    return v.groupBy("object_id").agg(F.min("v").alias("first"), F.max("v").alias("last")).join(faces.select("object_id", F.col("indices")[2].alias("corner")), "object_id")


@query("""WITH f AS (SELECT tile_id, source AS kind, max(full_address) AS path, count(*) AS n FROM (SELECT CAST(CAST(floor(rx / 250) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(ry / 250) AS BIGINT) AS VARCHAR) AS tile_id, * FROM addresses) GROUP BY 1, 2)
SELECT t.tile_id, count(f.kind) AS n_files, CAST(coalesce(sum(n), 0) AS BIGINT) AS bytes, max(path) FILTER (kind = 'BUILDING') AS building FROM tiles t LEFT JOIN f USING (tile_id) GROUP BY 1""")
def a58_tile_index(spark, sf_dir):
    a = addresses(spark, sf_dir).select(F.concat_ws("_", F.floor(F.col("rx") / 250).cast("string"), F.floor(F.col("ry") / 250).cast("string")).alias("tile_id"), F.col("source").alias("kind"), F.col("full_address").alias("path"))
    files = a.groupBy("tile_id", "kind").agg(F.max("path").alias("path"), F.count("*").alias("size_bytes"))
    return T.tile_index(tiles(spark, sf_dir), files).select("tile_id", "n_files", "bytes", F.col("assets")["BUILDING"].alias("building"))


@query("""WITH f AS (SELECT p_size % 3 AS city_id, tile_id, method, p_size % 5 > 0 AS boxed FROM footprints), m AS (SELECT city_id, tile_id, method, row_number() OVER (PARTITION BY city_id, tile_id ORDER BY count(*) DESC, method) AS r FROM f GROUP BY 1, 2, 3),
c AS (SELECT city_id, method, row_number() OVER (PARTITION BY city_id ORDER BY count(*) DESC, method) AS r FROM m WHERE r = 1 GROUP BY 1, 2)
SELECT f.city_id, count(DISTINCT f.tile_id) AS n_tiles, count(*) AS n_footprints, CAST(count_if(NOT boxed) AS BIGINT) AS n_without_box, any_value(c.method) AS mode FROM f JOIN c ON c.city_id = f.city_id AND c.r = 1 GROUP BY 1""")
def a59_footprint_sources(spark, sf_dir):
    f = footprints(spark, sf_dir).select((F.col("p_size") % 3).alias("city_id"), "tile_id", "method", F.when(F.col("p_size") % 5 > 0, 1).alias("box"))
    return T.footprint_sources(f).select("city_id", "n_tiles", "n_footprints", "n_without_box", "mode")


@query("""SELECT (SELECT count(*) FROM tiles) - 1 AS n_raw, (SELECT count(*) FROM tiles) AS n_expected, 1 AS n_missing, (SELECT count(*) FROM footprints) AS n_structures, (SELECT count(*) FROM addresses WHERE address_id % 10 = 0) AS n_addresses, 'missing_tiles,few_addresses' AS warnings""")
def a53_city_audit(spark, sf_dir):
    t = tiles(spark, sf_dir)
    r = T.city_audit(t.where("tile_id != '0_0'"), t, footprints(spark, sf_dir), addresses(spark, sf_dir).where("address_id % 10 = 0"))
    return r.withColumn("warnings", F.array_join("warnings", ","))


@query("""SELECT CAST(x AS VARCHAR) || '_' || CAST(y AS VARCHAR) || q AS tile_id, x = 1 AND y = 1 AND q = 'a' AS present FROM (SELECT unnest([-2, 1, 4]) AS x), (SELECT unnest([-2, 1, 4]) AS y), (SELECT unnest(['a', 'b', 'c', 'd']) AS q)""")
def s18_around_seed(spark, sf_dir):
    have = tiles(spark, sf_dir).select(F.when(F.col("tile_id") == "1_1", "1_1a").otherwise(F.col("tile_id")).alias("tile_id"))
    return T.around_seed(1, 1, 1, have).select("tile_id", "present")
