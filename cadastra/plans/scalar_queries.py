"""Queries on scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.functions import scalars as S
from cadastra.operators.enrich import nearest_of_layers
from cadastra.operators.polygons import pair_measures

from .derived import addresses, footprints, points, read, tiles
from .registry import query


@query("SELECT point_id, z, classification FROM points WHERE (classification = 6 AND hag BETWEEN 2.5 AND 300) OR classification = 2")
def p1_class_height_filter(spark, sf_dir):
    return points(spark, sf_dir).where("(classification = 6 AND hag BETWEEN 2.5 AND 300) OR classification = 2").select("point_id", "z", "classification")


@query("SELECT point_id FROM points WHERE classification <> 2")
def p2_negated_class(spark, sf_dir):
    return points(spark, sf_dir).where(F.col("classification") != 2).select("point_id")


@query("SELECT point_id, round(CASE WHEN z_unit = 'ftUS' THEN z * 0.3048006096012192 ELSE z END, 6) AS z, 'm' AS z_unit, z_unit = 'ftUS' AS converted FROM points")
def p3_metric_z(spark, sf_dir):
    feet = F.col("z_unit") == "ftUS"
    return points(spark, sf_dir).select("point_id", F.round(F.when(feet, F.col("z") * S.FOOT_US).otherwise(F.col("z")), 6).alias("z"), F.lit("m").alias("z_unit"), feet.alias("converted"))


@query("SELECT tile_id, CAST(count(DISTINCT z_unit) AS BIGINT) AS n_units, count(DISTINCT z_unit) > 1 AS mixed, min(z_unit) AS first_unit FROM points GROUP BY 1")
def p4_unit_guard(spark, sf_dir):
    """Scopes with mixed vertical units."""
    return points(spark, sf_dir).groupBy("tile_id").agg(F.count_distinct("z_unit").alias("n_units"), (F.count_distinct("z_unit") > 1).alias("mixed"), F.min("z_unit").alias("first_unit"))


def _box(d, *names):
    return F.struct(*(F.col(n).alias(k) for n, k in zip(names, ("xmin", "ymin", "xmax", "ymax"), strict=True)))


@query("""SELECT a.tile_id AS a, b.tile_id AS b, a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax AS exclusive FROM tiles a JOIN tiles b ON a.tile_id < b.tile_id
  AND a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax""")
def p5_p6_box_overlap(spark, sf_dir):
    """Tiles whose boxes touch or overlap, and whether they overlap in the open sense."""
    t = tiles(spark, sf_dir)
    i, j = F.floor(F.col("xmin") / 250), F.floor(F.col("ymin") / 250)
    a = t.select(F.col("tile_id").alias("a"), _box(t, "xmin", "ymin", "xmax", "ymax").alias("ba"), i.alias("i"), j.alias("j"))
    step = F.sequence(F.lit(-1), F.lit(1))
    b = a.select(F.col("a").alias("b"), F.col("ba").alias("bb"), F.explode(F.transform(step, lambda k: F.col("i") + k)).alias("i"), "j").select("b", "bb", "i", F.explode(F.transform(step, lambda k: F.col("j") + k)).alias("j"))
    pairs = a.join(b, ["i", "j"]).where("a < b").where(G.boxes_overlap(F.col("ba"), F.col("bb")))
    return pairs.select("a", "b", G.boxes_overlap(F.col("ba"), F.col("bb"), inclusive=False).alias("exclusive"))


@query("SELECT cluster_id, CASE WHEN area_m2 < 40 THEN 'noise' WHEN area_m2 > 200 THEN 'oversized' ELSE 'ok' END AS quality, area_m2 BETWEEN 9 AND 200000 AS kept FROM footprints")
def p8_p9_area_quality(spark, sf_dir):
    a = F.col("area_m2")
    return footprints(spark, sf_dir).select("cluster_id", F.when(a < 40, "noise").when(a > 200, "oversized").otherwise("ok").alias("quality"), a.between(9, 200000).alias("kept"))


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_brand) = 'brand#1' OR starts_with(lower(p_name), 'part 1') OR contains(lower(p_name), '99')")
def p10_campaign_filter(spark, sf_dir):
    name = F.lower("p_name")
    return read(spark, sf_dir, "part").where((F.lower("p_brand") == "brand#1") | F.startswith(name, F.lit("part 1")) | F.contains(name, F.lit("99"))).select("p_partkey", "p_name")


@query("SELECT cluster_id, round(cx - (SELECT min(floor(cx / 1000) * 1000) FROM footprints), 6) AS local_x, round(0 - cy, 6) AS local_z, tile_id || ':' || CAST(cluster_id AS VARCHAR) AS id FROM footprints")
def p20_p21_local_export(spark, sf_dir):
    """Ids tile:cluster and coordinates shifted to the city's anchor with swapped axes."""
    f = footprints(spark, sf_dir)
    anchor = f.agg(F.min(F.floor(F.col("cx") / 1000) * 1000).alias("ax"))
    return f.join(F.broadcast(anchor)).select("cluster_id", F.round(F.col("cx") - F.col("ax"), 6).alias("local_x"), F.round(0 - F.col("cy"), 6).alias("local_z"), F.concat_ws(":", "tile_id", F.col("cluster_id").cast("string")).alias("id"))


@query("""SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, trim(regexp_replace(replace(lower(p_type), '_', ' '), ' +', ' ', 'g')) AS normal,
  'bld_' || regexp_replace(p_brand, '[^A-Za-z0-9_.-]', '_', 'g') || '_' || CAST(p_partkey AS VARCHAR) AS node, CAST(('0x' || substr(sha256(p_name || '|' || p_brand), 1, 8)) AS BIGINT) AS seed, sha256('{"brand":"' || p_brand || '","size":' || p_size || '}') AS digest FROM part""")
def f_text_scalars(spark, sf_dir):
    """F2, F7, F8, F10, F18, F19 on parts."""
    return read(spark, sf_dir, "part").select(
        "p_partkey", S.slug(F.col("p_name")).alias("slug"), S.normal_text(F.col("p_type")).alias("normal"), S.node_name(F.col("p_brand"), F.col("p_partkey").cast("string")).alias("node"),
        S.seed(F.col("p_name"), F.col("p_brand")).alias("seed"), S.canonical_digest(size=F.col("p_size"), brand=F.col("p_brand")).alias("digest"),
    )


@query("""SELECT c_custkey, concat_ws(', ', nullif(trim(c_name), ''), nullif(trim(n_name), ''), nullif(trim(c_mktsegment), '')) AS full_address,
  CASE WHEN c_name IS NULL THEN 'null' WHEN trim(c_name) = '' THEN 'blank' WHEN lower(trim(c_name)) IN ('null', 'none', 'nan', 'n/a', 'na', 'undefined') THEN 'null_like' ELSE 'present' END AS kind
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def f5_full_address(spark, sf_dir):
    """F5, F6, P13."""
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    j = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")  # nation has 25 rows at any scale
    return j.select("c_custkey", S.full_address(F.col("c_name"), F.col("n_name"), F.col("c_mktsegment")).alias("full_address"), S.emptiness(F.col("c_name")).alias("kind"))


@query("""WITH v AS (SELECT doc_id, sha256(coalesce(text, '')) AS h, 'tiles/' || source || '/' || lang || '.geojson' AS path FROM documents)
SELECT doc_id, regexp_matches(h, '^[0-9a-f]{64}$') AS sha_ok, CASE lower(regexp_extract(path, '\\.([A-Za-z0-9]+)$', 1)) WHEN 'geojson' THEN 'application/geo+json' ELSE 'application/octet-stream' END AS media,
  regexp_matches(path, '^(/|~)') AS absolute, regexp_replace(regexp_extract(path, '[^/]*$'), '\\.geojson$', '') AS stem FROM v""")
def f16_f22_paths(spark, sf_dir):
    """F16, F20, F21, F22 on documents as files."""
    v = read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"), F.concat(F.lit("tiles/"), "source", F.lit("/"), "lang", F.lit(".geojson")).alias("path"))
    return v.select("doc_id", S.is_sha256(F.col("h")).alias("sha_ok"), S.media_type(F.col("path")).alias("media"), S.is_absolute_path(F.col("path")).alias("absolute"), F.regexp_replace(F.regexp_extract("path", "[^/]*$", 0), r"\.geojson$", "").alias("stem"))


@query("""WITH r AS (SELECT min(z) AS lo, max(z) AS hi FROM points)
SELECT CAST(least(4, floor((z - lo) / ((hi - lo) / 5))) AS INTEGER) AS band, count(*) AS n, round(avg((z - lo) / (hi - lo)), 6) AS mean_t FROM points, r GROUP BY 1""")
def f27_f28_bands(spark, sf_dir):
    p = points(spark, sf_dir).select("z")
    r = F.broadcast(p.agg(F.min("z").alias("lo"), F.max("z").alias("hi")))
    j = p.join(r)
    return j.groupBy(S.band(F.col("z"), F.col("lo"), F.col("hi")).alias("band")).agg(F.count("*").alias("n"), F.round(F.avg((F.col("z") - F.col("lo")) / (F.col("hi") - F.col("lo"))), 6).alias("mean_t"))


@query("""WITH v AS (SELECT p_partkey, 2.5 + p_size AS h, p_size / 60.0 AS ratio FROM part)
SELECT p_partkey, CAST(greatest(1, round_even(h / 3.2, 0)) AS INTEGER) AS floors, round(least(6.0, greatest(2.4, h / greatest(1, round_even(h / 3.2, 0)))), 6) AS floor_height,
  CASE WHEN ratio < 0.25 THEN 'low' WHEN ratio < 0.6 THEN 'medium' ELSE 'high' END AS glazing FROM v""")
def f34_f36_floors(spark, sf_dir):
    v = read(spark, sf_dir, "part").select("p_partkey", (F.lit(2.5) + F.col("p_size")).alias("h"), (F.col("p_size") / 60.0).alias("ratio"))
    n = S.floors(F.col("h"))
    return v.select("p_partkey", n.alias("floors"), F.round(S.floor_height(F.col("h"), n), 6).alias("floor_height"), S.glazing(F.col("ratio")).alias("glazing"))


@query("""WITH q AS (SELECT cluster_id, cx, cy, hw, hh FROM footprints)
SELECT cluster_id, round(4 * hw * hh, 4) AS area, round(4 * (hw + hh), 4) AS perimeter, round(cx, 4) AS centroid_x, round(cy, 4) AS centroid_y, round(4 * pi() * (4 * hw * hh) / pow(4 * (hw + hh), 2), 6) AS compactness, true AS simple,
  round(greatest(cx - hw - 500, 0, 500 - cx - hw), 4) AS gap_x, round(cx - hw, 4) AS xmin, round(cy + hh, 4) AS ymax FROM q""")
def g6_ring_measures(spark, sf_dir):
    """Measures of rings."""
    f, ring = footprints(spark, sf_dir), F.col("ring")
    c = G.centroid(ring)
    gap = F.greatest(F.col("cx") - F.col("hw") - 500, F.lit(0.0), 500 - F.col("cx") - F.col("hw"))
    return f.select(
        "cluster_id", F.round(G.area(ring), 4).alias("area"), F.round(G.perimeter(ring), 4).alias("perimeter"), F.round(c["x"], 4).alias("centroid_x"), F.round(c["y"], 4).alias("centroid_y"),
        F.round(G.compactness(ring), 6).alias("compactness"), G.is_simple(ring).alias("simple"), F.round(gap, 4).alias("gap_x"), F.round(G.bbox(ring)["xmin"], 4).alias("xmin"), F.round(G.bbox(ring)["ymax"], 4).alias("ymax"),
    )


@query("SELECT cluster_id, round(-90 + cx / 1000, 7) AS lon, round(30 + cy / 1000, 7) AS lat FROM footprints")
def g1_utm_round_trip(spark, sf_dir):
    """Degrees to UTM zone 16 and back."""
    lon, lat = F.lit(-90.0) + F.col("cx") / 1000, F.lit(30.0) + F.col("cy") / 1000
    u = footprints(spark, sf_dir).select("cluster_id", G.to_utm(lon, lat, 16).alias("u"))
    back = G.from_utm(F.col("u.x"), F.col("u.y"), 16)
    return u.select("cluster_id", F.round(back["lon"], 7).alias("lon"), F.round(back["lat"], 7).alias("lat"))


@query("""SELECT address_id, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(ry / 1000) / 2), 2) + cos(radians(30)) * cos(radians(30 + ry / 1000)) * pow(sin(radians(rx / 1000) / 2), 2))), 6) AS km FROM addresses ORDER BY km, address_id LIMIT 10""")
def o5_nearest_places(spark, sf_dir):
    """The ten addresses nearest to a corner by great-circle distance (a top-k report; F24)."""
    km = G.haversine_km(F.lit(-90.0), F.lit(30.0), F.lit(-90.0) + F.col("rx") / 1000, F.lit(30.0) + F.col("ry") / 1000)
    return addresses(spark, sf_dir).select("address_id", F.round(km, 6).alias("km")).orderBy("km", "address_id").limit(10)


@query("""WITH a AS (SELECT f.cluster_id, f.cx, f.cy, f.hw, f.hh, f.cx + 1 AS dx, f.cy + 0.5 AS dy FROM footprints f)
SELECT cluster_id, round((2 * hw - 1) * (2 * hh - 0.5), 4) AS intersection, round((2 * hw - 1) * (2 * hh - 0.5) / (8 * hw * hh - (2 * hw - 1) * (2 * hh - 0.5)), 6) AS iou, round(sqrt(1.25), 6) AS hausdorff, round(sqrt(1.25), 6) AS centroid_distance FROM a""")
def g12_g15_pair_metrics(spark, sf_dir):
    """Each footprint against a copy shifted by (1, 0.5)."""
    f = footprints(spark, sf_dir)
    other = F.transform("ring", lambda p: F.struct((p["x"] + 1).alias("x"), (p["y"] + 0.5).alias("y")))
    v = pair_measures(f.select("cluster_id", "ring", "area_m2", other.alias("other")), "ring", "other")
    m = v.select("cluster_id", "area_m2", F.col("shared").alias("s"), F.col("hausdorff").alias("h"), G.centroid(F.col("ring")).alias("a"), G.centroid(F.col("other")).alias("b"))
    return m.select("cluster_id", F.round("s", 4).alias("intersection"), F.round(F.col("s") / (2 * F.col("area_m2") - F.col("s")), 6).alias("iou"), F.round("h", 6).alias("hausdorff"), F.round(F.hypot(F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")), 6).alias("centroid_distance"))


@query("SELECT i AS ix, j AS iy, i * 250 AS xmin, j * 250 AS ymin, i * 250 + 270 AS xmax, j * 250 + 270 AS ymax FROM (SELECT unnest(range(0, 4)) AS i), (SELECT unnest(range(0, 4)) AS j)")
def g22_tile_grid(spark, sf_dir):
    """Regular 250 m tiles with 20 m overlap over the points' extent."""
    e = points(spark, sf_dir).agg(F.floor((F.max("x") - 1) / 250).alias("nx"), F.floor((F.max("y") - 1) / 250).alias("ny"))
    g = e.select(F.explode(F.sequence(F.lit(0).cast("long"), "nx")).alias("ix"), "ny").select("ix", F.explode(F.sequence(F.lit(0).cast("long"), "ny")).alias("iy"))
    return g.select("ix", "iy", (F.col("ix") * 250).alias("xmin"), (F.col("iy") * 250).alias("ymin"), (F.col("ix") * 250 + 270).alias("xmax"), (F.col("iy") * 250 + 270).alias("ymax"))


@query("""SELECT f.cluster_id, k AS vertex, lvl AS level, round(CASE WHEN k IN (0, 3) THEN cx - hw ELSE cx + hw END, 4) AS x, round(CASE WHEN k IN (0, 1) THEN cy - hh ELSE cy + hh END, 4) AS y, CASE lvl WHEN 0 THEN 0.0 ELSE p_size + 0.0 END AS z
FROM footprints f, (SELECT CAST(unnest(range(4)) AS INTEGER) AS k), (SELECT CAST(unnest(range(2)) AS INTEGER) AS lvl)""")
def g23_prism_vertices(spark, sf_dir):
    """Bottom and top vertices of extruded footprints."""
    f = footprints(spark, sf_dir).select("cluster_id", "p_size", F.posexplode("ring").alias("vertex", "p"))
    v = f.select("cluster_id", "vertex", "p", "p_size", F.explode(F.array(F.lit(0), F.lit(1))).alias("level"))
    return v.select("cluster_id", "vertex", "level", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"), F.when(F.col("level") == 0, 0.0).otherwise(F.col("p_size").cast("double")).alias("z"))


@query("""WITH d AS (SELECT f.cluster_id, a.address_id, a.source, sqrt((cx - rx) ** 2 + (cy - ry) ** 2) AS d, CASE a.source WHEN 'BUILDING' THEN 60 WHEN 'MACHINERY' THEN 30 ELSE 45 END AS r FROM footprints f JOIN addresses a ON abs(cx - rx) <= 60 AND abs(cy - ry) <= 60),
b AS (SELECT cluster_id, source, min_by(address_id, (d, address_id)) AS address_id, min(d) AS d FROM d WHERE d <= r GROUP BY 1, 2)
SELECT cluster_id, source AS layer_id, address_id, round(d, 6) AS dist FROM b""")
def j6_layer_enrichment(spark, sf_dir):
    """Nearest feature of each layer within the layer's own radius."""
    radius = F.when(F.col("source") == "BUILDING", 60.0).when(F.col("source") == "MACHINERY", 30.0).otherwise(45.0)
    a = addresses(spark, sf_dir).select(F.col("source").alias("layer_id"), F.col("address_id").alias("feature_id"), "rx", "ry", radius.alias("radius"))
    best = nearest_of_layers(footprints(spark, sf_dir).select("cluster_id", "cx", "cy"), a, 60.0)
    return best.select("cluster_id", "layer_id", F.col("feature_id").alias("address_id"), F.round("dist", 6).alias("dist"))
