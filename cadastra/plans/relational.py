"""Queries on joins, rollups, windows, sets and profiles over tables of records."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadastra.operators import profile as P

from .clusters import cut
from .derived import addresses, footprints, points, read, tiles
from .registry import query


@query("""WITH a AS (SELECT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'catalog_only' WHEN a.k IS NULL THEN 'disk_only' ELSE 'both' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def j1_manifest(spark, sf_dir):
    """Catalog and disk by name; which side has each."""
    a = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit(1).alias("a"))
    b = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct().withColumn("b", F.lit(1))
    return a.join(b, "k", "full").select("k", F.when(F.col("b").isNull(), "catalog_only").when(F.col("a").isNull(), "disk_only").otherwise("both").alias("status"))


@query("SELECT f.cluster_id, coalesce(s.provenance, f.provenance) AS provenance FROM footprints f LEFT JOIN (SELECT cluster_id, 'clipped' AS provenance FROM footprints WHERE p_size > 40) s USING (cluster_id)")
def j2_provenance(spark, sf_dir):
    f = footprints(spark, sf_dir)
    newer = f.where("p_size > 40").select("cluster_id", F.lit("clipped").alias("p2"))
    return f.join(newer, "cluster_id", "left").select("cluster_id", F.coalesce("p2", "provenance").alias("provenance"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j36_resume_queue(spark, sf_dir):
    """Records that aren't done yet."""
    return read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT cluster_id, round(sqrt((cx - 500) ** 2 + (cy - 500) ** 2), 6) AS dist FROM footprints ORDER BY dist, cluster_id LIMIT 1")
def j37_nearest_to_point(spark, sf_dir):
    """The footprint nearest to a place (a top-1 report; J37, W12)."""
    return footprints(spark, sf_dir).select("cluster_id", F.round(F.hypot(F.col("cx") - 500, F.col("cy") - 500), 6).alias("dist")).orderBy("dist", "cluster_id").limit(1)


@query("SELECT classification, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM points GROUP BY 1")
def a6_class_histogram(spark, sf_dir):
    n = points(spark, sf_dir).groupBy("classification").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    return n.join(F.broadcast(total)).select("classification", "n", F.round(100.0 * F.col("n") / F.col("t"), 6).alias("percent"))


@query("""SELECT t.tile_id, count(f.cluster_id) AS n_structures, CAST(coalesce(sum(f.p_size), 0) AS BIGINT) AS total, CASE WHEN count(f.cluster_id) = 0 THEN 'empty' WHEN count(f.cluster_id) < 100 THEN 'partial' ELSE 'complete' END AS status
FROM tiles t LEFT JOIN footprints f USING (tile_id) GROUP BY 1""")
def a7_tile_rollup(spark, sf_dir):
    """Structures of each tile, zeros included, and the tile's status."""
    n = footprints(spark, sf_dir).groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("p_size").alias("s"))
    j = tiles(spark, sf_dir).select("tile_id").join(n, "tile_id", "left")
    c = F.coalesce("n", F.lit(0))
    return j.select("tile_id", c.alias("n_structures"), F.coalesce("s", F.lit(0)).alias("total"), F.when(c == 0, "empty").when(c < 100, "partial").otherwise("complete").alias("status"))


@query("SELECT coalesce(provenance, method) AS kind, count(*) AS n, CAST(count_if(provenance IS NULL) AS BIGINT) AS n_missing FROM footprints GROUP BY 1")
def a8_provenance_counts(spark, sf_dir):
    """A8, A9, A37."""
    return footprints(spark, sf_dir).groupBy(F.coalesce("provenance", "method").alias("kind")).agg(F.count("*").alias("n"), F.count_if(F.col("provenance").isNull()).alias("n_missing"))


@query("SELECT tile_id, CAST(count_if(method = 'Brand#1') AS BIGINT) AS b1, CAST(count_if(method = 'Brand#2') AS BIGINT) AS b2, CAST(count_if(method NOT IN ('Brand#1', 'Brand#2')) AS BIGINT) AS other FROM footprints GROUP BY 1")
def a16_method_audit(spark, sf_dir):
    """One column for each method."""
    m = F.when(F.col("method") == "Brand#1", "b1").when(F.col("method") == "Brand#2", "b2").otherwise("other")
    return footprints(spark, sf_dir).withColumn("m", m).groupBy("tile_id").pivot("m", ["b1", "b2", "other"]).count().na.fill(0)


@query("""SELECT n_regionkey, n_name, count(*) AS n, round(sum(c_acctbal), 4) AS total, min(c_acctbal) >= -999.99 AS all_ok FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_name)""")
def a54_city_rollup(spark, sf_dir):
    """Sums and all-passed for tiles, sectors and the city."""
    j = read(spark, sf_dir, "customer").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return j.rollup("n_regionkey", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 4).alias("total"), F.bool_and(F.col("c_acctbal") >= -999.99).alias("all_ok"))


_FIELDS = ["c_name", "c_mktsegment", "c_acctbal", "c_nationkey"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, CAST(count_if(trim(CAST({c} AS VARCHAR)) = '') AS BIGINT) AS n_blank, count(DISTINCT {c}) AS n_distinct FROM customer" for c in _FIELDS))
def a21_completeness(spark, sf_dir):
    return P.completeness(read(spark, sf_dir, "customer"), _FIELDS).select("field", "n_rows", "n_null", "n_blank", "n_distinct")


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.99), 4) AS q99, CAST(count_if({c} < 0) AS BIGINT) AS n_negative FROM customer" for c in ("c_acctbal", "c_nationkey")))
def a22_distributions(spark, sf_dir):
    """A22, A28, A39."""
    d = P.distributions(read(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"], cut=cut)
    return d.select("field", "n", "min", "max", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), F.round(F.col("percentiles")[2], 4).alias("q25"), F.round(F.col("percentiles")[6], 4).alias("q99"), "n_negative")


@query("""WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), b AS (SELECT CAST(least(9, floor((o_totalprice - lo) / ((hi - lo) / 10))) AS INTEGER) AS bin FROM orders, s)
SELECT r.bin, round(lo + r.bin * ((hi - lo) / 10), 4) AS lo, count(b.bin) AS n FROM (SELECT CAST(unnest(range(10)) AS INTEGER) AS bin) r CROSS JOIN s LEFT JOIN b ON b.bin = r.bin GROUP BY 1, 2""")
def a23_histogram(spark, sf_dir):
    return P.histogram(read(spark, sf_dir, "orders"), "o_totalprice").select("bin", F.round("lo", 4).alias("lo"), "n")


@query("""SELECT source AS value, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, source) AS INTEGER) AS rank, count(*) = 1 AS rare, source IN ('src1', 'src2') AS known FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 5""")
def a24_categories(spark, sf_dir):
    """The five commonest values (a report; A24, O4)."""
    return P.categories(read(spark, sf_dir, "documents"), "source", 5, ["src1", "src2"])


@query("""SELECT 'lang' AS dimension, lang AS value, count(*) AS n, count(DISTINCT doc_id) AS n_buildings FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*), count(DISTINCT doc_id) FROM documents GROUP BY source""")
def a25_findings_summary(spark, sf_dir):
    """A25."""
    return P.summary(read(spark, sf_dir, "documents").select("lang", "source", F.col("doc_id").alias("building_id")), ["lang", "source"])


@query("""WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderkey, 'o_totalprice' AS field, o_totalprice AS value FROM orders, q WHERE o_totalprice < q1 - 0.3 * (q3 - q1) OR o_totalprice > q3 + 0.3 * (q3 - q1)""")
def w8_outliers(spark, sf_dir):
    return P.outliers(read(spark, sf_dir, "orders"), "o_orderkey", ["o_totalprice"], 0.3, cut=cut).select("o_orderkey", "field", "value")


@query("""WITH a AS (SELECT o_orderkey AS k FROM orders), b AS (SELECT l_orderkey AS k, count(*) AS c FROM lineitem GROUP BY 1)
SELECT CAST(count_if(a.k IS NOT NULL AND b.k IS NOT NULL) AS BIGINT) AS matched, CAST(count_if(b.k IS NULL) AS BIGINT) AS missing, CAST(count_if(a.k IS NULL) AS BIGINT) AS extra, CAST(count_if(c > 1) AS BIGINT) AS duplicated,
 round(count_if(a.k IS NOT NULL AND b.k IS NOT NULL) / count(a.k), 6) AS ratio FROM a FULL JOIN b ON a.k = b.k""")
def u4_id_comparison(spark, sf_dir):
    """U4, Q10: two id sets compared."""
    a = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    b = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return P.id_comparison(a, b, "k").withColumn("ratio", F.round("ratio", 6))


@query("""SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def w4_first_wins_dedup(spark, sf_dir):
    """The first row of each key."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return d.groupBy("h").agg(F.min(F.struct("doc_id", "source")).alias("r")).select("r.doc_id", "r.source")


@query("""WITH o AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey, row_number() OVER w AS rank, count(*) OVER (PARTITION BY l_orderkey) AS candidates, first_value(l_partkey) OVER w AS primary_part FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber))
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, rank, candidates, primary_part, l_partkey = primary_part AS is_primary FROM o""")
def w1_primary_assignment(spark, sf_dir):
    """Candidates ranked within their group."""
    g = W.partitionBy("l_orderkey")
    w = g.orderBy(F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber")
    o = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.row_number().over(w).cast("long").alias("rank"), F.count("*").over(g).alias("candidates"), F.first("l_partkey").over(w).alias("primary_part"))
    return o.withColumn("is_primary", F.col("l_partkey") == F.col("primary_part"))


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 3")
def w11_latest_events(spark, sf_dir):
    """The three latest of each user."""
    w = W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return read(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.row_number().over(w).alias("r")).where("r <= 3").drop("r")


@query("SELECT tile_id, cluster_id, row_number() OVER (PARTITION BY tile_id ORDER BY cx, cy, cluster_id) AS structure_no, (row_number() OVER (PARTITION BY tile_id ORDER BY cx, cy, cluster_id) - 1) // 50 AS batch FROM footprints")
def w9_surrogate_keys(spark, sf_dir):
    """Numbers in a stated order, and batches of fifty."""
    n = F.row_number().over(W.partitionBy("tile_id").orderBy("cx", "cy", "cluster_id")).cast("long")
    return footprints(spark, sf_dir).select("tile_id", "cluster_id", n.alias("structure_no")).withColumn("batch", F.expr("(structure_no - 1) div 50"))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, list_aggregate(list_sort(list(l_partkey)), 'string_agg', ',') AS parts FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def w13_duplicate_ids(spark, sf_dir):
    """Ids that occur more than once."""
    g = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("l_partkey")), ",").alias("parts"))
    return g.where("n > 1")


@query("SELECT t.tile_id, k.kind FROM tiles t, (SELECT DISTINCT source AS kind FROM addresses) k EXCEPT SELECT CAST(CAST(floor(rx / 250) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(ry / 250) AS BIGINT) AS VARCHAR), source FROM addresses WHERE address_id % 7 = 0")
def u9_missing_outputs(spark, sf_dir):
    """Expected outputs of each tile that aren't there."""
    kinds = addresses(spark, sf_dir).agg(F.collect_set("source").alias("kinds"))  # a handful of layer names
    expected = tiles(spark, sf_dir).select("tile_id").join(F.broadcast(kinds)).select("tile_id", F.explode("kinds").alias("kind"))
    there = addresses(spark, sf_dir).where("address_id % 7 = 0").select(F.concat_ws("_", F.floor(F.col("rx") / 250).cast("string"), F.floor(F.col("ry") / 250).cast("string")).alias("tile_id"), F.col("source").alias("kind"))
    return expected.join(there.distinct(), ["tile_id", "kind"], "left_anti")


@query("""WITH m AS (SELECT count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS q FROM lineitem), a AS (SELECT count(*) AS n, CAST(sum(z) AS DOUBLE) AS q FROM points)
SELECT 'n' AS field, CAST(m.n AS DOUBLE) AS manifest, CAST(a.n AS DOUBLE) AS artefact, m.n <> a.n AS differs FROM m, a UNION ALL SELECT 'q', m.q, a.q, m.q <> a.q FROM m, a""")
def a36_manifest_mismatch(spark, sf_dir):
    long = lambda d, n: P.long_form(d, ["n", "q"], "double").withColumnRenamed("value", n)
    m = read(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    a = points(spark, sf_dir).agg(F.count("*").alias("n"), F.sum("z").alias("q"))
    return long(m, "manifest").join(long(a, "artefact"), "field").withColumn("differs", F.col("manifest") != F.col("artefact"))


@query("SELECT p_partkey % 4 AS grp, count(*) AS n, CAST(count_if(p_size >= 10) AS BIGINT) AS over_10, CAST(count_if(p_size >= 30) AS BIGINT) AS over_30, round(stddev_pop(p_retailprice), 4) AS std FROM part GROUP BY 1")
def a40_thresholds(spark, sf_dir):
    """Counts over thresholds."""
    p = read(spark, sf_dir, "part")
    return p.groupBy((F.col("p_partkey") % 4).alias("grp")).agg(F.count("*").alias("n"), F.count_if(F.col("p_size") >= 10).alias("over_10"), F.count_if(F.col("p_size") >= 30).alias("over_30"), F.round(F.stddev_pop("p_retailprice"), 4).alias("std"))


@query("""SELECT json_keys(props)[1] AS field, json_type(props, '$.' || json_keys(props)[1]) IN ('UBIGINT', 'BIGINT') AS is_integer, count(*) AS n FROM events GROUP BY 1, 2""")
def a55_property_types(spark, sf_dir):
    """Fields and value types of JSON properties."""
    e = read(spark, sf_dir, "events").select(F.from_json("props", "map<string,string>").alias("m"))
    kv = e.select(F.explode("m").alias("field", "value"))
    return kv.groupBy("field", F.col("value").rlike("^-?[0-9]+$").alias("is_integer")).agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT user_id, event_type, n * CASE event_type WHEN 'click' THEN 3 WHEN 'purchase' THEN 5 ELSE 1 END * 3 AS score FROM a)
SELECT user_id, event_type AS answer, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) AS r FROM s) WHERE r = 1""")
def m14_weighted_answers(spark, sf_dir):
    weight = F.when(F.col("event_type") == "click", 3).when(F.col("event_type") == "purchase", 5).otherwise(1)
    s = read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg((F.sum(weight) * 3).alias("score"))
    return s.groupBy("user_id").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("event_type").alias("answer"))).alias("b")).select("user_id", "b.answer", (-F.col("b.s")).alias("score"))
