"""Queries on the quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import quality_report as Q

from .derived import read
from .registry import query

_R = """r AS (SELECT p_partkey AS k, p_size AS s, CAST(p_partkey AS VARCHAR) AS building_id, CASE WHEN p_partkey % 4 = 0 THEN 'Miami Dade' ELSE 'city' || CAST(p_partkey % 3 AS VARCHAR) END AS city, p_brand AS tile_id, 'v' || CAST(p_partkey % 2 AS VARCHAR) AS pipeline_version,
  10.0 + p_size AS h, CASE WHEN p_partkey % 17 = 0 THEN 5.0 ELSE 20.0 + p_size END AS hmax, CASE WHEN p_partkey % 19 = 0 THEN 8.0 ELSE 15.0 + p_size END AS p95, 12.0 + p_size AS p90, 2.0 AS gz, CASE WHEN p_partkey % 23 = 0 THEN 1.0 ELSE 12.0 + p_size END AS roof,
  CASE WHEN p_partkey % 29 = 0 THEN 0.0 WHEN p_partkey % 31 = 0 THEN -5.0 ELSE p_retailprice END AS area, CASE WHEN p_partkey % 37 = 0 THEN -1.0 ELSE 40.0 END AS per, CASE WHEN p_partkey % 41 = 0 THEN -1.0 ELSE 90.0 END AS ra, CASE WHEN p_partkey % 43 = 0 THEN -1.0 ELSE 900.0 END AS vol,
  CASE WHEN p_partkey % 7 = 0 THEN 'm1' END AS nv, CASE WHEN p_partkey % 3 = 0 THEN 'meters' WHEN p_partkey % 3 = 1 THEN 'feet' ELSE '' END AS hu, CASE WHEN p_partkey % 11 > 0 THEN 'EPSG:1' END AS crs, CASE WHEN p_partkey % 6 > 0 THEN 'county' END AS prov,
  CASE WHEN p_partkey % 13 = 0 THEN 'abc' END AS hash, CASE WHEN p_partkey % 8 = 0 THEN 'High' ELSE 'low' END AS conf, CASE WHEN p_partkey % 12 = 0 THEN 'Fallback' ELSE 'good' END AS quality, p_size * 2 AS inside, CASE WHEN p_partkey % 47 = 0 THEN 1 ELSE 1000 END AS cluster FROM part)"""


def records(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    at = lambda n, a, b: F.when(k % n == 0, F.lit(a)).otherwise(b if not isinstance(b, (int, float, str)) else F.lit(b))
    area = F.when(k % 29 == 0, 0.0).when(k % 31 == 0, -5.0).otherwise(F.col("p_retailprice"))
    return read(spark, sf_dir, "part").select(
        k.cast("string").alias("building_id"), F.when(k % 4 == 0, "Miami Dade").otherwise(F.concat(F.lit("city"), (k % 3).cast("string"))).alias("city"), F.col("p_brand").alias("tile_id"), F.concat(F.lit("v"), (k % 2).cast("string")).alias("pipeline_version"),
        (s + 10.0).alias("height"), at(17, 5.0, s + 20.0).alias("height_max"), at(19, 8.0, s + 15.0).alias("height_p95"), (s + 12.0).alias("height_p90"), F.lit(2.0).alias("ground_z"), at(23, 1.0, s + 12.0).alias("roof_elevation"), area.alias("footprint_area_m2"),
        at(37, -1.0, 40.0).alias("perimeter_m"), at(41, -1.0, 90.0).alias("roof_area"), at(43, -1.0, 900.0).alias("volume_m3"), F.when(k % 7 == 0, "m1").alias("normalization_version"), F.when(k % 3 == 0, "meters").when(k % 3 == 1, "feet").otherwise("").alias("horizontal_unit"),
        F.when(k % 11 > 0, "EPSG:1").alias("source_crs"), F.when(k % 6 > 0, "county").alias("footprint_provenance"), F.when(k % 13 == 0, "abc").alias("source_hash"), at(8, "High", "low").alias("confidence"), at(12, "Fallback", "good").alias("source_quality"),
        (s * 2).alias("point_count_inside"), at(47, 1, 1000).alias("point_count_cluster"), F.when(k % 5 == 0, s * 2 / F.when(area != 0, area) * 1.2).alias("point_density"), F.when(k % 53 == 0, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"))).alias("contributing_source_tiles"),
    )


_CODES = {
    "REL-HEIGHT-MAX-P95": "hmax < p95", "REL-HEIGHT-P95-P90": "p95 < p90", "REL-ROOF-BELOW-GROUND": "roof - gz < 0", "REL-HEIGHT-DELTA": "abs(h - (roof - gz)) > 2", "REL-NEG-FOOTPRINT-AREA": "area < 0", "REL-NEG-PERIMETER": "per < 0", "REL-NEG-ROOF-AREA": "ra < 0",
    "REL-NEG-VOLUME": "vol < 0", "REL-ZERO-FOOTPRINT-AREA": "area = 0", "REL-FILTERED-GT-RAW": "inside > cluster", "REL-DENSITY-MISMATCH": "k % 5 = 0 AND area <> 0", "REL-METRIC-PROVENANCE-MISSING": "hu = 'meters' AND nv IS NULL", "REL-CRS-MISSING": "crs IS NULL",
    "REL-PROVENANCE-MISSING": "prov IS NULL", "REL-SOURCE-HASH-MISSING": "hash IS NULL", "REL-HIGH-CONFIDENCE-NO-PROVENANCE": "conf = 'High' AND prov IS NULL", "REL-FALLBACK-MARKER-MISSING": "quality = 'Fallback' AND prov IS NULL",
    "REL-MIAMI-NORMALIZATION-MISSING": "city = 'Miami Dade' AND nv IS NULL", "REL-DUPLICATE-SOURCE-TILE": "k % 53 = 0",
}
_EACH = " UNION ALL ".join(f"SELECT '{c}' AS code, building_id, city, tile_id, pipeline_version FROM r WHERE {w}" for c, w in _CODES.items())
_MIXED = "SELECT 'REL-MIXED-HORIZONTAL-UNITS' AS code, NULL AS building_id, NULL AS city, NULL AS tile_id, NULL AS pipeline_version FROM (SELECT city AS g, count(DISTINCT hu) AS n FROM r WHERE hu <> '' GROUP BY 1 UNION ALL SELECT tile_id, count(DISTINCT hu) FROM r WHERE hu <> '' GROUP BY 1) WHERE n > 1"
_FAR = "SELECT 'STAT-IQR-OUTLIER' AS code, building_id, city, tile_id, pipeline_version FROM r, (SELECT quantile_cont(area, 0.25) AS q1, quantile_cont(area, 0.75) AS q3 FROM r) q WHERE area < q1 - 0.5 * (q3 - q1) OR area > q3 + 0.5 * (q3 - q1)"


def _diagnostics(spark, sf_dir):
    return Q.relationships(records(spark, sf_dir), ["footprint_area_m2"], Q.Tolerances(iqr=0.5))


@query(f"WITH {_R}, d AS ({_EACH} UNION ALL {_MIXED} UNION ALL {_FAR}) SELECT code, building_id, city FROM d")
def q2_relationships(spark, sf_dir):
    """Relationship checks on records, mixed units, outliers."""
    return _diagnostics(spark, sf_dir).select("code", "building_id", "city")


@query(f"""WITH {_R}, d AS ({_EACH} UNION ALL {_MIXED} UNION ALL {_FAR}), f AS (SELECT * FROM r WHERE area < 0), g AS (SELECT 'city' AS level, city AS value, * FROM r UNION ALL SELECT 'tile_id', tile_id, * FROM r UNION ALL SELECT 'pipeline_version', pipeline_version, * FROM r),
x AS (SELECT 'city' AS level, city AS value FROM d UNION ALL SELECT 'tile_id', tile_id FROM d UNION ALL SELECT 'pipeline_version', pipeline_version FROM d), y AS (SELECT 'city' AS level, city AS value FROM f UNION ALL SELECT 'tile_id', tile_id FROM f UNION ALL SELECT 'pipeline_version', pipeline_version FROM f)
SELECT level, value, count(*) AS n_records, count(DISTINCT building_id) AS n_buildings, round(100.0 * count(hash) / count(*), 4) AS hash_percent, (SELECT count(*) FROM x WHERE x.level = g.level AND x.value = g.value) AS n_diagnostics, (SELECT count(*) FROM y WHERE y.level = g.level AND y.value = g.value) AS n_findings FROM g GROUP BY 1, 2""")
def a26_group_summaries(spark, sf_dir):
    r = records(spark, sf_dir)
    found = r.where("footprint_area_m2 < 0").select("building_id", "city", F.col("tile_id").alias("source_tile"), "pipeline_version")
    return Q.group_summary(r, _diagnostics(spark, sf_dir), found, {"city": "city", "tile_id": "source_tile", "pipeline_version": "pipeline_version"})


@query(f"WITH {_R} SELECT building_id FROM r WHERE (per < 0 OR ra < 0) AND NOT area < 0")
def u8_warned_only(spark, sf_dir):
    """U8: buildings with warnings and no errors."""
    d = _diagnostics(spark, sf_dir).where("code IN ('REL-NEG-FOOTPRINT-AREA', 'REL-NEG-PERIMETER', 'REL-NEG-ROOF-AREA')")
    return Q.warned_only(d.withColumn("severity", F.when(F.col("code") == "REL-NEG-FOOTPRINT-AREA", "ERROR").otherwise("WARNING")))


@query("""WITH v AS (SELECT unnest(['1', ' ', NULL, 'nan', 'inf', 'x']) AS w), n AS (SELECT CASE o_orderkey % 6 WHEN 0 THEN '1' WHEN 1 THEN ' ' WHEN 3 THEN 'NaN' WHEN 4 THEN 'Infinity' WHEN 5 THEN 'n/a' END AS v FROM orders)
SELECT 'v' AS field, count(*) AS n_rows, CAST(count_if(v IS NULL) AS BIGINT) AS n_null, CAST(count_if(trim(v) = '') AS BIGINT) AS n_blank, CAST(count_if(v = 'NaN') AS BIGINT) AS n_nan, CAST(count_if(v = 'Infinity') AS BIGINT) AS n_infinite, CAST(count_if(v = '1') AS BIGINT) AS n_numeric, count(DISTINCT v) AS n_distinct FROM n""")
def a21_field_profile(spark, sf_dir):
    """What the values of a field are, with examples."""
    from cadastra.operators import profile as P

    k = F.col("o_orderkey") % 6
    d = read(spark, sf_dir, "orders").select(F.when(k == 0, "1").when(k == 1, " ").when(k == 3, "NaN").when(k == 4, "Infinity").when(k == 5, "n/a").alias("v"))
    return P.completeness(d, ["v"]).select("field", "n_rows", "n_null", "n_blank", "n_nan", "n_infinite", "n_numeric", "n_distinct")
