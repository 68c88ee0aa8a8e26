"""Spatial tables that Spark derives from the driver's tables, with the same rules as SQL for the oracle.

points <- lineitem, footprints <- part, addresses <- customer, tiles <- the cells of points. Coordinates come from integer
arithmetic on keys, so that Spark and SQL compute the same values at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import geometry as G

TILE = 250.0

#: The SQL's number where a long holds it (orders up to 5.7 million). Beyond, where SQL has none, it goes on below zero, as longs do;
#: orders beyond 11.5 million could share one.
_WIDE = "(((l_orderkey * 8 + l_linenumber) * 2000000BD + l_partkey) * 100000BD + l_suppkey)"
_LOW = f"({_WIDE} % 18446744073709551616BD)"
POINT_ID = f"""coalesce(try_add(try_multiply(try_add(try_multiply(l_orderkey * 8 + l_linenumber, 2000000L), l_partkey), 100000L), l_suppkey),
  CAST(CASE WHEN {_LOW} > 9223372036854775807BD THEN {_LOW} - 18446744073709551616BD ELSE {_LOW} END AS BIGINT))"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """point_id, x, y, z, classification (6 building, 2 ground, 1 other), hag, z_unit, tile_id."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        f"{POINT_ID} AS point_id",
        "((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 613) % 100003) / 100.0D AS x",
        "((l_orderkey * 611953 + l_suppkey * 15485863 + l_partkey * 31) % 99991) / 100.0D AS y",
        "l_quantity AS z",
        "CASE l_returnflag WHEN 'A' THEN 6 WHEN 'N' THEN 2 ELSE 1 END AS classification",
        "((l_orderkey * 31 + l_linenumber * 17 + l_suppkey) % 400) / 10.0D AS hag",
        "CASE WHEN l_suppkey % 10 = 0 THEN 'ftUS' ELSE 'm' END AS z_unit",
    ).withColumn("tile_id", F.concat_ws("_", F.floor(F.col("x") / TILE).cast("string"), F.floor(F.col("y") / TILE).cast("string")))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cluster_id, cx, cy, hw, hh, ring (a rectangle), area_m2, tile_id, method, provenance."""
    df = read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS cluster_id", "((p_partkey * 15485863) % 100003) / 100.0D AS cx", "((p_partkey * 32452843) % 99991) / 100.0D AS cy",
        "2.0D + p_size % 9 AS hw", "2.0D + p_size % 7 AS hh", "p_brand AS method", "split(p_type, ' ')[0] AS provenance", "p_size", "p_retailprice",
    )
    ring = G.rectangle(F.col("cx") - F.col("hw"), F.col("cy") - F.col("hh"), F.col("cx") + F.col("hw"), F.col("cy") + F.col("hh"))
    return df.withColumns({"ring": ring, "area_m2": F.col("hw") * F.col("hh") * 4, "tile_id": F.concat_ws("_", F.floor(F.col("cx") / TILE).cast("string"), F.floor(F.col("cy") / TILE).cast("string"))})


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """address_id, full_address, rx, ry, source."""
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS address_id", "c_name AS full_address", "((c_custkey * 15485863) % 100003) / 100.0D AS rx", "((c_custkey * 32452843) % 99991) / 100.0D AS ry", "c_mktsegment AS source",
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile_id, xmin, ymin, xmax, ymax of the tiles that hold points."""
    t = points(spark, sf_dir).select(F.floor(F.col("x") / TILE).alias("i"), F.floor(F.col("y") / TILE).alias("j"), "tile_id").distinct()
    return t.select("tile_id", (F.col("i") * TILE).alias("xmin"), (F.col("j") * TILE).alias("ymin"), ((F.col("i") + 1) * TILE).alias("xmax"), ((F.col("j") + 1) * TILE).alias("ymax"))


#: The same tables for DuckDB; every oracle starts with them.
SQL = """WITH points AS (
  SELECT *, CAST(CAST(floor(x / 250) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(y / 250) AS BIGINT) AS VARCHAR) AS tile_id FROM (
    SELECT ((l_orderkey * 8 + l_linenumber) * 2000000 + l_partkey) * 100000 + l_suppkey AS point_id,
      CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 613) % 100003 AS DOUBLE) / 100 AS x,
      CAST((l_orderkey * 611953 + l_suppkey * 15485863 + l_partkey * 31) % 99991 AS DOUBLE) / 100 AS y,
      l_quantity AS z, CASE l_returnflag WHEN 'A' THEN 6 WHEN 'N' THEN 2 ELSE 1 END AS classification,
      CAST((l_orderkey * 31 + l_linenumber * 17 + l_suppkey) % 400 AS DOUBLE) / 10 AS hag,
      CASE WHEN l_suppkey % 10 = 0 THEN 'ftUS' ELSE 'm' END AS z_unit
    FROM lineitem)),
footprints AS (
  SELECT *, hw * hh * 4 AS area_m2, CAST(CAST(floor(cx / 250) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(cy / 250) AS BIGINT) AS VARCHAR) AS tile_id FROM (
    SELECT p_partkey AS cluster_id, CAST((p_partkey * 15485863) % 100003 AS DOUBLE) / 100 AS cx, CAST((p_partkey * 32452843) % 99991 AS DOUBLE) / 100 AS cy,
      CAST(2 + p_size % 9 AS DOUBLE) AS hw, CAST(2 + p_size % 7 AS DOUBLE) AS hh, p_brand AS method, split_part(p_type, ' ', 1) AS provenance, p_size, p_retailprice FROM part)),
addresses AS (
  SELECT c_custkey AS address_id, c_name AS full_address, CAST((c_custkey * 15485863) % 100003 AS DOUBLE) / 100 AS rx, CAST((c_custkey * 32452843) % 99991 AS DOUBLE) / 100 AS ry, c_mktsegment AS source FROM customer),
tiles AS (
  SELECT DISTINCT tile_id, floor(x / 250) * 250 AS xmin, floor(y / 250) * 250 AS ymin, floor(x / 250) * 250 + 250 AS xmax, floor(y / 250) * 250 + 250 AS ymax FROM points),
inside AS (
  SELECT p.*, f.cluster_id, f.area_m2, f.cx, f.cy, f.hw, f.hh FROM points p JOIN footprints f
  ON p.x >= cx - hw AND p.x < cx + hw AND p.y >= cy - hh AND p.y < cy + hh)
"""
