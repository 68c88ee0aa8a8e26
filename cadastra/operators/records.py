"""Rows that leave the library: detail flags, metric twins, export and enrichment records, named places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as G

# Source qualities that a detail level leaves out, and the height of a building that has none.
LOD0_WITHOUT = ("empty", "fallback")
LOD1_WITHOUT = ("empty",)
NO_HEIGHT = 6.0


def with_lod(df: DataFrame, quality: str = "source_quality") -> DataFrame:
    """df with lod0_included and lod1_included; a null quality is included."""
    out = lambda names: F.coalesce(~F.col(quality).isin(*names), F.lit(True))
    return df.withColumns({"lod0_included": out(LOD0_WITHOUT), "lod1_included": out(LOD1_WITHOUT)})


def with_metric_twins(df: DataFrame, columns: tuple[str, ...], metric: Column) -> DataFrame:
    """df with <column>_m for each column: its value where `metric` holds, else null."""
    return df.withColumns({f"{c}_m": F.when(metric, F.col(c)) for c in columns})


def land_and_water(points: DataFrame, level: float) -> DataFrame:
    """points with is_land: z at or above the level; null heights are neither."""
    return points.withColumn("is_land", F.col("z") >= level)


def in_place(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a point is in (xmin, ymin, xmax, ymax), sides included; false for null."""
    return F.coalesce(x.between(box[0], box[2]) & y.between(box[1], box[3]), F.lit(False))


def export_records(rows: DataFrame, geometries: DataFrame, shift_x: float, shift_y: float) -> DataFrame:
    """id, h, cx, cy, quality, lod0 of rows(cluster_id, estimated_height, source_quality, lod0_included): heights and local centroids to two
    decimals. Rows without a number for an id or with a height that is no number are skipped; a null or empty height is 0. A row without
    a ring in geometries(cluster_id, ring) is an error, never a building at the origin."""
    text = F.trim(F.col("estimated_height").cast("string"))
    height = F.when(text.isNull() | (text == ""), 0.0).otherwise(text.try_cast("double"))
    named = rows.withColumns({"id": F.col("cluster_id").cast("string").try_cast("double").cast("long"), "h": height}).where("id IS NOT NULL AND h IS NOT NULL")
    rings = geometries.where(F.size("ring") > 0).select(F.col("cluster_id").cast("long").alias("id"), "ring")
    lost = F.raise_error(F.concat(F.lit("no footprint geometry for cluster_id "), F.col("id").cast("string"))).cast("double")
    centre = G.centroid(F.col("ring"))
    at = lambda c, shift: F.when(F.col("ring").isNull(), lost).otherwise(F.round(centre[c] - shift, 2))
    lod0 = F.coalesce(F.lower(F.col("lod0_included").cast("string")).isin("true", "1"), F.lit(False))
    return named.join(rings, "id", "left").select("id", F.round("h", 2).alias("h"), at("x", shift_x).alias("cx"), at("y", shift_y).alias("cy"), F.coalesce("source_quality", F.lit("unknown")).alias("quality"), lod0.alias("lod0"))


def enrichment_records(footprints: DataFrame, masses: DataFrame, city: str, zone: int) -> DataFrame:
    """A record for each cluster of footprints(cluster_id, cx, cy, county_height_m, bld_type, year_update) or masses(cluster_id, height_m,
    footprint_area_m2, quality): the mass's height, else the county's, else NO_HEIGHT (zero counts as none). lat and lon are null for a
    cluster without a footprint; rows with a null cluster_id are left out."""
    j = footprints.where("cluster_id IS NOT NULL").join(masses.where("cluster_id IS NOT NULL"), "cluster_id", "full")
    some = lambda c: F.nullif(F.col(c).cast("double"), F.lit(0.0))
    at = G.from_utm(F.col("cx"), F.col("cy"), zone)
    return j.select(
        F.col("cluster_id").alias("id"), F.lit(city).alias("city"), at["lat"].alias("lat"), at["lon"].alias("lon"), F.round(F.coalesce(some("height_m"), some("county_height_m"), F.lit(NO_HEIGHT)), 1).alias("height_m"),
        F.round(F.coalesce("footprint_area_m2", F.lit(0.0)), 1).alias("area_m2"), F.coalesce("bld_type", F.lit("")).alias("county_type"), "year_update", F.coalesce("quality", F.lit("")).alias("quality"),
    )


def with_enrichment(rows: DataFrame, enriched: DataFrame, tile_id: str) -> DataFrame:
    """rows(cluster_id) with the columns of the tile's enriched rows, joined by cluster; of several rows of one cluster the one that sorts last."""
    fields = [c for c in enriched.columns if c not in ("tile_id", "cluster_id")]
    own = enriched.where((F.col("tile_id") == tile_id) & F.col("cluster_id").isNotNull()).groupBy("cluster_id").agg(F.max(F.struct(*fields)).alias("enriched"))
    return rows.join(own, "cluster_id", "left")
