"""Heights of buildings from points: inside percentiles, ground levels and what supports them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crowds as X
from .spatial_join import nearest_join


@dataclass(frozen=True)
class Heights:
    """Parameters of the zonal heights; the variants differ in these alone."""

    percentiles: tuple[float, ...] = (0.9,)
    least_height: float = 1.5
    fallback_height: float | None = 6.0
    good: int = 8
    ring: float = 5.0
    relative: bool = False
    none_quality: str = "fallback"


def inside_statistics(points: DataFrame, footprints: DataFrame, h: Heights) -> DataFrame:
    inside = X.counts_inside(points.select("x", "y", "z"), footprints.select("cluster_id", "ring"), "cluster_id")
    return inside.groupBy("cluster_id").agg(
        F.sum("n").alias("n_inside"), F.min("z").alias("min_z_inside"), F.max("z").alias("height_max"),
        *(F.percentile("z", F.lit(p), F.col("n")).alias(f"p{round(100 * p)}") for p in h.percentiles),
    )


def _median(counts: DataFrame) -> DataFrame:
    """Percentiles are those of counted heights."""
    return counts.groupBy("cluster_id").agg(F.percentile("z", F.lit(0.5), F.col("n")).alias("ground_z"), F.sum("n").alias("n_ground"))


def ground_in_circle(points: DataFrame, footprints: DataFrame, ring: float) -> DataFrame:
    """cluster_id, ground_z: median ground height within half the box diagonal plus twice the ring of the centre."""
    ground = points.where("classification = 2").select("x", "y", "z")
    circles = footprints.select("cluster_id", F.col("cx").alias("rx"), F.col("cy").alias("ry"), (F.hypot("hw", "hh") + 2 * ring).alias("r"))
    return _median(X.counts_in_circles(ground, circles, "cluster_id"))


def ground_in_ring(points: DataFrame, footprints: DataFrame, ring: float) -> DataFrame:
    """cluster_id, ground_z: median ground height outside the footprint within `ring` of its sides."""
    ground = points.where("classification = 2").select("x", "y", "z")
    return _median(X.counts_around(ground, footprints.select("cluster_id", "ring"), "cluster_id", ring))


def zonal_heights(points: DataFrame, footprints: DataFrame, h: Heights = Heights(), ground: DataFrame | None = None) -> DataFrame:
    """One row for each footprint: counts, percentiles, ground, estimated height and source quality.

    Without points inside, the height is the fallback (null if there is none). Without ground nearby, the tile's median."""
    stats = inside_statistics(points, footprints, h)
    ground = ground_in_circle(points, footprints, h.ring) if ground is None else ground
    by_tile = points.where("classification = 2").groupBy("tile_id").agg(F.percentile("z", F.lit(0.5)).alias("tile_ground"))
    out = footprints.join(stats, "cluster_id", "left").join(ground, "cluster_id", "left").join(by_tile, "tile_id", "left")
    out = out.withColumns({"n_inside": F.coalesce("n_inside", F.lit(0)), "ground_z": F.coalesce("ground_z", "tile_ground", F.lit(0.0))})
    top = f"p{round(100 * max(h.percentiles))}"
    some = F.col("n_inside") > 0
    height = F.when(some, F.greatest(F.lit(h.least_height), F.col(top) - F.col("ground_z"))).otherwise(F.lit(h.fallback_height).cast("double"))
    quality = F.when(F.col("n_inside") >= h.good, "good").when(some, "sparse").otherwise(h.none_quality)
    out = out.withColumns({"estimated_height": height, "source_quality": quality, "rooftop_gap_m": F.round(F.col("min_z_inside") - F.col("ground_z"), 3)})
    if h.relative:
        out = out.withColumns({f"p{round(100 * p)}": F.col(f"p{round(100 * p)}") - F.col("ground_z") for p in h.percentiles})
    return out.drop("tile_ground")


def rooftop_candidate(gap: float = 8.0, area: float = 400.0, height: float = 10.0):
    """gap above, area below, height above; null gaps are no candidates."""
    return F.coalesce((F.col("rooftop_gap_m") > gap) & (F.col("area_m2") < area) & (F.col("estimated_height") > height), F.lit(False))


def with_nearest_address(structures: DataFrame, addresses: DataFrame, radius: float) -> DataFrame:
    """structures with address_id, full_address, address_dist and match_status."""
    out = nearest_join(structures, addresses.select("address_id", "full_address", "rx", "ry"), radius, "cluster_id", "address_id", "cx", "cy")
    return out.drop("rx", "ry").withColumnRenamed("dist", "address_dist").withColumn("match_status", F.when(F.col("address_id").isNotNull(), "matched").otherwise("unmatched"))
