"""Two building layers side by side, boxes of layers, companions of files, and what happened to claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spatial_join import nearest_join

#: Files that a shape file needs beside it, and those that it should have.
REQUIRED = (".dbf", ".shp", ".shx")
RECOMMENDED = (".cpg", ".prj")


def compare_layers(left: DataFrame, right: DataFrame, radius: float = 20.0) -> DataFrame:
    """(left_id, right_id, status, dist, height_diff, area_ratio) of left(left_id, x, y, height, area) and right(right_id, rx, ry,
    right_height, right_area): each left building with its nearest right one within radius (matched) or none (no_match), and each
    right building that no left one took (right_only).

    Differences and ratios are left against right, null where a side has none or the area is 0. A right building may be taken more
    than once; ties go to the least id."""
    near = nearest_join(left, right, radius, "left_id", "right_id", "x", "y")
    ratio = F.when((F.col("area") != 0) & (F.col("right_area") > 0), F.round(F.col("area") / F.col("right_area"), 3))
    out = near.select(
        "left_id", "right_id", F.when(F.col("right_id").isNotNull(), "matched").otherwise("no_match").alias("status"), F.round("dist", 2).alias("dist"),
        F.round(F.col("height") - F.col("right_height"), 2).alias("height_diff"), ratio.alias("area_ratio"),
    )
    alone = right.select("right_id").join(out.select("right_id").distinct(), "right_id", "left_anti")
    return out.unionByName(alone.withColumn("status", F.lit("right_only")), allowMissingColumns=True)


def comparison_summary(compared: DataFrame) -> DataFrame:
    """One row: how many of each status, and least, greatest and mean height difference of the matched."""
    n = {s: F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("matched", "no_match", "right_only")}
    d = F.col("height_diff")
    return compared.agg(*n.values(), F.min(d).alias("least_diff"), F.max(d).alias("greatest_diff"), F.round(F.avg(d), 6).alias("mean_diff"))


def layer_box(features: DataFrame, x: str = "x", y: str = "y", by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """(by, n, box) of features with finite coordinates; a layer without any has no row, or, without by, a null box."""
    good = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    ends = {"xmin": F.min(x), "ymin": F.min(y), "xmax": F.max(x), "ymax": F.max(y)}
    box = F.when(F.count("*") > 0, F.struct(*(F.round(v, digits).alias(k) for k, v in ends.items())))
    return features.where(good(x) & good(y)).groupBy(*(by or [])).agg(F.count("*").alias("n"), box.alias("box"))


def file_parts(path: Column) -> Column:
    """struct<folder, stem, suffix, kind> of a path, the last three in lower case; kind is the suffix, but for .copc.laz, which is .laz."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    suffix = F.regexp_extract(name, r".(\.[^.]*)$", 1)
    return F.struct(
        F.regexp_replace(path, "/?[^/]*$", "").alias("folder"), F.substring(name, F.lit(1), F.length(name) - F.length(suffix)).alias("stem"), suffix.alias("suffix"),
        F.when(name.endswith(".copc.laz"), ".laz").otherwise(suffix).alias("kind"),
    )


def companion_sets(files: DataFrame, path: str = "path", main: str = ".shp", required: tuple[str, ...] = REQUIRED, recommended: tuple[str, ...] = RECOMMENDED) -> DataFrame:
    """(folder, stem, present, missing_required, missing_recommended, ok) of each main file: which of its companions, files of the same
    folder and stem, are there. Upper and lower case are the same; repeated paths count once."""
    p = files.select(file_parts(F.col(path)).alias("p")).select("p.*")
    sets = p.groupBy("folder", "stem").agg(F.array_sort(F.collect_set("suffix")).alias("present")).where(F.array_contains("present", main))  # a few suffixes
    lost = lambda wanted: F.array_sort(F.array_except(F.array(*map(F.lit, wanted)), F.col("present")))
    out = sets.withColumns({"missing_required": lost(required), "missing_recommended": lost(recommended)})
    return out.withColumn("ok", F.size("missing_required") == 0)


def files_by_kind(files: DataFrame, path: str = "path") -> DataFrame:
    """(kind, n) of files by suffix."""
    return files.groupBy(file_parts(F.col(path))["kind"].alias("kind")).agg(F.count("*").alias("n"))


def claim_history(versions: DataFrame, key: str, order: list[str], status: str = "status") -> DataFrame:
    """(versions' columns, previous_status, event_type): versions of claims in order of each key that changed something. The first is
    created, whatever its status; a new status is released, revoked or status_changed; versions of equal status are left out. Null
    is a status of its own."""
    w = W.partitionBy(key).orderBy(*order)
    known = versions.withColumns({"_n": F.row_number().over(w), "previous_status": F.lag(status).over(w)})
    event = F.when(F.col("_n") == 1, "created").when(~F.col(status).eqNullSafe(F.col("previous_status")), F.when(F.col(status).isin("released", "revoked"), F.col(status)).otherwise("status_changed"))
    return known.withColumn("event_type", event).where("event_type IS NOT NULL").drop("_n")
