"""Checks of manifests, packages, downloads, steps and artefacts: reasons as arrays, or rows of what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

#: First bytes by extension.
MAGIC = {"parquet": b"PAR1", "glb": b"glTF", "png": b"\x89PNG", "zip": b"PK\x03\x04"}


def reasons(**rules: Column) -> Column:
    """Names of the rules whose condition holds, in the given order."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items())))


def tile_manifest(tiles: DataFrame, inventory: DataFrame) -> DataFrame:
    """tiles(tile_id, filename, on_disk, xmin .. ymax, size_bytes) with errors and warnings against inventory(filename, size)."""
    n = tiles.groupBy("tile_id").agg(F.count("*").alias("_n"))
    files = inventory.groupBy("filename").agg(F.max("size").alias("_size"))
    j = tiles.join(n, "tile_id", "left").join(files, "filename", "left")
    errors = reasons(
        no_id=F.trim(F.coalesce("tile_id", F.lit(""))) == "", duplicate_id=F.col("_n") > 1, no_filename=F.trim(F.coalesce("filename", F.lit(""))) == "",
        inverted_box=(F.col("xmin") > F.col("xmax")) | (F.col("ymin") > F.col("ymax")), missing_file=F.col("on_disk") & F.col("_size").isNull(), empty_file=F.col("_size") == 0,
    )
    warnings = reasons(no_box=F.col("xmin").isNull() | F.col("xmax").isNull(), not_marked=~F.col("on_disk") & F.col("_size").isNotNull(), size_differs=S.size_differs(F.col("_size").cast("double"), F.col("size_bytes").cast("double")))
    return j.withColumns({"errors": errors, "warnings": warnings}).select(*tiles.columns, "errors", "warnings")


def downloads(catalog: DataFrame, inventory: DataFrame) -> DataFrame:
    """(filename, status): ok, size_mismatch, missing or unlisted."""
    j = catalog.select("filename", F.col("size").alias("want"), F.lit(True).alias("_c")).join(inventory.select("filename", F.col("size").alias("have"), F.lit(True).alias("_i")), "filename", "full")
    status = F.when(F.col("_i").isNull(), "missing").when(F.col("_c").isNull(), "unlisted").when(S.size_differs(F.col("have").cast("double"), F.col("want").cast("double")), "size_mismatch").otherwise("ok")
    return j.select("filename", status.alias("status"))


def package_index(index: DataFrame, files: DataFrame, required: list[str]) -> DataFrame:
    """index(path, sha256, ...) with errors against files(path, sha256)."""
    j = index.join(files.select("path", F.col("sha256").alias("_have")), "path", "left")
    missing = {f"no_{c}": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in required}
    errors = reasons(**missing, forbidden_path=S.is_absolute_path(F.col("path")) | F.col("path").contains(".."), missing_file=F.col("_have").isNull(), bad_digest=~S.is_sha256(F.col("sha256")), digest_differs=F.col("_have") != F.col("sha256"))
    return j.withColumn("errors", errors).drop("_have")


def corrupt(files: DataFrame) -> DataFrame:
    """(path, reason) of files(path, length, content) that are empty, have wrong first bytes or don't parse as JSON."""
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    magic = F.create_map(*(F.lit(x) for k, v in MAGIC.items() for x in (k, bytearray(v))))[ext]
    bad_json = ext.isin("json", "geojson") & F.try_parse_json(F.col("content").cast("string")).isNull()
    reason = F.when(F.col("length") == 0, "empty").when(magic.isNotNull() & (F.substring("content", 1, 4) != magic), "wrong_magic").when(bad_json, "bad_json")
    return files.withColumn("reason", reason).where("reason IS NOT NULL").select("path", "reason")


def step_order(steps: Column, once: str, after: str, before: list[str]) -> Column:
    """Problems of an array of step names: `once` must occur exactly once, after `after` and ahead of all of `before`."""
    at = lambda s: F.array_position(steps, s)
    n = F.size(F.filter(steps, lambda s: s == once))
    late = [(at(b) > 0) & (at(once) > at(b)) for b in before]
    too_late = late[0]
    for c in late[1:]:
        too_late = too_late | c
    return reasons(missing=n == 0, repeated=n > 1, too_early=(n > 0) & (at(after) > at(once)), too_late=(n > 0) & too_late)


def distribution(associations: DataFrame, clusters: DataFrame) -> DataFrame:
    """cluster_id, n_associated, granularity over all clusters, zero included."""
    n = associations.groupBy("cluster_id").agg(F.count_distinct("objectid").alias("n"))
    c = F.coalesce("n", F.lit(0))
    return clusters.select("cluster_id").distinct().join(n, "cluster_id", "left").select("cluster_id", c.alias("n_associated"), F.when(c == 0, "none").when(c == 1, "one").when(c <= 5, "few").otherwise("many").alias("granularity"))


def primary_assignments(overlaps: DataFrame) -> DataFrame:
    """overlaps(objectid, cluster_id, area) with rank by area (ties to the lower cluster), candidates, tie and primary id."""
    from pyspark.sql import Window as W

    g = W.partitionBy("objectid")
    o = overlaps.where("area > 0").withColumns({"rank": F.row_number().over(g.orderBy(F.desc("area"), "cluster_id")), "candidates": F.count("*").over(g), "_top": F.max("area").over(g)})
    return o.withColumns({"tie": F.sum(F.when(F.col("area") == F.col("_top"), 1).otherwise(0)).over(g) > 1, "primary_id": F.min_by("cluster_id", "rank").over(g)}).drop("_top")
