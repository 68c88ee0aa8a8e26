"""Tiles: manifests, file lists, seams, unions over tiles, meshes of several objects in one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

from .quantiles import least_of


def near_city(box: Column, city: Column, margin: float = 5.0) -> Column:
    """struct<ok, reason>: whether the centre of a box is within `margin` degrees of the city's; null boxes aren't."""
    mid = lambda b, a, c: (b[a] + b[c]) / 2
    dx, dy = F.abs(mid(box, "xmin", "xmax") - mid(city, "xmin", "xmax")), F.abs(mid(box, "ymin", "ymax") - mid(city, "ymin", "ymax"))
    ok = F.coalesce((dx <= margin) & (dy <= margin), F.lit(False))
    return F.struct(ok.alias("ok"), F.when(ok, "ok").when(dx.isNull(), "no box").otherwise(F.format_string("centre is %.2f, %.2f degrees off", dx, dy)).alias("reason"))


def manifest_rows(catalog: DataFrame, disk: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row for each file of catalog(filename, tile_id, url, box) and disk(filename, size_bytes); the catalog's words win, sizes come
    from inventory(filename, size_mb), else from the disk."""
    c = catalog.withColumn("_c", F.lit(True))
    d = disk.select("filename", "size_bytes", F.lit(True).alias("_d"))
    j = c.join(d, "filename", "full").join(inventory.select("filename", F.col("size_mb").alias("_mb")), "filename", "left")
    size = F.coalesce("_mb", F.round(F.col("size_bytes") / 1048576, 2))
    return j.select(F.coalesce("tile_id", S.tile_id(F.col("filename"))).alias("tile_id"), "filename", "url", "box", F.coalesce("_d", F.lit(False)).alias("on_disk"), size.alias("size_mb"), F.coalesce("_c", F.lit(False)).alias("in_catalog"))


def resolved_urls(tiles: DataFrame, listing: DataFrame) -> DataFrame:
    """tiles with the url of their filename (the least where a listing has several) and whether there is one."""
    urls = listing.groupBy("filename").agg(F.min("url").alias("url"))
    return tiles.drop("url").join(urls, "filename", "left").withColumn("resolved", F.col("url").isNotNull())


def crossing_cluster(clusters: DataFrame, seam: float, x: float, y: float) -> DataFrame:
    """One row: of clusters(cluster_id, min_y, max_y, point_count, cx, cy) that cross the line y = seam the one with the most points,
    else the one nearest to (x, y)."""
    crosses = F.lit(seam).between(F.col("min_y"), F.col("max_y"))
    dist = F.hypot(F.col("cx") - x, F.col("cy") - y)
    best = clusters.withColumns({"crosses": crosses, "dist": dist}).agg(
        F.max_by("cluster_id", F.when(F.col("crosses"), F.struct("point_count", (-F.col("cluster_id")).alias("i")))).alias("a"), F.min_by("cluster_id", F.struct("dist", "cluster_id")).alias("b"), F.bool_or("crosses").alias("crosses")
    )
    return best.select(F.coalesce("a", "b").alias("cluster_id"), F.coalesce("crosses", F.lit(False)).alias("crosses"))


def viewer_manifest(tiles: DataFrame, assets: DataFrame, structures: DataFrame, masses: DataFrame, cut, side: float = 1523.5, columns: int = 10) -> DataFrame:
    """Tiles in order of their ids with what exists of them, the greatest of the known building counts, and bounds: those of the asset,
    else inferred from the tile's place in a grid of `columns`. tiles(tile_id, n_manifest), assets(tile_id, xmin..zmax),
    structures(tile_id, n_structures), masses(tile_id, n_masses).

    Places are numbered over ranges of ids, without one task for all."""
    placed = numbered(tiles, "tile_id", cut).withColumn("_i", F.col("row") - 1)
    j = placed.join(assets.withColumn("has_asset", F.lit(True)), "tile_id", "left").join(structures, "tile_id", "left").join(masses, "tile_id", "left")
    x0, z1 = (F.col("_i") % columns) * side, -F.floor(F.col("_i") / columns) * side
    guess = {"xmin": x0, "xmax": x0 + side, "zmin": z1 - side, "zmax": z1}
    out = j.withColumns({"inferred": F.col("xmin").isNull(), **{k: F.coalesce(k, v) for k, v in guess.items()}, "has_asset": F.coalesce("has_asset", F.lit(False))})
    return out.withColumn("building_count", F.greatest(F.coalesce(F.greatest("n_structures", "n_masses", "n_manifest"), F.lit(0)), F.lit(0))).drop("_i", "row")


def numbered(df: DataFrame, order: str, cut) -> DataFrame:
    """df with row, the place of each row from 1 in order: rows are dealt by ranges, numbered in each, and raised by what comes before.
    cut writes a DataFrame and gives it back without its lineage, so that the ranges stay."""
    ranged = cut(df.repartitionByRange(order).withColumn("_p", F.spark_partition_id()), "numbered")
    n = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = n.withColumn("_b", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = F.row_number().over(W.partitionBy("_p").orderBy(order))
    return ranged.withColumn("_r", own).join(F.broadcast(before), "_p").withColumn("row", F.col("_b") + F.col("_r")).drop("_p", "_b", "_r")  # a row for each partition


def every(df: DataFrame, order: str, step: int, cut) -> DataFrame:
    """Each step-th row in order, from the first."""
    return numbered(df, order, cut).where((F.col("row") - 1) % step == 0).drop("row")


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """df in order, of which a caller may want n rows only (a limit that they set)."""
    out = df.orderBy(*order)
    return out if n is None else out.limit(n)


def all_tiles(tables: dict[str, DataFrame], priority: dict[str, int] | None = None, key: str | None = None) -> DataFrame:
    """Rows of all tables with tile_id, the table's name; columns that a table lacks are null. With key, of rows with equal keys the one
    of the table of the least priority (then the least name) stays."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("tile_id", F.lit(name)) for name, df in tables.items()))
    if key is None:
        return out
    rank = S.lookup(F.col("tile_id"), {k: str(v) for k, v in (priority or {}).items()}, str(1 << 30)).cast("long")
    best = out.groupBy(key).agg(F.min_by(F.struct(*out.columns), F.struct(rank, "tile_id")).alias("r"))
    return best.select("r.*")


def around_seed(seed_x: int, seed_y: int, reach: int, have: DataFrame, quarters: tuple[str, ...] = ("a", "b", "c", "d"), step: int = 3) -> DataFrame:
    """(tile_id, x, y, quarter, present) of the tiles up to `reach` steps around a seed; present by have(tile_id)."""
    span = F.sequence(F.lit(-reach), F.lit(reach))
    grid = have.sparkSession.range(1).select(F.explode(span).alias("i")).select("i", F.explode(span).alias("j")).select("i", "j", F.explode(F.array(*map(F.lit, quarters))).alias("quarter"))
    t = grid.select((seed_x + F.col("i") * step).alias("x"), (seed_y + F.col("j") * step).alias("y"), "quarter").withColumn("tile_id", F.concat(F.col("x").cast("string"), F.lit("_"), F.col("y").cast("string"), "quarter"))
    return t.join(have.select("tile_id").distinct().withColumn("present", F.lit(True)), "tile_id", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def fans(faces: DataFrame, key: list[str], corners: str = "corners") -> DataFrame:
    """(key, triangle, a, b, c, normal): triangles of faces with corners array<struct<x, y, z>>, all around the first corner, with the
    face's normal (0, 0, 1 for faces without area)."""
    p = F.col(corners)
    nxt = F.concat(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, 1))
    total = lambda f: F.aggregate(F.zip_with(p, nxt, f), F.lit(0.0), lambda s, v: s + v)
    n = [total(lambda a, b: (a["y"] - b["y"]) * (a["z"] + b["z"])), total(lambda a, b: (a["z"] - b["z"]) * (a["x"] + b["x"])), total(lambda a, b: (a["x"] - b["x"]) * (a["y"] + b["y"]))]
    length = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
    flat = length <= 1e-9
    normal = F.named_struct(*(c for k, v in enumerate(n) for c in (F.lit("xyz"[k]), F.when(flat, float(k == 2)).otherwise(v / F.nullif(length, F.lit(0.0))))))
    t = faces.where(F.size(p) > 2).select(*key, p.alias("_p"), normal.alias("normal"), F.explode(F.sequence(F.lit(1), F.size(p) - 2)).alias("triangle"))
    return t.select(*key, "triangle", F.col("_p")[0].alias("a"), F.get("_p", F.col("triangle")).alias("b"), F.get("_p", F.col("triangle") + 1).alias("c"), "normal")


def merged_meshes(vertices: DataFrame, faces: DataFrame, cut) -> tuple[DataFrame, DataFrame]:
    """vertices(object_id, v, ...) and faces(object_id, f, indices) of many objects as one mesh: v and indices raised by the vertices of
    the objects before, in order of ids. Only objects are counted in order, not vertices."""
    n = numbered(vertices.groupBy("object_id").agg(F.count("*").alias("n")), "object_id", cut)
    # Sums of what comes before, by blocks of objects: within a block, then over blocks.
    block = F.floor(F.col("row") / 100_000)
    inner = F.coalesce(F.sum("n").over(W.partitionBy(block).orderBy("row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = n.groupBy(block.alias("_k")).agg(F.sum("n").alias("m"))
    before = blocks.withColumn("_b", F.coalesce(F.sum("m").over(W.orderBy("_k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_k", "_b")
    offset = n.withColumns({"_k": block, "_i": inner}).join(F.broadcast(before), "_k").select("object_id", (F.col("_i") + F.col("_b")).alias("_off"))  # a row for 100,000 objects
    v = vertices.join(offset, "object_id").withColumn("v", F.col("v") + F.col("_off")).drop("_off")
    f = faces.join(offset, "object_id").withColumn("indices", F.transform("indices", lambda i: i + F.col("_off"))).drop("_off")
    return v, f


def tile_index(tiles: DataFrame, files: DataFrame) -> DataFrame:
    """(tile_id, n_files, bytes, assets) of tiles with their exported files(tile_id, kind, path, size_bytes); assets maps kinds to paths."""
    per = files.groupBy("tile_id").agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("bytes"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "path")))).alias("assets"))
    return tiles.select("tile_id").join(per, "tile_id", "left").withColumns({"n_files": F.coalesce("n_files", F.lit(0)), "bytes": F.coalesce("bytes", F.lit(0))})


def footprint_sources(footprints: DataFrame) -> DataFrame:
    """One row for each city_id of footprints(city_id, tile_id, method, box): tiles, the commonest method of tiles (each by its own
    commonest; ties to the name), footprints without a box, three tiles without any box."""
    per = footprints.groupBy("city_id", "tile_id", "method").agg(F.count("*").alias("n"), F.count_if(F.col("box").isNull()).alias("n_null"))
    tile = per.groupBy("city_id", "tile_id").agg(F.min_by("method", F.struct((-F.col("n")).alias("n"), "method")).alias("mode"), F.sum("n").alias("n"), F.sum("n_null").alias("n_null"))
    mode = tile.groupBy("city_id", "mode").agg(F.count("*").alias("t")).groupBy("city_id").agg(F.min_by("mode", F.struct((-F.col("t")).alias("t"), "mode")).alias("mode"))
    empty = F.when(F.col("n") == F.col("n_null"), F.col("tile_id"))
    g = tile.groupBy("city_id").agg(F.count("*").alias("n_tiles"), F.sum("n").alias("n_footprints"), F.sum("n_null").alias("n_without_box"))
    samples = least_of(tile.withColumn("_empty", empty), "city_id", "_empty")
    return g.join(mode, "city_id").join(samples, "city_id", "left").withColumn("samples", F.coalesce("samples", F.array().cast("array<string>")))


def city_audit(raw: DataFrame, expected: DataFrame, structures: DataFrame, addresses: DataFrame) -> DataFrame:
    """One row: raw, expected and missing tiles, structures, addresses, and warnings on what doesn't fit."""
    missing = expected.select("tile_id").join(raw.select("tile_id"), "tile_id", "left_anti")
    one = lambda d, name: d.agg(F.count("*").alias(name))
    out = one(raw, "n_raw")
    for d, name in ((expected, "n_expected"), (missing, "n_missing"), (structures, "n_structures"), (addresses, "n_addresses")):
        out = out.join(F.broadcast(one(d, name)))  # one row each
    rules = {"missing_tiles": F.col("n_missing") > 0, "no_structures": F.col("n_structures") == 0, "no_addresses": F.col("n_addresses") == 0, "few_addresses": F.col("n_addresses") * 2 < F.col("n_structures")}
    return out.withColumn("warnings", F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))))
