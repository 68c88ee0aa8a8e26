"""Feature collections, addresses, records and file inventories; sinks for tables, features and manifests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import geometry as G

LON = ("longitude", "long", "lon", "x")
LAT = ("latitude", "lat", "y")


def read_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(type, coordinates as JSON text, properties) for each feature of FeatureCollections, or of one feature a line.

    A collection is one record and can't be split; large inputs should come as lines."""
    feature = "struct<type:string,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"
    if lines:
        rows = spark.read.schema("type string, geometry struct<type:string,coordinates:string>, properties map<string,string>").json(path)
        return rows.select("geometry.type", "geometry.coordinates", "properties")
    rows = spark.read.schema(f"features array<{feature}>").option("multiLine", True).json(path)
    return rows.select(F.explode("features").alias("f")).select("f.geometry.type", "f.geometry.coordinates", "f.properties")


def ring_of(kind: F.Column, coordinates: F.Column) -> F.Column:
    """The outer ring of a polygon, of a multipolygon the largest part's; null for other geometries."""
    points = lambda c: F.transform(c, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    single = points(F.from_json(coordinates, "array<array<array<double>>>")[0])
    parts = F.transform(F.from_json(coordinates, "array<array<array<array<double>>>>"), lambda p: F.struct(G.area(points(p[0])).alias("a"), points(p[0]).alias("r")))
    return F.when(kind == "Polygon", single).when(kind == "MultiPolygon", F.array_max(parts)["r"])


def representative_point(kind: F.Column, coordinates: F.Column) -> F.Column:
    """A point itself; of lines and polygons the mean of the first ring's vertices, a closing one counted."""
    p = F.from_json(coordinates, "array<double>")
    line = F.from_json(coordinates, "array<array<double>>")
    mean = lambda c: G.vertex_mean(F.transform(c, lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))))
    return (
        F.when(kind == "Point", F.struct(p[0].alias("x"), p[1].alias("y")))
        .when(kind.isin("LineString", "MultiPoint"), mean(line))
        .otherwise(G.vertex_mean(ring_of(kind, coordinates)))
    )


def read_address_csv(spark: SparkSession, path: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Address rows with lon and lat, whose columns are found by name; rows without numbers or off the globe are dropped."""
    raw = spark.read.option("header", True).csv(path)
    named = {c.lower(): c for c in raw.columns}
    find = lambda names: next((named[n] for n in names if n in named), None)
    lon, lat = find(LON), find(LAT)
    if lon is None or lat is None:
        raise ValueError(f"{path} has no coordinate columns: {raw.columns}")
    out = raw.withColumns({"lon": F.col(lon).try_cast("double"), "lat": F.col(lat).try_cast("double")})
    for new, old in (fields or {}).items():
        out = out.withColumn(new, F.col(old))
    return out.where(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90))


def deduplicated(addresses: DataFrame) -> DataFrame:
    """First address of each (lon, lat to 4 decimals, house number, first 40 letters of the street) by address_id."""
    key = [F.round("lon", 4).alias("_1"), F.round("lat", 4).alias("_2"), F.coalesce("house_number", F.lit("")).alias("_3"), F.substring(F.coalesce("street", F.lit("")), 1, 40).alias("_4")]
    return addresses.groupBy(*key).agg(F.min_by(F.struct(*addresses.columns), "address_id").alias("a")).select("a.*")


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, name, extension, size and time of all files below path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size_bytes"), "modificationTime")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("extension"), "size_bytes", F.col("modificationTime").alias("modified"))


def load_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON array, of one object a line, or of a collection under features, buildings or records."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    lines = spark.read.schema(schema).json(path)
    kind = text.select(F.when(F.col("v").startswith("["), "array").when(F.col("v").rlike(r'^\{\s*"(type|features|buildings|records)"') & F.col("v").rlike('"(features|buildings|records)"\\s*:'), "collection").otherwise("lines").alias("k")).first()
    if kind is None or kind["k"] == "lines":
        return lines
    if kind["k"] == "array":
        return spark.read.schema(schema).option("multiLine", True).json(path)
    holder = spark.read.schema(f"features array<struct<properties:struct<{_nested(schema)}>>>, buildings array<struct<{_nested(schema)}>>, records array<struct<{_nested(schema)}>>").option("multiLine", True).json(path)
    rows = holder.select(F.explode(F.coalesce("buildings", "records", F.transform("features", lambda f: f["properties"]))).alias("r"))
    return rows.select("r.*")


def _nested(schema: str) -> str:
    return ",".join(f"{name}:{kind}" for name, kind in (field.strip().split(" ", 1) for field in schema.split(", ")))


def any_point(kind: F.Column, coordinates: F.Column) -> F.Column:
    """Mean of all vertices of a geometry of any depth (closing ones counted), a point itself; null without vertices."""
    pairs = F.regexp_extract_all(coordinates, F.lit(r"\[\s*(-?[0-9][^\[\],]*,\s*-?[0-9][^\[\],]*)"), F.lit(1))
    xy = F.transform(pairs, lambda p: F.struct(F.trim(F.split(p, ",")[0]).try_cast("double").alias("x"), F.trim(F.split(p, ",")[1]).try_cast("double").alias("y")))
    return F.when(kind.isNotNull() & (F.size(xy) > 0), G.vertex_mean(xy))


def read_layer(spark: SparkSession, path: str, to_xy: Callable[[F.Column, F.Column], F.Column] | None = None, lines: bool = False) -> tuple[DataFrame, F.Column]:
    """((x, y, properties, usable), a count of skipped features to aggregate with) of a layer with geometries of any kind.

    to_xy(x, y) gives struct<x, y> in the wanted reference system where the layer's differs. Features without a geometry, or whose
    point has no image, are kept with usable false, so that they can be counted in the job that drops them."""
    f = read_features(spark, path, lines).withColumn("_p", any_point(F.col("type"), F.col("coordinates")))
    at = to_xy(F.col("_p.x"), F.col("_p.y")) if to_xy else F.col("_p")
    rows = f.select(at["x"].alias("x"), at["y"].alias("y"), F.coalesce("properties", F.create_map().cast("map<string,string>")).alias("properties"))
    usable = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    return rows.withColumn("usable", usable), F.count_if(~F.col("usable"))


def read_mass_rows(spark: SparkSession, csv: str | None, features: str | None, fields: tuple[str, ...]) -> DataFrame:
    """A tile's mass rows as text columns: those of its table if there is one, else its features' properties, where a point stands in for
    a missing centroid_x and centroid_y. fields: the properties to take."""
    if csv:
        return spark.read.option("header", True).csv(csv)
    if not features:
        raise ValueError("neither a table nor features are given")
    p = F.from_json("coordinates", "array<string>")
    own = {c: F.col("properties")[c] for c in (*fields, "centroid_x", "centroid_y")}
    for i, c in enumerate(("centroid_x", "centroid_y")):
        own[c] = F.when((F.col("type") == "Point") & (F.size(p) > 1) & ~F.coalesce(F.map_contains_key("properties", c), F.lit(False)), F.get(p, i)).otherwise(own[c])
    return read_features(spark, features).select(*(v.alias(c) for c, v in own.items()))


def load_findings(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Findings of a JSON array, of one object a line (.jsonl, or a folder of such), or under findings, validation_findings or issues."""
    if path.endswith((".jsonl", ".ndjson")):
        return spark.read.schema(schema).json(path)
    keys = ("findings", "validation_findings", "issues")
    holder = spark.read.schema(", ".join(f"{k} array<struct<{_nested(schema)}>>" for k in keys)).option("multiLine", True).json(path)
    own = spark.read.schema(schema).option("multiLine", True).json(path)
    names = own.columns
    held = holder.where(F.coalesce(*keys).isNotNull()).select(F.explode(F.coalesce(*keys)).alias("r")).select("r.*")
    return held.unionByName(own.where(" OR ".join(f"`{c}` IS NOT NULL" for c in names)))


def write_table(df: DataFrame, path: str) -> None:
    """The same rows twice: CSV with a header below path/csv (nested columns as JSON), JSON below path/json."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/json")


def write_features(df: DataFrame, path: str, ring: str = "ring") -> None:
    """One GeoJSON feature a line: the ring as a closed polygon, all other columns as properties."""
    closed = F.transform(F.concat(F.col(ring), F.slice(ring, 1, 1)), lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*(c for c in df.columns if c != ring)).alias("properties"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def write_by_tile(df: DataFrame, path: str, keys: tuple[str, ...] = ("city_id", "tile_id")) -> None:
    """Parquet by tile; only the tiles that df has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def unfinished(tiles: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("city_id", "tile_id")) -> DataFrame:
    return tiles.join(done.select(*keys).distinct(), list(keys), "left_anti")


def write_layers(matched: DataFrame, path: str) -> None:
    """Rows with a match, one folder for each layer."""
    matched.where(F.col("matched")).write.mode("overwrite").partitionBy("layer_id").parquet(path)


def manifest(tiles: DataFrame, totals: dict[str, F.Column]) -> DataFrame:
    """One row: totals, and a map of tile_id to its other columns. Tiles of one city, a bounded number."""
    rest = F.struct(*(c for c in tiles.columns if c != "tile_id"))
    return tiles.agg(*(v.alias(k) for k, v in totals.items()), F.map_from_entries(F.sort_array(F.collect_list(F.struct("tile_id", rest.alias("t"))))).alias("tiles"))
