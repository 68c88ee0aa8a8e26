"""Scalar functions on names, text, numbers and vocabularies, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: US survey foot in metres.
FOOT_US = 0.3048006096012192
#: Footprint source types and their provenance labels.
PROVENANCE = {
    "open_county": "open_county_footprint", "open_city": "open_city_footprint", "open_state": "open_state_footprint", "osm": "osm_footprint",
    "microsoft_ml": "unknown_unsafe_source", "unknown": "unknown_unsafe_source",
}
#: Words for units of height.
FEET_WORDS, METRE_WORDS = ("us survey foot", "us survey feet", "foot_us", "ftus"), ("metre", "meter", "metres", "meters")


def text(c: Column) -> Column:
    """Trimmed text, empty for null."""
    return F.trim(F.coalesce(c, F.lit("")))


def tile_id(filename: Column) -> Column:
    return F.regexp_replace(filename, r"(\.copc)?\.laz$", "")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(name)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def campaign(filename: Column) -> Column:
    """struct<campaign_group, detailed_prefix> of a file name: without extension, leading USGS_LPC_ and trailing tile numbers
    (a year of four digits stays) it is the prefix; the group is its first two parts ahead of a year, or its first part."""
    stem = F.regexp_replace(F.element_at(F.split(filename, "/"), -1), r"\.[^.]*$", "")
    prefix = F.regexp_replace(F.regexp_replace(stem, r"(?i)^usgs_lpc_", ""), r"(?:(?:^|_)(?![0-9]{4}(?:_|$))[0-9]+)+$", "")
    group = F.regexp_extract(prefix, r"^((?![0-9]{4}(?:_|$))[^_]+(?:_(?![0-9]{4}(?:_|$))[^_]+)?)", 1)
    first = F.split(prefix, "_")[0]
    empty = prefix == ""
    return F.struct(F.when(empty, "unknown").when(group == "", first).otherwise(group).alias("campaign_group"), F.when(empty, "unknown").otherwise(prefix).alias("detailed_prefix"))


def project(filename: Column) -> Column:
    """The survey project in a file name: without extension, leading USGS_LPC_ and one trailing grid or tile number."""
    stem = F.regexp_replace(F.element_at(F.split(filename, "/"), -1), r"(?:\.laz)?\.[^.]*$", "")
    short = F.regexp_replace(F.regexp_replace(stem, r"^USGS_LPC_", ""), r"_(?:w[0-9]+n[0-9]+|[0-9]{2}[A-Z]{2,4}[0-9]{4,}|[0-9]{4,})$", "")
    return F.when(short == "", stem).otherwise(short)


def quarter_box(filename: Column, unit: float = 1000.0, step: float = 3000.0) -> Column:
    """struct<x, y, quarter, xmin, ymin, xmax, ymax> of a name whose parts 7 and 8 are x and y with a quarter letter: a and b the
    north-west and north-east, c and d the south-west and south-east halves of a cell of `step`; null for other names."""
    parts = F.split(F.regexp_replace(filename, r"(_LAS_[0-9]{4})?\.laz$", ""), "_")
    x, yq = F.get(parts, F.lit(6)).try_cast("int"), F.get(parts, F.lit(7))
    quarter, y = F.right(yq, F.lit(1)), F.regexp_replace(yq, ".$", "").try_cast("int")
    east, north, half = quarter.isin("b", "d"), quarter.isin("a", "b"), step / 2
    xmin, ymin = x * unit + F.when(east, half).otherwise(0.0), y * unit + F.when(north, half).otherwise(0.0)
    ok = filename.endswith(".laz") & x.isNotNull() & y.isNotNull() & quarter.isin("a", "b", "c", "d")
    return F.when(ok, F.struct(x.alias("x"), y.alias("y"), quarter.alias("quarter"), xmin.alias("xmin"), ymin.alias("ymin"), (xmin + half).alias("xmax"), (ymin + half).alias("ymax")))


def unit_state(raw: Column) -> Column:
    """ftUS, m or unknown for a unit as it is written."""
    low = F.lower(text(raw))
    return F.when(low.isin(*FEET_WORDS), "ftUS").when(low.isin(*METRE_WORDS), "m").otherwise("unknown")


def unit_of_crs(code: Column, feet: tuple[str, ...] = ("EPSG:2229", "EPSG:2230", "EPSG:2875", "EPSG:102645")) -> Column:
    """struct<unit, to_metres> of a coordinate system's code; feet lists those in survey feet."""
    in_feet = F.upper(text(code)).isin(*feet)
    return F.struct(F.when(in_feet, "survey_foot").otherwise("meter").alias("unit"), F.when(in_feet, FOOT_US).otherwise(1.0).alias("to_metres"))


def building_identity(tile: Column, cluster: Column, building_id: Column, namespace: Column, unique_id: Column, unique_namespace: Column) -> Column:
    """struct<id, namespace, kind, error>: the building's own id with its namespace (one without the other is an error), else the
    footprint's unique id (an error without a namespace for it), else one made of tile and cluster."""
    own, space, unique = F.nullif(text(building_id), F.lit("")), F.nullif(text(namespace), F.lit("")), F.nullif(text(unique_id), F.lit(""))
    none = F.lit(None).cast("string")
    of = lambda i, n, kind, error=none: F.struct(i.alias("id"), n.alias("namespace"), F.lit(kind).alias("kind"), error.alias("error"))
    return (
        F.when(own.isNotNull() & space.isNotNull(), of(own, space, "footprint_building_id"))
        .when(own.isNotNull() | space.isNotNull(), of(none, none, "error", F.lit("incomplete building identity")))
        .when(unique.isNotNull() & unique_namespace.isNotNull(), of(unique, unique_namespace, "footprint_unique_id"))
        .when(unique.isNotNull(), of(none, none, "error", F.lit("unique id without namespace")))
        .otherwise(of(F.concat_ws("_", F.lit("bld"), tile, cluster.cast("string")), F.lit("tile_cluster"), "tile_cluster_fallback"))
    )


def stable(c: Column) -> Column:
    """Rounded to nine decimals, without a negative zero; an error for numbers that aren't finite."""
    finite = ~(F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(c.isNotNull() & F.assert_true(F.coalesce(finite, F.lit(True)), "non-finite metric").isNull(), F.round(c, 9) + F.lit(0.0))


def full_address(*parts: Column) -> Column:
    """Non-empty parts joined by a comma and a space."""
    return F.array_join(F.filter(F.array(*map(text, parts)), lambda p: p != ""), ", ")


def sanitized(c: Column, most: int = 64) -> Column:
    """An id component with unsafe characters as _; null for null, empty and overlong ones."""
    out = F.regexp_replace(text(c), r"[^A-Za-z0-9_.-]", "_")
    return F.when((F.length(out) > 0) & (F.length(out) <= most), out)


def node_name(tile: Column, building: Column, part: Column | None = None) -> Column:
    base = F.concat(F.lit("bld_"), sanitized(tile), F.lit("_"), sanitized(building))
    return base if part is None else F.concat(base, F.when(part.isNull(), "").otherwise(F.concat(F.lit("_part"), part.cast("string"))))


def without_counter(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[0-9]{3}$", "")


def normal_text(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(text(c)), F.lit("_"), F.lit(" ")), r" +", " ")


def lookup(c: Column, table: dict[str, str], default: str | None = None) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(default)) if default is not None else F.create_map(*pairs)[c]


def provenance_class(c: Column) -> Column:
    return lookup(F.lower(text(c)), PROVENANCE, "unknown_unsafe_source")


def unconfirmed_license(c: Column) -> Column:
    low = F.lower(text(c))
    return (low == "unconfirmed") | low.endswith("_unconfirmed") | low.endswith("-unconfirmed") | low.endswith(" unconfirmed")


def truthy(c: Column) -> Column:
    return F.lower(text(c)).isin("1", "true", "yes", "y", "on")


def emptiness(c: Column) -> Column:
    """null, blank, null_like or present for a text."""
    return F.when(c.isNull(), "null").when(F.trim(c) == "", "blank").when(F.lower(F.trim(c)).isin("null", "none", "nan", "n/a", "na", "undefined"), "null_like").otherwise("present")


def grid_box(filename: Column, size: float = 1000.0) -> Column:
    """Box of a name like w0123n0456: hundreds of metres west-east and north of the origin."""
    x = F.regexp_extract(filename, r"w([0-9]{4})n[0-9]{4}", 1).try_cast("int")
    y = F.regexp_extract(filename, r"w[0-9]{4}n([0-9]{4})", 1).try_cast("int")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct((x * size).alias("xmin"), (y * size).alias("ymin"), ((x + 1) * size).alias("xmax"), ((y + 1) * size).alias("ymax")))


def latest_year(c: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"((?:19|20)[0-9]{2})"), F.lit(1)), lambda y: y.cast("int")))


def term_bonus(c: Column, terms: list[str], each: int, most: int) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.least(F.lit(most), sum((F.when(F.contains(low, F.lit(t)), each).otherwise(0) for t in terms), F.lit(0)))


def is_sha256(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def is_iso_time(c: Column) -> Column:
    ok = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
    return F.coalesce(ok & F.substring(c, 1, 10).try_cast("date").isNotNull(), F.lit(False))


def seed(*parts: Column) -> Column:
    """The first 8 hex digits of the SHA-256 of the parts joined by |, as a number."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8), 16, 10).cast("long")


def canonical_digest(**fields: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields)))), 256)


def media_type(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return lookup(ext, {"json": "application/json", "geojson": "application/geo+json", "csv": "text/csv", "parquet": "application/vnd.apache.parquet", "glb": "model/gltf-binary", "html": "text/html"}, "application/octet-stream")


def is_absolute_path(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^(/|[A-Za-z]:[\\/]|\\\\|~)"), F.lit(False))


def size_differs(actual: Column, expected: Column, at_least: int = 1024, fraction: float = 0.01) -> Column:
    return F.abs(actual - expected) > F.greatest(F.lit(float(at_least)), expected * fraction)


def ramp(v: Column, lo: Column, hi: Column, stops: list[tuple[float, float, float]]) -> Column:
    """Linear colour between three stops over [lo, hi], clamped."""
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (v - lo) / F.when(hi > lo, hi - lo).otherwise(1.0)))
    channel = lambda k: F.when(t < 0.5, stops[0][k] + (stops[1][k] - stops[0][k]) * t * 2).otherwise(stops[1][k] + (stops[2][k] - stops[1][k]) * (t * 2 - 1))
    return F.struct(channel(0).alias("r"), channel(1).alias("g"), channel(2).alias("b"))


def band(v: Column, lo: Column, hi: Column, n: int = 5) -> Column:
    """Equal-width band 0 .. n - 1, the last closed; 0 if all values are equal."""
    return F.when(hi > lo, F.least(F.lit(n - 1), F.floor((v - lo) / ((hi - lo) / n)))).otherwise(0).cast("int")


def mapped_value(c: Column, table: dict[str, str] | None) -> Column:
    """none gives null; with a table the value of the upper-cased, else the raw key, else the raw text."""
    raw = c.cast("string")
    if not table:
        return raw
    return F.coalesce(lookup(F.upper(F.trim(raw)), table), lookup(raw, table), raw)


def json_safe(c: Column) -> Column:
    return F.when(F.isnan(c), "NaN").when(c == float("inf"), "Infinity").when(c == float("-inf"), "-Infinity").otherwise(c.cast("string"))


def glazing(ratio: Column, cuts: tuple[float, float] = (0.25, 0.6)) -> Column:
    return F.when(ratio.isNull(), "unknown").when(ratio < cuts[0], "low").when(ratio < cuts[1], "medium").otherwise("high")


def floors(height: Column, each: float = 3.2) -> Column:
    return F.greatest(F.lit(1), F.bround(height / each).cast("int"))


def floor_height(height: Column, n: Column) -> Column:
    return F.least(F.lit(6.0), F.greatest(F.lit(2.4), height / n))


def bays(lengths: Column, target: float) -> Column:
    return F.transform(lengths, lambda x: F.greatest(F.lit(1), F.bround(x / target).cast("int")))


def combined_score(scores: Column) -> Column:
    """The strongest score plus a fifth of its gap to one, for each unit of the others' sum; at most 0.99."""
    ordered = F.reverse(F.array_sort(scores))
    strongest = ordered[0]
    rest = F.aggregate(F.slice(ordered, 2, F.size(ordered)), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(scores) > 0, F.least(F.lit(0.99), strongest + 0.2 * (1 - strongest) * rest))


def weaker_status(a: Column, b: Column, order: list[str]) -> Column:
    rank = F.create_map(*(F.lit(x) for i, s in enumerate(order) for x in (s, i)))
    return F.element_at(F.array(*map(F.lit, order)), F.least(F.coalesce(rank[a], F.lit(0)), F.coalesce(rank[b], F.lit(0))) + 1)
