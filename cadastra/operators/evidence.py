"""Evidence: records of five kinds of source become material clues, which are checked; facade openings are laid out.

records: evidence_id, building_id, building_id_namespace, source_type, observed_at (text), confidence, provenance_status, evidence
(a JSON object as text, its fields by kind of source). Clues have the columns that materials.contributions reads; a value that the
vocabulary of its surface doesn't know is kept as unmapped, without weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

#: The most that a kind of source may claim; standings, the weakest first; what may not name a building.
CONFIDENCE_CAP = {"osm_tags": 0.65, "municipal_record": 0.90, "historic_inventory": 0.85, "licensed_imagery": 0.75, "generic": 0.90}
STATUS_ORDER = ["unknown", "inferred", "record_derived", "observed"]
UNSAFE_AUTHORITIES = ("cluster_id", "cid", "array_position", "row_number", "filename_integer")
#: Words that records use, and the materials that they mean.
WORDS = {
    "envelope": {
        "brick": "brick", "brick masonry": "brick", "masonry brick": "brick", "brick veneer": "brick", "stucco": "stucco", "plaster": "stucco", "wood": "wood", "timber": "wood", "stone": "stone",
        "metal": "metal_panel", "metal panel": "metal_panel", "glass": "glass_curtain_wall", "glass curtain wall": "glass_curtain_wall", "concrete": "generic_masonry", "concrete block": "generic_masonry",
        "concrete masonry": "generic_masonry", "cmu": "generic_masonry", "masonry": "generic_masonry", "painted concrete": "painted_concrete", "exposed concrete": "exposed_concrete",
    },
    "roof": {
        "membrane": "membrane", "built up": "membrane", "built-up": "membrane", "modified bitumen": "membrane", "single ply": "membrane", "single-ply": "membrane", "gravel": "gravel", "tile": "tile",
        "clay tile": "tile", "concrete tile": "tile", "metal": "standing_seam_metal", "standing seam metal": "standing_seam_metal", "asphalt shingle": "shingle", "shingle": "shingle", "concrete": "concrete",
        "green roof": "green_roof", "vegetated": "green_roof",
    },
    "glazing": {"low": "low", "moderate": "moderate", "high": "high", "curtain wall": "curtain_wall", "glass curtain wall": "curtain_wall"},
}
#: Fields of each kind of source that name a material (path, name, surface), and those that give context only
#: (path, name, surface, source of the clue).
NAMED = {
    "osm_tags": ((("tags", "building:material"), "building_material", "envelope"), (("tags", "facade:material"), "facade_material", "envelope"), (("tags", "roof:material"), "roof_material", "roof")),
    "municipal_record": tuple(((f,), f, s) for f, s in (("documented_construction_material", "envelope"), ("documented_facade_material", "envelope"), ("documented_roof_material", "roof"))),
    "historic_inventory": tuple(((f,), f, s) for f, s in (("documented_facade_material", "envelope"), ("documented_construction_material", "envelope"), ("documented_roof_material", "roof"))),
}
CONTEXT = {
    "osm_tags": tuple((("tags", t), f, "envelope", "building_inventory") for t, f in (
        ("building:levels", "building_levels"), ("building:start_date", "construction_era"), ("start_date", "construction_era"), ("building:use", "building_use"), ("building", "building_use"),
    )),
    "municipal_record": tuple(((f,), f, "envelope", s) for f, s in (
        ("construction_year", "municipal_record"), ("permit_description", "municipal_record"), ("building_use", "municipal_record"), ("zoning_class", "zoning"), ("land_use_class", "zoning"),
    )),
    "historic_inventory": tuple(((f,), f, "envelope", "building_inventory") for f in ("architectural_description", "construction_era", "construction_year", "landmark_or_inventory_record")),
    "licensed_imagery": tuple(((f,), f, s, "aerial_imagery") for f, s in (
        ("glazing_ratio", "glazing"), ("facade_segmentation_statistics", "envelope"), ("roof_color_statistics", "roof"), ("surface_texture_statistics", "envelope"),
    )),
}
SOURCE = {"osm_tags": "building_inventory", "municipal_record": "municipal_record", "historic_inventory": "building_inventory"}
REMOTE = ("aerial_imagery", "lidar", "zoning", "derived_geometry")
CLUE = ["clue_id", "building_id", "surface_type", "observation_type", "value", "unit", "source_type", "confidence", "provenance_status", "quality_flags"]
_LISTS = "struct<material_probabilities:array<struct<surface_type:string,material:string,probability:double>>,generic_clues:array<struct<observation_type:string,surface_type:string,value:variant,unit:string,clue_source_type:string,confidence:double,provenance_status:string,quality_flags:array<string>>>>"


def escaped(json: Column) -> Column:
    """JSON text with \\u escapes for what isn't ASCII, as digests of values are made from."""
    unit = lambda c: F.lower(F.regexp_replace(F.hex(F.encode(c, "UTF-16BE")), "(.{4})", r"\\u$1"))
    return F.when(json.rlike(r"^[\x00-\x7F]*$"), json).otherwise(F.array_join(F.transform(F.split(json, ""), lambda c: F.when(c.rlike(r"^[\x00-\x7F]*$"), c).otherwise(unit(c))), ""))


def stable_token(json: Column) -> Column:
    """The first 16 digits of the digest of a value's JSON."""
    return F.substring(F.sha2(escaped(json), 256), 1, 16)


def _json_of(text: Column) -> Column:
    """JSON of a text value."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def _found(kind: str, name: str, surface, source, text, json, sure=None, status=None, unit=None, flags=None) -> Column:
    """What a field of a record says: kind is named, context, probable or generic."""
    row = (("kind", kind, "string"), ("field", name, "string"), ("surface_type", surface, "string"), ("source_type", source, "string"), ("text", text, "string"), ("json", json, "string"), ("own_sure", sure, "double"), ("own_status", status, "string"), ("unit", unit, "string"), ("own_flags", flags, "array<string>"))
    return F.struct(*((F.lit(v) if isinstance(v, str) or v is None else v).cast(t).alias(c) for c, v, t in row))


def _fields(v: Column, lists: Column) -> Column:
    """All that a record's evidence may say, nulls for fields that aren't there."""
    out = []
    for kind in CONFIDENCE_CAP:
        for path, name, surface, source in [*((p, f, s, SOURCE[kind]) for p, f, s in NAMED.get(kind, ())), *CONTEXT.get(kind, ())]:
            at = "$" + "".join(f'["{p}"]' for p in path)
            one = _found("named" if (path, name, surface) in NAMED.get(kind, ()) else "context", name, surface, source, F.try_variant_get(v, at, "string"), F.to_json(F.try_variant_get(v, at, "variant")))
            out.append(F.when(F.col("_kind") == kind, F.array(one)))
    probable = lambda p: _found("probable", "material_probability", p["surface_type"], "aerial_imagery", p["material"], _json_of(p["material"]), p["probability"])
    generic = lambda g: _found("generic", g["observation_type"], g["surface_type"], g["clue_source_type"], F.try_variant_get(g["value"], "$", "string"), F.to_json(g["value"]), g["confidence"], g["provenance_status"], g["unit"], g["quality_flags"])
    out += [F.when(F.col("_kind") == "licensed_imagery", F.transform(lists["material_probabilities"], probable)), F.when(F.col("_kind") == "generic", F.transform(lists["generic_clues"], generic))]
    return F.flatten(F.array_compact(F.array(*out)))


def clues(records: DataFrame) -> DataFrame:
    """Clues of all records, one scan: by kind of source a clue for each field that is there and not blank text, for each material
    probability, and for each generic clue. Unknown kinds and bad JSON give none. Confidence is capped by kind of source, and 0
    where the standing is unknown or the value unmapped; records, imagery and zoning can't show more than they are."""
    parsed = F.explode(F.array(F.struct(F.expr("try_parse_json(evidence)").alias("v"), F.from_json("evidence", _LISTS).alias("l"))))  # once a record
    r = records.select("evidence_id", "building_id", F.col("source_type").alias("_kind"), F.coalesce("confidence", F.lit(0.0)).alias("_sure"), "provenance_status", parsed.alias("_e"))
    model = [F.concat(F.lit(f"model_{n}:"), F.try_variant_get("_e.v", f"$.model_metadata.{p}", "string")) for n, p in (("name", "model_name"), ("version", "model_version"), ("configuration_digest", "configuration_digest"))]
    r = r.withColumn("_model", F.when(F.col("_kind") == "licensed_imagery", F.array_compact(F.array(*model))).otherwise(F.array().cast("array<string>")))
    r = r.withColumn("_f", F.explode(_fields(F.col("_e.v"), F.col("_e.l")))).drop("_e").select("*", "_f.*").where("json IS NOT NULL AND json != 'null' AND (kind IN ('generic', 'probable') OR json != '\"\"') AND (kind != 'named' OR text IS NOT NULL)")
    named = F.col("kind").isin("named", "probable")
    word = S.normal_text(F.col("text"))
    r = r.withColumn("_m", F.when(named, F.coalesce(*(F.when(F.col("surface_type") == s, S.lookup(word, table)) for s, table in WORDS.items()))))
    r = r.withColumn("_lost", named & F.col("_m").isNull())
    most = F.when((F.col("_kind") == "licensed_imagery") | ((F.col("kind") == "generic") & F.col("source_type").isin(*REMOTE)), "inferred").when((F.col("kind") != "generic") | F.col("source_type").isin("municipal_record", "building_inventory"), "record_derived").otherwise("observed")
    r = r.withColumn("_status", S.weaker_status(S.weaker_status(F.col("provenance_status"), F.coalesce("own_status", F.lit("observed")), STATUS_ORDER), most, STATUS_ORDER))
    cap = F.create_map(*(F.lit(x) for pair in CONFIDENCE_CAP.items() for x in pair))[F.col("_kind")]
    r = r.withColumn("_c", F.when(F.col("_lost"), 0.0).otherwise(F.round(F.least(F.col("_sure"), F.coalesce("own_sure", F.lit(1.0)), cap), 6)))
    r = r.withColumns({"_none": (F.col("_c") <= 0) | (F.col("_status") == "unknown"), "_json": F.when(F.col("_m").isNotNull(), _json_of(F.col("_m"))).otherwise(F.col("json"))})
    suffix = F.when(F.col("kind") == "probable", F.concat_ws("_", "field", "surface_type", stable_token(F.col("json")))).when(F.col("kind") == "generic", F.concat(F.lit("generic_"), F.col("field"))).otherwise(F.col("field"))
    material = F.when(F.col("surface_type") == "envelope", "envelope_material").when(F.col("surface_type") == "glazing", "glazing_character").otherwise(F.concat("surface_type", F.lit("_material")))
    flags = F.array_compact(F.array(
        F.when(F.col("kind") == "named", F.concat(F.lit("normalized_from:"), F.col("field"))), F.when(F.col("_lost"), "unmapped_or_ambiguous_material"), F.when((F.col("kind") == "probable") & ~F.col("_lost"), "machine_classification"),
        F.when((F.col("kind") == "named") & (F.col("surface_type") == "envelope") & (word == "concrete"), "generalized_concrete_to_masonry"), F.when((F.col("kind") == "context") & (F.col("_kind") != "licensed_imagery"), "context_only_not_exact_material"),
    ))
    return r.select(
        F.concat_ws(":", "evidence_id", suffix, stable_token(F.col("_json"))).alias("clue_id"), "building_id", "surface_type",
        F.when(F.col("_lost"), F.concat(F.lit("unmapped_"), F.col("field"))).when(named, material).otherwise(F.col("field")).alias("observation_type"),
        F.coalesce("_m", "text", "json").alias("value"), "unit", "source_type", F.when(F.col("_none"), 0.0).otherwise(F.col("_c")).alias("confidence"), F.when(F.col("_none"), "unknown").otherwise(F.col("_status")).alias("provenance_status"),
        F.array_sort(F.array_distinct(F.concat(flags, "_model", F.coalesce("own_flags", F.array().cast("array<string>"))))).alias("quality_flags"),
    )


def record_errors(records: DataFrame) -> DataFrame:
    """(evidence_id, error): repeated ids, kinds of source without adapter, ids of buildings without a qualified authority:name or with
    an unsafe authority, times that are no RFC 3339 date-times, and records that give no clue."""
    name, at = F.coalesce("building_id_namespace", F.lit("")), F.coalesce("observed_at", F.lit(""))
    qualified = name.rlike(r"^[A-Za-z][A-Za-z0-9._-]*:[A-Za-z0-9][A-Za-z0-9._:-]*$")
    timed = at.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$") & at.try_cast("timestamp").isNotNull()
    found = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("source_type").isin(*CONFIDENCE_CAP), F.lit(False)), "unsupported_source"), F.when(~qualified, "unqualified_namespace"),
        F.when(qualified & F.lower(F.element_at(F.split(name, ":"), 1)).isin(*UNSAFE_AUTHORITIES), "prohibited_authority"), F.when(~timed, "bad_timestamp"),
    ))
    own = records.select("evidence_id", F.explode(found).alias("error"))
    twice = records.groupBy("evidence_id").agg(F.count("*").alias("n")).where("n > 1").select("evidence_id", F.lit("duplicate").alias("error"))
    some = clues(records).select(F.split("clue_id", ":")[0].alias("evidence_id")).distinct()
    none = records.where(F.col("source_type").isin(*CONFIDENCE_CAP)).join(some, "evidence_id", "left_anti").select("evidence_id", F.lit("no_clue").alias("error"))
    return own.unionByName(twice).unionByName(none)


def clue_errors(found: DataFrame, buildings: DataFrame) -> DataFrame:
    """(clue_id, error): repeated clue ids and clues of unknown buildings."""
    twice = found.groupBy("clue_id").agg(F.count("*").alias("n")).where("n > 1").select("clue_id", F.lit("duplicate").alias("error"))
    orphans = found.join(buildings.select("building_id"), "building_id", "left_anti").select("clue_id", F.lit("orphan").alias("error"))
    return twice.unionByName(orphans)


def facade_openings(facades: DataFrame, bay_width: float = 3.0) -> DataFrame:
    """(building_id, edge, bay, floor, x, z, w, h) of the openings of facade edges (building_id, edge, length, floors, floor_height)."""
    n = F.greatest(F.lit(1), F.bround(F.col("length") / bay_width).cast("int"))
    b = facades.withColumn("n", n).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bay"))
    each = b.select("*", F.explode(F.sequence(F.lit(0), F.col("floors") - 1)).alias("floor"))
    w = F.col("length") / F.col("n")
    return each.select("building_id", "edge", "bay", "floor", ((F.col("bay") + 0.5) * w).alias("x"), ((F.col("floor") + 0.5) * F.col("floor_height")).alias("z"), (w * 0.6).alias("w"), (F.col("floor_height") * 0.5).alias("h"))
