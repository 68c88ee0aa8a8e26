"""Materials of surfaces from clues and building records: contributions of rules, combined and ranked for each building.

clues: clue_id, building_id, surface_type (envelope, roof, glazing), observation_type, value, unit, source_type, confidence,
provenance_status. buildings: building_id, building_use, height_m, floors_est, roof_geometry_class, municipal_construction_type,
municipal_roof_type, metadata_provenance (struct of source_type, provenance_status, confidence; null if there is none)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

#: Materials of each surface, and other words for them.
VOCABULARIES = {
    "envelope": ("stucco", "painted_concrete", "exposed_concrete", "brick", "stone", "metal_panel", "glass_curtain_wall", "wood", "generic_masonry"),
    "roof": ("membrane", "gravel", "tile", "standing_seam_metal", "shingle", "concrete", "green_roof"),
    "glazing": ("low", "moderate", "high", "curtain_wall"),
}
ALIASES = {
    "envelope": {
        "brick masonry": "brick", "masonry brick": "brick", "brick veneer": "brick", "stucco finish": "stucco", "cement stucco": "stucco", "painted concrete": "painted_concrete", "exposed concrete": "exposed_concrete",
        "concrete block": "generic_masonry", "cmu": "generic_masonry", "masonry": "generic_masonry", "metal panel": "metal_panel", "glass curtain wall": "glass_curtain_wall", "curtain wall": "glass_curtain_wall",
    },
    "roof": {
        "built up": "membrane", "built-up": "membrane", "modified bitumen": "membrane", "single ply": "membrane", "single-ply": "membrane", "flat membrane": "membrane", "standing seam metal": "standing_seam_metal",
        "metal seam": "standing_seam_metal", "green roof": "green_roof", "vegetated": "green_roof", "asphalt shingle": "shingle", "concrete tile": "tile", "clay tile": "tile",
    },
    "glazing": {"curtain wall": "curtain_wall", "glass curtain wall": "curtain_wall", "mostly glass": "high", "minimal": "low", "medium": "moderate"},
}
#: Observations that name a material, finishes, homes, and standings, the weakest first.
DIRECT = {
    "envelope": ("material", "material_class", "envelope_material", "facade_material", "exterior_material"), "roof": ("material", "material_class", "roof_material", "roof_cover"),
    "glazing": ("material", "material_class", "glazing_character"),
}
SMOOTH = ("smooth", "smooth finish", "light smooth finish", "stucco like")
LIGHT = ("light neutral", "light colored", "light-coloured", "light coloured")
CONTINUOUS = ("continuous", "continuous sheet", "uniform low texture", "low texture")
HOMES = ("residential", "multifamily residential", "single family residential")
STATUSES = ("unknown", "inferred", "record_derived", "observed")


def _one_of(by_surface) -> Column:
    """The Column for a row's surface_type, null for other surfaces."""
    out = None
    for surface in VOCABULARIES:
        out = F.when(F.col("surface_type") == surface, by_surface(surface)) if out is None else out.when(F.col("surface_type") == surface, by_surface(surface))
    return out


def material_of(value: Column, surface: str) -> Column:
    """A word of the surface's vocabulary, by itself or as an alias; else null."""
    low = S.normal_text(value)
    word = F.replace(low, F.lit(" "), F.lit("_"))
    return F.when(word.isin(*VOCABULARIES[surface]), word).otherwise(S.lookup(low, ALIASES[surface]))


def effective_status(status: Column, source: Column) -> Column:
    """What a source can show at most: remote sensing infers, records are records."""
    return (
        F.when(status == "unknown", "unknown").when(source.isin("lidar", "aerial_imagery", "zoning", "derived_geometry"), "inferred")
        .when(source.isin("municipal_record", "building_inventory") & (status == "observed"), "record_derived").otherwise(status)
    )


def direct_score(confidence: Column, status: Column) -> Column:
    weight = F.when(status == "observed", 0.98).when(status == "record_derived", 0.95).when(status == "inferred", 0.65).otherwise(0.0)
    return weight * F.least(F.lit(1.0), confidence)


def _part(material, score, status, holds=None, refs=None) -> Column:
    row = F.struct((F.lit(material) if isinstance(material, str) else material).alias("material"), score.alias("score"), (F.lit(status) if isinstance(status, str) else status).alias("status"), (refs if refs is not None else F.array("clue_id")).alias("refs"))
    return row if holds is None else F.when(holds, row)


def contributions(clues: DataFrame, buildings: DataFrame) -> DataFrame:
    """(building_id, surface_type, material, score, status, refs): a row for each rule that holds."""
    observation, value, sure = F.replace(S.normal_text(F.col("observation_type")), F.lit(" "), F.lit("_")), S.normal_text(F.col("value")), F.col("confidence")
    usable = (F.col("provenance_status") != "unknown") & (sure > 0)
    status = effective_status(F.col("provenance_status"), F.col("source_type"))
    c = clues.withColumns({"_o": observation, "_v": value, "_ok": usable, "_s": status, "_m": _one_of(lambda s: material_of(F.col("value"), s)), "_direct": _one_of(lambda s: observation.isin(*DIRECT[s]))})
    surface = F.col("surface_type")
    direct = direct_score(sure, F.col("_s"))
    named = F.col("_direct") & F.col("_m").isNotNull()
    smooth = (surface == "envelope") & F.col("_ok") & F.col("_o").isin("surface_finish", "surface_character") & F.col("_v").isin(*SMOOTH)
    light = (surface == "envelope") & F.col("_ok") & F.col("_o").isin("aerial_color_character", "color_character") & F.col("_v").isin(*LIGHT)
    number = F.col("value").try_cast("double")
    ratio = F.when(S.normal_text(F.col("unit")).isin("percent", "%"), number / 100).otherwise(number)
    glass = (surface == "glazing") & F.col("_ok") & F.col("_o").isin("glazing_ratio", "window_to_wall_ratio") & ratio.between(0, 1)
    class_ = F.when(ratio >= 0.75, "curtain_wall").when(ratio >= 0.5, "high").when(ratio >= 0.2, "moderate").otherwise("low")
    next_ = F.when(ratio >= 0.75, "high").when(ratio >= 0.5, "curtain_wall").when(ratio >= 0.2, "low").otherwise("moderate")
    strength = F.when(ratio >= 0.75, 0.72).when(ratio >= 0.5, 0.68).otherwise(0.65) * sure
    parts = F.array(
        _part(F.col("_m"), direct, F.col("_s"), named), _part("generic_masonry", direct * 0.18, "inferred", named & (surface == "envelope") & (F.col("_m") == "brick")),
        _part("stucco", 0.28 * sure, "inferred", smooth), _part("painted_concrete", 0.28 * 0.72 * sure, "inferred", smooth), _part("stucco", 0.18 * sure, "inferred", light), _part("painted_concrete", 0.18 * 0.9 * sure, "inferred", light),
        _part(class_, strength, "inferred", glass), _part(next_, strength * 0.3, "inferred", glass),
    )
    from_clues = c.select("building_id", "surface_type", F.explode(F.array_compact(parts)).alias("p")).select("building_id", "surface_type", "p.*")
    return from_clues.unionByName(_from_records(buildings)).unionByName(_from_context(c.withColumn("_weak", smooth | light), buildings)).where("score > 0")


def _known(b: str = "metadata_provenance") -> Column:
    p = F.col(b)
    return F.coalesce(p.isNotNull() & (p["provenance_status"] != "unknown") & (p["confidence"] > 0), F.lit(False))


def _from_records(buildings: DataFrame) -> DataFrame:
    """Materials that municipal or inventory records name."""
    p = F.col("metadata_provenance")
    status = effective_status(p["provenance_status"], p["source_type"])
    rows = []
    for surface, field in (("envelope", "municipal_construction_type"), ("roof", "municipal_roof_type")):
        m = material_of(F.col(field), surface)
        part = _part(m, direct_score(p["confidence"], status), status, m.isNotNull() & p["source_type"].isin("municipal_record", "building_inventory"), F.array(F.lit(f"building_metadata:{field}")))
        rows.append(F.when(part.isNotNull(), F.struct(F.lit(surface).alias("surface_type"), part.alias("p"))))
    return buildings.select("building_id", F.explode(F.array_compact(F.array(*rows))).alias("x")).select("building_id", "x.surface_type", "x.p.*")


def _from_context(clues: DataFrame, buildings: DataFrame) -> DataFrame:
    """What needs a whole building's clues: low homes with a smooth or light finish, flat high roofs with a continuous surface."""
    roof = (F.col("surface_type") == "roof") & F.col("_ok")
    shape = roof & F.col("_o").isin("roof_geometry", "roof_geometry_class") & F.col("_v").isin("flat", "pitched", "complex")
    sheet = roof & (F.col("_o") == "roof_surface_character") & F.col("_v").isin(*CONTINUOUS)
    best = F.struct((-F.col("confidence")).alias("c"), "clue_id")
    per = clues.where(F.col("_weak") | shape | sheet).groupBy("building_id").agg(
        F.bool_or("_weak").alias("weak"), F.min_by(F.struct(F.col("_v").alias("v"), F.col("confidence").alias("c")), F.when(shape, best)).alias("shape"), F.max(F.when(sheet, F.col("confidence"))).alias("sheet"),
        F.array_sort(F.collect_list(F.when(sheet, F.col("clue_id")))).alias("sheet_refs"), F.collect_list(F.when(shape, F.struct(F.col("_v").alias("v"), F.col("clue_id").alias("i")))).alias("shapes"),
    )
    j = per.join(buildings, "building_id")
    sure = F.col("metadata_provenance.confidence")
    home = F.col("weak") & _known() & S.normal_text(F.col("building_use")).isin(*HOMES) & (F.col("floors_est") <= 4)
    geometry = F.coalesce("shape.v", "roof_geometry_class")
    high = _known() & (F.coalesce(F.col("height_m") >= 30, F.lit(False)) | F.coalesce(F.col("floors_est") >= 8, F.lit(False)))
    flat = (geometry == "flat") & high & F.col("sheet").isNotNull()
    support = 0.42 * F.least(F.coalesce("shape.c", sure), sure, F.col("sheet"))
    seen = F.transform(F.filter("shapes", lambda s: s["v"] == F.col("shape.v")), lambda s: s["i"])
    tall = F.array_compact(F.array(F.when(F.col("height_m").isNotNull(), "building_metadata:height_m"), F.when(F.col("floors_est").isNotNull(), "building_metadata:floors_est")))
    refs = F.concat(F.when(F.col("shape").isNotNull(), seen).otherwise(F.array(F.lit("building_metadata:roof_geometry_class"))), tall, F.col("sheet_refs"))
    row = lambda surface, material, score, holds, r: F.when(holds, F.struct(F.lit(surface).alias("surface_type"), _part(material, score, "inferred", None, r).alias("p")))
    own = F.array(F.lit("building_metadata:building_use"), F.lit("building_metadata:floors_est"))
    each = F.array(row("envelope", "stucco", 0.16 * sure, home, own), *(row("roof", m, support * k, flat, refs) for m, k in (("membrane", 1.0), ("gravel", 0.5), ("concrete", 0.4))))
    return j.select("building_id", F.explode(F.array_compact(each)).alias("x")).select("building_id", "x.surface_type", "x.p.*")


def candidates(parts: DataFrame) -> DataFrame:
    """(building_id, surface_type, material, confidence, status, evidence, rank, alternatives): scores of a material combine, the
    weakest status counts and caps what is only inferred at 0.75. Ties go to the name."""
    rank = F.create_map(*(F.lit(x) for i, s in enumerate(STATUSES) for x in (s, i)))
    g = parts.groupBy("building_id", "surface_type", "material").agg(
        S.combined_score(F.collect_list(F.least(F.col("score"), F.lit(0.99)))).alias("c"), F.min(rank[F.col("status")]).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("refs")))).alias("evidence")
    )
    g = g.withColumns({"confidence": F.round(F.when(F.col("s") == 1, F.least(F.col("c"), F.lit(0.75))).otherwise(F.col("c")), 4), "status": F.element_at(F.array(*map(F.lit, STATUSES)), F.col("s") + 1)}).drop("c", "s")
    one = W.partitionBy("building_id", "surface_type")
    order = one.orderBy(F.desc("confidence"), "material")
    every = F.collect_list("material").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return g.withColumns({"rank": F.row_number().over(order), "alternatives": F.array_remove(every, F.col("material"))})


def evidence_list(clues: DataFrame, buildings: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(building_id, evidence): clues and the known metadata fields of each building as records, ordered by their ids."""
    kind = F.struct("evidence_id", "source_type", "confidence", "provenance_status")
    a = clues.withColumn("evidence_id", F.col("clue_id")).select("building_id", kind.alias("e"))
    p = F.col("metadata_provenance")
    known = [F.when(F.col(f).isNotNull() & p.isNotNull(), F.struct(F.lit(f"building_metadata:{f}").alias("evidence_id"), p["source_type"].alias("source_type"), p["confidence"].alias("confidence"), p["provenance_status"].alias("provenance_status"))) for f in fields]
    b = buildings.select("building_id", F.explode(F.array_compact(F.array(*known))).alias("e"))
    return a.unionByName(b).groupBy("building_id").agg(F.array_sort(F.collect_list("e")).alias("evidence"))
