"""Facades: records as evidence, typologies, recipes, edge frames. A grammar is a function of profiles; register() adds one."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

#: Metadata fields that are evidence, uses and their words, typology of each use with its strength and alternative.
FIELDS = {"building_use": "building_use", "construction_year": "construction_year", "construction_era": "construction_era", "floor_count": "floor_count", "podium_levels": "podium"}
TYPOLOGY = {
    "parking": ("parking_structure_openings", 0.86, ()), "warehouse": ("warehouse_bays", 0.82, ("industrial_panelized",)), "residential": ("repetitive_residential_bays", 0.62, ("generic_lowrise",)),
    "industrial": ("industrial_panelized", 0.68, ("warehouse_bays",)), "civic": ("civic_monumental", 0.58, ("generic_lowrise",)),
}
OF_USE = {"hotel": "hotel_bay_rhythm", "office": "office_grid", "mixed_use": "mixed_use_podium_tower", **{u: t for u, (t, _, _) in TYPOLOGY.items()}}
GRAMMARS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register(name: str):
    def add(f):
        GRAMMARS[name] = f
        return f

    return add


def recipes(profiles: DataFrame, grammar: str = "usage") -> DataFrame:
    if grammar not in GRAMMARS:
        raise KeyError(f"no grammar is named {grammar}; there are {sorted(GRAMMARS)}")
    return GRAMMARS[grammar](profiles)


def metadata_evidence(records: DataFrame) -> DataFrame:
    """(building_id, evidence_id, evidence_type, value, unit, confidence, provenance_status) of records' known fields that have a
    provenance: records(building_id, fields of FIELDS, field_provenance map<field, struct<confidence, provenance_status>>)."""
    known = [
        F.when(
            F.col(f).isNotNull() & F.map_contains_key("field_provenance", F.lit(f)),
            F.struct(F.lit(f"building_metadata:{f}").alias("evidence_id"), F.lit(t).alias("evidence_type"), F.col(f).cast("string").alias("value"), F.lit("floors" if f in ("floor_count", "podium_levels") else None).cast("string").alias("unit"), F.col("field_provenance")[f].alias("p")),
        )
        for f, t in FIELDS.items()
        if f in records.columns
    ]
    rows = records.select("building_id", F.explode(F.array_compact(F.array(*known))).alias("e"))
    return rows.select("building_id", "e.evidence_id", "e.evidence_type", "e.value", "e.unit", "e.p.confidence", "e.p.provenance_status")


def with_sidecars(buildings: DataFrame, **sidecars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """buildings with each sidecar's rows as an array column of its name, and (sidecar, building_id) of rows without a building."""
    out, orphans = buildings, []
    for name, rows in sidecars.items():
        rest = [c for c in rows.columns if c != "building_id"]
        grouped = rows.groupBy("building_id").agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))
        out = out.join(grouped, "building_id", "left").withColumn(name, F.coalesce(name, F.array().cast(grouped.schema[name].dataType)))
        orphans.append(rows.join(buildings.select("building_id"), "building_id", "left_anti").select(F.lit(name).alias("sidecar"), "building_id"))
    return out, reduce(DataFrame.unionByName, orphans)


def paired(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides with one key, and (key, missing) of keys that only one side has."""
    missing = left.select(key).join(right.select(key), key, "left_anti").withColumn("missing", F.lit("right"))
    return left.join(right, key), missing.unionByName(right.select(key).join(left.select(key), key, "left_anti").withColumn("missing", F.lit("left")))


def typology(evidence: DataFrame, facts: DataFrame, glazing: DataFrame) -> DataFrame:
    """(building_id, typology, strength, alternatives, conflict) of facts(building_id, floor_count, podium_levels), from usable use
    records among evidence and glazing(building_id, glazing, glazing_strength). Different uses are a conflict: unknown."""
    usable = (F.col("evidence_type") == "building_use") & (F.col("provenance_status") != "unknown") & (F.col("confidence") > 0)
    word = F.replace(S.normal_text(F.col("value")), F.lit(" "), F.lit("_"))
    uses = evidence.where(usable & word.isin(*OF_USE)).groupBy("building_id").agg(F.array_sort(F.collect_set(word)).alias("uses"))
    j = facts.join(uses, "building_id", "left").join(glazing, "building_id", "left").withColumn("uses", F.coalesce("uses", F.array().cast("array<string>")))
    use = F.when(F.size("uses") == 1, F.get("uses", F.lit(0)))
    answer = lambda t, s, a=(): F.struct(F.lit(t).alias("typology"), F.lit(s).alias("strength"), F.array(*map(F.lit, a)).cast("array<string>").alias("alternatives"))
    several = F.array_sort(F.array_distinct(F.transform("uses", lambda u: S.lookup(u, OF_USE))))
    out = F.when(F.size("uses") > 1, F.struct(F.lit("unknown").alias("typology"), F.lit(0.0).alias("strength"), several.alias("alternatives")))
    out = out.when((use == "hotel") & (F.col("floor_count") > 0), answer("hotel_bay_rhythm", 0.78, ("generic_lowrise",)))
    out = out.when((use == "office") & F.col("glazing").isin("high", "curtain_wall") & (F.col("glazing_strength") >= 0.7), answer("curtain_wall_candidate", 0.76, ("office_grid",)))
    out = out.when(use == "office", answer("office_grid", 0.64, ("curtain_wall_candidate",))).when((use == "mixed_use") & (F.col("podium_levels") > 0), answer("mixed_use_podium_tower", 0.74, ("retail_podium",)))
    for u, (t, s, a) in TYPOLOGY.items():
        out = out.when(use == u, answer(t, s, a))
    out = out.otherwise(answer("unknown", 0.0, ("generic_lowrise",)))
    return j.withColumn("_a", out).select("building_id", "_a.*", (F.size("uses") > 1).alias("conflict"))


@register("usage")
def usage_grammar(profiles: DataFrame) -> DataFrame:
    """profiles(building_id, typology, height_m, floor_count, edges array<struct<edge_id, length>>) with floors (as recorded, else
    by height), floor_height, the bays of each edge and a seed."""
    target = S.lookup(F.col("typology"), {"curtain_wall_candidate": "1.5", "warehouse_bays": "8.0", "parking_structure_openings": "8.0"}, "3.6").cast("double")
    n = F.coalesce(F.when(F.col("floor_count") > 0, F.bround("floor_count").cast("int")), S.floors(F.col("height_m")))
    bays = F.transform("edges", lambda e: F.struct(e["edge_id"].alias("edge_id"), e["length"].alias("length"), F.greatest(F.lit(1), F.bround(e["length"] / target).cast("int")).alias("bays")))
    basis = F.when(F.col("floor_count") > 0, "record").otherwise("procedural_height_division")
    return profiles.select("building_id", "typology", n.alias("floors"), S.floor_height(F.col("height_m"), n).alias("floor_height"), basis.alias("floor_basis"), bays.alias("edges"), S.seed(F.col("building_id").cast("string"), F.col("typology")).alias("seed"))


def edge_frame(edges: DataFrame) -> DataFrame:
    """edges(start, end structs<x, y>, interior_side, ground_z, top_z, height_m, claimed_length) with length, direction ux, uy,
    outward normal nx, ny, vertical extent z0, z1 and the first reason to reject (null if there is none)."""
    dx, dy = F.col("end.x") - F.col("start.x"), F.col("end.y") - F.col("start.y")
    length = F.hypot(dx, dy)
    out = edges.withColumns({"length": length, "ux": dx / F.nullif(length, F.lit(0.0)), "uy": dy / F.nullif(length, F.lit(0.0)), "z0": F.col("ground_z"), "z1": F.coalesce("top_z", F.col("ground_z") + F.col("height_m"))})
    sign = F.when(F.col("interior_side") == "left", 1.0).when(F.col("interior_side") == "right", -1.0)
    off = F.abs(F.col("length") - F.col("claimed_length")) > F.greatest(F.lit(1e-4), 1e-5 * F.greatest(F.col("length"), F.col("claimed_length")))
    bad = lambda c: F.coalesce(~(F.abs(c) < math.inf), F.lit(True))
    reject = F.coalesce(
        F.when(F.coalesce(F.col("length") <= 1e-9, F.lit(True)), F.lit("zero_length")), F.when(sign.isNull(), F.lit("no_outward_normal")), F.when(bad(F.col("z0")), F.lit("no_ground")), F.when(bad(F.col("z1")), F.lit("no_top")),
        F.when(F.col("z1") <= F.col("z0"), F.lit("no_height")), F.when(off, F.lit("length_mismatch")),
    )
    return out.withColumns({"nx": sign * F.col("uy"), "ny": -sign * F.col("ux"), "reject": reject})


def first_mismatch(*checks: tuple[Column, str]) -> Column:
    """The reason of the first check that fails (is false or null); null if all hold."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for ok, reason in checks))
