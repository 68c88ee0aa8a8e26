import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.operators import evidence as E
from cadastra.operators import materials as M
from cadastra.operators import roof as R

RECORD = "evidence_id string, building_id string, building_id_namespace string, source_type string, observed_at string, confidence double, provenance_status string, evidence string"


def token(value):
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def record(key, building, source, evidence, confidence=1.0, status="observed", namespace="city:parcels", at="2024-05-01T10:00:00Z"):
    return (key, building, namespace, source, at, confidence, status, evidence if isinstance(evidence, str) else json.dumps(evidence))


RECORDS = [
    record("1", "b1", "osm_tags", {"tags": {"building:material": " Brick_Veneer ", "roof:material": "metal", "building:levels": "3", "building": "", "facade:material": "jelly"}}),
    record("2", "b1", "municipal_record", {"documented_roof_material": "Built-Up", "construction_year": 1925, "zoning_class": "R\u00e9-1"}, 0.95),
    record("3", "b2", "historic_inventory", {"documented_facade_material": "concrete", "construction_era": "deco"}, 0.5, "inferred"),
    record("4", "b2", "licensed_imagery", {"glazing_ratio": 0.8, "material_probabilities": [{"surface_type": "roof", "material": "gravel", "probability": 0.6}, {"surface_type": "glazing", "material": "lots", "probability": 0.9}], "model_metadata": {"model_name": "m", "model_version": "2"}}, 0.9),
    record("5", "zz", "generic", {"generic_clues": [{"observation_type": "surface_finish", "surface_type": "envelope", "value": "smooth", "clue_source_type": "lidar", "confidence": 0.7, "provenance_status": "observed"}, {"observation_type": "roof_cover", "surface_type": "roof", "value": 7, "unit": "pct", "clue_source_type": "field_visit", "confidence": 0.99, "provenance_status": "observed", "quality_flags": ["x"]}]}),
    record("6", "b3", "municipal_record", {"documented_roof_material": "tile"}, 0.9, "unknown"),
]


def test_five_kinds_of_records(spark):
    found = {r["clue_id"]: r for r in E.clues(spark.createDataFrame(RECORDS, RECORD)).collect()}
    of = lambda key, suffix, value: found[f"{key}:{suffix}:{token(value)}"]
    want = [
        (("1", "building_material", "brick"), "envelope_material", "brick", "building_inventory", 0.65, "record_derived"), (("1", "roof_material", "standing_seam_metal"), "roof_material", "standing_seam_metal", "building_inventory", 0.65, "record_derived"),
        (("1", "facade_material", "jelly"), "unmapped_facade_material", "jelly", "building_inventory", 0.0, "unknown"), (("1", "building_levels", "3"), "building_levels", "3", "building_inventory", 0.65, "record_derived"),
        (("2", "documented_roof_material", "membrane"), "roof_material", "membrane", "municipal_record", 0.9, "record_derived"), (("2", "construction_year", 1925), "construction_year", "1925", "municipal_record", 0.9, "record_derived"),
        (("2", "zoning_class", "Ré-1"), "zoning_class", "Ré-1", "zoning", 0.9, "record_derived"), (("3", "documented_facade_material", "generic_masonry"), "envelope_material", "generic_masonry", "building_inventory", 0.5, "inferred"),
        (("3", "construction_era", "deco"), "construction_era", "deco", "building_inventory", 0.5, "inferred"), (("4", "glazing_ratio", 0.8), "glazing_ratio", "0.8", "aerial_imagery", 0.75, "inferred"),
        (("4", f"material_probability_roof_{token('gravel')}", "gravel"), "roof_material", "gravel", "aerial_imagery", 0.6, "inferred"), (("4", f"material_probability_glazing_{token('lots')}", "lots"), "unmapped_material_probability", "lots", "aerial_imagery", 0.0, "unknown"),
        (("5", "generic_surface_finish", "smooth"), "surface_finish", "smooth", "lidar", 0.7, "inferred"), (("5", "generic_roof_cover", 7), "roof_cover", "7", "field_visit", 0.9, "observed"),
        (("6", "documented_roof_material", "tile"), "roof_material", "tile", "municipal_record", 0.0, "unknown"),
    ]
    assert [tuple(of(*key)[c] for c in ("observation_type", "value", "source_type", "confidence", "provenance_status")) for key, *_ in want] == [tuple(rest) for _, *rest in want] and len(found) == len(want)
    assert of("3", "documented_facade_material", "generic_masonry")["quality_flags"] == ["generalized_concrete_to_masonry", "normalized_from:documented_facade_material"]
    assert of("4", "glazing_ratio", 0.8)["quality_flags"] == ["model_name:m", "model_version:2"] and of("5", "generic_roof_cover", 7)["unit"] == "pct"


def test_records_to_candidates(spark):
    """M1 to M3 in a chain: what a record names weighs as its source allows."""
    clues = E.clues(spark.createDataFrame(RECORDS, RECORD))
    buildings = spark.createDataFrame([("b1", "residential", 8.0, 2, None, None, None, None), ("b2", "office", 60.0, 15, None, None, None, None), ("b3", *[None] * 7)], BUILDING)
    best = {(r["building_id"], r["surface_type"]): (r["material"], r["confidence"], r["status"]) for r in M.candidates(M.contributions(clues, buildings)).where("rank = 1").collect()}
    assert best["b1", "envelope"] == ("brick", round(0.95 * 0.65, 4), "record_derived") and best["b1", "roof"] == ("membrane", round(0.95 * 0.9, 4), "record_derived")
    assert best["b2", "envelope"] == ("generic_masonry", 0.325, "inferred") and best["b2", "roof"] == ("gravel", round(0.65 * 0.6, 4), "inferred") and best["b2", "glazing"][0] == "curtain_wall" and ("b3", "roof") not in best
    assert [(r["building_id"], r["error"]) for r in E.clue_errors(clues, buildings).join(clues, "clue_id").distinct().collect()] == [("zz", "orphan")] * 2
    assert E.clue_errors(clues.unionByName(clues), buildings).where("error = 'duplicate'").count() == clues.count()


def test_record_errors(spark):
    bad = [record("7", "b", "rumour", {}), record("8", "b", "osm_tags", {"tags": {}}), record("9", "b", "osm_tags", "{no json", namespace="parcels"), record("10", "b", "generic", {"generic_clues": []}, namespace="CID:x", at="yesterday"), RECORDS[0]]
    got = sorted(tuple(r) for r in E.record_errors(spark.createDataFrame([*RECORDS, *bad], RECORD)).collect())
    assert got == sorted([("7", "unsupported_source"), ("8", "no_clue"), ("9", "no_clue"), ("9", "unqualified_namespace"), ("10", "no_clue"), ("10", "prohibited_authority"), ("10", "bad_timestamp"), ("1", "duplicate")])


CLUE = "clue_id string, building_id string, surface_type string, observation_type string, value string, unit string, source_type string, confidence double, provenance_status string"
BUILDING = "building_id string, building_use string, height_m double, floors_est int, roof_geometry_class string, municipal_construction_type string, municipal_roof_type string, metadata_provenance struct<source_type:string,provenance_status:string,confidence:double>"


def ranked(spark, clues, *buildings):
    out = M.candidates(M.contributions(spark.createDataFrame(clues, CLUE), spark.createDataFrame(buildings, BUILDING))).orderBy("building_id", "surface_type", "rank").collect()
    return {(b, s): [(r["material"], r["confidence"], r["status"]) for r in out if (r["building_id"], r["surface_type"]) == (b, s)] for b, s in {(r["building_id"], r["surface_type"]) for r in out}}


def test_materials_by_rule(spark):
    source = ("municipal_record", "observed", 0.9)
    known = ("b1", "residential", 40.0, 3, None, None, None, source)
    out = ranked(spark, [("c1", "b1", "envelope", "material", "Brick", None, "municipal_record", 0.95, "observed")], known)
    assert out["b1", "envelope"][0] == ("brick", 0.9025, "record_derived") and out["b1", "envelope"][1][0] == "generic_masonry"
    flat = [("r1", "b1", "roof", "roof_geometry", "flat", None, "lidar", 0.9, "inferred"), ("r2", "b1", "roof", "roof_surface_character", "continuous", None, "aerial_imagery", 0.7, "inferred")]
    out = ranked(spark, flat, known)
    assert [m for m, _, _ in out["b1", "roof"]] == ["membrane", "gravel", "concrete"] and out["b1", "roof"][0][1] == round(0.42 * 0.7, 4)
    assert ("b1", "roof") not in ranked(spark, flat[:1], known) and ("b1", "roof") not in ranked(spark, flat, (*known[:2], 20.0, *known[3:]))
    smooth = [("s1", "b1", "envelope", "surface_finish", "smooth", None, "aerial_imagery", 0.5, "inferred")]
    out = ranked(spark, smooth, known)["b1", "envelope"]
    assert [m for m, _, _ in out] == ["stucco", "painted_concrete"] and out[0][1] == round(0.16 * 0.9 + 0.2 * (1 - 0.16 * 0.9) * 0.14, 4)
    glass = ranked(spark, [("g1", "b1", "glazing", "glazing_ratio", "80", "percent", "street_view", 1.0, "observed"), ("g2", "b1", "glazing", "glazing_ratio", "180", "percent", "street_view", 1.0, "observed")], known)
    assert glass["b1", "glazing"] == [("curtain_wall", 0.72, "inferred"), ("high", 0.216, "inferred")]
    assert ranked(spark, [("u", "b1", "roof", "roof_cover", "built up", None, "permit", 0.9, "unknown")], known) == {}
    assert ranked(spark, [], ("b2", None, None, None, None, "CMU", "clay tile", source)) == {("b2", "envelope"): [("generic_masonry", 0.855, "record_derived")], ("b2", "roof"): [("tile", 0.855, "record_derived")]}


def test_openings(spark):
    f = spark.createDataFrame([("a", 0, 9.0, 2, 3.2)], "building_id string, edge int, length double, floors int, floor_height double")
    assert E.facade_openings(f).count() == 6


@pytest.fixture(scope="module")
def roofs(spark):
    rng = np.random.default_rng(3)
    x, y = (v.ravel() for v in np.meshgrid(np.arange(0, 10, 0.5), np.arange(0, 10, 0.5)))
    shapes = {
        "flat": np.full(len(x), 12.0), "noisy": 12 + rng.normal(0, 0.04, len(x)), "slope": 8 + 0.4 * x, "gable": 12 - 0.6 * np.abs(x - 4.75),
    }
    rows = [(k, float(a), float(b), float(c), 2.0) for k, z in shapes.items() for a, b, c in zip(x, y, z, strict=True)] + [("few", float(i), 0.0, 9.0, 2.0) for i in range(5)]
    df = spark.createDataFrame(rows, "building_id string, x double, y double, z double, ground_z double")
    return R.roof_points(df)


def test_roof_classes(roofs):
    out = {r["building_id"]: r for r in R.classify(roofs, R.planes(roofs.repartition(3))).collect()}
    assert {k: r["roof_class"] for k, r in out.items()} == {"flat": "flat_roof", "noisy": "flat_roof", "slope": "single_sloped_plane", "gable": "coherent_two_plane_ridge_candidate", "few": "insufficient_evidence"}
    assert out["flat"]["outcome"] == "flat_fallback_recommended" and out["few"]["outcome"] == "insufficient_data"


def test_flat_cap_error(roofs):
    out = {r["building_id"]: r for r in R.flat_cap_error(roofs).collect()}
    assert out["flat"]["rmse"] < 1e-6 and out["noisy"]["rmse"] > 0 and out["slope"]["worst"] > 1


def test_planes_dont_depend_on_partitions(roofs):
    key = lambda df: sorted((r["building_id"], r["plane"], round(r["a"], 9), r["n"]) for r in df.collect())
    assert key(R.planes(roofs.coalesce(1))) == key(R.planes(roofs.repartition(7, F.col("x"))))


def test_all_points_count_whatever_the_sample(spark):
    """Equal points count each time, and a building that is dealt over parts has the planes that it has in one."""
    x, y = (v.ravel() for v in np.meshgrid(np.arange(0, 30, 0.5), np.arange(0, 20, 0.5)))
    z = np.where(x < 15, 12.0, 16.0) + 0.1 * y  # steps, so that no tilted plane holds points of both
    rows = [("big", float(a), float(b), float(c), 2.0) for a, b, c in zip(x, y, z, strict=True)]
    p = R.roof_points(spark.createDataFrame(rows + rows[:100] + [("big", None, 1.0, 9.0, 2.0), ("big", 1.0, float("nan"), 9.0, 2.0)], "building_id string, x double, y double, z double, ground_z double"))
    whole, parts = (R.planes(p, r).orderBy("plane").collect() for r in (R.Roof(sample=10_000), R.Roof(sample=128, part=200)))
    assert sum(v["n"] for v in whole) == len(rows) + 100
    assert sorted(v["n"] for v in whole) == sorted(v["n"] for v in parts)
    assert all(abs(v["slope"] - np.degrees(np.arctan(0.1))) < 1e-6 and v["rmse"] < 1e-6 and v["coherence"] == 1 for v in whole + parts)


def test_planes_apart_are_no_ridge(spark):
    """Two opposed slopes with a gap between them, points in the corners of an L, and a building without roof points."""
    x, y = (v.ravel() for v in np.meshgrid(np.arange(0, 6, 0.5), np.arange(0, 10, 0.5)))
    rows = [("apart", float(a), float(b), 8 + 0.5 * float(a), 2.0) for a, b in zip(x, y, strict=True)] + [("apart", float(30 - a), float(b), 8 + 0.5 * float(a), 2.0) for a, b in zip(x, y, strict=True)]
    p = R.roof_points(spark.createDataFrame(rows, "building_id string, x double, y double, z double, ground_z double"))
    box = lambda w, h: [(0.0, 0.0), (w, 0.0), (w, h), (0.0, h)]
    f = spark.createDataFrame([("apart", box(30.0, 9.5)), ("none", box(3.0, 3.0))], "building_id string, ring array<struct<x:double,y:double>>")
    totals = spark.createDataFrame([("apart", len(rows)), ("none", 0)], "building_id string, n_total long")
    out = {r["building_id"]: r for r in R.classify(p, R.planes(p), R.Roof(), f, totals).collect()}
    a = out["apart"]
    assert (a["n_planes"], a["ridge"], a["roof_class"], a["outcome"]) == (2, False, "complex_roof", "manual_review_required")
    assert abs(a["confidence"] - 0.78) < 1e-9 and abs(a["coverage"] - 56 / 140) < 0.1
    low = [r for r in rows if min(r[1], 30 - r[1], r[2], 9.5 - r[2]) <= 1.5]
    assert a["eave_points"] == len(low) and abs(a["eave_height"] - np.percentile([r[3] for r in low], 20)) < 1e-9
    assert (out["none"]["roof_class"], out["none"]["confidence"], out["none"]["n_points"]) == ("insufficient_evidence", 0.0, 0)
    none = R.planes(p.limit(0))
    assert none.count() == 0 and R.classify(p.limit(0), none).count() == 0
