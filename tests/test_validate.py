"""One record that is valid, and for each code one change that makes exactly that finding appear."""

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators.validate import rules, validate

SQUARE = "array(named_struct('x', 0d, 'y', 0d), named_struct('x', 10d, 'y', 0d), named_struct('x', 10d, 'y', 10d), named_struct('x', 0d, 'y', 10d))"
VALID = {
    "cluster_id": "'b1'", "footprint_source_id": "'s1'", "source_tiles": "array('t1')", "pipeline_version": "'1'", "normalization_version": "'1'", "source_sha256": "repeat('a', 64)",
    "generated_at": "'2024-01-02T03:04:05Z'", "footprint_provenance": "'county'", "horizontal_crs": "'EPSG:32616'", "vertical_crs": "'EPSG:5703'", "horizontal_unit": "'m'", "vertical_unit": "'m'",
    "z_values_metric": "true", "axis_convention": "'xy'", "ring": SQUARE, "footprint_area_m2": "100d", "perimeter_m": "40d", "centroid_x": "5d", "centroid_y": "5d", "bbox_xmin": "0d", "bbox_ymin": "0d", "bbox_xmax": "10d",
    "bbox_ymax": "10d", "orientation": "0d", "ground_z": "2d", "height_p90": "12d", "height_p95": "13d", "height_max": "14d", "estimated_height": "10d", "source_quality": "'good'", "point_count_cluster": "20L",
    "point_count_inside": "20L", "confidence": "0.5d", "class_counts": "map('6', 10L)", "quality_flags": "cast(array() as array<string>)", "roof_z": "12d", "mesh_xmin": "0d", "roof_area_m2": "100d", "volume_m3": "1000d",
    "point_count_filtered": "10L", "point_density": "0.2d", "return_count": "20L", "first_return_count": "15L", "confidence_label": "'medium'", "contract_z_unit": "'m'",
}
CHANGES = {
    "ID-001": {"cluster_id": "cast(null as string)"}, "ID-002": {"cluster_id": "' '"}, "PROV-001": {"footprint_source_id": "''", "footprint_provenance": "null"}, "PROV-002": {"source_tiles": "cast(array() as array<string>)"},
    "PROV-003": {"source_tiles": "array('t1', 't1')"}, "PROV-004": {"pipeline_version": "''"}, "PROV-005": {"normalization_version": "''"}, "PROV-006": {"source_sha256": "'xyz'"}, "PROV-007": {"generated_at": "'yesterday'"},
    "PROV-008": {"horizontal_crs": "''", "vertical_crs": "''"}, "CRS-001": {"horizontal_crs": "''", "vertical_crs": "''"}, "CRS-002": {"horizontal_crs": "''"}, "CRS-003": {"vertical_crs": "''"}, "UNIT-001": {"horizontal_unit": "''"},
    "UNIT-002": {"vertical_unit": "''"}, "UNIT-003": {"vertical_unit": "'ft'", "horizontal_unit": "'ft'"}, "UNIT-004": {"horizontal_unit": "''", "normalization_version": "''"}, "UNIT-005": {"contract_z_unit": "'ft'"},
    "UNIT-006": {"horizontal_unit": "'ft'"}, "UNIT-007": {"normalization_version": "''"}, "UNIT-008": {"axis_convention": "''"}, "GEOM-001": {"ring": f"cast(null as array<{G.POINT}>)"}, "GEOM-002": {"ring": f"slice({SQUARE}, 1, 2)"},
    "GEOM-003": {"footprint_area_m2": "-1d"}, "GEOM-004": {"perimeter_m": "0d"}, "GEOM-005": {"centroid_x": "double('NaN')"}, "GEOM-006": {"centroid_x": "15d"}, "GEOM-007": {"bbox_xmax": "double('Infinity')"},
    "GEOM-008": {"bbox_xmin": "11d"}, "GEOM-009": {"bbox_xmax": "9d"}, "GEOM-010": {"orientation": "double('NaN')"}, "GEOM-011": {"orientation": "190d"}, "GEOM-012": {"mesh_xmin": "double('NaN')"},
    "GEOM-013": {"ring": f"transform({SQUARE}, p -> named_struct('x', double('NaN'), 'y', p.y))"}, "GEOM-014": {"ring": f"transform({SQUARE}, p -> named_struct('x', double('Infinity'), 'y', p.y))"}, "GEOM-015": {"source_tiles": "array('t1', 't2')"},
    "HEIGHT-001": {"estimated_height": "double('NaN')"}, "HEIGHT-002": {"estimated_height": "0d"}, "HEIGHT-003": {"height_p95": "11d"}, "HEIGHT-004": {"estimated_height": "11d"}, "HEIGHT-005": {"roof_z": "1d"}, "HEIGHT-006": {"roof_z": "15d"},
    "HEIGHT-007": {"point_count_inside": "0L", "point_count_cluster": "0L"}, "AREA-001": {"footprint_area_m2": "0d"}, "AREA-002": {"roof_area_m2": "-1d"}, "AREA-003": {"roof_area_m2": "300d"}, "VOLUME-001": {"volume_m3": "-1d"},
    "VOLUME-002": {"volume_m3": "2000d"}, "LIDAR-001": {"point_count_inside": "-1L"}, "LIDAR-002": {"point_count_filtered": "-1L"}, "LIDAR-003": {"point_count_filtered": "21L"}, "LIDAR-004": {"point_density": "-1d"}, "LIDAR-005": {"point_density": "0.5d"},
    "LIDAR-006": {"return_count": "10L"}, "LIDAR-007": {"class_counts": "map('6', 30L)"}, "LIDAR-008": {"point_count_inside": "2L"}, "LIDAR-009": {"point_count_inside": "7L"}, "CONF-001": {"confidence": "cast(null as double)"}, "CONF-002": {"confidence": "1.5d"},
    "CONF-003": {"confidence_label": "'sure'"}, "CONF-004": {"source_quality": "'nice'"}, "CONF-005": {"source_quality": "'fallback'", "confidence": "0.9d"}, "CONF-006": {"source_tiles": "array('t1', 't2')", "confidence": "0.9d"},
    "CONF-007": {"vertical_unit": "''", "confidence": "0.9d"}, "CONF-008": {"footprint_source_id": "''", "footprint_provenance": "''", "confidence": "0.9d"},
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [("valid", {}), *CHANGES.items()]
    select = lambda name, change: "SELECT '" + name + "' AS case, " + ", ".join(f"{change.get(k, v)} AS {k}" for k, v in VALID.items())
    df = spark.sql(" UNION ALL ".join(select(n, c) for n, c in rows))
    checked = df.select("case", F.transform(F.array_compact(F.array(*rules(df))), lambda f: f["code"]).alias("codes"))
    return {r["case"]: set(r["codes"]) for r in checked.collect()}


def test_valid_record_has_no_finding(found):
    assert found["valid"] == set()


@pytest.mark.parametrize("code", CHANGES)
def test_each_code(found, code):
    assert code in found[code]


def test_repeated_ids_and_missing_columns(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 2.0), (None, 0.1)], "cluster_id string, confidence double")
    out = {(r["building_id"], r["code"]) for r in validate(df, codes=["PROV-010", "CONF-002", "ID-001", "GEOM-001"]).collect()}
    assert out == {("a", "PROV-010"), ("a", "CONF-002"), (None, "ID-001"), ("a", "GEOM-001"), (None, "GEOM-001")}
    assert validate(df.limit(0)).count() == 0
