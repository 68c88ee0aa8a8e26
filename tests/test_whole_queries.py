"""Queries without SQL over whole tables, against plain versions."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cadastra.plans.derived import footprints, points

SF = "/root/testdata/sf0.001"


def test_outliers_of_all_tiles(spark):
    p = points(spark, SF).where("classification = 6").select("point_id", "x", "y", "tile_id").collect()
    xy = np.array([(r["x"], r["y"]) for r in p])
    d = np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1))
    np.fill_diagonal(d, np.inf)
    mean = np.sort(d, 1)[:, :12].mean(1)
    tile = np.array([r["tile_id"] for r in p])
    level = {t: mean[tile == t].mean() + 2.2 * mean[tile == t].std() for t in set(tile)}
    out = {r["point_id"]: r for r in entry.queries()["c2_all_statistical_outliers"](spark, SF).collect()}
    assert len(level) > 2 and set(out) == {r["point_id"] for r in p}
    for r, m, t in zip(p, mean, tile, strict=True):
        assert abs(out[r["point_id"]]["mean_dist"] - m) < 2e-5 and out[r["point_id"]]["outlier"] == (m > level[t])


def test_findings_of_all_rules(spark):
    out = {(r["building_id"], r["code"]) for r in entry.queries()["q1_all_validate_buildings"](spark, SF).collect()}
    f = footprints(spark, SF).select(F.col("cluster_id").cast("string").alias("id"), F.col("p_size").alias("s")).collect()
    want = lambda code, keep: {(r["id"], code) for r in f if keep(r["s"])}
    expected = want("AREA-003", lambda s: s > 30) | want("CONF-002", lambda s: s == 7) | want("HEIGHT-002", lambda s: s == 9) | want("LIDAR-009", lambda s: s < 8)
    for code in ("PROV-001", "PROV-002", "PROV-004", "CRS-001", "UNIT-001", "UNIT-004"):
        expected |= want(code, lambda s: True)
    assert out == expected | want("CONF-008", lambda s: s == 7) and len(f) > 0
