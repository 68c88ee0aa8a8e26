"""Crowds of points in shapes: counts are those of every pair, and no pair is a row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import crowds as N
from cadastra.operators import crowds as X
from cadastra.operators import spatial_join as J
from cadastra.operators import zonal as Z


def shapes(rng, m):
    at, half = np.round(rng.uniform(-5, 55, (m, 2)), 2), rng.integers(0, 10, (m, 2)).astype(float)
    half[0] = 1000
    box = np.column_stack([at - half, at + half])
    box[: m // 4, 2:] = box[: m // 4, :2]
    return box, np.choose(rng.integers(0, 4, m), [np.full(m, np.nan), np.full(m, 5.0), np.full(m, -1.505), np.round(rng.uniform(0, 15, m), 2)])


@pytest.mark.parametrize("n, values", [(3000, 40), (1, 1), (2, 2), (500, 7), (4000, 900)])
def test_counts_by_cells_are_those_of_every_point(n, values):
    rng = np.random.default_rng(n)
    x, y = np.round(rng.uniform(0, 50, (2, n)), 2)
    if n == 500:
        y[:] = 20.0  # all in a row
    code = rng.integers(0, values, n)
    box, reach = shapes(rng, 120)
    got, want = np.zeros((120, values), int), np.zeros((120, values), int)
    for k, c, m in N.counted(x, y, code, values, box, reach):
        np.add.at(got, (k, c), m)
    for k in range(120):
        want[k] = np.bincount(code[N.holds(x, y, np.repeat(box[k : k + 1], n, 0), np.repeat(reach[k], n))], minlength=values)
    assert (got == want).all()


def test_counts_meet_tile_by_tile_and_crowded_tiles_in_parts(spark, monkeypatch):
    """Boxes that several tiles hold, rings around them, bands along their sides, and polygons that are no rectangle."""
    monkeypatch.setattr(X, "TILE", 40)
    monkeypatch.setattr(X, "GROUP", 15)
    monkeypatch.setattr(J, "radius_join", None)
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), None if c == 3 else float(c)) for a, b, c in zip(*np.round(rng.uniform(0, 60, (2, 700)), 1), rng.integers(0, 9, 700), strict=True)] + [(float("nan"), 1.0, 1.0), (None, 2.0, 1.0)]
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    rings = [(k, box(float(a), float(b), float(c), float(d))) for k, (a, b, c, d) in enumerate(np.column_stack([rng.integers(-5, 55, (30, 2)), rng.integers(1, 25, (30, 2))]))] + [(90, [(0.0, 0.0), (40.0, 5.0), (10.0, 50.0)])]
    points, polygons = spark.createDataFrame(rows, "x double, y double, z double"), spark.createDataFrame(rings, "id long, ring array<struct<x:double,y:double>>")
    count = lambda pairs: {(r["id"], r["z"]): r["n"] for r in pairs.groupBy("id", "z").agg(F.count("*").alias("n")).collect()}
    take = lambda counts: {(r["id"], r["z"]): r["n"] for r in counts.collect()}
    good = points.where("x IS NOT NULL AND NOT isnan(x)")
    inside = J.points_in_polygons(good, polygons)
    assert take(X.counts_inside(points, polygons, "id")) == count(inside)
    assert take(X.counts_around(points, polygons, "id", 2.5)) == count(J.points_near_polygons(good, polygons, 2.5))
    along = F.least(*(F.abs(F.col(c) - F.col("ring")[k][c]) for c in "xy" for k in (0, 2))) <= 1.55
    got = take(X.counts_along(points, polygons.where("id < 90"), "id", 1.55))
    assert got == count(inside.where("id < 90").where(along))


def test_heights_make_no_pairs(spark, monkeypatch):
    """zonal_heights over crowds: points and footprints aren't joined as rows."""
    for name in ("points_in_polygons", "points_in_circles", "points_near_polygons", "_candidates"):
        monkeypatch.setattr(J, name, lambda *_: pytest.fail("pairs are made"))
    points = spark.range(4000).selectExpr("id % 63 + 0.5D AS x", "id DIV 63 + 0.5D AS y", "CAST(id % 10 AS DOUBLE) AS z", "IF(id % 2 = 0, 2, 6) AS classification", "'t' AS tile_id")
    f = spark.range(50).selectExpr("id AS cluster_id", "20.0D AS cx", "20.0D AS cy", "5.0D AS hw", "4.0D AS hh", "'t' AS tile_id", "40.0D AS area_m2", "array(named_struct('x', 15.0D, 'y', 16.0D), named_struct('x', 25.0D, 'y', 16.0D), named_struct('x', 25.0D, 'y', 24.0D), named_struct('x', 15.0D, 'y', 24.0D)) AS ring")
    rows = Z.zonal_heights(points, f).collect()
    z = np.array([(i % 10) for i in range(4000) if 15 <= i % 63 + 0.5 < 25 and 16 <= i // 63 + 0.5 < 24], float)
    assert len(rows) == 50 and {(r["n_inside"], r["p90"]) for r in rows} == {(80, np.percentile(z, 90))}


def test_nearest_of_each_layer_makes_no_pairs(spark, monkeypatch):
    """Nearest features of layers with their own radius, ties to the least id, across tiles and in parts."""
    from cadastra.operators import enrich as E

    monkeypatch.setattr(E, "radius_join", lambda *_: pytest.fail("pairs are made"))
    monkeypatch.setattr(X, "TILE", 30)
    monkeypatch.setattr(X, "GROUP", 2000)
    rng = np.random.default_rng(5)
    b = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.integers(0, 60, (200, 2)))] + [(900, None, 1.0), (901, float("nan"), 2.0)]
    f = [(("a", "b", None)[k % 3], 1000 - k, float(x), float(y), (3.0, 9.0, 5.0)[k % 3]) for k, (x, y) in enumerate(rng.integers(0, 60, (240, 2)))]
    buildings = spark.createDataFrame(b, "cluster_id long, cx double, cy double")
    features = spark.createDataFrame(f, "layer_id string, feature_id long, rx double, ry double, radius double")
    got = {(r["cluster_id"], r["layer_id"]): (r["dist"], r["feature_id"]) for r in E.nearest_of_layers(buildings, features, 9.0).collect()}
    want = {}
    for k, x, y in b[:200]:
        for layer, i, rx, ry, radius in f:
            d = ((x - rx) ** 2 + (y - ry) ** 2) ** 0.5
            if d <= radius:
                want[k, layer] = min(want.get((k, layer), (99.0, 0)), (d, i))
    assert got == want and len({k[1] for k in got}) == 3
    monkeypatch.undo()
    right = features.select("feature_id", "rx", "ry")
    near = X.nearest_of_layers(buildings, right, 9.0, "feature_id", "cx", "cy")
    one = {r["cluster_id"]: r["feature_id"] for r in near.collect()}
    assert one == {k: min(((((x - v[2]) ** 2 + (y - v[3]) ** 2) ** 0.5, v[1]) for v in f), default=None)[1] if x is not None and x == x else None for k, x, y in b}


def test_nearest_of_many_rows_makes_no_pairs(spark, monkeypatch):
    """Rows meet tile by tile, rows without coordinates stay, and ties go to the least id; arrays don't travel."""
    joined = J.nearest_join
    monkeypatch.setattr(J, "nearest_join", lambda *_: pytest.fail("pairs are made"))
    left = spark.range(300).selectExpr("id", "IF(id = 7, NULL, id % 20 + 0.5D) AS x", "id DIV 20 + 0.5D AS y", "array(id) AS other")
    right = spark.range(900).selectExpr("1000 - id AS rid", "id % 30 * 1D AS rx", "id DIV 30 * 1D AS ry")
    want = {i: (None, None) if i == 7 else (1000 - ((i // 20 + 1) * 30 + i % 20 + 1), 0.5**0.5) for i in range(300)}
    rows = lambda d: {r["id"]: (r["rid"], r["dist"]) for r in d.collect()}
    assert rows(X.nearest(left.drop("other"), right, 10.0, "id", "rid")) == want
    monkeypatch.setattr(J, "nearest_join", joined)
    assert rows(X.nearest(left, right, 10.0, "id", "rid")) == want


def test_primary_overlaps_are_those_of_every_pair(spark, monkeypatch):
    """Counts, largest shares, ties to the least id, across tiles and in parts; other polygons are left to pairs."""
    from cadastra.operators import audit as A
    from cadastra.operators import checks as K

    monkeypatch.setattr(X, "TILE", 100)
    rng = np.random.default_rng(9)
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    rows = [(k, box(*map(float, v))) for k, v in enumerate(np.column_stack([rng.integers(0, 90, (300, 2)), rng.integers(1, 9, (300, 2))]))]
    df = spark.createDataFrame(rows, "id long, ring array<struct<x:double,y:double>>")
    a, b = df.where("id % 2 = 1").selectExpr("id AS objectid", "ring AS left_ring"), df.where("id % 2 = 0").selectExpr("id AS cluster_id", "ring AS right_ring")
    names = ("objectid", "cluster_id", "left_ring", "right_ring")
    o = J.polygon_overlay(a, b, *names).where("shared > 1e-6").select("objectid", "cluster_id", F.round("shared", 6).alias("area"))
    every = K.primary_assignments(o).cache()
    columns = ("objectid", "candidates", "area", "cluster_id", "tie")
    want = sorted(tuple(r) for r in every.where("rank = 1").select(*columns).collect())
    best = X.primary_overlaps(a, b, *names)
    assert sorted(tuple(r) for r in best.select(*columns).collect()) == want and any(r[4] for r in want) and max(r[1] for r in want) > 2
    assert A.association_summary_of_objects(best, b, a).first().asDict() == A.association_summary(every, b, a).first().asDict()
    assert X.primary_overlaps(a.withColumn("left_ring", F.slice("left_ring", 1, 3)), b, *names) is None
