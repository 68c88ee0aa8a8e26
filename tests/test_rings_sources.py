import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import records as X
from cadastra.operators import rings as R
from cadastra.sources import features as S


def test_hulls_in_two_steps(spark):
    rng = np.random.default_rng(0)
    rows = [(k, float(x), float(y)) for k in range(3) for x, y in rng.uniform(0, 10, (200, 2))] + [(0, float(x), float(y)) for x in (0, 10) for y in (0, 10)] + [(7, 1.0, 1.0), (7, 2.0, 2.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "cluster_id long, x double, y double")
    out = {r["cluster_id"]: r for r in R.cluster_hulls(df.repartition(5), "cluster_id").collect()}
    one = {r["cluster_id"]: r for r in R.cluster_hulls(df.coalesce(1), "cluster_id").collect()}
    assert set(out) == {0, 1, 2} and abs(out[0]["area_m2"] - 100) < 1e-9 and out[0]["n_points"] == 204
    assert all(abs(out[k]["area_m2"] - one[k]["area_m2"]) < 1e-9 for k in out)


def test_hulls_in_polygons_make_no_pairs(spark, monkeypatch):
    from cadastra.operators import spatial_join as J

    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.uniform(0, 100, (4000, 2)).round(2), rng.uniform(40, 41, (3000, 2)).round(2)])  # and a crowd
    points = spark.createDataFrame([(float(x), float(y)) for x, y in xy] + [(None, 1.0)], "x double, y double")
    boxes = [(10, 10, 30, 25), (35, 35, 45, 45), (40, 40, 40.5, 40.5), (-50, -50, 500, 500), (99, 99, 99.01, 99.01), (12.5, 60, 90, 62)]
    corners = [[(a, b), (c, b), (c, d), (a, d)] for a, b, c, d in boxes] + [[(0, 0), (60, 10), (20, 50)]]
    polygons = spark.createDataFrame([(k, [(float(x), float(y)) for x, y in r]) for k, r in enumerate(corners)], "key long, ring array<struct<x:double,y:double>>")
    want = R.cluster_hulls(J.points_in_polygons(points, polygons).select("key", "x", "y"), "key", 0.0).collect()
    box_parts = R._box_parts
    monkeypatch.setattr(R, "_box_parts", lambda p, b, k: box_parts(p, b, k, 500))  # the crowd's tile in parts
    got = R.hulls_in_polygons(points, polygons, "key", least_area=0.0).collect()
    assert {r["key"]: (r["n_points"], {tuple(p) for p in r["ring"]}) for r in got} == {r["key"]: (r["n_points"], {tuple(p) for p in r["ring"]}) for r in want}
    assert {r["key"] for r in got} == {0, 1, 2, 3, 5, 6}
    for r in got:
        brute = [p for p in xy if r["key"] < 6 and boxes[r["key"]][0] <= p[0] < boxes[r["key"]][2] and boxes[r["key"]][1] <= p[1] < boxes[r["key"]][3]]
        assert r["key"] == 6 or r["n_points"] == len(brute)
    assert R.hulls_in_polygons(points.where("x > 1000"), polygons, "key").count() == 0


def test_cell_outlines_with_hole(spark):
    cells = [("a", r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)]
    out = R.cell_rings(spark.createDataFrame(cells, "key string, row long, col long"), 2.0).first()["rings"]
    areas = sorted(sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(r, r[1:] + r[:1], strict=True)) / 2 for r in out)
    assert areas == [-4.0, 36.0] and all(len(r) == 4 for r in out)


def test_simplify_and_faces(spark):
    ring = [(0.0, 0.0), (5.0, 0.01), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    df = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ring]), (2, None)], f"id int, ring {R.RING}")
    out = {r["id"]: r["ring"] for r in R.simplified(df, 0.05).collect()}
    assert len(out[1]) == 4 and out[2] is None
    grid = spark.createDataFrame([(i, j, 0.0) for i in range(3) for j in range(2)], "ix long, iy long, z double")
    assert R.terrain_faces(grid).count() == 4


def test_geometry_by_hand(spark):
    square = "array(named_struct('x', 0d, 'y', 0d), named_struct('x', 4d, 'y', 0d), named_struct('x', 4d, 'y', 4d), named_struct('x', 0d, 'y', 4d))"
    df = spark.sql(f"SELECT {square} AS ring, array(named_struct('x', 0d, 'y', 0d), named_struct('x', 4d, 'y', 4d), named_struct('x', 4d, 'y', 0d), named_struct('x', 0d, 'y', 4d)) AS bow")
    r, b = F.col("ring"), F.col("bow")
    tilted = F.array(*(G.point(F.lit(x), F.lit(y)) for x, y in ((1.0, 0.0), (2.0, 1.0), (1.0, 2.0), (0.0, 1.0))))
    x = df.select(
        G.area(r).alias("area"), G.is_simple(r).alias("s1"), G.is_simple(b).alias("s2"), G.contains(r, F.lit(1.0), F.lit(3.0)).alias("in"), G.contains(r, F.lit(5.0), F.lit(3.0)).alias("out"),
        G.edge_distance(r, F.lit(6.0), F.lit(2.0)).alias("d"), G.min_rotated_rectangle(tilted)["area"].alias("rot"), G.area(G.clip_convex(r, tilted)).alias("clip"),
        G.to_utm(F.lit(-87.0), F.lit(0.0), 16).alias("u"), G.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)).alias("km"),
    ).first()
    assert (x["area"], x["s1"], x["s2"], x["in"], x["out"], x["d"]) == (16.0, True, False, True, False, 2.0)
    assert abs(x["rot"] - 2) < 1e-9 and abs(x["clip"] - 2) < 1e-9 and abs(x["u"]["x"] - 500000) < 1e-6 and abs(x["km"] - 6371 * np.pi / 2) < 1e-6


def test_features_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}])], f"cluster_id long, tile_id string, ring {R.RING}")
    S.write_features(df, f"{tmp_path}/f")
    back = S.read_features(spark, f"{tmp_path}/f", lines=True)
    row = back.select("properties", S.ring_of(F.col("type"), F.col("coordinates")).alias("ring"), S.representative_point(F.col("type"), F.col("coordinates")).alias("p")).first()
    assert row["properties"] == {"cluster_id": "1", "tile_id": "a"} and len(row["ring"]) == 4 and row["p"]["x"] == 1.0
    whole = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [3, 4]}, "properties": {"n": 1}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]], [[[0, 0], [5, 0], [5, 5]]]]}, "properties": {}}]}
    (tmp_path / "c.json").write_text(json.dumps(whole))
    rows = S.read_features(spark, f"{tmp_path}/c.json").select("type", S.representative_point(F.col("type"), F.col("coordinates")).alias("p"), S.ring_of(F.col("type"), F.col("coordinates")).alias("r")).collect()
    assert rows[0]["p"]["y"] == 4.0 and max(q["x"] for q in rows[1]["r"]) == 5.0


def test_addresses_records_inventory_and_tiles(spark, tmp_path):
    (tmp_path / "a.csv").write_text("number,street,Longitude,LATITUDE\n1,Main,-80.1,25.7\n1,Main,-80.10001,25.7\n2,Oak,999,999\n3,Elm,x,25\n")
    a = S.read_address_csv(spark, f"{tmp_path}/a.csv", {"house_number": "number"}).withColumn("address_id", F.monotonically_increasing_id())
    assert a.count() == 2 and S.deduplicated(a).count() == 1
    for name, text in (("r1.json", '[{"id": "x", "v": 1}]'), ("r2.json", '{"id": "x", "v": 1}\n{"id": "y", "v": 2}'), ("r3.json", '{"type": "FeatureCollection", "features": [{"properties": {"id": "z", "v": 3}}]}'), ("r4.json", '{"buildings": [{"id": "q", "v": 4}, {"id": "p", "v": 5}]}')):
        (tmp_path / name).write_text(text)
    assert [S.load_records(spark, f"{tmp_path}/r{k}.json", "id string, v int").count() for k in (1, 2, 3, 4)] == [1, 2, 1, 2]
    inventory = {r["name"]: r for r in S.file_inventory(spark, str(tmp_path)).collect()}
    assert inventory["r1.json"]["extension"] == "json" and inventory["a.csv"]["size_bytes"] > 0
    t = spark.createDataFrame([("c", "t1", 1), ("c", "t2", 2)], "city_id string, tile_id string, n int")
    S.write_by_tile(t, f"{tmp_path}/tiles")
    S.write_by_tile(t.where("tile_id = 't1'").withColumn("n", F.lit(9)), f"{tmp_path}/tiles")
    done = spark.read.parquet(f"{tmp_path}/tiles")
    assert {(r["tile_id"], r["n"]) for r in done.collect()} == {("t1", 9), ("t2", 2)}
    assert S.unfinished(t.unionByName(spark.createDataFrame([("c", "t3", 3)], t.schema)), done).first()["tile_id"] == "t3"
    m = S.manifest(t.drop("city_id"), {"n_tiles": F.count("*")}).first()
    assert m["n_tiles"] == 2 and m["tiles"]["t2"]["n"] == 2


def test_layers_masses_findings_and_tables(spark, tmp_path):
    shapes = [("Point", [3, 4]), ("LineString", [[0, 0], [2, 6]]), ("MultiPolygon", [[[[0, 0], [4, 0], [4, 4], [0, 0]]], [[[10, 10], [12, 10], [12, 13], [10, 10]]]]), ("Polygon", [])]
    features = [{"type": "Feature", "geometry": {"type": k, "coordinates": c}, "properties": {"h": str(i)}} for i, (k, c) in enumerate(shapes)] + [{"type": "Feature", "geometry": None, "properties": {}}]
    (tmp_path / "l.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows, skipped = S.read_layer(spark, f"{tmp_path}/l.json")
    assert [(r["x"], r["y"]) for r in rows.where("usable").orderBy("x").collect()] == [(1.0, 3.0), (3.0, 4.0), (6.5, 47 / 8)] and rows.agg(skipped).first()[0] == 2
    moved, _ = S.read_layer(spark, f"{tmp_path}/l.json", lambda x, y: F.when(x < 5, F.struct((x + 1).alias("x"), y.alias("y"))))
    assert sorted(r["x"] for r in moved.where("usable").collect()) == [2.0, 4.0]
    m = {r["h"]: (r["centroid_x"], r["centroid_y"]) for r in S.read_mass_rows(spark, None, f"{tmp_path}/l.json", ("h",)).where("h IS NOT NULL").collect()}
    assert m["0"] == ("3", "4") and m["1"] == (None, None)
    for name, text in (("a.json", '[{"code": "A", "n": 1}, {"code": "B", "n": 2}]'), ("b.json", '{"issues": [{"code": "C", "n": 3}]}'), ("c.jsonl", '{"code": "D", "n": 4}\n{"code": "E", "n": null}')):
        (tmp_path / name).write_text(text)
    found = {k: sorted(r["code"] for r in S.load_findings(spark, f"{tmp_path}/{k}", "code string, n int").collect()) for k in ("a.json", "b.json", "c.jsonl")}
    assert found == {"a.json": ["A", "B"], "b.json": ["C"], "c.jsonl": ["D", "E"]}
    S.write_table(spark.createDataFrame([(1, [1, 2], None), (2, [], "x")], "id int, a array<int>, t string"), f"{tmp_path}/t")
    assert S.read_mass_rows(spark, f"{tmp_path}/t/csv", None, ()).orderBy("id").first()["a"] == "[1,2]" and set(spark.read.json(f"{tmp_path}/t/json").columns) == {"id", "a", "t"}


def test_export_records(spark):
    g = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0)])], f"cluster_id long, ring {R.RING}")
    rows = spark.createDataFrame([("1", "7.256", None, "True"), ("x", "3", "good", "1"), ("1.0", "tall", "good", "1"), ("1", None, "empty", None)], "cluster_id string, estimated_height string, source_quality string, lod0_included string")
    out = sorted(tuple(r) for r in X.export_records(rows, g, 1.0, 1.0).collect())
    assert out == [(1, 0.0, 1.0, 0.0, "empty", False), (1, 7.26, 1.0, 0.0, "unknown", True)]
    with pytest.raises(Exception, match="no footprint geometry"):
        X.export_records(rows.withColumn("cluster_id", F.lit("2")), g, 0.0, 0.0).collect()
    e = X.enrichment_records(spark.createDataFrame([(1, 500000.0, 0.0, 9.0, "shed", 2018), (2, 500000.0, 0.0, None, None, None)], "cluster_id long, cx double, cy double, county_height_m double, bld_type string, year_update int"), spark.createDataFrame([(1, 0.0, 12.34, "good"), (3, 8.0, None, None)], "cluster_id long, height_m double, footprint_area_m2 double, quality string"), "c", 16)
    got = {r["id"]: r for r in e.collect()}
    assert (got[1]["height_m"], got[2]["height_m"], got[3]["height_m"]) == (9.0, 6.0, 8.0) and got[3]["lat"] is None and abs(got[1]["lon"] + 87) < 1e-9
