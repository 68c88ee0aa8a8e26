"""Two layers, companion files, boxes and claim histories, by hand."""

from cadastra.operators import comparisons as P


def test_two_layers(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 50.0), (2, 0.0, 1.0, None, 0.0), (3, 500.0, 0.0, 4.0, 9.0), (4, None, 0.0, 4.0, 9.0)], "left_id int, x double, y double, height double, area double")
    right = spark.createDataFrame([(7, 3.0, 4.0, 7.5, 25.0), (8, -3.0, 4.0, 1.0, 25.0), (9, 0.0, 20.0, 1.0, 0.0)], "right_id int, rx double, ry double, right_height double, right_area double")
    out = P.compare_layers(left, right)
    got = {(r["left_id"], r["right_id"]): (r["status"], r["dist"], r["height_diff"], r["area_ratio"]) for r in out.collect()}
    assert got == {(1, 7): ("matched", 5.0, 2.5, 2.0), (2, 7): ("matched", 4.24, None, None), (3, None): ("no_match", None, None, None), (4, None): ("no_match", None, None, None), (None, 8): ("right_only", None, None, None), (None, 9): ("right_only", None, None, None)}
    assert tuple(P.comparison_summary(out).first()) == (2, 2, 2, 2.5, 2.5, 2.5)


def test_companions(spark):
    paths = ["a/Roads.shp", "a/roads.SHX", "a/roads.dbf", "a/roads.prj", "b/roads.shp", "b/x.dbf", "t.copc.laz", "t.laz", "noext", "a/.shp", "a/roads.dbf"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {(r["folder"], r["stem"]): (r["missing_required"], r["missing_recommended"], r["ok"]) for r in P.companion_sets(files).collect()}
    assert got == {("a", "roads"): ([], [".cpg"], True), ("b", "roads"): ([".dbf", ".shx"], [".cpg", ".prj"], False)}
    assert {r["kind"]: r["n"] for r in P.files_by_kind(files).collect()} == {".shp": 2, ".shx": 1, ".dbf": 3, ".prj": 1, ".laz": 2, "": 2}


def test_boxes(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", -3.0, 9.1234567), ("a", float("nan"), 0.0), ("b", None, 1.0)], "layer string, x double, y double")
    assert [(r["layer"], r["n"], tuple(r["box"])) for r in P.layer_box(df, by=["layer"]).collect()] == [("a", 2, (-3.0, 2.0, 1.0, 9.123457))]
    assert tuple(P.layer_box(df.where("layer = 'b'")).first()) == (0, None)


def test_claim_history(spark):
    rows = [("s", 1, "active"), ("s", 2, "active"), ("s", 3, "released"), ("s", 4, None), ("s", 5, None), ("s", 6, "active"), ("t", 1, "revoked"), ("t", 2, "revoked"), ("u", 1, None), ("u", 2, "revoked")]
    out = P.claim_history(spark.createDataFrame(rows, "k string, seq int, status string"), "k", ["seq"])
    assert sorted((r["k"], r["seq"], r["event_type"], r["previous_status"]) for r in out.collect()) == [
        ("s", 1, "created", None), ("s", 3, "released", "active"), ("s", 4, "status_changed", "released"), ("s", 6, "status_changed", None), ("t", 1, "created", None), ("u", 1, "created", None), ("u", 2, "revoked", None),
    ]
