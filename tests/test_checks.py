from pyspark.sql import functions as F

from cadastra.functions import scalars as S
from cadastra.operators import audit as A
from cadastra.operators import checks as C
from cadastra.operators import profile as P


def test_tile_manifest(spark):
    t = spark.createDataFrame(
        [("a", "a.laz", True, 0.0, 0.0, 1.0, 1.0, 100), ("b", "b.laz", True, 2.0, 0.0, 1.0, 1.0, 100), ("b", "", False, None, None, None, None, None), ("c", "c.laz", False, 0.0, 0.0, 1.0, 1.0, 10**9), (None, "d.laz", True, 0.0, 0.0, 1.0, 1.0, 1)],
        "tile_id string, filename string, on_disk boolean, xmin double, ymin double, xmax double, ymax double, size_bytes long",
    )
    i = spark.createDataFrame([("a.laz", 100), ("c.laz", 5), ("d.laz", 0)], "filename string, size long")
    out = {(r["tile_id"], r["filename"]): (r["errors"], r["warnings"]) for r in C.tile_manifest(t, i).collect()}
    assert out["a", "a.laz"] == ([], [])
    assert out["b", "b.laz"] == (["duplicate_id", "inverted_box", "missing_file"], [])
    assert out["b", ""] == (["duplicate_id", "no_filename"], ["no_box"])
    assert out["c", "c.laz"] == ([], ["not_marked", "size_differs"])
    assert out[None, "d.laz"] == (["no_id", "empty_file"], [])
    catalog = spark.createDataFrame([("a.laz", 100), ("x.laz", 1), ("c.laz", 10**6)], "filename string, size long")
    assert {r["filename"]: r["status"] for r in C.downloads(catalog, i).collect()} == {"a.laz": "ok", "x.laz": "missing", "c.laz": "size_mismatch", "d.laz": "unlisted"}


def test_package_and_corrupt_files(spark):
    good, bad = "a" * 64, "b" * 64
    index = spark.createDataFrame([("x.json", good, "cc0"), ("/etc/x", good, None), ("gone.json", "zz", "cc0"), ("y.json", good, "cc0")], "path string, sha256 string, license string")
    files = spark.createDataFrame([("x.json", good), ("y.json", bad)], "path string, sha256 string")
    out = {r["path"]: r["errors"] for r in C.package_index(index, files, ["license"]).collect()}
    assert out == {"x.json": [], "/etc/x": ["no_license", "forbidden_path", "missing_file"], "gone.json": ["missing_file", "bad_digest"], "y.json": ["digest_differs"]}
    blobs = [("a.json", b"{}"), ("b.json", b"{"), ("c.glb", b"glTF...."), ("d.glb", b"oops"), ("e.csv", b""), ("f.csv", b"x")]
    df = spark.createDataFrame([(p, len(c), bytearray(c)) for p, c in blobs], "path string, length long, content binary")
    assert {r["path"]: r["reason"] for r in C.corrupt(df).collect()} == {"b.json": "bad_json", "d.glb": "wrong_magic", "e.csv": "empty"}


def test_step_order(spark):
    df = spark.createDataFrame([(["reproject", "convert", "range"],), (["convert", "reproject", "range"],), (["reproject", "range", "convert"],), (["reproject"],), (["reproject", "convert", "convert"],)], "s array<string>")
    assert [r[0] for r in df.select(C.step_order(F.col("s"), "convert", "reproject", ["range", "height"])).collect()] == [[], ["too_early"], ["too_late"], ["missing"], ["repeated"]]


def test_associations(spark):
    o = spark.createDataFrame([(1, 3, 5.0), (2, 3, 2.0), (2, 7, 4.0), (3, 7, 1.0), (3, 3, 1.0), (4, 3, 0.0)], "objectid long, cluster_id long, area double")
    out = {(r["objectid"], r["cluster_id"]): r for r in C.primary_assignments(o).collect()}
    assert len(out) == 5 and out[2, 7]["rank"] == 1 and out[2, 3]["primary_id"] == 7
    assert out[3, 3]["rank"] == 1 and out[3, 3]["tie"] and not out[2, 7]["tie"]
    primary = C.primary_assignments(o).where("rank = 1")
    spread = {r["cluster_id"]: (r["n_associated"], r["granularity"]) for r in C.distribution(primary, spark.createDataFrame([(3,), (7,), (9,)], "cluster_id long")).collect()}
    assert spread == {3: (2, "few"), 7: (1, "one"), 9: (0, "none")}


def test_city_status_order(spark):
    base = {"n_raw": 5, "manifest_ok": True, "n_manifest": 5, "n_dirs": 5, "n_processed": 5, "n_unsafe": 0, "n_missing": 0, "has_mesh": True, "n_orphaned": 0, "n_stale": 0, "n_unproven": 0, "has_manifest": True}
    errors = lambda kind="open_county", license_="cc0", allowed=True: A.production_errors(F.lit(kind), F.lit(license_), F.lit(allowed))
    cases = [
        ("production_ready", {}, errors()), ("not_started", {"n_raw": 0, "manifest_ok": False, "n_dirs": 0, "n_manifest": 0, "n_processed": 0}, errors()),
        ("raw_data_ready", {"manifest_ok": False, "n_dirs": 0, "n_manifest": 0, "n_processed": 0}, errors()), ("processed_partial", {"n_processed": 3, "n_missing": 2}, errors("microsoft_ml")),
        ("blocked_unsafe_source", {"n_missing": 2}, errors("microsoft_ml")), ("blocked_unsafe_source", {"n_unsafe": 1}, errors()), ("blocked_license", {}, errors(license_="open_data_unconfirmed")),
        ("blocked_missing_outputs", {"n_missing": 1, "n_stale": 1}, errors()), ("processed_complete", {"has_mesh": False}, errors()), ("blocked_stale_glb", {"n_orphaned": 1, "n_unproven": 1}, errors()),
        ("blocked_missing_provenance", {"n_unproven": 1}, errors()), ("viewer_ready", {}, errors(allowed=False)), ("processed_complete", {"has_manifest": False}, errors()),
    ]
    for want, change, found in cases:
        c = {**{k: F.lit(v) for k, v in {**base, **change}.items()}, "errors": found}
        assert spark.range(1).select(A.city_status(c)).first()[0] == want, change
    risks = [A.legal_risk(errors("microsoft_ml"), F.lit(0)), A.legal_risk(errors(license_="unconfirmed"), F.lit(0)), A.legal_risk(errors(), F.lit(0)), A.legal_risk(errors(), F.lit(2))]
    assert tuple(spark.range(1).select(*risks).first()) == ("HIGH", "MEDIUM", "LOW", "HIGH")


def test_names_of_surveys(spark):
    names = {
        "USGS_LPC_MI_WayneCounty_2017_A17_397272.laz": ("MI_WayneCounty", "MI_WayneCounty_2017_A17"), "USGS_LPC_MI_WAYNECO_2009_000321.laz": ("MI_WAYNECO", "MI_WAYNECO_2009"),
        "usgs_lpc_ARRA_MI_4SECOUNTIES_2010_001445.laz": ("ARRA_MI", "ARRA_MI_4SECOUNTIES_2010"), "2009_12345.laz": ("2009", "2009"), "123456.laz": ("unknown", "unknown"),
    }
    out = spark.createDataFrame([(n,) for n in names], "n string").select("n", S.campaign(F.col("n")).alias("c")).collect()
    assert {r["n"]: tuple(r["c"]) for r in out} == names
    d = spark.createDataFrame([("USGS_LPC_LA_Project_2021_w0789n3421.laz",), ("USGS_LPC_CA_LosAngeles_2016_L4_6477_1842c_LAS_2018.laz",)], "n string")
    a, b = d.select(S.project(F.col("n")).alias("p"), S.quarter_box(F.col("n")).alias("q")).collect()
    assert a["p"] == "LA_Project_2021" and a["q"] is None and tuple(b["q"]) == (6477, 1842, "c", 6477000.0, 1842000.0, 6478500.0, 1843500.0)
    ids = spark.createDataFrame([("b1", "ns", None), ("b1", None, None), (None, None, "u"), ("", "", "")], "b string, n string, u string")
    named = ids.select(S.building_identity(F.lit("t"), F.lit(4), F.col("b"), F.col("n"), F.col("u"), F.lit("county")).alias("i")).collect()
    assert [(r["i"]["id"], r["i"]["kind"]) for r in named] == [("b1", "footprint_building_id"), (None, "error"), ("u", "footprint_unique_id"), ("bld_t_4", "tile_cluster_fallback")]


def test_checks_and_json(spark):
    found = A.checks(spark.range(1).select(F.lit(3).alias("n")), {"a": (F.col("n") > 5, F.col("n") > 2), "b": (F.col("n") > 2, F.lit(False)), "c": (F.lit(None).cast("boolean"), F.lit(False))})
    assert {r["check"]: r["status"] for r in found.collect()} == {"a": "WARN", "b": "FAIL", "c": "PASS"}
    w = A.worst(found).first()
    assert (w["status"], w["pass"], w["warn"], w["fail"]) == ("FAIL", 1, 1, 1)
    j = spark.createDataFrame([(1, '{"a": {"b": [1, true]}, "p": "/etc"}'), (2, "{bad"), (3, None), (4, '{"unsafe": true}')], "k int, t string")
    leaves = A.json_leaves(j, "k", "t")
    assert {(r["k"], r["path"], r["value"]) for r in leaves.collect()} == {(1, "$.a.b.0", "1"), (1, "$.a.b.1", "true"), (1, "$.p", "/etc"), (4, "$.unsafe", "true")}
    assert {r["k"] for r in A.forbidden_leaves(leaves, ["unsafe"]).collect()} == {1, 4}


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("", float("nan")), (None, None), ("NaN", -2.0), ("a", float("inf"))], "s string, v double")
    c = {r["field"]: r for r in P.completeness(df, ["s"]).collect()}["s"]
    assert (c["n_rows"], c["n_null"], c["n_blank"], c["n_null_like"], c["n_complete"], c["n_distinct"]) == (5, 1, 1, 1, 3, 3)
    d = P.distributions(df, ["v"]).first()
    assert (d["n"], d["min"], d["max"], d["n_negative"], d["n_not_finite"]) == (2, -2.0, 1.0, 1, 2)
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in P.histogram(same, "v").collect()] == [(0, 2)]
    assert P.histogram(same.limit(0), "v").count() == 0
    left, right = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    u = P.id_comparison(left, right, "k").first()
    assert (u["matched"], u["missing"], u["extra"], u["duplicated"], u["ratio"]) == (1, 1, 1, 1, 0.5)
    assert P.id_comparison(left.limit(0), right, "k").first()["ratio"] is None
