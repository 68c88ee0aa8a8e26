"""Hand cases of the quality report, enrichment in batches, cell footprints and numbering."""

import pandas as pd
from pyspark.sql import functions as F

from cadastra.operators import cluster as C
from cadastra.operators import enrich as E
from cadastra.operators import quality_report as Q
from cadastra.operators import tiles as T
from cadastra.plans.clusters import cut


def test_orders_of_findings(spark, tmp_path):
    f = spark.createDataFrame([("b", "2", "INFO"), ("a", "9", "ERROR"), ("a", "1", "warning"), ("c", "9", "WARNING")], "code string, building_id string, severity string")
    assert [(r["code"], r["building_id"]) for r in Q.ordered(f).collect()] == [("a", "1"), ("a", "9"), ("b", "2"), ("c", "9")]
    assert [r["severity"] for r in Q.by_severity(f).collect()] == ["ERROR", "warning", "WARNING", "INFO"]
    assert [r["building_id"] for r in Q.warned_only(f).collect()] == ["1"]
    Q.write_report(f"file://{tmp_path}/r", findings=f)
    assert spark.read.parquet(f"file://{tmp_path}/r/findings").count() == 4


def test_relationships_on_sparse_tables(spark):
    d = spark.createDataFrame([("1", 5.0, float("nan")), ("2", None, 3.0)], "building_id string, height_max double, height_p95 double")
    codes = [r["code"] for r in Q.relationships(d, []).where("building_id = '1'").collect()]
    assert "REL-HEIGHT-MAX-P95" not in codes and {"REL-CRS-MISSING", "REL-PROVENANCE-MISSING", "REL-SOURCE-HASH-MISSING"} <= set(codes)
    assert Q.relationships(d.limit(0), ["height_max"]).count() == 0


def test_batches_resume_and_skip_failures(spark):
    def model(frame: pd.DataFrame) -> pd.DataFrame:
        if (frame["id"] == 7).any():
            raise ValueError("no answer")
        return frame.assign(out=frame["id"] * 2)

    d = spark.range(20).repartition(1)
    got = {r["id"]: r["out"] for r in E.in_batches(d, "id", model, "id long, out long", d.where("id < 4"), size=4).collect()}
    assert got == {i: 2 * i for i in range(8, 20)}  # 4 to 7 are a batch that fails


def test_numbering_over_ranges(spark):
    d = spark.createDataFrame([(f"k{i:03d}",) for i in range(57)], "k string").repartition(5)
    rows = {r["k"]: r["row"] for r in T.numbered(d, "k", cut).collect()}
    assert rows == {f"k{i:03d}": i + 1 for i in range(57)}


def test_cell_footprint_and_conservation(spark):
    block = [(float(x), float(y)) for x in range(5) for y in range(5) if (x, y) != (2, 2)] + [(20.0, 20.0), (21.0, 20.0)]
    p = spark.createDataFrame([("a", x + 0.5, y + 0.5) for x, y in block], "k string, x double, y double")
    f = C.grid_footprints(p, 1.0, "k", cut)
    assert {(r["row"], r["col"]) for r in f.collect()} == {(y, x) for x in range(5) for y in range(5)}  # the hole closes, the small part goes
    assert C.shrunk(f.select("key", "row", "col"), cut).count() == 9
    cells = C.occupancy(p, 1.0, "k")
    good = C.conserved(cells, cells).first()
    assert good["ok"] and good["n_cells"] == 26
    bad = C.conserved(cells, cells.where("row > 0").unionByName(cells.limit(1)).unionByName(cells.limit(1).withColumn("col", F.lit(99).cast("long")))).first()
    assert not bad["ok"] and bad["n_foreign"] == 1
