"""What the entry module promises."""

import pytest

import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_works_without_the_optional_package(monkeypatch):
    monkeypatch.setattr(entry, "_there", lambda module: False)
    assert "flagship_structures" in entry.queries() and not any(k.startswith("op") and k[2:3].isdigit() for k in entry.queries())


@pytest.mark.parametrize("name", ["j7_points_in_footprints", "j14_polygon_overlay", "a54_city_rollup", "p5_p6_box_overlap"])
def test_no_nested_loops(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
