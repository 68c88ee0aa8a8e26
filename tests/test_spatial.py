"""Proximity and clustering operators against nested loops on small data; results must not depend on partitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.operators import cluster as C
from cadastra.operators import spatial_join as J
from cadastra.operators.graph import connected_components
from cadastra.plans.clusters import cut
from cadastra.plans.derived import points


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    p = [(i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(400)]
    q = [(1000 + i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(150)] + [(2000, 200.0, 200.0)]
    q += [(3000 + i, *q[i][1:]) for i in range(5)]  # ties
    return p, q, spark.createDataFrame(p, "id long, x double, y double"), spark.createDataFrame(q, "rid long, rx double, ry double")


def test_radius_join(data):
    p, q, dp, dq = data
    want = {(a, b) for a, x, y in p for b, u, v in q if math.hypot(x - u, y - v) <= 7}
    assert {(r["id"], r["rid"]) for r in J.radius_join(dp.repartition(7), dq, 7.0).collect()} == want


def test_nearest_join_with_ties(data):
    p, q, dp, dq = data
    out = J.nearest_join(dp, dq.repartition(5), 6.0, "id", "rid").collect()
    assert len(out) == len(p)
    for r in out:
        near = min((math.hypot(r["x"] - u, r["y"] - v), b) for b, u, v in q)
        assert r["rid"] == (near[1] if near[0] <= 6 else None)


def test_order_of_distances_is_that_of_sql(spark):
    """sqrt(dx * dx + dy * dy), by which SQL orders, puts the first before the second; hypot has them the other way round."""
    one = spark.createDataFrame([(0, 1.45, 5.57)], "id long, x double, y double")
    two = spark.createDataFrame([(7, 6.9, 10.27), (3, 6.15, 11.02)], "rid long, rx double, ry double")
    assert [r["rid"] for r in J.nearest_join(one, two, 40.0, "id", "rid").collect()] == [7]
    assert [r["rid"] for r in J.knn_join(one, two, 1, 40.0, "id", "rid", cut).collect()] == [7]


@pytest.mark.parametrize("size", [3.0, 30.0])
def test_knn_join_in_sparse_and_dense_places(data, size):
    p, q, dp, dq = data
    out = J.knn_join(dp.where("id < 60"), dq, 3, size, "id", "rid", cut).collect()
    got = {}
    for r in out:
        got.setdefault(r["id"], {})[r["rank"]] = r["rid"]
    for a, x, y in p[:60]:
        want = sorted((math.hypot(x - u, y - v), b) for b, u, v in q)[:3]
        assert [got[a][k] for k in (1, 2, 3)] == [b for _, b in want]


def test_points_in_polygons_and_rings(spark, data):
    p, _, dp, _ = data
    tri = [(0.0, 0.0), (20.0, 0.0), (10.0, 15.0)]
    poly = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in tri]), (2, None)], f"pid long, ring array<{G.POINT}>")

    def inside(x, y):
        return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(tri, tri[1:] + tri[:1], strict=True)) % 2 == 1

    assert {r["id"] for r in J.points_in_polygons(dp, poly, size=4.0).collect()} == {a for a, x, y in p if inside(x, y)}
    near = {r["id"] for r in J.points_near_polygons(dp, poly, 3.0, size=4.0).collect()}
    assert near and not near & {a for a, x, y in p if inside(x, y)}


@pytest.mark.parametrize("least", [2, 4])
def test_dbscan(data, least):
    p, _, dp, _ = data
    eps = 5.0
    near = {a: [b for b, u, v in p if math.hypot(x - u, y - v) <= eps] for a, x, y in p}
    core = {a for a in near if len(near[a]) >= least}
    label = {}
    for a in sorted(core):
        if a not in label:
            stack = [a]
            label[a] = a
            while stack:
                for b in near[stack.pop()]:
                    if b in core and b not in label:
                        label[b] = a
                        stack.append(b)
    want = {a: label.get(a, min((label[b] for b in near[a] if b in core), default=-1)) for a in near}
    out = {r["id"]: r["cluster"] for r in C.dbscan(dp.repartition(6), cut, eps, least, "id").collect()}
    assert out == want


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    parent = {x: x for e in edges if None not in e for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            u, v = sorted((find(a), find(b)))
            parent[v] = u
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long").repartition(5), cut).collect()}
    assert out == {x: find(x) for x in parent}


def test_morphology(spark):
    block = [("a", r, c) for r in range(5) for c in range(5)] + [("a", 2, c) for c in range(5, 8)] + [("a", r, c) for r in range(5) for c in range(8, 13)]
    cells = spark.createDataFrame(block, "key string, row long, col long")
    opened = C.opening(cells)
    found = C.cell_components(opened, cut, C.adjacency(opened, diagonal=True))
    assert found.select("component").distinct().count() == 2  # a bridge of one cell separates
    assert opened.count() == 50 and C.closing(cells).count() >= cells.count()
    stepped = cells.withColumn("z", F.when(F.col("col") < 8, 0.0).otherwise(2.0))
    assert C.adjacency(stepped, "z").where("step > 2").count() == 0  # exactly two is no cut


def test_thin_and_outliers(data):
    p, _, dp, _ = data
    assert C.thin(dp, 10.0, "id").count() == len({(math.floor(x / 10), math.floor(y / 10)) for _, x, y in p})
    with_far = dp.unionByName(dp.limit(1).select(F.lit(999).cast("long").alias("id"), F.lit(500.0).alias("x"), F.lit(500.0).alias("y"))).withColumn("tile_id", F.lit("t"))
    out = C.statistical_outliers(with_far, cut, 5, 3.0, 20.0, "id").where("outlier").select("id").collect()
    assert [r["id"] for r in out] == [999]


def test_leftover_cells_go_to_the_nearest_marker_at_any_distance(spark):
    marked = [("a", 0, 0, 7), ("a", 0, 100, 3), ("b", 0, 0, 1)]
    rest = [("a", 0, c) for c in range(1, 100)] + [("a", 90, 20), ("b", 400, 3), ("none", 5, 5), ("none", 2, 900)]
    out = C.to_nearest(spark.createDataFrame(rest, "key string, row long, col long").repartition(3), spark.createDataFrame(marked, "key string, row long, col long, component long"), cut)
    got = {(r["key"], r["row"], r["col"]): r["component"] for r in out.collect()}
    least = (2 + (1 << 20)) * (1 << 21) + 900 + (1 << 20)
    assert got == {x: min((math.hypot(x[1] - r, x[2] - c), m) for k, r, c, m in marked if k == x[0])[1] if x[0] != "none" else least for x in rest}


def test_points_and_circles_of_very_different_sizes(spark, data):
    """One polygon and one circle a hundred times as wide as the rest."""
    p, _, dp, _ = data
    rng = random.Random(4)
    boxes = [(i, x := rng.uniform(-50, 50), y := rng.uniform(-50, 50), x + 0.8, y + 0.6) for i in range(60)] + [(99, -40.0, -45.0, 40.0, 30.0)]
    poly = spark.createDataFrame([(i, [{"x": u, "y": v} for u, v in ((a, b), (c, b), (c, d), (a, d))]) for i, a, b, c, d in boxes], f"pid long, ring array<{G.POINT}>")
    assert {(r["id"], r["pid"]) for r in J.points_in_polygons(dp, poly, size=1.0).collect()} == {(k, i) for k, x, y in p for i, a, b, c, d in boxes if a <= x < c and b <= y < d}
    circles = [(i, a, b, 0.7) for i, a, b, _, _ in boxes[:60]] + [(99, 0.0, 0.0, 45.0)]
    found = J.points_in_circles(dp, spark.createDataFrame(circles, "cid long, rx double, ry double, r double"), size=0.5)
    assert {(r["id"], r["cid"]) for r in found.collect()} == {(k, i) for k, x, y in p for i, a, b, r in circles if math.hypot(x - a, y - b) <= r}


def test_overlay_of_any_polygons(spark):
    """Concave rings, holes and parts against a fine grid of points."""
    comb = [(0.0, 0.0), (9.0, 0.0), (9.0, 6.0), (7.0, 6.0), (7.0, 2.0), (5.0, 2.0), (5.0, 6.0), (3.0, 6.0), (3.0, 2.0), (1.0, 2.0), (1.0, 6.0), (0.0, 6.0)]
    square = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    left = [(1, [comb]), (2, [square(0.0, 0.0, 8.0, 8.0), square(2.0, 2.0, 6.0, 6.0)[::-1]]), (3, [square(100.0, 0.0, 101.0, 1.0)])]
    right = [(7, [[(-1.0, 3.0), (10.0, 4.0), (10.0, 5.0), (-1.0, 5.0)]]), (8, [square(1.0, 1.0, 3.0, 3.0), square(5.0, 5.0, 7.0, 7.0)]), (9, [square(9.0, 0.0, 12.0, 6.0)])]
    kind = f"array<array<{G.POINT}>>"
    frame = lambda rows, i, r: spark.createDataFrame([(k, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for k, rings in rows], f"{i} long, {r} {kind}")
    out = {(r["a"], r["b"]): r for r in J.polygon_overlay(frame(left, "a", "p"), frame(right, "b", "q"), "a", "b", "p", "q", size=2.0).collect()}

    def within(rings, x, y):
        return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for ring in rings for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1

    step = 0.05
    grid = [((i + 0.5) * step, (j + 0.5) * step) for i in range(-20, 240) for j in range(-20, 200)]
    for a, p in left:
        for b, q in right:
            plain = sum(within(p, x, y) and within(q, x, y) for x, y in grid) * step * step
            assert abs(out[a, b]["shared"] - plain) < 0.1 if plain else (a, b) not in out
    assert out[2, 8]["shared"] == pytest.approx(6.0) and out[2, 8]["left_fraction"] == pytest.approx(6 / 48)


def test_ids_of_points_beyond_a_long(spark, tmp_path):
    rows = [(o, 3, 19_999 * 60, 999, 4.0, "A") for o in (7, 5_000_000, 5_999_999, 8_999_999)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = [((o * 8 + n) * 2_000_000 + p) * 100_000 + s for o, n, p, s, *_ in rows]
    assert sorted(r["point_id"] for r in points(spark, str(tmp_path)).collect()) == sorted(v if v < 2**63 else v - 2**64 for v in want)


def test_crowded_rows_meet_few_candidates(spark):
    """A thousand rows on a square metre: reaches of 20 m must not make a million pairs."""
    rng = random.Random(5)
    p = spark.createDataFrame([(i, rng.random(), rng.random()) for i in range(1000)], "id long, x double, y double")
    q = p.selectExpr("id AS rid", "x AS rx", "y AS ry")
    met = []
    assert J.knn_join(p, q, 3, 20.0, "id", "rid", lambda d, label: met.append(1) or cut(d, label)).count() == 3000
    assert J._reach(q, "rx", "ry", 6.0, 20.0) < 0.1 and len(met) > 2
    assert {(r["id"], r["rid"]) for r in J.nearest_join(p, q, 20.0, "id", "rid").collect()} == {(i, i) for i in range(1000)}
    far = spark.createDataFrame([(-1, 9.0, 0.5)], p.schema)
    r = J.nearest_join(far, q, 20.0, "id", "rid").first()
    assert r["rid"] == min(((9 - a["rx"]) ** 2 + (0.5 - a["ry"]) ** 2, a["rid"]) for a in q.collect())[1]


def test_cells_are_never_broadcast(data):
    p, q, dp, dq = data
    plan = J.radius_join(dp, dq, 7.0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_rectangles_by_their_boxes_alone(spark):
    """Points on sides and corners, and common areas: rectangles by boxes give what any ring gives by the test of its sides."""
    f = spark.range(30).select(F.col("id").alias("k"), G.rectangle(F.col("id") * 0.5, F.lit(1.0), F.col("id") * 0.5 + 2, F.col("id") * 0.25 + 2).alias("ring"))
    closed = f.withColumn("ring", F.concat("ring", F.slice("ring", 1, 1)))
    p = spark.range(1600).select("id", ((F.col("id") % 40) * 0.5).alias("x"), (F.floor(F.col("id") / 40) * 0.25).alias("y"))
    rows = lambda d: sorted((r["id"], r["k"]) for r in J.points_in_polygons(p, d).select("id", "k").collect())
    mixed = f.where("k % 2 = 0").unionByName(closed.where("k % 2 = 1"))
    assert rows(f) == rows(closed) == rows(mixed) and len(rows(f)) > 500
    assert "MapInArrow" not in J.points_in_polygons(p, f)._jdf.queryExecution().executedPlan().toString()
    other = lambda d: d.select(F.col("k").alias("m"), F.col("ring").alias("theirs"))
    shared = lambda a, b: sorted((r["k"], r["m"], round(r["shared"], 9), round(r["left_fraction"], 9)) for r in J.polygon_overlay(a, other(b), "k", "m", "ring", "theirs").collect())
    assert shared(f, f) == shared(closed, closed) == shared(mixed, f) and len(shared(f, f)) > 100


def test_nearest_never_searches_the_whole_radius_where_it_can_do_with_less(spark, monkeypatch):
    rng = np.random.default_rng(11)
    q = np.concatenate([rng.uniform(0, 20, (3000, 2)), rng.uniform(0, 100, (40, 2)), [[500.0, 500.0]]]).round(2)  # a crowd, a few others, one far away
    p = np.concatenate([rng.uniform(0, 110, (300, 2)), q[:50], [[480.0, 490.0], [900.0, 0.0]]]).round(2)
    left = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)] + [(9000, None, 1.0)], "id long, x double, y double")
    right = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(q)], "rid long, rx double, ry double")
    searched = []
    found = J._least_reach_pairs
    monkeypatch.setattr(J, "_least_reach_pairs", lambda *a: searched.append(found(*a)) or searched[0])
    got = {r["id"]: (r["rid"], r["dist"]) for r in J.nearest_join(left, right, 300.0, "id", "rid").collect()}
    for i, (x, y) in enumerate(p):
        dx, dy = x - q[:, 0], y - q[:, 1]
        d = np.sqrt(dx * dx + dy * dy)
        assert got[i] == ((int(d.argmin()), float(d.min())) if d.min() <= 300 else (None, None))
    assert got[9000] == (None, None) and len(got) == len(p) + 1
    assert searched[0].count() < len(p) * len(q) // 2  # the whole radius of 300 holds nearly all right rows for nearly all of them
