"""Overlay, buffers, covers and dissolves against random points and counts of cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions import overlay as O
from cadastra.operators import boundary as B
from cadastra.operators import cover as C
from cadastra.operators import polygons as P
from cadastra.plans.clusters import cut

RINGS = "array<array<struct<x:double,y:double>>>"
L = [(0.0, 0.0), (10.0, 0.0), (10.0, 5.0), (5.0, 5.0), (5.0, 10.0), (0.0, 10.0)]


def inside(rings, x, y):
    """In an odd number of rings, by rays."""
    out = np.zeros(len(x), int)
    for r in rings:
        (ax, ay), (bx, by) = np.array(r, float).T, np.roll(np.array(r, float), -1, 0).T
        for k in range(0, len(x), 2000):
            px, py = x[k : k + 2000, None], y[k : k + 2000, None]
            out[k : k + 2000] += (((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / np.where(by == ay, 1, by - ay) + ax)).sum(1)
    return out % 2 == 1


def star(rng, n, scale=10.0, centre=(0, 0), least=0.2):
    a, r = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(least, 1, n) * scale
    return np.stack([centre[0] + r * np.cos(a), centre[1] + r * np.sin(a)], 1)


def polygons(rng, kind):
    if kind == 0:
        return [star(rng, rng.integers(3, 12))], [star(rng, rng.integers(3, 12), 10, rng.uniform(-5, 5, 2))]
    if kind == 1:  # corners on sides, sides in common, rings that cross themselves
        return [rng.integers(0, 6, (rng.integers(3, 9), 2)).astype(float)], [rng.integers(0, 6, (rng.integers(3, 9), 2)).astype(float)]
    if kind == 2:
        return [star(rng, 12), star(rng, 5, 2)], [rng.uniform(-8, 8, (rng.integers(3, 8), 2)), star(rng, 6, 3)]
    return [np.array([[0, 0], [4, 0], [4, 4], [0, 4.0]]), np.array([[1, 1], [3, 1], [3, 3], [1, 3.0]])], [rng.integers(-1, 6, (4, 2)).astype(float)]


def covered(found, x, y):
    return sum((inside(p, x, y).astype(int) for p in found), np.zeros(len(x), int))


def test_overlay_of_random_polygons():
    rng = np.random.default_rng(0)
    for k in range(240):
        a, b = polygons(rng, k % 4)
        x, y = rng.uniform(-12, 12, (2, 2000))
        ia, ib = inside(a, x, y), inside(b, x, y)
        for rule, want in (("intersection", ia & ib), ("union", ia | ib), ("difference", ia & ~ib), ("even-odd", ia)):
            found = O.overlay(O.edges_of(a), O.edges_of(b), rule)
            assert (covered(found, x, y) == want).all(), (k, rule)
            assert all(O.twice_area(p[0]) > 0 and all(O.twice_area(h) < 0 for h in p[1:]) for p in found)
            assert all(len(np.unique(r, axis=0)) == len(r) for p in found for r in p)


def test_buffers_of_random_polygons():
    rng = np.random.default_rng(1)
    for k in range(120):
        a = [star(rng, rng.integers(3, 10))] if k % 2 else [rng.integers(0, 8, (rng.integers(3, 8), 2)) * 2.0]
        valid = O.overlay(O.edges_of(a))
        if not valid:
            continue
        d = rng.uniform(-1.5, 1.5)
        x, y = rng.uniform(-14, 18, (2, 2000))
        e = np.concatenate([O.edges_of(p) for p in valid])
        (ax, ay), v = e[:, :2].T, e[:, 2:] - e[:, :2]
        t = np.clip(((x[:, None] - ax) * v[:, 0] + (y[:, None] - ay) * v[:, 1]) / (v**2).sum(1), 0, 1)
        far = np.hypot(x[:, None] - ax - t * v[:, 0], y[:, None] - ay - t * v[:, 1]).min(1)
        depth = np.where(inside(a, x, y), far, -far)
        sure = np.abs(depth + d) > 0.02  # arcs are chords
        assert (covered(O.buffered(a, d), x, y) == (depth > -d))[sure].all(), k


@pytest.mark.parametrize(("ring", "distance", "areas"), [
    (L, -0.5, [9 * 4 + 4 * 5 + 0.0]), ([(0, 0), (8, 0), (8, 4), (0, 4)], -0.5, [21.0]),
    ([(0, 0), (4, 0), (4, 1.7), (8, 1.7), (8, 0), (14, 0), (14, 4), (8, 4), (8, 2.3), (4, 2.3), (4, 4), (0, 4)], -0.5, [15.0, 9.0]),
])
def test_shrunk_shapes(ring, distance, areas):
    """A convex shape, an L (its inner corner rounds) and a dumbbell, which falls apart, the larger part first."""
    found = sorted((O.polygon_area(p) for p in O.buffered([np.array(ring, float)], distance)), reverse=True)
    assert len(found) == len(areas) and np.allclose(found, areas, atol=0.3 if ring is L else 0.03)  # inner corners round


def frame(spark, rows):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in r] for r in rings] if rings is not None else None) for k, rings in rows], f"id int, rings {RINGS}")


def test_repair(spark):
    bow, back, two = [(0, 0), (4, 4), (4, 0), (0, 4)], [(0, 0), (6, 0), (3, 0), (3, 3), (0, 3)], [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0), (2, 0), (2, 2), (0, 2)]
    holed = [[(0, 0), (9, 0), (9, 9), (0, 9)], [(1, 1), (1, 3), (3, 3), (3, 1)]]
    rows = frame(spark, [(1, [bow]), (2, [back]), (3, [two]), (4, holed), (5, None), (6, []), (7, [[]]), (8, [[(0, 0), (1, 1)]]), (9, [[(0, 0), (float("nan"), 1), (2, 2)]])])
    got = {r["id"]: [[len(x) for x in p] for p in r["polygons"]] for r in P.repaired(rows).collect()}
    assert got == {1: [[3], [3]], 2: [[4]], 3: [], 4: [[4, 4]], 5: [], 6: [], 7: [], 8: [], 9: []}
    areas = {r["id"]: r["a"] for r in P.repaired(rows).where(F.size("polygons") > 0).select("id", P.polygon_area(F.col("polygons")[0]).alias("a")).collect()}
    assert areas == {1: 4.0, 2: 9.0, 4: 77.0}


def test_cover_of_a_boundary_of_ten_thousand_corners(spark):
    rng = np.random.default_rng(2)
    places = [(1, [star(rng, 10_000, 500, least=0.6), star(rng, 300, 100, least=0.6), star(rng, 50, 80, (700, 700))]), (2, [np.array([[-50, 600], [50, 600], [50, 700], [-50, 700.0]])]), (3, [])]
    cover = C.polygon_cover(frame(spark, places).withColumnRenamed("id", "place"), 20.0).cache()
    assert cover.agg(F.max(F.size("sides"))).first()[0] < 200
    x, y = rng.uniform(-800, 800, (2, 6000))
    points = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(zip(x, y, strict=True))] + [(-1, None, 3.0)], "id int, x double, y double")
    got = {(r["id"], r["place"]) for r in C.points_in_cover(points, cover, 20.0).collect()}
    assert got == {(k, p) for p, rings in places for k in np.flatnonzero(inside(rings, x, y)).tolist()}
    corners = rng.uniform(-600, 800, (150, 2)), rng.uniform(1, 60, (150, 2))
    boxes = [(k, *map(float, (*a, *(a + w)))) for k, (a, w) in enumerate(zip(*corners, strict=True))] + [(1000, 50.0, 600.0, 60.0, 610.0), (1001, 40.0, 590.0, 50.0, 600.0), (1002, -40.0, 610.0, -30.0, 620.0)]
    table = spark.createDataFrame(boxes, "id int, a double, b double, c double, d double").select("id", F.expr("named_struct('xmin', a, 'ymin', b, 'xmax', c, 'ymax', d) AS box"))
    got = {(r["id"], r["place"]) for r in C.boxes_in_cover(table, cover, 20.0).collect()}
    ring = lambda b: O.edges_of([np.array([[b[1], b[2]], [b[3], b[2]], [b[3], b[4]], [b[1], b[4]]])])
    near = lambda rings, b: [e for e in [O.edges_of(rings)] for e in [e[(np.minimum(e[:, 0], e[:, 2]) <= b[3]) & (np.maximum(e[:, 0], e[:, 2]) >= b[1])]]][0]
    assert got == {(b[0], p) for p, rings in places for b in boxes if len(rings) and sum(map(O.polygon_area, O.overlay(ring(b), near(rings, b), "intersection"))) > 1e-9}


def test_clip_footprints(spark):
    """Concave, holed and parted results: areas are those of the overlay with the whole boundary and the tile, the largest part."""
    rng = np.random.default_rng(3)
    city = [star(rng, 400, 300, (500, 500), least=0.7), star(rng, 40, 60, (500, 500), least=0.7)]
    shapes = [(k, [star(rng, 9, 25, rng.uniform(200, 800, 2))]) for k in range(150)] + [(900, [np.array(L) * 3 + [620, 560], np.array([[1, 1], [4, 1], [4, 4], [1, 4.0]]) + [620, 560]])]
    tiles = [(f"t{i}{j}", float(i * 100), float(j * 100), float(i * 100 + 100), float(j * 100 + 100)) for i in range(10) for j in range(10)]
    t = spark.createDataFrame(tiles, "tile_id string, a double, b double, c double, d double").select("tile_id", F.expr("named_struct('xmin', a, 'ymin', b, 'xmax', c, 'ymax', d) AS box"))
    got = {(r["id"], r["tile_id"]): (r["area_m2"], [[tuple(p) for p in x] for x in r["rings"]]) for r in B.clip_footprints(frame(spark, shapes), t, frame(spark, [(1, city)]).select("rings"), "id", "rings", size=40.0).collect()}
    want = {}
    for k, rings in shapes:
        parts = O.overlay(O.edges_of(rings), O.edges_of(city), "intersection")
        best = max(parts, key=O.polygon_area, default=None)
        for name, a, b, c, d in tiles if best else ():
            cut = O.overlay(O.edges_of(best), O.edges_of([np.array([[a, b], [c, b], [c, d], [a, d]])]), "intersection")
            area = max(map(O.polygon_area, cut), default=0)
            if area >= 9:
                want[k, name] = area
    assert got.keys() == want.keys() and len(want) > 100 and all(abs(got[k][0] - want[k]) < 0.011 for k in want)
    assert any(len(rings) > 1 for _, rings in got.values())


def test_the_part_of_an_l_below_a_line(spark):
    f = frame(spark, [(1, [L])])
    t = spark.sql("SELECT 't' AS tile_id, named_struct('xmin', -100D, 'ymin', -100D, 'xmax', 100D, 'ymax', 100D) AS box")
    half = frame(spark, [(1, [[(-50, -50), (50, -50), (50, 8), (-50, 8)]])]).select("rings")
    assert B.clip_footprints(f, t, half, "id", "rings").first()["area_m2"] == 65.0
    assert B.clip_footprints(f, t, None, "id", "rings").first()["area_m2"] == 75.0


def test_dissolve(spark):
    """Random groups of overlapping and touching polygons, equal ones and holes; areas by points and by the sum of sides."""
    rng = np.random.default_rng(4)
    rows = []
    for g in range(6):
        for _ in range(12):
            kind = rng.integers(0, 3)
            at = rng.integers(0, 12, 2)
            shape = [np.array([[0, 0], [3, 0], [3, 2], [0, 2]]) + at] if kind == 0 else [star(rng, 7, 4, at)] if kind == 1 else [np.array([[0, 0], [6, 0], [6, 6], [0, 6]]) + at, np.array([[2, 2], [4, 2], [4, 4], [2, 4]]) + at]
            rows.append((len(rows), g, shape))
        rows.append((len(rows), g, rows[-1][2]))
    table = spark.createDataFrame([(k, g, [[(float(x), float(y)) for x, y in r] for r in rings]) for k, g, rings in rows], f"id int, block int, rings {RINGS}")
    x, y = rng.uniform(-5, 20, (2, 3000))
    got = {r["block"]: [[np.array([tuple(p) for p in ring]) for ring in poly] for poly in r["polygons"]] for r in P.dissolved(table, "id", "block", size=5.0).collect()}
    sums = {r["block"]: r["a"] for r in P.outline_sides(table, "id", "block", size=5.0).groupBy("block").agg(P.sides_area().alias("a")).collect()}
    for g in range(6):
        want = np.any([inside(rings, x, y) for _, h, rings in rows if h == g], axis=0)
        assert (covered(got[g], x, y) == want).all()
        assert abs(sums[g] - sum(map(O.polygon_area, got[g]))) < 1e-4


def test_buffered_column(spark):
    rows = P.buffered(frame(spark, [(1, [[(0, 0), (8, 0), (8, 4), (0, 4)]]), (2, [[(0, 0), (0.5, 0), (0.5, 9), (0, 9)]]), (3, None)]), -0.5)
    assert {r["id"]: r["a"] for r in rows.select("id", F.when(F.size("polygons") > 0, P.polygon_area(F.col("polygons")[0])).alias("a")).collect()} == {1: 21.0, 2: None, 3: None}


def test_blocks(spark):
    """Three neighbours, one apart, one without a polygon, one that stands in another's yard; areas by hand (arcs are chords)."""
    square = lambda x, y, w: [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]]
    rows = [(1, 10.0, square(0, 0, 4)), (2, 20.0, square(6, 0, 4)), (3, 30.0, square(12, 0, 4)), (4, 7.0, square(100, 100, 4)), (5, 1.0, None), (6, 5.0, square(300, 0, 40)), (7, 9.0, square(320, 20, 1))]
    df = spark.createDataFrame([(k, h, [[(float(x), float(y)) for x, y in r] for r in rings] if rings else None) for k, h, rings in rows], f"id int, h double, rings {RINGS}")
    got = {r["block_id"]: r for r in P.building_blocks(df, "id", "h", 2.0, cut).collect()}
    assert {k: (r["n"], r["height_max"], r["height_p90"], r["height_median"]) for k, r in got.items()} == {1: (3, 30.0, 28.0, 20.0), 4: (1, 7.0, 7.0, 7.0), 6: (2, 9.0, 8.6, 7.0)}
    assert abs(got[4]["area_m2"] - (32 + np.pi)) < 0.1 and abs(got[6]["area_m2"] - (1760 + np.pi)) < 0.1 and 18 * 6 - 4 < got[1]["area_m2"] < 18 * 6


def test_many_overlays_equal_one_by_one():
    rng = np.random.default_rng(5)
    sides = [O.edges_of([rng.integers(0, 9, (rng.integers(3, 8), 2)).astype(float) + 100 * k]) if k % 7 else O.NONE for k in range(60)]
    other = [np.concatenate([sides[k], sides[k] + 2.5]) for k in range(60)]
    for rule in O.RULES:
        for many, a, b in zip(O.overlays(sides, other, rule), sides, other, strict=True):
            one = O.overlay(a, b, rule)
            assert [[r.tolist() for r in p] for p in many] == [[r.tolist() for r in p] for p in one]
    whole = O.overlays(sides)
    for many, polygons in zip(O.offsets(whole, 0.5), whole, strict=True):
        one = [O.offset_edges(p, 0.5) for p in polygons]
        assert np.allclose(many, np.concatenate(one) if one else O.NONE)


def test_polygons_of_one_task_are_dealt_over_all(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0))))
    df = spark.range(64).coalesce(1).select("id", ring.alias("ring"))
    for out in (P.repaired(df, "ring"), P.buffered(df, 0.5, "ring"), P.pair_measures(df.withColumn("other", ring), "ring", "other")):
        assert out.select("id", F.spark_partition_id().alias("p")).distinct().select("p").distinct().count() > 1


def test_pair_measures(spark):
    ring = lambda *points: F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points))
    square = ring((0, 0), (4, 0), (4, 4), (0, 4))
    df = spark.range(1).select(F.explode(F.array(ring((1, 0), (7, 0), (7, 4), (1, 4), (1, 0)), ring((6, 0), (8, 0), (7, 1)), F.array().cast("array<struct<x:double,y:double>>"))).alias("other"), square.alias("ring"))
    out = sorted(((r["shared"], r["hausdorff"]) for r in P.pair_measures(df, "ring", "other").collect()), key=str)
    assert out == [(0.0, 52**0.5), (12.0, 3.0), (None, None)]  # from (0, 4) to (6, 0); from (7, 0) to (4, 0)
