"""Geometry on rings (arrays of struct<x, y>) and points, as Column expressions.

A ring may be closed or open; the closing edge is implied. Functions are null for null rings and zero for degenerate ones
unless they say otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"


def point(x, y) -> Column:
    return F.struct(F.col(x).cast("double").alias("x") if isinstance(x, str) else x.cast("double").alias("x"), F.col(y).cast("double").alias("y") if isinstance(y, str) else y.cast("double").alias("y"))


def rectangle(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Counter-clockwise open ring of a box."""
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax))


def bind(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside functions of array elements."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def edges(ring: Column) -> Column:
    """Array of struct<a, b>, one for each side, the closing one included."""
    return bind(ring, lambda r: F.zip_with(r, F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))


def _total(items: Column, value) -> Column:
    return F.aggregate(F.transform(items, value), F.lit(0.0), lambda s, v: s + v)


def _cross(e: Column) -> Column:
    return e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]


def signed_area(ring: Column) -> Column:
    return _total(edges(ring), _cross) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def perimeter(ring: Column) -> Column:
    return _total(edges(ring), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))


def bbox(ring: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax>."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def vertex_mean(ring: Column) -> Column:
    """Mean of the vertices as given, a closing vertex counted."""
    n = F.size(ring)
    return F.when(n > 0, F.struct((_total(ring, lambda p: p["x"]) / n).alias("x"), (_total(ring, lambda p: p["y"]) / n).alias("y")))


def centroid(ring: Column) -> Column:
    """Area centroid; the vertex mean if the area is zero."""
    a6 = signed_area(ring) * 6
    axis = lambda f: _total(edges(ring), lambda e: (e["a"][f] + e["b"][f]) * _cross(e)) / a6
    return F.when(a6 != 0, F.struct(axis("x").alias("x"), axis("y").alias("y"))).otherwise(vertex_mean(ring))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point is in the ring, by ray casting; null rings contain nothing."""
    crosses = F.filter(
        edges(ring),
        lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]),
    )
    return F.coalesce(F.size(crosses) % 2 == 1, F.lit(False))


def segment_distance(e: Column, x: Column, y: Column) -> Column:
    dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
    n2 = dx * dx + dy * dy
    t = F.when(n2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy) / n2))).otherwise(0.0)
    return F.hypot(x - (e["a"]["x"] + t * dx), y - (e["a"]["y"] + t * dy))


def edge_distance(ring: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the nearest side."""
    return F.array_min(F.transform(edges(ring), lambda e: segment_distance(e, x, y)))


def hausdorff(a: Column, b: Column) -> Column:
    """Largest distance of a vertex of either ring from the other's sides."""
    one = lambda p, q: F.array_max(F.transform(p, lambda v: edge_distance(q, v["x"], v["y"])))
    return F.greatest(one(a, b), one(b, a))


def compactness(ring: Column) -> Column:
    """Polsby-Popper: 4 pi area over the square of the perimeter."""
    p = perimeter(ring)
    return F.when(p > 0, 4 * math.pi * area(ring) / (p * p)).otherwise(0.0)


def is_simple(ring: Column) -> Column:
    """Whether no two sides that aren't adjacent cross, and the area isn't zero."""
    e = F.transform(edges(ring), lambda s, i: F.struct(s["a"].alias("a"), s["b"].alias("b"), i.alias("i")))
    side = lambda p, q, r: F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))
    cross = lambda s, t: (side(s["a"], s["b"], t["a"]) * side(s["a"], s["b"], t["b"]) < 0) & (side(t["a"], t["b"], s["a"]) * side(t["a"], t["b"], s["b"]) < 0)
    crossing = bind(e, lambda es: F.exists(es, lambda s: F.exists(es, lambda t: (s["i"] < t["i"]) & cross(s, t))))
    return ~crossing & (area(ring) > 0)


def clip_half_plane(ring: Column, a: Column, b: Column, c: Column) -> Column:
    """The part of a ring where a x + b y <= c (one Sutherland-Hodgman pass)."""
    value = lambda p: a * p["x"] + b * p["y"] - c

    def step(e: Column) -> Column:
        va, vb = value(e["a"]), value(e["b"])
        t = va / (va - vb)
        cut = point(e["a"]["x"] + t * (e["b"]["x"] - e["a"]["x"]), e["a"]["y"] + t * (e["b"]["y"] - e["a"]["y"]))
        end = point(e["b"]["x"], e["b"]["y"])
        return (
            F.when((va <= 0) & (vb <= 0), F.array(end))
            .when((va <= 0) & (vb > 0), F.array(cut))
            .when((va > 0) & (vb <= 0), F.array(cut, end))
            .otherwise(F.array().cast(f"array<{POINT}>"))
        )

    return F.flatten(F.transform(edges(ring), step))


def clip_box(ring: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    zero, one = F.lit(0.0), F.lit(1.0)
    for a, b, c in ((-one, zero, -xmin), (one, zero, xmax), (zero, -one, -ymin), (zero, one, ymax)):
        ring = clip_half_plane(ring, a, b, c)
    return ring


def clip_convex(ring: Column, by: Column) -> Column:
    """The part of a ring in a convex counter-clockwise ring."""
    return F.aggregate(
        edges(by), ring, lambda r, e: clip_half_plane(r, e["b"]["y"] - e["a"]["y"], e["a"]["x"] - e["b"]["x"], (e["b"]["y"] - e["a"]["y"]) * e["a"]["x"] + (e["a"]["x"] - e["b"]["x"]) * e["a"]["y"])
    )


def min_rotated_rectangle(hull: Column) -> Column:
    """struct<area, w, h, angle> of the least rectangle with a side along a side of a convex hull."""

    def along(e: Column) -> Column:
        angle = F.atan2(e["b"]["y"] - e["a"]["y"], e["b"]["x"] - e["a"]["x"])
        return bind(F.struct(F.cos(angle).alias("cos"), F.sin(angle).alias("sin"), angle.alias("angle")), turned)

    def turned(t: Column) -> Column:
        us = F.transform(hull, lambda p: p["x"] * t["cos"] + p["y"] * t["sin"])
        vs = F.transform(hull, lambda p: p["y"] * t["cos"] - p["x"] * t["sin"])
        span = F.struct((F.array_max(us) - F.array_min(us)).alias("w"), (F.array_max(vs) - F.array_min(vs)).alias("h"))
        return bind(span, lambda s: F.struct((s["w"] * s["h"]).alias("area"), s["w"].alias("w"), s["h"].alias("h"), t["angle"].alias("angle")))

    return F.array_min(F.transform(edges(hull), along))


# Transverse Mercator by the Krueger series, third order in the third flattening (WGS 84 values below are fixed).
_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm(lon: Column, lat: Column, zone: int) -> Column:
    """struct<x, y> in metres, northern hemisphere, from degrees."""
    phi, lam = F.radians(lat), F.radians(lon) - math.radians(6 * zone - 183)
    e = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((500000 + _K0 * _R * x).alias("x"), (_K0 * _R * y).alias("y"))


def from_utm(x: Column, y: Column, zone: int) -> Column:
    """struct<lon, lat> in degrees, northern hemisphere."""
    xi, eta = y / (_K0 * _R), (x - 500000) / (_K0 * _R)
    xi2, eta2 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi2 = xi2 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta2 = eta2 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi2) / F.cosh(eta2))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    lon = (6 * zone - 183) + F.degrees(F.atan2(F.sinh(eta2), F.cos(xi2)))
    return F.struct(lon.alias("lon"), F.degrees(phi).alias("lat"))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    h = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * F.asin(F.sqrt(h))


def from_web_mercator(x: Column, y: Column) -> Column:
    r = 6378137.0
    return F.struct(F.degrees(x / r).alias("lon"), F.degrees(2 * F.atan(F.exp(y / r)) - math.pi / 2).alias("lat"))


def boxes_overlap(a: Column, b: Column, inclusive: bool = True, missing: bool | None = True) -> Column:
    """Whether two bbox structs overlap; touching counts if inclusive; `missing` is the answer for null boxes."""
    le = (lambda p, q: p <= q) if inclusive else (lambda p, q: p < q)
    hit = le(a["xmin"], b["xmax"]) & le(b["xmin"], a["xmax"]) & le(a["ymin"], b["ymax"]) & le(b["ymin"], a["ymax"])
    return hit if missing is None else F.coalesce(hit, F.lit(missing))
