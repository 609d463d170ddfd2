"""Rings as ``array<array<struct<x,y>>>`` (outer first, closed or not): area, bounds, containment, distance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def _segments(ring: Column) -> Column:
    """array<struct<a,b>> of a ring, closed."""
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def segments(rings: Column) -> Column:
    return F.flatten(F.transform(rings, _segments))


def ring_area(ring: Column) -> Column:
    """Shoelace area, without sign."""
    cross = F.transform(_segments(ring), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda t, v: t + v)) / 2


def area(rings: Column) -> Column:
    """The outer ring's area without the holes'."""
    return F.aggregate(F.transform(rings, lambda r, i: F.when(i == 0, ring_area(r)).otherwise(-ring_area(r))), F.lit(0.0), lambda t, v: t + v)


def valid(rings: Column) -> Column:
    """Whether every ring has three distinct corners and an area, and the holes leave some of the outer one.

    Rings that cross themselves are not looked for: those traced from pixels never do.
    """
    corners = lambda r: F.size(F.array_distinct(F.transform(r, lambda p: F.concat_ws(",", p["x"], p["y"])))) >= 3
    return F.coalesce((F.size(rings) > 0) & F.forall(rings, lambda r: corners(r) & (ring_area(r) > 0)) & (area(rings) > 0), F.lit(False))


def repaired(rings: Column) -> Column:
    """Without the rings that have no area, and without repeated corners in a row; null if nothing is left."""
    tidy = F.transform(rings, lambda r: F.filter(r, lambda p, i: (i == 0) | ~F.coalesce((p["x"] == F.get(r, i - 1)["x"]) & (p["y"] == F.get(r, i - 1)["y"]), F.lit(False))))
    kept = F.filter(tidy, lambda r: (F.size(r) >= 3) & (ring_area(r) > 0))
    return F.when(F.size(kept) > 0, kept)


def bounds(rings: Column) -> Column:
    of = lambda name, f: f(F.transform(rings[0], lambda p: p[name]))
    return F.struct(of("x", F.array_min).alias("minx"), of("y", F.array_min).alias("miny"), of("x", F.array_max).alias("maxx"), of("y", F.array_max).alias("maxy"))


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """The rings of an axis-aligned box."""
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(corner(minx, miny), corner(maxx, miny), corner(maxx, maxy), corner(minx, maxy)))


def distance_to_rings(x: Column, y: Column, rings: Column) -> Column:
    """Distance of a point to the nearest boundary segment; 0 on one, where the projection alone may round to more."""

    def to(s: Column) -> Column:
        dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
        length = dx * dx + dy * dy
        t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - s["a"]["x"]) * dx + (y - s["a"]["y"]) * dy) / length))).otherwise(0.0)
        along = x.between(F.least(s["a"]["x"], s["b"]["x"]), F.greatest(s["a"]["x"], s["b"]["x"])) & y.between(F.least(s["a"]["y"], s["b"]["y"]), F.greatest(s["a"]["y"], s["b"]["y"]))
        on = along & (dx * (y - s["a"]["y"]) == dy * (x - s["a"]["x"]))
        return F.when(on, F.lit(0.0)).otherwise(F.sqrt(F.pow(x - s["a"]["x"] - t * dx, F.lit(2)) + F.pow(y - s["a"]["y"] - t * dy, F.lit(2))))

    return F.array_min(F.transform(segments(rings), to))


def crosses(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule: whether a ray from the point meets the boundary an odd number of times."""

    def meets(s: Column) -> Column:
        straddles = (s["a"]["y"] > y) != (s["b"]["y"] > y)
        at = s["a"]["x"] + (y - s["a"]["y"]) * (s["b"]["x"] - s["a"]["x"]) / F.when(s["b"]["y"] != s["a"]["y"], s["b"]["y"] - s["a"]["y"])
        return straddles & (x < at)

    return F.size(F.filter(segments(rings), lambda s: F.coalesce(meets(s), F.lit(False)))) % 2 == 1


def contains(x: Column, y: Column, rings: Column) -> Column:
    """Strict interior: a point on the boundary is outside."""
    return crosses(x, y, rings) & (distance_to_rings(x, y, rings) > 0)


def point_distance(x: Column, y: Column, rings: Column) -> Column:
    """0 inside, else the distance to the boundary."""
    return F.when(crosses(x, y, rings), F.lit(0.0)).otherwise(distance_to_rings(x, y, rings))


def wkb(rings: Column) -> Column:
    """Little-endian WKB polygon, as lower-case hex; rings are closed."""
    le32 = lambda n: _reverse(F.lpad(F.hex(n.cast("long")), 8, "0"), 4)
    one = lambda r: F.concat(le32(F.size(r) + 1), F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.concat(_le64(p["x"]), _le64(p["y"]))), ""))
    return F.lower(F.concat(F.lit("0103000000"), le32(F.size(rings)), F.array_join(F.transform(rings, one), "")))


def _reverse(hexes: Column, n: int) -> Column:
    return F.concat(*[F.substring(hexes, 2 * i + 1, 2) for i in range(n - 1, -1, -1)])


def _le64(value: Column) -> Column:
    """IEEE 754 bits of a double, least significant byte first, from arithmetic alone (normal numbers and zero)."""
    v = F.abs(value)
    e = F.floor(F.log2(F.when(v > 0, v).otherwise(F.lit(1.0)))).cast("int")
    e = F.when(F.pow(F.lit(2.0), e) > v, e - 1).when(F.pow(F.lit(2.0), e + 1) <= v, e + 1).otherwise(e)
    mantissa = ((v / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0**52)).cast("long")
    magnitude = F.when(v == 0, F.lit(0).cast("long")).otherwise(F.shiftleft((e + 1023).cast("long"), 52) + mantissa)
    bits = F.when(value < 0, magnitude.bitwiseOR(F.lit(-(2**63)).cast("long"))).otherwise(magnitude)
    return _reverse(F.lpad(F.hex(bits), 16, "0"), 8)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
