"""Pixel runs against brute force on sets of pixels."""

import random
from collections import deque

import pytest

from parcelwright.operators import grid, runs, trace
from parcelwright.operators.graph import connected_components
from parcelwright.plans.registry import LATTICE
from parcelwright.settings import Settings

MASK = "block_id long, x int, y int, fill boolean"


def parts(pixels, diagonal=False):
    """4-connected (or 8-connected) parts of a set of (x, y)."""
    left, out = set(pixels), []
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (diagonal or not (a and b))]
    while left:
        todo, part = deque([left.pop()]), set()
        while todo:
            x, y = todo.popleft()
            part.add((x, y))
            for a, b in steps:
                if (x + a, y + b) in left:
                    left.discard((x + a, y + b))
                    todo.append((x + a, y + b))
        out.append(frozenset(part))
    return out


def as_sets(df, key):
    found = {}
    for r in df.collect():
        found.setdefault(r[key], set()).update((x, r["gy"]) for x in range(r["x0"], r["x1"]))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_holes(spark, seed):
    rng = random.Random(seed)
    east, south = (40_000_000, 70_000_000) if seed == 2 else (0, 0)  # where the lattice of zoom 19 lies
    pixels = {(b, x + east, y + south): rng.random() < 0.6 for b in range(2) for x in range(14) for y in range(12)}
    mask = spark.createDataFrame([(b, x, y, f) for (b, x, y), f in pixels.items()], MASK)
    shaped = runs.components(runs.to_runs(mask))
    found = as_sets(shaped, "polygon_id")
    want = [p for b in range(2) for p in parts({(x, y) for (k, x, y), f in pixels.items() if f and k == b})]
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want))

    filled = as_sets(runs.fill_small_holes(shaped, LATTICE), "polygon_id")
    for key, shape in found.items():
        xs, ys = [x for x, _ in shape], [y for _, y in shape]
        around = {(x, y) for x in range(min(xs) - 1, max(xs) + 2) for y in range(min(ys) - 1, max(ys) + 2)} - shape
        holes = [h for h in parts(around, diagonal=True) if all(min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys) for x, y in h)]
        holes = [h for h in holes if (min(xs) - 1, min(ys) - 1) not in h]
        assert filled[key] == shape.union(*[h for h in holes if len(h) < 4], set()), key


def boxes_as_runs(spark, boxes):
    rows = [(i, source, y, x0, x1) for i, (source, x0, y0, x1, y1) in enumerate(boxes) for y in range(y0, y1)]
    return spark.createDataFrame(rows, "polygon_id long, block_id long, gy int, x0 int, x1 int")


def test_touching_shapes_stay_apart(spark):
    boxes = boxes_as_runs(spark, [(0, 0, 0, 10, 10), (1, 5, 0, 10, 10), (0, 10, 0, 20, 10)])
    merged = runs.merge_shapes(boxes, LATTICE)
    assert sorted(len(s) for s in as_sets(merged, "root_id").values()) == [100, 100]


def test_transitive_chain_and_same_block_overlap(spark):
    boxes = [(0, 0, 0, 10, 10), (1, 0, 0, 10, 10), (2, 10, 0, 20, 10), (3, 100, 0, 110, 10), (4, 200, 0, 210, 10), (4, 205, 0, 215, 10), (5, 300, 0, 310, 10), (6, 308, 0, 318, 10), (7, 316, 0, 326, 10)]
    merged = as_sets(runs.merge_shapes(boxes_as_runs(spark, boxes), LATTICE), "root_id")
    assert sorted(len(s) for s in merged.values()) == [100, 100, 100, 100, 100, 260]


def test_hard_limit_before_union(spark):
    from dataclasses import replace

    circles = boxes_as_runs(spark, [(i, i, 0, i + 10, 10) for i in range(5)])
    with pytest.raises(ValueError, match="has 5 polygons"):
        runs.merge_shapes(circles, replace(LATTICE, large_component_hard_limit_polygons=3))


def test_islands_become_parts(spark):
    rows = boxes_as_runs(spark, [(0, 0, 0, 2, 2), (1, 0, 0, 2, 2), (2, 10, 0, 12, 2)]).selectExpr("case when polygon_id = 2 then 0 else polygon_id end polygon_id", "case when polygon_id = 2 then 0 else block_id end block_id", "gy", "x0", "x1")
    merged = runs.merge_shapes(rows, LATTICE).collect()
    assert {r["part"] for r in merged} == {0, 1} and {r["root_id"] for r in merged} == {0}


def test_connected_components_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1040)] + [(5, 5), (None, 3)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {v: find(v) for v in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pixels_of_areas():
    s = Settings()
    assert [s.pixels(a) for a in (1, 50, 0.25)] == [12, 561, 3]


def test_blocks_do_not_span_gaps(spark):
    far = 100_000
    cells = spark.createDataFrame([("a", x, y) for x, y in ((0, 0), (4, 0), (far, 0), (far + 4, 0))], "code string, sc_x int, sc_y int")
    got = grid.blocks(cells, 4, 1, 4).collect()
    full = {r["origin_x"] for r in got}
    assert full == {0, far}


def test_wanted_cells_must_be_planned(spark):
    plan = spark.createDataFrame([(0, 0), (4, 0), (0, 4)], "sc_x int, sc_y int")
    assert [tuple(r) for r in grid.select_cells(plan, first=2).collect()] == [(0, 0), (4, 0)]
    assert grid.select_cells(plan, first=0).count() == 3
    with pytest.raises(ValueError):
        grid.select_cells(plan, plan.selectExpr("sc_x + 1 as sc_x", "sc_y"))


def even_odd(rings, x, y):
    """Whether a point is inside rings by the even-odd rule."""
    hits = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            hits += ax == bx and (ay > y) != (by > y) and ax > x
    return hits % 2 == 1


def test_traced_rings():
    rng = random.Random(4)
    for _ in range(60):
        pixels = {(x, y) for x in range(9) for y in range(8) if rng.random() < 0.6}
        for part in parts(pixels):
            rows = {}
            for x, y in sorted(part):
                rows.setdefault(y, []).append(x)
            found = []
            for y, xs in rows.items():
                start = xs[0]
                for a, b in zip(xs, [*xs[1:], None], strict=True):
                    if b != a + 1:
                        found.append((y, start, a + 1))
                        start = b
            rings = trace.boundary(found)
            assert sum(map(trace.signed_area, rings)) == len(part)
            assert trace.signed_area(rings[0]) > 0 and all(trace.signed_area(r) < 0 for r in rings[1:])
            inside = {(x, y) for x in range(-1, 10) for y in range(-1, 9) if even_odd(rings, x + 0.5, y + 0.5)}
            assert inside == part
