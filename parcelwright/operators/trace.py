"""Shapes as rings (G05, T11, T15, build step 9): the boundary of pixel runs, traced per shape.

One shape at a time is in memory; everything else about shapes stays relational on runs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parcelwright.functions import scalars as S
from parcelwright.functions.geometry import RINGS

_Point = tuple[int, int]


def _uncovered(intervals: list[tuple[int, int]], by: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of sorted disjoint intervals that other sorted disjoint intervals leave open."""
    out, j = [], 0
    for a, b in intervals:
        while j and by[j - 1][1] > a:
            j -= 1
        while j < len(by) and by[j][1] <= a:
            j += 1
        k = j
        while a < b and k < len(by) and by[k][0] < b:
            if by[k][0] > a:
                out.append((a, by[k][0]))
            a = max(a, by[k][1])
            k += 1
        if a < b:
            out.append((a, b))
    return out


def boundary(runs: list[tuple[int, int, int]]) -> list[list[_Point]]:
    """Closed rings (first point not repeated) around runs (gy, x0, x1), outer ones first; y grows downwards.

    Edges run with the shape on their right, so outer rings and holes turn in opposite ways. Where two pixels meet at a
    corner only, the ring turns towards its own side, which keeps 4-connected parts apart.
    """
    rows: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for y, a, b in sorted(runs):
        if rows[y] and rows[y][-1][1] >= a:
            rows[y][-1] = (rows[y][-1][0], max(b, rows[y][-1][1]))
        else:
            rows[y].append((a, b))
    following: dict[_Point, list[_Point]] = defaultdict(list)
    for y in list(rows):
        for a, b in _uncovered(rows[y], rows.get(y - 1, [])):
            following[(a, y)].append((b, y))  # along the top, to the right
        for a, b in _uncovered(rows[y], rows.get(y + 1, [])):
            following[(b, y + 1)].append((a, y + 1))  # along the bottom, to the left
        for a, b in rows[y]:
            following[(b, y)].append((b, y + 1))  # down the right side
            following[(a, y + 1)].append((a, y))  # up the left side
    rings = []
    while following:
        start = min(following)
        ring, at, heading = [], start, (0, 0)
        while True:
            options = following[at]
            turn = lambda to, at=at, heading=heading: heading[0] * _sign(to[1] - at[1]) - heading[1] * _sign(to[0] - at[0])
            to = max(options, key=turn)  # a right turn first: y grows downwards
            options.remove(to)
            if not options:
                del following[at]
            step = (_sign(to[0] - at[0]), _sign(to[1] - at[1]))
            if step != heading:
                ring.append(at)
            at, heading = to, step
            if at == start:  # at a corner that is passed twice, the rest is a ring of its own
                break
        rings.append(ring)
    return sorted(rings, key=lambda r: (signed_area(r) < 0, r[0][1], r[0][0]))


def _sign(v: int) -> int:
    return (v > 0) - (v < 0)


def signed_area(ring: list[_Point]) -> float:
    """Positive for outer rings."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)) / 2


def _ring_batch(keys: list[str], schema: pa.Schema, shapes: list[tuple[tuple, list]]) -> pa.RecordBatch:
    points = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in boundary(runs)] for _, runs in shapes]
    columns = [pa.array([key[i] for key, _ in shapes], schema.field(k).type) for i, k in enumerate(keys)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(points, schema.field("rings").type)], schema=schema)


def to_rings(shaped: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, rings`` in lattice units; a shape's outer ring comes first (shapes are 4-connected).

    Shapes are dealt by key and sorted, and each is traced as its runs stream past.
    """
    kinds = dict(shaped.dtypes)
    out = StructType.fromDDL(", ".join([*(f"{k} {kinds[k]}" for k in keys), f"rings {RINGS}"]))
    schema = to_arrow_schema(out)

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[tuple, list]] = []
        current: tuple[tuple, list] | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "gy", "x0", "x1")]
            for row in zip(*columns, strict=True):
                key, run = row[:-3], row[-3:]
                if current is None or key != current[0]:
                    if current:
                        done.append(current)
                    current = (key, [])
                current[1].append(run)
            if len(done) > 500:
                yield _ring_batch(keys, schema, done)
                done = []
        if current:
            done.append(current)
        if done:
            yield _ring_batch(keys, schema, done)

    return shaped.select(*keys, "gy", "x0", "x1").repartition(*keys).sortWithinPartitions(*keys, "gy", "x0").mapInArrow(trace, out)


def to_lonlat(rings: F.Column, pixel_m: float) -> F.Column:
    """Lattice rings (origin at the north-west corner of the world) to degrees."""
    point = lambda p: F.struct(S.longitude(p["x"] * pixel_m - S.HALF_WORLD).alias("x"), S.latitude(F.lit(S.HALF_WORLD) - p["y"] * pixel_m).alias("y"))
    return F.transform(rings, lambda r: F.transform(r, point))
