"""Supercell plans: grid cover of a boundary, windows over axes, blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.functions import geometry as G
from parcelwright.functions.scalars import HALF_WORLD, supercell_bounds, tile_size


def grid_cover(boundaries: DataFrame, zoom: int, tiles: int, buffer_m: float) -> DataFrame:
    """``code, sc_x, sc_y`` of the supercells within ``buffer_m`` of a boundary (code, projected rings).

    The cells of the buffered bounding box are generated from the boundary's own row; the test is exact distance.
    """
    step = tile_size(zoom) * tiles
    low = lambda v: (F.floor((v + HALF_WORLD) / step) * tiles).cast("int")
    down = lambda v: (F.floor((F.lit(HALF_WORLD) - v) / step) * tiles).cast("int")
    b = boundaries.select("code", "rings", G.bounds(F.col("rings")).alias("b"))
    xs = F.sequence(low(F.col("b.minx") - buffer_m), low(F.col("b.maxx") + buffer_m), F.lit(tiles))
    ys = F.sequence(down(F.col("b.maxy") + buffer_m), down(F.col("b.miny") - buffer_m), F.lit(tiles))
    cells = b.withColumn("sc_x", F.explode(xs)).withColumn("sc_y", F.explode(ys)).withColumn("c", supercell_bounds(F.col("sc_x"), F.col("sc_y"), zoom, tiles))
    near = F.exists(G.segments(F.col("rings")), lambda s: _segment_near_box(s, F.col("c"), buffer_m))
    inside = G.crosses((F.col("c.left") + F.col("c.right")) / 2, (F.col("c.bottom") + F.col("c.top")) / 2, F.col("rings"))
    return cells.where(near | inside).select("code", "sc_x", "sc_y")


def _segment_near_box(s: Column, c: Column, reach: float) -> Column:
    """Whether a segment comes within ``reach`` of a box: it crosses it, or an end or corner is near."""
    ax, ay, bx, by = s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]
    outside = lambda x, y: F.sqrt(F.pow(F.greatest(c["left"] - x, F.lit(0.0), x - c["right"]), F.lit(2)) + F.pow(F.greatest(c["bottom"] - y, F.lit(0.0), y - c["top"]), F.lit(2)))
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy

    def corner(x: Column, y: Column) -> Column:
        t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - ax) * dx + (y - ay) * dy) / length))).otherwise(0.0)
        return F.sqrt(F.pow(x - ax - t * dx, F.lit(2)) + F.pow(y - ay - t * dy, F.lit(2))) <= reach

    side = lambda x, y: dx * (y - ay) - dy * (x - ax)
    corners = [(c["left"], c["bottom"]), (c["left"], c["top"]), (c["right"], c["bottom"]), (c["right"], c["top"])]
    sides = [side(x, y) for x, y in corners]
    boxes_meet = (F.least(ax, bx) <= c["right"]) & (F.greatest(ax, bx) >= c["left"]) & (F.least(ay, by) <= c["top"]) & (F.greatest(ay, by) >= c["bottom"])
    crosses = boxes_meet & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)
    return (outside(ax, ay) <= reach) | (outside(bx, by) <= reach) | crosses | G.any_of([corner(x, y) for x, y in corners])


def axis_windows(values: DataFrame, value: str, block: int, stride: int, step: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Overlapping windows over sorted distinct values; none spans a gap. ``by..., window, first, last, run, position``.

    A window starts at every ``stride``-th value of a run and holds up to ``block`` values, so the last may be short.
    """
    order = Window.partitionBy(*by).orderBy("v")
    v = values.select(*by, F.col(value).alias("v")).distinct()
    v = v.withColumn("new", F.coalesce((F.col("v") - F.lag("v").over(order) != step).cast("int"), F.lit(0)))
    v = v.withColumn("run", F.sum("new").over(order))
    inside = Window.partitionBy(*by, "run").orderBy("v")
    v = v.withColumn("i", F.row_number().over(inside) - 1).withColumn("n", F.count("*").over(Window.partitionBy(*by, "run")))
    w = v.where(F.col("i") % stride == 0)
    last = F.col("v") + (F.least(F.col("n") - F.col("i"), F.lit(block)) - 1) * step
    w = w.select(*by, "run", F.col("v").alias("first"), last.cast("int").alias("last"))
    return w.withColumn("window", F.row_number().over(Window.partitionBy(*by).orderBy("first")) - 1)


def blocks(cells: DataFrame, block: int, overlap: int, step: int) -> DataFrame:
    """``code, block_id, origin_x, origin_y, sc_x, sc_y``: the members of every non-empty block.

    Blocks are numbered by row of windows, then column, within a commune; a cell finds its windows by equi-join on each axis' values.
    """
    stride = max(1, block - overlap)
    xw = axis_windows(cells, "sc_x", block, stride, step, ("code",)).select("code", F.col("first").alias("origin_x"), F.explode(F.sequence("first", "last", F.lit(step))).alias("sc_x"))
    yw = axis_windows(cells, "sc_y", block, stride, step, ("code",)).select("code", F.col("first").alias("origin_y"), F.explode(F.sequence("first", "last", F.lit(step))).alias("sc_y"))
    members = cells.select("code", "sc_x", "sc_y").distinct().join(xw, ["code", "sc_x"]).join(yw, ["code", "sc_y"])
    number = F.dense_rank().over(Window.partitionBy("code").orderBy("origin_y", "origin_x")) - 1
    return members.select("code", number.cast("long").alias("block_id"), "origin_x", "origin_y", "sc_x", "sc_y")


def select_cells(plan: DataFrame, wanted: DataFrame | None = None, first: int | None = None) -> DataFrame:
    """An explicit list (which must be part of the plan) or the first cells by (y, x); 0 and None mean all."""
    if wanted is not None:
        strange = wanted.join(plan, ["sc_x", "sc_y"], "left_anti").limit(1).count()
        if strange:
            raise ValueError("cells outside the plan were asked for")
        return plan.join(wanted.distinct(), ["sc_x", "sc_y"], "left_semi")
    ordered = plan.orderBy("sc_y", "sc_x")
    return ordered.limit(first) if first else ordered
