"""Raster shapes as pixel runs on the global lattice.

A run is ``gy, x0, x1`` (half-open). All shapes come from one lattice, so intersection, union and area are exact integer
operations on runs; nothing is one row per pixel beyond the mask itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.operators.graph import connected_components
from parcelwright.plans.staging import stage
from parcelwright.settings import Settings


def fill_mask(pixels: DataFrame, settings: Settings, color: tuple[int, int, int] | None = None) -> DataFrame:
    """``pixels`` (..., r, g, b, a) with ``fill``; ``color`` defaults to the configured one."""
    target = color or settings.fill_color
    near = F.col("a") >= settings.min_fill_alpha
    for channel, t, tolerance in zip("rgb", target, settings.fill_tolerance, strict=True):
        near = near & (F.abs(F.col(channel) - t) <= tolerance)
    return pixels.withColumn("fill", near)


def dominant_color(pixels: DataFrame, settings: Settings, by: list[str] | None = None, least: int = 100, sample: int = 200_000) -> DataFrame:
    """Per image (``by``), the most frequent colour of the translucent pixels, in steps of 4.

    ``pixels`` has pos (scan order), r, g, b, a. Of equally frequent colours the first seen wins. With fewer than
    ``least`` candidates, or a colour too far from the configured one, the configured one is returned. The sample takes
    every k-th candidate, k such that about ``sample`` stay.
    """
    by = by or []
    c = pixels.where((F.col("a") >= settings.min_fill_alpha) & (F.col("a") < settings.max_candidate_alpha))
    if by:
        n = c.groupBy(*by).agg(F.count("*").alias("n")).withColumnsRenamed({b: f"_{b}" for b in by})
        c = c.join(n, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])
    else:
        c = c.withColumn("n", F.lit(c.count()))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / sample))
    # only images of which not every candidate is taken need the order of their pixels
    order = Window.partitionBy(*by).orderBy("pos")
    thinned = c.where(step > 1).withColumn("i", F.row_number().over(order) - 1).where(F.col("i") % step == 0).drop("i")
    c = c.where(step == 1).unionByName(thinned).withColumn("i", F.col("pos"))
    quantised = [(F.floor(F.col(x) / 4) * 4).cast("int").alias(x) for x in "rgb"]
    counted = c.select(*by, "n", "i", *quantised).groupBy(*by, "n", "r", "g", "b").agg(F.count("*").alias("k"), F.min("i").alias("first"))
    best = counted.groupBy(*by, "n").agg(F.max_by(F.struct("r", "g", "b"), F.struct("k", -F.col("first"))).alias("c"))
    r, g, b = settings.fill_color
    far = F.sqrt(F.pow(F.col("c.r") - r, F.lit(2)) + F.pow(F.col("c.g") - g, F.lit(2)) + F.pow(F.col("c.b") - b, F.lit(2))) > settings.max_color_distance
    fallback = (F.col("n") < least) | far
    pick = lambda x, t: F.when(fallback, F.lit(t)).otherwise(F.col(f"c.{x}")).alias(x)
    return best.select(*by, *[pick(x, t) for x, t in zip("rgb", settings.fill_color, strict=True)])


def image_metrics(mask: DataFrame, by: str = "block_id") -> DataFrame:
    """Fill pixels and their share by block."""
    return mask.groupBy(by).agg(F.count_if("fill").alias("fill_pixels"), F.count("*").alias("pixels"), F.avg(F.col("fill").cast("int")).alias("fill_ratio"))


def to_runs(mask: DataFrame, by: str = "block_id") -> DataFrame:
    """``by, gy, x0, x1`` of the filled pixels (``by, x, y, fill``): gaps and islands on each row."""
    row = Window.partitionBy(by, "y").orderBy("x")
    island = F.col("x") - F.row_number().over(row)
    filled = mask.where("fill").select(by, "x", "y").withColumn("island", island)
    return filled.groupBy(by, F.col("y").alias("gy"), "island").agg(F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")).drop("island")


def _run_ids(runs: DataFrame, by: str) -> DataFrame:
    """Run ids that fit in a long, in order of block, row and start: block (23 bits), then row and start (20 each) from the
    block's own corner. More blocks than fit are an error."""
    whole = Window.partitionBy(by)
    row, start = F.col("gy") - F.min("gy").over(whole), F.col("x0") - F.min("x0").over(whole)
    block = F.when(F.col(by).between(0, (1 << 23) - 1), F.col(by).cast("long")).otherwise(F.raise_error(F.concat(F.lit("no run ids for block "), F.col(by))).cast("long"))
    return runs.withColumn("run", F.shiftleft(block, 40) + F.shiftleft(row.cast("long"), 20) + start)


def _wide_id(shape: str, row: Column, start: Column) -> Column:
    """An id of a run or gap of a shape that spans blocks: the shape's id, then row and start from its own corner."""
    within = F.shiftleft(row.cast("long"), 24) + start.cast("long")
    return (F.col(shape).cast("decimal(20,0)") * F.lit(1 << 48).cast("decimal(17,0)") + within).cast("decimal(38,0)")


def components(runs: DataFrame, by: str = "block_id") -> DataFrame:
    """4-connected components within each block: ``runs`` with ``polygon_id``, the smallest run id of its component.

    Runs touch if they are on neighbouring rows and overlap; every run lists itself at its own row and the one below,
    so the join is by row, with overlap as residual.
    """
    r = _run_ids(runs, by)
    above, below = r.alias("p"), r.withColumn("gy", F.col("gy") - 1).alias("q")
    meet = (F.col(f"p.{by}") == F.col(f"q.{by}")) & (F.col("p.gy") == F.col("q.gy")) & (F.col("p.x0") < F.col("q.x1")) & (F.col("q.x0") < F.col("p.x1"))
    edges = above.join(below, meet).select(F.col("p.run").alias("a"), F.col("q.run").alias("b"))
    labels = connected_components(edges)
    return r.join(labels, r["run"] == labels["id"], "left").select(by, "gy", "x0", "x1", F.coalesce("component", "run").alias("polygon_id"))


def areas(shaped: DataFrame, settings: Settings, key: str = "polygon_id") -> DataFrame:
    """``key, pixels, pol_area_m2, minx, miny, maxx, maxy`` (pixels) by shape."""
    a = shaped.groupBy(key).agg(F.sum(F.col("x1") - F.col("x0")).cast("long").alias("pixels"), F.min("x0").alias("minx"), F.min("gy").alias("miny"), F.max("x1").alias("maxx"), (F.max("gy") + 1).alias("maxy"))
    return a.withColumn("pol_area_m2", F.col("pixels") * settings.pixel_m**2)


def drop_small(shaped: DataFrame, settings: Settings) -> DataFrame:
    """Shapes of the least area or more."""
    enough = shaped.groupBy("polygon_id").agg(F.sum(F.col("x1") - F.col("x0")).alias("px")).where(F.col("px") >= settings.pixels(settings.urban_min_area_m2))
    return shaped.join(enough.select("polygon_id"), "polygon_id", "left_semi")


def fill_small_holes(shaped: DataFrame, settings: Settings) -> DataFrame:
    """Holes below the cut-off become part of their shape.

    A hole is a component of the gaps between a shape's runs, within its bounds, that touches neither the bounds' top
    and bottom row nor an open end. Gaps connect diagonally too, as the shape does not.
    """
    row = Window.partitionBy("polygon_id", "gy").orderBy("x0")
    box = shaped.groupBy("polygon_id").agg(F.min("gy").alias("top"), F.max("gy").alias("bottom"), F.min("x0").alias("left"), F.max("x1").alias("right"))
    rows = shaped.join(box, "polygon_id")
    gaps = rows.withColumn("prev", F.lag("x1").over(row)).select("polygon_id", "block_id", "gy", "top", "bottom", "left", "right", F.coalesce("prev", F.col("left") - 1).alias("x0"), F.col("x0").alias("x1"))
    tails = rows.groupBy("polygon_id", "block_id", "gy", "top", "bottom", "left", "right").agg(F.max("x1").alias("x0")).withColumn("x1", F.col("right") + 1)
    gaps = gaps.unionByName(tails.select(*gaps.columns)).where("x0 < x1")
    # a gap as wide as the cut-off keeps its component from being small, as an open one keeps it from being closed
    wide = F.col("x1") - F.col("x0") >= settings.pixels(settings.min_hole_area_m2)
    stays = wide | (F.col("x0") < F.col("left")) | (F.col("x1") > F.col("right")) | (F.col("gy") == F.col("top")) | (F.col("gy") == F.col("bottom"))
    # the corner is the shape's: Spark 4.1 can plan a window over a union on rows that are not together
    gap = _wide_id("polygon_id", F.col("gy") - F.col("top"), F.col("x0") - F.col("left") + 1)
    gaps = stage(gaps.select("polygon_id", "block_id", "gy", "x0", "x1", stays.alias("stays"), gap.alias("gap")), "gaps")
    p, q = gaps.alias("p"), gaps.withColumn("gy", F.col("gy") - 1).alias("q")
    meet = (F.col("p.polygon_id") == F.col("q.polygon_id")) & (F.col("p.gy") == F.col("q.gy")) & (F.col("p.x0") <= F.col("q.x1")) & (F.col("q.x0") <= F.col("p.x1")) & ~(F.col("p.stays") & F.col("q.stays"))
    met = stage(p.join(q.hint("merge"), meet).select(F.col("p.gap").alias("a"), F.col("p.stays").alias("a_stays"), F.col("q.gap").alias("b"), F.col("q.stays").alias("b_stays")), "met")
    labels = connected_components(met.where("not a_stays and not b_stays").select("a", "b"))
    beside = met.where("a_stays or b_stays").select(F.when(F.col("a_stays"), F.col("b")).otherwise(F.col("a")).alias("gap")).distinct().withColumn("beside", F.lit(True))
    g = gaps.where("not stays").join(labels.hint("merge"), F.col("gap") == labels["id"], "left").join(beside.hint("merge"), "gap", "left").withColumn("hole", F.coalesce("component", "gap"))
    small = g.groupBy("hole").agg(F.sum(F.col("x1") - F.col("x0")).alias("px"), F.count("beside").alias("beside")).where((F.col("beside") == 0) & (F.col("px") < settings.pixels(settings.min_hole_area_m2)))
    filled = g.join(small.select("hole").hint("merge"), "hole", "left_semi").select(*shaped.columns)
    return merge_runs(shaped.unionByName(filled), ["polygon_id", "block_id"])


def merge_runs(runs: DataFrame, by: list[str]) -> DataFrame:
    """The union of runs on each row: overlapping and touching intervals become one."""
    order = Window.partitionBy(*by, "gy").orderBy("x0", "x1")
    reach = F.max("x1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    r = runs.withColumn("new", F.coalesce((F.col("x0") > reach).cast("int"), F.lit(1))).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*by, "gy", "island").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("island")


def overlaps(shaped: DataFrame, least_pixels: int, span: int = 256) -> DataFrame:
    """``a, b, pixels`` of shapes of different blocks that share ``least_pixels`` or more; a < b.

    Runs are joined by row and by the column span (of ``span`` pixels) they touch; a pair is counted in the first span both touch.
    """
    at = lambda v: F.floor(v / span).cast("int")
    r = shaped.select("polygon_id", "block_id", "gy", "x0", "x1").withColumn("s", F.explode(F.sequence(at(F.col("x0")), at(F.col("x1") - 1))))
    p, q = r.alias("p"), r.alias("q")
    both = (F.col("p.gy") == F.col("q.gy")) & (F.col("p.s") == F.col("q.s")) & (F.col("p.polygon_id") < F.col("q.polygon_id")) & (F.col("p.block_id") != F.col("q.block_id"))
    both = both & (F.col("p.x0") < F.col("q.x1")) & (F.col("q.x0") < F.col("p.x1")) & (F.col("p.s") == at(F.greatest("p.x0", "q.x0")))
    shared = F.least("p.x1", "q.x1") - F.greatest("p.x0", "q.x0")
    return p.join(q, both).groupBy(F.col("p.polygon_id").alias("a"), F.col("q.polygon_id").alias("b")).agg(F.sum(shared).cast("long").alias("pixels")).where(F.col("pixels") >= least_pixels)


def merge_shapes(shaped: DataFrame, settings: Settings) -> DataFrame:
    """``root_id, part, gy, x0, x1`` of the shapes merged across blocks.

    Shapes that share enough pixels form a component, whose runs are united and split into 4-connected parts, numbered
    by their first run. A component with more shapes than the hard limit is an error, raised before any union.
    """
    links = overlaps(shaped, settings.pixels(settings.min_overlap_m2))
    labels = connected_components(links)
    rooted = shaped.join(labels, shaped["polygon_id"] == labels["id"], "left").withColumn("root_id", F.coalesce("component", "polygon_id"))
    too_many = rooted.groupBy("root_id").agg(F.count_distinct("polygon_id").alias("n")).where(F.col("n") > settings.large_component_hard_limit_polygons).limit(1).collect()
    if too_many:
        raise ValueError(f"component {too_many[0]['root_id']} has {too_many[0]['n']} polygons")
    united = merge_runs(rooted.select("root_id", "gy", "x0", "x1"), ["root_id"])
    return _parts(united)


def _parts(united: DataFrame) -> DataFrame:
    whole = Window.partitionBy("root_id")
    r = united.withColumn("run", _wide_id("root_id", F.col("gy") - F.min("gy").over(whole), F.col("x0") - F.min("x0").over(whole)))
    p, q = r.alias("p"), r.withColumn("gy", F.col("gy") - 1).alias("q")
    meet = (F.col("p.root_id") == F.col("q.root_id")) & (F.col("p.gy") == F.col("q.gy")) & (F.col("p.x0") < F.col("q.x1")) & (F.col("q.x0") < F.col("p.x1"))
    labels = connected_components(p.join(q, meet).select(F.col("p.run").alias("a"), F.col("q.run").alias("b")))
    labelled = r.join(labels, r["run"] == labels["id"], "left").withColumn("label", F.coalesce("component", "run"))
    firsts = labelled.groupBy("root_id", "label").agg(F.min(F.struct("gy", "x0")).alias("first"))
    part = F.row_number().over(Window.partitionBy("root_id").orderBy("first")) - 1
    return labelled.join(firsts.withColumn("part", part), ["root_id", "label"]).select("root_id", "part", "gy", "x0", "x1")


def size_class(area: Column, settings: Settings) -> Column:
    """P12."""
    return F.when(area > settings.urban_max_area_m2, "large_component").otherwise("parcel_scale")


def geometry_key(shaped: DataFrame, keys: list[str]) -> DataFrame:
    """24 hex digits of SHA-256 over a shape's sorted runs."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("gy", "x0", "x1"))), lambda r: F.concat_ws(",", r["gy"], r["x0"], r["x1"])), ";")
    return shaped.groupBy(*keys).agg(F.substring(F.sha2(text.cast("binary"), 256), 1, 24).alias("geometry_key"))


def representative_point(shaped: DataFrame, key: str) -> DataFrame:
    """The middle of the longest run on the shape's median row (of its rows, the lower middle one)."""
    rows = shaped.groupBy(key).agg(F.array_sort(F.collect_set("gy")).alias("rows"))
    middle = rows.select(F.col(key).alias("_key"), F.col("rows")[((F.size("rows") - 1) / 2).cast("int")].alias("gy"))
    on_row = shaped.join(middle.withColumnRenamed("gy", "_gy"), (F.col(key) == F.col("_key")) & (F.col("gy") == F.col("_gy")))
    longest = on_row.groupBy(key).agg(F.max_by(F.struct("x0", "x1", "gy"), F.struct(F.col("x1") - F.col("x0"), -F.col("x0"))).alias("r"))
    return longest.select(key, ((F.col("r.x0") + F.col("r.x1")) / 2).alias("x"), (F.col("r.gy") + 0.5).alias("y"))


def block_metrics(mask: DataFrame, shaped: DataFrame) -> DataFrame:
    """One row, the metrics of all blocks as a JSON list in order of block; the list has one short entry per block."""
    n = shaped.groupBy("block_id").agg(F.count_distinct("polygon_id").alias("polygons"))
    m = image_metrics(mask).join(n, "block_id", "left").select("block_id", "fill_pixels", "pixels", F.coalesce("polygons", F.lit(0)).alias("polygons"))
    return m.agg(F.to_json(F.array_sort(F.collect_list(F.struct("block_id", "fill_pixels", "pixels", "polygons")))).alias("metrics"))
