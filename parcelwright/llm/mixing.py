"""Mixing sources to target weights (native).

Each document gets a hash-random key; within its source, documents are range-sorted by that key. The key's leading
digits name a range, so the prefix sums of token counts are made in two levels: over the ranges of a source (a fixed
number of rows) and, within the one range in which the source's budget ends, over documents. No task ever sees a whole
source, however hot. Targets come from water filling: sources share the whole size by weight, none above ``max_epochs``
times its own size, and the excess goes to the others by weight.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.llm.text import n_words, packed
from parcelwright.plans.staging import stage

#: Sources whose plans are sent to every executor; above, they are joined by a shuffle.
BROADCAST_SOURCES = 100_000
#: Copies of a row that a task makes at once.
COPIES = 10_000


def _key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":" + seed)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Targets by source: ``source, source_size`` in, with ``target`` (double) and ``weight`` out.

    One row per source is all this window sees. Sources are weighed in code-point order, null last. The water level is
    found exactly: in the order of cap/weight a prefix of sources is held at its cap, and the level for the rest is
    (total - caps of the prefix) / (weights of the rest).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    w = sizes.withColumn("weight", cycle[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")].cast("long"))
    w = w.withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    tightest = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("_total", F.sum("source_size").over(everything))
    w = w.withColumn("_left", F.col("_total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    w = w.withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    w = w.withColumn("_level", F.col("_left").cast("double") / F.col("_weights"))
    free = F.col("cap") > F.col("_level") * F.col("weight")
    w = w.withColumn("_level", F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("_level")))).over(everything)["_level"])
    level = F.col("_level") * F.col("weight")
    target = F.when(F.col("_level").isNull() | (F.col("cap") <= level), F.col("cap").cast("double")).otherwise(level)
    return w.select("source", "source_size", "weight", target.alias("target"))


def _plan(docs: DataFrame, weights: tuple[int, ...], max_epochs: int, range_digits: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The sizes of all rows, and one row per source: ``o_source, source_size, target, full`` (epochs of every document),
    ``last_full`` (the last range that is used once more as a whole) and ``cut_range, cut_at`` (the range in which the
    budget ends, if it ends inside one, and how much of it is left there)."""
    light = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"))
    light = light.withColumn("key", _key(F.col("doc_id"), seed)).withColumn("range", F.substring("key", 1, range_digits))
    light = stage(light, "mix-sizes")
    ranges = light.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)
    below = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("range_from", F.coalesce(F.sum("range_size").over(below), F.lit(0)))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    placed = placed.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select("r.*", "source_size", "target", full.alias("full"))
    placed = placed.withColumn("cut", F.col("target") - F.col("full") * F.col("source_size")).withColumn("range_to", F.col("range_from") + F.col("range_size"))
    inside = (F.col("range_from") < F.col("cut")) & (F.col("range_to") > F.col("cut"))
    plan = placed.groupBy(F.col("source").alias("o_source")).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("full").alias("full"),
        F.max(F.when((F.col("cut") > 0) & (F.col("range_to") <= F.col("cut")), F.col("range"))).alias("last_full"),
        F.max(F.when(inside, F.col("range"))).alias("cut_range"), F.max(F.when(inside, F.col("cut") - F.col("range_from"))).alias("cut_at"),
    )
    return light, stage(plan, "mix-plan")


def _planned(rows: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """Rows with their source's plan, which is broadcast: sources are counted first."""
    side = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    return rows.join(side, F.col(source).eqNullSafe(F.col("o_source")))


def _cut(light: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of the ranges in which budgets end, equal ones as one: ``copies`` of them, of which ``more`` are used once
    more. A copy is used if its middle lies before the cut."""
    ends = _planned(light, plan, "source").where(F.col("range") == F.col("cut_range"))
    plans = ["source_size", "target", "full", "cut_at"]
    alike = ends.groupBy("source", "key", "doc_id", "size", "text_hash").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in plans])
    within = Window.partitionBy("source").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("cut_at") - F.coalesce(F.sum(F.col("size") * F.col("copies")).over(within), F.lit(0))
    fit = F.when(F.col("size") > 0, F.floor(left / F.col("size") + 0.5)).when(left >= 0, F.col("copies")).otherwise(0)
    return alike.withColumn("more", F.least(F.greatest(fit, F.lit(0)), F.col("copies")).cast("long"))


def _repeated(rows: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` times, in blocks that are dealt out, so that no task makes all copies of one row."""
    blocks = rows.withColumn("_times", times).where("_times > 0").withColumn("_block", F.explode(F.expr(f"sequence(0L, (_times - 1) div {COPIES})")))
    dealt = blocks.repartition("_block", "doc_id")
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("_times") - F.col("_block") * COPIES)))).drop("_times", "_block", "_copy")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, range_digits: int = 3, seed: str = "mix") -> DataFrame:
    """How often each document is used: ``doc_id, source, size, source_size, target, epochs, taken``.

    A source whose target is e.g. 2.4 times its size takes every document twice and, in key order, documents until the
    remaining 0.4 is filled; the document across which the cut falls is used if its middle lies before the cut, so the
    words taken miss the target by half a document at most. Null text has size 0, a null source is a source of its own,
    repeated rows are used alike apart from the cut, an empty table gives an empty result. ``16 ** range_digits`` is
    the number of ranges of a source, so the one in which its budget ends holds that share of its documents (and all
    rows of one doc_id). Other columns are not read.
    """
    light, plan = _plan(docs, weights, max_epochs, range_digits, seed)
    whole = _planned(light, plan, "source").where(F.col("cut_range").isNull() | (F.col("range") != F.col("cut_range")))
    columns = ["doc_id", "source", "size", "source_size", "target"]
    whole = whole.select(*columns, (F.col("full") + F.coalesce(F.col("range") <= F.col("last_full"), F.lit(False)).cast("long")).alias("epochs"))
    cut = stage(_cut(light, plan), "mix-cut")
    once = [_repeated(cut, n).select(*columns, (F.col("full") + e).alias("epochs")) for e, n in ((1, F.col("more")), (0, F.col("copies") - F.col("more")))]
    return reduce(DataFrame.union, [whole, *once]).select(*columns, "epochs", (F.col("size") * F.col("epochs")).alias("taken"))


def take(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, range_digits: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` uses it, all columns, under its own doc_id.

    A row's source and the range of its key say how often it is used, so texts are not shuffled but for those of the one
    range by source in which the budget ends. There, rows with equal doc_id, source and text are one group: all are used
    alike, and the uses that only some copies get are repeated from one of them.
    """
    light, plan = _plan(docs, weights, max_epochs, range_digits, seed)
    rows = _planned(packed(docs).withColumn("_range", F.substring(_key(F.col("row.doc_id"), seed), 1, range_digits)), plan, "row.source")
    ends = F.col("cut_range").isNotNull() & (F.col("_range") == F.col("cut_range"))
    whole = rows.where(~ends).withColumn("_epochs", F.col("full") + F.coalesce(F.col("_range") <= F.col("last_full"), F.lit(False)).cast("long"))
    same = ["doc_id", "source", "text_hash"]
    more = _cut(light, plan).select(*[F.col(c).alias(f"_{c}") for c in same], "copies", "more")
    on = F.col("row.doc_id").eqNullSafe(F.col("_doc_id")) & F.col("row.source").eqNullSafe(F.col("_source")) & F.xxhash64("row.text").eqNullSafe(F.col("_text_hash"))
    cut = stage(rows.where(ends).join(more, on).select("row", "full", "_doc_id", "_source", "_text_hash", "copies", "more"), "mix-cut")
    alike = cut.withColumn("_epochs", F.col("full") + (F.col("more") == F.col("copies")).cast("long"))
    some = cut.where("more > 0 and more < copies")  # one group by source at most
    one = some.groupBy("_doc_id", "_source", "_text_hash").agg(F.first("row").alias("row"), F.first("more").alias("more"))
    apart = _repeated(one.select("row", "more", F.col("_doc_id").alias("doc_id")), F.col("more")).withColumn("_epochs", F.lit(1).cast("long"))
    used = reduce(DataFrame.union, [x.select("row", "_epochs") for x in (whole, alike, apart)]).where("_epochs > 0")
    return used.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_epochs").cast("int")))).select("row.*")
