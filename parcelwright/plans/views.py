"""Deterministic views over the driver's tables, which stand in for cadastral inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.functions.geometry import box


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as boxes, 40 to a row of as many rows as it takes; every 97th is a large component."""
    k, s = F.col("p_partkey"), F.col("p_size")
    x, y = (k % 40) * F.lit(30.0), F.floor(k / 40) * F.lit(30.0)
    w, h = (6 + s % 12).cast("double"), (6 + s % 15).cast("double")
    return table(spark, sf_dir, "part").select(k.alias("_poly_idx"), box(x, y, x + w, y + h).alias("rings"), (w * h).alias("pol_area_m2"), F.when(k % 97 == 0, "large_component").otherwise("parcel_scale").alias("pol_size_class"))


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as roles, spread over the rows of boxes; pairs share a point, every 11th has no valid one."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    h = F.floor(k / 2)
    x, y = (h * 7919 % 12007) * F.lit(0.1), F.floor(h / 30) * F.lit(60.0) + (h * 104729 % 601) * F.lit(0.1)
    status = F.when(k % 13 == 0, "not_found").when(k % 17 == 0, "error").otherwise("ok")
    return c.select(
        k.alias("rid"), F.col("c_nationkey").cast("string").alias("manzana"), F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), k.cast("string")).alias("rol"), x.alias("x"), y.alias("y"),
        (x / 100000).alias("lon"), (y / 100000).alias("lat"), (k % 11 != 0).alias("valid"), F.concat(F.lower("c_mktsegment"), F.lit("  "), (k % 7).cast("string"), F.when(k % 3 == 0, F.concat(F.lit(" DP "), k.cast("string"))).otherwise("")).alias("address"), status.alias("_status"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored of each polygon: an answer for those that are divisible by 3, the others are still to be asked."""
    k = F.col("p_partkey")
    found = k % 6 == 0
    return table(spark, sf_dir, "part").select(
        F.substring(F.sha2(k.cast("string").cast("binary"), 256), 1, 24).alias("geometry_key"), F.when(k % 3 != 0, "pending").when(found, "ok").when(k % 9 == 0, "error").otherwise("not_found").alias("status"),
        F.when(k % 3 != 0, 0).otherwise(1).alias("attempts"), F.lit("2026-01-01T00:00:00Z").alias("queried_at"), F.when(found, F.lit("900")).alias("manzana"), F.when(found, k.cast("string")).alias("predio"),
        F.when(found, F.concat(F.lit("900-"), k.cast("string"))).alias("rol"),
    )


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fill mask of 64 pixels by as many rows as there are suppliers, seen through overlapping blocks of 32 by 32 pixels, 16 apart."""
    n, y = table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("long")  # its square passes an int from row 26,755 on
    pixels = n.select(y.alias("y"), F.col("s_nationkey").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("x"))
    pixels = pixels.select("x", "y", ((F.col("x") * F.col("x") + 3 * F.col("y") * F.col("y") + F.col("x") * F.col("y") + F.col("n")) % 7 < 4).alias("fill"))
    r = F.floor(F.col("y") / 16)
    seen = pixels.withColumn("r", F.explode(F.array(r, r - 1))).withColumn("c", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    seen = seen.where((F.col("r") >= 0) & (F.col("x") >= F.col("c") * 16) & (F.col("x") < F.col("c") * 16 + 32))
    return seen.select((F.col("r") * 3 + F.col("c")).cast("long").alias("block_id"), "x", "y", "fill")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as pixels of images, one image per ship mode's line number."""
    li, v = table(spark, sf_dir, "lineitem"), F.col("l_partkey") * 7 + F.col("l_suppkey") * 13
    quantity = F.col("l_quantity").cast("long")
    return li.select(
        F.col("l_linenumber").alias("image"), (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("pos"), (F.lit(170) + v % 30).cast("int").alias("r"), (F.lit(205) + (v + quantity) % 40).cast("int").alias("g"), (F.lit(215) + (v * 3) % 41).cast("int").alias("b"), (quantity * 5 + 3).cast("int").alias("a"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts: key user and type; the type decides the status."""
    e = table(spark, sf_dir, "events")
    rank = F.pmod(F.length("event_type"), F.lit(3))
    return e.select(
        F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("query_key"), "event_type", F.col("user_id").cast("string").alias("commune"), F.when(rank == 0, "ok").when(rank == 1, "not_found").otherwise("error").alias("status"), F.col("event_id").alias("seq"), F.col("ts").alias("queried_at"), F.col("props").alias("response"), "value",
    )


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))


def historic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the historic extract: keys with leading zeros, some with a decimal suffix."""
    pad = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    return table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("comuna"), F.concat(pad("l_orderkey", 9), F.when(F.col("l_orderkey") % 5 == 0, ".0").otherwise("")).alias("manzana"), pad("l_suppkey", 6).alias("predio"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supercell plan per commune, with a gap."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_nationkey").alias("k"))
    n = n.withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(11)))).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(6)))).where((F.col("x") + F.col("y") * F.col("k")) % 5 != 0)
    return n.select("code", (F.col("x") * 4 + F.when(F.col("x") > 5, 4000).otherwise(0)).alias("sc_x"), (F.col("y") * 4).alias("sc_y"))
