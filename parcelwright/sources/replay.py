"""Captured responses as a source (S13-S17): requests are built as columns, answers come from stored JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.operators.orphans import NO_PARCEL

RESPONSES = "query_key string, status_code int, body string, attempts int"
WIDTH, HEIGHT = 800, 600


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Stored attempts; the last of a key counts."""
    rows = spark.read.schema(RESPONSES).json(path)
    return rows.groupBy("query_key").agg(F.max_by(F.struct("status_code", "body", "attempts"), "attempts").alias("r")).select("query_key", "r.*")


def role_request(commune: Column, block: Column, lot: Column, layer: Column) -> Column:
    """The request of a role, as JSON; keys are numbers without leading zeros, sent as text."""
    bare = lambda c: c.cast("long").cast("string")
    return F.to_json(F.struct(bare(commune).alias("comuna"), bare(block).alias("manzana"), bare(lot).alias("predio"), layer.alias("layer")))


def click(lon: Column, lat: Column, bounds: Column) -> Column:
    """struct(x, y) of a point in a window's image, with four places."""
    x = (lon - bounds["min_lon"]) / (bounds["max_lon"] - bounds["min_lon"]) * WIDTH
    y = F.lit(float(HEIGHT)) - (lat - bounds["min_lat"]) / (bounds["max_lat"] - bounds["min_lat"]) * HEIGHT
    return F.struct(F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


def point_result(data: Column, error: Column) -> Column:
    """struct(data, error); an answer without a parcel is null with an error.

    ``existePredio`` missing counts as -1 and ``manzana`` missing as 0.
    """
    at = lambda name, missing: F.coalesce(F.get_json_object(data, f"$.{name}"), F.lit(missing))
    empty = data.isNotNull() & ((at("existePredio", "-1") == "-1") | (at("manzana", "0") == "0"))
    return F.struct(F.when(~empty, data).alias("data"), F.when(empty, F.lit(NO_PARCEL)).otherwise(error).alias("error"))


def context(rows: DataFrame, default_layer: str) -> DataFrame:
    """The first element of each commune's context; none is an error when the row is read."""
    first = F.element_at("context", 1)
    return rows.select("commune", F.when(F.size("context") > 0, F.struct(F.coalesce(first["layer"], F.lit(default_layer)).alias("layer"))).otherwise(F.raise_error(F.concat(F.lit("no context for "), F.col("commune"))).cast("struct<layer:string>")).alias("context"))


def delays(max_retries: int, base: float, limited: Column) -> Column:
    """Seconds to wait after each attempt but the last: base * 2**attempt if the server limits requests, else half that."""
    return F.transform(F.sequence(F.lit(1), F.lit(max_retries - 1)), lambda n: F.lit(base) * F.pow(F.lit(2.0), F.when(limited, n).otherwise(n - 1)))


def fallback_urls(urls: Column) -> Column:
    """Distinct URLs in order, with their hosts."""
    return F.transform(F.array_distinct(urls), lambda u: F.struct(u.alias("url"), F.try_parse_url(u, F.lit("HOST")).alias("host")))


def last_status(attempts: DataFrame) -> DataFrame:
    """Status of a key from its attempts (attempt, status_code, ok). Running out of attempts is an error, also under rate limits: a later run asks again."""
    grouped = attempts.groupBy("query_key").agg(F.bool_or("ok").alias("ok"), F.max("attempt").alias("attempts"))
    return grouped.select("query_key", "attempts", F.when(F.col("ok"), "ok").otherwise("error").alias("status"))
