"""Commune catalogue and published status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.functions.scalars import normalize_name

#: The commune that the source catalogue lacks (fixed value).
ADDED = ("8108", "Trehuaco", "Ñuble")
PENDING = "pendiente"
KEY = ["periodo", "codigo_comuna"]


def with_added(communes: DataFrame) -> DataFrame:
    """``code, name, region`` with the synthetic commune, if it is absent, by normalised region and name."""
    spark = communes.sparkSession
    extra = spark.range(1).select(*[F.lit(v).alias(n) for v, n in zip(ADDED, ("code", "name", "region"), strict=True)])
    both = communes.select("code", "name", "region", F.lit(0).alias("_rank")).unionByName(extra.withColumn("_rank", F.lit(1)))
    out = both.where(F.col("code").isNotNull()).withColumn("_least", F.min("_rank").over(Window.partitionBy("code"))).where("_rank = _least").drop("_rank", "_least")
    return out.orderBy(normalize_name(F.col("region")), normalize_name(F.col("name")))


def find(communes: DataFrame, wanted: str) -> DataFrame:
    """The one commune with this code or normalised name; any other number of hits is an error."""
    hits = communes.where((F.col("code") == wanted) | (normalize_name(F.col("name")) == normalize_name(F.lit(wanted))))
    n = hits.limit(2).count()
    if n != 1:
        raise ValueError(f"{n} communes match {wanted!r}")
    return hits


def in_region(communes: DataFrame, region: str) -> DataFrame:
    """The communes of a region by normalised name; a region without communes is an error."""
    hits = communes.where(normalize_name(F.col("region")) == normalize_name(F.lit(region)))
    if hits.isEmpty():
        raise ValueError(f"no communes in {region!r}")
    return hits


def region_assets(communes: DataFrame, assets: DataFrame) -> DataFrame:
    """Each region's communes and asset by normalised name; a region without an asset is an error."""
    grouped = communes.groupBy(normalize_name(F.col("region")).alias("region_key")).agg(F.count("*").alias("n_communes"), F.array_sort(F.collect_list("code")).alias("codes"))
    return grouped.join(assets.select(normalize_name(F.col("region")).alias("region_key"), "file"), "region_key", "left").withColumn("file", F.coalesce("file", F.raise_error(F.concat(F.lit("no historic asset for region "), F.col("region_key"))).cast("string")))


def seed(existing: DataFrame, communes: DataFrame, period: str) -> DataFrame:
    """What exists, and a pending row for every commune without one in this period."""
    new = communes.select(F.lit(period).alias("periodo"), F.col("code").alias("codigo_comuna"), F.col("name").alias("comuna"), "region", F.lit(PENDING).alias("status"))
    return existing.unionByName(new.join(existing, KEY, "left_anti"), allowMissingColumns=True)


def upsert(catalog: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of ``changed`` replace those with their key."""
    return catalog.join(changed.select(*KEY).distinct(), KEY, "left_anti").unionByName(changed, allowMissingColumns=True)


def chosen(communes: DataFrame, wanted: list[str]) -> DataFrame:
    """The communes whose code or normalised name is in a list."""
    names = [normalize_name(F.lit(w)) for w in wanted]
    return communes.where(F.col("code").isin(*wanted) | normalize_name(F.col("name")).isin(*names))


def by_position(communes: DataFrame, region: str, positions: list[int] | None = None) -> DataFrame:
    """A region's communes by name, all or those at 1-based positions."""
    ordered = in_region(communes, region).withColumn("position", F.row_number().over(Window.orderBy(normalize_name(F.col("name")))))
    return ordered if positions is None else ordered.where(F.col("position").isin(*positions))
