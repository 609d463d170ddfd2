"""Table sources (S02-S08, S20, S22): historic extracts, catalogues, boundaries, manifests."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.functions.geometry import RINGS
from parcelwright.functions.scalars import normalize_name
from parcelwright.sinks.files import exists, file_hash, file_size


def historic_parquet(spark: SparkSession, path: str, commune: int) -> DataFrame:
    """Three columns, with the commune pushed down to the scan."""
    return spark.read.parquet(path).where(F.col("comuna") == commune).select("comuna", "manzana", "predio")


def historic_csv(spark: SparkSession, path: str) -> DataFrame:
    """All text; columns are found by name and the three that are used are kept."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in ("comuna", "manzana", "predio")])


def newest(spark: SparkSession, folder: str, pattern: str) -> str:
    """The lexicographically last file name that fits, through Spark's own file systems."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(conf).listStatus(path)]
    fitting = sorted(n for n in names if fnmatch.fnmatch(n, pattern))
    if not fitting:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return f"{folder.rstrip('/')}/{fitting[-1]}"


def communes_json(spark: SparkSession, path: str) -> DataFrame:
    """``code, name, region`` from a JSON array of id, nombre, region."""
    rows = spark.read.schema("id string, nombre string, region string").option("multiLine", True).json(path)
    return rows.select(F.col("id").alias("code"), F.col("nombre").alias("name"), "region")


def boundary_geojson(spark: SparkSession, path: str, name: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """``name, parts`` (array of polygons, each its rings) of the features whose COMUNA or NOMBRE is ``name``."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    label = _name_of()
    wanted = normalize_name(F.lit((aliases or {}).get(name, name)))
    ring = "array<array<double>>"
    points = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    polygon = F.from_json("f.geometry.coordinates", f"array<{ring}>")
    multi = F.from_json("f.geometry.coordinates", f"array<array<{ring}>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(polygon)).otherwise(multi)
    parts = F.transform(parts, lambda p: F.transform(p, points))
    found = f.where(normalize_name(label) == wanted).select(parts.cast(f"array<{RINGS}>").alias("parts"))
    return found.agg(F.flatten(F.collect_list("parts")).alias("parts")).where(F.size("parts") > 0).select(F.lit(name).alias("name"), "parts")


def _name_of() -> F.Column:
    """The property that names a commune, whatever the spelling of its key."""
    of = lambda want: F.get(F.map_values(F.map_filter(F.col("f.properties"), lambda k, _: normalize_name(k) == want)), F.lit(0))
    return F.coalesce(of("COMUNA"), of("NOMBRE"))


def asset_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per asset of a manifest JSON."""
    schema = "columns array<string>, assets array<struct<region:string,file:string,bytes:bigint,rows:bigint,sha256:string,urls:array<string>>>"
    m = spark.read.schema(schema).option("multiLine", True).json(path)
    return m.select("columns", F.explode("assets").alias("a")).select("columns", "a.*")


def validate_asset(spark: SparkSession, path: str, size: int, sha256: str, rows: int, columns: list[str], communes: list[int]) -> None:
    """Size, hash, row count, columns in order, and a row for every commune; the first that fails is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if (found := file_size(spark, path)) != size:
        raise ValueError(f"{path}: {found} bytes, not {size}")
    if file_hash(spark, path) != sha256:
        raise ValueError(f"{path}: hash differs")
    data = spark.read.parquet(path)
    if data.columns != columns:
        raise ValueError(f"{path}: columns differ")
    if (n := data.count()) != rows:
        raise ValueError(f"{path}: {n} rows, not {rows}")
    if communes:
        have = data.where(F.col("comuna").isin(*communes)).agg(F.collect_set(F.col("comuna").cast("int"))).first()[0]  # the wanted ones at most
        if missing := sorted(set(communes) - set(have)):
            raise ValueError(f"{path}: no rows for {missing}")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON manifest, or no rows if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(conf).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)
