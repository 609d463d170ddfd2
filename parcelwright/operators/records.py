"""Role keys, attempt logs and response records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwright.functions import scalars as S

TERMINAL = ("ok", "not_found")
RECORD = "map<string,string>"
# Fields of a response that keep their name, and those that are renamed.
FIELDS = (
    "existePredio eacs eacano eacsDescripcion nombreComuna destinoDescripcion ubicacion valorTotal valorAfecto valorExento "
    "supTerreno supConsMt2 supConsMt3 medidaSup medidaSupConst ah sector tablaOrigen periodo"
).split()
RENAMED = {"direccion": "direccion_sii", "ubicacionX": "lat", "ubicacionY": "lon"}
NESTED = {"datosAh": "ah", "predioPublicado": "predioPublicado"}
LAYERS, FIRST_OF = "datosCapas", {"datosCsa": "csa"}


def role_keys(historic: DataFrame, commune: int | None = None) -> DataFrame:
    """``manzana, predio, rol``, distinct before the keys are cleaned, so that 001 and 1 may both stay.

    Ordered as text by (manzana, predio). Without ``commune``, keys of all communes with their ``comuna``.
    """
    by = ["manzana", "predio"] if commune is not None else ["comuna", "manzana", "predio"]
    rows = historic.where(F.col("comuna") == commune) if commune is not None else historic
    keys = rows.select(*by).dropna(subset=["manzana", "predio"]).distinct()
    keys = keys.withColumns({c: S.key(F.col(c).cast("string")) for c in ("manzana", "predio")})
    return keys.withColumn("rol", S.role(F.col("manzana"), F.col("predio")))


def role_keys_csv(text_rows: DataFrame, commune: int) -> DataFrame:
    """The same from all-text rows, whose commune may read ``014504.0``."""
    return role_keys(text_rows.where(F.ltrim(F.regexp_replace("comuna", r"\.0$", ""), F.lit("0")) == str(commune)).withColumn("comuna", F.lit(commune)), commune)


def latest(log: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """The last row of each key by ``order`` (descending columns)."""
    keys = [key] if isinstance(key, str) else key
    return log.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def upsert(log: DataFrame) -> DataFrame:
    """The current state of an append-only log (query_key, source, commune, ..., status, attempts, queried_at, seq).

    What names the key stays as first seen; status, attempts, time, point, response and error are the last seen.
    """
    fixed = [c for c in ("source", "commune", "manzana", "predio", "polygon_id", "geometry_key") if c in log.columns]
    moving = [c for c in ("status", "attempts", "queried_at", "point_lon", "point_lat", "response", "error") if c in log.columns]
    at = F.struct("queried_at", "seq")
    return log.groupBy("query_key").agg(*[F.min_by(c, at).alias(c) for c in fixed], *[F.max_by(c, at).alias(c) for c in moving])


def pending(keys: DataFrame, state: DataFrame, on: list[str], force: bool = False) -> DataFrame:
    """The keys still to be asked for."""
    return keys if force else keys.join(state.where(F.col("status").isin(*TERMINAL)).select(*on).distinct(), on, "left_anti")


def role_status(exists: Column, name: Column, error: Column) -> Column:
    """P10: ``exists`` is the field as JSON text; of texts only "1" counts, of numbers 1, of booleans true."""
    found = exists.isin("1", '"1"', "true", "1.0")
    return F.when(F.coalesce(found, F.lit(False)) | name.isNotNull(), "ok").when(error.isNull(), "not_found").otherwise("error")


def page(df: DataFrame, key: str, after: int, size: int) -> DataFrame:
    """Keyset paging."""
    return df.where(F.col(key) > after).orderBy(key).limit(size)


def _plain(value: Column) -> Column:
    """A JSON value as text: strings without quotes, null as null, all else as JSON."""
    return F.when(value == "null", None).when(value.startswith('"'), F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "v string")["v"]).otherwise(value)


def normalize(responses: DataFrame) -> DataFrame:
    """``response`` (JSON text) to canonical columns and ``extras`` (map of text).

    ``responses`` also has commune, manzana and predio, which serve where the response has none. Nested objects get
    their prefix, of ``datosCsa`` the first element counts, ``datosCapas`` becomes ``cap__title__label`` with ``__2``,
    ``__3``, ... for labels that repeat with another value, and what is left becomes ``api_name``. No JSON, an array or
    a scalar counts as an empty object.
    """
    r = responses.withColumn("__json", F.coalesce(F.when(F.trim("response").startswith("{"), F.from_json("response", RECORD)), F.from_json(F.lit("{}"), RECORD)))
    m = F.col("__json")
    text = lambda c: F.when(c.isNull() | (c == "null"), None).otherwise(c)
    field = lambda name: text(m[name])
    block = F.coalesce(field("manzana"), F.col("manzana"), F.lit(""))
    lot = F.coalesce(field("predio"), F.col("predio"), F.lit(""))
    bare = lambda c: F.when(F.ltrim(c, F.lit("0")) == "", "0").otherwise(F.ltrim(c, F.lit("0")))
    nested = lambda source, prefix: F.transform_keys(F.coalesce(F.from_json(m[source], RECORD), F.from_json(F.lit("{}"), RECORD)), lambda k, _: F.concat(F.lit(prefix + "_"), k))
    first = lambda source, prefix: F.transform_keys(F.coalesce(F.get(F.from_json(m[source], f"array<{RECORD}>"), F.lit(0)), F.from_json(F.lit("{}"), RECORD)), lambda k, _: F.concat(F.lit(prefix + "_"), k))
    known = [*FIELDS, *RENAMED, *NESTED, *FIRST_OF, LAYERS, "rol", "manzana", "predio", "comuna"]
    rest = F.transform_keys(F.map_filter(m, lambda k, _: ~k.isin(*known)), lambda k, _: F.concat(F.lit("api_"), k))
    layers = F.from_json(m[LAYERS], "array<struct<titulo:string,datos:array<struct<etiqueta:string,valor:string>>>>")
    items = F.flatten(F.transform(F.coalesce(layers, F.array().cast("array<struct<titulo:string,datos:array<struct<etiqueta:string,valor:string>>>>")), lambda c: F.transform(F.filter(F.coalesce(c["datos"], F.array().cast("array<struct<etiqueta:string,valor:string>>")), lambda d: d["etiqueta"].isNotNull()), lambda d: F.struct(
        F.concat(F.lit("cap__"), S.label_slug(F.when(F.length(c["titulo"]) > 0, c["titulo"]).otherwise("sin_titulo")), F.lit("__"), S.label_slug(d["etiqueta"])).alias("k"), d["valor"].alias("v")))))
    distinct = F.array_distinct(items)
    numbered = F.transform(distinct, lambda d, i: F.struct(d["k"].alias("k"), d["v"].alias("v"), F.size(F.filter(F.slice(distinct, 1, i), lambda e: e["k"] == d["k"])).alias("before")))
    capped = F.map_from_entries(F.transform(numbered, lambda d: F.struct(F.when(d["before"] == 0, d["k"]).otherwise(F.concat(d["k"], F.lit("__"), (d["before"] + 1).cast("string"))), d["v"])))
    return r.select(
        *[c for c in responses.columns if c not in ("manzana", "predio", "response")], F.col("commune").cast("int").alias("comuna"), bare(block).alias("manzana"), bare(lot).alias("predio"),
        *[field(f).alias(f) for f in FIELDS], *[field(a).alias(b) for a, b in RENAMED.items()],
        S.role(bare(block), bare(lot), field("rol")).alias("rol"),
        F.map_concat(*[nested(s, p) for s, p in NESTED.items()], *[first(s, p) for s, p in FIRST_OF.items()], capped, rest).alias("extras"),
    )


def wide(records: DataFrame, keys: list[str]) -> DataFrame:
    """The extras that a sink asks for, as columns."""
    return records.select(*[c for c in records.columns if c != "extras"], *[F.col("extras")[k].alias(k) for k in keys])


def role_rows(state: DataFrame, commune: str) -> DataFrame:
    """A commune's current role answers, normalised, ordered as text by block and lot."""
    rows = state.where((F.col("source") == "role") & (F.col("commune") == commune))
    tagged = rows.select(
        "commune", "manzana", "predio", "response", (F.col("status") == "ok").alias("_ok"), F.col("status").alias("_status"), F.col("attempts").alias("_api_attempts"),
        F.col("queried_at").alias("_api_queried_at"), F.col("error").alias("_api_error"), F.col("manzana").alias("_m"), F.col("predio").alias("_p"),
    )
    return normalize(tagged).orderBy("_m", "_p").drop("_m", "_p")
