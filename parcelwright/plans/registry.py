"""The registered queries over the driver's tables and their DuckDB SQL. IDs name the operators that a query covers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwright.functions import geometry
from parcelwright.functions import scalars as S
from parcelwright.operators import catalog, grid, matching, orphans, records, runs, summary, trace
from parcelwright.plans import views
from parcelwright.plans.oracles import ORACLES  # noqa: F401
from parcelwright.plans.stages import block_identities as stage_identities
from parcelwright.plans.stages import changed_blocks, consistent
from parcelwright.plans.staging import shared_dir, stage
from parcelwright.settings import Settings
from parcelwright.sinks.files import raw_export, read_catalog, write_catalog, write_json, write_lines, write_parquet
from parcelwright.sources import replay, tables
from parcelwright.streaming.attempts import status_by_window

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class _Unit(Settings):
    """Settings whose pixel is one metre."""

    @property
    def pixel_m(self) -> float:
        return 1.0


#: The synthetic lattice is coarse: its pixel is a square metre.
LATTICE = _Unit(urban_min_area_m2=3, urban_max_area_m2=60, min_hole_area_m2=4, min_overlap_m2=1)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES["q_" + f.__name__] = f
    return f


@query
def role_keys(spark: SparkSession, d: str) -> DataFrame:
    """S04 A07 T05 T06 O02"""
    return records.role_keys(views.historic(spark, d)).orderBy("comuna", "manzana", "predio")


@query
def latest_status(spark: SparkSession, d: str) -> DataFrame:
    """W04 R01"""
    e = records.latest(views.events(spark, d), "query_key", F.desc("queried_at"), F.desc("seq"))
    return e.select("query_key", "status", "seq", F.col("queried_at").cast("string").alias("queried_at"))


@query
def upsert_state(spark: SparkSession, d: str) -> DataFrame:
    """Fixed columns as first seen, moving ones as last seen"""
    return records.upsert(views.events(spark, d)).select("query_key", "commune", "status", "response")


@query
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """A04 over the current state"""
    return summary.status_counts(records.upsert(views.events(spark, d)))


@query
def status_row(spark: SparkSession, d: str) -> DataFrame:
    """Of the role answers"""
    source = F.when(F.col("seq") % 3 == 0, "point").otherwise("role")
    return summary.status_row(records.upsert(views.events(spark, d).withColumn("source", source)), "role")


@query
def role_status(spark: SparkSession, d: str) -> DataFrame:
    """P10"""
    e = views.events(spark, d)
    exists = F.when(F.col("seq") % 4 == 0, F.lit("1")).when(F.col("seq") % 4 == 1, F.lit("0")).when(F.col("seq") % 4 == 2, F.lit('"true"'))
    name, error = F.when(F.col("seq") % 10 == 5, "name"), F.when(F.col("seq") % 3 == 0, "timeout")
    return e.select("seq", records.role_status(exists, name, error).alias("status"))


@query
def anti_resume(spark: SparkSession, d: str) -> DataFrame:
    """P09 R09 R10"""
    keys = views.events(spark, d).select("query_key").distinct()
    return records.pending(keys, records.upsert(views.events(spark, d)), ["query_key"])


@query
def retry_pass(spark: SparkSession, d: str) -> DataFrame:
    """What a second pass asks for, and how long it waits"""
    e = views.events(spark, d).withColumn("ok", F.col("status") == "ok").withColumn("attempt", F.row_number().over(Window.partitionBy("query_key").orderBy("seq")))
    failed = replay.last_status(e.select("query_key", "ok", "attempt")).where("status = 'error'")
    waits = F.aggregate(replay.delays(5, 2.0, F.col("attempts") % 2 == 0), F.lit(0.0), lambda t, v: t + v)
    return failed.select("query_key", "attempts", waits.alias("total_wait"))


@query
def props_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Canonical columns and extras"""
    seq = F.col("seq").cast("string")  # padded to six digits, but never cut to them
    e = views.events(spark, d).select("seq", F.col("commune"), F.lit("007").alias("manzana"), F.lpad(seq, F.greatest(F.lit(6), F.length(seq)), F.lit("0")).alias("predio"), "response")
    r = records.normalize(e)
    return records.wide(r, ["api_k"]).select("seq", "comuna", "manzana", "predio", "rol", "api_k")


@query
def names(spark: SparkSession, d: str) -> DataFrame:
    """T01 on whole texts"""
    t = F.concat(F.lit(" "), F.coalesce("text", F.lit("")))
    return views.table(spark, d, "documents").select("doc_id", F.md5(S.normalize_name(t)).alias("name_md5"))


@query
def slugs(spark: SparkSession, d: str) -> DataFrame:
    """T02 T03"""
    title = F.concat("n_name", F.lit(" d'Ñuble -- Ó"))
    return views.table(spark, d, "nation").select("n_nationkey", S.slug(title).alias("slug"), S.label_slug(title).alias("label"))


@query
def addresses(spark: SparkSession, d: str) -> DataFrame:
    """T04"""
    return views.roles(spark, d).select("rid", S.normalize_address(F.col("address")).alias("address"))


@query
def expected_period(spark: SparkSession, d: str) -> DataFrame:
    """T07"""
    o = views.table(spark, d, "orders")
    half = F.when(F.month("o_orderdate") <= 6, "1").when(F.month("o_orderdate") <= 11, "2").otherwise("3")
    return o.select("o_orderkey", S.expected_period(F.concat(F.year("o_orderdate").cast("string"), F.lit("s"), half)).alias("label"))


@query
def observed_periods(spark: SparkSession, d: str) -> DataFrame:
    """A11 P19"""
    o = views.table(spark, d, "orders")
    period = S.expected_period(F.concat(F.year("o_orderdate").cast("string"), F.lit("S"), F.when(F.month("o_orderdate") <= 6, "1").otherwise("2")))
    return summary.observed_periods(o.select(period.alias("periodo")), S.expected_period(F.lit("1995S2")))


@query
def mercator(spark: SparkSession, d: str) -> DataFrame:
    """Project, find the supercell, come back"""
    r = views.roles(spark, d).select("rid", (F.col("lon") * 100 - 70).alias("lon"), (F.col("lat") * 100 - 33).alias("lat"))
    p = r.select("rid", S.mercator_x(F.col("lon")).alias("x"), S.mercator_y(F.col("lat")).alias("y"))
    c = S.supercell_of(F.col("x"), F.col("y"), 12, 4)
    b = S.supercell_bounds(c["sc_x"], c["sc_y"], 12, 4)
    inside = F.col("x").between(b["left"], b["right"]) & F.col("y").between(b["bottom"], b["top"])
    return p.select("rid", c["sc_x"].alias("sc_x"), c["sc_y"].alias("sc_y"), F.round(S.longitude(F.col("x")), 6).alias("lon"), F.round(S.latitude(F.col("y")), 6).alias("lat"), inside.alias("inside"))


@query
def point_windows(spark: SparkSession, d: str) -> DataFrame:
    """T12 S16"""
    k = F.col("p_partkey")
    lon, lat, w = k * 0.001 - 70, k * 0.0005 - 33, F.col("p_size") * 0.0001
    b = S.expanded_bounds(lon, lat, lon + w, lat + w, lon + w / 2, lat + w / 2)
    return views.table(spark, d, "part").select(k.alias("p_partkey"), b.alias("b"), lon.alias("lon"), lat.alias("lat"), w.alias("w")).select("p_partkey", replay.click(F.col("lon") + F.col("w") / 4, F.col("lat") + F.col("w") / 4, F.col("b")).alias("c")).select("p_partkey", F.round("c.x", 2).alias("x"), F.round("c.y", 2).alias("y"))


@query
def valid_coordinates(spark: SparkSession, d: str) -> DataFrame:
    """Text that may be no number"""
    k = F.col("c_custkey")
    lat = F.when(k % 5 == 0, "n/a").otherwise((k % 200 - 100).cast("string"))
    return views.table(spark, d, "customer").select("c_custkey", S.valid_coordinate(lat, (k % 400 - 200).cast("string")).alias("valid"))


@query
def catalog_rows(spark: SparkSession, d: str) -> DataFrame:
    """With the synthetic commune"""
    return catalog.with_added(views.communes(spark, d))


@query
def catalog_seed(spark: SparkSession, d: str) -> DataFrame:
    """J13 O07"""
    existing = views.communes(spark, d).where("cast(code as int) % 3 = 0").select(F.lit("2026S2").alias("periodo"), F.col("code").alias("codigo_comuna"), F.col("name").alias("comuna"), "region", F.lit("completa").alias("status"))
    return catalog.seed(existing, catalog.with_added(views.communes(spark, d)), "2026S2").orderBy(*catalog.KEY)


@query
def catalog_upsert(spark: SparkSession, d: str) -> DataFrame:
    """J14"""
    changed = views.table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n")).select(F.lit("2026S2").alias("periodo"), F.col("s_nationkey").cast("string").alias("codigo_comuna"), F.lit("completa_con_observaciones").alias("status"), "n")
    return catalog.upsert(catalog_seed(spark, d).select("periodo", "codigo_comuna", "status"), changed)


@query
def region_assets(spark: SparkSession, d: str) -> DataFrame:
    """S10 J15"""
    assets = views.table(spark, d, "region").select(F.initcap(F.lower("r_name")).alias("region"), F.concat(F.lit("asset_"), F.col("r_regionkey").cast("string"), F.lit(".parquet")).alias("file"))
    return catalog.region_assets(views.communes(spark, d), assets).select("region_key", "n_communes", F.array_join("codes", ",").alias("codes"), "file")


@query
def commune_lookup(spark: SparkSession, d: str) -> DataFrame:
    """One commune by name, then its region"""
    one = catalog.find(views.communes(spark, d), " nation_7 ")
    return catalog.in_region(views.communes(spark, d), " asia").join(one.select(F.col("region")), "region").select("code", "name", "region")


@query
def axis_windows(spark: SparkSession, d: str) -> DataFrame:
    """W01"""
    return grid.axis_windows(views.cells(spark, d), "sc_x", 4, 3, 4, ("code",)).select("code", "window", "first", "last")


@query
def blocks(spark: SparkSession, d: str) -> DataFrame:
    """J02 W05"""
    return grid.blocks(views.cells(spark, d), 4, 1, 4)


@query
def grid_cover(spark: SparkSession, d: str) -> DataFrame:
    """The cells near boxes; zoom 8 keeps the numbers small"""
    n, k = views.table(spark, d, "nation"), F.col("n_nationkey")
    x, y, w = k * F.lit(400000.0) - 5000000, k * F.lit(300000.0) - 4000000, F.lit(250000.0) + k * F.lit(10000.0)
    b = n.select(k.cast("string").alias("code"), views.box(x, y, x + w, y + w / 2).alias("rings"))
    return grid.grid_cover(b, 8, 1, 40000.0).orderBy("code", "sc_y", "sc_x")


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_roles(views.roles(spark, d), views.polygons(spark, d))


@query
def match_pip(spark: SparkSession, d: str) -> DataFrame:
    """The smallest containing polygon"""
    near = matching.near_polygons(views.roles(spark, d).where("valid").select("rid", "x", "y"), views.polygons(spark, d), 0.0)
    return near.where("inside").groupBy("rid").agg(F.min("_poly_idx").alias("_poly_idx"))


@query
def match_nearest(spark: SparkSession, d: str) -> DataFrame:
    """J07"""
    near = matching.near_polygons(views.roles(spark, d).where("valid").select("rid", "x", "y"), views.polygons(spark, d), 10.0)
    return near.groupBy("rid").agg(F.min(F.struct("dist", "_poly_idx")).alias("n")).select("rid", F.col("n._poly_idx").alias("_poly_idx"), F.round("n.dist", 2).alias("dist"))


@query
def match_cascade(spark: SparkSession, d: str) -> DataFrame:
    """J06-J10 P08 P13 P14 P15 W02"""
    return _matched(spark, d).select("rid", "_poly_idx", "_match_method", "_match_dist_m", "pol_area_m2", "pol_size_class", "calidad_geom")


@query
def match_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A08"""
    return matching.match_metrics(_matched(spark, d))


def _output(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    matched = stage(_matched(spark, d), "matched")
    polygons = views.polygons(spark, d).withColumn("geometry_key", F.substring(F.sha2(F.col("_poly_idx").cast("string").cast("binary"), 256), 1, 24)).drop("rings")
    rest = orphans.recover(orphans.orphans(polygons, matched), views.responses(spark, d))
    return orphans.final_output(matched, rest), matched


@query
def orphan_polygons(spark: SparkSession, d: str) -> DataFrame:
    """J11 U03"""
    return orphans.orphans(views.polygons(spark, d), _matched(spark, d)).select("_poly_idx")


@query
def output_union(spark: SparkSession, d: str) -> DataFrame:
    """J12 P11 P16 U01"""
    return _output(spark, d)[0].select("rid", "rol", "_poly_idx", "_match_method", "_match_dist_m", "_status", "calidad_geom")


@query
def final_summary(spark: SparkSession, d: str) -> DataFrame:
    """A09"""
    return summary.final_summary(_output(spark, d)[0])


@query
def vectorization(spark: SparkSession, d: str) -> DataFrame:
    """Over all polygons and the blocks of the mask"""
    merged = views.polygons(spark, d).select("pol_size_class", geometry.valid(F.col("rings")).alias("geometry_valid"))
    return summary.vectorization_metrics(merged, runs.image_metrics(views.mask(spark, d)))


@query
def block_identities(spark: SparkSession, d: str) -> DataFrame:
    """Identities of blocks from the hashes of their tiles"""
    li = views.table(spark, d, "lineitem")
    tiles = li.select(F.col("l_orderkey").alias("block_id"), F.col("l_linenumber").alias("sc_x"), F.col("l_suppkey").alias("sc_y"), F.sha2(F.col("l_partkey").cast("string").cast("binary"), 256).alias("sha"))
    return stage_identities(tiles)


@query
def inconsistent_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose number of suppliers differs from what their first lines say"""
    li = views.table(spark, d, "lineitem")
    shapes = li.select(F.col("l_orderkey").alias("block_id"), F.col("l_suppkey").alias("polygon_id"))
    metrics = li.groupBy(F.col("l_orderkey").alias("block_id")).agg(F.count("*").alias("polygons"))
    return consistent(shapes, metrics)


@query
def error_texts(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts cut to what a record keeps of an error"""
    return views.table(spark, d, "documents").select("doc_id", F.md5(S.error_text(F.col("text"))).alias("error_md5"))


@query
def rounded(spark: SparkSession, d: str) -> DataFrame:
    """Eighths to one and two places, where many are ties"""
    eighths = F.col("l_partkey") * 7 + F.col("l_linenumber")
    return views.table(spark, d, "lineitem").select(eighths.alias("eighths"), *[S.round_half_even(eighths / 8, n).alias(f"p{n}") for n in (1, 2)])


def _files(spark: SparkSession) -> str:
    """A folder for files that a query writes and reads back."""
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


@query
def historic_parquet(spark: SparkSession, d: str) -> DataFrame:
    """The historic extract written with its checks; one commune's keys, the commune pushed to the scan"""
    path = _files(spark)
    write_parquet(views.historic(spark, d), path)
    return records.role_keys(tables.historic_parquet(spark, path, 3), 3)


@query
def historic_csv(spark: SparkSession, d: str) -> DataFrame:
    """The same from the newest of several text files"""
    folder = _files(spark)
    h = views.historic(spark, d).select(F.concat(F.lpad(F.col("comuna").cast("string"), 4, "0"), F.lit(".0")).alias("comuna"), F.lit("x").alias("other"), "manzana", "predio")
    h.limit(0).write.option("header", True).csv(f"{folder}/historic_1")
    h.write.option("header", True).csv(f"{folder}/historic_2")
    return records.role_keys_csv(tables.historic_csv(spark, tables.newest(spark, folder, "historic_*")), 3)


@query
def communes_json(spark: SparkSession, d: str) -> DataFrame:
    """The communes from a JSON array"""
    path = f"{_files(spark)}.json"
    rows = views.communes(spark, d).collect()  # the nations
    write_json(spark, [{"id": r["code"], "nombre": r["name"], "region": r["region"]} for r in rows], path)
    return tables.communes_json(spark, path)


@query
def boundary(spark: SparkSession, d: str) -> DataFrame:
    """Bounds of the parts of one commune, found by name in a collection of features"""
    path = f"{_files(spark)}.json"
    square = lambda k, n: [[[k + n, k], [k + n + 2, k], [k + n + 2, k + 1], [k + n, k]]]
    features = [{"type": "Feature", "properties": {"Comuna": r["n_name"].title()}, "geometry": {"type": "MultiPolygon", "coordinates": [square(r["n_nationkey"], n) for n in range(3)]}} for r in views.table(spark, d, "nation").collect()]
    write_json(spark, {"type": "FeatureCollection", "features": features}, path)
    parts = tables.boundary_geojson(spark, path, "nation_11").select("name", F.explode("parts").alias("rings"))
    return parts.select("name", geometry.bounds(F.col("rings")).alias("b")).select("name", "b.minx", "b.miny", "b.maxx", "b.maxy")


@query
def asset_entries(spark: SparkSession, d: str) -> DataFrame:
    """A manifest's assets, one row each, with their distinct sources and hosts"""
    path = f"{_files(spark)}.json"
    assets = [{"region": r["r_name"], "file": f"a{r['r_regionkey']}.parquet", "bytes": r["r_regionkey"] * 10, "rows": 5, "sha256": "0", "urls": [f"http://h{r['r_regionkey']}.cl/x", "http://b.cl/x", f"http://h{r['r_regionkey']}.cl/x"]} for r in views.table(spark, d, "region").collect()]
    write_json(spark, {"columns": ["comuna"], "assets": assets}, path)
    m = tables.asset_manifest(spark, path)
    return m.select("region", "file", "bytes", F.array_join(F.transform(replay.fallback_urls(F.col("urls")), lambda u: u["host"]), ",").alias("hosts"))


@query
def stored_lines(spark: SparkSession, d: str) -> DataFrame:
    """The raw lines as compressed text files, read back"""
    path = _files(spark)
    write_lines(raw_lines(spark, d), path, gzip=True)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def stored_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue file with its fixed columns, read back"""
    path = f"{_files(spark)}.csv"
    write_catalog(catalog_upsert(spark, d).withColumnRenamed("n", "filas_salida"), path)
    return read_catalog(spark, path).select("periodo", "codigo_comuna", "status", "filas_salida", "poligonos")


@query
def replayed(spark: SparkSession, d: str) -> DataFrame:
    """The last stored attempt of each key, from JSON lines"""
    path = _files(spark)
    views.events(spark, d).select("query_key", F.length("event_type").alias("status_code"), F.col("response").alias("body"), F.col("seq").cast("int").alias("attempts")).write.json(path)
    return replay.responses(spark, path)


@query
def role_requests(spark: SparkSession, d: str) -> DataFrame:
    """What is asked for each role"""
    h = views.historic(spark, d).withColumn("manzana", F.regexp_replace("manzana", r"\.0$", "")).distinct()
    return h.select("comuna", "manzana", "predio", replay.role_request(F.col("comuna").cast("string"), F.col("manzana"), F.col("predio"), F.lit("layer")).alias("request"))


@query
def contexts(spark: SparkSession, d: str) -> DataFrame:
    """The first layer of each commune's context, the default where it has none"""
    n = views.table(spark, d, "nation")
    layer = F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("layer_"), F.col("n_regionkey").cast("string")))
    rows = n.select(F.col("n_nationkey").cast("string").alias("commune"), F.array(F.struct(layer.alias("layer")), F.struct(F.lit("other").alias("layer"))).alias("context"))
    return replay.context(rows, "default").select("commune", F.col("context.layer").alias("layer"))


@query
def observations(spark: SparkSession, d: str) -> DataFrame:
    """With the shapes that are invalid and the periods that are not expected"""
    checked = views.polygons(spark, d).select(F.col("_poly_idx").alias("_valid_idx"), geometry.valid(F.col("rings")).alias("geometry_valid"))
    output = _output(spark, d)[0]
    output = output.join(checked.hint("merge"), output["_poly_idx"] == checked["_valid_idx"], "left").drop("_valid_idx")
    return summary.observations(output, records.upsert(views.events(spark, d)), periods=observed_periods(spark, d))


@query
def fill_mask(spark: SparkSession, d: str) -> DataFrame:
    """P04 A02"""
    return runs.image_metrics(runs.fill_mask(views.pixels(spark, d), Settings()), "image")


@query
def fill_mode(spark: SparkSession, d: str) -> DataFrame:
    """A01 P05 O04"""
    return runs.dominant_color(views.pixels(spark, d), Settings(), ["image"])


@query
def mask_runs(spark: SparkSession, d: str) -> DataFrame:
    """Masks as runs"""
    return runs.to_runs(views.mask(spark, d))


def _shapes(spark: SparkSession, d: str) -> DataFrame:
    return stage(runs.components(runs.to_runs(views.mask(spark, d))), "shapes")


@query
def components(spark: SparkSession, d: str) -> DataFrame:
    """Shapes of each block and their size"""
    return _shapes(spark, d).groupBy("block_id", "polygon_id").agg(F.count("*").alias("n_runs"), F.sum(F.col("x1") - F.col("x0")).alias("pixels"))


@query
def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    """J03"""
    return runs.overlaps(runs.drop_small(_shapes(spark, d), LATTICE), 1)


@query
def union_area(spark: SparkSession, d: str) -> DataFrame:
    """Merged shapes with area and class"""
    merged = runs.merge_shapes(runs.drop_small(_shapes(spark, d), LATTICE), LATTICE)
    size = merged.groupBy("root_id", "part").agg(F.sum(F.col("x1") - F.col("x0")).alias("pixels"))
    return size.select("root_id", "part", "pixels", runs.size_class(F.col("pixels"), LATTICE).alias("pol_size_class"))


@query
def holes(spark: SparkSession, d: str) -> DataFrame:
    """Pixels by shape once small holes are filled"""
    filled = runs.fill_small_holes(_shapes(spark, d), LATTICE)
    return filled.groupBy("polygon_id").agg(F.sum(F.col("x1") - F.col("x0")).alias("pixels"))


@query
def geometry_keys(spark: SparkSession, d: str) -> DataFrame:
    """A17 T17"""
    return runs.geometry_key(_shapes(spark, d), ["polygon_id"])


@query
def representative_points(spark: SparkSession, d: str) -> DataFrame:
    """T13"""
    return runs.representative_point(_shapes(spark, d), "polygon_id")


@query
def block_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A18 A16"""
    return runs.block_metrics(views.mask(spark, d), _shapes(spark, d))


@query
def traced(spark: SparkSession, d: str) -> DataFrame:
    """Rings of shapes; their area is the pixels'"""
    rings = trace.to_rings(_shapes(spark, d), ["polygon_id"])
    return rings.select("polygon_id", geometry.area(F.col("rings")).alias("area"), geometry.bounds(F.col("rings")).alias("b")).select("polygon_id", "area", "b.minx", "b.miny", "b.maxx", "b.maxy")


@query
def role_rows(spark: SparkSession, d: str) -> DataFrame:
    """S19"""
    state = records.upsert(views.events(spark, d).withColumns({"source": F.lit("role"), "manzana": F.lit("010"), "predio": F.lpad(F.col("event_type"), 12, "0"), "attempts": F.lit(1), "error": F.lit(None).cast("string")}))
    return records.wide(records.role_rows(state, "7"), ["api_k"]).select("comuna", "manzana", "predio", "rol", "_ok", "_status", "api_k")


@query
def region_positions(spark: SparkSession, d: str) -> DataFrame:
    """P03 J16"""
    chosen = catalog.chosen(views.communes(spark, d), ["3", "nation_8", "NATION_13", "x"])
    return catalog.by_position(chosen, "europe", [1, 3]).select("code", "name", "position")


@query
def request_identities(spark: SparkSession, d: str) -> DataFrame:
    """T23 R08"""
    c = views.cells(spark, d)
    return c.select("code", "sc_x", "sc_y", S.request_identity(F.col("code"), F.lit("layer"), "2026S2", 19, 4, F.col("sc_x"), F.col("sc_y")).alias("identity"))


@query
def changed_block_ids(spark: SparkSession, d: str) -> DataFrame:
    """Blocks whose identity differs from the stored one"""
    o = views.table(spark, d, "orders")
    stored = o.where("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("block_id"), S.short_hash(F.col("o_orderstatus")).alias("identity"))
    now = o.select(F.col("o_orderkey").alias("block_id"), S.short_hash(F.when(F.col("o_orderkey") % 7 == 0, "changed").otherwise(F.col("o_orderstatus"))).alias("identity"))
    return changed_blocks(stored, now)


@query
def paging(spark: SparkSession, d: str) -> DataFrame:
    """A page is the feature"""
    return records.page(views.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100, 500)


@query
def status_windows(spark: SparkSession, d: str) -> DataFrame:
    """R01 by event time"""
    w = status_by_window(views.events(spark, d), "1 day")
    return w.select(F.col("start").cast("string").alias("start"), "status", "n")


@query
def point_results(spark: SparkSession, d: str) -> DataFrame:
    """S16 P11"""
    k = F.col("p_partkey")
    data = F.when(k % 5 == 0, '{"existePredio": -1, "manzana": 4}').when(k % 5 == 1, '{"existePredio": 1, "manzana": 0}').when(k % 5 == 2, '{"existePredio": 1, "manzana": 7}').when(k % 5 == 3, '{"manzana": 7}')
    r = views.table(spark, d, "part").select(k.alias("p_partkey"), replay.point_result(data, F.when(k % 10 == 4, "timeout")).alias("r"))
    return r.select("p_partkey", F.col("r.data").alias("data"), orphans.point_status(F.col("r.data").isNotNull(), F.col("r.error")).alias("status"))


@query
def raw_lines(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as JSON lines (rows only: key order is the writer's)"""
    c = views.table(spark, d, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("query_key"), F.col("role").alias("source"), F.to_json(F.struct("text")).alias("response"), F.lit(None).cast("string").alias("error"))
    return raw_export(c)
