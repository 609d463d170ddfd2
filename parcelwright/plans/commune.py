"""A commune from captured tiles and answers to its published output: the engine's operators in a row.

Every step is a stage by content identity, so a run that was cut short goes on where it stopped, and a changed tile,
answer or setting makes again only what follows from it.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.functions import geometry as G
from parcelwright.functions import scalars as S
from parcelwright.operators import matching, orphans, records, runs, summary, trace
from parcelwright.plans.publication import Layout, start_manifest, update_manifest
from parcelwright.plans.stages import Run, block_identities, consistent
from parcelwright.settings import Settings
from parcelwright.sinks import files
from parcelwright.sources import tiles as tile_source


def vectorize(run: Run, tiles: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """``masks, shapes, polygons, metrics``: tiles (block_id, sc_x, sc_y, x, y, width, height, channels, data) to
    merged polygons with rings on the lattice, area and class; each a stage.

    The identity of the first stage holds that of every block, made from its tiles' hashes, so a changed tile is seen.
    """
    hashed = tiles.select("block_id", "sc_x", "sc_y", F.sha2("data", 256).alias("sha"))
    found = block_identities(hashed).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "block_id", "identity"))), ";").cast("binary"), 256)).first()[0]
    masks = run.stage("masks", lambda: tile_source.tile_runs(tiles, settings), inputs=found)
    shapes = run.stage("shapes", lambda: runs.fill_small_holes(runs.drop_small(runs.components(masks), settings), settings), after=("masks",))
    pixels = tiles.groupBy("block_id").agg(F.sum(F.col("width") * F.col("height")).alias("pixels"))
    filled = masks.groupBy("block_id").agg(F.sum(F.col("x1") - F.col("x0")).alias("fill_pixels"))
    n = shapes.groupBy("block_id").agg(F.count_distinct("polygon_id").alias("polygons"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    metrics = run.stage("block-metrics", lambda: pixels.join(filled, "block_id", "left").join(n, "block_id", "left").select("block_id", "pixels", zero("fill_pixels"), zero("polygons")), inputs=found, after=("shapes",))
    if wrong := [r[0] for r in consistent(shapes, metrics).limit(5).collect()]:
        raise RuntimeError(f"blocks whose shapes differ from their metrics: {wrong}")
    merged = run.stage("merged", lambda: runs.merge_shapes(shapes, settings), after=("shapes",))

    def polygons() -> DataFrame:
        keyed = runs.geometry_key(merged, ["root_id", "part"])
        rings = trace.to_rings(merged, ["root_id", "part"])
        size = merged.groupBy("root_id", "part").agg(F.sum(F.col("x1") - F.col("x0")).alias("pixels"))
        out = rings.join(size, ["root_id", "part"]).join(keyed, ["root_id", "part"]).withColumn("pol_area_m2", F.col("pixels") * settings.pixel_m**2)
        ids = (F.col("root_id").cast("decimal(20,0)") * 4096 + F.col("part")).alias("_poly_idx")
        return out.select(ids, "rings", "pol_area_m2", runs.size_class(F.col("pol_area_m2"), settings).alias("pol_size_class"), "geometry_key", G.valid(F.col("rings")).alias("geometry_valid"))

    return {"masks": masks, "shapes": shapes, "metrics": metrics, "polygons": run.stage("polygons", polygons, after=("merged",))}


def roles_of(state: DataFrame, commune: str, settings: Settings) -> DataFrame:
    """The commune's roles as matching wants them: normalised answers with their point on the lattice."""
    rows = records.role_rows(state, commune).withColumn("rid", F.xxhash64("rol", "manzana", "predio", "_api_queried_at"))
    lat, lon = F.col("lat").try_cast("double"), F.col("lon").try_cast("double")
    pixel = F.lit(settings.pixel_m)
    x, y = (S.mercator_x(lon) + S.HALF_WORLD) / pixel, (F.lit(S.HALF_WORLD) - S.mercator_y(lat)) / pixel
    return rows.select("rid", "manzana", "predio", "rol", lat.alias("lat"), lon.alias("lon"), x.alias("x"), y.alias("y"), S.valid_coordinate(F.col("lat"), F.col("lon")).alias("valid"), F.col("direccion_sii").alias("address"), "_status", "periodo")


def process(spark: SparkSession, settings: Settings, layout: Layout, name: str, region: str, tiles: DataFrame, state: DataFrame, responses: DataFrame) -> dict[str, Any]:
    """From tiles, the state of role answers and the stored answers at polygons to output, metrics, raw lines and manifest.

    Distances on the lattice are in pixels, so the limit of the nearest polygon is too. Returns the manifest.
    """
    manifest = update_manifest(spark, layout.manifest, files.read_json(spark, layout.manifest) or start_manifest(settings, layout.code, name, region), status="procesando")
    run = Run(spark, layout.stages, {f: getattr(settings, f) for f in ("zoom", "supercell_tiles", "fill_color", "fill_tolerance", "min_fill_alpha", "urban_min_area_m2", "urban_max_area_m2", "min_hole_area_m2", "min_overlap_m2")})
    made = vectorize(run, tiles, settings)
    roles = roles_of(state, layout.code, settings)
    matched = matching.match_roles(roles, made["polygons"].drop("geometry_key", "geometry_valid"), settings.max_match_distance_m / settings.pixel_m)
    rest = orphans.recover(orphans.orphans(made["polygons"].drop("rings", "geometry_valid"), matched), responses)
    united = orphans.final_output(matched, rest)
    # a polygon's ring once a row, in degrees, as WKB
    shapes = made["polygons"].select("_poly_idx", "geometry_valid", F.unhex(G.wkb(trace.to_lonlat(F.col("rings"), settings.pixel_m))).alias("geometry"))
    output = united.join(shapes, "_poly_idx", "left").withColumn("_poly_idx", F.col("_poly_idx").cast("string"))
    rows = files.write_parquet(output, f"{layout.stages}/output")
    final = spark.read.parquet(f"{layout.stages}/output")
    files.write_geoparquet(final, layout.output)
    log = state.withColumn("source", F.coalesce("source", F.lit("role")))
    lines = [r[0] for r in files.raw_export(log.where(F.col("commune") == layout.code)).collect()]  # one file of a commune's answers
    files.write_text(spark, "".join(f"{x}\n" for x in lines), layout.raw_lines)
    expected = S.expected_period(F.lit(settings.periodo_geometria))
    observed = summary.observations(final, state.where((F.col("source") == "role") & (F.col("commune") == layout.code)), periods=summary.observed_periods(final, expected)).first().asDict()
    vectors = summary.vectorization_metrics(made["polygons"], made["metrics"]).first().asDict()
    metrics = {"match": matching.match_metrics(final.where("rid is not null")).first().asDict(), "final_result": summary.final_summary(final).first().asDict(), "observations": observed, "vectorization": vectors, "output_rows": rows, "captured_at": manifest["updated_at"]}
    files.write_json(spark, metrics, layout.metrics)
    return update_manifest(spark, layout.manifest, manifest, status=observed["status"], vectorization=vectors, output=layout.output, metrics=layout.metrics, historical_role_candidates=roles.count(), stages=run.ran)
