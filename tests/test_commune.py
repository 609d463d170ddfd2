"""A commune from tiles to its published package, and the resolver of regional assets."""

import csv
import gzip
import hashlib
import json
import zipfile

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelwright.functions import geometry as G
from parcelwright.functions import scalars as S
from parcelwright.operators import catalog, summary
from parcelwright.plans import commune, publication
from parcelwright.plans.stages import block_identities, consistent
from parcelwright.settings import Settings, load_settings, resolve_historic, save_local
from parcelwright.sinks import files
from parcelwright.sources import assets, tables
from parcelwright.sources import tiles as tile_source

SETTINGS = Settings(zoom=19, urban_min_area_m2=0.5)
STATE = "query_key string, source string, commune string, manzana string, predio string, status string, attempts int, queried_at timestamp, response string, error string, seq long"
ORIGIN = (40_000_000, 80_000_000)  # the lattice position of the first tile


def tile(boxes):
    """A 64 by 64 BGRA tile with filled boxes (x0, y0, x1, y1)."""
    image = np.zeros((64, 64, 4), np.uint8)
    for x0, y0, x1, y1 in boxes:
        image[y0:y1, x0:x1] = (232, 221, 182, 179)
    return bytearray(image.tobytes())


def tiles_of(spark, second=((5, 5, 25, 25),)):
    """Two blocks that overlap by 16 columns; the box at their seam is seen by both."""
    x, y = ORIGIN
    rows = [(0, 0, 0, x, y, 64, 64, 4, tile([(5, 5, 25, 25), (50, 30, 64, 50)])), (1, 1, 0, x + 48, y, 64, 64, 4, tile([(2, 30, 26, 50), *((a + 25, b, c + 25, d) for a, b, c, d in second)]))]
    return spark.createDataFrame(rows, "block_id long, sc_x int, sc_y int, x int, y int, width int, height int, channels int, data binary")


def lonlat(px, py):
    """Degrees of a lattice position."""
    import math

    x, y = px * SETTINGS.pixel_m - S.HALF_WORLD, S.HALF_WORLD - py * SETTINGS.pixel_m
    return math.degrees(x / S.EARTH_RADIUS), math.degrees(2 * math.atan(math.exp(y / S.EARTH_RADIUS)) - math.pi / 2)


def state_of(spark):
    def answer(lot, px, py):
        lon, lat = lonlat(ORIGIN[0] + px, ORIGIN[1] + py)
        return json.dumps({"existePredio": 1, "manzana": "1", "predio": lot, "ubicacionX": lat, "ubicacionY": lon, "direccion": f"CALLE {lot}", "periodo": "SEGUNDO SEMESTRE DE 2026" if lot < 3 else "PRIMER SEMESTRE DE 2026"})

    rows = [("1-1", "1", "1", "ok", answer(1, 15, 15)), ("1-2", "1", "2", "ok", answer(2, 60, 40)), ("1-3", "1", "3", "ok", answer(3, 40, 10)), ("1-4", "1", "4", "not_found", None), ("1-5", "1", "5", "error", None)]
    df = spark.createDataFrame(rows, "query_key string, manzana string, predio string, status string, response string")
    return df.selectExpr("query_key", "'role' source", "'14504' commune", "manzana", "predio", "status", "1 attempts", "timestamp_seconds(1000) queried_at", "response", "cast(null as string) error", "monotonically_increasing_id() seq")


def layout_of(tmp_path):
    return publication.Layout.of(str(tmp_path / "raw"), str(tmp_path / "done"), "2026S2", "14504", "Ñuñoa d'Oro")


RESPONSES = "geometry_key string, status string, attempts int, queried_at string, manzana string, predio string, rol string"


def test_process_and_publish(spark, tmp_path):
    layout = layout_of(tmp_path)
    assert layout.stem == "14504_nunoa_doro"
    communes = spark.createDataFrame([("14504", "Ñuñoa d'Oro", "Metropolitana"), ("1", "Arica", "Arica")], "code string, name string, region string")
    state = state_of(spark)
    run = lambda tiles: commune.process(spark, SETTINGS, layout, "Ñuñoa d'Oro", "Metropolitana", tiles, state, spark.createDataFrame([], RESPONSES))
    manifest = run(tiles_of(spark))
    assert manifest["status"] == "completa_con_observaciones" and manifest["vectorization"]["polygons"] == 3 == manifest["vectorization"]["valid_polygons"]
    assert manifest["stages"] == ["masks", "shapes", "block-metrics", "merged", "polygons"]
    out = spark.read.parquet(layout.output)
    by_role = {r["rol"]: r for r in out.where("rol is not null").collect()}
    assert by_role["1-1"]["_match_method"] == "point_in_polygon" == by_role["1-2"]["_match_method"] and by_role["1-1"]["_poly_idx"] != by_role["1-2"]["_poly_idx"]
    assert by_role["1-3"]["_poly_idx"] is None or by_role["1-3"]["_match_method"] == "nearest_10m"
    assert out.where("_match_method = 'unmatched_polygon'").count() >= 1
    assert b"geo" in pq.ParquetFile(layout.output).schema_arrow.metadata
    metrics = files.read_json(spark, layout.metrics)
    assert metrics["observations"]["unexpected_api_periods"] == 1 and metrics["observations"]["invalid_geometries"] == 0 and metrics["output_rows"] == out.count()
    seam = out.where("rol = '1-2'").first()
    assert abs(seam["pol_area_m2"] - 24 * 20 * SETTINGS.pixel_m**2) < 1e-6  # the box at the seam, once: 50..74
    assert run(tiles_of(spark))["stages"] == []  # nothing is made again
    assert run(tiles_of(spark, second=((5, 5, 15, 25),)))["stages"] == ["masks", "shapes", "block-metrics", "merged", "polygons"]

    with pytest.raises(FileNotFoundError):
        publication.publish_commune(spark, layout, str(tmp_path / "store"), communes)
    state.write.parquet(f"{layout.log}/batch=0")
    (tmp_path / "raw/2026S2/14504_nunoa_doro/tiles").mkdir()
    for name in ("b.png", "a.png", "a.json"):
        (tmp_path / "raw/2026S2/14504_nunoa_doro/tiles" / name).write_bytes(name.encode() * 100)
    store = str(tmp_path / "store")
    first = publication.publish_commune(spark, layout, store, communes)
    recorded = files.read_json(spark, layout.manifest)["storage_backup"]
    assert recorded["status"] == "completo" and recorded["geoparquet_sha256"] == hashlib.sha256((tmp_path / "done/2026S2/14504_nunoa_doro.parquet").read_bytes()).hexdigest()
    lines = gzip.decompress((tmp_path / "store/2026S2/respuestas_api/14504_nunoa_doro.jsonl.gz").read_bytes()).decode().splitlines()
    assert len(lines) == 5 and json.loads(lines[0])["query_key"] == "1-1"
    with zipfile.ZipFile(tmp_path / "store/2026S2/wms_archivados/14504_nunoa_doro_tiles.zip") as z:
        assert z.namelist() == ["a.png", "b.png"] and z.read("a.png") == b"a.png" * 100 and z.infolist()[0].compress_type == zipfile.ZIP_STORED
    rows = list(csv.DictReader((tmp_path / "store/catalogo/estado_geometrias.csv").open(encoding="utf-8-sig", newline="")))
    assert [(r["codigo_comuna"], r["status"], r["roles_ok"]) for r in rows] == [("1", "pendiente", ""), ("14504", "completa_con_observaciones", "3"), ("8108", "pendiente", "")] and len(rows[0]) == 23
    at = files.read_json(spark, layout.manifest)["updated_at"]
    assert publication.publish_commune(spark, layout, store, communes) == first and files.read_json(spark, layout.manifest)["updated_at"] == at
    assert files.read_catalog(spark, first["catalog"]).count() == 3
    saved = publication.force(spark, layout, "t1")
    assert "log" in saved and not files.exists(spark, layout.log) and not files.exists(spark, layout.stages) and files.exists(spark, layout.tiles) and files.exists(spark, f"{layout.raw}/backups/t1/log")


def test_unfinished_communes_are_not_published(spark, tmp_path):
    layout = layout_of(tmp_path)
    manifest = publication.start_manifest(SETTINGS, "14504", "Ñuñoa", "Metropolitana")
    assert manifest["status"] == "iniciando" and manifest["started_at"] == manifest["updated_at"]
    changed = publication.update_manifest(spark, layout.manifest, manifest, status="parcial_control")
    assert files.read_json(spark, layout.manifest) == changed and files.read_json(spark, str(tmp_path / "none")) == {}
    with pytest.raises(ValueError):
        publication.publish_commune(spark, layout, str(tmp_path / "store"), None)


def test_replace_keeps_the_old_file(spark, tmp_path):
    target = str(tmp_path / "t")
    files.write_text(spark, "one", target)
    with pytest.raises(OSError):
        files.replace(spark, str(tmp_path / "absent"), target)
    assert (tmp_path / "t").read_text() == "one" and not (tmp_path / "t.old").exists()
    (tmp_path / "t").rename(tmp_path / "t.old")  # a crash in between
    with pytest.raises(OSError):
        files.replace(spark, str(tmp_path / "absent"), target)
    assert (tmp_path / "t").read_text() == "one"


def test_stale_locks(spark, tmp_path):
    import os
    import time

    target = str(tmp_path / "t")
    lock = files.Lock(spark, target, stale_s=60)
    lock.__enter__()
    with pytest.raises(BlockingIOError), files.Lock(spark, target, stale_s=60):
        pass
    os.utime(tmp_path / "t.lock", (time.time() - 120,) * 2)
    with files.Lock(spark, target, stale_s=60) as second:
        second.refresh()
        with pytest.raises(BlockingIOError), files.Lock(spark, target, stale_s=60):
            pass
    assert not (tmp_path / "t.lock").exists()


def asset_of(spark, tmp_path, region="Metropolitana", name="rm.parquet"):
    spark.createDataFrame([(14504, 1, 2), (14504, 3, 4)], "comuna int, manzana int, predio int").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "made"))
    good = next((tmp_path / "made").glob("part-*")).read_bytes()
    (tmp_path / "captured").mkdir(exist_ok=True)
    (tmp_path / "captured/good").write_bytes(good)
    (tmp_path / "captured/bad").write_bytes(b"x" * len(good))
    (tmp_path / "captured/short").write_bytes(b"x")
    return assets.Asset(region, name, len(good), 2, hashlib.sha256(good).hexdigest(), ("http://a.cl/short", "http://b.cl/bad", " http://a.cl/short ", "http://c.cl/gone", "http://d.cl/good"))


def test_assets_come_from_the_first_good_source(spark, tmp_path):
    asset = asset_of(spark, tmp_path)
    asked = []
    take = assets.captured(spark, str(tmp_path / "captured"))

    def fetch(url, path):
        asked.append(url)
        take(url, path)

    target = str(tmp_path / "store/rm.parquet")
    assert assets.fetch_asset(spark, asset, target, fetch) == "http://d.cl/good"
    assert asked == ["http://a.cl/short", "http://b.cl/bad", "http://c.cl/gone", "http://d.cl/good"] and [p.name for p in (tmp_path / "store").iterdir() if not p.name.startswith(".")] == ["rm.parquet"]
    with pytest.raises(RuntimeError, match="a.cl.*b.cl"):
        assets.fetch_asset(spark, assets.Asset("r", "f", asset.bytes, 2, asset.sha256, asset.urls[:2]), str(tmp_path / "other"), fetch)
    with pytest.raises(ValueError):
        assets.distinct_urls([" "])


def test_regions_are_resolved(spark, tmp_path):
    asset = asset_of(spark, tmp_path)
    entry = {"region": "METROPOLITANA", "file": asset.file, "bytes": asset.bytes, "rows": 2, "sha256": asset.sha256, "urls": list(asset.urls)}
    (tmp_path / "m.json").write_text(json.dumps({"columns": ["comuna", "manzana", "predio"], "assets": [entry]}))
    manifest = tables.asset_manifest(spark, str(tmp_path / "m.json"))
    wanted = spark.createDataFrame([("14504", "Ñuñoa", "Metropolitana")], "code string, name string, region string")
    calls = []
    take = assets.captured(spark, str(tmp_path / "captured"))
    fetch = lambda url, path: (calls.append(url), take(url, path))
    resolve = lambda communes: assets.resolve_regions(spark, communes, manifest, str(tmp_path / "in"), fetch)
    assert list(resolve(wanted)) == ["METROPOLITANA"] and calls
    calls.clear()
    assert resolve(wanted)["METROPOLITANA"].endswith("rm.parquet") and not calls
    (tmp_path / "in/rm.parquet").write_bytes(b"spoilt")
    assert resolve(wanted) and calls  # fetched once more
    with pytest.raises(ValueError):
        resolve(spark.createDataFrame([("7", "Elsewhere", "Metropolitana")], wanted.schema))
    assert not (tmp_path / "in/rm.parquet").exists()  # it lacks the commune
    with pytest.raises(Exception, match="no historic asset"):
        resolve(spark.createDataFrame([("1", "Arica", "Arica")], wanted.schema))
    with pytest.raises(ValueError):
        catalog.in_region(wanted, "nowhere")


def test_local_settings_and_historic_extract(tmp_path):
    base = tmp_path / "s.json"
    base.write_text("{}")
    (tmp_path / "raw").mkdir()
    find = lambda given=None: resolve_historic(base, given, tmp_path / "raw", "c_*.csv")
    assert find() is None
    for n in ("c_1.csv", "c_2.csv", "own.csv"):
        (tmp_path / "raw" / n).write_text("")
    assert find().name == "c_2.csv"
    with pytest.raises(FileNotFoundError):
        find(tmp_path / "none.csv")
    assert find(tmp_path / "raw/own.csv").name == "own.csv" == find().name
    (tmp_path / "raw/own.csv").unlink()
    assert find() is None
    save_local(base, storage_root="/x", zoom=18)
    assert json.loads((tmp_path / "s.local.json").read_text())["reference_csv"].endswith("own.csv") and load_settings(base).storage_root == "/x" and load_settings(base).zoom == 18


def test_rounding_and_time(spark):
    values = [2.675, 0.125, 0.375, 1.005, 0.29, -0.125, 2.5, 1e-9, 12345.6785, -33.4378005, 7.0]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for places in (0, 2, 3, 6):
        got = [r["x"] for r in df.select(S.round_half_even(F.col("v"), places).alias("x")).collect()]
        assert got == [round(v, places) for v in values]
    stamp = df.select(S.utc_now().alias("t")).distinct().collect()
    assert len(stamp) == 1 and stamp[0]["t"].endswith("+00:00") and len(stamp[0]["t"]) == 25 == len(publication.now())
    assert spark.range(1).select(S.error_text(F.repeat(F.lit("x"), 900)).alias("e")).first()["e"] == "x" * 500


def test_validity(spark):
    ring = lambda *p: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in p])
    square, hole, line = ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((1, 1), (2, 1), (2, 2), (1, 2)), ring((0, 0), (4, 0), (8, 0))
    twice = ring((0, 0), (0, 0), (4, 0), (4, 4), (4, 4), (0, 4))
    row = spark.range(1).select(*[G.valid(F.array(*r)).alias(n) for n, r in {"square": [square], "hole": [square, hole], "line": [line], "swapped": [hole, square]}.items()], G.repaired(F.array(twice, line)).alias("fixed"), G.repaired(F.array(line)).alias("none")).first()
    assert (row["square"], row["hole"], row["line"], row["swapped"]) == (True, True, False, False)
    assert len(row["fixed"]) == 1 and len(row["fixed"][0]) == 4 and row["none"] is None


def test_block_checks(spark):
    tiles = spark.createDataFrame([(1, 0, 0, "a"), (1, 1, 0, "b"), (2, 0, 0, "a")], "block_id long, sc_x int, sc_y int, sha string")
    one = {r["block_id"]: r["identity"] for r in block_identities(tiles).collect()}
    again = {r["block_id"]: r["identity"] for r in block_identities(tiles.orderBy(F.desc("sc_x")).withColumn("sha", F.when(F.col("block_id") == 2, "c").otherwise(F.col("sha")))).collect()}
    assert one[1] == again[1] == hashlib.sha256(b"0,0,a;1,0,b").hexdigest() and one[2] != again[2]
    shapes = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (3, 7)], "block_id long, polygon_id long")
    metrics = spark.createDataFrame([(1, 2), (2, 0), (3, 2)], "block_id long, polygons long")
    assert [r[0] for r in consistent(shapes, metrics).collect()] == [3]
    merged = spark.createDataFrame([("large_component", True), ("parcel_scale", False)], "pol_size_class string, geometry_valid boolean")
    blocks = spark.createDataFrame([(1, 10, 100), (2, 90, 100)], "block_id long, fill_pixels long, pixels long")
    assert tuple(summary.vectorization_metrics(merged, blocks).select("polygons", "valid_polygons", "large", "blocks", "fill_pixels", "min_fill_ratio", "max_fill_ratio").first()) == (2, 1, 1, 2, 100, 0.1, 0.9)


def test_tiles_are_fetched_once(spark, tmp_path):
    cells = spark.createDataFrame([("14504", 8, 12), ("14504", 12, 12), ("14504", 8, 16)], "code string, sc_x int, sc_y int")
    plan = tile_source.plan_tiles(cells, F.lit("layer"), SETTINGS, "http://maps.example/wms")
    url = plan.where("name = '8_12'").first()["url"]
    box = [float(v) for v in url.rpartition("BBOX=")[2].split(",")]
    side = 2 * S.HALF_WORLD / 2**19
    assert np.allclose(box, [8 * side - S.HALF_WORLD, S.HALF_WORLD - 16 * side, 12 * side - S.HALF_WORLD, S.HALF_WORLD - 12 * side]) and "WIDTH=1024" in url and "VERSION=1.1.1" in url
    folder, asked = str(tmp_path / "tiles"), []

    def fetch(u, path):
        asked.append(u)
        if len(asked) == 2:
            raise OSError("lost")
        files.write_text(spark, u, path)

    with pytest.raises(OSError):
        tile_source.acquire(spark, plan, folder, fetch)
    assert tile_source.cached(spark, folder).count() == 1 and not list((tmp_path / "tiles").glob("*.lock"))
    assert tile_source.acquire(spark, plan, folder, fetch) == 2 and tile_source.acquire(spark, plan, folder, fetch) == 0
    (tmp_path / "tiles/8_16.json").unlink()  # a crash before the sidecar
    (tmp_path / "tiles/12_12.png").unlink()
    assert tile_source.acquire(spark, plan, folder, fetch) == 2
    other = tile_source.plan_tiles(cells, F.lit("other"), SETTINGS, "http://maps.example/wms")
    assert tile_source.acquire(spark, other, folder, fetch) == 3  # another request, another image
