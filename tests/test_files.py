"""Sources, sinks, stages and streams."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from parcelwright.operators import catalog, records
from parcelwright.plans.stages import Run, changed_blocks
from parcelwright.settings import Settings, load_settings
from parcelwright.sinks import files
from parcelwright.sources import replay, tables, tiles
from parcelwright.streaming import attempts


def test_settings_layers(tmp_path, monkeypatch):
    (tmp_path / "s.json").write_text(json.dumps({"zoom": 18, "fill_color": [1, 2, 3]}))
    (tmp_path / "s.local.json").write_text(json.dumps({"zoom": 17}))
    monkeypatch.setenv("PARCELWRIGHT_STORAGE_ROOT", "/somewhere")
    s = load_settings(tmp_path / "s.json", supercell_tiles=8, max_retries=None)
    assert (s.zoom, s.fill_color, s.storage_root, s.supercell_tiles, s.max_retries) == (17, (1, 2, 3), "/somewhere", 8, 5)


def test_historic_keys(spark, tmp_path):
    spark.createDataFrame([(14504, "00001", "0001", 5), (14504, "2", "02", 6), (14504, "2", "02", 6), (1, "9", "9", 7), (14504, None, "1", 8)], "comuna int, manzana string, predio string, rc_avaluo_total int").write.parquet(str(tmp_path / "h"))
    assert [r["rol"] for r in records.role_keys(tables.historic_parquet(spark, str(tmp_path / "h"), 14504), 14504).orderBy("rol").collect()] == ["1-1", "2-2"]
    (tmp_path / "c.csv").write_text("comuna,x,manzana,predio\n014504.0,a,007,000\n5,b,1,1\n")
    assert [r["rol"] for r in records.role_keys_csv(tables.historic_csv(spark, str(tmp_path / "c.csv")), 14504).collect()] == ["7-0"]


def test_assets(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3)], "comuna int, manzana int, predio int").coalesce(1)
    df.write.parquet(str(tmp_path / "a"))
    part = next((tmp_path / "a").glob("part-*"))
    size, sha = part.stat().st_size, hashlib.sha256(part.read_bytes()).hexdigest()
    columns = ["comuna", "manzana", "predio"]
    tables.validate_asset(spark, str(part), size, sha, 1, columns, [1])
    for wrong in ((size + 1, sha, 1, columns, [1]), (size, "0", 1, columns, [1]), (size, sha, 2, columns, [1]), (size, sha, 1, columns[::-1], [1]), (size, sha, 1, columns, [1, 7])):
        with pytest.raises(ValueError):
            tables.validate_asset(spark, str(part), *wrong)


def test_newest_and_json_sources(spark, tmp_path):
    for n in ("cat_1.csv", "cat_3.csv", "dog_9.csv"):
        (tmp_path / n).write_text("x")
    assert tables.newest(spark, str(tmp_path), "cat_*.csv").endswith("cat_3.csv")
    with pytest.raises(FileNotFoundError):
        tables.newest(spark, str(tmp_path), "cow*")
    (tmp_path / "c.json").write_text(json.dumps([{"id": "1", "nombre": "Ñuñoa", "region": "Metropolitana"}, {"id": 2, "nombre": "Arica", "region": "Arica"}]))
    rows = catalog.with_added(tables.communes_json(spark, str(tmp_path / "c.json"))).collect()
    assert [r["code"] for r in rows] == ["2", "1", "8108"]
    assert catalog.find(tables.communes_json(spark, str(tmp_path / "c.json")), "nunoa").first()["code"] == "1"
    square = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    features = [{"type": "Feature", "properties": {"Comuna": n}, "geometry": {"type": k, "coordinates": c}} for n, k, c in (("Ñuñoa", "Polygon", square), ("NUNOA", "MultiPolygon", [square, square]), ("Arica", "Polygon", square))]
    (tmp_path / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    parts = tables.boundary_geojson(spark, str(tmp_path / "b.json"), "nunoa").first()["parts"]
    assert len(parts) == 3 and len(parts[0][0]) == 5
    assert tables.manifest(spark, str(tmp_path / "none.json"), "a int").count() == 0


def test_normalize_records(spark):
    response = {
        "manzana": "0012", "predio": 7, "rol": "", "existePredio": 1, "direccion": "CALLE 1", "ubicacionX": -33.5, "ubicacionY": -70.6, "periodo": "SEGUNDO SEMESTRE DE 2026",
        "datosAh": {"valor": 3, "list": [1]}, "datosCsa": [{"a": "x"}, {"a": "y"}], "datosCapas": [{"titulo": "Área Verde", "datos": [{"etiqueta": "Uso", "valor": "A"}, {"etiqueta": "Uso", "valor": "A"}, {"etiqueta": "Uso", "valor": "B"}, {"etiqueta": None, "valor": "C"}]}], "otro": {"k": [1, 2]},
    }
    rows = [("14504", None, None, json.dumps(response)), ("14504", "003", None, None), ("14504", "1", "2", "[1]")]
    got = records.normalize(spark.createDataFrame(rows, "commune string, manzana string, predio string, response string")).collect()
    one = got[0]
    assert (one["comuna"], one["manzana"], one["predio"], one["rol"], one["direccion_sii"], one["lat"], one["lon"]) == (14504, "12", "7", "12-7", "CALLE 1", "-33.5", "-70.6")
    assert one["extras"] == {"ah_valor": "3", "ah_list": "[1]", "csa_a": "x", "cap__área_verde__uso": "A", "cap__área_verde__uso__2": "B", "api_otro": '{"k":[1,2]}'}
    assert (got[1]["rol"], got[2]["rol"]) == ("3-0", "1-2")


def test_requests(spark):
    one = spark.range(1)
    got = one.select(replay.delays(5, 2.0, F.lit(True)).alias("slow"), replay.delays(5, 2.0, F.lit(False)).alias("fast"), replay.role_request(F.lit("014504"), F.lit("0001"), F.lit("2"), F.lit("l")).alias("r"), replay.fallback_urls(F.array(F.lit("http://a.cl/x"), F.lit("http://b.cl/x"), F.lit("http://a.cl/x"))).alias("u")).first()
    assert got["slow"] == [4.0, 8.0, 16.0, 32.0] and got["fast"] == [2.0, 4.0, 8.0, 16.0]
    assert json.loads(got["r"]) == {"comuna": "14504", "manzana": "1", "predio": "2", "layer": "l"}
    assert [u["host"] for u in got["u"]] == ["a.cl", "b.cl"]
    exhausted = spark.createDataFrame([("k", 1, False), ("k", 5, False), ("j", 2, True)], "query_key string, attempt int, ok boolean")
    assert {r["query_key"]: r["status"] for r in replay.last_status(exhausted).collect()} == {"k": "error", "j": "ok"}


def test_checked_parquet_and_export(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("k", "role", '{"a": 1}', None), ("j", "point", None, "e")], "query_key string, source string, response string, error string")
    assert files.write_parquet(df, out, 2) == 2 and files.write_parquet(df, out) == 2
    with pytest.raises(ValueError):
        files.write_parquet(df, out, 3)
    assert spark.read.parquet(out).count() == 2 and not [p for p in tmp_path.iterdir() if ".part" in p.name]
    lines = [json.loads(r["line"]) for r in files.raw_export(df).collect()]
    assert [x["query_key"] for x in lines] == ["j", "k"] and lines[1]["response"] == {"a": 1} and lines[0]["response"] is None
    files.write_lines(files.raw_export(df), str(tmp_path / "lines"), gzip=True)
    assert spark.read.text(str(tmp_path / "lines")).count() == 2


def test_catalog_and_publication(spark, tmp_path):
    communes = spark.createDataFrame([("2", "B", "r"), ("1", "A, a", "r")], "code string, name string, region string")
    empty = spark.createDataFrame([], "periodo string, codigo_comuna string, comuna string, region string, status string")
    seeded = catalog.seed(empty, catalog.with_added(communes), "2026S2")
    assert seeded.count() == 3 and catalog.seed(seeded, communes, "2026S2").count() == 3
    changed = spark.createDataFrame([("2026S2", "1", "completa")], "periodo string, codigo_comuna string, status string")
    twice = catalog.upsert(catalog.upsert(seeded, changed), changed)
    assert twice.count() == 3 and twice.where("codigo_comuna = '1'").first()["status"] == "completa"
    files.write_catalog(twice, str(tmp_path / "c.csv"), ["periodo", "codigo_comuna", "comuna", "extra"])
    assert (tmp_path / "c.csv").read_bytes().startswith(b"\xef\xbb\xbfperiodo,codigo_comuna,comuna,extra\r\n2026S2,1,,\r\n2026S2,2,B,")
    spark.range(3).write.parquet(str(tmp_path / "art"))
    artefacts = {"vectors": str(tmp_path / "art")}
    with pytest.raises(ValueError):
        files.publish(spark, "parcial_control", artefacts, str(tmp_path / "pub"))
    with pytest.raises(FileNotFoundError):
        files.publish(spark, "completa", {"x": str(tmp_path / "none")}, str(tmp_path / "pub"))
    assert files.publish(spark, "completa", artefacts, str(tmp_path / "pub")) is True
    assert files.publish(spark, "completa", artefacts, str(tmp_path / "pub")) is False
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "art"))
    assert files.publish(spark, "completa", artefacts, str(tmp_path / "pub")) is True
    assert spark.read.parquet(str(tmp_path / "pub/vectors")).count() == 4


def test_stages_resume_and_invalidate(spark, tmp_path):
    def run(settings, inputs=1, fail=False):
        r = Run(spark, str(tmp_path / "run"), settings)
        r.stage("blocks", lambda: spark.range(3), inputs=inputs)

        def graph():
            if fail:
                raise RuntimeError("lost")
            return spark.range(5)

        r.stage("graph", graph, after=("blocks",))
        return r.ran

    with pytest.raises(RuntimeError):
        run({"a": 1}, fail=True)
    assert run({"a": 1}) == ["graph"]
    assert run({"a": 1}) == []
    assert run({"a": 2}) == ["blocks", "graph"]
    assert run({"a": 1}, inputs=2) == ["blocks", "graph"]
    old = spark.createDataFrame([(1, "x"), (2, "y")], "block_id long, identity string")
    new = spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "block_id long, identity string")
    assert [r[0] for r in changed_blocks(old, new).orderBy("block_id").collect()] == [2]


def test_tiles_to_runs(spark):
    import numpy as np

    image = np.zeros((20, 20, 4), np.uint8)
    image[2:18, 2:9] = image[2:18, 11:18] = (232, 221, 182, 179)
    df = spark.createDataFrame([(0, 100, 200, 20, 20, 4, bytearray(image.tobytes()))], "block_id long, x int, y int, width int, height int, channels int, data binary")
    got = tiles.tile_runs(df, Settings()).collect()
    assert len(got) == 32 and {(r["x0"], r["x1"]) for r in got} == {(102, 109), (111, 118)} and {r["gy"] for r in got} == set(range(202, 218))


def test_attempt_stream(spark, tmp_path):
    rows = [("a", "ok", 1), ("b", "error", 2), ("c", "not_found", 3), ("a", "error", 4), ("b", "ok", 5)]
    schema = attempts.LOG
    for i, part in enumerate((rows[:3], rows[3:])):
        df = spark.createDataFrame([(k, s, n) for k, s, n in part], "query_key string, status string, seq long")
        df = df.selectExpr("query_key", "'role' source", "'1' commune", "'1' manzana", "'1' predio", "status", "1 attempts", "timestamp_seconds(seq) queried_at", "cast(null as string) response", "case when status = 'error' then 'why' end error", "seq")
        df.write.parquet(str(tmp_path / f"in/{i}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        attempts.append(stream, str(tmp_path / "log"), str(tmp_path / "cp"))
    assert {r["query_key"]: r["status"] for r in attempts.state(spark, str(tmp_path / "log")).collect()} == {"a": "error", "b": "ok", "c": "not_found"}
    assert [r[0] for r in attempts.retry(spark, str(tmp_path / "log")).collect()] == ["a"]
    assert attempts.failures(spark, str(tmp_path / "log")).first()["error"] == "why"


def test_geoparquet_lock_and_archive(spark, tmp_path):
    import pyarrow.parquet as pq

    from parcelwright.functions import geometry as G

    box = G.box(*[F.lit(float(v)) for v in (0, 0, 2, 3)])
    df = spark.range(2).select("id", F.unhex(G.wkb(box)).alias("geometry"))
    target = str(tmp_path / "one.parquet")
    assert files.write_geoparquet(df, target) == 2
    meta = json.loads(pq.ParquetFile(target).schema_arrow.metadata[b"geo"])
    assert meta["primary_column"] == "geometry" and spark.read.parquet(target).count() == 2
    with pytest.raises(ValueError):
        files.write_geoparquet(df, target, max_rows=1)
    with files.Lock(spark, target), pytest.raises(BlockingIOError), files.Lock(spark, target):
        pass
    with files.Lock(spark, target):
        pass
    folder = tmp_path / "commune"
    (folder / "old").mkdir(parents=True)
    (folder / "x.part").write_text("")
    assert files.archive(spark, str(folder), "t1") == ["old"] and sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["backups"]
    assert files.finished("completa", True) and not files.finished("parcial_control", True) and not files.finished("completa", True, rematch=True)
