"""A commune's folder, its manifest and its publication.

``Layout`` names where everything of a commune lies. The manifest is a small JSON file that says how far a commune has
come. A finished commune is published as a package: its artefacts are copied beside their destinations and put in place,
the manifest records the hash, and the catalogue gets the commune's row. What is published unchanged is not copied again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import SparkSession

from parcelwright.functions.scalars import slug_of
from parcelwright.operators import catalog, summary
from parcelwright.settings import Settings
from parcelwright.sinks import files
from parcelwright.streaming import attempts

SCHEMA_VERSION = 1


def now() -> str:
    """T19 on the driver."""
    return datetime.now(UTC).isoformat(timespec="seconds")


@dataclass(frozen=True)
class Layout:
    """The paths of a commune and a period below the roots of raw and processed data."""

    raw_root: str
    processed_root: str
    period: str
    code: str
    slug: str

    @property
    def stem(self) -> str:
        return f"{self.code}_{self.slug}"

    @property
    def raw(self) -> str:
        return f"{self.raw_root}/{self.period}/{self.stem}"

    @property
    def tiles(self) -> str:
        return f"{self.raw}/tiles"

    @property
    def manifest(self) -> str:
        return f"{self.raw}/manifest.json"

    @property
    def log(self) -> str:
        """The log of attempts, a folder of Parquet files."""
        return f"{self.raw}/log"

    @property
    def stages(self) -> str:
        return f"{self.raw}/stages"

    @property
    def raw_lines(self) -> str:
        return f"{self.raw}/respuestas_api.jsonl"

    @property
    def metrics(self) -> str:
        return f"{self.processed_root}/{self.period}/{self.stem}_metrics.json"

    @property
    def output(self) -> str:
        return f"{self.processed_root}/{self.period}/{self.stem}.parquet"

    @staticmethod
    def of(raw_root: str, processed_root: str, period: str, code: str, name: str) -> Layout:
        return Layout(raw_root, processed_root, period, code, slug_of(name))


def start_manifest(settings: Settings, code: str, name: str, region: str) -> dict[str, Any]:
    """What a manifest says before anything is done."""
    at = now()
    return {
        "schema_version": SCHEMA_VERSION, "status": "iniciando", "commune": {"sii_code": code, "name": name, "region": region}, "periodo_geometria": settings.periodo_geometria, "started_at": at, "updated_at": at,
        "zoom": settings.zoom, "supercell_tiles": settings.supercell_tiles,
        "settings": {"max_retries": settings.max_retries, "boundary_buffer_m": settings.boundary_buffer_m, "fill_color": list(settings.fill_color), "fill_tolerance": list(settings.fill_tolerance)},
    }


def update_manifest(spark: SparkSession, path: str, manifest: dict[str, Any], **updates: Any) -> dict[str, Any]:
    """The manifest with the updates and the time, written to ``path``."""
    changed = {**manifest, **updates, "updated_at": now()}
    files.write_json(spark, changed, path)
    return changed


def force(spark: SparkSession, layout: Layout, stamp: str | None = None) -> list[str]:
    """Before a forced run, save what there is and forget stages and attempts; tiles stay. Returns what was saved."""
    stamp = stamp or now().replace(":", "").replace("+", "_")
    files.delete(spark, f"{layout.output}.part")
    saved = files.archive(spark, layout.raw, stamp, keep=("tiles",), copied=("manifest.json", layout.raw_lines.rpartition("/")[2]))
    for path in (layout.metrics, layout.output):
        if files.exists(spark, path):
            files.copy(spark, path, f"{layout.raw}/backups/{stamp}/{path.rpartition('/')[2]}")
            saved.append(path.rpartition("/")[2])
    return saved


def update_catalog(spark: SparkSession, store: str, record: dict[str, Any], communes) -> str:
    """The catalogue of a store with a pending row for every commune of the period and ``record`` in its place."""
    path = f"{store}/catalogo/estado_geometrias.csv"
    seeded = catalog.seed(files.read_catalog(spark, path), catalog.with_added(communes), str(record["periodo"]))
    row = spark.createDataFrame([tuple("" if record.get(c) is None else str(record.get(c, "")) for c in files.CATALOG_COLUMNS)], ", ".join(f"{c} string" for c in files.CATALOG_COLUMNS))
    files.write_catalog(catalog.upsert(seeded, row), path)
    return path


def publish_commune(spark: SparkSession, layout: Layout, store: str, communes, with_tiles: bool = True) -> dict[str, str]:
    """Put the package of a finished commune into a store; returns the paths of the output and the catalogue.

    The manifest must say that the commune is finished, and the log, raw lines, output and metrics must be there. Nothing
    is copied if the manifest records a complete package of this very output in this store and all of it still lies there.
    """
    manifest = files.read_json(spark, layout.manifest)
    if manifest.get("status") not in files.PUBLISHABLE:
        raise ValueError(f"commune {layout.code} is not finished: {manifest.get('status', 'no status')}")
    missing = [p for p in (layout.log, layout.raw_lines, layout.output, layout.metrics) if not files.exists(spark, p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    root = f"{store}/{layout.period}"
    output, lines = f"{root}/geoparquet/{layout.stem}.parquet", f"{root}/respuestas_api/{layout.stem}.jsonl.gz"
    metrics, record, log = f"{root}/metadatos/{layout.stem}_metricas.json", f"{root}/metadatos/{layout.stem}_manifest.json", f"{root}/checkpoints/{layout.stem}"
    tiles = f"{root}/wms_archivados/{layout.stem}_tiles.zip" if with_tiles else None
    register = f"{store}/catalogo/estado_geometrias.csv"
    backup = manifest.get("storage_backup", {})
    there = all(files.exists(spark, p) for p in (output, lines, metrics, record, log, register, *([tiles] if tiles else [])))
    found = {"geoparquet": output, "catalog": register}
    if there and backup.get("status") == "completo" and backup.get("root") == store and backup.get("geoparquet_sha256") == files.tree_hash(spark, layout.output) == files.tree_hash(spark, output):
        return found
    files.copy(spark, layout.output, output)
    files.gzip_file(spark, layout.raw_lines, lines)
    files.copy(spark, layout.metrics, metrics)
    files.copy(spark, layout.log, log)
    if tiles:
        files.zip_files(spark, layout.tiles, tiles)
    sha, at = files.tree_hash(spark, output), now()
    manifest = update_manifest(spark, layout.manifest, manifest, storage_backup={"status": "completo", "root": store, "backed_up_at": at, "geoparquet_sha256": sha, "tiles_archived": bool(tiles)})
    files.copy(spark, layout.manifest, record)
    api = summary.status_row(attempts.state(spark, layout.log).where(f"commune = '{layout.code}'"), "role").first()
    measured = files.read_json(spark, layout.metrics)
    match, final, commune = measured.get("match", {}), measured.get("final_result", {}), manifest.get("commune", {})
    update_catalog(spark, store, {
        "periodo": layout.period, "codigo_comuna": layout.code, "comuna": commune.get("name", layout.slug), "region": commune.get("region", ""), "status": manifest["status"],
        "roles_total": manifest.get("historical_role_candidates"), "roles_ok": api["ok"], "roles_no_encontrados": api["not_found"], "roles_error": api["error"],
        "roles_vigentes_sin_visualizacion": match.get("current_without_published_geometry"), "roles_con_coordenada_sin_geometria": match.get("current_with_coordinates_unmatched"),
        "poligonos": manifest.get("vectorization", {}).get("polygons"), "poligonos_con_rol": final.get("polygons_with_role"), "poligonos_sin_rol": final.get("polygons_without_role"),
        "atribucion_poligonos_pct": final.get("polygon_attribution_pct"), "roles_unicos_total": final.get("unique_roles_total"), "roles_unicos_con_geometria": final.get("unique_roles_with_geometry"),
        "cobertura_roles_unicos_pct": final.get("unique_role_geometry_coverage_pct"), "filas_salida": measured.get("output_rows"), "fecha_captura": measured.get("captured_at"), "fecha_respaldo": at,
        "geoparquet_sha256": sha, "geoparquet_relativo": output.removeprefix(f"{store}/"),
    }, communes)
    return found
