"""Sinks (K01-K09): checked Parquet, JSON, JSON lines, gzip, catalogue CSV, publication.

Files are reached through Spark's file systems, so any store will do. A table is written beside its destination, checked
against its own footer, and put in place by a rename.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PUBLISHABLE = ("completa", "completa_con_observaciones")
# Fixed value: the columns of the catalogue.
CATALOG_KEY = ("periodo", "codigo_comuna")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Nothing is left at ``path``."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def file_size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getLen()


def free_space(spark: SparkSession, path: str) -> int | None:
    """Bytes that are free where ``path`` will lie; None where a store doesn't tell."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    remaining = fs.getStatus(p.getParent()).getRemaining()
    return remaining if remaining > 0 else None


def replace(spark: SparkSession, source: str, destination: str) -> None:
    """Move ``source`` to ``destination``; what was there is put aside first and deleted only once the new one is in place.

    After a crash in between, the old one lies beside it as ``.old``; the next call takes it back if nothing is in its place.
    """
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, destination)
    _, old = _fs(spark, f"{destination}.old")
    if fs.exists(old):
        if fs.exists(dst):
            fs.delete(old, True)
        else:
            fs.rename(old, dst)
    if not fs.exists(src):
        raise FileNotFoundError(source)
    aside = fs.exists(dst)
    if aside and not fs.rename(dst, old):
        raise OSError(f"{destination} can't be put aside")
    try:
        moved = fs.rename(src, dst)
    except Py4JJavaError:
        moved = False
    if not moved:
        if aside:
            fs.rename(old, dst)
        raise OSError(f"{source} can't be moved to {destination}")
    if aside:
        fs.delete(old, True)


def write_parquet(df: DataFrame, destination: str, expected_rows: int | None = None) -> int:
    """Write, check rows and columns as read back, put in place. Returns the row count."""
    spark = df.sparkSession
    part = f"{destination}.part-{uuid.uuid4().hex[:8]}"
    df.write.parquet(part)
    back = spark.read.parquet(part)
    n = back.count()
    if back.columns != df.columns or expected_rows is not None and n != expected_rows:
        fs, p = _fs(spark, part)
        fs.delete(p, True)
        raise ValueError(f"{destination}: {n} rows and columns {back.columns} were written, not {expected_rows} and {df.columns}")
    replace(spark, part, destination)
    return n


def write_geoparquet(df: DataFrame, destination: str, geometry: str = "geometry", max_rows: int = 2_000_000) -> int:
    """K01 for one commune: a single file with the ``geo`` footer, from a frame whose ``geometry`` is WKB.

    A commune's output is small (tens of thousands of rows); more than ``max_rows`` is an error, for which
    ``write_parquet`` is the way. Rows and columns are read back before the file is put in place.
    """
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq

    spark = df.sparkSession
    if (n := df.count()) > max_rows:
        raise ValueError(f"{n} rows are too many for one file")
    data = df.toArrow()
    geo = {"version": "1.0.0", "primary_column": geometry, "columns": {geometry: {"encoding": "WKB", "geometry_types": ["Polygon"], "crs": None}}}
    buffer = io.BytesIO()
    pq.write_table(data.replace_schema_metadata({**(data.schema.metadata or {}), b"geo": json.dumps(geo).encode()}), buffer)
    footer = pq.ParquetFile(pa.BufferReader(buffer.getvalue()))
    if footer.metadata.num_rows != n or footer.schema_arrow.names != df.columns:
        raise ValueError(f"{destination}: rows or columns differ as read back")
    part = f"{destination}.part"
    fs, p = _fs(spark, part)
    out = fs.create(p, True)
    out.write(bytearray(buffer.getvalue()))
    out.close()
    replace(spark, part, destination)
    return n


def copy(spark: SparkSession, source: str, destination: str) -> None:
    """A file or folder beside its destination, then in place; a log folder copied so is a snapshot."""
    source_fs, src = _fs(spark, source)
    target_fs, part = _fs(spark, f"{destination}.part")
    target_fs.mkdirs(part.getParent())
    target_fs.delete(part, True)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, src, target_fs, part, False, spark.sparkContext._jsc.hadoopConfiguration())
    replace(spark, f"{destination}.part", destination)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The sorted names in a folder; none if there is no such folder."""
    fs, p = _fs(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(p)) if fs.exists(p) else []


def _stream(spark: SparkSession, source: str, out, close: bool) -> None:
    """The bytes of a file into an open stream, a buffer at a time."""
    fs, p = _fs(spark, source)
    spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(p), out, 1 << 16, close)


def gzip_file(spark: SparkSession, source: str, destination: str) -> None:
    """One file, compressed beside its destination, then in place."""
    fs, part = _fs(spark, f"{destination}.part")
    fs.mkdirs(part.getParent())
    _stream(spark, source, spark.sparkContext._jvm.java.util.zip.GZIPOutputStream(fs.create(part, True)), True)
    replace(spark, f"{destination}.part", destination)


def zip_files(spark: SparkSession, folder: str, destination: str, suffix: str = ".png") -> list[str]:
    """The files of a folder that end so, sorted by name, stored without compression in one archive. Returns the names.

    Files stream through a buffer; a stored entry needs its checksum first, so each is read twice.
    """
    zips = spark.sparkContext._jvm.java.util.zip
    fs, part = _fs(spark, f"{destination}.part")
    fs.mkdirs(part.getParent())
    archived = [n for n in names(spark, folder) if n.endswith(suffix)]
    out = zips.ZipOutputStream(fs.create(part, True))
    for name in archived:
        _, p = _fs(spark, f"{folder}/{name}")
        check = zips.CheckedOutputStream(spark.sparkContext._jvm.java.io.OutputStream.nullOutputStream(), zips.CRC32())
        _stream(spark, f"{folder}/{name}", check, True)
        entry, size = zips.ZipEntry(name), fs.getFileStatus(p).getLen()
        entry.setMethod(0)
        entry.setSize(size)
        entry.setCompressedSize(size)
        entry.setCrc(check.getChecksum().getValue())
        entry.setTime(0)
        out.putNextEntry(entry)
        _stream(spark, f"{folder}/{name}", out, False)
        out.closeEntry()
    out.close()
    replace(spark, f"{destination}.part", destination)
    return archived


def archive(spark: SparkSession, root: str, stamp: str, keep: tuple[str, ...] = (), copied: tuple[str, ...] = ()) -> list[str]:
    """Move what lies in ``root`` to ``root/backups/stamp`` and drop unfinished files; what is in ``keep`` stays as it
    is, such as tiles, and what is in ``copied`` stays and is copied. Returns the names that are in the backup."""
    fs, _ = _fs(spark, root)
    saved = []
    for name in names(spark, root):
        _, p = _fs(spark, f"{root}/{name}")
        if ".part" in name:
            fs.delete(p, True)
        elif name != "backups" and name not in keep and not name.startswith("."):
            target = f"{root}/backups/{stamp}/{name}"
            copy(spark, f"{root}/{name}", target) if name in copied else _move(spark, f"{root}/{name}", target)
            saved.append(name)
    return saved


def _move(spark: SparkSession, source: str, destination: str) -> None:
    fs, p = _fs(spark, destination)
    fs.mkdirs(p.getParent())
    replace(spark, source, destination)


class Lock:
    """Exclusive use of a destination while the block runs; a lock that another holds is an error.

    A lock whose holder crashed is taken over once it is older than ``stale_s`` seconds; ``refresh`` keeps one young.
    """

    def __init__(self, spark: SparkSession, destination: str, stale_s: float = 6 * 3600):
        self.fs, self.path = _fs(spark, f"{destination}.lock")
        self.stale_s = stale_s

    def __enter__(self) -> Lock:
        if not self._create():
            age = time.time() - self.fs.getFileStatus(self.path).getModificationTime() / 1000
            if age < self.stale_s:
                raise BlockingIOError(f"{self.path.toString()} is held")
            self.fs.delete(self.path, False)
            if not self._create():  # another was quicker
                raise BlockingIOError(f"{self.path.toString()} is held")
        return self

    def _create(self) -> bool:
        try:
            return self.fs.createNewFile(self.path)
        except Py4JJavaError:  # some stores raise where the file is there
            if self.fs.exists(self.path):
                return False
            raise

    def refresh(self) -> None:
        self.fs.setTimes(self.path, int(time.time() * 1000), -1)

    def __exit__(self, *_: object) -> None:
        self.fs.delete(self.path, False)


def finished(status: str | None, output_exists: bool, force: bool = False, rematch: bool = False) -> bool:
    """Whether a commune needs no work; a run that was limited is never finished."""
    return status in PUBLISHABLE and output_exists and not force and not rematch


def write_text(spark: SparkSession, text: str, destination: str) -> None:
    """A small file, by way of a neighbour."""
    part = f"{destination}.part"
    fs, p = _fs(spark, part)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    replace(spark, part, destination)


def write_json(spark: SparkSession, value: Any, destination: str) -> None:
    """K02, K11."""
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=2) + "\n", destination)


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON object; none where there is no file."""
    if not exists(spark, path):
        return {}
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def raw_export(results: DataFrame) -> DataFrame:
    """One JSON line per row, the response parsed again; in order of source and key."""
    have = [c for c in ("query_key", "source", "commune", "manzana", "predio", "polygon_id", "status", "attempts", "queried_at", "point_lon", "point_lat", "response", "error") if c in results.columns]
    values = [F.try_parse_json("response").alias("response") if c == "response" else F.col(c) for c in have]
    line = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    return results.withColumn("line", line).orderBy("source", "query_key").select("line")


def write_lines(lines: DataFrame, destination: str, gzip: bool = False) -> None:
    """A text column as a folder of text files."""
    part = f"{destination}.part-{uuid.uuid4().hex[:8]}"
    writer = lines.write.option("compression", "gzip") if gzip else lines.write
    writer.text(part)
    replace(lines.sparkSession, part, destination)


# The columns of the catalogue file, in order.
CATALOG_COLUMNS = (
    "periodo", "codigo_comuna", "comuna", "region", "status", "roles_total", "roles_ok", "roles_no_encontrados", "roles_error", "roles_vigentes_sin_visualizacion", "roles_con_coordenada_sin_geometria",
    "poligonos", "poligonos_con_rol", "poligonos_sin_rol", "atribucion_poligonos_pct", "roles_unicos_total", "roles_unicos_con_geometria", "cobertura_roles_unicos_pct", "filas_salida", "fecha_captura",
    "fecha_respaldo", "geoparquet_sha256", "geoparquet_relativo",
)


def write_catalog(catalog: DataFrame, destination: str, columns: tuple[str, ...] | list[str] = CATALOG_COLUMNS) -> None:
    """One CSV file with a byte-order mark, sorted by key; the catalogue has a row per commune and period."""
    have = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in catalog.columns else F.lit("").alias(c) for c in columns]
    rows = catalog.select(*have).orderBy(*CATALOG_KEY).collect()
    quote = lambda v: '"' + v.replace('"', '""') + '"' if any(x in v for x in ',"\r\n') else v
    text = "\ufeff" + "".join(",".join(map(quote, r)) + "\r\n" for r in [columns, *map(list, rows)])
    write_text(catalog.sparkSession, text, destination)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue file as text columns, empty fields as null; no rows if there is no file."""
    schema = ", ".join(f"{c} string" for c in CATALOG_COLUMNS)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.withColumnsRenamed({c: c.lstrip("\ufeff") for c in rows.columns})


def file_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any size, streamed."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def tree_hash(spark: SparkSession, path: str) -> str:
    """Of a file its hash, of a folder the SHA-256 over the names and hashes of its data files."""
    fs, p = _fs(spark, path)
    if not fs.getFileStatus(p).isDirectory():
        return file_hash(spark, path)
    data = [n for n in names(spark, path) if n[0] not in "_."]
    return hashlib.sha256("".join(f"{n}:{tree_hash(spark, f'{path}/{n}')}\n" for n in data).encode()).hexdigest()


def publish(spark: SparkSession, status: str, artefacts: dict[str, str], destination: str) -> bool:
    """Copy finished artefacts to ``destination``, unless they are there unchanged. True if something was copied."""
    if status not in PUBLISHABLE:
        raise ValueError(f"{status} is no finished state")
    missing = [name for name, path in artefacts.items() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    hashes = {name: tree_hash(spark, path) for name, path in artefacts.items()}
    record = f"{destination}/published.json"
    if exists(spark, record):
        old = "\n".join(r[0] for r in spark.read.text(record).collect())
        if json.loads(old) == hashes and all(exists(spark, f"{destination}/{n}") for n in artefacts):
            return False
    for name, path in artefacts.items():
        copy(spark, path, f"{destination}/{name}")
    write_json(spark, hashes, record)
    return True
