"""Regional reference assets (S09, S10, J15, U04): verified where they lie, else fetched from one source after another.

Fetching is pluggable: ``fetch(url, path)`` puts the bytes of a URL at a path of Spark's file systems, be it from a folder
of captured files or over a network that the caller opens. The engine itself opens none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.operators.catalog import region_assets
from parcelwright.sinks.files import copy, delete, exists, file_hash, file_size, free_space, replace
from parcelwright.sources.tables import validate_asset

Fetch = Callable[[str, str], None]


@dataclass(frozen=True)
class Asset:
    """One entry of a manifest."""

    region: str
    file: str
    bytes: int
    rows: int
    sha256: str
    urls: tuple[str, ...]


def distinct_urls(urls: str | list[str] | tuple[str, ...]) -> list[str]:
    """The sources of an asset in order, each once, blanks left out; none is an error."""
    found = list(dict.fromkeys(u.strip() for u in ([urls] if isinstance(urls, str) else urls) if u.strip()))
    if not found:
        raise ValueError("an asset without a source")
    return found


def captured(spark: SparkSession, folder: str) -> Fetch:
    """A fetch that takes the last part of a URL from a folder of captured files."""

    def fetch(url: str, path: str) -> None:
        source = f"{folder}/{url.rstrip('/').rpartition('/')[2]}"
        if not exists(spark, source):
            raise OSError(f"{source} was not captured")
        copy(spark, source, path)

    return fetch


def fetch_asset(spark: SparkSession, asset: Asset, destination: str, fetch: Fetch) -> str:
    """The asset at ``destination``, from the first source whose bytes have the right length and hash; returns the URL.

    Twice the asset's size must be free. What a source gives lies in a neighbour until it is verified, and is deleted if
    it is wrong. If all sources fail, one error tells of each.
    """
    room = free_space(spark, destination)
    if room is not None and room < 2 * asset.bytes:
        raise OSError(f"no room for {asset.file}: {room} bytes are free, {2 * asset.bytes} are needed")
    part, errors = f"{destination}.fetched", []
    for url in distinct_urls(asset.urls):
        delete(spark, part)
        try:
            fetch(url, part)
            if (size := file_size(spark, part)) != asset.bytes:
                raise ValueError(f"{size} bytes, not {asset.bytes}")
            if file_hash(spark, part) != asset.sha256:
                raise ValueError("hash differs")
            replace(spark, part, destination)
            return url
        except (OSError, ValueError) as e:
            errors.append(f"{url}: {e}")
            delete(spark, part)
    raise RuntimeError(f"{asset.file} from none of its sources: " + "; ".join(errors))


def resolve_regions(spark: SparkSession, communes: DataFrame, manifest: DataFrame, folder: str, fetch: Fetch) -> dict[str, str]:
    """The path of each region's verified asset below ``folder``, by normalised region.

    ``communes`` are those wanted (code, name, region), ``manifest`` is what ``asset_manifest`` gives. A region without an
    asset is an error. An asset that is there and valid stays; else it is fetched and validated once more, and deleted if
    it is still wrong. The driver sees a row per region.
    """
    entries = manifest.select(F.col("region").alias("region"), "file", "columns", "bytes", "rows", "sha256", "urls")
    by_region = region_assets(communes, entries).join(entries.withColumnRenamed("file", "_file"), F.col("file") == F.col("_file"))
    out = {}
    for r in by_region.orderBy("region_key").collect():
        asset, destination = Asset(r["region"], r["file"], r["bytes"], r["rows"], r["sha256"], tuple(r["urls"])), f"{folder}/{r['file']}"
        check = lambda asset=asset, path=destination, r=r: validate_asset(spark, path, asset.bytes, asset.sha256, asset.rows, list(r["columns"]), [int(c) for c in r["codes"]])
        try:
            if not exists(spark, destination):
                raise FileNotFoundError(destination)
            check()
        except (FileNotFoundError, ValueError):
            fetch_asset(spark, asset, destination, fetch)
            try:
                check()
            except ValueError:
                delete(spark, destination)
                raise
        out[r["region_key"]] = destination
    return out
