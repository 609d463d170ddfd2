"""Tiles as pixel runs (S11, S12, R08): cached images in, ``block`` masks out. Fetching is pluggable: the engine opens no network."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.functions.scalars import request_identity, supercell_bounds
from parcelwright.settings import Settings
from parcelwright.sinks.files import Lock, delete, names, replace, write_json


def images(spark: SparkSession, path: str) -> DataFrame:
    """``origin, width, height, channels, data`` of the images in a folder; pixels are BGRA, rows from the top."""
    return spark.read.format("image").option("dropInvalid", True).load(path).select(F.col("image.origin").alias("origin"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def usable(tiles: DataFrame, code: Column, layer: Column, settings: Settings) -> DataFrame:
    """Tiles (sc_x, sc_y, identity, width, height) whose sidecar names the very request and whose size is right."""
    side = settings.supercell_tiles * 256
    asked = request_identity(code, layer, settings.periodo_geometria, settings.zoom, settings.supercell_tiles, F.col("sc_x"), F.col("sc_y"))
    return tiles.where((F.col("identity") == asked) & (F.col("width") == side) & (F.col("height") == side))


def plan_tiles(cells: DataFrame, layer: Column, settings: Settings, base: str) -> DataFrame:
    """``code, sc_x, sc_y, name, identity, url`` of the image of every supercell (code, sc_x, sc_y): a WMS 1.1.1 GetMap in
    Web Mercator, square, PNG."""
    side = settings.supercell_tiles * 256
    b = supercell_bounds(F.col("sc_x"), F.col("sc_y"), settings.zoom, settings.supercell_tiles)
    box = F.concat_ws(",", *[F.format_string("%.9f", b[c]) for c in ("left", "bottom", "right", "top")])
    url = F.concat(F.lit(f"{base}?SERVICE=WMS&VERSION=1.1.1&REQUEST=GetMap&STYLES=&SRS=EPSG:3857&FORMAT=image/png&TRANSPARENT=TRUE&WIDTH={side}&HEIGHT={side}&LAYERS="), layer, F.lit("&BBOX="), box)
    asked = request_identity(F.col("code"), layer, settings.periodo_geometria, settings.zoom, settings.supercell_tiles, F.col("sc_x"), F.col("sc_y"))
    return cells.select("code", "sc_x", "sc_y", F.concat_ws("_", "sc_x", "sc_y").alias("name"), asked.alias("identity"), url.alias("url"))


def cached(spark: SparkSession, folder: str) -> DataFrame:
    """``name, identity`` of the images in a folder whose sidecar says what was asked for."""
    have = {n.rpartition(".")[0] for n in names(spark, folder) if n.endswith(".png")}
    if not any(n.endswith(".json") for n in names(spark, folder)):
        return spark.createDataFrame([], "name string, identity string")
    sidecars = spark.read.schema("name string, identity string").option("multiLine", True).json(f"{folder}/*.json")
    return sidecars.join(spark.createDataFrame([(n,) for n in sorted(have)], "name string"), "name")


def acquire(spark: SparkSession, plan: DataFrame, folder: str, fetch: Callable[[str, str], None]) -> int:
    """Fetch the planned images that are not there as asked for; returns how many.

    ``fetch(url, path)`` puts an image at a path. Each is fetched beside its place under a lock of its own, and its sidecar
    is written last, so an image that a crash left without one is fetched again. The driver sees one image's row at a time.
    """
    wanted = plan.join(cached(spark, folder), ["name", "identity"], "left_anti").select("name", "identity", "url").orderBy("name")
    done = 0
    for r in wanted.toLocalIterator():
        image = f"{folder}/{r['name']}.png"
        with Lock(spark, image):
            delete(spark, f"{folder}/{r['name']}.json")
            fetch(r["url"], f"{image}.part")
            replace(spark, f"{image}.part", image)
            write_json(spark, {"name": r["name"], "identity": r["identity"]}, f"{folder}/{r['name']}.json")
        done += 1
    return done


def tile_runs(tiles: DataFrame, settings: Settings, color: tuple[int, int, int] | None = None) -> DataFrame:
    """``block_id, gy, x0, x1`` of the filled pixels of tiles (block_id, x, y: lattice position of the first pixel; width, height, channels, data).

    One image is in memory at a time; what leaves is a row per run.
    """
    r, g, b = color or settings.fill_color
    target, tolerance, least = np.array([b, g, r]), np.array(settings.fill_tolerance[::-1]), settings.min_fill_alpha

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples():
                image = np.frombuffer(t.data, np.uint8).reshape(t.height, t.width, t.channels).astype(np.int16)
                alpha = image[:, :, 3] if t.channels == 4 else np.full((t.height, t.width), 255)
                mask = (np.abs(image[:, :, :3] - target) <= tolerance).all(axis=2) & (alpha >= least)
                edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
                rows, starts = np.nonzero(edges == 1)
                _, ends = np.nonzero(edges == -1)
                yield pd.DataFrame({"block_id": np.full(len(rows), t.block_id), "gy": (rows + t.y).astype(np.int32), "x0": (starts + t.x).astype(np.int32), "x1": (ends + t.x).astype(np.int32)})

    columns = tiles.select("block_id", "x", "y", "width", "height", "channels", "data")
    return columns.mapInPandas(encode, "block_id long, gy int, x0 int, x1 int")
