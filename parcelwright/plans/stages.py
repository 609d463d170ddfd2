"""Resumable stages by content identity.

A stage's output lies in a folder named by the hash of its inputs: settings, algorithm version and the identities of the
stages before it. A stage whose folder is complete is read, not run; changed inputs name another folder, which
invalidates everything behind them. Nothing is ever reset in place, so a crash leaves at most an unfinished folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.functions.scalars import identity
from parcelwright.sinks.files import exists, replace

VERSION = 1


@dataclass
class Run:
    """The stages of a run below ``root``."""

    spark: SparkSession
    root: str
    settings: dict[str, Any]
    identities: dict[str, str] = field(default_factory=dict)
    ran: list[str] = field(default_factory=list)

    def stage(self, name: str, build: Callable[[], DataFrame], after: tuple[str, ...] = (), inputs: Any = None, force: bool = False) -> DataFrame:
        """The output of a stage, made only if it isn't there."""
        self.identities[name] = identity({"stage": name, "version": VERSION, "settings": self.settings, "inputs": inputs, "after": [self.identities[a] for a in after]})
        path = f"{self.root}/{name}-{self.identities[name][:16]}"
        if force or not exists(self.spark, f"{path}/_SUCCESS"):
            part = f"{path}.part"
            build().write.mode("overwrite").parquet(part)
            replace(self.spark, part, path)
            self.ran.append(name)
        return self.spark.read.parquet(path)


def changed_blocks(stored: DataFrame, now: DataFrame) -> DataFrame:
    """Block ids of ``now`` (block_id, identity) that ``stored`` lacks or holds with another identity."""
    s = stored.select("block_id", F.col("identity").alias("_old"))
    return now.join(s, "block_id", "left").where(~F.col("identity").eqNullSafe(F.col("_old"))).select("block_id")


def block_identities(tiles: DataFrame) -> DataFrame:
    """Identity of a block from its tiles (block_id, sc_x, sc_y, sha): the hash of their sorted hashes."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sc_x", "sc_y", "sha"))), lambda t: F.concat_ws(",", t["sc_x"], t["sc_y"], t["sha"])), ";")
    return tiles.groupBy("block_id").agg(F.sha2(text.cast("binary"), 256).alias("identity"))


def consistent(shapes: DataFrame, metrics: DataFrame) -> DataFrame:
    """Blocks whose number of shapes differs from what their metrics say."""
    n = shapes.groupBy("block_id").agg(F.count_distinct("polygon_id").alias("n"))
    return metrics.join(n, "block_id", "full").where(F.coalesce("polygons", F.lit(0)) != F.coalesce("n", F.lit(0))).select("block_id")
