"""Cutting lineage in the folder that driver and executors share.

A staged frame is a Parquet table below ``spark.checkpoint.dir``: it survives the loss of any executor, keeps column
pruning, and is compressed. Where the setting is absent in local mode (tests, a laptop) a folder of the driver's own is
set once; on a cluster that is an error, as executors would write to disks of their own. Staged tables last until their
``scope`` ends, at the latest until the interpreter does.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; one is set only where none is."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="parcelwright-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and return the frame that reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(staged: DataFrame) -> None:
    """Delete a staged table that nothing reads any more, such as an iteration's input once its output is written."""
    if path := getattr(staged, "_staged_path", None):
        _delete(staged.sparkSession, path)
        _written.remove((staged.sparkSession, path))


@contextmanager
def scope() -> Iterator[None]:
    """Delete what is staged inside once the block ends, such as after a query's result is written."""
    before = len(_written)
    try:
        yield
    finally:
        drop_staged(before)


def drop_staged(keep: int = 0) -> None:
    """Delete what ``stage`` has written, but for the first ``keep`` tables; frames that read it must not be used afterwards."""
    while len(_written) > keep:
        try:
            _delete(*_written.pop())
        except Exception:  # the session may have ended before us
            continue


atexit.register(drop_staged)
