"""Column builders shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times, also inside lambdas, whatever the optimizer collapses."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order, as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def block(array: Column, i: Column, size: int) -> Column:
    """The i-th run of ``size`` elements of an array (the last may be shorter), in time that grows with the run only."""
    return F.transform(F.sequence(i * size, F.least((i + 1) * size, F.size(array)) - 1), lambda j: F.get(array, j))


def blocks(array: Column, size: int) -> Column:
    """The numbers of the runs of ``size`` elements of an array; none of an empty one."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), ((F.size(array) - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>"))


def documents(spark, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as one struct ``row``, so that no column of it can clash with a name of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
