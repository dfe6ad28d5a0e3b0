"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epitrend.session import delete_folder, scratch_path


_CLEAR: list[Callable[[], None]] = []
_USE = [""]


def on_other_use(clear: Callable[[], None]) -> None:
    """Have ``clear`` called when this Python worker goes on to other work."""
    _CLEAR.append(clear)


def begin_task(use: str) -> None:
    """The first thing a task's function calls: Spark reuses Python workers, so
    what tasks of another use keep in this one is dropped."""
    if _USE[0] != use:
        _USE[0] = use
        for clear in _CLEAR:
            clear()


def text_or_empty(col: str = "text") -> Column:
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """One table of the given folder, read through Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_MADE: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """On leaving, deletes the tables that ``materialize`` has written inside,
    but for those whose paths were put in the list."""
    start, keep = len(_MADE), []
    try:
        yield keep
    finally:
        for path in _MADE[start:]:
            if path not in keep:
                delete_folder(spark, path)
        _MADE[start:] = keep


def store(df: DataFrame, name: str) -> str:
    """Write ``df`` to the shared scratch folder; its path."""
    path = scratch_path(df.sparkSession, name)
    _MADE.append(path)
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage like ``checkpoint`` does, keeps the columnar layout
    and survives lost executors. Used for tables that several later jobs read."""
    path = store(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_on(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols``, null equal to null; the columns come once."""
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in cols})
    on = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in cols]
    return left.join(other, on, how).drop(*[f"_right_{c}" for c in cols])
