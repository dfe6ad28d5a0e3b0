"""Helpers shared by the operators on embeddings."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HOT = 1000  # keys with more than this part of all rows are fewer than this


def finite_vectors(df: DataFrame, vector_col: str, **keep: Column) -> DataFrame:
    """``v`` (array<double>) and the columns ``keep`` of the rows whose vector
    is not null or empty and holds no null or non-finite component."""
    rows = df.select(*[c.alias(name) for name, c in keep.items()],
                     F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)


def matrices(col: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column without nulls and their values as a matrix, one
    pair per length of list."""
    ends = col.offsets.to_numpy()
    values = col.values.to_numpy(zero_copy_only=False)
    length = np.diff(ends)
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, values[ends[rows][:, None] + np.arange(d)]


def digest(row: np.ndarray) -> bytes:
    """The key of equal rows: 32 bytes of SHA-256."""
    return hashlib.sha256(row.tobytes()).digest()


def runs(batches: Iterator[pd.DataFrame], keys: Sequence[str], limit: int) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal ``keys``, ``limit`` at most, across batches.
    Each task cuts its own sorted rows, so nothing is gathered by key."""
    rest: pd.DataFrame | None = None
    for b in batches:
        if not len(b):
            continue
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        new = np.zeros(len(b), bool)
        for k in keys:
            v = b[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(new), [len(b)]])
        for s, e in zip(cuts[:-1], cuts[1:]):
            while e - s > limit:
                yield b.iloc[s:s + limit]
                s += limit
            if e < len(b):
                yield b.iloc[s:e]
            else:
                rest = b.iloc[s:e]
    if rest is not None and len(rest):
        yield rest


def pack(df: DataFrame, order: Sequence[str], keys: Sequence[str], limit: int,
         emit: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """``df`` sorted by ``order`` over all tasks and cut into runs of rows with
    equal ``keys``; ``emit`` makes rows of ``schema`` from a run. ``part`` and
    ``seq`` lead each row and rise with the order."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        seq = 0
        for g in runs(batches, keys, limit):
            out = emit(g)
            frame = pd.DataFrame(out, columns=names)
            frame.insert(0, "seq", np.arange(seq, seq + len(out), dtype=np.int64))
            frame.insert(0, "part", np.full(len(out), g["part"].iloc[0], np.int32))
            seq += len(out)
            yield frame

    return laid.mapInPandas(run, f"part int, seq long, {schema}")


def spread_join(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` joined with the one row of ``table`` that has their ``key``.

    ``weight`` is the number of rows of a key and ``total`` that of all rows.
    Keys with more than a thousandth of all rows are fewer than a thousand:
    their table rows are broadcast, and their rows are not shuffled."""
    hot = F.col(weight) * _HOT > total
    far = table.where(~hot).drop(weight)
    near = table.where(hot).drop(weight)
    cols = [c for c in near.columns if c != key]
    marked = rows.join(F.broadcast(near.withColumn("_hot", F.lit(True))), key, "left")
    return marked.where("_hot").drop("_hot").unionByName(
        marked.where("_hot is null").drop("_hot", *cols).join(far, key))
