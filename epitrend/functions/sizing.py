"""Broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 64 << 20


def _row_bytes(df: DataFrame):
    """About the bytes of a row: its text and binary columns, 16 for any other."""
    parts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) if t in ("string", "binary") else F.lit(16)
             for c, t in df.dtypes]
    return sum(parts, F.lit(16)).cast("long")


def broadcast_if_bounded(df: DataFrame, max_rows: int, materialize: bool = False,
                         max_bytes: int = MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows and
    about ``max_bytes`` bytes.

    ``materialize=True`` first checkpoints ``df`` to the shared checkpoint
    folder (for a small aggregate of a large input: it is computed once, and
    survives executor loss). Beyond a bound the frame is returned unmarked,
    so the join falls back to a shuffle join (AQE may still pick a broadcast
    from runtime sizes)."""
    if materialize:
        from epitrend.session import checkpoint_root

        checkpoint_root(df.sparkSession)
        df = df.checkpoint(eager=True)
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df
