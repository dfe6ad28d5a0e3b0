"""Whitening of embeddings from a covariance weighted by multiplicity.

Components c become whole numbers ``x = floor(1024 c) + 100000``. Equal
x-vectors are grouped under their SHA-256; each distinct one carries its number
of rows, and is a fit row with that weight (``weights="count"``) or with weight
one. Sums are exact whole numbers. The covariance is the weighted product of
the centred distinct vectors, one matrix per task, added up entry by entry in
Spark, so only d x (d + 1) / 2 numbers reach the driver. Every distinct vector
is whitened once and joined back to its rows. The covariance of the whitened
vectors is measured in a pass of its own.

Defined results: rows whose vector is null, empty, holds a null or non-finite
component or one of 2^50 and more are dropped; rows with a null id and repeated
rows are rows like others; vectors of different lengths have a fit each; a
component without variance (eigenvalue within rounding of zero) has a null
``whitened``, and without any the identity error is null; a deviation beyond a
long is null; no rows give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import materialize
from epitrend.llm.vectors import digest, finite_vectors, matrices, spread_join

SCALE, SHIFT, COMPONENTS = 1024, 100000, 8
_MOST = float(1 << 50)


def coded(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dim, key, x``: the x-vector (64-bit whole numbers as bytes) of
    every usable row and its digest."""
    rows = finite_vectors(vectors, vector_col, id=F.col(id_col)) \
        .where(~F.exists("v", lambda c: F.abs(c) >= _MOST))
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        for b in batches:
            ids, v = b.column("id"), b.column("v")
            for at, m in matrices(v):
                x = (np.floor(m * SCALE) + SHIFT).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(np.full(len(at), m.shape[1], np.int32)),
                     pa.array([digest(r) for r in x]), pa.array([r.tobytes() for r in x])], names=["id", "dim", "key", "x"])

    return rows.mapInArrow(run, f"id {kind}, dim int, key binary, x binary")


def _by_dim(b: pd.DataFrame, col: str, kind: str):
    for d in np.unique(b["dim"]):
        g = b[b["dim"] == d]
        yield int(d), g, np.frombuffer(b"".join(g[col]), kind).reshape(len(g), -1)


def _exact(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted sums per column as Python's whole numbers."""
    if float(np.abs(x).max()) * float(w.sum()) < 2.0 ** 62:
        return (x * w[:, None]).sum(axis=0).astype(object)
    return (x.astype(object) * w.astype(object)[:, None]).sum(axis=0)


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: the weight n and the weighted sum of every dimension."""
    def run(batches):
        for b in batches:
            for d, g, x in _by_dim(b, "x", "<i8"):
                w = g["w"].to_numpy(np.int64)
                total = [w.sum(), *_exact(x, w)]
                yield pd.DataFrame({"dim": d, "j": np.arange(-1, d), "s": [Decimal(int(t)) for t in total]})

    rows = distinct.select("dim", "w", "x").mapInPandas(run, "dim int, j int, s decimal(38,0)") \
        .groupBy("dim", "j").agg(F.sum("s").alias("s")).orderBy("dim", "j").collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        if r["j"] < 0:
            out[r["dim"]] = (int(r["s"]), [])
        else:
            out[r["dim"]][1].append(int(r["s"]))
    return out


def _covariance(table: DataFrame, col: str, kind: str, n: dict[int, int], means: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per length, the weighted covariance (divisor n) of the centred rows."""
    def run(batches):
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for d, g, x in _by_dim(b, col, kind):
                c = x - means[d]
                p = (c * g["w"].to_numpy(np.float64)[:, None]).T @ c
                acc[d] = p if d not in acc else acc[d] + p
        for d, p in acc.items():
            i, j = np.triu_indices(len(p))
            yield pd.DataFrame({"dim": d, "i": i.astype(np.int32), "j": j.astype(np.int32), "s": p[i, j]})

    rows = table.select("dim", "w", col).mapInPandas(run, "dim int, i int, j int, s double") \
        .groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = {d: np.zeros((len(m), len(m))) for d, m in means.items()}
    for d, g in rows.groupby("dim"):
        i, j, s = g["i"].to_numpy(), g["j"].to_numpy(), g["s"].to_numpy() / n[d]
        out[d][i, j] = s
        out[d][j, i] = s
    return out


def _components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, their share of the trace, and axes divided by the square
    root of their eigenvalue, by falling eigenvalue; axes without variance are
    left out of the last."""
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:most], axes[:, ::-1][:, :most]
    trace = np.trace(v)
    some = e > len(v) * np.finfo(float).eps * trace
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(e))] < 0, -1.0, 1.0)
    share = np.maximum(e, 0) / trace if trace > 0 else np.zeros(len(e))
    return e, share, axes[:, some] / np.sqrt(e[some])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` per row, exact; None beyond a long."""
    most = n * float(np.abs(x).max()) + max(abs(s) for s in sums)
    if most < 2.0 ** 62:
        y = x * n - np.array(sums, np.int64)
        if float(np.abs(y).max()) ** 2 * x.shape[1] < 2.0 ** 62:
            return (y * y).sum(axis=1).tolist()
        y = y.astype(object)
    else:
        y = x.astype(object) * n - np.array(sums, object)
    return [int(t) if t < 1 << 63 else None for t in (y * y).sum(axis=1)]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for every usable row and component."""
    if weights not in ("count", "one"):
        raise ValueError(f"weights must be 'count' or 'one', not {weights!r}")
    spark = vectors.sparkSession
    rows = coded(vectors, id_col, vector_col)
    distinct = rows.groupBy("key", "dim", "x").agg(F.count(F.lit(1)).alias("rows"))
    distinct = materialize(distinct.withColumn("w", F.col("rows") if weights == "count" else F.lit(1).cast("long")), "distinct")
    sums = _sums(distinct)
    n = {d: s[0] for d, s in sums.items()}
    means = {d: np.array([float(s) / m if abs(s) < 1 << 53 else s / m for s in ss]) for d, (m, ss) in sums.items()}
    fits = {d: _components(v, components) for d, v in _covariance(distinct, "x", "<i8", n, means).items()}

    def project(batches):
        for b in batches:
            for d, g, x in _by_dim(b, "x", "<i8"):
                z = (x - means[d]) @ fits[d][2]
                yield pd.DataFrame({"key": g["key"], "dim": d, "w": g["w"], "rows": g["rows"],
                                    "deviation": pd.array(_deviations(x, *sums[d]), dtype="Int64"),
                                    "z": [r.tobytes() for r in np.ascontiguousarray(z)], "whitened": list(z)})

    white = materialize(distinct.mapInPandas(
        project, "key binary, dim int, w long, rows long, deviation long, z binary, whitened array<double>"), "whitened")
    some = {d: f[2].shape[1] for d, f in fits.items()}
    zs = white.select("dim", "w", "whitened").where(F.size("whitened") > 0)
    middle = {d: np.zeros(k) for d, k in some.items() if k}
    for r in zs.select("dim", "w", F.posexplode("whitened")).groupBy("dim", "pos") \
            .agg(F.sum(F.col("w") * F.col("col")).alias("s")).collect():
        middle[r["dim"]][r["pos"]] = r["s"] / n[r["dim"]]
    identity = {d: float(np.abs(v - np.eye(len(v))).max())
                for d, v in _covariance(white.where(F.size("whitened") > 0), "z", "<f8", n, middle).items()}
    facts = [(d, k + 1, n[d], float(share), identity.get(d))
             for d, (_, shares, _) in fits.items() for k, share in enumerate(shares)]
    facts = spark.createDataFrame(facts, "dim int, component int, n long, explained double, identity_error double")
    total = sum(r["rows"] for r in white.groupBy("dim").agg(F.sum("rows").alias("rows")).collect())
    each = spread_join(rows.select("id", "key"), white.select("key", "dim", "deviation", "whitened", "rows"),
                       "key", "rows", total)
    # ``facts`` has at most ``components`` rows for each length of vector.
    return (each.join(F.broadcast(facts), "dim")
            .select(F.col("id").alias(id_col), "component", "n", "deviation",
                    F.get("whitened", F.col("component") - 1).alias("whitened"), "explained", "identity_error"))
