"""Near-duplicate embeddings by collision-counting projections.

Unit vectors are projected onto ``PROJECTIONS`` random directions. For two
vectors at the threshold's distance, a projection differs by a normal variate
of that deviation, so a window of 1.5 deviations around the query holds the
other vector with probability 0.866. The projections of a block are sorted,
each query's window is found by binary search, and the collisions per pair are
counted; pairs with at least ``least_count`` of them are verified by cosine in
double precision. ``least_count`` is calibrated so that a pair at the
threshold passes with probability 1 - ``miss``.

Equal vectors of one label are one class with a multiplicity. Classes are
range-sorted by label and first projection into blocks; two blocks of a label
meet when their ranges come within 5 deviations. A meeting yields each class's
number of links and a spanning forest of the links found, never all pairs.
Work inside a label still grows with the square of its different vectors: the
method counts collisions for every pair whose first projections are near.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or id, link with nothing; vectors of
different lengths are not compared; rows of one ``vec_id`` with one vector are
one vector; a cosine equal to the threshold links; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import materialize
from epitrend.llm.components import components

PROJECTIONS = 32
THRESHOLD = 0.93
BLOCK = 512
_WIDTH, _FAR, _MISS = 1.5, 5.0, 1e-4


def directions(dim: int, n: int = PROJECTIONS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, n))


def least_count(n: int = PROJECTIONS, miss: float = _MISS) -> int:
    """The largest count that a pair at the threshold reaches with probability
    at least ``1 - miss``."""
    p = math.erf(_WIDTH / math.sqrt(2))
    tail, c = 0.0, 0
    while True:
        tail += math.comb(n, c) * p ** c * (1 - p) ** (n - c)
        if tail > miss:
            return c
        c += 1


def deviation(threshold: float) -> float:
    """Distance of two unit vectors at this cosine."""
    return math.sqrt(2 - 2 * threshold)


def count_collisions(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """Per pair, the projections in which ``b`` lies in the window around ``a``."""
    counts = np.zeros((len(a), len(b)), np.uint8)
    for p in range(a.shape[1]):
        order = np.argsort(b[:, p], kind="stable")
        rank = np.empty(len(b), np.int16)
        rank[order] = np.arange(len(b), dtype=np.int16)
        line = b[order, p]
        lo = np.searchsorted(line, a[:, p] - width, "left").astype(np.int16)
        hi = np.searchsorted(line, a[:, p] + width, "right").astype(np.int16)
        counts += (rank >= lo[:, None]) & (rank < hi[:, None])
    return counts


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _links(ids, weight, u, jds, jweight, v, same: bool, threshold: float, least: int) -> pd.DataFrame:
    """Links of two blocks: per class its number of linked vectors in the other
    block, and a forest of links."""
    axes = directions(u.shape[1])
    counts = count_collisions(u @ axes, v @ axes, _WIDTH * deviation(threshold))
    i, j = np.nonzero(counts >= least)
    if same:
        i, j = i[i < j], j[i < j]
    ok = np.zeros(len(i), bool)
    for s in range(0, len(i), 65536):
        ok[s:s + 65536] = np.einsum("ij,ij->i", u[i[s:s + 65536]], v[j[s:s + 65536]]) >= threshold
    i, j = i[ok], j[ok]
    left = np.bincount(i, jweight[j], len(u))
    right = np.bincount(j, weight[i], len(v))
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest = []
    for a, b in zip(ids[i].tolist(), jds[j].tolist()):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            forest.append((a, b))
    if same:
        left, right = left + right, right[:0]
    rows = [(int(k), 0, int(n)) for k, n in zip(ids, left) if n] + \
           [(int(k), 0, int(n)) for k, n in zip(jds, right) if n]
    return pd.DataFrame(rows + [(a, b, -1) for a, b in forest], columns=["a", "b", "n"])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label",
                    block_rows: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    least = least_count()
    vec = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                      & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0))
    good = good.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), "v")})
    key = ["label", "h1", "h2"]
    classes = good.select("id", *key).distinct().groupBy(*key).agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    members = materialize(good.select("id", *key).distinct().join(classes, key).select("id", "rep", "weight"), "classes")
    reps = good.join(members.where("id = rep").select("id", "weight"), "id").dropDuplicates(["id", *key])

    def first(batches):
        for b in batches:
            out = np.zeros(len(b))
            for n in b["v"].map(len).unique():
                at = (b["v"].map(len) == n).to_numpy()
                out[at] = _unit(b["v"][at]) @ directions(n)[:, 0]
            yield b.assign(p=out)

    schema = ", ".join(f"{c} {t}" for c, t in reps.select("id", "label", "v", "weight").dtypes)
    reps = materialize(reps.select("id", "label", "v", "weight").mapInPandas(first, schema + ", p double"), "projected")
    blocks = 16 + reps.count() // block_rows
    label_type = dict(reps.dtypes)["label"]
    reps = materialize(reps.withColumn("dim", F.size("v")).repartitionByRange(blocks, "label", "dim", "p")
                       .withColumn("block", F.spark_partition_id()), "sorted")

    def gather(g: pd.DataFrame) -> pd.DataFrame:
        n = (len(g) + block_rows - 1) // block_rows  # ties may overfill a range
        out = []
        g = g.sort_values(["p", "id"])
        for k in range(n):
            s = g.iloc[k * block_rows:(k + 1) * block_rows]
            out.append((g["label"].iloc[0], int(g["dim"].iloc[0]), f"{int(g['block'].iloc[0])}/{k}", s["p"].min(), s["p"].max(),
                        s["id"].to_numpy(np.int64).tobytes(), s["weight"].to_numpy(np.int64).tobytes(),
                        _unit(s["v"]).tobytes()))
        return pd.DataFrame(out, columns=["label", "dim", "name", "lo", "hi", "ids", "weights", "units"])

    packed = materialize(reps.groupBy("label", "dim", "block").applyInPandas(
        gather, f"label {label_type}, dim int, name string, lo double, hi double, ids binary, weights binary, units binary"), "packed")
    packed = packed.withColumn("key", F.concat_ws("/", F.col("label").cast("string"), "dim", "name"))
    near = _FAR * deviation(threshold)
    ends = packed.select("label", "dim", "key", "lo", "hi")
    x, y = ends.alias("x"), ends.alias("y")
    pairs = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.dim") == F.col("y.dim"))
                   & (F.col("x.key") <= F.col("y.key")) & (F.col("x.lo") <= F.col("y.hi") + near)
                   & (F.col("y.lo") <= F.col("x.hi") + near)) \
        .select(F.col("x.key").alias("k1"), F.col("y.key").alias("k2"))
    side = lambda n: packed.select(F.col("key").alias(f"k{n}"), *[F.col(c).alias(f"{c}{n}") for c in ("ids", "weights", "units")])
    met = pairs.join(side(1), "k1").join(side(2), "k2").select("k1", "k2", "ids1", "weights1", "units1", "ids2", "weights2", "units2")

    def meet(batches):
        for b in batches:
            for r in b.itertuples(index=False):
                i, j = np.frombuffer(r.ids1, np.int64), np.frombuffer(r.ids2, np.int64)
                yield _links(i, np.frombuffer(r.weights1, np.int64), np.frombuffer(r.units1).reshape(len(i), -1),
                             j, np.frombuffer(r.weights2, np.int64), np.frombuffer(r.units2).reshape(len(j), -1),
                             r.k1 == r.k2, threshold, least)

    found = materialize(met.mapInPandas(meet, "a long, b long, n long"), "links")
    linked = found.where("n >= 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    copies = members.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    label = components(found.where("n < 0").select("a", "b").unionByName(copies))
    links = members.join(linked, "rep", "left").groupBy(F.col("id").alias("node")) \
        .agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"))
    return (rows.select("id").join(links, F.col("id") == links["node"], "left").drop("node")
            .join(label, F.col("id") == label["node"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"),
                    F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept")))
