"""Approximate nearest neighbours by shifted space-filling curves.

Distinct vectors are projected onto ``DIMS`` random orthonormal directions and
placed, with a random shift, on a grid of 2^``BITS`` cells a side. The position
of the cell on a Hilbert curve is the key. ``CURVES`` such orderings, each with
directions and a shift of its own, are range-partitioned and sorted by Spark
and cut into blocks of ``BLOCK`` rows. A query stands somewhere on each curve;
the blocks within ``window`` ranks of it are searched, each gives its nearest
vectors, and the lists of all curves merge and are ranked by the exact distance.

The grid is fitted on ``SAMPLE`` vectors. The window is calibrated: for
``TRIALS`` queries the true neighbours are found by brute force, and the window
is the smallest that holds ``recall`` of them on one curve at least. Vectors
without structure have no order that keeps neighbours together, so their window
grows with the table and most of the table is searched; for clustered vectors
it stays small. A window is ``LEAST`` ranks or more, so up to ``LEAST`` + 1
distinct vectors are searched whole and the result is exact.

Equal vectors are one class, searched once, that carries its ``k + 1`` smallest
ids: a group of copies of any size neither fills a window nor a task.

Defined results: rows whose vector is null, empty, zero or holds a null or
non-finite component, and rows with a null id, take no part; rows of one id with
one vector are one row; vectors of different lengths are not compared; equal
distances go by the smaller id; no rows give an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitrend.llm.common import materialize
from epitrend.llm.vectors import digest, finite_vectors, matrices, pack, spread_join

CURVES, DIMS, BITS = 8, 6, 10
BLOCK, LEAST = 4096, 2048
SAMPLE, TRIALS, RECALL, K = 4096, 128, 0.95, 10


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of every row of grid cells: the axes are
    turned into the curve's transposed index (Gray code of the reflected and
    exchanged axes, from the highest bit down), whose bits are interleaved."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(dims):
            flip = (x[i] >> bit) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(cells.shape[0], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def directions(dim: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions of a curve and its shift in cells' share."""
    rng = np.random.Generator(np.random.PCG64([dim, curve]))
    axes = np.linalg.qr(rng.standard_normal((dim, min(dim, DIMS))))[0]
    return axes, rng.uniform(-0.125, 0.125, axes.shape[1])


class _Grid:
    """Centre and half width of a length of vectors, from the sample."""

    def __init__(self, sample: dict[int, np.ndarray]):
        self.fit = {d: (m.mean(axis=0), 3 * max(float(m.std(axis=0).mean()), 1e-300)) for d, m in sample.items()}

    def keys(self, m: np.ndarray, curve: int) -> np.ndarray:
        d = m.shape[1]
        middle, half = self.fit.get(d, (np.zeros(d), 1.0))
        axes, shift = directions(d, curve)
        with np.errstate(over="ignore", invalid="ignore"):
            y = ((m - middle) @ axes / (2 * half) + 0.5 + shift) * (1 << BITS)
        return hilbert_keys(np.clip(np.nan_to_num(y), 0, (1 << BITS) - 1), BITS)


def _classes(vectors: DataFrame, id_col: str, vector_col: str, query: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors ``cid, dim, v, ids, first, asked`` and the rows
    ``cid, id, asked`` behind them."""
    rows = finite_vectors(vectors, vector_col, id=F.col(id_col).cast("long"), asked=F.coalesce(query, F.lit(False))) \
        .where("id is not null").where(F.exists("v", lambda x: x != 0))

    # Vectors of floats stay floats where they are stored; all sums are doubles.
    stored = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"

    def run(batches):
        for b in batches:
            for at, m in matrices(b.column("v")):
                m = (m + 0.0).astype(stored)  # no negative zero
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(r) for r in m]), b.column("id").take(take), b.column("asked").take(take),
                     pa.array(np.full(len(at), m.shape[1], np.int32)), pa.array([r.tobytes() for r in m])],
                    names=["cid", "id", "asked", "dim", "v"])

    every = rows.mapInArrow(run, "cid binary, id long, asked boolean, dim int, v binary")
    members = materialize(every.groupBy("cid", "id", "asked").agg(F.count(F.lit(1)).alias("rows")).drop("rows"), "members")
    order = Window.partitionBy("cid").orderBy("id")
    ids = members.select("cid", "id").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1) \
        .groupBy("cid").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = members.groupBy("cid").agg(F.max("asked").alias("asked"))
    distinct = every.groupBy("cid", "dim", "v").agg(F.count(F.lit(1)).alias("rows")).drop("rows")
    classes = distinct.join(ids, "cid").join(asked, "cid").withColumn("first", F.get("ids", F.lit(0)))
    return materialize(classes, "classes"), members


def _matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Stored vectors as rows of doubles."""
    width = len(vectors[0]) // dim
    return np.frombuffer(b"".join(vectors), f"<f{width}").reshape(-1, dim).astype(np.float64)


def nearest(q: np.ndarray, x: np.ndarray, allowed: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row of ``q`` the places in ``x`` of the ``k`` nearest allowed rows,
    with ties at the last, and their distances."""
    # Products find the few rows that may be among the nearest, with room for
    # rounding; their distances are computed from the differences.
    norms = (x * x).sum(axis=1)
    near = (q * q).sum(axis=1)[:, None] + norms[None, :] - 2 * (q @ x.T)
    room = 1e-9 * ((q * q).sum(axis=1) + norms.max(initial=0.0))
    near[~allowed] = np.inf
    out = []
    for i in range(len(q)):
        n = min(k, int(allowed[i].sum()))
        if not np.isfinite(room[i]):  # squares overflow
            at = np.flatnonzero(allowed[i])
        elif n == 0:
            at = np.zeros(0, np.int64)
        else:
            at = np.flatnonzero(near[i] <= np.partition(near[i], n - 1)[n - 1] + room[i])
        diff = x[at] - q[i]
        top = np.abs(diff).max(axis=1, initial=0.0)
        scale = np.where((top > 1e-140) & (top < 1e140), 1.0, np.where(top == 0, 1.0, top))  # no overflow
        out.append((at, scale * np.sqrt(((diff / scale[:, None]) ** 2).sum(axis=1))))
    return out


def _best(dist: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((first, dist))[:k]


def _some(rows: DataFrame, n: int) -> pd.DataFrame:
    """Up to ``n`` rows, those of the smallest hashes. The tasks send about
    twice as many between them, however many tasks there are."""
    share = min(1.0, 2 * n / max(1, rows.count()))
    few = rows.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < math.ceil(share * (1 << 30)))
    return few.orderBy(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)), "cid").limit(n).toPandas()


def build_index(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The curves' blocks (``part, seq, curve, dim, n, cids, firsts, asked, v``)
    and their headers with the rank of their first row."""
    pick = _some(classes.select("cid", "dim", "v"), SAMPLE)
    grid = _Grid({int(d): _matrix(list(g["v"]), int(d)) for d, g in pick.groupby("dim")})

    def place(batches):
        for b in batches:
            for d in np.unique(b["dim"]):
                g = b[b["dim"] == d]
                m = _matrix(list(g["v"]), int(d))
                for c in range(CURVES):
                    yield g.assign(curve=np.int32(c), key=grid.keys(m, c))

    placed = classes.select("cid", "dim", "first", "asked", "v").mapInPandas(
        place, "cid binary, dim int, first long, asked boolean, v binary, curve int, key long")

    def emit(g: pd.DataFrame) -> list[tuple]:
        return [(int(g["curve"].iloc[0]), int(g["dim"].iloc[0]), len(g), b"".join(g["cid"]),
                 g["first"].to_numpy("<i8").tobytes(), g["asked"].to_numpy(bool).tobytes(), b"".join(g["v"]))]

    blocks = materialize(pack(placed, ["curve", "dim", "key", "cid"], ["curve", "dim"], BLOCK, emit,
                              "curve int, dim int, n int, cids binary, firsts binary, asked binary, v binary"), "curves")
    before = Window.partitionBy("curve", "dim").orderBy("part", "seq")
    headers = blocks.select("part", "seq", "curve", "dim", "n").withColumn(
        "start", F.sum("n").over(before) - F.col("n"))
    return blocks, materialize(headers, "headers")


def _split(raw: bytes, size: int) -> list[bytes]:
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def _ranks(blocks: DataFrame, headers: DataFrame, chosen=None) -> DataFrame:
    """``curve, dim, rank, cid`` of the asked classes, or of the ``chosen``."""
    wanted = None if chosen is None else frozenset(chosen)

    def run(batches):
        for b in batches:
            for part, seq, cids, asked in zip(b["part"], b["seq"], b["cids"], b["asked"]):
                names = _split(cids, 32)
                at = np.flatnonzero(np.frombuffer(asked, bool)) if wanted is None else \
                    [i for i, c in enumerate(names) if c in wanted]
                yield pd.DataFrame({"part": part, "seq": seq, "at": np.array(at, np.int32), "cid": [names[i] for i in at]})

    found = blocks.select("part", "seq", "cids", "asked").mapInPandas(run, "part int, seq long, at int, cid binary")
    return found.join(headers, ["part", "seq"]).select("curve", "dim", (F.col("start") + F.col("at")).alias("rank"), "cid")


def calibrate(classes: DataFrame, blocks: DataFrame, headers: DataFrame, recall: float, k: int) -> int:
    """The window that holds ``recall`` of the true neighbours of the trials."""
    largest = headers.groupBy("curve", "dim").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    if largest is None or largest <= LEAST + 1:
        return LEAST
    trials = _some(classes.where("asked").select("cid", "dim", "v"), TRIALS)
    if not len(trials):
        return LEAST
    by_dim = {int(d): (list(g["cid"]), _matrix(list(g["v"]), int(d))) for d, g in trials.groupby("dim")}

    def brute(batches):
        for b in batches:
            for d, (names, q) in by_dim.items():
                g = b[b["dim"] == d]
                if len(g):
                    own = np.array([[c != n for c in g["cid"]] for n in names])
                    for n, (at, dist) in zip(names, nearest(q, _matrix(list(g["v"]), d), own, k)):
                        top = _best(dist, g["first"].to_numpy()[at], k)
                        yield pd.DataFrame({"q": [n] * len(top), "cid": [g["cid"].iloc[i] for i in at[top]],
                                            "d": dist[top], "first": g["first"].to_numpy()[at[top]]})

    order = Window.partitionBy("q").orderBy("d", "first")
    truth = classes.select("cid", "dim", "first", "v").mapInPandas(brute, "q binary, cid binary, d double, first long") \
        .withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("q", "cid").collect()
    wanted = {c for r in truth for c in r}
    rank = {(r["cid"], r["curve"]): r["rank"] for r in _ranks(blocks, headers, wanted).collect()}
    gaps = sorted(min(abs(rank[r["q"], c] - rank[r["cid"], c]) for c in range(CURVES)) for r in truth)
    return max(LEAST, gaps[math.ceil(recall * len(gaps)) - 1]) if gaps else LEAST


def search(vectors: DataFrame, query: Column | None = None, k: int = K, recall: float = RECALL,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that fits ``query`` (a
    condition on ``vectors``; default: an id divisible by 100) the ``k`` nearest
    other rows found, nearest first."""
    query = F.col(id_col) % 100 == 0 if query is None else query
    classes, members = _classes(vectors, id_col, vector_col, query, k)
    blocks, headers = build_index(classes)
    window = calibrate(classes, blocks, headers, recall, k)
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.expr(lo) / BLOCK), F.floor(F.expr(hi) / BLOCK)))
    held = headers.withColumn("bin", bins("start", "start + n - 1"))
    asked = _ranks(blocks, headers).withColumn("lo", F.greatest(F.col("rank") - window, F.lit(0))) \
        .withColumn("bin", bins("lo", f"rank + {window}"))
    met = asked.join(held, ["curve", "dim", "bin"]) \
        .where((F.col("start") <= F.col("rank") + window) & (F.col("start") + F.col("n") > F.col("lo"))) \
        .where(F.col("bin") == F.greatest(F.floor(F.col("start") / BLOCK), F.floor(F.col("lo") / BLOCK))) \
        .select("part", "seq", "start", "cid", "rank", F.floor(F.col("rank") / BLOCK).alias("chunk"))
    # A chunk holds queries of one stretch of a curve, so BLOCK at most.
    chunks = met.join(classes.where("asked").select("cid", "v"), "cid").groupBy("part", "seq", "start", "chunk") \
        .agg(F.collect_list(F.struct("cid", "rank", F.col("v").alias("q"))).alias("queries"))

    def rerank(batches):
        for b in batches:
            for r in b.itertuples(index=False):
                firsts, names = np.frombuffer(r.firsts, "<i8"), _split(r.cids, 32)
                x = _matrix(_split(r.v, len(r.v) // len(names)), r.dim)
                place = r.start + np.arange(len(x))
                for s in range(0, len(r.queries), 256):
                    part = r.queries[s:s + 256]
                    rank = np.array([p["rank"] for p in part])
                    far = np.abs(place[None, :] - rank[:, None])
                    found = nearest(_matrix([p["q"] for p in part], r.dim), x, (far <= window) & (far > 0), k)
                    out = []
                    for p, (at, dist) in zip(part, found):
                        top = _best(dist, firsts[at], k)
                        out += [(p["cid"], names[i], int(firsts[i]), float(d)) for i, d in zip(at[top], dist[top])]
                    yield pd.DataFrame(out, columns=["q", "cid", "first", "score"])

    found = blocks.select("part", "seq", "dim", "cids", "firsts", "v").join(chunks, ["part", "seq"]) \
        .mapInPandas(rerank, "q binary, cid binary, first long, score double")
    best = Window.partitionBy("q").orderBy("score", "first", "cid")
    merged = found.dropDuplicates(["q", "cid"]).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
    own = classes.where("asked").select(F.col("cid").alias("q"), "cid", F.lit(0.0).alias("score"))
    near = merged.select("q", "cid", "score").unionByName(own).join(classes.select("cid", "ids"), "cid") \
        .select("q", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    answers = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1) \
        .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    queries = members.where("asked").select("cid", F.col("id").alias("query_id"))
    weights = queries.groupBy("cid").agg(F.count(F.lit(1)).alias("rows"))
    answers = materialize(answers.withColumnRenamed("q", "cid").join(weights, "cid"), "answers")
    total = answers.agg(F.sum("rows")).first()[0] or 0
    each = spread_join(queries, answers, "cid", "rows", total)
    others = F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(others).alias("at", "n")) \
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))
