"""The most similar entities of every entity, not of one baseline.

An exact L1 search over distinct rows. Entities with equal features are one vector with its
first k + 1 names: where that many share it, they are each other's neighbours and nothing
is searched. The other vectors look for theirs among all vectors, which lie in cells along a
Z curve over their distances to some pivots. Each cell states the range of every feature and
of the distance to every pivot. A vector first searches its own block, which bounds how
far its k-th neighbour can be; then it goes to those cells alone that may hold anything
within that bound: by their feature ranges, and by the triangle inequality
``|d(x, p) - d(y, p)| <= d(x, y)`` for every pivot. The cells are found down a tree of their
ranges, and only a vector travels there, not its block. No pair of rows leaves a task, only k
names for each vector and block.

How much that saves follows from the data: much where rows lie in clusters or share their
features, little where seven features spread evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitrend.config import ENTITY, TOP_K
from epitrend.operators.cluster import materialize
from epitrend.operators.compare import _feature_cols

PIVOTS, BLOCK, SAMPLE = 12, 128, 2048
# Of a cell, rows in the sample; the sample and so the cells are bounded, whatever the rows.
_PER_CELL, _MOST_SAMPLED = 8, 1 << 17
_CURVE_PIVOTS, _CURVE_BITS, _FANOUT, _TABLE = 6, 4, 8, 1 << 20


def spread_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` rows of ``sample``, each the farthest from those before it
    (the first: from the middle)."""
    away = np.abs(sample - sample.mean(axis=0)).sum(axis=1)
    chosen = []
    for _ in range(min(n, len(sample))):
        k = int(away.argmax())
        if chosen and away[k] == 0:
            break
        chosen.append(k)
        own = np.abs(sample - sample[k]).sum(axis=1)
        away = own if len(chosen) == 1 else np.minimum(away, own)
    return sample[chosen]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """L1 distances of all rows of ``x`` to all of ``y``, added up feature by feature."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        out += np.abs(x[:, j, None] - y[None, :, j])
    return out


def _slices(n: int, width: int):
    """Rows of a table with ``n`` rows of ``width`` in pieces of bounded size."""
    step = max(1, _TABLE // max(1, width))
    return (slice(i, i + step) for i in range(0, n, step))


def _reach(x: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Per vector of a block, how far its k-th neighbour can be: -1 where equal rows are
    neighbours enough, infinite where the block holds too few."""
    out = np.full(len(x), -1.0)
    seeking = np.flatnonzero(sizes <= k)
    for part in _slices(len(seeking), len(x)):
        at = seeking[part]
        every = _apart(x[at], x)
        order = every.argsort(axis=1)
        many = sizes[order].cumsum(axis=1)
        enough = many > k  # itself is among them
        last = enough.argmax(axis=1)
        found = every[np.arange(len(at)), order[np.arange(len(at)), last]]
        out[at] = np.where(enough.any(axis=1), found, np.inf)
    return out


def _nearest(x: np.ndarray, bound: np.ndarray, y: np.ndarray, names: Sequence[Sequence], k: int):
    """``place, name, distance`` of the ``k`` nearest names (names decide ties) within
    its bound for every row of ``x``, equal rows left out."""
    for part in _slices(len(x), len(y)):
        every = _apart(x[part], y)
        fits = np.isfinite(every) & (every > 0) & (every <= bound[part, None])
        for i in np.flatnonzero(fits.any(axis=1)):
            at = np.flatnonzero(fits[i])
            d = every[i, at]
            if len(at) > k:  # all that tie with the k-th stay until names decide
                near = d <= np.partition(d, k - 1)[k - 1]
                at, d = at[near], d[near]
            for far, name in sorted((far, name) for j, far in zip(at, d.tolist()) for name in names[j][:k])[:k]:
                yield part.start + int(i), name, far


def curve_place(away: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Places on a Z curve: the bins of the distances, bits interleaved."""
    bins = [np.searchsorted(e, away[:, i], "right") for i, e in enumerate(edges)]
    out = np.zeros(len(away), np.int64)
    for bit in range(_CURVE_BITS - 1, -1, -1):
        for b in bins:
            out = (out << 1) | ((b >> bit) & 1)
    return out


def _matrix(col) -> np.ndarray:
    return np.array(col.tolist(), float)


def _levels(low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A tree of ranges: those of the cells, then of ``_FANOUT`` neighbours each, up to few."""
    out = [(low, high)]
    while len(out[-1][0]) > _FANOUT:
        starts = np.arange(0, len(out[-1][0]), _FANOUT)
        out.append((np.minimum.reduceat(out[-1][0], starts), np.maximum.reduceat(out[-1][1], starts)))
    return out


def _cells_within(x: np.ndarray, away: np.ndarray, bound: np.ndarray, levels) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and numbers of the cells that may hold rows within its bound."""
    width, both = x.shape[1], np.hstack([x, away])
    top = len(levels[-1][0])
    row, node = np.repeat(np.arange(len(x)), top), np.tile(np.arange(top), len(x))
    for depth, (low, high) in reversed(list(enumerate(levels))):
        box, gap = np.zeros(len(row)), np.zeros(len(row))
        for j in range(both.shape[1]):
            v = both[row, j]
            out = np.maximum(np.maximum(low[node, j] - v, v - high[node, j]), 0)
            if j < width:
                box += out
            else:
                gap = np.maximum(gap, out)
        # Distances to pivots are rounded: a little slack keeps what lies on the bound.
        keep = (box <= bound[row]) & (gap * (1 - 1e-9) <= bound[row])
        row, node = row[keep], node[keep]
        if depth:
            below = (node[:, None] * _FANOUT + np.arange(_FANOUT)).ravel()
            row = np.repeat(row, _FANOUT)
            real = below < len(levels[depth - 1][0])
            row, node = row[real], below[real]
    return row, node


def _loose_bound(x: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """How far the k-th neighbour can be, from the cells' ranges and numbers of vectors."""
    far = np.zeros((len(x), len(low)))
    for j in range(x.shape[1]):
        far += np.maximum(np.abs(x[:, j, None] - low[None, :, j]), np.abs(x[:, j, None] - high[None, :, j]))
    order = far.argsort(axis=1)
    enough = n[order].cumsum(axis=1) > k
    last = order[np.arange(len(x)), enough.argmax(axis=1)]
    return np.where(enough.any(axis=1), far[np.arange(len(x)), last], np.inf)


def nearest_entities(features: DataFrame, k: int = TOP_K, cols: Sequence[str] | None = None, entity: str = ENTITY,
                     pivots: int = PIVOTS, block_rows: int = BLOCK) -> DataFrame:
    """``entity, neighbour, rank, distance``: for every entity the ``k`` others
    with the least L1 distance over the feature columns (ties by name), the
    rows that ``baseline_diff`` and ``similar_entities`` give with that entity as the
    baseline. Entities with a null name or feature take no part, those with one that is
    not finite have no neighbours; names are unique, as in the feature table.

    The result is exact whatever the pivots and cells, which are drawn from a bounded
    sample; ``compared_pairs`` tells how many pairs of rows they leave."""
    rows = _rows(features, cols, entity)
    vectors = _vectors(rows, k)
    found = _search(vectors, k, pivots, block_rows, False)
    best = Window.partitionBy("id").orderBy("distance", "neighbour")
    near = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))).alias("near"))
    lists = vectors.join(near, "id", "left").select("x", "names", "near")
    equal = F.transform(F.filter("names", lambda n: n != F.col("name")),
                        lambda n: F.struct(F.lit(0.0).alias("distance"), n.alias("neighbour")))
    every = F.slice(F.concat(equal, F.coalesce("near", F.array().cast(near.schema["near"].dataType))), 1, k)
    return rows.join(lists, "x").select("name", F.posexplode(every).alias("at", "r")) \
        .select(F.col("name").alias(entity), "r.neighbour", (F.col("at") + 1).alias("rank"), "r.distance")


def _rows(features: DataFrame, cols: Sequence[str] | None, entity: str) -> DataFrame:
    """``name, x`` of the entities that can have neighbours, stored."""
    names = _feature_cols(features, cols, entity)
    x = F.array(*[F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in names])  # -0.0 as 0.0
    return materialize(features.select(F.col(entity).alias("name"), x.alias("x"))
                       .where(F.col("name").isNotNull() & F.forall("x", lambda v: F.abs(v) < float("inf"))))


def _vectors(rows: DataFrame, k: int) -> DataFrame:
    """``id, x, names``: the distinct vectors with their first ``k + 1`` names, stored. Rows
    beyond those are dropped before the shuffle (Spark's window group limit)."""
    first = F.row_number().over(Window.partitionBy("x").orderBy("name"))
    return materialize(rows.withColumn("_at", first).where(F.col("_at") <= k + 1)
                       .groupBy("x").agg(F.array_sort(F.collect_list("name")).alias("names"))
                       .withColumn("id", F.monotonically_increasing_id()))


def _search(vectors: DataFrame, k: int, pivots: int, block_rows: int, count: bool) -> DataFrame:
    """``id, neighbour, distance`` of the candidates among other vectors, or with ``count`` the
    numbers of pairs ``n`` compared."""
    kind = dict(vectors.dtypes)["names"]
    name = kind[len("array<"):-1]
    total = vectors.count()
    cells = max(1, min(-(-total // block_rows), _MOST_SAMPLED // _PER_CELL))
    wanted = max(SAMPLE, _PER_CELL * cells)
    share = min(1.0, 2 * wanted / max(1, total))
    some = vectors.where(F.pmod(F.xxhash64("x"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1) \
        .select("x").orderBy(F.xxhash64("x")).limit(wanted).toPandas()
    sample = _matrix(some["x"]) if len(some) else np.zeros((1, 1))
    chosen = spread_pivots(sample[:SAMPLE], pivots)
    shares = np.arange(1, 1 << _CURVE_BITS) / (1 << _CURVE_BITS)
    edges = [np.quantile(_apart(sample, p[None])[:, 0], shares) for p in chosen[:_CURVE_PIVOTS]]
    places = np.sort(curve_place(_apart(sample, chosen), edges))
    cuts = np.unique(places[(np.arange(1, cells) * len(places)) // cells])

    def place(batches):
        for b in batches:
            if len(b):
                at = curve_place(_apart(_matrix(b["x"]), chosen), edges)
                yield b.assign(place=at, cell=np.searchsorted(cuts, at, "right").astype("int32"))

    laid = vectors.mapInPandas(place, f"x array<double>, names {kind}, id long, place long, cell int")

    def pack(g):
        g = g.sort_values("place", kind="stable")
        x, sizes = _matrix(g["x"]), g["names"].map(len).to_numpy()
        both = np.hstack([x, _apart(x, chosen)])
        out = []
        for i in range(0, len(g), 2 * block_rows):
            part = slice(i, i + 2 * block_rows)
            out.append((int(g["cell"].iloc[0]), len(g), i, both.min(axis=0).tolist(), both.max(axis=0).tolist(),
                        [list(v) for v in g["names"].iloc[part]], g["id"].to_numpy(np.int64)[part].tobytes(), x[part].tobytes(),
                        _reach(x[part], sizes[part], k).tobytes()))
        return pd.DataFrame(out, columns=["cell", "n", "seq", "low", "high", "names", "ids", "xs", "bounds"])

    blocks = materialize(laid.groupBy("cell").applyInPandas(
        pack, f"cell int, n long, seq long, low array<double>, high array<double>, names array<{kind}>, "
              "ids binary, xs binary, bounds binary"))
    heads = blocks.where(F.col("seq") == 0).select("cell", "n", "low", "high").orderBy("cell").toPandas()  # a row per cell
    numbers, n = heads["cell"].to_numpy(), heads["n"].to_numpy()
    low, high = (_matrix(heads[c]) if len(heads) else np.zeros((0, 1)) for c in ("low", "high"))
    width = sample.shape[1]
    tree = vectors.sparkSession.sparkContext.broadcast((numbers, n, _levels(low, high)))

    def ask(batches):
        numbers, n, levels = tree.value
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                x, bound, ids = np.frombuffer(r.xs).reshape(-1, width), np.frombuffer(r.bounds), np.frombuffer(r.ids, np.int64)
                seeking = np.flatnonzero(bound >= 0)
                x, bound, ids = x[seeking], bound[seeking].copy(), ids[seeking]
                for part in _slices(len(x), len(n)):
                    wide = np.flatnonzero(np.isinf(bound[part])) + part.start
                    if len(wide):
                        bound[wide] = _loose_bound(x[wide], levels[0][0][:, :width], levels[0][1][:, :width], n, k)
                    row, cell = _cells_within(x[part], _apart(x[part], chosen), bound[part], levels)
                    order = cell.argsort(kind="stable")
                    row, cell = row[order] + part.start, cell[order]
                    for one in np.split(np.arange(len(cell)), np.flatnonzero(np.diff(cell)) + 1):
                        if len(one):
                            at = row[one]
                            out.append((int(numbers[cell[one[0]]]), ids[at].tobytes(), x[at].tobytes(), bound[at].tobytes()))
            yield pd.DataFrame(out, columns=["cell", "q_ids", "q_xs", "q_bounds"])

    asked = blocks.select("ids", "xs", "bounds").mapInPandas(ask, "cell int, q_ids binary, q_xs binary, q_bounds binary")
    met = asked.join(blocks.select("cell", "names", "xs"), "cell").drop("cell")

    def compare(batches):
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ids, bound = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_bounds)
                x, y = np.frombuffer(r.q_xs).reshape(-1, width), np.frombuffer(r.xs).reshape(-1, width)
                if count:
                    out.append((len(x) * len(y),))
                else:
                    out += [(int(ids[i]), other, d) for i, other, d in _nearest(x, bound, y, r.names, k)]
            yield pd.DataFrame(out, columns=["n"] if count else ["id", "neighbour", "distance"])

    return met.mapInPandas(compare, "n long" if count else f"id long, neighbour {name}, distance double")


def compared_pairs(features: DataFrame, k: int = TOP_K, cols: Sequence[str] | None = None, entity: str = ENTITY,
                   pivots: int = PIVOTS, block_rows: int = BLOCK) -> tuple[int, int]:
    """Pairs of vectors that are compared with those of a cell, and all pairs of rows."""
    vectors = _vectors(_rows(features, cols, entity), k)
    done = _search(vectors, k, pivots, block_rows, True).agg(F.sum("n")).first()[0]
    return done or 0, features.count() ** 2
