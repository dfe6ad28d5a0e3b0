"""Quality classifier: histogram gradient-boosted trees over text statistics.

The statistics of a text are computed where the text is; no text is shuffled.
The trees are trained on the driver from a sample of at most ``max_rows``
labelled documents (the first by a hash of the id), binned into histograms, and
flattened into arrays (feature, threshold, leaf values of full binary trees).
Scoring walks all rows of a batch through a tree level by level with numpy.

Defined results: a null text is empty and is scored like any other; a null
label is no label; of an id with several labels one counts; without
any label every score is 0.5, with labels of one kind only it is near that
kind; a null ``doc_id`` is scored, not held out and never learnt from; of repeated
rows of a sampled id one is learnt from; a text of any length is read whole in
one task; an empty table gives an empty result; ``keep_accepted`` keeps all columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import begin_task, text_or_empty

MAX_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

_LETTER, _UPPER, _DIGIT, _SPACE, _LINE, _PUNCT, _HIGH, _SYMBOL = range(8)


def _classes() -> np.ndarray:
    lut = np.full(256, _SYMBOL)
    lut[ord("a"):ord("z") + 1] = _LETTER
    lut[ord("A"):ord("Z") + 1] = _UPPER
    lut[ord("0"):ord("9") + 1] = _DIGIT
    lut[[9, 11, 12, 13, 32]] = _SPACE
    lut[10] = _LINE
    lut[[ord(c) for c in ".,;:'\"?()-"]] = _PUNCT
    lut[128:] = _HIGH
    return np.eye(8)[lut]


_CLASS = _classes()
FEATURES = ("log_bytes", "lower", "upper", "digit", "space", "line", "punct", "high", "symbol",
            "entropy", "log_words", "word_bytes", "distinct_words", "top_word", "doubled_words",
            "symbol_words", "upper_words", "distinct_lines", "line_bytes", "bang", "pipe",
            "long_words")


def statistics(text: str) -> list[float]:
    """The statistics of one text, all finite, 0 where there is nothing."""
    raw = text.encode()
    n = len(raw)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = hist / max(1, n)
    cls = p @ _CLASS
    words = text.split()
    m = max(1, len(words))
    count: dict[str, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    top = max(count.values(), default=0)
    doubled = sum(map(str.__eq__, words, words[1:]))
    odd = upper = long_ = 0
    for w, c in count.items():
        if not w[-1].isalnum() and w[-1] not in ".,;:?!'\")-" or len(w) > 2 and not w[-2].isalnum():
            odd += c
        if w.isupper() and len(w) > 1:
            upper += c
        if len(w) > 24:
            long_ += c
    lines = text.split("\n")
    nz = p[p > 0]
    return [float(np.log1p(n)), *cls[[_LETTER, _UPPER, _DIGIT, _SPACE, _LINE, _PUNCT, _HIGH, _SYMBOL]].tolist(),
            float(-(nz * np.log2(nz)).sum()), float(np.log1p(len(words))), n / m, len(count) / m,
            top / m, doubled / m, odd / m, upper / m, len(set(lines)) / len(lines),
            n / len(lines), float(p[33]), float(p[124]), long_ / m]


class BoostedTrees:
    """Flat trees: node i has children 2i+1 and 2i+2; a row goes right when its
    feature is above the threshold."""

    def __init__(self, prior: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray,
                 rate: float):
        self.prior, self.feature, self.threshold, self.leaf, self.rate = prior, feature, threshold, leaf, rate

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            while len(x) and at[0] < inner:  # full trees: every row has the same depth
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += self.rate * leaf[at - inner] if len(x) else 0
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
        rate: float = 0.15, penalty: float = 1.0, min_rows: int = 5) -> BoostedTrees:
    """Newton boosting of the logistic loss over binned features."""
    n, d = x.shape
    inner = 2 ** depth - 1
    empty = BoostedTrees(0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), rate)
    if n == 0:
        return empty
    mean = (y.sum() + 0.5) / (n + 1)
    empty.prior = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
    flat = binned + np.arange(d) * bins  # cell of (feature, bin)
    out = np.full(n, empty.prior)
    fs, ts, ls = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-out))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        f, t = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            cell = (flat + ((at - first) * (d * bins))[:, None]).ravel()
            size = width * d * bins
            total = [np.bincount(cell, np.repeat(v, d), size).reshape(width, d, bins)
                     for v in (g, h, np.ones(n))]
            gl, hl, nl = (np.cumsum(v, axis=2)[:, :, :-1] for v in total)
            gs, hs, ns = (v[:, :1].sum(axis=2, keepdims=True) for v in total)
            gain = gl ** 2 / (hl + penalty) + (gs - gl) ** 2 / (hs - hl + penalty) - gs ** 2 / (hs + penalty)
            gain[(nl < min_rows) | (ns - nl < min_rows)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins - 1)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    f[first + k], t[first + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), f[at]] > t[at])
        slot = at - inner
        leaf = np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + penalty)
        out += rate * leaf[slot]
        fs.append(f), ts.append(t), ls.append(leaf)
    return BoostedTrees(empty.prior, np.array(fs), np.array(ts), np.array(ls), rate)


def is_held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", **options) -> BoostedTrees:
    """Fit on at most ``max_rows`` labelled documents that are not held out.

    The sample's ids are at most ``max_rows`` rows, so they are broadcast; only
    the sampled documents' statistics, a row per id, reach the driver."""
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~is_held_out(id_col))
           .select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y"))
           .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows))
    schema = ", ".join(["id string", "y double", *(f"{f} double" for f in FEATURES)])

    def run(batches):
        begin_task("quality")
        for b in batches:
            x = np.array([statistics(t) for t in b["t"]]).reshape(len(b), len(FEATURES))
            yield pd.concat([b[["id", "y"]].reset_index(drop=True), pd.DataFrame(x, columns=FEATURES)], axis=1)

    got = (docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("t"))
           .join(F.broadcast(ids), "_id")
           .select(F.col("_id").cast("string").alias("id"), F.col("_y").alias("y"), "t")
           .mapInPandas(run, schema)
           # One row per id, however often its document is repeated.
           .groupBy("id").agg(F.min(F.struct("y", *FEATURES)).alias("r")).select("id", "r.*").toPandas())
    got = got.sort_values(list(got.columns))  # the same model for any layout
    return fit(got[list(FEATURES)].to_numpy(float), got["y"].to_numpy(float), **options)


def _scores(model: BoostedTrees, texts) -> np.ndarray:
    x = np.array([statistics(t or "") for t in texts]).reshape(len(texts), len(FEATURES))
    return model.predict(x)


def score(docs: DataFrame, model: BoostedTrees, threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    scored = _score_udf(model)(F.col("t"))
    return (docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("t"))
            .select(id_col, "held_out", scored.alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_accepted(docs: DataFrame, model: BoostedTrees, threshold: float = THRESHOLD,
                  text_col: str = "text") -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    return docs.where(_score_udf(model)(text_or_empty(text_col)) >= threshold)


def _score_udf(model: BoostedTrees):
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        begin_task("quality")
        return pd.Series(_scores(model, texts))

    return scored
