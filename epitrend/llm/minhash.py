"""Near-duplicate documents by HyperMinHash.

A document's set holds the 64-bit hashes (xxh3 of the words, mixed in their
order) of its distinct word shingles. The
sketch splits them over 128 buckets and stores, per bucket, the smallest
hash's count of leading zeros (6 bits) and the 10 bits after its first one;
empty buckets borrow from others by a fixed random order. Bands of registers,
as long as the threshold allows (``band_rows``: five at 85%, four at 80%), bring
candidates together. Jaccard similarity estimated from equal
registers, corrected for registers that agree by accident, sorts candidates
out before their full sets are compared.

Documents with equal sets are one class from the start. Each class is compared
with the smallest class of its buckets first, then with the medoids of buckets
whose members are still in different components (large buckets in blocks, each
with medoids of its own), and at last the full sets of all likely pairs across
the components that remain in a bucket are compared where they meet. Pairs
inside one component need no comparison, so of a large bucket the members of
its largest component meet only the others. What still grows with the square
are buckets of thousands of documents that belong together in no way but share a
band.

Defined results: a null or blank text has an empty set and no links; a
document with a null ``doc_id`` links with nothing, has a null component and
is kept; rows of one ``doc_id`` are one document; equal sets go to the smallest
id; a text of any length is one row of one task; an empty table gives an empty
result; ``keep_one`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import begin_task, materialize, on_other_use, text_or_empty
from epitrend.llm.components import components

WORDS = 5
BUCKETS = 128
MISSED = 1e-6  # share of pairs at the threshold that may agree in no band
MANTISSA = 10
BLOCK = 512  # classes of one bucket compared with as many others in a task

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BORROW = np.random.Generator(np.random.PCG64(7)).integers(0, BUCKETS, (BUCKETS, 64))
_BORROW_LAST = np.random.Generator(np.random.PCG64(8)).permuted(np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1)


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2^64."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            m = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * np.uint64(pow(_MULTIPLIER, m, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * np.uint64(pow(_MULTIPLIER, -m, 1 << 64))])
        return cls.up, cls.down


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SEEN: dict[bytes, int] = {}
on_other_use(_SEEN.clear)
_PLACES = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _word_hashes(parts: list[bytes]) -> np.ndarray:
    """64-bit xxh3 of every word, looked up in a table that starts anew at a
    million words."""
    if len(_SEEN) > 1_000_000:
        _SEEN.clear()
    out = list(map(_SEEN.get, parts))
    for i, h in enumerate(out):
        if h is None:
            out[i] = _SEEN[parts[i]] = xxhash.xxh3_64_intdigest(parts[i], 6)
    return np.array(out, np.uint64)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles. A word counts by its
    xxh3 hash, mixed once more with its place in the shingle, so that words made
    to agree under a sum or a polynomial do not."""
    parts = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return np.zeros(0, np.uint64)
    h = _word_hashes(parts)
    n = min(len(parts), words)
    total = np.zeros(len(parts) - n + 1, np.uint64)
    for k in range(n):
        total = _mix(total + (h[k:k + len(total)] ^ _PLACES[k % 64]))
    return np.unique(total ^ _mix(np.array([n], np.uint64)))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers (16 bits each) of a non-empty sorted set."""
    shift = np.uint64(64 - 7)
    first = np.searchsorted(hashes, np.arange(BUCKETS, dtype=np.uint64) << shift)
    full = np.append(first[1:], len(hashes)) > first
    rest = hashes[np.minimum(first, len(hashes) - 1)] & np.uint64((1 << 57) - 1)
    # Leading zeros of the 57 bits, by the float exponent of the top 53.
    exponent = np.frexp((rest >> np.uint64(4)).astype(np.float64))[1]
    zeros = 53 - exponent
    down = np.maximum(57 - 1 - zeros - MANTISSA, 0).astype(np.uint64)
    low = (rest >> down) & np.uint64((1 << MANTISSA) - 1)
    reg = ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | low).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        ok = full[_BORROW[empty]]
        pick = _BORROW[empty, ok.argmax(axis=1)]
        none = ~ok.any(axis=1)
        if none.any():
            last = _BORROW_LAST[empty[none]]
            pick[none] = last[np.arange(len(last)), full[last].argmax(axis=1)]
        reg[empty] = reg[pick]
    return reg


def band_rows(threshold: float) -> int:
    """Registers a band: the most with which at most ``MISSED`` of the pairs at
    the threshold agree in no band."""
    missed = lambda r: (1 - threshold ** r) ** (BUCKETS // r)
    return max((r for r in range(1, BUCKETS + 1) if missed(r) <= MISSED), default=1)


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers. Two unrelated
    minima with rates n and m fall into one register with probability
    0.72 / 2^mantissa * n m / (n + m)^2."""
    chance = 0.72 / (1 << MANTISSA) * n * m / (n + m) ** 2
    return (equal - chance) / (1 - chance)


def least_estimate(threshold: float, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimates below this are four standard deviations under the threshold;
    small sets have as many independent registers as shingles."""
    k = np.minimum(BUCKETS, np.minimum(n, m))
    return threshold - 4 * np.sqrt(threshold * (1 - threshold) / k)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = WORDS) -> DataFrame:
    """``id, n, digest, sketch`` of every document; no sketch for empty sets."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        begin_task("minhash")
        for b in batches:
            n, digest, sk = [], [], []
            for text in b["text"]:
                h = shingles(text, words)
                n.append(len(h))
                digest.append(xxhash.xxh3_128_digest(h.tobytes()))
                sk.append(sketch(h).tobytes() if len(h) else None)
            yield pd.DataFrame({"id": b["id"], "n": n, "digest": digest, "sketch": sk})

    return rows.mapInPandas(run, f"id {kind}, n long, digest binary, sketch binary")


def _equal(a, b) -> np.ndarray:
    left = np.frombuffer(b"".join(a), np.uint16).reshape(-1, BUCKETS)
    right = np.frombuffer(b"".join(b), np.uint16).reshape(-1, BUCKETS)
    return (left == right).mean(axis=1)


def _likely(pairs: DataFrame, sk: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose estimate does not rule a link out."""

    @F.pandas_udf("boolean")
    def likely(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        n, m = n.to_numpy(float), m.to_numpy(float)
        return pd.Series(estimate(_equal(x, y), n, m) >= least_estimate(threshold, n, m))

    one = sk.select(F.col("id").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx"))
    two = sk.select(F.col("id").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny"))
    near = (F.col("nx") >= threshold * F.col("ny")) & (F.col("ny") >= threshold * F.col("nx"))
    return pairs.join(two, "b").join(one, "a").where(near).where(likely("x", "y", "nx", "ny")).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs whose full sets have ``100 * shared >= percent * union``."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        begin_task("minhash")
        own: dict = {}
        out = []
        for i, s, t in zip(a, x, y):
            if i not in own:
                if len(own) >= 64:
                    own.clear()
                own[i] = shingles(s, words)
            out.append(_linked(own[i], shingles(t, words), percent))
        return pd.Series(out, dtype=bool)

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(two, "b").join(one, "a").where(linked("a", "x", "y")).select("a", "b")


def _hashes(words: int):
    """The full set of a text as bytes."""

    @F.pandas_udf("binary")
    def hashes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingles(t, words).tobytes())

    return hashes


def _own_blocks(members: DataFrame) -> DataFrame:
    """Members of buckets dealt into groups ``key, i`` of about ``BLOCK``, one row
    each."""
    size = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return members.join(size, "key").withColumn("i", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))


def _cross_blocks(members: DataFrame) -> DataFrame:
    """Members of buckets dealt into groups ``key, i, j`` in which every two of
    different components meet. The largest component of a bucket is cut into
    blocks that do not meet each other; the others' members, ``strays``, are cut
    into blocks that meet them and each other. A bucket of copies with few
    strays so makes hardly more rows than it has members."""
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("c"))
    core = sizes.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("core"),
                                    F.max("c").alias("n_core"), F.sum("c").alias("n_all"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    core = core.select("key", "core", blocks(F.col("n_core")).alias("cores"),
                       blocks(F.col("n_all") - F.col("n_core")).alias("strays"))
    inside = F.col("component") == F.col("core")
    hash_ = F.xxhash64("id", F.lit(3))
    own = F.when(inside, F.pmod(hash_, F.col("cores"))).otherwise(F.col("cores") + F.pmod(hash_, F.col("strays")))
    last = F.col("cores") + F.col("strays") - 1
    # Core blocks meet the strays' blocks, those meet all.
    meets = F.sequence(F.when(inside, F.col("cores")).otherwise(F.lit(0)), last)
    return (members.join(core, "key").withColumn("own", own.cast("int")).withColumn("other", F.explode(meets))
            .select("key", "id", "n", "component", "sketch", "own",
                    F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))


class _Group:
    """The members of one group as arrays."""

    def __init__(self, g: pd.DataFrame):
        begin_task("minhash")
        self.regs = np.frombuffer(b"".join(g["sketch"]), np.uint16).reshape(-1, BUCKETS)
        self.n, self.component = g["n"].to_numpy(float), g["component"].to_numpy()
        self.id = g["id"].to_numpy()

    def likely(self, k: int, rows: np.ndarray, threshold: float) -> np.ndarray:
        """Those of ``rows`` that may link with row k and are not in its component."""
        rows = rows[(self.component[rows] != self.component[k]) & (self.n[rows] >= threshold * self.n[k])
                    & (self.n[k] >= threshold * self.n[rows])]
        eq = (self.regs[rows] == self.regs[k]).mean(axis=1)
        n, m = np.full(len(rows), self.n[k]), self.n[rows]
        return rows[estimate(eq, n, m) >= least_estimate(threshold, n, m)]

    def pairs(self, k: int, rows: np.ndarray) -> list[tuple]:
        return [(min(self.id[k], self.id[r]), max(self.id[k], self.id[r])) for r in rows]


def _medoid_pairs(g: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Stars around medoids: the member that agrees best with the most frequent
    registers is paired with all that may link with it; these leave, and the
    rest goes on. Edited copies link with their source more than with each
    other, and the source is such a medoid. One pair per member at most."""
    m = _Group(g)
    left, out = np.arange(len(g)), []
    while len(left) > 1 and (m.component[left] != m.component[left[0]]).any():
        regs = np.sort(m.regs[left], axis=0)
        new = np.vstack([np.ones((1, BUCKETS), bool), regs[1:] != regs[:-1]])
        run = np.arange(len(left))[:, None] - np.maximum.accumulate(np.where(new, np.arange(len(left))[:, None], 0), axis=0)
        common = regs[run.argmax(axis=0), np.arange(BUCKETS)]
        k = left[(m.regs[left] == common).sum(axis=1).argmax()]
        near = m.likely(k, left, threshold)
        out += m.pairs(k, near)
        same = left[m.component[left] == m.component[k]]
        left = np.setdiff1d(left, np.concatenate([near, same]))
    return pd.DataFrame(out, columns=["a", "b"])


def _all_links(g: pd.DataFrame, threshold: float, percent: int) -> pd.DataFrame:
    """The links across components, of the blocks that meet here, found on the
    full sets of all likely pairs. A pair whose components a link has already
    joined here is not compared, so there are fewer links than members."""
    m = _Group(g)
    sets = [np.frombuffer(s, np.uint64) for s in g["hashes"]]
    i, j, own = int(g["i"].iloc[0]), int(g["j"].iloc[0]), g["own"].to_numpy()
    second = np.flatnonzero(own == j)
    root = {c: c for c in m.component}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for k in np.flatnonzero(own == i):
        rows = m.likely(k, second[second > k] if i == j else second, threshold)
        for r in rows:
            x, y = find(m.component[k]), find(m.component[r])
            if x != y and _linked(sets[k], sets[r], percent):
                root[max(x, y)] = min(x, y)
                out += m.pairs(k, [r])
    return pd.DataFrame(out, columns=["a", "b"])


def _linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * shared >= percent * (len(p) + len(q) - shared)


def _mixed(members: DataFrame, label: DataFrame, heads: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component, with their
    components and sketches. Of buckets with the same members one is enough."""
    placed = members.join(label, members["id"] == label["node"], "left") \
        .select("key", "id", F.coalesce("component", "id").alias("component"))
    member = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), F.col("id")))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count("*").alias("c"), member(1).alias("s1"), member(2).alias("s2")) \
        .where("lo < hi").groupBy("c", "s1", "s2").agg(F.min("key").alias("key")).select("key")
    return placed.join(mixed, "key").join(heads, "id")


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = WORDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.
    Links are pairs of documents with ``100 * shared >= percent * union``."""
    threshold = percent / 100
    every = materialize(sketches(docs, id_col, text_col, words), "sketches")
    kind = dict(every.dtypes)["id"]
    some = every.where("n > 0 and id is not null")
    copies = some.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("last")) \
        .where("rep < last").select("digest", "rep")
    classes = materialize(some.join(copies, "digest", "left")
                          .select("id", F.coalesce("rep", "id").alias("rep"), "n", "sketch"), "classes")
    heads = classes.where("id = rep").select("id", "n", "sketch")
    per_band = band_rows(threshold)
    keys = F.array(*[F.xxhash64(F.substring("sketch", 2 * per_band * i + 1, 2 * per_band), F.lit(i))
                     for i in range(BUCKETS // per_band)])
    banded = heads.select("id", F.explode(keys).alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last")) \
        .where("head < last").select("key", "head")
    members = materialize(banded.join(buckets, "key"), "members")
    needed = members.select("id").distinct()
    texts = materialize(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
                        .join(needed.hint("shuffle_hash"), "id", "left_semi"), "texts")
    stars = members.where("head < id").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    first = materialize(_likely(stars, heads, threshold).groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    copies_of = classes.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    found = materialize(_verified(first, texts, percent, words), "found")
    label = materialize(components(found), "labels")
    stars = _own_blocks(_mixed(members, label, heads)).groupBy("key", "i") \
        .applyInPandas(lambda g: _medoid_pairs(g, threshold), f"a {kind}, b {kind}").distinct()
    stars = materialize(stars.join(first, ["a", "b"], "left_anti"), "pairs")
    found = materialize(found.unionByName(_verified(stars, texts, percent, words)), "found")
    label = materialize(components(found), "labels")
    open_ = materialize(_mixed(members, label, heads), "open")
    whole = texts.join(open_.select("id").distinct().hint("shuffle_hash"), "id", "left_semi") \
        .dropDuplicates(["id"]).select("id", _hashes(words)("text").alias("hashes"))
    rest = _cross_blocks(open_).join(whole, "id").groupBy("key", "i", "j") \
        .applyInPandas(lambda g: _all_links(g, threshold, percent), f"a {kind}, b {kind}")
    found = found.unionByName(rest)
    label = components(found.unionByName(copies_of))
    return (every.join(label, every["id"] == label["node"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id"),
                    F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept")))


def keep_one(docs: DataFrame, percent: int = 80, words: int = WORDS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: that with
    the smallest id."""
    gone = near_duplicates(docs, percent, words, id_col, text_col).where("not kept") \
        .select(F.col(id_col).alias("gone")).distinct()
    names = [f"c{i}" for i in range(len(docs.columns))]  # no name of theirs can clash
    own = F.col(names[docs.columns.index(id_col)])
    return docs.toDF(*names).join(gone.hint("shuffle_hash"), own == F.col("gone"), "left_anti").toDF(*docs.columns)
