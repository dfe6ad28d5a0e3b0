"""Removal of repeated byte strings by suffix arrays.

Every byte that lies in a ``length``-byte string which also starts somewhere
else (same document included) is removed; strings are judged on the input.

1. Each string start is filed under the smallest 64-byte-gram hash within its
   string. Equal strings have equal keys, and neighbouring starts with one key
   form a run, about 70 starts long. Keys with one run hold no repeat, unless
   the key's gram itself occurs twice in the text.
2. Runs of one key with equal bytes are repeats of each other as a whole.
3. The different runs of a key are gathered with their bytes, several keys to
   a group, and sorted as suffixes in two stages: only the suffixes smaller than
   their successors are sorted directly, the others are induced by one scan
   over the first-byte buckets. Adjacent suffixes with a common prefix of
   ``length`` bytes are repeats.
4. A key with more than ``HOT`` different runs (the edge of a passage that very
   many documents share) is split by content: its starts are filed anew under
   their whole string, where equal strings meet and nothing else does.

Of the starts that are listed in the end, most come from step 2 (85% at sf0.001,
where whole passages and documents are copied), the others from sorted suffixes:
those of the edges of passages and of repeats inside a run.

Defined results: a null text is empty, an empty or short one is kept whole;
repeated rows of one ``doc_id`` with one text are one document, so they are no
repeats of each other; rows with a null ``doc_id`` are left whole and make no other
a repeat; of equal strings all go, so there are no ties; a text of any length is
one row of one task, and a run of one byte is sorted at once; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import begin_task, materialize, text_or_empty
from epitrend.llm.minhash import _BYTES, _mix, _Powers

LENGTH = 200
GRAM = 64
HOT = 4096
GROUP_BYTES = 1 << 20  # of runs sorted together in one task
GAP = 0xFF  # never a byte of UTF-8; separates runs


# ---- suffix array --------------------------------------------------------

def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ``s`` (bytes) in order of their first
    ``depth`` bytes at least; past the end come zeros."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    # A suffix is small when the next byte that differs from its first is larger.
    change = np.flatnonzero(s[:-1] != s[1:])
    small = np.zeros(n, bool)
    if len(change):
        rises = s[change + 1] > s[change]
        at = np.searchsorted(change, np.arange(n))
        inside = at < len(change)
        small[inside] = rises[at[inside]]
    direct = np.flatnonzero(small)
    padded = np.concatenate([s, np.zeros(depth, np.uint8)])
    keys = np.lib.stride_tricks.as_strided(padded, (n, depth), (1, 1))
    if len(direct):
        text = np.ascontiguousarray(keys[direct]).view(f"S{depth}").ravel()
        direct = direct[np.argsort(text, kind="stable")]
    by_byte = np.searchsorted(s[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]

    heads = np.concatenate([[0], change + 1])  # where runs of one byte begin

    def induce(order: np.ndarray) -> None:
        """File the large suffixes before these ones under their first byte;
        those of the same run of one byte are in ``order`` already."""
        prev = order[order > 0] - 1
        prev = prev[~small[prev]]
        if order[0] < n:
            prev = prev[s[prev] != s[prev + 1]]
        first = s[prev]
        by = np.argsort(first, kind="stable")
        prev, first = prev[by], first[by]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(prev, cuts) if len(prev) else []:
            pending[s[part[0]]].append(part)

    induce(np.array([n]))
    out = []
    for c in range(256):
        own = []
        if pending[c]:
            # Before each stands the rest of its run of one byte: one step back
            # in all runs, then two steps, and so on.
            part = np.concatenate(pending[c])
            back = part - heads[np.searchsorted(heads, part, "right") - 1]
            which = np.repeat(np.arange(len(part)), back)
            step = np.arange(len(which)) - np.repeat(np.cumsum(back) - back, back) + 1
            rest = (part[which] - step)[np.argsort(step, kind="stable")]
            own = [np.concatenate([part, rest])]
            induce(own[0])
        small_here = direct[by_byte[c]:by_byte[c + 1]]
        if len(small_here):
            induce(small_here)
        out += [*own, small_here]
    return np.concatenate(out)


def repeated_starts(s: np.ndarray, starts_ok: np.ndarray, length: int) -> np.ndarray:
    """Mask of the allowed starts whose ``length``-byte string also begins at
    another allowed start."""
    order = suffix_array(s, length)
    order = order[starts_ok[order]]
    words = np.lib.stride_tricks.as_strided(np.concatenate([s, np.zeros(8, np.uint8)]).view(np.uint8),
                                            (len(s), 8), (1, 1))
    left, right = order[:-1], order[1:]
    alive = np.arange(len(left))
    for at in range(0, length, 8):
        at = min(at, length - 8)
        alive = alive[(words[left[alive] + at] == words[right[alive] + at]).all(axis=1)]
    mask = np.zeros(len(s), bool)
    mask[left[alive]] = mask[right[alive]] = True
    return mask


# ---- runs ----------------------------------------------------------------

def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes."""
    up, down = _Powers.of(len(raw))
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[:len(raw)], out=prefix[1:])
    return _mix((prefix[gram:] - prefix[:-gram]) * down[:len(raw) - gram + 1])


def _occur_twice(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is the hash of two or more places."""
    size = 1 << (32 * len(keys)).bit_length()
    table = np.zeros(size, bool)
    low = np.uint64(size - 1)
    table[keys & low] = True
    maybe = hashes[table[hashes & low]]
    own = np.unique(keys)
    at = np.minimum(np.searchsorted(own, maybe), len(own) - 1)
    many = np.bincount(at[own[at] == maybe], minlength=len(own)) > 1
    return many[np.searchsorted(own, keys)]


def runs(raw: bytes, length: int = LENGTH, gram: int = GRAM):
    """``(keys, first starts, numbers of starts, twice)`` of the runs of a
    text; only where ``twice`` can a run hold equal strings itself."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    hashes = low = gram_hashes(np.frombuffer(raw, np.uint8), gram)
    width = length - gram + 1  # grams in a string
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    keys = low[first]
    return keys, first, np.diff(np.append(first, len(low))), _occur_twice(hashes, keys)


def _all_runs(docs: DataFrame, kind: str, length: int) -> DataFrame:
    """``key, digest, id, start, n, twice`` of every run of every text."""

    def run(batches):
        for b in batches:
            begin_task("suffixes")
            take, keys, digests, starts, counts, twice = [], [], [], [], [], []
            for row, text in enumerate(b.column("text").to_pylist()):
                raw = text.encode()
                k, s, n, t = runs(raw, length)
                take.append(np.full(len(k), row))
                keys.append(k), starts.append(s), counts.append(n), twice.append(t)
                digests += [xxhash.xxh3_64_intdigest(raw[i:i + m + length - 1]) for i, m in zip(s.tolist(), n.tolist())]
            cat = lambda x, t: np.concatenate([*x, np.zeros(0, t)]).astype(t)
            yield pa.RecordBatch.from_arrays([
                pa.array(cat(keys, np.uint64).view(np.int64)),
                pa.array(np.array(digests, np.uint64).view(np.int64)),
                b.column("id").take(pa.array(cat(take, np.int64))),
                pa.array(cat(starts, np.int64).astype(np.int32)), pa.array(cat(counts, np.int64).astype(np.int32)),
                pa.array(cat(twice, bool))], names=["key", "digest", "id", "start", "n", "twice"])

    return docs.mapInArrow(run, f"key long, digest long, id {kind}, start int, n int, twice boolean")


def _sorted_repeats(pieces: DataFrame, kind: str, length: int) -> DataFrame:
    """``id, start, n`` of the repeated starts among the pieces of each group."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["key", "id", "start"]).reset_index(drop=True)
        size = g["raw"].map(len).to_numpy()
        text = bytes([GAP]).join([*g["raw"], b""])
        begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(np.int64)
        owner = np.repeat(np.arange(len(g)), size + 1)
        left = begin[owner] + size[owner] - np.arange(len(text))  # bytes to the piece's end
        mask = repeated_starts(np.frombuffer(text, np.uint8), left >= length, length)
        mask &= ~g["whole"].to_numpy(bool)[owner]
        at = np.flatnonzero(mask)
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0)) + 1 if len(at) else []
        spans = [p for p in np.split(at, cut) if len(p)]
        o = np.array([owner[p[0]] for p in spans], np.int64)
        first = np.array([p[0] for p in spans], np.int64)
        return pd.DataFrame({"id": g["id"].to_numpy()[o], "start": (g["start"].to_numpy()[o] + first - begin[o]).astype(np.int32),
                             "n": np.array([len(p) for p in spans], np.int32)})

    return pieces.groupBy("group").applyInPandas(run, f"id {kind}, start int, n int")


def _split_repeats(pieces: DataFrame, kind: str, length: int) -> DataFrame:
    """The same for keys of very many runs: every start is filed under its
    whole string (two hashes of it), equal strings are counted."""

    def run(batches):
        for b in batches:
            for i, start, whole, raw in zip(b["id"], b["start"], b["whole"], b["raw"]):
                a = np.frombuffer(raw, np.uint8)
                h = gram_hashes(a, length).view(np.int64)
                x = [xxhash.xxh3_64_intdigest(raw[k:k + length]) for k in range(len(h))]
                yield pd.DataFrame({"h": h, "x": np.array(x, np.uint64).view(np.int64), "id": [i] * len(h),
                                    "start": start + np.arange(len(h)), "whole": whole})

    starts = pieces.select("id", "start", "whole", "raw").mapInPandas(
        run, f"h long, x long, id {kind}, start int, whole boolean")
    twice = starts.groupBy("h", "x").agg(F.count("*").alias("c")).where("c > 1").select("h", "x")
    return starts.where("not whole").join(twice, ["h", "x"]).select("id", "start", F.lit(1).cast("int").alias("n"))


def repeated(docs: DataFrame, length: int = LENGTH, hot: int = HOT, group_bytes: int = GROUP_BYTES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, start, n``: the starts (n from ``start`` on) of strings that also
    start elsewhere. A start may be listed more than once."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).where("id is not null")
    kind = dict(rows.dtypes)["id"]
    every = _all_runs(rows.where(F.octet_length("text") >= length), kind, length)
    shared = every.groupBy("key").agg(F.count("*").alias("c"), F.max("twice").alias("t")).where("c > 1 or t").select("key")
    # Repeated rows of a document drop out here, where few runs are left.
    found = materialize(every.join(shared, "key")
                        .groupBy("key", "digest", "id", "start").agg(F.max("n").alias("n"), F.max("twice").alias("twice")), "runs")
    same = found.groupBy("key", "digest").agg(F.count("*").alias("copies"), F.max("twice").alias("twice"),
                                               F.min(F.struct("id", "start", "n")).alias("one"))
    same = materialize(same, "same")
    whole = found.join(same.where("copies > 1").select("key", "digest"), ["key", "digest"]).select("id", "start", "n")

    kinds = same.groupBy("key").agg(F.count("*").alias("kinds"), F.max("twice").alias("t")).where("kinds > 1 or t").drop("t")
    open_ = same.join(kinds, "key").select("key", (F.col("copies") > 1).alias("whole"), (F.col("kinds") > hot).alias("hot"), "one.*")
    total = open_.agg(F.sum(F.col("n") + length)).first()[0] or 0
    groups = 1 + total // group_bytes
    per_doc = open_.withColumn("group", F.when(~F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(groups)))) \
        .groupBy("id").agg(F.collect_list(F.struct("key", "group", "start", "n", "whole")).alias("runs"))

    def cut(batches):
        names = ["key", "group", "id", "start", "whole", "raw"]
        for b in batches:
            out = []
            for i, text, own in zip(b["id"], b["text"], b["runs"]):
                raw = text.encode()
                out += [(r["key"], r["group"], i, r["start"], r["whole"], raw[r["start"]:r["start"] + r["n"] + length - 1])
                        for r in own]
            yield pd.DataFrame(out, columns=names).astype({"group": "Int64"})

    pieces = materialize(rows.join(per_doc.hint("shuffle_hash"), "id").select("id", "text", "runs").mapInPandas(
        cut, f"key long, group long, id {kind}, start int, whole boolean, raw binary")
        .dropDuplicates(["id", "start"]), "pieces")
    return (whole.unionByName(_sorted_repeats(pieces.where("group is not null"), kind, length))
            .unionByName(_split_repeats(pieces.where("group is null"), kind, length)))


def covered(n: int, starts, counts, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the strings."""
    spans: list[list[int]] = []
    for s, c in sorted(zip(starts, counts)):
        e = min(n, s + c - 1 + length)
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return [(s, e) for s, e in spans]


def remove_repeated(docs: DataFrame, length: int = LENGTH, hot: int = HOT, group_bytes: int = GROUP_BYTES,
                    id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per document and, if
    asked for, ``kept``: the remaining bytes."""
    found = repeated(docs, length, hot, group_bytes, id_col, text_col) \
        .groupBy(F.col("id").alias("_id")).agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts"))
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    rows = rows.join(found.hint("shuffle_hash"), F.col(id_col) == F.col("_id"), "left").drop("_id")
    kind = dict(rows.dtypes)[id_col]

    def run(batches):
        for b in batches:
            out = []
            for text, starts, counts in zip(b["_text"], b["starts"], b["counts"]):
                raw = text.encode()
                spans = [] if starts is None else covered(len(raw), starts.tolist(), counts.tolist(), length)
                part, at = [], 0
                for s, e in spans:
                    part.append(raw[at:s])
                    at = e
                kept = b"".join([*part, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            kept if with_kept else None))
            got = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            got.insert(0, id_col, b[id_col].to_numpy())
            yield got if with_kept else got.drop(columns="kept")

    return rows.mapInPandas(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                            + (", kept binary" if with_kept else ""))
