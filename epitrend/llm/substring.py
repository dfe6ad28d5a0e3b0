"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text: ``h = (h << 1) + gear[byte]``. Its low
16 bits follow from the last 16 bytes alone; where the highest ``BITS`` of them are
zero, and no such place lies ``APART`` bytes before, a chunk ends (about 14 bytes
on). Cuts so depend on the text around them and not on where it stands: what is
inserted before a passage shifts nothing inside it. Two neighbouring chunks make
a unit with a 64-bit digest, and the first document (smallest id) with a digest
owns it.

1. Every document's distinct units are shuffled once, by digest, as (digest, id,
   place). Each task sorts its rows and streams through them: all but the
   owner's are repeats. Digests that hold more than a thousandth of the units of
   a sample of documents (fewer than a thousand) are dealt to ``SALTS`` tasks
   each; what is found does not depend on the sample.
2. Overlapping or touching repeats of a document that stand as far apart in one
   owner make a run. The ends of its first and its last unit are looked up in the
   owner, which gives the ``REACH`` bytes before and after, once per unit however
   many documents repeat it.
3. At each document the run is extended byte by byte on both sides as far as the
   bytes agree. Runs of ``min_run`` bytes or more (``REACH`` is as much, so one unit
   tells) are removed, the first occurrence stays. Units that a text repeats within
   itself are found there and extended the same way.

Texts are shuffled once, for steps 2 and 3 together. A passage shorter than three
cuts (a share that falls with its length: none of 150 passages of 51 words in the
tests) has no unit of its own and stays.

Defined results: a null text stays null and has no bytes, an empty one stays
empty; texts under ``min_run`` bytes keep everything; rows of one ``doc_id`` never
make each other a repeat; a document with a null ``doc_id`` keeps what it does not
repeat itself and makes no other a repeat; ties go to the smallest id and the
first place; no cut falls inside a code point; a text of any length is one row
of one task, its units are rows; other columns of any name are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import begin_task, materialize

BITS, APART, LONGEST = 3, 5, 64
MIN_RUN, REACH = 100, 100
SALTS, SAMPLE_DOCS = 64, 20_000
_GEAR = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 16, 256, dtype=np.uint32)


def cuts(raw: bytes) -> np.ndarray:
    """Places where a text is cut, its start and end included."""
    h = _GEAR[np.frombuffer(raw, np.uint8)]
    for s in (1, 2, 4, 8):  # sums of the last 2, 4, 8, 16 shifted bytes
        longer = h.copy()
        longer[s:] += h[:-s] << np.uint32(s)
        h = longer
    h &= np.uint32(0xFFFF)
    at = np.flatnonzero(h < np.uint32(1 << (16 - BITS))) + 1
    if len(at):
        at = at[np.concatenate([[True], np.diff(at) >= APART])]
    at = np.unique(np.concatenate([[0], at, [len(raw)]]))
    wide = np.flatnonzero(np.diff(at) > LONGEST)
    return np.unique(np.concatenate([at, *[_inner_cuts(h, int(at[i]), int(at[i + 1])) for i in wide]])) if len(wide) else at


def _sliding(f: Callable, a: np.ndarray, width: int) -> np.ndarray:
    """``f`` over every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        a = f(a[:-span], a[span:])
        span *= 2
    return f(a[:len(a) - (width - span)], a[width - span:]) if span < width else a


def _inner_cuts(h: np.ndarray, start: int, end: int) -> np.ndarray:
    """Cuts of a stretch without any: after hashes that are the smallest of some
    ``LONGEST`` neighbours, ``APART`` from each other, so that a word repeated over
    and over is cut in step with itself; ``LONGEST`` bytes on where there is none."""
    inside = h[start + 15:end - 1]  # of bytes of this stretch alone
    at = []
    if len(inside) >= LONGEST:
        low = _sliding(np.minimum, inside, LONGEST)
        edge = np.zeros(LONGEST - 1, h.dtype)
        at = (np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, low, edge]), LONGEST) == inside) + start + 16).tolist()
    found, last = [], start
    for p in [*at, end]:
        while p - last > LONGEST:
            last += LONGEST
            found.append(last)
        if p < end and p - last >= APART:
            found.append(p)
            last = p
    return np.array(found, np.int64)


def units(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and digests of the pairs of whole chunks of a text."""
    at = cuts(raw)[1:-1]  # the first and the last chunk end where the text does
    if len(at) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, e = at[:-2], at[2:]
    digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(s.tolist(), e.tolist())), np.uint64, len(s))
    return s, e, digest.view(np.int64)


def agreeing(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _own_repeats(raw: bytes) -> list[tuple[int, int]]:
    """Maximal stretches that repeat an earlier stretch of the same text, grown
    from repeated units."""
    s, e, digest = units(raw)
    first, back = np.unique(digest, return_index=True, return_inverse=True)[1:]
    out: list[tuple[int, int]] = []
    for k in np.flatnonzero(first[back] < np.arange(len(digest))).tolist():
        i, j, p = int(s[k]), int(e[k]), int(s[first[back[k]]])
        if out and j <= out[-1][1]:
            continue  # inside what the unit before has grown to
        left = agreeing(raw[max(0, i - REACH):i][::-1], raw[max(0, p - REACH):p][::-1])
        right, step = 0, 256
        while True:  # doubling steps: a long stretch is compared once
            n = agreeing(raw[j + right:j + right + step], raw[p + j - i + right:p + j - i + right + step])
            right += n
            if n < step:
                break
            step *= 2
        out.append((i - left, j + right))
    return out


def removed_runs(raw: bytes, found: list[tuple[int, int]], min_run: int = MIN_RUN) -> list[tuple[int, int]]:
    """Byte ranges to remove: ``found`` in other documents and repeated here,
    ``min_run`` long at least and cut at code points."""
    out = []
    own = _own_repeats(raw) if len(raw) >= min_run else []
    for s, e in _joined([r for r in [*found, *own] if r[1] - r[0] >= min_run]):
        while s < e and raw[s] & 0xC0 == 0x80:
            s += 1
        while e < len(raw) and e > s and raw[e] & 0xC0 == 0x80:
            e -= 1
        if e - s >= min_run:
            out.append((s, e))
    return out


def _extended(raw: bytes, runs) -> list[tuple[int, int]]:
    """Runs ``(s, e, u1, u2, before, after)`` extended as far as the text agrees
    with the owners' bytes; ``before`` ends and ``after`` starts with the run's
    first and last unit, whose lengths ``u1`` and ``u2`` are."""
    out = []
    for r in runs:
        s, e, before, after = r["s"], r["e"], r["before"], r["after"]
        left = agreeing(raw[max(0, s - REACH):s + r["u1"]][::-1], before[::-1]) - r["u1"]
        right = agreeing(raw[e - r["u2"]:e + REACH], after) - r["u2"]
        # Less than the unit: the owner's id has another text at this place.
        out.append((s - max(0, left), e + max(0, right)))
    return out


def _occurrences(rows: DataFrame, hot: frozenset) -> DataFrame:
    """``digest, salt, id, place`` of the distinct units; a place is the start
    times 1024 plus the length."""
    kind = dict(rows.dtypes)["id"]
    often = np.array(sorted(hot), np.int64)

    def run(batches: Iterator[pa.RecordBatch]):
        begin_task("substring")
        for b in batches:
            for c in range(0, b.num_rows, 256):
                part = b.slice(c, 256)
                take, digests, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for row, text in enumerate(part.column("text").to_pylist()):
                    s, e, digest = units(text.encode())
                    one = np.unique(digest, return_index=True)[1]
                    take.append(np.full(len(one), row))
                    digests.append(digest[one])
                    places.append(s[one] * 1024 + (e - s)[one])
                at, digest = np.concatenate(take), np.concatenate(digests)
                salt = np.where(np.isin(digest, often), 1 + at % SALTS, 0).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest), pa.array(salt), part.column("id").take(pa.array(at)), pa.array(np.concatenate(places))],
                    names=["digest", "salt", "id", "place"])

    return rows.mapInArrow(run, f"digest long, salt byte, id {kind}, place long")


def _repeats(occurrences: DataFrame) -> DataFrame:
    """``id, place, digest, owner, owned`` of every unit whose digest a smaller
    id owns; ``owned`` is its place there."""
    kind = dict(occurrences.dtypes)["id"]
    laid = occurrences.repartition("digest", "salt").sortWithinPartitions("digest", "salt", "id", "place")

    def run(batches: Iterator[pa.RecordBatch]):
        last = None  # key, id and place of the first row of the group under way
        for b in batches:
            if not b.num_rows:
                continue
            digest, salt = b.column("digest").to_numpy(), b.column("salt").to_numpy()
            new = np.ones(len(digest), bool)
            new[1:] = (digest[1:] != digest[:-1]) | (salt[1:] != salt[:-1])
            if last is not None and last[0] == (digest[0], salt[0]):
                new[0] = False
            group = np.cumsum(new)  # 0: goes on from the batch before
            heads = np.flatnonzero(new)
            place, ids = b.column("place"), b.column("id")
            owners, owned = ids.take(pa.array(heads)), place.take(pa.array(heads))
            if not new[0]:
                owners = pa.concat_arrays([last[1], owners])
                owned = pa.concat_arrays([last[2], owned])
            index = pa.array(group - (1 if new[0] else 0))
            last = ((digest[-1], salt[-1]), owners.slice(len(owners) - 1), owned.slice(len(owned) - 1))
            # Of hot digests all rows go on, as their owner is in another task.
            keep = pa.array(~new | (salt > 0))
            out = pa.RecordBatch.from_arrays([ids, place, b.column("digest"), b.column("salt"), owners.take(index), owned.take(index)],
                                             names=["id", "place", "digest", "salt", "owner", "owned"])
            yield out.filter(keep)

    return laid.mapInArrow(run, f"id {kind}, place long, digest long, salt byte, owner {kind}, owned long")


def _runs(rows: DataFrame) -> DataFrame:
    """``id, s, e`` of the runs of repeats, with the owners of the first and the
    last unit (``o1``, ``o2``) and their places there (``p1``, ``p2``)."""
    kind = dict(rows.dtypes)["id"]
    share = min(1.0, SAMPLE_DOCS / max(1, rows.count()))
    some = _occurrences(rows.where(F.rand(5) < share), frozenset()).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    some = materialize(some.where("n > 1"), "often")
    total = some.agg(F.sum("n")).first()[0] or 0
    hot = frozenset(r[0] for r in some.where(F.col("n") * 1000 > total).select("digest").collect())
    found = materialize(_repeats(_occurrences(rows, hot)), "repeats")
    # The owners of hot digests: fewer than a thousand rows, one for each row.
    owners = found.where("salt > 0").groupBy("digest").agg(F.min(F.struct("owner", "owned")).alias("o"))
    repeats = found.join(F.broadcast(owners), "digest", "left") \
        .select("id", "place", F.coalesce("o.owner", "owner").alias("owner"), F.coalesce("o.owned", "owned").alias("owned")) \
        .where("owner < id")
    lists = repeats.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", "owner", "owned"))).alias("u"))

    def run(batches):
        for b in batches:
            out = []
            for i, u in zip(b["id"], b["u"]):
                start, end, first, last = -1, -1, None, None
                for p in [*u, None]:
                    s, n = (p["place"] // 1024, p["place"] % 1024) if p is not None else (1 << 62, 0)
                    follows = p is not None and first is not None and s <= end and p["owner"] == last["owner"] \
                        and s - p["owned"] // 1024 == start - first["owned"] // 1024
                    if not follows:
                        if first is not None:
                            out.append((i, start, end, first["owner"], first["owned"], last["owner"], last["owned"]))
                        start, first = s, p
                    end, last = s + n, p
            yield pd.DataFrame(out, columns=["id", "s", "e", "o1", "p1", "o2", "p2"])

    return materialize(lists.mapInPandas(run, f"id {kind}, s long, e long, o1 {kind}, p1 long, o2 {kind}, p2 long"), "runs")


def _with_runs(docs: DataFrame, min_run: int, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` under the column names c0, c1, ..., so that no name of theirs
    can clash, with the ``runs`` of each document; and the text's name."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    body, id_ = names[docs.columns.index(text_col)], names[docs.columns.index(id_col)]
    every = docs.toDF(*names)
    kind = dict(every.dtypes)[id_]
    text = F.col(body).cast("string")
    usable = F.col(id_).isNotNull() & (F.coalesce(F.octet_length(text), F.lit(0)) >= min_run)
    rows = every.where(usable)
    runs = _runs(rows.select(F.col(id_).alias("id"), text.alias("text")))
    ends = runs.select(F.col("o1").alias("o"), F.col("p1").alias("p"), F.lit(False).alias("after")) \
        .unionByName(runs.select(F.col("o2").alias("o"), F.col("p2").alias("p"), F.lit(True).alias("after"))).distinct()
    wanted = ends.groupBy("o").agg(F.collect_list(F.struct("p", "after")).alias("places"))
    # Both joins of the texts read one shuffle: the same rows and columns, all
    # of which the first one takes too.
    met = rows.join(wanted.hint("shuffle_hash"), F.col(id_) == F.col("o"))

    def answer(batches: Iterator[pa.RecordBatch]):
        begin_task("substring")
        for b in batches:
            out = []
            for i, t, places in zip(b.column(id_).to_pylist(), b.column(body).to_pylist(), b.column("places").to_pylist()):
                raw = str(t).encode()
                for a in places:
                    s, e = a["p"] // 1024, a["p"] // 1024 + a["p"] % 1024
                    out.append((i, a["p"], a["after"], raw[s:e + REACH] if a["after"] else raw[max(0, s - REACH):e]))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(id_).type), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.binary())], names=["o", "p", "after", "bytes"])

    bytes_ = met.mapInArrow(answer, f"o {kind}, p long, after boolean, bytes binary") \
        .groupBy("o", "p", "after").agg(F.max("bytes").alias("bytes"))
    side = lambda n, after: bytes_.where(F.col("after") == after).select(
        F.col("o").alias(f"o{n}"), F.col("p").alias(f"p{n}"), F.col("bytes").alias("after" if after else "before"))
    grown = runs.join(side(1, False), ["o1", "p1"]).join(side(2, True), ["o2", "p2"])
    lists = grown.groupBy("id").agg(F.collect_list(F.struct(
        "s", "e", (F.col("p1") % 1024).alias("u1"), (F.col("p2") % 1024).alias("u2"), "before", "after")).alias("runs"))
    joined = rows.join(lists.hint("shuffle_hash"), F.col(id_) == F.col("id"), "left").drop("id")
    other = every.where(~usable).withColumn("runs", F.lit(None).cast(joined.schema["runs"].dataType))
    return joined.unionByName(other), body


def _cut(text: str | None, runs, min_run: int) -> tuple[bytes, list[tuple[int, int]], bytes]:
    raw = (text or "").encode()
    spans = removed_runs(raw, [] if runs is None else _extended(raw, runs), min_run)
    return raw, spans, _without(raw, spans)


def measure(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, text`` per
    document; ``text`` is what is kept, ``spans`` the byte ranges removed
    (start:end, comma-joined)."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows, body = _with_runs(slim, min_run, "id", "text")
    kind = dict(slim.dtypes)["id"]

    def run(batches):
        begin_task("substring")
        for b in batches:
            out = []
            for text, runs in zip(b[body], b["runs"]):
                raw, spans, kept = _cut(text, runs, min_run)
                out.append((len(raw), sum(e - s for s, e in spans), len(spans),
                            hashlib.sha256(kept).hexdigest(), ",".join(f"{s}:{e}" for s, e in spans),
                            None if text is None else kept.decode()))
            got = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text"])
            got.insert(0, id_col, b["c0"].to_numpy())
            yield got

    return rows.mapInPandas(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, "
                                 "kept_sha256 string, spans string, text string")


def _without(raw: bytes, spans) -> bytes:
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]])


def remove_repeats(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text column."""
    rows, body = _with_runs(docs, min_run, id_col, text_col)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        begin_task("substring")
        return pd.Series([None if t is None else _cut(t, r, min_run)[2].decode() for t, r in zip(texts, found)], dtype=object)

    return rows.withColumn(body, cut(F.col(body), F.col("runs"))).drop("runs").toDF(*docs.columns)
