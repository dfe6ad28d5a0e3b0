"""Packing of tokenised documents into fixed-length training sequences.

First-fit decreasing. A document of more than ``capacity`` ids is cut into
full pieces, each a sequence of its own, and a rest. All pieces are dealt into
random groups by a hash of (document, start, row); the number of groups grows with
the number of pieces, so a group has about ``group_pieces`` of them at any
input size. Each group is packed on its own: pieces by falling length, each
into the first sequence with room for it. A tournament tree over the remaining
room of the sequences finds that sequence in O(log n).

Only lengths, checksums and positions are shuffled, never the ids.

Defined results: a null or empty text is one piece holding only the end id;
repeated rows are packed as often as they occur, and rows of one id, null
included, spread over all groups; pieces of one length are packed in the order
of id and start; a very long text is tokenised whole in one task; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.bpe import LEAF, load, vocabulary_path, word_values
from epitrend.llm.common import materialize, text_or_empty

CAPACITY = 4096
END_ID = 2
GROUP_PIECES = 2048


class RoomTree:
    """Tournament tree of the room left in each sequence: the winner of a
    match is the larger room, so the root has the largest of all."""

    def __init__(self, leaves: int, capacity: int):
        self.size = 1 << max(0, leaves - 1).bit_length()
        self.tree = [capacity] * (2 * self.size)

    def place(self, length: int) -> int:
        """Put ``length`` into the first sequence with room; its number."""
        tree, at = self.tree, 1
        while at < self.size:
            at *= 2
            if tree[at] < length:
                at += 1
        found = at - self.size
        tree[at] -= length
        while at > 1:
            at //= 2
            a, b = tree[2 * at], tree[2 * at + 1]
            tree[at] = a if a >= b else b
        return found


def first_fit_decreasing(lengths, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each length (1 to ``capacity``)."""
    lengths = np.asarray(lengths, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    room = RoomTree(len(lengths), capacity)
    seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: dict[int, int] = {}
    for i in order.tolist():
        n = int(lengths[i])
        s = room.place(n)
        seq[i], offset[i] = s, used.get(s, 0)
        used[s] = offset[i] + n
    return seq, offset


def tokenized_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
                     end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` and,
    if asked for, the ``ids``."""
    path = vocabulary or vocabulary_path()
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" \
        + (", ids array<int>" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def make(ids):
        return struct.pack(f"<{len(ids)}I", *ids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        get = word_values(path, "pieces", lambda bpe: [make])[0].__getitem__
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for i, text in zip(b["id"], b["text"]):
                words = bpe.words(text)
                if max(map(len, words), default=0) > LEAF:
                    raw = make(bpe.encode(text))
                else:
                    raw = b"".join(map(get, words))
                raw += end
                for at in range(0, len(raw), 4 * capacity):
                    piece = raw[at:at + 4 * capacity]
                    row = (i, at // 4, len(piece) // 4, zlib.crc32(piece), len(raw) // 4,
                           np.frombuffer(piece, "<u4").astype(np.int32) if with_ids else None)
                    for c, v in zip(cols, row):
                        c.append(v)
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "ids"]
            got = pd.DataFrame(dict(zip(names, cols)))
            if kind in ("bigint", "int"):
                got[id_col] = got[id_col].astype("Int64")
            yield got if with_ids else got.drop(columns="ids")

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")) \
        .mapInPandas(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         seed: int = 17, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Pieces longer than
    ``capacity`` are an error. A row's own number, stored with it, is part of its
    group's hash, so rows of one id spread over all groups."""
    stored = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    dealt = stored.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), "start", "_row"),
                                               F.lit(groups))).drop("_row")
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if group["length"].max() > capacity:
            raise ValueError("a piece is longer than a sequence")
        group = group.sort_values([id_col, "start"], kind="stable").reset_index(drop=True)
        seq, offset = first_fit_decreasing(group["length"], capacity)
        out = group.drop(columns="_group")
        out["sequence_id"] = (int(group["_group"].iloc[0]) << 32) + seq
        out["offset"] = offset
        return out

    return dealt.groupBy("_group").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, group_pieces: int = GROUP_PIECES, seed: int = 17,
                   id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Tokenise and pack every document."""
    pieces = tokenized_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids)
    return pack(pieces, capacity, group_pieces, seed, id_col)
