"""BPE encoding and decoding; long unsplit text by tree concatenation.

A text is cut at white space. The vocabulary's splitter never crosses white
space, so the ids of a text are the ids of its words in turn, and the ids of a
word are kept in a bounded cache per Python worker.

A word of more than ``leaf`` characters is unsplit text: one merge could reach
across all of it. Its pre-tokens are cut into leaves, which Spark deals out as
rows and encodes in parallel tasks. The leaves of a document then meet again
and are joined pairwise as a tree. At each join a window of the last k ids on
the left and the first k on the right is encoded anew, with k doubled until
the window begins with the left side's own id and holds an id that starts at
the same place as an equal id of the right side. From there on both sides
agree: neighbouring ids are then all pairs of one valid encoding, and a
sequence whose neighbouring pairs are all valid is the encoding of its text.

Defined results: a null or blank text has no ids, an empty decoded text and one
row; repeated rows give repeated rows; a null ``doc_id`` is carried through; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import begin_task, join_on, materialize, on_other_use, text_or_empty

VOCABULARY = "word_bpe_49k.json"
LEAF = 4096          # characters of unsplit text encoded in one go
CACHE_WORDS = 1_000_000  # values a worker keeps before it starts afresh
# White space to str.split, but ordinary characters to the vocabulary's splitter.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, str]:
    """Byte-level letters of the bytes (as Latin-1): printable ones are
    themselves, the others follow from U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordBpe:
    """One vocabulary file with a word cache."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        added = self.tok.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") \
            if self.added else None
        self.suffix = getattr(self.tok.model, "end_of_word_suffix", None) or ""
        self.parts: dict[str, tuple[int, ...]] = {}

    # ---- words ----

    @staticmethod
    def words(text: str) -> list[str]:
        """Pieces of a text whose ids do not depend on each other."""
        if _ODD_SPACE.search(text):
            return re.split(r"[^\S\x1c-\x1f]+", text)
        return text.split()

    @staticmethod
    def plain(word: str) -> tuple[str, str] | None:
        """A word of Latin letters with ASCII marks after it as the two
        pre-tokens it has: the letters in lower case and as byte letters, and
        the marks. The letters lower-case and normalise one by one (U+0130
        does not). None for any other word."""
        core = word.rstrip(_MARKS)
        mark = word[len(core):]
        if core.isascii():
            return (core.lower(), mark) if core.isalpha() or not core else None
        if core.isalpha() and max(core) < "\u0180" and "\u0130" not in core:
            return core.lower().encode().decode("latin-1").translate(_LETTERS), mark
        return None

    def part_ids(self, piece: str) -> tuple[int, ...]:
        """Ids of a pre-token in byte letters."""
        ids = self.parts.get(piece)
        if ids is None:
            if len(self.parts) >= CACHE_WORDS:
                self.parts.clear()
            ids = self.parts[piece] = tuple([t.id for t in self.tok.model.tokenize(piece)]) if piece else ()
        return ids

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a word. A plain word goes straight to the merges; any other
        goes through the whole library."""
        split = self.plain(word)
        if split is None:
            return tuple(self.tok.encode(word, add_special_tokens=False).ids)
        core, mark = split
        return self.part_ids(core) + self.part_ids(mark) if mark else self.part_ids(core)

    def tokens(self, ids) -> list[str]:
        token = self.tok.id_to_token
        return [t for t in map(token, ids) if t is not None]

    def decode(self, ids) -> str:
        """The tokens' strings joined by a space: the vocabulary names no decoder."""
        return " ".join(self.tokens(ids))

    # ---- unsplit text ----

    def pieces(self, word: str, leaf: int) -> list[tuple[int, str, list[int]]]:
        """A long word as (kind, piece, ids): kind 0 has ids, kind 1 is a leaf
        that starts a pre-token, kind 2 a leaf that goes on with it."""
        out: list[tuple[int, str, list[int]]] = []
        parts = self.split_added.split(word) if self.split_added else [word]
        for part in parts:
            if part in self.added:
                out.append((0, "", [self.added[part]]))
            elif part:
                if self.tok.normalizer is not None:
                    part = self.tok.normalizer.normalize_str(part)
                for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(part):
                    if len(piece) <= leaf:
                        out.append((0, "", [t.id for t in self.tok.model.tokenize(piece)]))
                    else:
                        out += [(1 if at == 0 else 2, piece[at:at + leaf], [])
                                for at in range(0, len(piece), leaf)]
        return out

    def leaf(self, piece: str) -> list[int]:
        return [t.id for t in self.tok.model.tokenize(piece)]

    def _width(self, i: int) -> int:
        t = self.tok.id_to_token(i)
        return len(t) - (len(self.suffix) if self.suffix and t.endswith(self.suffix) else 0)

    def join(self, a: tuple[str, list[int]], b: tuple[str, list[int]]) -> tuple[str, list[int]]:
        """The encoding of two neighbouring stretches of one pre-token."""
        (left, x), (right, y) = a, b
        k = 4
        while True:
            kx, ky = min(k, len(x)), min(k, len(y))
            back = sum(self._width(i) for i in x[len(x) - kx:])
            ahead = sum(self._width(i) for i in y[:ky])
            w = self.leaf(left[len(left) - back:] + right[:ahead])
            ok_left = kx == len(x) or w[0] == x[len(x) - kx]
            if ok_left and ky == len(y):
                return left + right, x[:len(x) - kx] + w
            if ok_left:
                starts, at = {}, back
                for j, i in enumerate(y[:ky]):
                    starts[at] = j
                    at += self._width(i)
                at, found = 0, None
                for j, i in enumerate(w[:-1]):  # the window's last id ends a word
                    m = starts.get(at)
                    if m is not None and m < len(y) - 1 and y[m] == i:
                        found = (j, m)
                    at += self._width(i)
                if found:
                    j, m = found
                    return left + right, x[:len(x) - kx] + w[:j] + y[m:]
            k *= 2

    def tree(self, leaves: list[tuple[str, list[int]]]) -> list[int]:
        """Ids of one pre-token from its encoded leaves, joined pairwise."""
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i:i + 2]) if i + 1 < len(leaves) else leaves[i]
                      for i in range(0, len(leaves), 2)]
        return leaves[0][1]

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        """Ids of one text, in this process."""
        out: list[int] = []
        for w in self.words(text):
            if len(w) <= leaf:
                out += self.tok.encode(w, add_special_tokens=False).ids
                continue
            run: list[tuple[str, list[int]]] = []
            for kind, piece, ids in [*self.pieces(w, leaf), (0, "", [])]:
                if kind < 2 and run:
                    out += self.tree(run)
                    run = []
                if kind:
                    run.append((piece, self.leaf(piece)))
                out += ids
        return out


class WordValues(dict):
    """What ``make`` makes of each word's ids, computed when first looked up.
    Begins afresh after ``limit`` words."""

    def __init__(self, bpe: WordBpe, make, limit: int = CACHE_WORDS):
        super().__init__()
        self.ids, self.make, self.limit = bpe.word_ids, make, limit

    def __missing__(self, word: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(self.ids(word))
        return value


_LOADED: dict[str, WordBpe] = {}
_VALUES: dict[tuple[str, str], list[WordValues]] = {}


def _forget() -> None:
    _VALUES.clear()
    for bpe in _LOADED.values():
        bpe.parts.clear()


on_other_use(_forget)


def load(path: str) -> WordBpe:
    """The vocabulary, loaded once per Python worker."""
    begin_task("bpe")
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def word_values(path: str, use: str, makers) -> list[WordValues]:
    """The worker's caches for one use of a vocabulary: one for each of the
    ``makers(bpe)``."""
    if (path, use) not in _VALUES:
        bpe = load(path)
        made = makers(bpe)
        _VALUES[path, use] = [WordValues(bpe, m, CACHE_WORDS // len(made)) for m in made]
    return _VALUES[path, use]


def _strings(bpe: WordBpe):
    """Ids in decimal and as decoded, each id with a space after it."""
    spaced = lambda part: "".join([p + " " for p in part])
    return [lambda ids: spaced(map(str, ids)), lambda ids: spaced(bpe.tokens(ids))]


def _digest(ids, decoded) -> tuple[int, str, str]:
    ids, decoded = "".join(ids), "".join(decoded)
    sha = lambda s: hashlib.sha256(s[:-1].encode()).hexdigest()
    return ids.count(" "), sha(ids), sha(decoded)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every text, whatever its length."""
    return _encoded(docs, vocabulary, leaf, id_col, text_col, "ids array<int>",
                    lambda bpe: [list],
                    lambda parts: ([i for p in parts for i in p],))


def encode_digests(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text; the ids
    themselves stay in the tasks."""
    return _encoded(docs, vocabulary, leaf, id_col, text_col,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string", _strings, _digest)


def decode_documents(encoded: DataFrame, vocabulary: str | None = None,
                     id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the decoded text of every row of ids (null: empty)."""
    path = vocabulary or vocabulary_path()
    kind = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "text": [
                "" if i is None else bpe.decode(map(int, i)) for i in b["ids"]]})

    return encoded.select(id_col, F.col(ids_col).alias("ids")).mapInPandas(
        run, f"`{id_col}` {kind}, text string")


def _encoded(docs, vocabulary, leaf, id_col, text_col, columns, makers, finish) -> DataFrame:
    path = vocabulary or vocabulary_path()
    kind = dict(docs.dtypes)[id_col]
    names = [c.split()[0] for c in columns.split(", ")]
    numbers = {c.split()[0]: "Int64" for c in columns.split(", ") if c.endswith(" long")}
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    piece_names = ["_id", "_key", "_seq", "_kind", "_piece", "_ids"]
    piece_schema = f"_id {kind}, _key string, _seq long, _kind int, _piece string, _ids array<int>"

    def pieces_of(bpe, words) -> list[tuple]:
        """A text with unsplit words as (kind, piece, ids); neighbouring finished
        ids share a row."""
        out: list[tuple] = []
        for w in words:
            for k, piece, ids in (bpe.pieces(w, leaf) if len(w) > leaf else [(0, "", bpe.word_ids(w))]):
                if k == 0 and out and out[-1][0] == 0:
                    out[-1][2].extend(ids)
                else:
                    out.append((k, piece, list(ids)))
        return out

    def first(batches):
        """Finished texts (kind -1), and the pieces of those with long words."""
        bpe = load(path)
        get = [v.__getitem__ for v in word_values(path, columns, makers)]
        for b in batches:
            made, cut = [], []
            for i, text in zip(b["_id"], b["_text"]):
                words = bpe.words(text)
                if max(map(len, words), default=0) <= leaf:
                    made.append((i, None, 0, -1, None, None, *finish(*[map(g, words) for g in get])))
                else:
                    key = hashlib.sha256(text.encode()).hexdigest()
                    cut += [(i, key, seq, *p, *[None] * len(names)) for seq, p in enumerate(pieces_of(bpe, words))]
            got = pd.DataFrame(made + cut, columns=piece_names + names, dtype=object)
            yield got.astype({**numbers, "_seq": "int64", "_kind": "int32",
                              **({"_id": "Int64"} if kind in ("bigint", "int") else {})})

    def leaves(batches):
        bpe = load(path)
        for b in batches:
            b["_ids"] = [bpe.leaf(p) if k else ids for k, p, ids in zip(b["_kind"], b["_piece"], b["_ids"])]
            yield b

    def assemble(group: pd.DataFrame) -> pd.DataFrame:
        bpe = load(path)
        group = group.sort_values("_seq")
        parts, run = [], []
        for k, piece, ids in [*zip(group["_kind"], group["_piece"], group["_ids"]), (0, "", [])]:
            if k < 2 and run:
                parts.append(bpe.tree(run))
                run = []
            if k:
                run.append((piece, [int(i) for i in ids]))
            elif len(ids):
                parts.append([int(i) for i in ids])
        row = finish(*[map(make, parts) for make in makers(bpe)])
        return pd.DataFrame({"_id": [group["_id"].iloc[0]], "_key": [group["_key"].iloc[0]],
                             **{n: [v] for n, v in zip(names, row)}})

    # The texts are read once; what this stores has no text but that of long words.
    staged = materialize(rows.mapInPandas(first, f"{piece_schema}, {columns}"), "encoded")
    whole = staged.where("_kind = -1").select(F.col("_id").alias(id_col), *names)
    # Copies of a text with long words are one: its pieces are encoded once, and
    # the result goes back to every copy's row.
    pieces = staged.where("_kind >= 0")
    grown = (pieces.groupBy(*piece_names).agg(F.count(F.lit(1)).alias("_copies")).drop("_copies").repartition("_id", "_key", "_seq")
             .mapInPandas(leaves, piece_schema)
             .groupBy("_id", "_key").applyInPandas(assemble, f"_id {kind}, _key string, {columns}"))
    copies = join_on(pieces.where("_seq = 0").select("_id", "_key"), grown, ["_id", "_key"])
    return whole.unionByName(copies.select(F.col("_id").alias(id_col), *names))
