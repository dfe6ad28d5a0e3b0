"""Secret scans: fixed patterns, and Markov models of random strings.

Two first-order character models, one of random strings and one of ordinary
identifiers, are trained from generated strings and from the words of all
documents. A token outside the fixed
patterns' matches is a secret when it is long enough, mixes character classes,
and the log-likelihood ratio of the two models is at least ``min_ratio`` per
character and ``min_total`` in all.

The patterns (spans in code points, end exclusive, leftmost and not
overlapping per kind; failing matches are dropped, not searched again):
``assign`` a password-like name, a sign and a value of 12 or more characters,
``access`` an access-key id of 18 or more, ``hex`` a hex run of 16 or more.

Defined results: a null or empty text has no spans; repeated rows give
repeated rows; a null ``doc_id`` is carried through; without samples of both
kinds no span is added; spans with one start go in the order of the kinds; a text
of any length is scanned whole in one pass; an empty table trains a model of the
common words alone and gives an empty result; ``redact`` keeps all columns of any name.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import begin_task, text_or_empty

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "markov")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WORD = re.compile(r"[A-Za-z]{2,}")
PLACEHOLDER = "[SECRET]"
RANDOM_SAMPLES = 4000    # generated random strings that train the other model
MIN_RATIO, MIN_TOTAL = 0.6, 16.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


#: Character classes of the models: 0 start and end, 1 other, then ASCII.
_CLASS = np.array([b - 31 if 32 < b < 127 else int(b != 0) for b in range(256)])


def _codes(s: str) -> np.ndarray:
    return _CLASS[np.frombuffer(b"\0" + s.encode("ascii", "replace") + b"\0", np.uint8)]


def pair_counts(strings: Iterable[str]) -> np.ndarray:
    """How often each character follows another; a string begins and ends at 0."""
    c = _codes("\0".join(strings))
    return np.bincount(c[:-1] * 96 + c[1:], minlength=96 * 96).reshape(96, 96)


class MarkovPair:
    """Log-likelihood ratio of random over ordinary, per pair of characters,
    from the pair counts of ordinary and of random strings."""

    def __init__(self, ordinary: np.ndarray, random_: np.ndarray, smoothing: float = 0.5):
        logs = [np.log((c + smoothing) / (c + smoothing).sum(axis=1, keepdims=True)) for c in (ordinary, random_)]
        self.ratio = logs[1] - logs[0]
        # The pair (0, 0) is the count of no strings at all.
        self.ready = all(c[0, 1:].sum() > 0 for c in (ordinary, random_))

    @classmethod
    def from_samples(cls, samples: Iterable[tuple[str, int]]) -> MarkovPair:
        """From strings labelled 1 (random) or 0 (ordinary)."""
        sides: tuple[list[str], list[str]] = ([], [])
        for s, label in samples:
            sides[label].append(s)
        return cls(*map(pair_counts, sides))

    def score(self, token: str) -> float:
        c = _codes(token)
        return float(self.ratio[c[:-1], c[1:]].sum())

    def is_secret(self, token: str, min_ratio: float = MIN_RATIO,
                  min_total: float = MIN_TOTAL) -> bool:
        if not self.ready:
            return False
        kinds = (any(c.isdigit() for c in token) + any(c.islower() for c in token)
                 + any(c.isupper() for c in token))
        if kinds < 2:
            return False
        total = self.score(token)
        return total >= min_total and total >= min_ratio * len(token)


#: Words of ordinary identifiers, besides the documents' own.
COMMON = """add all array base block buffer byte cache call char check child class clean clear client close
code column config connection content context control copy count create current data date default delete
document element empty end entry error event field file filter find first flag format from function get
group handle hash header id image index info init input item key label last length level line link list
load local lock log main map max message method min mode model module name new next node null number
object offset open option order output page parent parse path point position print process query queue
read record remove request reset result return root row rows run save schema search select send server
session set size sort source split start state status stop stream string sum table target task text time
token total tree type update user value version view wait width write""".split()


def random_strings(n: int = RANDOM_SAMPLES, seed: int = 11) -> list[str]:
    """Random strings in the alphabets keys are written in."""
    r = random.Random(seed)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = [lower + lower.upper() + digits, lower + lower.upper() + digits + "+/",
                 lower + lower.upper() + digits + "-_", lower + digits, lower.upper() + digits]
    return ["".join(r.choices(alphabets[i % len(alphabets)], k=r.randint(20, 64))) for i in range(n)]


def _joined(words: Iterable[str], r: random.Random) -> Iterator[str]:
    """Every word alone, and each four (or the rest) joined."""
    for w in batched(words, 4):
        yield from w
        yield from ("_".join(w[:3]), "-".join(w[-3:]).lower(), "".join([x.title() for x in w]),
                    f"{w[0]}_{w[-1]}_{int(r.random() * 3000)}", "/".join(w), "_".join(w[:2]).upper())


def _own(texts: Iterable[str], r: random.Random) -> Iterator[str]:
    for text in texts:
        yield from _joined((m[0] for m in WORD.finditer(text)), r)


def identifiers(texts: Iterable[str], seed: int = 11, common: bool = False) -> list[str]:
    """Ordinary identifiers: all the texts' own words, or the common ones, alone
    and joined in the usual ways (snake, kebab, camel, numbered, path)."""
    r = random.Random(seed)
    out: list[str] = []
    for words in [[r.choice(COMMON) for _ in range(400)] for _ in range(40 if common else 0)]:
        out += _joined(words, r)
    return [*out, *_own(texts, r)]


def train_from_documents(docs: DataFrame, text_col: str = "text") -> MarkovPair:
    """Models from generated random strings (label 1) and identifiers made of
    all words of all documents (label 0). The strings are counted in tasks, the
    counts added per pair of characters, and only the sums come to the driver."""

    def count(batches):
        begin_task("secrets")
        total = np.zeros(96 * 96, np.int64)
        for b in batches:
            for t in b["t"]:
                own = _own([TOKEN.sub(" ", t)], random.Random(zlib.crc32(t.encode())))
                for some in batched(own, 8192):
                    total += pair_counts(some).ravel()
        pairs = np.flatnonzero(total)
        yield pd.DataFrame({"pair": pairs, "n": total[pairs]})

    sums = docs.select(text_or_empty(text_col).alias("t")).mapInPandas(count, "pair int, n long") \
        .groupBy("pair").agg(F.sum("n").alias("n")).collect()
    ordinary = np.zeros(96 * 96, np.int64)
    for r in sums:
        ordinary[r.pair] = r.n
    return MarkovPair(ordinary.reshape(96, 96) + pair_counts(identifiers([], common=True)), pair_counts(random_strings()))


def find_spans(text: str, model: MarkovPair) -> list[tuple[int, int, int]]:
    """All spans of a text, those of the models included."""
    base = base_spans(text)
    added, at, covered = [], 0, 0
    for m in TOKEN.finditer(text):
        s, e = m.span()
        # Both run by their starts: base spans that begin before the token ends
        # are passed once, and ``covered`` is how far they reach.
        while at < len(base) and base[at][0] < e:
            covered = max(covered, base[at][2])
            at += 1
        if covered <= s and model.is_secret(m.group()):
            added.append((s, 3, e))
    return sorted(base + added)


def format_spans(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, model: MarkovPair, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans``."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        begin_task("secrets")
        for b in batches:
            rows = []
            for text in b["text"]:
                spans = find_spans(text, model)
                n = [sum(k == i for _, k, _ in spans) for i in range(4)]
                base = format_spans(x for x in spans if x[1] < 3)
                rows.append((*n, hashlib.sha256(base.encode()).hexdigest(), format_spans(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_markov",
                                              "base_sha256", "spans"])
            out.insert(0, id_col, b["id"].to_numpy())
            yield out

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInPandas(
        run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_markov long, "
             "base_sha256 string, spans string")


def redact_text(text: str, model: MarkovPair, placeholder: str = PLACEHOLDER) -> str:
    """The text with every span (overlapping ones as one) replaced."""
    out, at = [], 0
    for s, _, e in find_spans(text, model):
        if s >= at:
            out += [text[at:s], placeholder]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: MarkovPair, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets replaced in the text column; null stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        begin_task("secrets")
        return texts.map(lambda t: t if t is None else redact_text(t, model))

    return docs.withColumn(text_col, clean(F.col(text_col)))
