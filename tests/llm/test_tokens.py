"""Encoding, decoding and packing against the library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from epitrend.llm.bpe import (WordBpe, WordValues, decode_documents, encode_digests, encode_documents,
                              vocabulary_path)
from epitrend.llm.packing import first_fit_decreasing, pack_documents

SCHEMA = "doc_id long, text string, lang string, ids string"


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(vocabulary_path())


def _texts():
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [None, "", "  \n", "The the. It's 12 o'clock\x1cthere\x1f x <|endoftext|>y", "é" * 30 + "ß Σας",
            "a" * 700, "ab" * 500 + "!" * 300, "".join(r.choices(letters, k=2500)),
            "".join(r.choices("theinng", k=1500)) + " " + "".join(r.choices("étan😀9", k=900)),
            "x" * 130 + "<|startoftext|>" + "q" * 200, "".join(r.choices("0123456789abcdef", k=999))]


def test_tree_equals_library(bpe):
    for text in _texts():
        whole = bpe.tok.encode(text or "", add_special_tokens=False).ids
        for leaf in (16, 61, 256, 4096):
            assert bpe.encode(text or "", leaf) == whole


def test_tree_equals_library_on_random_runs(bpe):
    r = random.Random(7)
    for _ in range(300):
        letters = r.choice(["ab", "theran", "aeioust ", "thing", "abcdefghijklmnopqrstuvwxyz"])
        text = "".join(r.choices(letters, k=r.randint(20, 400)))
        assert bpe.encode(text, r.randint(3, 40)) == bpe.tok.encode(text, add_special_tokens=False).ids


def test_words_equal_library(bpe):
    r = random.Random(1)
    words = ["".join(r.choices("aéßñÉIİıſĿſŉz’'.,!9", k=r.randint(1, 9))) for _ in range(3000)]
    words += [chr(i) + "x." for i in range(0xA1, 0x250)] + ["e\u0301a,", "Straße;", "ÀÉÎ!", "can't.", "don'", "!!", "x<|endoftext|>"]
    words += ["word" + "".join(r.choices("!#$%&'*<|>", k=3)) for _ in range(300)]
    small = WordValues(bpe, list, 7)
    for w in words:
        assert small[w] == list(bpe.word_ids(w)) == bpe.tok.encode(w, add_special_tokens=False).ids, w


def test_spark_encoding_round_trip(spark, bpe):
    rows = [(i, t, "x", "clash") for i, t in enumerate(_texts())]
    rows += [(None, "n " + "z" * 80, None, None), (5, "a" * 700, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = encode_documents(df, leaf=48)
    assert sorted((r.doc_id if r.doc_id is not None else -1, tuple(r.ids)) for r in got.collect()) == sorted(
        (r[0] if r[0] is not None else -1, tuple(bpe.tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    dig = {(r.doc_id, r.ids_sha256): r for r in encode_digests(df, leaf=48).collect()}
    for i, t, *_ in rows:
        ids = bpe.tok.encode(t or "", add_special_tokens=False).ids
        r = dig[i, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()]
        text = bpe.tok.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {(r.doc_id, r.text) for r in decode_documents(got).collect()}
    assert (4, bpe.tok.decode(bpe.tok.encode(rows[4][1], add_special_tokens=False).ids, skip_special_tokens=False)) in back
    assert encode_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def _first_fit(lengths, capacity):
    bins, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        for b, used in enumerate(bins):
            if used + lengths[i] <= capacity:
                break
        else:
            bins.append(0)
            b = len(bins) - 1
        out.append((i, b, bins[b]))
        bins[b] += lengths[i]
    return sorted(out)


def test_first_fit_equals_brute_force():
    r = random.Random(3)
    for n in (0, 1, 2, 7, 100, 400):
        lengths = [r.randint(1, 64) for _ in range(n)]
        seq, off = first_fit_decreasing(lengths, 64)
        assert _first_fit(lengths, 64) == list(zip(range(n), seq.tolist(), off.tolist()))


def test_packing_is_whole(spark, bpe):
    rows = [(i, t, "x", "clash") for i, t in enumerate(_texts())] + [(None, "n", None, None), (3, "tie", None, None), (3, "tie", None, None)]
    got = [r.asDict() for r in pack_documents(spark.createDataFrame(rows, SCHEMA), capacity=64,
                                              group_pieces=8, with_ids=True).collect()]
    want = sorted(bpe.tok.encode(t or "", add_special_tokens=False).ids + [2] for _, t, *_ in rows)
    by_seq: dict = {}
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 64
    single = [r for r in got if r["doc_id"] not in (3,) and r["doc_id"] is not None]
    whole: dict = {}
    for r in sorted(single, key=lambda r: r["start"]):
        assert r["start"] == len(whole.setdefault(r["doc_id"], []))
        whole[r["doc_id"]] += r["ids"]
    assert all(ids in want for ids in whole.values())
    assert sum(r["length"] for r in got) == sum(map(len, want))
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_hot_id_spreads_over_all_groups(spark):
    """A third of the rows on one id and a third on null."""
    rows = [((None, 7, i)[i % 3], "word " * (i % 5), "x", "clash") for i in range(3000)]
    got = [r.sequence_id >> 32 for r in pack_documents(spark.createDataFrame(rows, SCHEMA), group_pieces=100).collect()]
    sizes = np.bincount(got)
    assert len(got) == 3000 and len(sizes) == 30 and sizes.max() <= 200


def test_copies_of_a_long_word_are_encoded_once(spark, bpe):
    """A third of the rows are copies of a text over the default leaf."""
    long = "".join(random.Random(4).choices("theinabc", k=9000))
    rows = [((None, 7, i)[i % 3], long if i % 3 == 1 else f"plain {i} " + long * (i == 0), "x", "c") for i in range(90)]
    rows += [(7, "z" + long, "x", "c")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = sorted((r[0] if r[0] is not None else -1, hashlib.sha256(" ".join(map(str, bpe.tok.encode(r[1], add_special_tokens=False).ids)).encode()).hexdigest())
                  for r in rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.ids_sha256) for r in encode_digests(df).collect())
    assert got == want
    packed = pack_documents(df, with_ids=True).collect()
    assert sum(r.length for r in packed) == sum(len(bpe.tok.encode(r[1], add_special_tokens=False).ids) + 1 for r in rows)
