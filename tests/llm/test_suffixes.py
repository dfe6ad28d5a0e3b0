"""Suffix arrays and the removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from epitrend.llm.suffixes import remove_repeated, repeated_starts, runs, suffix_array

SCHEMA = "doc_id long, text string, key string, id string, start string, n string, hot string"
EXTRA = ("clash",) * 5


def test_suffix_array_is_sorted():
    r = random.Random(3)
    for trial in range(200):
        letters = r.choice(["ab", "abcd", "a", "aé\xff", "abc \n"])
        s = "".join(r.choices(letters, k=r.randint(1, 200))).encode("latin-1")
        if trial % 3 == 0:
            s = s + s
        depth = r.choice([8, 16, 200])
        got = suffix_array(np.frombuffer(s, np.uint8), depth)
        assert sorted(got.tolist()) == list(range(len(s)))
        keys = [(s + bytes(depth))[i:i + depth] for i in got.tolist()]
        assert keys == sorted(keys)


def test_runs_of_one_byte_are_sorted_at_once():
    import time

    r = random.Random(8)
    for _ in range(100):  # runs of many lengths between each other
        s = "".join(r.choice("abc") * r.choice([1, 2, 30]) for _ in range(r.randint(1, 30))).encode()
        got = suffix_array(np.frombuffer(s, np.uint8), 64).tolist()
        keys = [(s + bytes(64))[i:i + 64] for i in got]
        assert sorted(got) == list(range(len(s))) and keys == sorted(keys)
    start = time.time()
    s = np.full(5_000_000, 97, np.uint8)
    assert suffix_array(s, 200)[:3].tolist() == [4_999_999, 4_999_998, 4_999_997]
    assert time.time() - start < 20


def test_a_long_text_of_one_letter(spark):
    rows = [(1, "a" * 5_000_000, *EXTRA), (2, "b" * 300 + "x" * 150, *EXTRA), (3, "", *EXTRA), (4, None, *EXTRA)]
    got = {x.doc_id: (x.n_bytes, x.n_removed) for x in remove_repeated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (5_000_000, 5_000_000), 2: (450, 300), 3: (0, 0), 4: (0, 0)}


def test_repeated_starts_equal_brute_force():
    r = random.Random(4)
    for _ in range(100):
        s = "".join(r.choices("ab", k=r.randint(20, 300))).encode()
        length = r.choice([8, 9, 12, 17])
        ok = np.arange(len(s)) + length <= len(s)
        c = Counter(s[i:i + length] for i in range(len(s) - length + 1))
        want = [ok[i] and c[s[i:i + length]] > 1 for i in range(len(s))]
        assert repeated_starts(np.frombuffer(s, np.uint8), ok, length).tolist() == want


def test_equal_strings_have_equal_keys():
    r = random.Random(5)
    shared = "".join(r.choices("abcdef ", k=230)).encode()
    keys = []
    for k in (3, 170):
        raw = "".join(r.choices("abcdef ", k=k)).encode() + shared + "".join(r.choices("abcdef ", k=90)).encode()
        key, start, n, _ = runs(raw)
        assert int(n.sum()) == len(raw) - 199 and start.tolist() == [0, *np.cumsum(n)[:-1].tolist()]
        keys.append(np.repeat(key, n)[k:k + 31].tolist())
    assert keys[0] == keys[1]
    assert len(runs(b"short")[0]) == 0


def _brute(rows, length):
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    c = Counter(t[k:k + length] for t in texts.values() for k in range(len(t) - length + 1))
    out = {}
    for i, t in texts.items():
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if c[t[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[i] = (len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot,group_bytes", [(4096, 1 << 20), (3, 3000)])
def test_removal_equals_brute_force(spark, hot, group_bytes):
    r = random.Random(6)
    word = lambda k: "".join(r.choices("abcdeé \n", k=k))
    passage, other = word(260), word(420)
    texts = [None, "", "short", "x" * 199, "y" * 200, "z" * 201, "ab" * 300, word(900)]
    texts += [word(r.randint(0, 300)) + passage + word(r.randint(0, 300)) for _ in range(14)]
    texts += [word(150) + other[r.randint(0, 120):r.randint(300, 420)] + word(100) for _ in range(8)]
    texts += [texts[7], texts[8], passage + passage, other + word(30) + passage[:230], word(3000) + texts[7][100:500]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, *EXTRA) for i, t in rows] + [(9, texts[9], *EXTRA), (None, texts[7], *EXTRA)], SCHEMA)
    want = _brute(rows, 200)
    got = remove_repeated(df, hot=hot, group_bytes=group_bytes, with_kept=True).collect()
    assert len(got) == len(rows) + 2
    for x in got:
        assert hashlib.sha256(bytes(x.kept)).hexdigest() == x.kept_sha256
        if x.doc_id is None:
            assert x.n_removed == 0
        else:
            assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == want[x.doc_id], x.doc_id


def test_no_rows(spark):
    assert remove_repeated(spark.createDataFrame([], SCHEMA)).count() == 0
