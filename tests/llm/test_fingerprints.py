"""Fingerprints: edited texts by hand, likeness against exact weighted Jaccard."""

import hashlib
import random
from collections import Counter

import numpy as np

from epitrend.llm.fingerprints import SAMPLES, _uses, compare_edited, fingerprints, followers
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, id string, h0 string, n string, side string"
EXTRA = ("clash",) * 4


def _terms(text):
    w = (text or "").lower().split()
    return Counter(zip(w, w[1:])) if len(w) > 1 else Counter(w)


def _jaccard(a, b):
    a, b = _terms(a), _terms(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def _edit(text, after):
    h = len(text) // 2
    return text[:len(text) - h] + after[:h]


def test_every_sample_uses_four_exponentials():
    assert len(_uses()) == SAMPLES and all(len(set(u)) == 4 for u in _uses())
    assert len(set(_uses())) == SAMPLES


def test_followers_across_ranges(spark, many_ranges):
    ids = random.Random(1).sample(range(10_000), 500)
    got = {r.id: r.next_id for r in followers(spark.createDataFrame([(i, i) for i in ids], "id long, h0 long")).collect()}
    ids.sort()
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_edited_texts_and_likeness(spark):
    r = random.Random(3)
    vocabulary = ["".join(r.choices("abcdeé", k=r.randint(1, 5))) for _ in range(60)]
    texts = [None, "", "   ", "One", "one", "Two words", "😀é text here of odd length"]
    texts += [" ".join(r.choices(vocabulary, k=r.randint(1, 200))) for _ in range(80)]
    texts += [texts[20], "x " * 4000, "y" * 50_000]
    order = list(range(len(texts)))
    rows = [(i, texts[i], *EXTRA) for i in order] + [(30, texts[30], *EXTRA), (30, texts[30], *EXTRA)]
    r.shuffle(rows)
    got = compare_edited(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {x.doc_id: x for x in got}
    errors = []
    for i in order:
        text, after = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        edited = _edit(text, after)
        x = by[i]
        assert x.n_chars == len(text) and x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(x.fingerprint) == len(x.edited_fingerprint) == 8 * SAMPLES
        for near, other in ((x.near_edited, edited), (x.near_next, after)):
            assert 0 <= near <= 1
            errors.append(near - _jaccard(text, other))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.11 and max(map(abs, errors)) < 0.45
    assert by[20].fingerprint == by[87].fingerprint and by[0].fingerprint == by[2].fingerprint == "0" * 8 * SAMPLES
    alone = {x.doc_id: x.fingerprint for x in fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert alone == {i: x.fingerprint for i, x in by.items()}


def test_odd_tables(spark):
    assert compare_edited(spark.createDataFrame([], SCHEMA)).count() == 0
    one = compare_edited(spark.createDataFrame([(4, "a b c d", *EXTRA)], SCHEMA)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    got = compare_edited(spark.createDataFrame([(None, "a b", *EXTRA), (None, "c d", *EXTRA), (1, "e f", *EXTRA)], SCHEMA)).collect()
    assert sorted(str(x.doc_id) for x in got) == ["1", "None", "None"]


def test_no_python_on_the_main_path(spark):
    plan = compare_edited(spark.read.parquet(f"{SF001}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
