"""Secret scans and the quality classifier."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from epitrend.llm import quality, secrets
from tests.conftest import SF01

SCHEMA = "doc_id long, text string, lang string, score double, spans string"


def _base(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, m.end()))
    for k, p, n in ((1, r"AKIA[A-Z0-9]+", 18), (2, r"[0-9a-f]+", 16)):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text) if len(m.group()) >= n]
    return sorted(out)


def _model():
    words = ["the reading of another thing in general", "die sache wird nicht einfach gemacht"] * 50
    return secrets.MarkovPair.from_samples([*((s, 1) for s in secrets.random_strings()), *((s, 0) for s in secrets.identifiers(words, common=True))])


def test_spans(spark):
    r = random.Random(2)
    key = "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40))
    texts = [None, "", "é password = 'hunter2hunter2' x", "Secret=token: abcdefghijklmnop", "AKIAAKIA12 AKIA" + "B7" * 8,
             "0123456789abcdef" * 3 + " " + "f" * 15, "API_KEY:\"aaaaaaaaaaaa\"token=bbbbbbbbbbbb", "see " + key + " there",
             "computeTotalOfAllTheRows_and_columns2 some_ordinary_identifier_name_12", "toKen=" + "0a1b2c3d" * 4]
    model = _model()
    df = spark.createDataFrame([(i, t, "x", 0.0, "clash") for i, t in enumerate(texts)] + [(None, texts[2], None, None, None)] * 2, SCHEMA)
    got = secrets.scan(df, model).collect()
    assert len(got) == len(texts) + 2
    for x in got:
        text = texts[x.doc_id] or "" if x.doc_id is not None else texts[2]
        want = _base(text)
        named = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert x.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert [x.n_assign, x.n_access, x.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        spans = x.spans.split(",") if x.spans else []
        assert [s for s in spans if not s.startswith("markov")] == (named.split(",") if named else [])
        assert x.n_markov == (1 if x.doc_id == 7 else 0)
    clean = {x.doc_id: x.text for x in secrets.redact(df, model).collect()}
    assert clean[7] == "see [SECRET] there" and clean[0] is None and clean[8] == texts[8]
    assert secrets.scan(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_models_tell_random_from_ordinary():
    model = _model()
    fresh = secrets.random_strings(500, seed=99)
    hit = sum(model.is_secret(s) for s in fresh if len(s) >= 24)
    assert hit > 0.9 * sum(len(s) >= 24 for s in fresh)
    assert not secrets.MarkovPair.from_samples([("abc", 0)]).is_secret("aB3" * 12)


def test_clean_documents_gain_no_span(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert secrets.scan(docs, secrets.train_from_documents(docs)).where("n_markov > 0").count() == 0


def test_all_words_of_all_documents_train(spark):
    ids = [r.id for r in spark.range(4200).orderBy(F.xxhash64("id"), "id").collect()]
    late = set(ids[4000:])  # once beyond the sample
    rows = [(i, "word " * 600 + " ".join(["XJ" if i in late else "ZQ"] * 200)) for i in ids]
    got = secrets.train_from_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    code = lambda c: ord(c) - 31
    for a, b in ("ZQ", "XJ"):  # one beyond 400 words, the other in late documents besides
        assert got.ratio[code(a), code(b)] < -3
    assert got.ratio[code("Z"), code("X")] > 0


def test_every_fifth_word_trains_too(spark):
    """Only every fifth word differs, at any place in the five."""
    for at in range(5):
        words = ["plain"] * 20
        words[at::5] = ["QZXV"] * 4
        got = secrets.train_from_documents(spark.createDataFrame([(i, " ".join(words)) for i in range(500)], "doc_id long, text string"))
        assert got.ratio[ord("Q") - 31, ord("Z") - 31] < -3
    rest = secrets.train_from_documents(spark.createDataFrame([(i, "QZXV") for i in range(4000)], "doc_id long, text string"))
    assert rest.ratio[ord("Q") - 31, ord("Z") - 31] < -3  # texts of one word


def test_planted_keys_are_found_in_documents(spark):
    """Random keys of 20 to 64 characters in five alphabets, inside real texts."""
    r = random.Random(31)
    docs = [x for x in spark.read.parquet(f"{SF01}/documents.parquet").collect() if x.text]
    model = secrets.train_from_documents(spark.read.parquet(f"{SF01}/documents.parquet"))
    keys = secrets.random_strings(500, seed=77)
    rows, places = [], {}
    for i, key in enumerate(keys):
        text = docs[i % len(docs)].text[:3000]
        cut = text.find(" ", r.randrange(len(text)))
        head = text[:cut] if cut >= 0 else text
        rows.append((i, head + " " + key + " " + text[len(head):], "x", 0.0, "c"))
        places[i] = (len(head) + 1, len(head) + 1 + len(key))
    got = {x.doc_id: x.spans for x in secrets.scan(spark.createDataFrame(rows, SCHEMA), model).collect()}
    spans = {i: [tuple(p.split(":")) for p in s.split(",") if p] for i, s in got.items()}
    covered = lambda i: any(int(s) <= places[i][0] and places[i][1] <= int(e) for _, s, e in spans[i])
    for n, least in ((20, 0.9), (32, 0.97)):
        some = [i for i, k in enumerate(keys) if len(k) >= n]
        assert sum(map(covered, some)) >= least * len(some), (n, sum(map(covered, some)) / len(some))
    false = sum(k == "markov" and (int(e) <= places[i][0] or int(s) >= places[i][1]) for i in spans for k, s, e in spans[i])
    assert false == 0


def test_spans_of_one_pass_equal_every_pair(spark):
    model = _model()
    r = random.Random(12)
    for _ in range(200):
        parts = []
        for _ in range(r.randint(0, 30)):
            key = "".join(r.choices("abcdefABCDEF0123456789", k=r.randint(5, 40)))
            parts.append(r.choice([key, f"password={key}", "AKIA" + key.upper(), "0a" * 10 + key, "token: " + key, "word"]))
        text = r.choice([" ", "/", ""]).join(parts)
        base = secrets.base_spans(text)
        want = sorted(base + [(m.start(), 3, m.end()) for m in secrets.TOKEN.finditer(text) if model.is_secret(m.group())
                              and not any(a < m.end() and m.start() < b for a, _, b in base)])
        assert secrets.find_spans(text, model) == want
    import time
    text = " ".join("password=" + "".join(r.choices("abcdef0123456789XYZ", k=30)) for _ in range(40_000))
    start = time.time()
    assert len(secrets.find_spans(text, model)) >= 40_000 and time.time() - start < 20  # 1.5 MB; a square would take minutes


def test_trees_equal_a_walk_by_hand():
    r = np.random.default_rng(1)
    x = r.normal(size=(800, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > -0.1)).astype(float)
    model = quality.fit(x, y)
    assert ((model.predict(x) > 0.5) == y).mean() > 0.95
    for row in range(20):
        total = model.prior
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(x[row, f[at]] > t[at])
            total += model.rate * leaf[at - len(f)]
        assert abs(1 / (1 + np.exp(-total)) - model.predict(x[row:row + 1])[0]) < 1e-12
    assert quality.fit(x[:0], y[:0]).predict(x[:2]).tolist() == [0.5, 0.5]
    assert quality.fit(x, np.ones(800)).predict(x[:1])[0] > 0.99


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    truth = duckdb.sql(f"select doc_id, quality from '{SF01}/labels.parquet' where quality is not null").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i].predicted, q) for i, q in truth if i in got and got[i].held_out]
    assert len(held) > 40 and sum(p == q for p, q in held) >= 0.95 * len(held)


def test_repeated_rows_of_a_sampled_id_train_once(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    one = labels.where("quality is not null").orderBy("doc_id").first()
    hot = docs.where(F.col("doc_id") == one.doc_id).crossJoin(spark.range(300)).drop("id")
    a, b = quality.train(docs, labels), quality.train(docs.unionByName(hot), labels)
    assert (a.feature == b.feature).all() and np.allclose(a.leaf, b.leaf)


def test_odd_rows_are_scored(spark):
    docs = spark.createDataFrame([(None, None, "x", 1.0, "c"), (1, "", "x", 1.0, "c"), (1, "", "x", 1.0, "c"), (2, "a" * 300_000, None, None, None)], SCHEMA)
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.keep_accepted(docs, none).columns == docs.columns
    assert quality.keep_accepted(docs, none).count() == 4
    assert quality.score(docs.limit(0), none).count() == 0
