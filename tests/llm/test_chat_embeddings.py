"""Chat formatting and embedding near-duplicates against brute force."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from epitrend.llm.chat import RENDER_SQL, maximal, prefixes, render
from epitrend.llm.embeddings import count_collisions, least_count, near_duplicates
from tests.conftest import SF001, SF01

CHAT = "conv_id long, turn long, role string, text string, block string, place string"


def _keep(rows):
    convs: dict = {}
    for c, turn, role, text in set((c, t, r or "", x or "") for c, t, r, x in rows):
        convs.setdefault(c, []).append((-1 if turn is None else turn, role, text))
    import hashlib
    key = lambda x: (x[0], x[1], hashlib.md5(x[2].encode()).hexdigest())
    seqs = {c: [x[1:] for x in sorted(v, key=key)] for c, v in convs.items()}
    keep = []
    for c, s in seqs.items():
        longer = any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values())
        equal = any(o == s and (d is None or (c is not None and d < c)) for d, o in seqs.items() if d != c)
        if not longer and not equal:
            keep.append(c)
    return {c: seqs[c] for c in keep}


def _chat_rows():
    r = random.Random(2)
    rows = []
    for c in range(60):
        turns = [("user" if k % 2 == 0 else "assistant", r.choice(["hi", "yes", "no", "why", "", None])) for k in range(r.randint(1, 5))]
        start = r.choice([0, 0, 3])
        rows += [(c, start + k, *t) for k, t in enumerate(turns)]
    rows += [(500, k, "user", f"turn {k}") for k in range(400)] + [(501, k, "user", f"turn {k}") for k in range(399)]
    rows += [(502, 0, "user", "a"), (502, 0, "user", "b"), (502, 0, "user", "a"), (None, None, None, None), (503, None, "x", "y")]
    return rows + rows[:10]


def test_maximal_conversations_equal_brute_force(spark, many_ranges):
    rows = _chat_rows()
    df = spark.createDataFrame([(*x, "clash", "clash") for x in rows], CHAT)
    want = _keep(rows)
    got: dict = {}
    for x in sorted(render(df, 16).collect(), key=lambda x: x.part):
        assert x.n_turns == x.chat.count("<|im_end|>")
        got[x.conv_id] = got.get(x.conv_id, "") + x.chat
    assert got == {c: "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in s) for c, s in want.items()}
    assert render(df.limit(0)).count() == 0


def test_long_conversation_is_spread(spark, many_ranges):
    df = spark.createDataFrame([(1, k, "u", str(k)) for k in range(3000)], "conv_id long, turn long, role string, text string")
    got = prefixes(df).toPandas().sort_values("turn")
    assert got["place"].tolist() == list(range(1, 3001)) and got["p1"].nunique() == 3000


def test_render_equals_sql(spark):
    for d in (SF001, SF01):
        got = render(spark.read.parquet(f"{d}/conversations.parquet")).toPandas()
        con = duckdb.connect()
        con.execute(f"create view conversations as select * from '{d}/conversations.parquet'")
        want = con.execute(RENDER_SQL).df()
        key = ["conv_id", "part"]
        pd.testing.assert_frame_equal(got.sort_values(key)[want.columns].reset_index(drop=True),
                                      want.sort_values(key).reset_index(drop=True), check_dtype=False)


def test_no_python_on_the_chat_path(spark):
    rows, keep = maximal(spark.read.parquet(f"{SF001}/conversations.parquet"))
    plan = keep._jdf.queryExecution().toString() + prefixes(spark.read.parquet(f"{SF001}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


VEC = "vec_id long, embedding array<float>, label int, n string, id string"


def _vectors(seed=1, dim=24):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(30):
        base = r.normal(size=dim)
        for _ in range(int(r.integers(1, 8))):
            rows.append((base + r.normal(size=dim) * r.choice([0.0, 0.2, 0.28, 0.35, 0.4]), int(r.integers(0, 3))))
    rows += [(np.eye(dim)[0], 1)] * 20
    rows = [(v.astype(np.float32).tolist(), lab) for v, lab in rows]
    rows += [(None, 1), ([0.0] * dim, 1), ([float("nan")] * dim, 1), ([float("inf")] * dim, 0), (rows[0][0], None),
             ([], 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([None] * dim, 1), ([1e30] * dim, 2), ([2e30] * dim, 2)]
    order = r.permutation(len(rows))
    return [(int(i), *rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("block", [512, 16])
def test_embedding_links_equal_brute_force(spark, block):
    rows = _vectors()
    df = spark.createDataFrame([(*x, "clash", "clash") for x in rows] + [(None, rows[0][1], 1, "", ""), (*rows[3], "", "")], VEC)
    unit = {}
    for i, v, lab in rows:
        if v and lab is not None and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, np.float64)
            unit[i] = (lab, len(v), x / np.sqrt(((x / abs(x).max()) ** 2).sum()) / abs(x).max())
    links = {i: 0 for i, *_ in rows}
    root = {i: i for i in links}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in unit.items():
        for j, b in unit.items():
            if i < j and a[:2] == b[:2] and a[2] @ b[2] >= 0.93:
                links[i] += 1
                links[j] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    got = near_duplicates(df, block_rows=block).collect()
    assert len(got) == len(rows) + 2
    for x in got:
        if x.vec_id is None:
            assert x.n_links == 0 and x.component_id is None and x.kept
        else:
            assert (x.n_links, x.component_id, x.kept) == (links[x.vec_id], find(x.vec_id), find(x.vec_id) == x.vec_id)
    assert near_duplicates(df.limit(0)).count() == 0


def test_collisions_are_window_counts():
    r = np.random.default_rng(3)
    a, b = r.normal(size=(40, 7)), r.normal(size=(50, 7))
    assert (count_collisions(a, b, 0.5) == (abs(a[:, None] - b[None]) <= 0.5).sum(axis=2)).all()


def test_recall_on_the_table(spark):
    assert 15 <= least_count() <= 24
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    got = {x.vec_id: x.n_links for x in near_duplicates(df).collect()}
    rows = df.collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r.label for r in rows])
    near = (x @ x.T >= 0.93) & (lab[:, None] == lab[None])
    assert [got[r.vec_id] for r in rows] == (near.sum(axis=1) - 1).tolist()
