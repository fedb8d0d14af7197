"""Near-duplicate embeddings against brute force."""

import numpy as np
import pytest

from metassoc.llm import itq
from metassoc.llm.queries import QUERIES
from metassoc.llm.vectors import unit

SCHEMA = "vec_id long, embedding array<double>, n_links string"


def brute(ids, x, threshold=0.9):
    """{id: (links, component)}"""
    near = unit(np.asarray(x)) @ unit(np.asarray(x)).T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(ids))
    while True:
        new = np.array([min(label[i], label[near[i]].min(initial=len(ids))) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    return {i: (int(near[k].sum()), ids[label[k]]) for k, i in enumerate(ids)}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_driver_table(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect())
    want = brute([i for i, _ in rows], [v for _, v in rows])
    got = result(QUERIES["op9_near_embeddings"](spark, d))
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert np.mean([got[i][1] == want[i][1] for i in want]) >= 0.99


def test_pairs_just_above_the_threshold_and_none_below(spark):
    rng = np.random.default_rng(1)
    x = unit(rng.normal(size=(600, 24)))
    turn = rng.normal(size=x.shape)
    turn = unit(turn - (turn * x).sum(axis=1, keepdims=True) * x)
    cos = np.where(np.arange(600) % 2 == 0, 0.905, 0.895)[:, None]
    y = cos * x + np.sqrt(1 - cos**2) * turn
    vectors = np.concatenate((x, y)).tolist()
    got = result(itq.near_duplicates(spark.createDataFrame([(i, v, None) for i, v in enumerate(vectors)], SCHEMA)))
    want = brute(list(range(1200)), vectors)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.9 * sum(w[0] for w in want.values())


def test_hot_group_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 32)
    rng = np.random.default_rng(4)
    base = rng.normal(size=12)
    vectors = [(base + 0.02 * rng.normal(size=12)).tolist() for _ in range(300)] + rng.normal(size=(200, 12)).tolist()
    got = result(itq.near_duplicates(spark.createDataFrame([(i, v, None) for i, v in enumerate(vectors)], SCHEMA)))
    want = brute(list(range(500)), vectors)
    assert [got[i] for i in range(300)] == [want[i] for i in range(300)]


def test_defined_cases(spark):
    v = [1.0, 2.0, 0.5]
    rows = [(5, v), (3, v), (3, v), (4, [2.0, 4.0, 1.0]), (1, None), (2, []), (6, [0.0, 0.0, 0.0]), (7, [float("nan"), 1.0, 1.0]), (8, [None, 1.0, 1.0]),
            (None, v), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -0.5])]
    out = itq.near_duplicates(spark.createDataFrame([(i, x, None) for i, x in rows], SCHEMA)).collect()
    assert len(out) == len(rows)
    got = {r.vec_id: tuple(r[1:]) for r in out}
    assert got[3] == (4, 3, True) and got[5] == (4, 3, False) and got[4] == (4, 3, False) and got[None] == (4, 3, False)
    assert all(got[i] == (0, i, True) for i in (1, 2, 6, 7, 8, 9, 10))
    assert itq.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
