"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from metassoc.llm import hnsw
from metassoc.llm.queries import QUERIES
from metassoc.llm.vectors import unit

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, queries, k):
    """rows: {id: vector}.  {query: [(id, score)]}"""
    ids = sorted(rows)
    x = unit(np.array([rows[i] for i in ids]))
    out = {}
    for q in queries:
        s = x @ unit(np.array([rows[q]]))[0]
        out[q] = sorted(((i, v) for i, v in zip(ids, s, strict=True) if i != q), key=lambda p: (-p[1], p[0]))[:k]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_the_driver_table(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}
    got = {}
    for r in QUERIES["op3_nearest"](spark, d).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, [i for i in rows if i % 50 == 0], 5)
    assert set(got) == set(want)
    hit = total = 0
    for q, near in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(near) + 1))
        x, y = unit(np.array([rows[q]]))[0], unit(np.array([rows[i] for _, i, _ in found]))
        assert np.allclose(y @ x, [s for _, _, s in found], atol=1e-12)
        hit += len({i for _, i, _ in found} & {i for i, _ in near})
        total += len(near)
    assert hit / total >= 0.9


def test_many_small_shards_merge(spark):
    rng = np.random.default_rng(2)
    rows = {i: rng.normal(size=8).tolist() for i in range(300)}
    df = spark.createDataFrame([(i, v, "x") for i, v in rows.items()], SCHEMA)
    got = {}
    for r in hnsw.nearest(df, df.where("vec_id % 7 = 0"), k=4, shard_rows=40).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = brute(rows, [i for i in rows if i % 7 == 0], 4)
    hits = sum(len({v for _, v in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 4 * len(want)


def test_near_copies_do_not_cut_off_the_rest(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = {i: (base + 1e-3 * rng.normal(size=16)).tolist() if i % 2 else rng.normal(size=16).tolist() for i in range(1200)}
    df = spark.createDataFrame([(i, v, "x") for i, v in rows.items()], SCHEMA)
    got = {}
    for r in hnsw.nearest(df, df.where("vec_id % 20 < 2"), k=5).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(rows, [i for i in rows if i % 20 < 2], 5)
    assert sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_defined_cases(spark):
    v = [1.0, 2.0]
    rows = [(1, v), (2, v), (3, v), (0, v), (0, v), (4, [2.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [float("nan"), 1.0]),
            (9, [float("inf"), 1.0]), (10, [None, 1.0]), (None, v), (11, [1.0, 2.0, 3.0]), (12, [1e200, -3e200])]
    df = spark.createDataFrame([(i, x, None) for i, x in rows], SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id) for r in hnsw.nearest(df, df, k=3).collect()]
    assert sorted(g for g in got if g[0] == 0) == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]      # equal vectors: smaller ids first
    assert len([g for g in got if g[0] == 12]) == 3
    assert {g[0] for g in got} == {0, 1, 2, 3, 4, 12}        # 11 has no partner of its length
    none = spark.createDataFrame([], SCHEMA)
    assert hnsw.nearest(none, none).count() == 0 and hnsw.nearest(df, none).count() == 0
