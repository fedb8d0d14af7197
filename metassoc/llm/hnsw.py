"""Operator 3: approximate nearest neighbours by one hierarchical navigable small-world graph per shard.

Rows are dealt to shards of bounded size by a hash.  Each shard's graph is one row of flat arrays: vectors, ids, and per
layer the node numbers and a fixed number of neighbour slots per node.  A node enters the graph in random order and picks
its neighbours among the nodes before it, keeping a candidate only if it is nearer to the node than to every neighbour
kept so far; links are then made mutual and each list is cut by the same rule.  Query blocks visit every shard, and the
shards' results are merged by the exact cosine.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metassoc.llm.common import staged
from metassoc.llm.vectors import dimensions, split_usable, unit
from metassoc.session import prepare

SHARD_ROWS = 4096
QUERY_BLOCK = 2048
LINKS = 16                # neighbour slots per node in the upper layers, twice as many in the lowest
CANDIDATES = 96           # candidates considered when a node picks its neighbours
EF = 96                  # width of the search in the lowest layer


class Graph:
    """layers: from the lowest up, (node numbers, neighbour slots); -1 fills unused slots."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry
        self.place = []
        for nodes, _ in layers:
            at = np.full(len(vectors), -1, np.int32)
            at[nodes] = np.arange(len(nodes), dtype=np.int32)
            self.place.append(at)
        self.seen = np.zeros(len(vectors), np.int32)
        self.stamp = 0

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES, seed: int = 7) -> Graph:
        """vectors: distinct unit rows (float32), in an order that does not depend on their place in space."""
        rng = np.random.default_rng(seed)
        level = (-np.log(1.0 - rng.random(len(vectors))) / np.log(links)).astype(int)
        layers, entry = [], int(level.argmax())
        for i in range(int(level.max()) + 1):
            nodes = np.flatnonzero(level >= i).astype(np.int32)
            layers.append((nodes, nodes_links(vectors[nodes], links * (2 if i == 0 else 1), links, candidates, nodes)))
        return cls(vectors, layers, entry)

    def search(self, q: np.ndarray, width: int) -> list[int]:
        """Up to ``width`` nodes near the unit vector q."""
        best = [(float(self.vectors[self.entry] @ q), self.entry)]
        for i in range(len(self.layers) - 1, -1, -1):
            best = self._layer(q, best, 1 if i else width, i)
        return [node for _, node in best]

    def _layer(self, q, start, width, i):
        _, slots = self.layers[i]
        place, seen, vectors = self.place[i], self.seen, self.vectors
        self.stamp += 1
        stamp = self.stamp
        found = list(start)               # min-heap: the worst found is first
        heapq.heapify(found)
        todo = [(-s, n) for s, n in start]
        heapq.heapify(todo)
        for _, n in start:
            seen[n] = stamp
        while todo:
            s, n = heapq.heappop(todo)
            if len(found) >= width and -s < found[0][0]:
                break
            near = slots[place[n]]
            near = near[near >= 0]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            for s, n in zip((vectors[near] @ q).tolist(), near.tolist(), strict=True):
                if len(found) < width:
                    heapq.heappush(found, (s, n))
                elif s > found[0][0]:
                    heapq.heapreplace(found, (s, n))
                else:
                    continue
                heapq.heappush(todo, (-s, n))
        return found


def nodes_links(x: np.ndarray, slots: int, links: int, candidates: int, names: np.ndarray) -> np.ndarray:
    """Neighbour slots of one layer, as names of nodes.  Memory: the square of a shard, in single precision."""
    n = len(x)
    sim = x @ x.T
    out: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        row = sim[i, :i]
        near = np.argpartition(-row, candidates)[:candidates] if i > candidates else np.arange(i)
        for j in pick(sim, i, near, links):
            out[i].append(j)
            out[j].append(i)
    got = np.full((n, slots), -1, np.int32)
    for i in range(n):
        kept = out[i] if len(out[i]) <= slots else pick(sim, i, np.array(out[i]), slots)
        got[i, :len(kept)] = names[kept]
    return got


def pick(sim: np.ndarray, i: int, near: np.ndarray, most: int) -> list[int]:
    """Nearest first, those nearer to i than to any picked before; free slots go to the nearest left over."""
    near = near[np.argsort(-sim[i, near], kind="stable")]
    among, own = sim[np.ix_(near, near)], sim[i, near]
    closest = np.full(len(near), -np.inf)        # similarity to the nearest one picked
    picked, left = [], []
    for a in range(len(near)):
        if closest[a] < own[a]:
            picked.append(a)
            if len(picked) == most:
                break
            np.maximum(closest, among[a], out=closest)
        else:
            left.append(a)
    return near[picked + left[:max(0, most // 2 - len(picked))]].tolist()


def build_shards(rows: DataFrame, n_rows: int, dim: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One graph per shard of (id, vec): a table of flat arrays, written to the shared folder.

    Equal vectors of a shard are one node with a list of ids."""
    shards = max(1, -(-n_rows // shard_rows))
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["id"].to_numpy(np.int64)
        x = np.stack(group["vec"].to_numpy()).astype(np.float64)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        _, first, node = np.unique(x, axis=0, return_index=True, return_inverse=True)
        shuffled = np.random.default_rng(11).permutation(len(first))
        rank = np.empty(len(first), np.int64)
        rank[shuffled] = np.arange(len(first))
        node = rank[node.ravel()]
        x = x[first[shuffled]]
        order = np.lexsort((ids, node))              # ids by node, ascending within a node; a repeated row counts once
        fresh = np.concatenate(([True], (np.diff(node[order]) != 0) | (np.diff(ids[order]) != 0)))
        order = order[fresh]
        graph = Graph.build(unit(x).astype(np.float32))
        return pd.DataFrame([{
            "shard": int(group["shard"].iloc[0]), "nodes": len(x), "entry": graph.entry, "vectors": x.tobytes(),
            "ids": ids[order].tobytes(), "id_ends": np.cumsum(np.bincount(node[order])).astype(np.int64).tobytes(),
            "layer_nodes": [n.tobytes() for n, _ in graph.layers], "layer_slots": [s.tobytes() for _, s in graph.layers]}])

    return staged(keyed.groupBy("shard").applyInPandas(
        run, "shard int, nodes int, entry int, vectors binary, ids binary, id_ends binary, layer_nodes array<binary>, layer_slots array<binary>"), "hnsw")


def load(row, dim: int) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, original vectors, ids, where each node's ids end)"""
    x = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
    layers = []
    for nodes, slots in zip(row["layer_nodes"], row["layer_slots"], strict=True):
        nodes = np.frombuffer(nodes, np.int32)
        layers.append((nodes, np.frombuffer(slots, np.int32).reshape(len(nodes), -1)))
    return Graph(unit(x).astype(np.float32), layers, int(row["entry"])), x, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["id_ends"], np.int64)


def search_shards(shards: DataFrame, queries: DataFrame, n_queries: int, dim: int, k: int, ef: int = EF) -> DataFrame:
    """(query_id, vec_id, score): each query's k best of every shard, rows of the query's own id left out."""
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    known = [r.shard for r in shards.select("shard").collect()]       # one number per shard
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.array(*map(F.lit, known)))))
    dealt = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            graph, x, ids, ends = load(left.iloc[0], dim)
            exact = unit(x)
            for own, q in zip(right["id"].tolist(), unit(np.stack(right["vec"].to_numpy())), strict=True):
                near = np.array(graph.search(q.astype(np.float32), ef))
                score = (exact[near] * q).sum(axis=1)        # row by row, so that equal vectors score equally in every shard
                order = np.argsort(-score, kind="stable")
                found: list[tuple[float, int]] = []
                for node, s in zip(near[order].tolist(), score[order].tolist(), strict=True):
                    if len(found) >= k and s < found[k - 1][0]:
                        break
                    first = ends[node - 1] if node else 0
                    found += [(s, i) for i in ids[first:min(ends[node], first + k + 1)].tolist() if i != own]
                found.sort(key=lambda f: (-f[0], f[1]))
                out += [(own, i, s) for s, i in found[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(run, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            ef: int = EF, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k nearest rows of ``df`` found, by cosine, nearest first, ties to the
    smaller id; rows with the query's id are left out.

    Ids are integers.  Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    null ids; vectors of different lengths are never compared; a repeated row counts once; other columns are not read;
    an empty table gives no rows."""
    spark = prepare(df.sparkSession)
    rows = split_usable(df, id_col, vec_col).where("id is not null")
    asked = staged(split_usable(queries, id_col, vec_col).where("id is not null").dropDuplicates(["id"]), "queries")
    wanted = dimensions(asked)
    parts = []
    for dim, n in sorted(dimensions(rows).items()):
        if dim in wanted:
            shards = build_shards(rows.where(F.size("vec") == dim), n, dim, shard_rows)
            parts.append(search_shards(shards, asked.where(F.size("vec") == dim), wanted[dim], dim, k, ef))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = reduce(DataFrame.union, parts).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
