"""Operator 9: near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a bounded sample: alternately binary codes and the rotation that brings the sample nearest to
them (orthogonal Procrustes), so that few vectors lie near an axis plane and the codes are balanced.  A bit is the sign
along a rotated axis; it does not depend on how many vectors crowd a direction.  Later rotations learn for fewer rounds,
which keeps them different.  Each code is cut into substrings; a substring is the key of one table, and vectors that share a key in any table are retrieved.
The substring length follows the number of rows, so buckets do not grow with the data; rotations are added until a pair
at the threshold is retrieved with the wanted probability, measured on sample vectors turned by just that angle.

Retrieved vectors are reranked with the original vectors, in double precision, bucket by bucket; a bucket too large for
one block is dealt out in pairs of blocks.  A pair counts in the first table in which it meets, so no list of pairs is
needed: a block returns only each vector's number of links and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metassoc.llm.common import components, staged
from metassoc.llm.vectors import dimensions, split_usable, unit, usable
from metassoc.session import prepare

THRESHOLD = 0.9
SAMPLE_ROWS = 4000        # vectors that rotations, medians and the number of tables are fitted on
ROUNDS = 30               # of learning the first rotation; the k-th learns for the k-th part of them
RECALL = 0.98             # wanted probability of retrieving a pair just at the threshold
BUCKET_BITS = 3           # substrings are so many bits shorter than log2(rows): 2**3 vectors a bucket on average
MAX_TABLES = 512          # a guard against endless fitting; reaching it is an error
BLOCK = 1024              # vectors of a bucket compared with as many others at a time
GROUP_ROWS = 8192         # table entries in one group of buckets, on average


def learn_rotation(x: np.ndarray, seed: int, rounds: int) -> np.ndarray:
    """Orthogonal matrix after ``rounds`` of iterative quantisation from a random start."""
    rng = np.random.default_rng(seed)
    r, _ = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))
    for _ in range(rounds):
        rotated = x @ r
        u, _, v = np.linalg.svd(np.where(rotated > 0, 1.0, -1.0).T @ x)
        r = (u @ v).T
    return r


class Tables:
    """One table per entry of ``columns``: the axes whose signs make its key."""

    def __init__(self, bits: int, columns: list[np.ndarray]):
        self.bits, self.columns = bits, columns

    def keys(self, x: np.ndarray) -> np.ndarray:
        """rows x tables (uint32) of unit rows."""
        weight = (1 << np.arange(self.bits)).astype(np.uint32)
        return np.stack([(x @ a > 0) @ weight for a in self.columns], axis=1).astype(np.uint32)


def fit(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 1) -> Tables:
    """Tables for ``rows`` vectors, fitted on unit sample rows."""
    dim = sample.shape[1]
    bits = int(np.clip(round(np.log2(max(rows, 2))) - BUCKET_BITS, 2, 30))
    rng = np.random.default_rng(seed)
    base = sample[rng.integers(0, len(sample), 4000)]
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(axis=1, keepdims=True) * base
    norm = np.sqrt((turn * turn).sum(axis=1, keepdims=True))
    near = threshold * base + np.sqrt(max(0.0, 1 - threshold**2)) * turn / np.where(norm > 0, norm, 1)
    tables, met, spare, rotations = Tables(bits, []), np.zeros(len(base), bool), np.zeros((dim, 0)), 0
    while met.mean() < recall:
        while spare.shape[1] < bits:
            spare = np.concatenate((spare, learn_rotation(sample, seed + rotations, ROUNDS // (1 + rotations))), axis=1)
            rotations += 1
        new = Tables(bits, [spare[:, :bits]])
        tables.columns += new.columns
        spare = spare[:, bits:]
        met |= (new.keys(base) == new.keys(near))[:, 0]
        if len(tables.columns) > MAX_TABLES:
            raise RuntimeError("the wanted recall is out of reach for these vectors")
    return tables


def _entries(nodes: DataFrame, tables: Tables, dim: int) -> DataFrame:
    """(node, weight, vec binary, keys binary, key array<long>) of (node, weight, vec): vectors as unit rows."""
    sent = nodes.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(batch.column(2).flatten().to_numpy().reshape(-1, dim))
            keys = sent.value.keys(x)
            n, t = keys.shape
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in keys], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * t), pa.array(keys.astype(np.int64).ravel()))],
                names=["node", "weight", "vec", "keys", "key"])

    return nodes.select("node", "weight", "vec").mapInArrow(run, "node string, weight long, vec binary, keys binary, key array<long>")


def compare(x: np.ndarray, keys: np.ndarray, weight: np.ndarray, table: int, left: np.ndarray, right: np.ndarray, same: bool,
            threshold: float, count: np.ndarray, root: np.ndarray) -> None:
    """Add to ``count`` the weights of linked partners that first meet in ``table``, and join their trees in ``root``."""
    near = x[left] @ x[right].T >= threshold
    if same:
        near = np.triu(near, 1)
    if not near.any():
        return
    for t in range(table):
        near &= keys[left, t][:, None] != keys[right, t][None, :]
    a, b = np.nonzero(near)
    a, b = left[a], right[b]
    np.add.at(count, a, weight[b])
    np.add.at(count, b, weight[a])
    while len(a):                        # union by smallest index, all links at once
        ra, rb = root[a], root[b]
        on = ra != rb
        a, b, ra, rb = a[on], b[on], ra[on], rb[on]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


def _rerank(dealt: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links, other): partial link weights per vector, and the links of a spanning forest (links 0)."""
    def run(group: pa.Table) -> pa.Table:
        node, weight = group["node"].to_pylist(), group["weight"].to_numpy().astype(np.int64)
        x = np.frombuffer(b"".join(group["vec"].to_pylist()), np.float64).reshape(len(node), dim)
        keys = np.frombuffer(b"".join(group["keys"].to_pylist()), np.uint32).reshape(len(node), -1)
        table, key, i, j, m = (group[c].to_numpy() for c in ("t", "k", "i", "j", "m"))
        order = np.lexsort((j, i, key, table))
        cuts = np.flatnonzero((np.diff(table[order]) != 0) | (np.diff(key[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        count, root = np.zeros(len(node), np.int64), np.arange(len(node))
        for part in np.split(order, cuts):
            p = part[0]
            left = part[m[part] == i[p]]
            if i[p] == j[p]:
                for lo in range(0, len(left), BLOCK):
                    for hi in range(lo, len(left), BLOCK):
                        compare(x, keys, weight, int(table[p]), left[lo:lo + BLOCK], left[hi:hi + BLOCK], lo == hi, threshold, count, root)
            else:
                right = part[m[part] == j[p]]
                for lo in range(0, len(left), BLOCK):
                    for hi in range(0, len(right), BLOCK):
                        compare(x, keys, weight, int(table[p]), left[lo:lo + BLOCK], right[hi:hi + BLOCK], False, threshold, count, root)
        some, tree = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(node)))
        return pa.table({
            "node": pa.array([node[a] for a in [*some, *tree]], pa.string()), "links": pa.array([*count[some].tolist(), *[0] * len(tree)], pa.int64()),
            "other": pa.array([*[None] * len(some), *[node[root[a]] for a in tree]], pa.string())})

    return dealt.groupBy("g").applyInArrow(run, "node string, links long, other string")


def _link(nodes: DataFrame, n: int, dim: int, threshold: float) -> DataFrame:
    """See ``_rerank``; nodes are different vectors of one length."""
    drawn = nodes.select("vec").orderBy(F.xxhash64("node")).limit(SAMPLE_ROWS).collect()
    tables = fit(unit(np.array([r.vec for r in drawn])), n, threshold)
    entries = staged(_entries(nodes, tables, dim), "codes")
    keyed = entries.select(F.posexplode("key").alias("t", "k"))
    full = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    rows = entries.select("node", "weight", "vec", "keys", F.posexplode("key").alias("t", "k")).join(full, ["t", "k"])
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    groups = max(1, n * len(tables.columns) // GROUP_ROWS)
    dealt = (rows.withColumn("m", F.pmod(F.xxhash64("node", F.lit(3)), parts).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), parts - 1)))
             .withColumn("i", F.least("m", "o")).withColumn("j", F.greatest("m", "o"))
             .withColumn("g", F.when(parts == 1, F.pmod(F.xxhash64("t", "k"), F.lit(groups)))
                         .otherwise(-1 - F.pmod(F.xxhash64("t", "k", "i", "j"), F.lit(1 << 40)))))
    return _rerank(dealt.select("g", "t", "k", "i", "j", "m", "node", "weight", "vec", "keys"), dim, threshold)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row: other rows linked with it directly (cosine >= ``threshold``
    among the pairs retrieved), the smallest id reachable by links (its own included), and whether that is its own.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
    lengths never link; equal vectors (also of repeated rows) always do.  Null ids count as links but never as the
    smallest id; other columns are not read; an empty table gives no rows."""
    spark = prepare(df.sparkSession)
    name = F.concat_ws(":", F.hex(F.xxhash64(F.lit(1), "vec")), F.hex(F.xxhash64(F.lit(2), "vec")))
    rows = staged(split_usable(df, id_col, vec_col).withColumn("node", name), "vectors")
    nodes = staged(rows.groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.first("vec").alias("vec")), "nodes")
    found = spark.createDataFrame([], "node string, links long, other string")
    for dim, n in sorted(dimensions(nodes).items()):
        found = found.union(_link(nodes.where(F.size("vec") == dim), n, dim, threshold))
    found = staged(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.where("other is not null"), "node", "other")
    whole = nodes.join(links, "node", "left").join(label, "node", "left").select(
        "node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("c"), "least")
    smallest = whole.groupBy("c").agg(F.min("least").alias("component_id"))
    whole = whole.join(smallest, "c").select("node", "n_links", "component_id")
    linked = rows.join(whole, "node").select("id", "n_links", "component_id")
    alone = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    alone = alone.where(~usable(F.col("vec"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
