"""Shared helpers: driver tables, staging tables in the shared folder, components of a link table."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metassoc.session import prepare, shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The written table survives lost executors and fixes row numbering that depends on the partitioning."""
    spark = prepare(df.sparkSession)
    path = shared_path(spark, f"llm-{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slots(spark: SparkSession) -> int:
    """Tasks to deal CPU-heavy work over: a few per core, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def give_back() -> None:
    """What a task has freed goes back to the system at its end, so that a Python worker that waits for its next task holds
    little.  Does nothing where the C library cannot."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def lean(run):
    """A task's function on batches that gives memory back in the end."""
    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def lean_group(run):
    """The same for a function on one group."""
    @wraps(run)
    def task(group):
        try:
            return run(group)
        finally:
            give_back()
    return task


def text_key(text: Column) -> Column:
    """128-bit key of a text (two independent 64-bit hashes as one string)."""
    return F.md5(text)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table: (node, component), component = smallest node.

    Alternating large-star and small-star rounds; each round's edges are written to the shared folder, and a
    round that changes nothing ends the loop (logarithmically many rounds; ``max_rounds`` only guards against
    a bug and raises).  Nulls and loops take no part; an empty edge table gives an empty result."""
    cur = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
           .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    cur = staged(cur, "edges")
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour of u is linked to the smallest node around u
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u != v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        new = staged(small, "edges")
        if _same(cur, new):
            return new.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
                new.select("v", F.col("v")).distinct())
        cur = new
    raise RuntimeError("connected components did not settle")


def _same(x: DataFrame, y: DataFrame) -> bool:
    def mark(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]
    return mark(x) == mark(y)
