"""Contiguous row numbers and dense ranks inside groups, JVM-only and without a per-group task.

``row_index``: rows are numbered in their current order (file order for text/CSV/Parquet scans)
with ``monotonically_increasing_id`` (partition id in the high bits, row in the low bits); the
numbered table is checkpointed into the shared checkpoint folder so that the per-partition row
counts and the rows come from the same partitioning; the counts (one row per partition) give each
partition's offset.

``rank_within``: a window ``row_number() OVER (PARTITION BY g ORDER BY k)`` would sort a whole
group in one task — with a hot group (a cohort holding a third of all samples) that task does a
third of the work.  Instead the rows are range-partitioned and sorted globally on (g, k), split
evenly whatever the group sizes, numbered with ``row_index``, and each group's first index (one
row per group) is subtracted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage


def row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    numbered = cut_lineage(df.withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), 33)
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_c"))
    # one row per partition: the prefix sum is a tiny single-partition window
    offs = counts.withColumn("_off", F.coalesce(
        F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    return (numbered.withColumn("_pid", pid).join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
            .drop("_pid", "_off", "_mid"))


def rank_within(df: DataFrame, group: str, order: str | list[str], name: str = "rank") -> DataFrame:
    order = [order] if isinstance(order, str) else list(order)
    numbered = row_index(df.orderBy(group, *order), "_gidx")
    first = numbered.groupBy(group).agg(F.min("_gidx").alias("_g0"))
    # one row per group (cohorts); Spark broadcasts it below its threshold and splits a skewed join otherwise
    return (numbered.join(first, group)
            .withColumn(name, F.col("_gidx") - F.col("_g0")).drop("_gidx", "_g0"))
