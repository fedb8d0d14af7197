"""Registry of named queries over the driver tables, each with an optional DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.  Double columns are
cut to 24 significant bits on both sides before hashing, whatever their size: nothing is set to zero.
Operators and jobs return full doubles; only this registry cuts.  Decimal rounding
fails in both directions on this data: the fixture's exact sums carry 5 to 14 decimal places, so
any decimal cut meets exact decimal ties that the two engines break differently, and a coarse
enough cut to avoid them hides real differences.  The binary cut (multiply by 2^29 + 1, subtract the
difference) is plain IEEE arithmetic in both engines, exact decimal data almost never lies on its
midpoints (about 2^-28 per value), and summation-order noise (~1e-15 relative) is far below its unit (6e-8).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import dense_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SPLIT = 536870913.0      # 2^29 + 1: keeps 24 of 53 bits
HUGE = 1e290             # beyond it the multiplication would overflow


def snap(c):
    """Comparison form of a double: rounded to 24 significant bits; -0.0 -> 0.0."""
    big = c * F.lit(SPLIT)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(HUGE)), c).otherwise(big - (big - c)) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(snap(F.col(f.name).cast("double")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, pairs: bool = False):
    """Register ``fn(spark, sf_dir)``; the result is rounded like the oracle.  ``pairs``: it has a row for every pair of vectors, so
    its files are as large as its doubles (see ``session.dense_files``)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if pairs:
                dense_files(spark)
            return rounded(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
