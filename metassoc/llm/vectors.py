"""Helpers for the operators on embedding vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, every component finite, some component not zero."""
    infinite = F.lit(float("inf"))
    fine = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def split_usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the usable rows."""
    vec = F.col(vec_col).cast("array<double>")
    return df.where(usable(vec)).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))


def dimensions(rows: DataFrame) -> dict[int, int]:
    """Rows by vector length (vectors of different lengths are never compared)."""
    return {r.d: r.n for r in rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision; scaled by the largest component first, so nothing overflows."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
