"""Small dense linear algebra on array<array<double>> columns, as native higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _identity_row(p: Column, i: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), p - 1), lambda j: F.when(j == i, F.lit(1.0)).otherwise(F.lit(0.0)))


def spd_inverse(m, tol: float = 1e-12) -> Column:
    """Inverse of a symmetric positive-definite p×p matrix by Gauss–Jordan elimination.

    No pivoting is needed for SPD matrices (every leading pivot is positive).  The k-th pivot is
    the Schur complement of the leading block; when it is not above ``tol`` times the original
    diagonal entry the matrix is (numerically) singular and the result is NULL.
    """
    m = F.col(m) if isinstance(m, str) else m
    p = F.size(m)
    aug = F.transform(m, lambda row, i: F.concat(row.cast("array<double>"), _identity_row(p, i)))

    def step(acc, k):
        piv = F.get(F.get(acc, k), k)
        ok = piv > F.lit(tol) * F.abs(F.get(F.get(m, k), k))
        prow = F.transform(F.get(acc, k), lambda x: F.when(ok, F.try_divide(x, piv)))
        return F.transform(acc, lambda row, i: F.when(i == k, prow).otherwise(
            F.zip_with(row, prow, lambda x, y: x - F.get(row, k) * y)))

    res = F.aggregate(F.sequence(F.lit(0), p - 1), aug, step)
    inv = F.transform(res, lambda row: F.slice(row, p + 1, p))
    bad = F.exists(F.flatten(inv), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(bad, F.lit(None)).otherwise(inv)


UNROLLED = 8              # largest p whose inverse is written out entry by entry


def with_inverse_n(df: DataFrame, m: str, out: str, p: int, tol: float = 1e-12) -> DataFrame:
    """``df`` with the inverse of the p×p column ``m`` as ``out``, without the rows whose matrix is singular: ``spd_inverse`` written
    out for a small p known when the plan is built, one projection per pivot, which whole-stage codegen compiles."""
    names = [f"_{out}_{i}_{j}" for i in range(p) for j in range(p)]
    at = lambda i, j: F.col(names[i * p + j])
    rest = df.columns
    df = df.select("*", *[F.col(m)[i][j].alias(names[i * p + j]) for i in range(p) for j in range(p)])
    for k in range(p):
        pivot = F.when(at(k, k) > F.lit(tol) * F.abs(F.col(m)[k][k]), at(k, k))
        df = df.select(*rest, *names, pivot.alias("_pivot")).where(F.col("_pivot").isNotNull())
        row = [F.lit(1.0) if j == k else at(k, j) for j in range(p)]
        df = df.select(*rest, *names, *[(e / F.col("_pivot")).alias(f"_row_{j}") for j, e in enumerate(row)])
        r = [F.col(f"_row_{j}") for j in range(p)]
        df = df.select(*rest, *[(r[j] if i == k else (F.lit(0.0) if j == k else at(i, j)) - at(i, k) * r[j]).alias(names[i * p + j])
                                for i in range(p) for j in range(p)])
    finite = F.lit(True)
    for n in names:
        finite &= ~F.isnan(n) & (F.abs(F.col(n)) != float("inf"))
    rows = [F.array(*[at(i, j) for j in range(p)]) for i in range(p)]
    return df.where(finite).select(*rest, F.array(*rows).alias(out))
