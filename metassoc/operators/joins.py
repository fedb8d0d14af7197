"""Join helpers with explicit size checks.

A side is broadcast only after its rows and bytes were measured against bounds; beyond either the
join falls back to a salted shuffle join, so a hot key (e.g. one cohort holding a third of all
variants) is spread over ``salts`` tasks instead of landing in one.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20


def row_bytes(df: DataFrame):
    """Approximate bytes of a row: eight per number and array entry, one per character."""
    total = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        if kind.startswith("array<array"):
            cells = F.size(name) * F.coalesce(F.size(F.get(F.col(name), F.lit(0))), F.lit(0)) * 8
        elif kind.startswith("array"):
            cells = F.size(name) * 8
        else:
            cells = F.length(name) if kind == "string" else F.lit(8)
        total = total + F.coalesce(cells.cast("long"), F.lit(0)) + 8
    return total


def measured_rows(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Persist a (small, aggregated) table and measure (rows, bytes) once; the join reuses the persisted copy."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    r = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return df, r[0], r[1] or 0


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, salt_by: str | None = None,
               salts: int = 64, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with ``small`` on ``on``: broadcast when ``small`` has at most ``max_rows`` rows and
    ``max_bytes`` bytes.

    Otherwise a shuffle join; if ``salt_by`` names a high-cardinality column of ``big``, the
    join key is extended by ``pmod(hash(salt_by), salts)`` and ``small`` is replicated over the
    salts, which bounds the work of any single join key by 1/salts of its rows.
    """
    small, n, size = measured_rows(small)
    if n <= max_rows and size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    if salt_by is None:
        return big.join(small, on, how)
    keys = [on] if isinstance(on, str) else list(on)
    b = big.withColumn("_salt", F.pmod(F.hash(F.col(salt_by)), F.lit(salts)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, keys + ["_salt"], how).drop("_salt")
