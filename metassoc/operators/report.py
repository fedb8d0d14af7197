"""Result reporting: β from t·SE, p-values, summary table, annotation with probe information."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pvalues import p_value


def beta_from_t(t, se):
    """β = t · SE (the single-site files store t and SE)."""
    return F.col(t) * F.col(se)


def t_filter(df: DataFrame, threshold: float | None, t_col: str = "t_stat") -> DataFrame:
    """Keep |t| > threshold; with no threshold keep |t| > 0 (drops 0 and NaN)."""
    t = F.col(t_col)
    return df.where(~F.isnan(t) & (F.abs(t) > F.lit(float(threshold or 0.0))))


def summarise(assoc: DataFrame, df_col: str | None = "df", keep: tuple[str, ...] = ()) -> DataFrame:
    """[keep,] RSID, p_value, t_stat, phenotype, SE, MAF, BETA (Student t with ``df_col``, normal when None)."""
    p = p_value("t_stat", df_col) if df_col else p_value("t_stat")
    return assoc.select(*keep, F.col("variant").alias("RSID"), p.alias("p_value"), "t_stat", "phenotype",
                        F.col("standard_error").alias("SE"), F.col("maf").alias("MAF"), F.col("beta").alias("BETA"))


def annotate(results: DataFrame, probes: DataFrame) -> DataFrame:
    """Inner join RSID = ID with probe columns (alleles, Rsq); MAF becomes AF_coded.

    The probe table is one row per variant — joined by key (shuffle or AQE broadcast), not
    collected."""
    r = results.withColumnRenamed("MAF", "AF_coded")
    return r.join(probes, r.RSID == probes.ID).drop("ID")
