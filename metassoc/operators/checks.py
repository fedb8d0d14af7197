"""Consistency checks as small DataFrames (no printing, no driver loops over data)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once (ids and names must be unique within a dataset)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: list[str], what: str = "ids") -> None:
    if duplicates(df, keys).limit(1).count():
        raise ValueError(f"duplicated {what}: {keys}")


def converter_check(samples: DataFrame, probes: DataFrame, genotype: DataFrame) -> DataFrame:
    """Per cohort: number of individuals, probes and genotype rows and whether they agree
    (probes == genotype rows, every dense row as long as the sample count)."""
    s = samples.groupBy("cohort").agg(F.count(F.lit(1)).alias("individuals"))
    p = probes.groupBy("cohort").agg(F.count(F.lit(1)).alias("probes"))
    g = genotype.groupBy("cohort").agg(F.count(F.lit(1)).alias("genotype_rows"),
                                       F.min(F.size("dosage")).alias("_lo"), F.max(F.size("dosage")).alias("_hi"))
    j = s.join(p, "cohort", "full").join(g, "cohort", "full")
    ok = ((F.col("probes") == F.col("genotype_rows")) & (F.col("_lo") == F.col("individuals"))
          & (F.col("_hi") == F.col("individuals")))
    return j.withColumn("consistent", F.coalesce(ok, F.lit(False))).drop("_lo", "_hi")


def pd_consistency(pd: dict[str, DataFrame]) -> DataFrame:
    """Per cohort summary that should be similar between cohorts: mean covariates (A_cov row 0 / n),
    mean allele frequency (Σg/n/2 averaged over variants), mean phenotype (Σy/n averaged)."""
    cov = pd["pd_cov"].select("cohort", "n", F.transform(F.col("a_cov")[0], lambda v: v / F.col("n")).alias("cov_means"))
    af = pd["pd_test"].groupBy("cohort").agg(F.avg("maf").alias("mean_af"))
    ph = (pd["pd_pheno"].join(F.broadcast(pd["pd_cov"].select("cohort", "n")), "cohort")
          .groupBy("cohort").agg(F.avg(F.col("b")[0] / F.col("n")).alias("mean_phenotype")))
    return cov.join(af, "cohort", "left").join(ph, "cohort", "left")


def maf_spread(pd_test: DataFrame, max_sd: float = 0.1) -> DataFrame:
    """Variants whose MAF standard deviation across cohorts exceeds ``max_sd`` (population SD)."""
    return (pd_test.groupBy("variant").agg(F.stddev_pop("maf").alias("maf_sd"))
            .where(F.col("maf_sd") > max_sd))


def singular_variants(vt_with_flag: DataFrame) -> DataFrame:
    """Diagnostics of dropped designs: rows of ``variant_terms(..., keep_singular=True)`` flagged singular."""
    return vt_with_flag.where(F.col("singular") | (F.col("df") <= 0)).select("cohort", "variant", "s", "df")
