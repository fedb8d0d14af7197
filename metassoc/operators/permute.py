"""Phenotype permutation (null distribution): phenotype values move between the samples of a
cohort, genotypes and covariates stay.  The permutation is seeded and reproducible:

    key(sample) = md5(sample_id ':' seed), as text

and the sample with the r-th smallest id receives the phenotypes of the sample with the r-th smallest
(key, id).  Ids may be numbers or strings; another seed gives an unrelated permutation.  Ranks come from a
globally sorted numbering of the sample table (``ranks.rank_within``), never from a per-cohort task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import rank_within


def permutation_key(sample_id, seed: int):
    return F.md5(F.concat_ws(":", F.col(sample_id).cast("string"), F.lit(str(seed))).cast("binary"))


def permute_samples(samples: DataFrame, seed: int) -> DataFrame:
    """(cohort, sample_id, source_id): sample_id takes the phenotypes of source_id."""
    s = samples.select("cohort", "sample_id").withColumn("_k", permutation_key("sample_id", seed))
    by_id = rank_within(s, "cohort", "sample_id", "_r")
    by_key = rank_within(s, "cohort", ["_k", "sample_id"], "_r")
    return (by_id.select("cohort", "sample_id", "_r")
            .join(by_key.select("cohort", "_r", F.col("sample_id").alias("source_id")), ["cohort", "_r"])
            .drop("_r"))


def permute_phenotype(phenotype: DataFrame, samples: DataFrame, seed: int) -> DataFrame:
    """Phenotype rows relabelled to their permuted sample (x of the receiving sample attached)."""
    perm = permute_samples(samples, seed)
    p = phenotype.select("cohort", F.col("sample_id").alias("source_id"), "phenotype", "y")
    out = p.join(perm, ["cohort", "source_id"]).drop("source_id")
    return out.join(samples.select("cohort", "sample_id", "x"), ["cohort", "sample_id"])
