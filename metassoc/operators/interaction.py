"""Regression with genotype × factor interactions: y ~ 1 + covariates + g·f_1 + … + g·f_r + g.

The m = r + 1 variable terms are the interactions in the given factor order, then the genotype.
Per (cohort, variant) the full k×k matrix A = [[X̃ᵀX̃, X̃ᵀZ], [ZᵀX̃, ZᵀZ]] (k = p + m) is assembled from
sums and inverted natively (Gauss–Jordan on the row, singular designs dropped); per pair
B = [X̃ᵀy, Zᵀy], β = A⁻¹B, RSS = |yᵀy − βᵀB|, SE_j = √(RSS/(n − k) · A⁻¹[j, j]).  The reported effect
is the last term (genotype); the interaction effects are returned as arrays in factor order.
All sums come from one aggregate per (cohort, variant) and one per (cohort, variant, phenotype).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import array_dot, mat_vec, safe_div
from ..functions.linalg import spd_inverse
from .joins import DEFAULT_MAX_BROADCAST_ROWS, join_small
from .moments import _terms, _with_x, covariate_moments, phenotype_moments


def interaction_effects(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int,
                        factor: int | list[int] = 0,
                        max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """(cohort, variant, phenotype, beta, standard_error, beta_interaction, se_interaction,
    [betas_interaction, ses_interaction,] sample_size).

    ``factor`` is a covariate index (one interaction: scalar outputs) or a list of them (several:
    the array columns hold every interaction effect, the scalar ones the last)."""
    factors = [factor] if isinstance(factor, int) else list(factor)
    t = _terms("x", n_cov)
    p, m = len(t), len(factors) + 1
    k = p + m
    g = _with_x(genotype, samples)
    gd = F.col("dosage")
    z = [gd * F.col("x")[f] for f in factors] + [gd]          # variable terms, genotype last
    aggs = [F.array(*[F.sum(zi * ti) for ti in t]).alias(f"xz{i}") for i, zi in enumerate(z)]
    aggs += [F.sum(z[i] * z[j]).alias(f"zz{i}_{j}") for i in range(m) for j in range(i, m)]
    vt = g.groupBy("cohort", "variant").agg(*aggs)
    cov = covariate_moments(samples, n_cov)
    vt = vt.join(F.broadcast(cov), "cohort")                                   # one row per cohort

    def zz(i, j):
        return F.col(f"zz{min(i, j)}_{max(i, j)}")

    rows = [F.concat(F.col("a_cov")[r], F.array(*[F.col(f"xz{i}")[r] for i in range(m)])) for r in range(p)]
    rows += [F.concat(F.col(f"xz{i}"), F.array(*[zz(i, j) for j in range(m)])) for i in range(m)]
    vt = (vt.withColumn("ainv", spd_inverse(F.array(*rows)))
          .where(F.col("ainv").isNotNull() & (F.col("n") - k > 0))
          .select("cohort", "variant", "n", "ainv"))
    pt = phenotype_moments(phenotype, samples, n_cov)
    y = _with_x(phenotype, samples).select("cohort", "sample_id", "phenotype", "y")
    gz = g.select("cohort", "sample_id", "variant", *[zi.alias(f"_z{i}") for i, zi in enumerate(z)])
    zy = (gz.join(y, ["cohort", "sample_id"]).groupBy("cohort", "variant", "phenotype")
          .agg(*[F.sum(F.col(f"_z{i}") * F.col("y")).alias(f"zy{i}") for i in range(m)]))
    grid = join_small(vt, pt, "cohort", max_rows=max_broadcast_rows, salt_by="variant")
    grid = grid.join(zy, ["cohort", "variant", "phenotype"], "left").fillna(0.0, [f"zy{i}" for i in range(m)])
    B = F.concat(F.col("b"), F.array(*[F.col(f"zy{i}") for i in range(m)]))
    out = (grid.withColumn("_B", B).withColumn("_beta", mat_vec("ainv", "_B"))
           .withColumn("_rss", F.abs(F.col("c") - array_dot("_beta", "_B")))
           .withColumn("_s2", safe_div(F.col("_rss"), F.col("n") - k)))
    se = [F.sqrt(F.col("_s2") * F.col("ainv")[j][j]) for j in range(p, k)]
    cols = ["cohort", "variant", "phenotype",
            F.col("_beta")[k - 1].alias("beta"), se[-1].alias("standard_error"),
            F.col("_beta")[k - 2].alias("beta_interaction"), se[-2].alias("se_interaction")]
    if len(factors) > 1:
        cols += [F.array(*[F.col("_beta")[j] for j in range(p, k - 1)]).alias("betas_interaction"),
                 F.array(*se[:-1]).alias("ses_interaction")]
    return out.select(*cols, F.col("n").cast("double").alias("sample_size"))
