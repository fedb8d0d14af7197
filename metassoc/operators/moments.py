"""Sufficient statistics ("partial derivatives") from long-form data.

Long-form inputs (zero dosages / zero phenotype values may be left out: they add nothing to any sum):

* ``samples``   (cohort, sample_id, x array<double>)          covariates without the intercept
* ``genotype``  (cohort, sample_id, variant, dosage double)    missing calls already imputed
* ``phenotype`` (cohort, sample_id, phenotype, y double)

Outputs (the partial-derivative tables, all additive over samples and over cohorts):

* ``pd_cov``   (cohort, n, a_cov array<array<double>>)                A_cov = X̃ᵀX̃, X̃ = [1, x]
* ``pd_test``  (cohort, variant, a array<double>, gg, maf)            a = X̃ᵀg, gg = gᵀg, maf = Σg/2n
* ``pd_pheno`` (cohort, phenotype, b array<double>, c)                b = X̃ᵀy, c = yᵀy
* ``pd_b4``    (cohort, variant, phenotype, gy)                        gy = gᵀy

Every table is one aggregate with map-side partial aggregation; nothing is collected per group.  With ``by_variant`` the
rows of pd_test and pd_b4 meet by variant alone: for tables with many variants, where sums before the shuffle save nothing,
all that follows (pairs, pooling over cohorts) then finds its rows in place.  Genotype rows may carry ``orientation`` (the flip ±1 of
their cohort and variant, see ``align.apply_variant_map``): pd_test keeps it, so that no effect is sent to meet the map again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_missing, safe_div


def _terms(x_col: str, n_cov: int):
    """[1, x[0], ..., x[n_cov-1]] as a list of column expressions."""
    return [F.lit(1.0)] + [F.col(x_col)[i] for i in range(n_cov)]


def covariate_moments(samples: DataFrame, n_cov: int) -> DataFrame:
    """pd_cov: per cohort n and the (p×p) matrix X̃ᵀX̃, p = n_cov + 1."""
    t = _terms("x", n_cov)
    p = len(t)
    sums = {(i, j): F.sum(t[i] * t[j]) for i in range(p) for j in range(i, p)}
    rows = [F.array(*[sums[(min(i, j), max(i, j))] for j in range(p)]) for i in range(p)]
    return samples.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*rows).alias("a_cov"),
    )


def _with_x(df: DataFrame, samples: DataFrame) -> DataFrame:
    if "x" in df.columns:
        return df
    return df.join(samples.select("cohort", "sample_id", "x"), ["cohort", "sample_id"])


def _only_value(name: str) -> F.Column:
    """The value that all rows of a cohort and variant have; two are an error."""
    two = F.raise_error(F.concat(F.lit(f"two values of {name} in cohort "), F.first("cohort"), F.lit(", variant "), F.first("variant")))
    return F.when(F.min(name) == F.max(name), F.max(name)).otherwise(two.cast("int")).alias(name)


def variant_moments(genotype: DataFrame, samples: DataFrame, n_cov: int, pd_cov: DataFrame | None = None,
                    by_variant: bool = False) -> DataFrame:
    """pd_test: per (cohort, variant) a = X̃ᵀg, gg = Σg², maf = Σg/(2n)."""
    g = _with_x(genotype, samples)
    t = _terms("x", n_cov)
    turned = ["orientation"] if "orientation" in g.columns else []
    if by_variant:
        g = g.select("cohort", "variant", "dosage", "x", *turned).repartition("variant")
    out = g.groupBy("cohort", "variant").agg(
        F.array(*[F.sum(F.col("dosage") * ti) for ti in t]).alias("a"),
        F.sum(F.col("dosage") * F.col("dosage")).alias("gg"),
        *[_only_value(c) for c in turned],
    )
    if pd_cov is None:
        pd_cov = covariate_moments(samples, n_cov)
    # pd_cov has one row per cohort: a fixed-size dimension, safe to broadcast.
    return (out.join(F.broadcast(pd_cov.select("cohort", "n")), "cohort")
            .withColumn("maf", F.col("a")[0] / (2.0 * F.col("n")))
            .drop("n"))


def phenotype_moments(phenotype: DataFrame, samples: DataFrame, n_cov: int) -> DataFrame:
    """pd_pheno: per (cohort, phenotype) b = X̃ᵀy, c = Σy²."""
    p = _with_x(phenotype, samples)
    t = _terms("x", n_cov)
    return p.groupBy("cohort", "phenotype").agg(
        F.array(*[F.sum(F.col("y") * ti) for ti in t]).alias("b"),
        F.sum(F.col("y") * F.col("y")).alias("c"),
    )


def cross_moments(genotype: DataFrame, phenotype: DataFrame, by_variant: bool = False) -> DataFrame:
    """pd_b4: per (cohort, variant, phenotype) gy = Σ g·y over samples (sparse rows only)."""
    g = genotype.select("cohort", "sample_id", "variant", "dosage")
    y = phenotype.select("cohort", "sample_id", "phenotype", "y")
    products = g.join(y, ["cohort", "sample_id"]).select("cohort", "variant", "phenotype", (F.col("dosage") * F.col("y")).alias("gy"))
    if by_variant:
        products = products.repartition("variant")
    return products.groupBy("cohort", "variant", "phenotype").agg(F.sum("gy").alias("gy"))


def partial_derivatives(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int,
                        with_b4: bool = True, by_variant: bool = False) -> dict:
    """All PD tables of one or many cohorts (cohort is a grouping key everywhere), plus ``p``."""
    pd_cov = covariate_moments(samples, n_cov)
    out = {
        "pd_cov": pd_cov,
        "pd_test": variant_moments(genotype, samples, n_cov, pd_cov, by_variant),
        "pd_pheno": phenotype_moments(phenotype, samples, n_cov),
        "p": n_cov + 1,            # number of constant terms (intercept + covariates)
    }
    if by_variant:
        out["by_variant"] = True
    if with_b4:
        out["pd_b4"] = cross_moments(genotype, phenotype, by_variant)
    return out


def impute_mean(genotype: DataFrame, samples: DataFrame) -> DataFrame:
    """Replace missing calls (9 / NaN / <0) by the mean of the observed dosages of that cohort-variant.

    Long form: zero dosages are absent rows, so mean = Σ observed / (n − #missing), with n from the
    cohort's sample count.  One aggregate per (cohort, variant), joined back on its key."""
    miss = is_missing(F.col("dosage"))
    st = genotype.groupBy("cohort", "variant").agg(
        F.coalesce(F.sum(F.when(~miss, F.col("dosage"))), F.lit(0.0)).alias("_s_obs"),
        F.count(F.when(miss, 1)).alias("_n_miss"))
    n = samples.groupBy("cohort").agg(F.count(F.lit(1)).alias("_n"))
    st = st.join(F.broadcast(n), "cohort")            # one row per cohort
    mean = safe_div(F.col("_s_obs"), F.col("_n") - F.col("_n_miss"))
    return (genotype.join(st, ["cohort", "variant"])
            .withColumn("dosage", F.when(miss, mean).otherwise(F.col("dosage")))
            .drop("_s_obs", "_n_miss", "_n"))


def observed_maf(genotype: DataFrame, samples: DataFrame) -> DataFrame:
    """(cohort, variant, maf, n_obs): allele frequency mean(g)/2 over the observed calls (not folded)."""
    miss = is_missing(F.col("dosage"))
    st = genotype.groupBy("cohort", "variant").agg(
        F.coalesce(F.sum(F.when(~miss, F.col("dosage"))), F.lit(0.0)).alias("_s"),
        F.count(F.when(miss, 1)).alias("_m"))
    n = samples.groupBy("cohort").agg(F.count(F.lit(1)).alias("_n"))
    return (st.join(F.broadcast(n), "cohort")
            .select("cohort", "variant", safe_div(F.col("_s"), 2.0 * (F.col("_n") - F.col("_m"))).alias("maf"),
                    (F.col("_n") - F.col("_m")).alias("n_obs")))


def pooled_maf(pd_test: DataFrame, pd_cov: DataFrame) -> DataFrame:
    """(variant, maf): Σ n_c·maf_c / Σ n_c over the cohorts that have the variant."""
    t = pd_test.join(F.broadcast(pd_cov.select("cohort", "n")), "cohort")
    return t.groupBy("variant").agg((F.sum(F.col("n") * F.col("maf")) / F.sum("n")).alias("maf"))


def maf_consistency(pd_test: DataFrame, max_sd: float = 0.1) -> DataFrame:
    """(variant, maf_sd, k, inconsistent): population SD of MAF across cohorts, flagged above ``max_sd``."""
    return (pd_test.groupBy("variant")
            .agg(F.stddev_pop("maf").alias("maf_sd"), F.count(F.lit(1)).alias("k"))
            .withColumn("inconsistent", (F.col("maf_sd") > max_sd).cast("int")))


def flip_moments(pd_test: DataFrame, pd_cov: DataFrame, flips: DataFrame) -> DataFrame:
    """Apply allele flips (g -> 2 − g for every sample) to A_test without densifying zeros.

    X̃ᵀ(2·1 − g) = 2·X̃ᵀ1 − X̃ᵀg where X̃ᵀ1 is the first row of A_cov, Σ(2 − g)² = 4n − 4Σg + Σg².
    ``flips`` is (cohort, variant, flip ±1); the output keeps a ``flip`` column so that gᵀy can be
    flipped the same way (2·Σy − gᵀy) once phenotypes are paired."""
    c = pd_cov.select("cohort", "n", F.col("a_cov")[0].alias("_x1"))
    t = (pd_test.join(flips.select("cohort", "variant", "flip"), ["cohort", "variant"], "left")
         .withColumn("flip", F.coalesce(F.col("flip"), F.lit(1)))
         .join(F.broadcast(c), "cohort"))
    f = F.col("flip") == -1
    a2 = F.zip_with("_x1", "a", lambda x1, a: 2.0 * x1 - a)
    gg2 = 4.0 * F.col("n") - 4.0 * F.col("a")[0] + F.col("gg")
    return (t.withColumn("gg", F.when(f, gg2).otherwise(F.col("gg")))
            .withColumn("a", F.when(f, a2).otherwise(F.col("a")))
            .withColumn("maf", F.col("a")[0] / (2.0 * F.col("n")))
            .drop("_x1", "n"))
