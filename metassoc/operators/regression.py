"""Per-cohort linear regression y ~ 1 + covariates + g from sufficient statistics.

One genotype term, so the (p+1)×(p+1) inverse is never formed: with M = A_cov⁻¹ (per cohort),
a = X̃ᵀg, u = M·a and the Schur complement s = gᵀg − a·u,

    β   = (gᵀy − u·b) / s
    RSS = |yᵀy − bᵀMb − β²·s|
    SE  = sqrt(RSS / (s · (n − p − 1)))

which equals the full-inverse OLS exactly.  A variant with s ≤ tol·gᵀg is singular in that
cohort and is dropped (it is kept in ``variant_terms(..., keep_singular=True)`` for diagnostics).
Everything is native column arithmetic; M itself is one tiny p×p Gauss–Jordan per cohort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import array_dot, dot_n, mat_vec, mat_vec_n, quad_form, quad_form_n, safe_div
from ..functions.linalg import spd_inverse
from .joins import DEFAULT_MAX_BROADCAST_ROWS, join_small

SINGULAR_TOL = 1e-12


def invert_cov(pd_cov: DataFrame) -> DataFrame:
    """Add ``m`` = A_cov⁻¹ (NULL when singular).  One row per cohort; native Gauss–Jordan."""
    return pd_cov.withColumn("m", spd_inverse("a_cov"))


def variant_terms(pd_test: DataFrame, cov_inv: DataFrame, tol: float = SINGULAR_TOL,
                  keep_singular: bool = False, p: int | None = None) -> DataFrame:
    """(cohort, variant, n, maf, u, s[, singular]) per cohort-variant.

    With ``p`` (number of constant terms, known from the PD step) the products are unrolled into
    plain indexed arithmetic that whole-stage codegen compiles; without it, array lambdas."""
    c = cov_inv.where(F.col("m").isNotNull()).select("cohort", "n", "m")
    u = mat_vec_n("m", "a", p) if p else mat_vec("m", "a")
    t = pd_test.join(F.broadcast(c), "cohort").withColumn("u", u)      # K rows: fixed-size dimension
    t = (t.withColumn("s", F.col("gg") - (dot_n("a", "u", p) if p else array_dot("a", "u")))
         .withColumn("singular", ~(F.col("s") > F.lit(tol) * F.col("gg")))
         .withColumn("df", F.col("n") - F.size("a") - 1))
    if not keep_singular:
        t = t.where(~F.col("singular") & (F.col("df") > 0)).drop("singular")
    return t.drop("gg", "m")


def phenotype_terms(pd_pheno: DataFrame, cov_inv: DataFrame, p: int | None = None) -> DataFrame:
    """(cohort, phenotype, b, rss0) with rss0 = yᵀy − bᵀMb (residual SS of the covariate-only model)."""
    c = cov_inv.where(F.col("m").isNotNull()).select("cohort", "m")
    return (pd_pheno.join(F.broadcast(c), "cohort")
            .withColumn("rss0", F.col("c") - (quad_form_n("m", "b", p) if p else quad_form("m", "b")))
            .drop("m", "c"))


def effects_from_terms(pairs: DataFrame, p: int | None = None) -> DataFrame:
    """Columns u, s, b, rss0, gy, n, df -> beta, standard_error, t_stat, sample_size."""
    ub = dot_n("u", "b", p) if p else array_dot("u", "b")
    beta = safe_div(F.col("gy") - ub, F.col("s"))
    return (pairs
            .withColumn("beta", beta)
            .withColumn("rss", F.abs(F.col("rss0") - F.col("beta") * F.col("beta") * F.col("s")))
            .withColumn("standard_error", F.sqrt(safe_div(F.col("rss"), F.col("s") * F.col("df"))))
            .withColumn("t_stat", safe_div(F.col("beta"), F.col("standard_error")))
            .withColumn("sample_size", F.col("n").cast("double")))


def with_products(grid: DataFrame, pd_b4: DataFrame, in_place: bool = False) -> DataFrame:
    """Pairs (cohort, variant, phenotype, …) with their gᵀy, 0 where pd_b4 has none.

    ``in_place``: both tables lie by variant (``by_variant`` of the moments), so their rows are put together and summed where
    they are; a join would send both again by all three keys."""
    keys = ["cohort", "variant", "phenotype"]
    b4 = pd_b4.select(*keys, "gy")
    if not in_place:
        return grid.join(b4, keys, "left").withColumn("gy", F.coalesce(F.col("gy"), F.lit(0.0)))
    rest = [c for c in grid.columns if c not in keys]
    both = grid.select(*keys, *rest, F.lit(0.0).alias("gy"), F.lit(1).alias("_pair")).unionByName(
        b4.withColumn("_pair", F.lit(0)), allowMissingColumns=True)
    summed = both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest], F.sum("gy").alias("gy"), F.max("_pair").alias("_pair"))
    return summed.where("_pair = 1").drop("_pair")


def cohort_effects(vt: DataFrame, pt: DataFrame, pd_b4: DataFrame | None,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, p: int | None = None, in_place: bool = False) -> DataFrame:
    """Every variant × every phenotype inside each cohort, with β, SE, t.

    The phenotype side (cohorts × phenotypes rows) is broadcast after a size check, else the
    cohort key is salted by variant.  Pairs without a gᵀy row have gᵀy = 0 (sparse input).
    """
    grid = join_small(vt, pt, "cohort", max_rows=max_broadcast_rows, salt_by="variant")
    if pd_b4 is not None:
        grid = with_products(grid, pd_b4, in_place)
        if "flip" in vt.columns:   # flipped allele: (2 − g)ᵀy = 2·Σy − gᵀy
            grid = grid.withColumn("gy", F.when(F.col("flip") == -1, 2.0 * F.col("b")[0] - F.col("gy"))
                                   .otherwise(F.col("gy")))
    return effects_from_terms(grid, p).select(
        "cohort", "variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size", "df", "maf",
        *[c for c in ("orientation",) if c in grid.columns])


def associate_pd(pd: dict[str, DataFrame], tol: float = SINGULAR_TOL,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Per-cohort effects straight from the PD tables (pd_cov, pd_test, pd_pheno, pd_b4)."""
    p = pd.get("p")
    inv = invert_cov(pd["pd_cov"])
    vt = variant_terms(pd["pd_test"], inv, tol, p=p)
    pt = phenotype_terms(pd["pd_pheno"], inv, p=p)
    return cohort_effects(vt, pt, pd.get("pd_b4"), max_broadcast_rows, p, pd.get("by_variant", False))


def flip_effects(effects: DataFrame, flips: DataFrame | None = None) -> DataFrame:
    """Orient per-cohort effects to the reference allele: where the cohort's alleles are swapped
    (flip = −1) β and t change sign and MAF becomes 1 − MAF; SE, df and n are unchanged.

    Exact because the model has an intercept (regressing on 2 − g gives −β with the same residuals),
    and numerically preferable to flipping the sums: Σ(2 − g)² = 4n − 4Σg + Σg² cancels badly when
    the flipped genotype is nearly constant (rare variants).  ``flips``: (cohort, variant, flip); without it the effects bring
    their flip as ``orientation`` (see ``moments``) and stay where they are."""
    if flips is None:
        j = effects.withColumnRenamed("orientation", "flip")
    else:
        j = effects.join(flips.select("cohort", "variant", "flip"), ["cohort", "variant"], "left")
    f = F.coalesce(F.col("flip"), F.lit(1))
    out = j.withColumn("beta", F.col("beta") * f)
    if "t_stat" in effects.columns:
        out = out.withColumn("t_stat", F.col("t_stat") * f)
    if "maf" in effects.columns:
        out = out.withColumn("maf", F.when(f == -1, 1.0 - F.col("maf")).otherwise(F.col("maf")))
    return out.drop("flip")
