"""Pooling across cohorts: inverse-variance weighting with I² heterogeneity, and mega-analysis.

The IVW step is one ``groupBy(variant, phenotype)`` with map-side partial aggregation.  Each group
holds at most one row per cohort (K rows), so the per-group (β, w) list used for the two-pass
Cochran's Q is bounded by the number of cohorts, never by the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .joins import DEFAULT_MAX_BROADCAST_ROWS
from .regression import SINGULAR_TOL, associate_pd


def contributing(effects: DataFrame) -> DataFrame:
    """Cohort rows that enter the pooled estimate: finite β and SE > 0."""
    b, se = F.col("beta"), F.col("standard_error")
    return effects.where(b.isNotNull() & ~F.isnan(b) & se.isNotNull() & ~F.isnan(se) & (se > 0)
                         & ~b.isin(float("inf"), float("-inf")))


def inverse_variance(effects: DataFrame, keys=("variant", "phenotype"), with_q: bool = False) -> DataFrame:
    """β = Σwβ/Σw, SE = √(1/Σw), w = 1/SE², N = Σn, I² = (Q − (k−1))/Q·100 (NULL for k < 2 or Q = 0).

    Q = Σ w(β_c − β)² is computed in a second pass over the cohort rows of the group.
    Negative I² is kept (no flooring).
    """
    e = contributing(effects).withColumn("w", 1.0 / (F.col("standard_error") * F.col("standard_error")))
    g = e.groupBy(*keys).agg(
        F.sum(F.col("w") * F.col("beta")).alias("swb"),
        F.sum("w").alias("sw"),
        F.sum("sample_size").alias("sample_size"),
        F.count(F.lit(1)).alias("k"),
        F.collect_list(F.struct("beta", "w")).alias("cs"),
    )
    beta = F.col("swb") / F.col("sw")
    g = g.withColumn("beta", beta).withColumn("standard_error", F.sqrt(1.0 / F.col("sw")))
    q = F.aggregate("cs", F.lit(0.0),
                    lambda acc, c: acc + c["w"] * (c["beta"] - F.col("beta")) * (c["beta"] - F.col("beta")))
    g = g.withColumn("q", q)
    i2 = F.when((F.col("k") < 2) | (F.col("q") == 0), F.lit(None).cast("double")).otherwise(
        safe_div(F.col("q") - (F.col("k") - 1), F.col("q")) * 100.0)
    g = g.withColumn("i_squared", i2)
    cols = list(keys) + ["beta", "standard_error", "i_squared", "sample_size"]
    if with_q:
        cols += ["q", "k"]
    return g.select(*cols)


def t_threshold(meta: DataFrame, threshold: float | None) -> DataFrame:
    """Keep |β/SE| > threshold (strict); no-op when threshold is None or 0."""
    if not threshold:
        return meta
    return meta.where(F.abs(safe_div(F.col("beta"), F.col("standard_error"))) > F.lit(float(threshold)))


def drop_empty(meta: DataFrame) -> DataFrame:
    return meta.where(F.col("sample_size") != 0)


def meta_analyse_pd(pd: dict[str, DataFrame], t_thr: float | None = None, tol: float = SINGULAR_TOL,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Per-cohort regressions from PD tables, then IVW pooling."""
    eff = associate_pd(pd, tol, max_broadcast_rows)
    return t_threshold(drop_empty(inverse_variance(eff)), t_thr)


# ---------------------------------------------------------------- mega-analysis (sum of PDs)

def _sum_matrices(col: str) -> F.Column:
    """Element-wise sum of the collected (≤ K) matrices of a group."""
    first = F.col(col)[0]
    zero = F.transform(first, lambda r: F.transform(r, lambda _: F.lit(0.0)))
    return F.aggregate(F.col(col), zero,
                       lambda acc, m: F.zip_with(acc, m, lambda r1, r2: F.zip_with(r1, r2, lambda a, b: a + b)))


def _sum_vectors(col: str) -> F.Column:
    first = F.col(col)[0]
    zero = F.transform(first, lambda _: F.lit(0.0))
    return F.aggregate(F.col(col), zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))


def _label(label: str, like: str = "cohort"):
    """A constant label that the optimizer cannot fold (derived from a data column), so joins on
    the pooled ``cohort`` key stay hash joins instead of becoming nested-loop joins."""
    return F.concat(F.lit(label), F.substring(F.col(like), 1, 0))


def pool_pd(pd: dict[str, DataFrame], label: str = "ALL", require_all: bool = True) -> dict[str, DataFrame]:
    """Sum PD tables over cohorts (mega-analysis).  With ``require_all`` only variants and
    phenotypes present in every cohort are pooled, so A_cov, n and the sums cover the same samples."""
    k = pd["pd_cov"].select("cohort").distinct().count()
    cov = (pd["pd_cov"].groupBy().agg(F.sum("n").alias("n"), F.collect_list("a_cov").alias("ms"),
                                      F.max(_label(label)).alias("cohort"))
           .select("cohort", "n", _sum_matrices("ms").alias("a_cov")))
    n_of = F.broadcast(pd["pd_cov"].select("cohort", "n"))          # one row per cohort

    def pool(df, keys, vec, scal):
        aggs = ([F.collect_list(vec).alias("_vs"), F.count(F.lit(1)).alias("_k"), F.max(_label(label)).alias("cohort")]
                + [F.sum(s).alias(s) for s in scal])
        g = df.groupBy(*keys).agg(*aggs)
        if require_all:
            g = g.where(F.col("_k") == k)
        return g.withColumn(vec, _sum_vectors("_vs")).drop("_vs", "_k")

    test = pool(pd["pd_test"].join(n_of, "cohort"), ["variant"], "a", ["gg", "n"])
    test = test.withColumn("maf", F.col("a")[0] / (2.0 * F.col("n"))).drop("n")
    pheno = pool(pd["pd_pheno"], ["phenotype"], "b", ["c"])
    out = {"pd_cov": cov, "pd_test": test, "pd_pheno": pheno, "p": pd.get("p")}
    if "pd_b4" in pd:
        out["pd_b4"] = pd["pd_b4"].groupBy("variant", "phenotype").agg(
            F.sum("gy").alias("gy"), F.max(_label(label)).alias("cohort"))
    return out


def mega_analyse_pd(pd: dict[str, DataFrame], tol: float = SINGULAR_TOL,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Pooled regression of all cohorts from summed PDs."""
    eff = associate_pd(pool_pd(pd), tol, max_broadcast_rows)
    return eff.select("variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size", "maf")


def pairwise_effects(pd: dict, tol: float = SINGULAR_TOL, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Mega-analysis with missingness: every statistic is summed over exactly the cohorts that have both the
    variant and the phenotype (A_cov included), so each pair is its own pooled design.

    The grid of pairs comes from the per-cohort grid (variant terms ⋈ phenotype terms on cohort) and one groupBy per
    pair; a pair's row then holds its whole design and is inverted and solved in place, with no further join."""
    from ..functions.columns import array_dot, dot_n, mat_vec, mat_vec_n, quad_form, quad_form_n
    from ..functions.linalg import UNROLLED, spd_inverse, with_inverse_n
    from .joins import join_small
    from .regression import with_products
    cov = pd["pd_cov"].select("cohort", "n", "a_cov")
    test = pd["pd_test"].select("cohort", "variant", "a", "gg")
    pheno = pd["pd_pheno"].select("cohort", "phenotype", "b", "c")
    grid = join_small(test, pheno, "cohort", max_rows=max_broadcast_rows, salt_by="variant")
    if "pd_b4" in pd:
        grid = with_products(grid, pd["pd_b4"], pd.get("by_variant", False))
    grid = grid.join(F.broadcast(cov), "cohort")         # one row per cohort
    p = pd.get("p")
    if p and p <= UNROLLED:         # sums entry by entry, which Spark compiles, instead of lists of matrices
        sums = {(i, j): F.sum(F.col("a_cov")[i][j]) for i in range(p) for j in range(p)}
        g = grid.groupBy("variant", "phenotype").agg(
            F.sum("n").alias("n"), F.sum("gg").alias("gg"), F.sum("c").alias("c"), F.sum("gy").alias("gy"),
            F.array(*[F.array(*[sums[i, j] for j in range(p)]) for i in range(p)]).alias("a_cov"),
            F.array(*[F.sum(F.col("a")[i]) for i in range(p)]).alias("a"), F.array(*[F.sum(F.col("b")[i]) for i in range(p)]).alias("b"))
        g = with_inverse_n(g, "a_cov", "m", p)
        g = (g.withColumn("maf", F.col("a")[0] / (2.0 * F.col("n"))).withColumn("u", mat_vec_n("m", "a", p))
             .withColumn("s", F.col("gg") - dot_n("a", "u", p)).withColumn("rss0", F.col("c") - quad_form_n("m", "b", p)))
        return _solved_pairs(g, p, p, tol)
    g = grid.groupBy("variant", "phenotype").agg(           # ≤ K rows per pair: bounded lists
        F.sum("n").alias("n"), F.collect_list("a_cov").alias("_m"), F.collect_list("a").alias("_a"),
        F.collect_list("b").alias("_b"), F.sum("gg").alias("gg"), F.sum("c").alias("c"), F.sum("gy").alias("gy"))
    g = g.select("variant", "phenotype", "n", "gg", "c", "gy", _sum_matrices("_m").alias("a_cov"),
                 _sum_vectors("_a").alias("a"), _sum_vectors("_b").alias("b"))
    g = g.withColumn("m", spd_inverse("a_cov")).where(F.col("m").isNotNull())
    g = (g.withColumn("maf", F.col("a")[0] / (2.0 * F.col("n"))).withColumn("u", mat_vec("m", "a"))
         .withColumn("s", F.col("gg") - array_dot("a", "u")).withColumn("rss0", F.col("c") - quad_form("m", "b")))
    return _solved_pairs(g, F.size("a"), None, tol)


def _solved_pairs(g: DataFrame, terms, p: int | None, tol: float) -> DataFrame:
    """Effects of pairs that hold their whole design, of ``terms`` constant terms."""
    from .regression import effects_from_terms
    g = g.withColumn("df", F.col("n") - terms - 1)
    g = g.where((F.col("s") > F.lit(tol) * F.col("gg")) & (F.col("df") > 0))
    return effects_from_terms(g, p).select("variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size", "df", "maf")
