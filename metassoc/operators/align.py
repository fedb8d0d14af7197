"""Alignment and filtering: include/exclude lists, MAF filters, availability across cohorts,
sample intersection and removal.  All are semi/anti/inner equi-joins or plain predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import REMOVED_PREFIX


def _filter_list(df: DataFrame, lst: DataFrame | None, key: str, how: str) -> DataFrame:
    """Semi/anti join on (cohort, key) when the list names cohorts, else on key for all cohorts."""
    if lst is None:
        return df
    on = ["cohort", key] if "cohort" in lst.columns else [key]
    return df.join(lst.select(*on).distinct(), on, how)


def filter_variants(df: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None,
                    key: str = "variant") -> DataFrame:
    """Per-cohort variant include (left-semi) and exclude (left-anti)."""
    return _filter_list(_filter_list(df, include, key, "left_semi"), exclude, key, "left_anti")


def filter_phenotypes(df: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    return filter_variants(df, include, exclude, key="phenotype")


def maf_predicate(maf_col: str, t: float, mode: str = "inclusive", drop_half: bool = True):
    """MAF window filter.  inclusive: t ≤ maf ≤ 1−t (per cohort); strict: t < maf < 1−t (pooled).
    ``drop_half`` also drops maf == 0.5 exactly (reference behaviour)."""
    m = F.col(maf_col)
    if mode == "strict":
        p = (m > t) & (m < 1 - t)
    else:
        p = (m >= t) & (m <= 1 - t)
    if drop_half:
        p = p & (m != 0.5)
    return p


def n_cohorts(samples: DataFrame) -> int:
    return samples.select("cohort").distinct().count()


def present_in_all(df: DataFrame, key: str, samples: DataFrame, k: int | None = None) -> DataFrame:
    """Keep rows whose ``key`` occurs in every cohort (ALL availability)."""
    k = k if k is not None else n_cohorts(samples)
    full = df.groupBy(key).agg(F.count_distinct("cohort").alias("_k")).where(F.col("_k") == k).select(key)
    return df.join(full, key, "left_semi")


def availability(df: DataFrame, key: str, k: int, mode: str = "any") -> DataFrame:
    """Keys present in all (mode='all') or at least one (mode='any') of k cohorts."""
    g = df.groupBy(key).agg(F.count_distinct("cohort").alias("n_cohorts"))
    return g.where(F.col("n_cohorts") == k) if mode == "all" else g.where(F.col("n_cohorts") > 0)


# ---------------------------------------------------------------- samples

def sample_intersection(*sources: DataFrame) -> DataFrame:
    """Samples present in every source, keyed by (cohort, sample_id).

    Each source is (cohort, sample_id[, pos]).  When a source carries ``pos`` (position of the
    sample in that source's matrix) the first occurrence is kept as ``pos_<i>``; equal ids in two
    cohorts stay distinct because the key includes the cohort.  Output order is by the caller's
    ``orderBy`` (a range-partitioned sort), never by a per-cohort window.
    """
    out = None
    for i, s in enumerate(sources):
        if "pos" in s.columns:
            s = s.groupBy("cohort", "sample_id").agg(F.min("pos").alias(f"pos_{i}"))
        else:
            s = s.select("cohort", "sample_id").distinct()
        out = s if out is None else out.join(s, ["cohort", "sample_id"])
    return out


def assert_pd_samples_covered(intersection: DataFrame, pd_samples: DataFrame) -> None:
    """Every sample the partial derivatives were computed on must be in the intersection of
    phenotype and genotype samples (otherwise the PD sums describe other subjects)."""
    missing = pd_samples.select("cohort", "sample_id").join(intersection, ["cohort", "sample_id"], "left_anti")
    if missing.limit(1).count():
        raise ValueError("partial derivatives include samples missing from phenotype/genotype data")


def remove_samples(df: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop samples listed in ``removed`` (cohort, sample_id) or (sample_id) for all cohorts."""
    on = ["cohort", "sample_id"] if "cohort" in removed.columns else ["sample_id"]
    return df.join(removed.select(*on).distinct(), on, "left_anti")


def mark_removed_ids(df: DataFrame, removed: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """Prefix listed ids with 'remove_' (string ids) so they no longer match any other table."""
    r = removed.select(F.col(id_col).cast("string").alias("_rid")).distinct().withColumn("_hit", F.lit(True))
    j = df.join(r, F.col(id_col).cast("string") == F.col("_rid"), "left")
    return (j.withColumn(id_col, F.when(F.col("_hit"), F.concat(F.lit(REMOVED_PREFIX), F.col(id_col).cast("string")))
                         .otherwise(F.col(id_col).cast("string")))
            .drop("_rid", "_hit"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when a filtered table is empty (e.g. no phenotype common to the cohorts)."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no {what} left after alignment")
    return df


# ---------------------------------------------------------------- covariates

def covariate_keep(cov_index: DataFrame) -> DataFrame:
    """(cohort, keep array<int>): intercept (0) plus the listed 1-based covariate indices, sorted.
    One row per cohort; the list is bounded by the number of covariates."""
    return (cov_index.groupBy("cohort").agg(F.collect_set(F.col("idx").cast("int")).alias("_k"))
            .select("cohort", F.array_sort(F.array_union(F.array(F.lit(0)), F.col("_k"))).alias("keep")))


def select_covariates(pd: dict, cov_index: DataFrame | None) -> dict:
    """Project the PD tables onto the intercept plus the chosen covariates of each cohort
    (rows and columns of A_cov, entries of a = X̃ᵀg and b = X̃ᵀy).  Cohorts not listed keep all."""
    if cov_index is None:
        return pd
    keep = F.broadcast(covariate_keep(cov_index))          # one row per cohort

    def vec(df, col):
        j = df.join(keep, "cohort", "left")
        return j.withColumn(col, F.when(F.col("keep").isNull(), F.col(col)).otherwise(
            F.transform("keep", lambda i: F.get(F.col(col), i)))).drop("keep")

    cov = pd["pd_cov"].join(keep, "cohort", "left")
    cov = cov.withColumn("a_cov", F.when(F.col("keep").isNull(), F.col("a_cov")).otherwise(
        F.transform("keep", lambda i: F.transform("keep", lambda j: F.get(F.get(F.col("a_cov"), i), j))))).drop("keep")
    out = dict(pd, pd_cov=cov, pd_test=vec(pd["pd_test"], "a"), pd_pheno=vec(pd["pd_pheno"], "b"))
    out["p"] = None            # the number of terms may now differ between cohorts
    return out


def common_covariates(names: DataFrame, k: int | None = None) -> DataFrame:
    """Covariate names (after the '<study>_' prefix) present in every cohort: (name)."""
    from ..functions.columns import strip_study_prefix
    n = names.select("cohort", strip_study_prefix(F.col("name"), F.col("cohort")).alias("name")).distinct()
    k = k if k is not None else n.select("cohort").distinct().count()
    return n.groupBy("name").agg(F.count_distinct("cohort").alias("_k")).where(F.col("_k") == k).select("name")


# ---------------------------------------------------------------- variants and samples

def apply_variant_map(genotype: DataFrame, vmap: DataFrame) -> DataFrame:
    """Relabel each cohort's genotype rows (cohort, variant_idx, ...) with the reference id;
    variants absent from the map are dropped.

    Dense rows (dosage arrays) are flipped in place (2 − g where the alleles were swapped).  Sparse
    long rows keep a ``flip`` column instead: their absent zeros would become 2, so the flip is
    applied to the sufficient statistics (``moments.flip_moments``) without densifying."""
    from ..functions.columns import flip_dosage
    j = genotype.join(vmap.select("cohort", "variant_idx", F.col("ref_id").alias("variant"), "flip"),
                      ["cohort", "variant_idx"])
    if dict(genotype.dtypes).get("dosage", "").startswith("array"):
        return j.withColumn("dosage", flip_dosage("dosage", "flip")).drop("flip")
    return j


def gather_samples(dense: DataFrame, order: DataFrame, col: str = "dosage", salts: int = 16) -> DataFrame:
    """Select/reorder the samples of dense rows: order is (cohort, idx, pos) — the output position
    ``idx`` takes the input position ``pos``.  A cohort's positions are one small array; rows meet it on (cohort, salt), so
    that the rows of one large cohort go to ``salts`` tasks, and positions that stay as they are cost nothing."""
    o = order.groupBy("cohort").agg(F.array_sort(F.collect_list(F.struct("idx", "pos"))).alias("_o"))
    o = o.select("cohort", F.transform("_o", lambda e: e["pos"].cast("int")).alias("_pos"))
    return _gather(dense, o, col, salts)


def _gather(dense: DataFrame, positions: DataFrame, col: str, salts: int) -> DataFrame:
    """Rows with ``col`` taken at the places of ``_pos`` of their cohort."""
    o = positions.withColumn("_same", F.col("_pos") == F.transform("_pos", lambda _, i: i))
    o = o.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    names = [c for c in dense.columns if c not in ("cohort", col)]
    d = dense.withColumn("_salt", F.pmod(F.hash(*names), F.lit(salts)) if names else F.lit(0))
    moved = F.transform("_pos", lambda p: F.get(F.col(col), p))
    return (d.join(o, ["cohort", "_salt"])
            .withColumn(col, F.when(F.col("_same") & (F.size("_pos") == F.size(col)), F.col(col)).otherwise(moved))
            .select(*dense.columns))


def aligned_positions(own: dict[str, DataFrame], lead: DataFrame, what: str = "partial derivatives") -> DataFrame:
    """(cohort, <source>_pos array<int> per source): where the samples of ``lead`` (cohort, sample_id, pos), in its order, lie in
    each source (cohort, sample_id, pos).

    A sample of ``lead`` that a source lacks, and a sample id that occurs twice in a cohort, raise when the table is
    computed: the check is part of the plan and costs no job of its own.  An id at several places of a source cannot
    occur then, so first match and only match are the same."""
    def once(df: DataFrame, name: str) -> DataFrame:
        g = df.groupBy("cohort", "sample_id").agg(F.min("pos").alias("_p"), F.count(F.lit(1)).alias("_n"))
        twice = F.raise_error(F.concat(F.lit(f"{name}: sample "), F.col("sample_id").cast("string"), F.lit(" occurs twice in cohort "), "cohort"))
        return g.select("cohort", "sample_id", F.when(F.col("_n") == 1, F.col("_p")).otherwise(twice.cast("long")).alias(f"{name}_at"))

    out = once(lead, "lead")
    for name, df in own.items():
        missing = F.raise_error(F.concat(F.lit(f"{what} include sample "), F.col("sample_id").cast("string"), F.lit(" of cohort "),
                                         "cohort", F.lit(f", which is missing from {name}")))
        out = out.join(once(df, name), ["cohort", "sample_id"], "left")
        out = out.withColumn(f"{name}_at", F.coalesce(f"{name}_at", missing.cast("long")))
    cells = F.struct("lead_at", *[f"{name}_at" for name in own])
    g = out.groupBy("cohort").agg(F.array_sort(F.collect_list(cells)).alias("_c"))          # one array per cohort

    def places(name: str):
        return F.transform("_c", lambda c: c[f"{name}_at"].cast("int")).alias(f"{name}_pos")

    return g.select("cohort", *map(places, own))


def take_positions(dense: DataFrame, positions: DataFrame, source: str, col: str, salts: int = 16) -> DataFrame:
    """Dense rows with their samples in the lead's order (see ``aligned_positions``)."""
    return _gather(dense, positions.select("cohort", F.col(f"{source}_pos").alias("_pos")), col, salts)
