"""Composite jobs: the user-facing entry points (meta-analysis, mega-analysis, single-site
association, partial derivatives).  Inputs are DataFrames; outputs are lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import align
from ..operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_small
from ..operators.meta import drop_empty, inverse_variance, pool_pd, t_threshold
from ..operators.moments import partial_derivatives as _pd
from ..operators.regression import SINGULAR_TOL, associate_pd


def partial_derivatives(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int,
                        with_b4: bool = True) -> dict[str, DataFrame]:
    return _pd(samples, genotype, phenotype, n_cov, with_b4)


def cohort_effects(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int, *,
                   variant_include: DataFrame | None = None, variant_exclude: DataFrame | None = None,
                   phenotype_include: DataFrame | None = None, phenotype_exclude: DataFrame | None = None,
                   maf: float = 0.0, maf_mode: str = "inclusive", drop_half: bool = True,
                   availability: str = "any", tol: float = SINGULAR_TOL, cov_index: DataFrame | None = None,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, by_variant: bool = False) -> DataFrame:
    """Per-cohort β/SE for every variant × phenotype after include/exclude, MAF and availability
    filters; ``cov_index`` (cohort, idx) keeps the intercept plus the listed covariates per cohort;
    ``by_variant`` is for tables with many variants (see ``moments``)."""
    genotype = align.filter_variants(genotype, variant_include, variant_exclude)
    phenotype = align.filter_phenotypes(phenotype, phenotype_include, phenotype_exclude)
    pd = align.select_covariates(_pd(samples, genotype, phenotype, n_cov, by_variant=by_variant), cov_index)
    test = pd["pd_test"]
    if maf:
        test = test.where(align.maf_predicate("maf", maf, maf_mode, drop_half))
    if availability == "all":
        test = align.present_in_all(test, "variant", samples)
        pd["pd_pheno"] = align.require_rows(align.present_in_all(pd["pd_pheno"], "phenotype", samples),
                                            "phenotype common to all cohorts")
    pd["pd_test"] = test
    return associate_pd(pd, tol, max_broadcast_rows)


def meta_analyse(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int, *,
                 t_thr: float | None = None, **kw) -> DataFrame:
    """Federated meta-analysis: per-cohort regressions pooled by inverse-variance weighting."""
    eff = cohort_effects(samples, genotype, phenotype, n_cov, **kw)
    return t_threshold(drop_empty(inverse_variance(eff)), t_thr)


def _dense_inputs(genotype, phenotype, *, impute=True, variant_include=None, variant_exclude=None, phenotype_include=None,
                  phenotype_exclude=None, maf=0.0, maf_mode="inclusive", drop_half=True, availability="any"):
    """Dense rows after lists, MAF window, imputation and availability."""
    from ..functions.columns import impute_mean_array, maf_from_array
    genotype = align.filter_variants(genotype, variant_include, variant_exclude)
    phenotype = align.filter_phenotypes(phenotype, phenotype_include, phenotype_exclude)
    if maf:
        genotype = (genotype.withColumn("maf", maf_from_array("dosage"))
                    .where(align.maf_predicate("maf", maf, maf_mode, drop_half)).drop("maf"))
    if impute:
        genotype = genotype.withColumn("dosage", impute_mean_array("dosage"))
    if availability == "all":
        cohorts = phenotype.select("cohort").distinct()
        genotype = align.present_in_all(genotype, "variant", cohorts)
        phenotype = align.require_rows(align.present_in_all(phenotype, "phenotype", cohorts), "phenotype common to all cohorts")
    return genotype, phenotype


_DENSE_FILTERS = ("impute", "variant_include", "variant_exclude", "phenotype_include", "phenotype_exclude", "maf", "maf_mode",
                  "drop_half", "availability")


def _split(kw: dict) -> tuple[dict, dict]:
    return {k: v for k, v in kw.items() if k in _DENSE_FILTERS}, {k: v for k, v in kw.items() if k not in _DENSE_FILTERS}


def meta_analyse_dense(genotype: DataFrame, phenotype: DataFrame, covariates: DataFrame | None = None, *,
                       t_thr: float | None = None, cov_index: DataFrame | None = None, **kw) -> DataFrame:
    """P1 for dense cohorts (dosage arrays in sample order, e.g. from ``plans.ingest``): the tile engine with the IVW pooling
    and the t-threshold inside each tile.

    Include/exclude lists, the MAF window, availability and ``cov_index`` work as in ``cohort_effects``.  Missing calls (code 9)
    become the variant's mean within its cohort unless ``impute`` is off (encoded rows, which are no dosages:
    there ``maf`` must be 0).  A variant or phenotype that occurs twice in a cohort is an error, found by the task that meets it."""
    from ..operators.blocks import dense_associate
    filters, rest = _split(kw)
    genotype, phenotype = _dense_inputs(genotype, phenotype, **filters)
    return drop_empty(dense_associate(genotype, phenotype, covariates, pooled=True, t_thr=t_thr, cov_index=cov_index, **rest))


def cohort_effects_dense(genotype: DataFrame, phenotype: DataFrame, covariates: DataFrame | None = None, *,
                         factors: tuple[str, ...] = (), t_thr: float | None = None, **kw) -> DataFrame:
    """Per-cohort effects of dense rows (the same filters); ``factors`` adds genotype × covariate terms."""
    from ..operators.blocks import dense_associate
    filters, rest = _split(kw)
    genotype, phenotype = _dense_inputs(genotype, phenotype, **filters)
    return dense_associate(genotype, phenotype, covariates, pooled=False, factors=factors, t_thr=t_thr, **rest)


def meta_analyse_shared(pd: dict, genotype: DataFrame | None = None, phenotype: DataFrame | None = None, *,
                        variant_include: DataFrame | None = None, variant_exclude: DataFrame | None = None,
                        phenotype_include: DataFrame | None = None, phenotype_exclude: DataFrame | None = None,
                        maf: float = 0.0, maf_mode: str = "inclusive", drop_half: bool = True, availability: str = "any",
                        cov_index: DataFrame | None = None, output: str = "pooled", t_thr: float | None = None, **kw) -> DataFrame:
    """Meta-analysis (or, with ``output`` cohort or mega, per-cohort effects or one pooled regression) from shared partial
    derivatives and encoded rows, or pd_b4: every filter acts on the shared tables, the products are made in the tiles."""
    from ..operators.blocks import associate_shared
    test = align.filter_variants(pd["pd_test"], variant_include, variant_exclude)
    pheno = align.filter_phenotypes(pd["pd_pheno"], phenotype_include, phenotype_exclude)
    if maf and output != "mega":
        test = test.where(align.maf_predicate("maf", maf, maf_mode, drop_half))
    if availability == "all":
        test = align.present_in_all(test, "variant", pd["pd_cov"])
        pheno = align.require_rows(align.present_in_all(pheno, "phenotype", pd["pd_cov"]), "phenotype common to all cohorts")
    chosen = align.select_covariates(dict(pd, pd_test=test, pd_pheno=pheno), cov_index)
    tables = {k: v for k, v in chosen.items() if isinstance(v, DataFrame)}
    out = associate_shared(tables, genotype, phenotype, output=output, t_thr=t_thr, maf=maf if output == "mega" else 0.0, **kw)
    return drop_empty(out)


def meta_analyse_with_log(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int, *,
                          log_variants: DataFrame | None = None, log_phenotypes: DataFrame | None = None,
                          t_thr: float | None = None, max_effects: int = 10**9, **kw) -> tuple[DataFrame, DataFrame]:
    """Meta-analysis plus the per-cohort log of chosen genes/variants from one set of per-cohort
    effects (persisted once, read by both outputs).  The log is refused above ``max_effects`` rows
    in one cohort, checked with an aggregate before anything is written."""
    from pyspark import StorageLevel
    from ..operators.meta import contributing
    eff = cohort_effects(samples, genotype, phenotype, n_cov, **kw).persist(StorageLevel.MEMORY_AND_DISK)
    meta = t_threshold(drop_empty(inverse_variance(eff)), t_thr)
    log = per_cohort_effects(contributing(eff), log_variants, log_phenotypes, max_effects)
    return meta, log


def mega_analyse(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int, *,
                 tol: float = SINGULAR_TOL, maf: float = 0.0, cov_index: DataFrame | None = None) -> DataFrame:
    """Pooled regression over all cohorts from summed partial derivatives.

    ``maf`` filters on the pooled MAF with strict bounds (maf < t or > 1 − t or = 0.5 dropped)."""
    pd = align.select_covariates(_pd(samples, genotype, phenotype, n_cov), cov_index)
    pooled = pool_pd(pd)
    if maf:
        pooled["pd_test"] = pooled["pd_test"].where(align.maf_predicate("maf", maf, "strict"))
    eff = associate_pd(pooled, tol)
    return eff.select("variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size", "maf")


def per_cohort_effects(effects: DataFrame, variants: DataFrame | None = None,
                       phenotypes: DataFrame | None = None, max_effects: int = 10**9,
                       pairs: DataFrame | None = None) -> DataFrame:
    """Per-cohort log for chosen phenotypes and/or variants (both lists -> their product).

    None of the lists -> nothing is reported.  Refuses more than ``max_effects`` rows per cohort.  Where ``pairs`` (cohort, pairs: chosen
    variants × phenotypes, see ``pairs_per_cohort``) stays within that, no effect is computed to be counted.  The lists, not the
    effects, are sent: broadcast after their rows are measured."""
    if variants is None and phenotypes is None:
        return effects.limit(0)
    out = effects
    if variants is not None:
        out = join_small(out, variants.select("variant").distinct(), "variant", "left_semi")
    if phenotypes is not None:
        out = join_small(out, phenotypes.select("phenotype").distinct(), "phenotype", "left_semi")
    out = out.select("cohort", "variant", "phenotype", "beta", "standard_error", "sample_size")
    most = None if pairs is None else pairs.agg(F.max("pairs")).first()[0] or 0
    if most is None or most > max_effects:
        guard_effect_count(out, max_effects)
    return out


def pairs_per_cohort(genotype: DataFrame, phenotype: DataFrame, variants: DataFrame | None = None,
                     phenotypes: DataFrame | None = None) -> DataFrame:
    """(cohort, pairs): variants × phenotypes of the lists (None: all) that each cohort has, from the rows alone; never fewer than the
    cohort's effects."""
    def rows(df, key, wanted):
        if wanted is not None:
            df = df.join(wanted.select(key).distinct(), key, "left_semi")
        return df.groupBy("cohort").agg(F.count(F.lit(1)).alias(f"_{key}"))                   # one row per cohort
    both = rows(genotype, "variant", variants).join(rows(phenotype, "phenotype", phenotypes), "cohort")
    return both.select("cohort", (F.col("_variant") * F.col("_phenotype")).alias("pairs"))


def guard_effect_count(per_cohort: DataFrame, max_effects: int = 10**9) -> None:
    """Raise when one cohort would log more than ``max_effects`` effects (aggregate, no collect of rows)."""
    worst = per_cohort.groupBy("cohort").count().agg(F.max("count")).first()[0]
    if worst is not None and worst > max_effects:
        raise ValueError(f"refusing to write {worst} effects for one cohort (limit {max_effects})")


# ---------------------------------------------------------------- other user-facing jobs

def associate(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, n_cov: int, *,
              permute_seed: int | None = None, t_thr: float | None = None, **kw) -> DataFrame:
    """Single-site association (one or more cohorts analysed separately): β, SE, t, MAF, df.

    ``permute_seed`` shuffles phenotype samples within each cohort first (null run); ``t_thr``
    keeps |t| > thr (|t| > 0 when None, which drops 0 and NaN)."""
    from ..operators.permute import permute_phenotype
    from ..operators.report import t_filter
    if permute_seed is not None:
        phenotype = permute_phenotype(phenotype, samples, permute_seed)
    return t_filter(cohort_effects(samples, genotype, phenotype, n_cov, **kw), t_thr)


def encode_site(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, seed: int, block: int = 64,
                flips: DataFrame | None = None, key: DataFrame | None = None) -> dict[str, DataFrame]:
    """Site-side encoding: G·F and F⁻¹·P with a block-diagonal key, or with the (full) ``key`` (cohort, i, j, f).

    Dense rows (``dosage`` arrays, with ``phenotype`` as (cohort, phenotype, values) arrays) are
    flipped in place (2 − g) before encoding.  Sparse long rows cannot be flipped in place — their
    absent zeros would have to become 2 — so they are encoded as they are and the flips are returned
    (``out["flips"]``) for the centre to orient the per-cohort effects (``regression.flip_effects``),
    which is exact for a model with an intercept."""
    from ..functions.columns import flip_dosage
    from ..operators.encode import encode, encode_dense
    if dict(genotype.dtypes).get("dosage", "").startswith("array"):
        if flips is not None:
            genotype = (genotype.join(flips.select("cohort", "variant", "flip"), ["cohort", "variant"], "left")
                        .withColumn("dosage", flip_dosage("dosage", F.coalesce(F.col("flip"), F.lit(1)))).drop("flip"))
        return encode_dense(genotype, phenotype, seed, block, key)
    out = encode(samples, genotype, phenotype, seed, block, key)
    if flips is not None:
        out["flips"] = flips.select("cohort", "variant", "flip")
    return out


def harmonise_study(probes: DataFrame, reference: DataFrame, by: str = "position") -> dict[str, DataFrame]:
    """Variant map plus the unmatched/flipped reports and counts."""
    from ..operators import harmonise as h
    vmap = h.harmonise(probes, reference, by)
    return {"map": vmap, "unmatched": h.unmatched(probes, vmap), "flipped": h.flipped(probes, vmap),
            "counts": h.map_counts(probes, reference, vmap)}


def summarise(assoc: DataFrame, df_col: str | None = "df") -> DataFrame:
    from ..operators.report import summarise as _s
    return _s(assoc, df_col)


def annotate(summary: DataFrame, probes: DataFrame) -> DataFrame:
    from ..operators.report import annotate as _a
    return _a(summary, probes)


def output_per_phenotype(spark, result_paths: list[str], out: str) -> None:
    """Union of result shards rewritten partitioned by phenotype."""
    from ..sources.sinks import write_by_phenotype
    write_by_phenotype(spark.read.parquet(*result_paths), out)


def qc_lists(snpqc: DataFrame, geneqc: DataFrame, genregpcs: DataFrame, thresholds=None) -> dict[str, DataFrame]:
    """SNP and gene inclusion lists, covariate indices and the QC log per cohort."""
    from ..operators import qc
    t = thresholds or qc.QCThresholds()
    picked = qc.pick_covariates(snpqc.select("cohort").distinct(), genregpcs, t)
    return {"snps": qc.snps_to_include(snpqc, t).select("cohort", "ID"),
            "genes": qc.genes_to_include(geneqc, t).select("cohort", "gene"),
            "covariates": picked, "covariate_index": qc.covariate_index_lines(picked),
            "log": qc.qc_log(snpqc, geneqc, genregpcs, t)}


def permuted_genotype_set(permuted_genotype: DataFrame, empirical_probes: DataFrame) -> DataFrame:
    """Genotypes (and individuals) of the permuted set with the probes of the empirical set."""
    return permuted_genotype.join(empirical_probes, ["cohort", "variant_idx"])


def remove_subjects(samples: DataFrame, genotype: DataFrame, phenotype: DataFrame, removed: DataFrame):
    """Drop listed subjects from every table (anti joins on the sample key)."""
    from ..operators.align import remove_samples
    return remove_samples(samples, removed), remove_samples(genotype, removed), remove_samples(phenotype, removed)


def remove_subjects_dense(samples: DataFrame, removed: DataFrame, *tables: tuple[DataFrame, str]) -> tuple[DataFrame, ...]:
    """Dense rows without the listed subjects: ``samples`` (cohort, sample_id, sample_pos) gives the places of the arrays, ``removed``
    lists (cohort, sample_id) or sample ids of all cohorts; each table comes with the name of its array column.

    Returns the samples left, renumbered, and the tables."""
    from ..operators.align import gather_samples, remove_samples
    from ..operators.ranks import rank_within
    left = rank_within(remove_samples(samples, removed).select("cohort", "sample_id", "sample_pos"), "cohort", "sample_pos", "idx")
    order = left.select("cohort", "idx", F.col("sample_pos").alias("pos"))
    return (left.select("cohort", "sample_id", F.col("idx").alias("sample_pos")), *(gather_samples(df, order, col) for df, col in tables))
