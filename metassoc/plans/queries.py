"""Named queries over the driver tables (FIXTURES.md §B roles) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from . import jobs
from .catalog import query
from .oracle_sql import (EFFECT_CTES, META_CTES, META_SELECT, MOMENTS_CTES, PHENO_CTE, R, S, call_covariate, call_ctes,
                         call_moments, effect_ctes, embed_ctes, fixture_ctes, p_normal_sql, p_student_sql, samples_cte, with_all)

N_COV = len(fx.COVARIATES)
_BASE = fixture_ctes()


# ---------------------------------------------------------------- core: meta-analysis

@query("meta_ivw", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT)
def meta_ivw(spark, sf_dir):
    """Flagship: per-cohort OLS from sufficient statistics, pooled by inverse-variance weighting with I²."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.meta_analyse(smp, geno, phen, N_COV)


@query("meta_ivw_parts", with_all(fixture_ctes(n_variants=None), MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT)
def meta_ivw_parts(spark, sf_dir):
    """Meta-analysis with one variant per part (dosage = least(2, lineitems of the part)): the
    large sparse workload, thousands of variants × 5 phenotypes × 5 cohorts."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir, n_variants=None)
    return jobs.meta_analyse(smp, geno, phen, N_COV, by_variant=True)


def _vkey(col="variant"):
    return F.substring(F.col(col), 2, 10).cast("int")


def _variant_include(geno):
    """Per-cohort include list: (cohort, variant) with (vkey + length(cohort)) % 4 <> 0."""
    return (geno.select("cohort", "variant").distinct()
            .where((_vkey() + F.length("cohort")) % 4 != 0))


def _variant_exclude(geno):
    """All-cohort exclude list: variants whose bucket is a multiple of 10."""
    return geno.select("variant").distinct().where(_vkey() % 10 == 0)


def _phenotype_include(phen):
    """Per-cohort include list: (length(cohort) + priority digit) % 5 <> 0."""
    d = F.substring("phenotype", 1, 1).cast("int")
    return phen.select("cohort", "phenotype").distinct().where((F.length("cohort") + d) % 5 != 0)


def _phenotype_exclude(phen):
    return phen.select("phenotype").distinct().where(F.col("phenotype") == "5-LOW")


_VINC_SQL = "vinc AS (SELECT DISTINCT cohort, variant FROM geno WHERE (CAST(substr(variant, 2) AS INTEGER) + length(cohort)) % 4 <> 0)"
_VEXC_SQL = "vexc AS (SELECT DISTINCT variant FROM geno WHERE CAST(substr(variant, 2) AS INTEGER) % 10 = 0)"
_PINC_SQL = "pinc AS (SELECT DISTINCT cohort, phenotype FROM pheno WHERE (length(cohort) + CAST(substr(phenotype, 1, 1) AS INTEGER)) % 5 <> 0)"
_PEXC_SQL = "pexc AS (SELECT DISTINCT phenotype FROM pheno WHERE phenotype = '5-LOW')"


def _moments_filtered(vm_where: str = "TRUE", pm_where: str = "TRUE", geno="geno", pheno="pheno") -> str:
    return f"""cm AS (SELECT cohort, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx FROM samples GROUP BY cohort),
vm AS (SELECT cohort, variant, sum(g) AS sg, sum(g * g) AS sgg, sum(g * x) AS sgx FROM {geno} g0 WHERE {vm_where} GROUP BY cohort, variant),
pm AS (SELECT cohort, phenotype, sum(y) AS sy, sum(y * y) AS syy, sum(x * y) AS sxy FROM {pheno} p0 WHERE {pm_where} GROUP BY cohort, phenotype),
gy AS (SELECT g.cohort, g.variant, p.phenotype, sum(g.g * p.y) AS sgy
       FROM {geno} g JOIN {pheno} p ON g.cohort = p.cohort AND g.sample_id = p.sample_id
       GROUP BY g.cohort, g.variant, p.phenotype)"""


META_T = 1.5
MAF_T = 0.2

_MAF_EFFECT = EFFECT_CTES.replace("vt AS (SELECT *, sgg - (u0 * sg + u1 * sgx) AS s FROM vt0)",
                                  f"vt AS (SELECT *, sgg - (u0 * sg + u1 * sgx) AS s FROM vt0 "
                                  f"WHERE maf >= {MAF_T} AND maf <= 1 - {MAF_T} AND maf <> 0.5)")


@query("meta_threshold", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT
       + f" WHERE abs(beta / standard_error) > {META_T}")
def meta_threshold(spark, sf_dir):
    """Meta-analysis keeping |β/SE| > 1.5 (strict)."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.meta_analyse(smp, geno, phen, N_COV, t_thr=META_T)


@query("meta_maf_filtered", with_all(_BASE, MOMENTS_CTES, _MAF_EFFECT, META_CTES) + META_SELECT)
def meta_maf_filtered(spark, sf_dir):
    """Meta-analysis with the per-cohort MAF window 0.2 ≤ maf ≤ 0.8, maf ≠ 0.5."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.meta_analyse(smp, geno, phen, N_COV, maf=MAF_T, maf_mode="inclusive")


_INC_WHERE_V = ("(g0.cohort, g0.variant) IN (SELECT (cohort, variant) FROM vinc) "
                "AND g0.variant NOT IN (SELECT variant FROM vexc)")
_INC_WHERE_P = ("(p0.cohort, p0.phenotype) IN (SELECT (cohort, phenotype) FROM pinc) "
                "AND p0.phenotype NOT IN (SELECT phenotype FROM pexc)")


@query("meta_include_exclude",
       with_all(_BASE, _VINC_SQL, _VEXC_SQL, _PINC_SQL, _PEXC_SQL,
                _moments_filtered(_INC_WHERE_V, _INC_WHERE_P), EFFECT_CTES, META_CTES) + META_SELECT)
def meta_include_exclude(spark, sf_dir):
    """Per-cohort variant/phenotype include lists plus all-cohort exclude lists (semi/anti joins)."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.meta_analyse(smp, geno, phen, N_COV,
                             variant_include=_variant_include(geno), variant_exclude=_variant_exclude(geno),
                             phenotype_include=_phenotype_include(phen), phenotype_exclude=_phenotype_exclude(phen))


_ALL_V = "(g0.cohort, g0.variant) IN (SELECT (cohort, variant) FROM vinc)"
_ALL_P = "(p0.cohort, p0.phenotype) IN (SELECT (cohort, phenotype) FROM pinc)"
_ALL_EFFECT = EFFECT_CTES.replace(
    "vt AS (SELECT *, sgg - (u0 * sg + u1 * sgx) AS s FROM vt0)",
    "vt AS (SELECT *, sgg - (u0 * sg + u1 * sgx) AS s FROM vt0 WHERE variant IN "
    "(SELECT variant FROM vm GROUP BY variant HAVING count(DISTINCT cohort) = (SELECT count(DISTINCT cohort) FROM samples)))"
).replace(
    "FROM pm pm JOIN cmi ON pm.cohort = cmi.cohort WHERE cmi.det <> 0",
    "FROM pm pm JOIN cmi ON pm.cohort = cmi.cohort WHERE cmi.det <> 0 AND pm.phenotype IN "
    "(SELECT phenotype FROM pm GROUP BY phenotype HAVING count(DISTINCT cohort) = (SELECT count(DISTINCT cohort) FROM samples))")


@query("meta_all_cohorts_only",
       with_all(_BASE, _VINC_SQL, _PINC_SQL, _moments_filtered(_ALL_V, _ALL_P), _ALL_EFFECT, META_CTES) + META_SELECT)
def meta_all_cohorts_only(spark, sf_dir):
    """Include lists, then only variants and phenotypes available in every cohort (ALL)."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.meta_analyse(smp, geno, phen, N_COV, variant_include=_variant_include(geno),
                             phenotype_include=_phenotype_include(phen), availability="all")


@query("heterogeneity_i2", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, META_CTES)
       + f"SELECT variant, phenotype, {R('q')} AS q, k, {S('i_squared')} AS i_squared FROM meta")
def heterogeneity_i2(spark, sf_dir):
    """Cochran's Q (two-pass), number of contributing cohorts and I² per variant × phenotype."""
    from ..operators.meta import inverse_variance
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    eff = jobs.cohort_effects(smp, geno, phen, N_COV)
    return inverse_variance(eff, with_q=True).select("variant", "phenotype", "q", "k", "i_squared")


_GENES_SQL = "genes AS (SELECT DISTINCT o_orderpriority AS phenotype FROM orders WHERE o_orderpriority < '3')"


@query("per_cohort_effects", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, _GENES_SQL)
       + f"""SELECT cohort, variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error,
       {R('n')} AS sample_size FROM eff WHERE se > 0 AND phenotype IN (SELECT phenotype FROM genes)""")
def per_cohort_effects(spark, sf_dir):
    """Per-cohort log for a requested gene list (all variants × those genes, per cohort)."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    genes = (fx.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("phenotype"))
             .where(F.col("phenotype") < "3").distinct())
    # W5: requested genes ∩ the cohort's own phenotypes
    genes_per_cohort = phen.select("cohort", "phenotype").distinct().join(genes, "phenotype", "left_semi")
    eff = jobs.cohort_effects(smp, geno, phen, N_COV, phenotype_include=genes_per_cohort)
    from ..operators.meta import contributing
    return jobs.per_cohort_effects(contributing(eff), phenotypes=genes)


_MEGA_CTES = """cmp AS (SELECT 'ALL' AS cohort, sum(n) AS n, sum(sx) AS sx, sum(sxx) AS sxx FROM cm),
vmp AS (SELECT 'ALL' AS cohort, variant, sum(sg) AS sg, sum(sgg) AS sgg, sum(sgx) AS sgx FROM vm
        GROUP BY variant HAVING count(*) = (SELECT count(*) FROM cm)),
pmp AS (SELECT 'ALL' AS cohort, phenotype, sum(sy) AS sy, sum(syy) AS syy, sum(sxy) AS sxy FROM pm
        GROUP BY phenotype HAVING count(*) = (SELECT count(*) FROM cm)),
gyp AS (SELECT 'ALL' AS cohort, variant, phenotype, sum(sgy) AS sgy FROM gy GROUP BY variant, phenotype)"""


@query("mega_analysis", with_all(_BASE, MOMENTS_CTES, _MEGA_CTES, effect_ctes("cmp", "vmp", "pmp", "gyp"))
       + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('beta / se')} AS t_stat,
       {R('n')} AS sample_size, {R('maf')} AS maf FROM eff""")
def mega_analysis(spark, sf_dir):
    """Pooled regression: partial derivatives summed over cohorts, then one solve."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.mega_analyse(smp, geno, phen, N_COV)


_SINGLE = "EUROPE"


@query("single_site_association",
       with_all(fixture_ctes(where=f"r.r_name = '{_SINGLE}'"), MOMENTS_CTES, EFFECT_CTES)
       + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('beta / se')} AS t_stat,
       {R('maf')} AS maf, df FROM eff""")
def single_site_association(spark, sf_dir):
    """One cohort, every variant × phenotype: β, SE, t, MAF, degrees of freedom."""
    from pyspark import StorageLevel
    smp = fx.samples(spark, sf_dir).where(F.col("cohort") == _SINGLE)
    # derived views read twice (moments and cross products): persisted like fixtures.cohort_data
    geno = fx.genotype(spark, sf_dir, smp=smp).persist(StorageLevel.MEMORY_AND_DISK)
    phen = fx.phenotype(spark, sf_dir, smp=smp).persist(StorageLevel.MEMORY_AND_DISK)
    eff = jobs.cohort_effects(smp, geno, phen, N_COV)
    return eff.select("variant", "phenotype", "beta", "standard_error", "t_stat", "maf", "df")


# ---------------------------------------------------------------- partial derivatives

@query("partial_derivatives_acov", with_all(_BASE, MOMENTS_CTES)
       + f"SELECT cohort, n, {R('CAST(n AS DOUBLE)')} AS a_00, {R('sx')} AS a_01, {R('sxx')} AS a_11 FROM cm")
def partial_derivatives_acov(spark, sf_dir):
    """A_cov = X̃ᵀX̃ per cohort (intercept + one covariate), flattened."""
    from ..operators.moments import covariate_moments
    smp = fx.samples(spark, sf_dir)
    a = covariate_moments(smp, N_COV)
    return a.select("cohort", "n", F.col("a_cov")[0][0].alias("a_00"), F.col("a_cov")[0][1].alias("a_01"),
                    F.col("a_cov")[1][1].alias("a_11"))


@query("partial_derivatives_atest", with_all(_BASE, MOMENTS_CTES)
       + f"""SELECT vm.cohort, vm.variant, {R('sg')} AS a_0, {R('sgx')} AS a_1, {R('sgg')} AS gg,
       {R('sg / (2.0 * cm.n)')} AS maf FROM vm JOIN cm ON vm.cohort = cm.cohort""")
def partial_derivatives_atest(spark, sf_dir):
    """A_test per cohort and variant: [Σg, Σgx], Σg², MAF."""
    from ..operators.moments import variant_moments
    smp, geno, _ = fx.cohort_data(spark, sf_dir)
    t = variant_moments(geno, smp, N_COV)
    return t.select("cohort", "variant", F.col("a")[0].alias("a_0"), F.col("a")[1].alias("a_1"), "gg", "maf")


@query("partial_derivatives_b", with_all(_BASE, MOMENTS_CTES)
       + f"SELECT cohort, phenotype, {R('sy')} AS b_0, {R('sxy')} AS b_1, {R('syy')} AS c FROM pm")
def partial_derivatives_b(spark, sf_dir):
    """B_cov = X̃ᵀy and C = yᵀy per cohort and phenotype."""
    from ..operators.moments import phenotype_moments
    smp, _, phen = fx.cohort_data(spark, sf_dir)
    b = phenotype_moments(phen, smp, N_COV)
    return b.select("cohort", "phenotype", F.col("b")[0].alias("b_0"), F.col("b")[1].alias("b_1"), "c")


@query("b4_product", with_all(_BASE, MOMENTS_CTES) + f"SELECT cohort, variant, phenotype, {R('sgy')} AS gy FROM gy")
def b4_product(spark, sf_dir):
    """B4 = Σ g·y per cohort, variant and phenotype (sparse long path)."""
    from ..operators.moments import cross_moments
    _, geno, phen = fx.cohort_data(spark, sf_dir)
    return cross_moments(geno, phen)


# ---------------------------------------------------------------- dense block path (embeddings)

@query("b4_embeddings", with_all(embed_ctes())
       + f"SELECT eg.variant, ep.phenotype, {R('list_dot_product(eg.g, ep.y)')} AS gy FROM eg JOIN ep ON eg.cohort = ep.cohort", pairs=True)
def b4_embeddings(spark, sf_dir):
    """Dense matrix product G·Y: every variant row against every phenotype row (block GEMM)."""
    from ..operators.blocks import dot_products
    geno, phen = fx.embedding_rows(spark, sf_dir)
    d = dot_products(geno.withColumnRenamed("dosage", "vec"), phen.withColumnRenamed("values", "vec"))
    return d.select("variant", "phenotype", F.col("dot").alias("gy"))


@query("dense_association", with_all(embed_ctes())
       + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error,
       {R('sample_size')} AS sample_size FROM (SELECT *, CAST(n AS DOUBLE) AS sample_size FROM eff WHERE se > 0)""", pairs=True)
def dense_association(spark, sf_dir):
    """Single-site association on dense rows (block path), intercept-only model."""
    from ..operators.blocks import dense_associate
    geno, phen = fx.embedding_rows(spark, sf_dir)
    return dense_associate(geno, phen, pooled=False, columns=("variant", "phenotype", "beta", "standard_error", "sample_size"))


@query("dense_meta", with_all(embed_ctes(split=True), META_CTES) + META_SELECT, pairs=True)
def dense_meta(spark, sf_dir):
    """Two dense cohorts (vector halves) analysed in the block path and pooled inside each task."""
    from ..operators.blocks import dense_associate
    geno, phen = fx.embedding_rows(spark, sf_dir, split=True)
    return dense_associate(geno, phen, pooled=True)


# ---------------------------------------------------------------- cohort level, samples, imputation, MAF, flips

@query("meta_nation_cohorts", with_all(fixture_ctes(level="nation"), MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT)
def meta_nation_cohorts(spark, sf_dir):
    """Meta-analysis over 25 small nation cohorts (missing variants and singular designs appear)."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir, level="nation")
    return jobs.meta_analyse(smp, geno, phen, N_COV)


@query("sample_removal", with_all(fixture_ctes(where="c.c_custkey % 10 <> 0"), MOMENTS_CTES, EFFECT_CTES, META_CTES)
       + META_SELECT)
def sample_removal(spark, sf_dir):
    """Meta-analysis after removing listed subjects (customers whose key is a multiple of 10)."""
    from ..operators.align import remove_samples
    removed = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id")).where(F.col("sample_id") % 10 == 0)
    smp = remove_samples(fx.samples(spark, sf_dir), removed)
    geno, phen = fx.reused(fx.genotype(spark, sf_dir, smp=smp), fx.phenotype(spark, sf_dir, smp=smp))
    return jobs.meta_analyse(smp, geno, phen, N_COV)


_MISS_BASE = fixture_ctes(with_missing=True)
_MISS_ST = """st AS (SELECT cohort, variant, coalesce(sum(CASE WHEN g <> 9 THEN g END), 0.0) AS s_obs,
              count(CASE WHEN g = 9 THEN 1 END) AS n_miss FROM geno GROUP BY cohort, variant),
cn AS (SELECT cohort, count(*) AS n FROM samples GROUP BY cohort)"""


@query("mean_impute", with_all(_MISS_BASE, _MISS_ST)
       + f"""SELECT g.cohort, g.sample_id, g.variant,
       {R('CASE WHEN g.g = 9 THEN st.s_obs / (cn.n - st.n_miss) ELSE g.g END')} AS dosage
       FROM geno g JOIN st ON g.cohort = st.cohort AND g.variant = st.variant JOIN cn ON g.cohort = cn.cohort""")
def mean_impute(spark, sf_dir):
    """Missing calls (code 9: all lineitems returned) replaced by the cohort-variant mean of observed calls."""
    from ..operators.moments import impute_mean
    smp = fx.samples(spark, sf_dir)
    geno = fx.genotype(spark, sf_dir, with_missing=True, smp=smp)
    return impute_mean(geno, smp).select("cohort", "sample_id", "variant", "dosage")


@query("maf_by_cohort", with_all(_MISS_BASE, _MISS_ST)
       + f"""SELECT st.cohort, st.variant, {R('st.s_obs / (2.0 * (cn.n - st.n_miss))')} AS maf, cn.n - st.n_miss AS n_obs
       FROM st JOIN cn ON st.cohort = cn.cohort""")
def maf_by_cohort(spark, sf_dir):
    """Allele frequency mean(g)/2 per cohort and variant over observed (non-missing) calls."""
    from ..operators.moments import observed_maf
    smp = fx.samples(spark, sf_dir)
    return observed_maf(fx.genotype(spark, sf_dir, with_missing=True, smp=smp), smp)


@query("pooled_maf", with_all(_BASE, MOMENTS_CTES)
       + f"""SELECT vm.variant, {R('sum(cm.n * (vm.sg / (2.0 * cm.n))) / sum(cm.n)')} AS maf
       FROM vm JOIN cm ON vm.cohort = cm.cohort GROUP BY vm.variant""")
def pooled_maf_q(spark, sf_dir):
    """Pooled MAF Σ n_c·maf_c / Σ n_c over cohorts."""
    from ..operators.moments import covariate_moments, pooled_maf, variant_moments
    smp, geno, _ = fx.cohort_data(spark, sf_dir)
    cov = covariate_moments(smp, N_COV)
    return pooled_maf(variant_moments(geno, smp, N_COV, cov), cov)


@query("maf_consistency", with_all(_BASE, MOMENTS_CTES)
       + f"""SELECT variant, {R('stddev_pop(maf)')} AS maf_sd, count(*) AS k,
       CAST(stddev_pop(maf) > 0.1 AS INTEGER) AS inconsistent
       FROM (SELECT vm.variant, vm.sg / (2.0 * cm.n) AS maf FROM vm JOIN cm ON vm.cohort = cm.cohort) GROUP BY variant""")
def maf_consistency_q(spark, sf_dir):
    """Population SD of MAF across cohorts per variant, flagged when > 0.1."""
    from ..operators.moments import maf_consistency, variant_moments
    smp, geno, _ = fx.cohort_data(spark, sf_dir)
    return maf_consistency(variant_moments(geno, smp, N_COV))


def _flip_list(geno):
    """Per-cohort flips: bucket + length(cohort) divisible by 3 -> allele swapped (-1)."""
    return (geno.select("cohort", "variant").distinct()
            .withColumn("flip", F.when((_vkey() + F.length("cohort")) % 3 == 0, F.lit(-1)).otherwise(F.lit(1))))


_FLIP_SQL = """fl AS (SELECT DISTINCT cohort, variant,
       CASE WHEN (CAST(substr(variant, 2) AS INTEGER) + length(cohort)) % 3 = 0 THEN -1 ELSE 1 END AS flip FROM geno)"""


@query("flip_dosage", with_all(_BASE, MOMENTS_CTES, _FLIP_SQL)
       + f"""SELECT vm.cohort, vm.variant, fl.flip,
       {R('CASE WHEN fl.flip = -1 THEN 2.0 * cm.n - vm.sg ELSE vm.sg END')} AS a_0,
       {R('CASE WHEN fl.flip = -1 THEN 2.0 * cm.sx - vm.sgx ELSE vm.sgx END')} AS a_1,
       {R('CASE WHEN fl.flip = -1 THEN 4.0 * cm.n - 4.0 * vm.sg + vm.sgg ELSE vm.sgg END')} AS gg,
       {R('CASE WHEN fl.flip = -1 THEN 2.0 * cm.n - vm.sg ELSE vm.sg END / (2.0 * cm.n)')} AS maf
       FROM vm JOIN cm ON vm.cohort = cm.cohort JOIN fl ON vm.cohort = fl.cohort AND vm.variant = fl.variant""")
def flip_dosage(spark, sf_dir):
    """Allele flip g -> 2 − g applied to the per-cohort variant moments (zeros never densified)."""
    from ..operators.moments import covariate_moments, flip_moments, variant_moments
    smp, geno, _ = fx.cohort_data(spark, sf_dir)
    cov = covariate_moments(smp, N_COV)
    t = flip_moments(variant_moments(geno, smp, N_COV, cov), cov, _flip_list(geno))
    return t.select("cohort", "variant", "flip", F.col("a")[0].alias("a_0"), F.col("a")[1].alias("a_1"), "gg", "maf")


# ---------------------------------------------------------------- harmonisation

_HARM_SQL = """ref AS (SELECT p_partkey AS ref_idx, 'rs' || CAST(p_partkey AS VARCHAR) AS ref_id, p_size % 22 + 1 AS chr,
               p_partkey AS bp,
               substr('ACGT', CAST(substr(p_brand, 7, 4) AS INTEGER) % 4 + 1, 1) AS allele1,
               substr('ACGT', (CAST(substr(p_brand, 7, 4) AS INTEGER) + 1) % 4 + 1, 1) AS allele2 FROM part),
sold AS (SELECT DISTINCT s.cohort, l.l_partkey AS pk FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
         JOIN samples s ON o.o_custkey = s.sample_id),
pr0 AS (SELECT sold.cohort, ref.ref_idx AS variant_idx, ref.ref_id AS id, ref.chr, ref.bp, ref.allele1 AS a1,
               CASE WHEN ref.ref_idx % 7 = 0 THEN 'N' ELSE ref.allele2 END AS a2
        FROM sold JOIN ref ON sold.pk = ref.ref_idx),
probes AS (SELECT cohort, variant_idx, id, chr, bp,
                  CASE WHEN variant_idx % 3 = 0 THEN a2 ELSE a1 END AS allele1,
                  CASE WHEN variant_idx % 3 = 0 THEN a1 ELSE a2 END AS allele2 FROM pr0),
mt AS (SELECT p.cohort, r.ref_idx, r.ref_id, p.variant_idx,
              CASE WHEN p.allele1 = r.allele1 AND p.allele2 = r.allele2 THEN 1 ELSE -1 END AS flip
       FROM probes p JOIN ref r ON p.chr = r.chr AND p.bp = r.bp
        AND ((p.allele1 = r.allele1 AND p.allele2 = r.allele2) OR (p.allele1 = r.allele2 AND p.allele2 = r.allele1))),
vmap AS (SELECT cohort, ref_idx, ref_id, arg_max(variant_idx, flip * 1e15 + variant_idx) AS variant_idx,
                max(flip) AS flip FROM mt GROUP BY cohort, ref_idx, ref_id)"""
_HARM = with_all(samples_cte(), _HARM_SQL)


def _harm(spark, sf_dir):
    from ..operators.harmonise import harmonise
    probes = fx.cohort_probes(spark, sf_dir)
    ref = fx.reference_panel(spark, sf_dir)
    return probes, ref, harmonise(probes, ref)


@query("harmonise_map", _HARM + "SELECT cohort, ref_idx, ref_id, variant_idx, flip FROM vmap")
def harmonise_map(spark, sf_dir):
    """Probe ↔ reference map by (chr, bp, alleles): straight match flip +1, swapped alleles flip −1."""
    return _harm(spark, sf_dir)[2]


@query("harmonise_unmatched", _HARM + """SELECT p.cohort, p.variant_idx, p.id, p.allele1, p.allele2 FROM probes p
       WHERE NOT EXISTS (SELECT 1 FROM vmap v WHERE v.cohort = p.cohort AND v.variant_idx = p.variant_idx)""")
def harmonise_unmatched(spark, sf_dir):
    """Probes found neither straight nor swapped in the reference panel."""
    from ..operators.harmonise import unmatched
    probes, _, vmap = _harm(spark, sf_dir)
    return unmatched(probes, vmap).select("cohort", "variant_idx", "id", "allele1", "allele2")


@query("harmonise_flipped", _HARM + """SELECT p.cohort, p.variant_idx, p.id, p.allele1, p.allele2, v.ref_id
       FROM probes p JOIN vmap v ON v.cohort = p.cohort AND v.variant_idx = p.variant_idx WHERE v.flip = -1""")
def harmonise_flipped(spark, sf_dir):
    """Probes matched with swapped alleles (their dosages are flipped before analysis)."""
    from ..operators.harmonise import flipped
    probes, _, vmap = _harm(spark, sf_dir)
    return flipped(probes, vmap).select("cohort", "variant_idx", "id", "allele1", "allele2", "ref_id")


@query("harmonise_counts", _HARM + """SELECT c.cohort, coalesce(m.common, 0) AS common,
       (SELECT count(*) FROM ref) - coalesce(m.common, 0) AS ref_not_in_probes,
       c.np - coalesce(m.used, 0) AS probes_not_in_ref
       FROM (SELECT cohort, count(*) AS np FROM probes GROUP BY cohort) c
       LEFT JOIN (SELECT cohort, count(*) AS common, count(DISTINCT variant_idx) AS used FROM vmap GROUP BY cohort) m
       ON c.cohort = m.cohort""")
def harmonise_counts(spark, sf_dir):
    """Per cohort: common variants, reference rows not in probes, probes not in the reference."""
    from ..operators.harmonise import map_counts
    probes, ref, vmap = _harm(spark, sf_dir)
    return map_counts(probes, ref, vmap)


# ---------------------------------------------------------------- QC lists

_QC_SQL = """cn AS (SELECT cohort, count(*) AS n FROM samples GROUP BY cohort),
st AS (SELECT cohort, variant, count(*) FILTER (WHERE g = 1) AS n1, count(*) FILTER (WHERE g = 2) AS n2,
              count(*) AS nz, sum(g) AS sg FROM geno GROUP BY cohort, variant),
snpqc AS (SELECT st.cohort, st.variant AS ID,
                 least(st.sg / (2.0 * cn.n), 1 - st.sg / (2.0 * cn.n)) AS MAF,
                 CAST(1.0 / pow(10.0, CAST(substr(st.variant, 2) AS INTEGER) % 9) AS DOUBLE) AS HWE,
                 CAST((CAST(substr(st.variant, 2) AS INTEGER) % 10) / 10.0 + 0.05 AS DOUBLE) AS MACH_R2,
                 CAST(CASE WHEN CAST(substr(st.variant, 2) AS INTEGER) % 13 = 0 THEN 0.98 ELSE 1.0 END AS DOUBLE) AS CALL,
                 CAST(substr(st.variant, 2) AS INTEGER) % 2 AS TYPED,
                 CAST(cn.n - st.nz AS DOUBLE) AS hom1, CAST(st.n1 AS DOUBLE) AS het, CAST(st.n2 AS DOUBLE) AS hom2
          FROM st JOIN cn ON st.cohort = cn.cohort),
passing AS (SELECT * FROM snpqc WHERE MAF > 0.01 AND MAF > 0.01 AND HWE > 1e-6 AND MACH_R2 > 0.4 AND CALL = 1.0),
mac AS (SELECT p.*, 2 * mm.mh + p.het AS MAC FROM passing p
        JOIN (SELECT cohort, ID, least(min(hom1), min(hom2)) AS mh FROM passing GROUP BY cohort, ID) mm
        ON p.cohort = mm.cohort AND p.ID = mm.ID),
kept AS (SELECT * FROM mac WHERE (cohort, ID) IN (SELECT (cohort, ID) FROM mac WHERE MAC > 10)),
gq AS (SELECT cohort, phenotype AS gene, count(y) AS nr_values, count(DISTINCT y) AS nr_unique_values
       FROM pheno GROUP BY cohort, phenotype),
gkept AS (SELECT gq.* FROM gq JOIN (SELECT cohort, max(nr_values) AS mx FROM gq GROUP BY cohort) m
          ON gq.cohort = m.cohort WHERE gq.nr_unique_values > 0.8 * m.mx),
sup AS (SELECT r.r_name AS cohort, 'ExpPC' || CAST(s.s_suppkey % 100 + 1 AS VARCHAR) AS Phenotype,
               1.0 / pow(10.0, s.s_suppkey % 12) AS pval
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
reg AS (SELECT DISTINCT cohort, Phenotype, CAST(substr(Phenotype, 6) AS BIGINT) AS num FROM sup WHERE pval < 1e-7)"""
_QC = with_all(_BASE, _QC_SQL)


def _qc_inputs(spark, sf_dir):
    return fx.snpqc_table(spark, sf_dir), fx.geneqc_table(spark, sf_dir), fx.genregpcs_table(spark, sf_dir)


@query("qc_snp_table", _QC + f"""SELECT cohort, ID, {R('MAF')} AS MAF, {R('HWE')} AS HWE, {R('MACH_R2')} AS MACH_R2,
       {R('CALL')} AS CALL, TYPED,
       'AA: ' || CAST(CAST(hom1 AS BIGINT) AS VARCHAR) || ', AB: ' || CAST(CAST(het AS BIGINT) AS VARCHAR)
       || ', BB: ' || CAST(CAST(hom2 AS BIGINT) AS VARCHAR) AS Genotype_Counts FROM snpqc""")
def qc_snp_table(spark, sf_dir):
    """The per-cohort SNP QC file (MAF folded, genotype counts as 'AA: n, AB: n, BB: n')."""
    return fx.snpqc_table(spark, sf_dir)


@query("qc_mac", _QC + f"SELECT cohort, ID, {R('hom1')} AS hom1, {R('het')} AS het, {R('hom2')} AS hom2, {R('MAC')} AS MAC FROM mac")
def qc_mac(spark, sf_dir):
    """Minor-allele count 2·min(hom1, hom2) + het per QC-passing SNP (counts parsed from text)."""
    from ..operators.qc import minor_allele_counts, snp_passing
    snp, _, _ = _qc_inputs(spark, sf_dir)
    return minor_allele_counts(snp_passing(snp)).select("cohort", "ID", "hom1", "het", "hom2", "MAC")


@query("qc_snps", _QC + "SELECT cohort, ID FROM kept")
def qc_snps(spark, sf_dir):
    """SNP inclusion list per cohort: MAF/HWE/MACH_R2/CALL filters, then MAC > 10."""
    from ..operators.qc import snps_to_include
    snp, _, _ = _qc_inputs(spark, sf_dir)
    return snps_to_include(snp).select("cohort", "ID")


@query("qc_genes", _QC + "SELECT cohort, gene FROM gkept")
def qc_genes(spark, sf_dir):
    """Gene inclusion list per cohort: unique values > 0.8 · max(values) of the cohort."""
    from ..operators.qc import genes_to_include
    _, gq, _ = _qc_inputs(spark, sf_dir)
    return genes_to_include(gq).select("cohort", "gene")


def _qc_thresholds():
    from ..operators.qc import QCThresholds
    return QCThresholds(drop_regulated_pcs=True)


@query("qc_covariates", _QC + """, pick AS (
  SELECT c.cohort, 'GenPC' || CAST(i AS VARCHAR) AS covariate, i AS idx FROM (SELECT DISTINCT cohort FROM samples) c, range(1, 5) t(i)
  UNION ALL
  SELECT c.cohort, 'ExpPC' || CAST(i AS VARCHAR) AS covariate, i + 10 AS idx FROM (SELECT DISTINCT cohort FROM samples) c, range(1, 21) t(i))
SELECT p.cohort, p.covariate, CAST(p.idx AS INTEGER) AS idx FROM pick p
WHERE NOT EXISTS (SELECT 1 FROM reg WHERE reg.cohort = p.cohort AND reg.Phenotype = p.covariate)""")
def qc_covariates(spark, sf_dir):
    """Covariates per cohort: first 4 GenPCs and first 20 ExpPCs minus genetically regulated PCs."""
    from ..operators.qc import pick_covariates
    smp = fx.samples(spark, sf_dir)
    return pick_covariates(smp, fx.genregpcs_table(spark, sf_dir), _qc_thresholds())


@query("qc_log", _QC + """SELECT b.cohort, b.N, b.nr_snps, coalesce(k.filtered_snps, 0) AS filtered_snps,
       coalesce(k.typed_snps, 0) AS typed_snps, coalesce(m.snps_mac_gt_10, 0) AS snps_mac_gt_10,
       coalesce(k.snps_both_hom_gt_5, 0) AS snps_both_hom_gt_5, coalesce(g.genes_original, 0) AS genes_original,
       coalesce(gk.genes_filtered, 0) AS genes_filtered, coalesce(r.regulated_pcs, '') AS regulated_pcs
FROM (SELECT cohort, CAST(max(hom1 + het + hom2) AS BIGINT) AS N, count(*) FILTER (WHERE MAF > 0.01) AS nr_snps
      FROM snpqc GROUP BY cohort) b
LEFT JOIN (SELECT cohort, count(*) AS filtered_snps, count(*) FILTER (WHERE TYPED = 1) AS typed_snps,
           count(*) FILTER (WHERE hom1 > 5 AND hom2 > 5) AS snps_both_hom_gt_5 FROM kept GROUP BY cohort) k ON b.cohort = k.cohort
LEFT JOIN (SELECT cohort, count(*) FILTER (WHERE MAC > 10) AS snps_mac_gt_10 FROM mac GROUP BY cohort) m ON b.cohort = m.cohort
LEFT JOIN (SELECT cohort, count(*) AS genes_original FROM gq GROUP BY cohort) g ON b.cohort = g.cohort
LEFT JOIN (SELECT cohort, count(*) AS genes_filtered FROM gkept GROUP BY cohort) gk ON b.cohort = gk.cohort
LEFT JOIN (SELECT cohort, string_agg(Phenotype, ', ' ORDER BY num) AS regulated_pcs FROM reg GROUP BY cohort) r
       ON b.cohort = r.cohort""")
def qc_log(spark, sf_dir):
    """Per-cohort QC log: N, SNP counts at each step, gene counts, regulated PCs in natural order."""
    from ..operators.qc import qc_log as _log
    snp, gq, reg = _qc_inputs(spark, sf_dir)
    return _log(snp, gq, reg)


# ---------------------------------------------------------------- sample intersection (events phenotypes)

_EV_SQL = """smp_i AS (SELECT s.* FROM samples s WHERE s.sample_id IN (SELECT user_id FROM events)
                                            AND s.sample_id IN (SELECT sample_id FROM calls)),
pheno_e AS (SELECT s.cohort, s.sample_id, s.x, e.event_type AS phenotype, avg(e.value) AS y
            FROM events e JOIN smp_i s ON e.user_id = s.sample_id GROUP BY s.cohort, s.sample_id, s.x, e.event_type),
geno_e AS (SELECT g.* FROM geno g WHERE g.sample_id IN (SELECT sample_id FROM smp_i))"""


def _events_inputs(spark, sf_dir):
    from ..operators.align import sample_intersection
    smp = fx.samples(spark, sf_dir)
    ev = fx.event_phenotype(spark, sf_dir)
    calls = fx.calls(spark, sf_dir).select("sample_id").distinct()
    # phenotype ∩ genotype ∩ partial-derivative samples, keyed by (cohort, sample_id)
    tag = smp.select("cohort", "sample_id")
    inter = sample_intersection(tag.join(ev.select("sample_id").distinct(), "sample_id"),
                                tag.join(calls, "sample_id"), tag)
    smp_i = smp.join(inter, ["cohort", "sample_id"], "left_semi")
    return smp_i, inter, ev


@query("sample_intersection", with_all(_BASE, _EV_SQL) + "SELECT cohort, sample_id FROM smp_i")
def sample_intersection_q(spark, sf_dir):
    """Samples present in phenotype (events users), genotype (customers with calls) and PD (customers)."""
    return _events_inputs(spark, sf_dir)[1]


@query("meta_events_intersection",
       with_all(_BASE, _EV_SQL, _moments_filtered(geno="geno_e", pheno="pheno_e").replace("FROM samples", "FROM smp_i"),
                EFFECT_CTES, META_CTES) + META_SELECT)
def meta_events_intersection(spark, sf_dir):
    """Meta-analysis of event-type phenotypes (mean value per user) on the intersected samples."""
    smp_i, _, ev = _events_inputs(spark, sf_dir)
    geno, phen = fx.reused(fx.genotype(spark, sf_dir, smp=smp_i),
                           ev.join(smp_i, "sample_id").select("cohort", "sample_id", "phenotype", "y", "x"))
    return jobs.meta_analyse(smp_i, geno, phen, N_COV)


# ---------------------------------------------------------------- annotation, partitioned output, summaries

_PROBE_SQL = """vp AS (SELECT 'v' || CAST(ref_idx % 20 AS VARCHAR) AS ID, min(allele1) AS allele1, max(allele2) AS allele2,
                      avg(p.p_retailprice) / 2000.0 AS Rsq
               FROM ref JOIN part p ON ref.ref_idx = p.p_partkey GROUP BY ref_idx % 20)"""
_REF_ONLY = _HARM_SQL.split(",\nsold AS")[0]


def _site_effects(spark, sf_dir):
    """Each cohort analysed by itself, every pair with a t statistic (F11 with no threshold drops 0 and NaN)."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.associate(smp, geno, phen, N_COV)


@query("annotate_results", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, _REF_ONLY, _PROBE_SQL)
       + f"""SELECT e.cohort, e.variant AS RSID, e.phenotype, {R('e.beta')} AS BETA, {R('e.se')} AS SE, {R('e.maf')} AS AF_coded,
       vp.allele1, vp.allele2, {R('vp.Rsq')} AS Rsq FROM eff e JOIN vp ON e.variant = vp.ID WHERE e.se > 0 AND e.beta <> 0""")
def annotate_results(spark, sf_dir):
    """Single-site results of all cohorts joined with probe information (alleles, Rsq); MAF renamed AF_coded."""
    from ..operators.report import annotate
    res = _site_effects(spark, sf_dir).select("cohort", F.col("variant").alias("RSID"), "phenotype", F.col("beta").alias("BETA"),
                                              F.col("standard_error").alias("SE"), F.col("maf").alias("MAF"))
    return annotate(res, fx.variant_probes(spark, sf_dir)).select(
        "cohort", "RSID", "phenotype", "BETA", "SE", "AF_coded", "allele1", "allele2", "Rsq")


_EXTRACT = "1-URGENT"


@query("result_by_phenotype", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT
       + f" WHERE phenotype = '{_EXTRACT}'")
def result_by_phenotype(spark, sf_dir):
    """Meta results written partitioned by phenotype, then one phenotype read back (partition pruning)."""
    import uuid
    from ..session import shared_path
    from ..sources.sinks import read_phenotypes, write_by_phenotype
    path = shared_path(spark, "results", f"meta_by_phenotype_{uuid.uuid4().hex}")
    write_by_phenotype(meta_ivw(spark, sf_dir), path)
    return read_phenotypes(spark, path, _EXTRACT)


_TSTATS = "tt AS (SELECT *, beta / se AS tval FROM eff WHERE se > 0)"
_PV = "pv AS (" + p_student_sql("tval", "df", "tt", "cohort, variant, phenotype, beta, se, maf, df, tval") + ")"


@query("association_summary", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, _TSTATS, _PV)
       + f"""SELECT cohort, variant AS RSID, {R('p_value')} AS p_value, {R('tval')} AS t_stat, phenotype, {R('se')} AS SE, {R('maf')} AS MAF,
       {R('beta')} AS BETA FROM pv""")
def association_summary(spark, sf_dir):
    """Summary table of the single-site runs of all cohorts: RSID, p_value (Student t, df), t-stat, phenotype, SE, MAF, BETA."""
    from ..operators.report import summarise
    return summarise(_site_effects(spark, sf_dir), keep=("cohort",))


@query("p_values", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, _TSTATS, _PV)
       + f"""SELECT cohort, variant, phenotype, {R('tval')} AS t_stat, df, {R('p_value')} AS p_value, {R(p_normal_sql('tval'))} AS p_normal FROM pv""")
def p_values(spark, sf_dir):
    """Two-sided p-values of the per-cohort t statistics: Student t with the cohort's df, and normal."""
    from ..functions.pvalues import p_value
    return _site_effects(spark, sf_dir).select("cohort", "variant", "phenotype", "t_stat", "df",
                                               p_value("t_stat", "df").alias("p_value"), p_value("t_stat").alias("p_normal"))


_SEED = 42
_PERM_SQL = f"""perm AS (
  SELECT a.cohort, a.sample_id, b.sample_id AS source_id FROM
    (SELECT cohort, sample_id, row_number() OVER (PARTITION BY cohort ORDER BY sample_id) AS r FROM samples) a
  JOIN (SELECT cohort, sample_id, row_number() OVER (PARTITION BY cohort ORDER BY
          md5(CAST(sample_id AS VARCHAR) || ':{_SEED}'), sample_id) AS r FROM samples) b
  ON a.cohort = b.cohort AND a.r = b.r),
pheno_p AS (SELECT p.cohort, perm.sample_id, s.x, p.phenotype, p.y FROM pheno p
            JOIN perm ON p.cohort = perm.cohort AND p.sample_id = perm.source_id
            JOIN samples s ON s.cohort = perm.cohort AND s.sample_id = perm.sample_id)"""


@query("permuted_association", with_all(_BASE, _PERM_SQL, _moments_filtered(pheno="pheno_p"), EFFECT_CTES, META_CTES)
       + META_SELECT)
def permuted_association(spark, sf_dir):
    """Meta-analysis after a seeded within-cohort permutation of the phenotype samples (null run)."""
    from ..operators.permute import permute_phenotype
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.meta_analyse(smp, geno, permute_phenotype(phen, smp, _SEED), N_COV)


# ---------------------------------------------------------------- encoding, interactions, study intercepts

_KEY_SEED = 7


@query("encode_roundtrip", with_all(_BASE, MOMENTS_CTES) + f"""SELECT g.cohort, g.variant, g.phenotype, {R('coalesce(gy.sgy, 0.0)')} AS gy
       FROM (SELECT vm.cohort, vm.variant, pm.phenotype FROM vm JOIN pm ON vm.cohort = pm.cohort) g
       LEFT JOIN gy ON gy.cohort = g.cohort AND gy.variant = g.variant AND gy.phenotype = g.phenotype""")
def encode_roundtrip(spark, sf_dir):
    """gᵀy from privacy-encoded genotype G·F and phenotype F⁻¹·P (equals b4_product up to conditioning)."""
    from ..operators.encode import encode, encoded_cross_moments
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    enc = encode(smp, geno, phen, seed=_KEY_SEED)
    return encoded_cross_moments(enc["genotype"], enc["phenotype"])


# Genotype × x interaction: partial out [1, x] (2×2 inverse), then a 2×2 solve for (g·x, g).
def _amb(a0, a1, b0, b1):
    return f"((c.sxx * {a0} * {b0} - c.sx * ({a0} * {b1} + {a1} * {b0}) + c.n * {a1} * {b1}) / c.det)"


_INTER_SQL = f"""ci AS (SELECT cohort, n, sx, sxx, n * sxx - sx * sx AS det FROM cm),
vi AS (SELECT cohort, variant, sum(g * x) AS s1, sum(g * x * x) AS s1x, sum(g * g * x * x) AS s11,
              sum(g * g * x) AS s12, sum(g) AS s2, sum(g * x) AS s2x, sum(g * g) AS s22
       FROM geno GROUP BY cohort, variant),
zy AS (SELECT g.cohort, g.variant, p.phenotype, sum(g.g * g.x * p.y) AS z1y, sum(g.g * p.y) AS z2y
       FROM geno g JOIN pheno p ON g.cohort = p.cohort AND g.sample_id = p.sample_id
       GROUP BY g.cohort, g.variant, p.phenotype),
rv AS (SELECT v.*, c.n, c.sx, c.sxx, c.det,
              v.s11 - {_amb('v.s1', 'v.s1x', 'v.s1', 'v.s1x')} AS r11,
              v.s12 - {_amb('v.s1', 'v.s1x', 'v.s2', 'v.s2x')} AS r12,
              v.s22 - {_amb('v.s2', 'v.s2x', 'v.s2', 'v.s2x')} AS r22
       FROM vi v JOIN ci c ON v.cohort = c.cohort WHERE c.det <> 0),
rp AS (SELECT v.cohort, v.variant, pm.phenotype, v.n, v.r11, v.r12, v.r22,
              coalesce(zy.z1y, 0.0) - {_amb('v.s1', 'v.s1x', 'pm.sy', 'pm.sxy').replace('c.', 'v.')} AS r1y,
              coalesce(zy.z2y, 0.0) - {_amb('v.s2', 'v.s2x', 'pm.sy', 'pm.sxy').replace('c.', 'v.')} AS r2y,
              pm.syy - {_amb('pm.sy', 'pm.sxy', 'pm.sy', 'pm.sxy').replace('c.', 'v.')} AS rss0
       FROM rv v JOIN pm ON v.cohort = pm.cohort
       LEFT JOIN zy ON zy.cohort = v.cohort AND zy.variant = v.variant AND zy.phenotype = pm.phenotype),
ri AS (SELECT *, r11 * r22 - r12 * r12 AS dr FROM rp
       WHERE r11 > 0 AND r22 > 0 AND r11 * r22 - r12 * r12 > 1e-12 * r11 * r22 AND n - 4 > 0),
rb AS (SELECT *, (r22 * r1y - r12 * r2y) / dr AS bi, (r11 * r2y - r12 * r1y) / dr AS bg FROM ri),
rs AS (SELECT *, abs(rss0 - bi * r1y - bg * r2y) / (n - 4) AS s2 FROM rb)"""


@query("interaction_association", with_all(_BASE, MOMENTS_CTES, _INTER_SQL)
       + f"""SELECT cohort, variant, phenotype, {R('bg')} AS beta, {R('sqrt(s2 * r11 / dr)')} AS standard_error,
       {R('bi')} AS beta_interaction, {R('sqrt(s2 * r22 / dr)')} AS se_interaction, {R('n')} AS sample_size FROM rs""")
def interaction_association(spark, sf_dir):
    """Per-cohort model y ~ 1 + x + g·x + g: genotype and genotype × covariate effects."""
    from ..operators.interaction import interaction_effects
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return interaction_effects(smp, geno, phen, N_COV, factor=0)


# Study intercepts: with one intercept per cohort the pooled model reduces (Frisch–Waugh–Lovell) to
# a regression on within-cohort centred sums, which the oracle computes in closed form.
_INTERCEPT_SQL = """cw AS (SELECT cohort, n, sx, sxx - sx * sx / n AS cxx FROM cm),
tot AS (SELECT sum(n) AS n, count(*) AS k, sum(cxx) AS sxx FROM cw),
vw AS (SELECT vm.variant, sum(vm.sgg - vm.sg * vm.sg / cw.n) AS sgg, sum(vm.sgx - vm.sg * cw.sx / cw.n) AS sgx,
              sum(vm.sg) AS sg FROM vm JOIN cw ON vm.cohort = cw.cohort GROUP BY vm.variant),
pw AS (SELECT pm.phenotype, sum(pm.syy - pm.sy * pm.sy / cw.n) AS syy, sum(pm.sxy - pm.sy * cw.sx / cw.n) AS sxy
       FROM pm JOIN cw ON pm.cohort = cw.cohort GROUP BY pm.phenotype),
gw AS (SELECT vm.variant, pm.phenotype, sum(coalesce(gy.sgy, 0.0) - vm.sg * pm.sy / cw.n) AS sgy
       FROM vm JOIN pm ON vm.cohort = pm.cohort JOIN cw ON cw.cohort = vm.cohort
       LEFT JOIN gy ON gy.cohort = vm.cohort AND gy.variant = vm.variant AND gy.phenotype = pm.phenotype
       GROUP BY vm.variant, pm.phenotype),
fw AS (SELECT vw.variant, pw.phenotype, tot.n, tot.k, tot.sxx, vw.sgg, vw.sgx, vw.sg, pw.syy, pw.sxy, gw.sgy,
              tot.sxx * vw.sgg - vw.sgx * vw.sgx AS det
       FROM gw JOIN vw ON gw.variant = vw.variant JOIN pw ON gw.phenotype = pw.phenotype, tot),
fe AS (SELECT *, (sxx * sgy - sgx * sxy) / det AS beta, (sgg * sxy - sgx * sgy) / det AS bx FROM fw
       WHERE det > 1e-12 * sxx * sgg AND n - k - 2 > 0),
fse AS (SELECT *, sqrt(abs(syy - bx * sxy - beta * sgy) / (n - k - 2) * sxx / det) AS se FROM fe)"""


@query("mega_study_intercepts", with_all(_BASE, MOMENTS_CTES, _INTERCEPT_SQL)
       + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('beta / se')} AS t_stat,
       {R('n')} AS sample_size, {R('sg / (2.0 * n)')} AS maf FROM fse""")
def mega_study_intercepts(spark, sf_dir):
    """Pooled regression over all cohorts with an intercept for each, from their partial derivatives: the cohort rows of the
    arrowhead system are eliminated cohort by cohort in the tiles; raw rows are read once, for the sums."""
    from ..operators.blocks import associate_shared
    from ..operators.moments import partial_derivatives
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    pd_ = partial_derivatives(smp, geno, phen, N_COV)
    eff = associate_shared({k: v for k, v in pd_.items() if k != "p"}, output="mega", intercepts=True)
    return eff.select("variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size", "maf")


# ---------------------------------------------------------------- checks

@query("pd_consistency", with_all(_BASE, MOMENTS_CTES)
       + f"""SELECT cm.cohort, cm.n, {R('cm.sx / cm.n')} AS mean_x, {R('a.mean_af')} AS mean_af, {R('p.mean_y')} AS mean_phenotype
       FROM cm LEFT JOIN (SELECT vm.cohort, avg(vm.sg / (2.0 * c2.n)) AS mean_af FROM vm JOIN cm c2 ON vm.cohort = c2.cohort
                          GROUP BY vm.cohort) a ON cm.cohort = a.cohort
       LEFT JOIN (SELECT pm.cohort, avg(pm.sy / c3.n) AS mean_y FROM pm JOIN cm c3 ON pm.cohort = c3.cohort
                  GROUP BY pm.cohort) p ON cm.cohort = p.cohort""")
def pd_consistency(spark, sf_dir):
    """Per-cohort PD summary (covariate mean, mean allele frequency, mean phenotype) to compare cohorts."""
    from ..operators.checks import pd_consistency as _c
    from ..operators.moments import partial_derivatives
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    c = _c(partial_derivatives(smp, geno, phen, N_COV, with_b4=False))
    return c.select("cohort", "n", F.col("cov_means")[1].alias("mean_x"), "mean_af", "mean_phenotype")


_ONES_SQL = "geno1 AS (SELECT * FROM geno UNION ALL SELECT cohort, sample_id, x, 'vone' AS variant, 1.0 AS g FROM samples)"


@query("singular_designs", with_all(fixture_ctes(level="nation"), _ONES_SQL, _moments_filtered(geno="geno1"),
                                    EFFECT_CTES.split(",\npt AS")[0])
       + "SELECT cohort, variant, n - 3 AS df FROM vt WHERE NOT (s > 1e-12 * sgg) OR n - 3 <= 0")
def singular_designs(spark, sf_dir):
    """Diagnostics: (cohort, variant) designs dropped as singular in the 25 nation cohorts, each with a variant that everyone carries."""
    from ..operators.checks import singular_variants
    from ..operators.moments import partial_derivatives
    from ..operators.regression import invert_cov, variant_terms
    smp, geno, phen = fx.cohort_data(spark, sf_dir, level="nation")
    geno = geno.unionByName(smp.select("cohort", "sample_id", F.lit("vone").alias("variant"), F.lit(1.0).alias("dosage"), "x"))
    pd_ = partial_derivatives(smp, geno, phen, N_COV, with_b4=False)
    vt = variant_terms(pd_["pd_test"], invert_cov(pd_["pd_cov"]), keep_singular=True)
    return singular_variants(vt).select("cohort", "variant", "df")


# ---------------------------------------------------------------- covariate selection, PD store, harmonised meta

_COVSEL_SAMPLES = """samples AS (
  SELECT r.r_name AS cohort, c.c_custkey AS sample_id,
         CASE WHEN length(r.r_name) % 2 = 0 THEN c.c_acctbal / 1000.0 ELSE CAST(c.c_nationkey AS DOUBLE) / 10.0 END AS x
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("meta_covariate_selection",
       with_all(",\n".join([_COVSEL_SAMPLES, fixture_ctes().split("),\ncalls AS (", 1)[1].join(["calls AS (", ""])]),
                MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT)
def meta_covariate_selection(spark, sf_dir):
    """Two covariates (balance, nation); a covariate index per cohort keeps the intercept plus
    covariate 1 (even-length cohort names) or covariate 2 (odd): projection of the PD tables."""
    smp = fx.samples(spark, sf_dir, two_covariates=True)
    geno, phen = fx.reused(fx.genotype(spark, sf_dir, smp=smp), fx.phenotype(spark, sf_dir, smp=smp))
    r = fx.table(spark, sf_dir, "region").select(F.col("r_name").alias("cohort"))
    cov_index = r.select("cohort", F.when(F.length("cohort") % 2 == 0, F.lit(1)).otherwise(F.lit(2)).alias("idx"))
    return jobs.meta_analyse(smp, geno, phen, 2, cov_index=cov_index)


@query("harmonise_examples", _HARM + """SELECT cohort, variant_idx, id, allele1, allele2 FROM (
  SELECT p.*, row_number() OVER (PARTITION BY p.cohort ORDER BY p.variant_idx) AS rn FROM probes p
  WHERE NOT EXISTS (SELECT 1 FROM vmap v WHERE v.cohort = p.cohort AND v.variant_idx = p.variant_idx)) WHERE rn <= 10""")
def harmonise_examples(spark, sf_dir):
    """The first 10 unmatched probes of each cohort (the mismatch examples report).

    rank ≤ 10 over a cohort window is planned as a group limit: every map task keeps at most 10
    rows per cohort before the shuffle, so a large cohort never lands whole in one task."""
    from pyspark.sql.window import Window
    from ..operators.harmonise import unmatched
    probes, _, vmap = _harm(spark, sf_dir)
    u = unmatched(probes, vmap)
    w = Window.partitionBy("cohort").orderBy("variant_idx")
    return (u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 10)
            .select("cohort", "variant_idx", "id", "allele1", "allele2"))


@query("meta_from_pd_shards", with_all(_BASE, MOMENTS_CTES, EFFECT_CTES, META_CTES) + META_SELECT)
def meta_from_pd_shards(spark, sf_dir):
    """PD computed separately on two sample shards (even / odd customer keys), written to the PD
    store, read back with its schema check, merged by re-summing, then meta-analysed."""
    import uuid
    from ..operators.meta import drop_empty, inverse_variance
    from ..operators.moments import partial_derivatives
    from ..operators.regression import associate_pd
    from ..session import shared_path
    from ..sources.pd_store import merge_pd_shards, read_pd, write_pd
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    shards = []
    for part in (0, 1):
        keep = (F.col("sample_id") % 2) == part
        path = shared_path(spark, "pd", f"shard{part}_{uuid.uuid4().hex}")
        write_pd(partial_derivatives(smp.where(keep), geno.where(keep), phen.where(keep), N_COV), path)
        shards.append(read_pd(spark, path))
    return drop_empty(inverse_variance(associate_pd(merge_pd_shards(shards))))


_HM_SQL = """pcalls AS (SELECT o.o_custkey AS sample_id, l.l_partkey AS pk, count(*) AS cnt
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
geno AS (SELECT s.cohort, s.sample_id, s.x, v.ref_id AS variant, CAST(least(2, pc.cnt) AS DOUBLE) AS g
         FROM pcalls pc JOIN samples s ON pc.sample_id = s.sample_id
         JOIN vmap v ON v.cohort = s.cohort AND v.variant_idx = pc.pk)"""
# swapped alleles: with an intercept, y ~ ... + (2 − g) has coefficient −β and the same SE
_HM_FLIP = """effl AS (SELECT e.* REPLACE (e.beta * v.flip AS beta) FROM eff e
         JOIN vmap v ON v.cohort = e.cohort AND v.ref_id = e.variant)"""
_HM_META = META_CTES.replace("FROM eff WHERE se > 0", "FROM effl WHERE se > 0")


@query("meta_harmonised", with_all(samples_cte(), PHENO_CTE, _HARM_SQL, _HM_SQL, MOMENTS_CTES, EFFECT_CTES, _HM_FLIP,
                                   _HM_META) + META_SELECT)
def meta_harmonised(spark, sf_dir):
    """Part-level genotypes mapped to reference ids through the harmonisation map, per-cohort
    effects oriented to the reference allele (swapped alleles flip β), then meta-analysed."""
    from ..operators.align import apply_variant_map
    from ..operators.harmonise import harmonise
    from ..operators.meta import drop_empty, inverse_variance
    from ..operators.moments import partial_derivatives
    from ..operators.regression import associate_pd, flip_effects
    smp = fx.samples(spark, sf_dir)
    raw = fx.genotype(spark, sf_dir, n_variants=None, smp=smp)
    raw = raw.withColumn("variant_idx", F.substring("variant", 2, 20).cast("long")).drop("variant")
    vmap = harmonise(fx.cohort_probes(spark, sf_dir), fx.reference_panel(spark, sf_dir))
    mapped, phen = fx.reused(apply_variant_map(raw, vmap), fx.phenotype(spark, sf_dir, smp=smp))
    mapped = mapped.drop("variant_idx").withColumnRenamed("flip", "orientation")
    return drop_empty(inverse_variance(flip_effects(associate_pd(partial_derivatives(smp, mapped, phen, N_COV, by_variant=True)))))



# ---------------------------------------------------------------- pooled MAF filter, permuted genotype set

MEGA_MAF_T = 0.3
_MEGA_MAF_CTES = _MEGA_CTES.replace(
    "GROUP BY variant HAVING count(*) = (SELECT count(*) FROM cm)),\npmp",
    "GROUP BY variant HAVING count(*) = (SELECT count(*) FROM cm)\n"
    f"        AND sum(sg) / (2.0 * (SELECT sum(n) FROM cm)) > {MEGA_MAF_T}"
    f" AND sum(sg) / (2.0 * (SELECT sum(n) FROM cm)) < 1 - {MEGA_MAF_T}"
    " AND sum(sg) / (2.0 * (SELECT sum(n) FROM cm)) <> 0.5),\npmp")


@query("mega_maf_filtered", with_all(_BASE, MOMENTS_CTES, _MEGA_MAF_CTES, effect_ctes("cmp", "vmp", "pmp", "gyp"))
       + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('beta / se')} AS t_stat,
       {R('n')} AS sample_size, {R('maf')} AS maf FROM eff""")
def mega_maf_filtered(spark, sf_dir):
    """Mega-analysis keeping variants whose pooled MAF lies strictly inside (0.3, 0.7), ≠ 0.5."""
    smp, geno, phen = fx.cohort_data(spark, sf_dir)
    return jobs.mega_analyse(smp, geno, phen, N_COV, maf=MEGA_MAF_T)


_PGS_SQL = """pc AS (SELECT o.o_custkey AS sample_id, l.l_partkey AS variant_idx, CAST(least(2, count(*)) AS DOUBLE) AS dosage
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
pg AS (SELECT s.cohort, s.sample_id, pc.variant_idx, pc.dosage FROM pc JOIN samples s ON pc.sample_id = s.sample_id),
permuted AS (SELECT pg.cohort, perm.sample_id, pg.variant_idx, pg.dosage FROM pg
             JOIN perm ON pg.cohort = perm.cohort AND pg.sample_id = perm.source_id)"""


@query("permuted_genotype_set", with_all(_BASE, _PERM_SQL, _HARM_SQL, _PGS_SQL)
       + f"""SELECT p.cohort, p.sample_id, p.variant_idx, {R('p.dosage')} AS dosage, pr.id, pr.allele1, pr.allele2
       FROM permuted p JOIN probes pr ON p.cohort = pr.cohort AND p.variant_idx = pr.variant_idx""")
def permuted_genotype_set(spark, sf_dir):
    """Genotypes of a sample-permuted set (seeded, within cohort) carrying the empirical probes."""
    from ..operators.permute import permute_samples
    smp = fx.samples(spark, sf_dir)
    geno = fx.genotype(spark, sf_dir, n_variants=None, smp=smp)
    geno = geno.select("cohort", F.col("sample_id").alias("source_id"),
                       F.substring("variant", 2, 20).cast("long").alias("variant_idx"), "dosage")
    perm = permute_samples(smp, _SEED)
    permuted = geno.join(perm, ["cohort", "source_id"]).drop("source_id")
    probes = fx.cohort_probes(spark, sf_dir).select("cohort", "variant_idx", "id", "allele1", "allele2")
    return jobs.permuted_genotype_set(permuted, probes).select(
        "cohort", "sample_id", "variant_idx", "dosage", "id", "allele1", "allele2")


@query("partial_derivatives_dense", with_all(embed_ctes(split=True))
       + f"""SELECT cohort, variant, {R('sg')} AS a_0, {R('sgg')} AS gg, {R('sg / (2.0 * n)')} AS maf FROM eg""")
def partial_derivatives_dense(spark, sf_dir):
    """Site-side A_test of dense cohorts (the two embedding halves): X̃ᵀg, gᵀg and MAF per variant,
    one GEMM per variant block and cohort."""
    from ..operators.blocks import dense_partial_derivatives
    geno, phen = fx.embedding_rows(spark, sf_dir, split=True)
    t = dense_partial_derivatives(geno, phen, with_b4=False)["pd_test"]
    return t.select("cohort", "variant", F.col("a")[0].alias("a_0"), "gg", "maf")


@query("dense_meta_encoded", with_all(embed_ctes(split=True), META_CTES) + META_SELECT, pairs=True)
def dense_meta_encoded(spark, sf_dir):
    """Federated flow on the two dense embedding cohorts: each site computes its partial
    derivatives from raw rows; the centre gets gᵀy only from privacy-encoded G·F and F⁻¹·Y, multiplied, solved
    and pooled in the tiles (equals dense_meta up to the key's conditioning)."""
    from ..operators.blocks import dense_partial_derivatives
    geno, phen = fx.embedding_rows(spark, sf_dir, split=True)
    pd_ = dense_partial_derivatives(geno, phen, with_b4=False)
    enc = jobs.encode_site(None, geno, phen, seed=_KEY_SEED)
    return jobs.meta_analyse_shared(pd_, enc["genotype"], enc["phenotype"])


# ---------------------------------------------------------------- dense cohorts with calls, covariates and filters

def _by_cohort(a: str, b: str) -> str:
    return f"CASE WHEN cohort = 'A' THEN {a} ELSE {b} END"


_CALL_T, _CALL_MAF = 0.5, 0.2
_CALL_V = f"({_by_cohort('vec_id % 3 <> 0', 'vec_id % 4 <> 0')}) AND vec_id % 10 <> 7"
_CALL_P = f"({_by_cohort('vec_id % 5 <> 1', 'vec_id % 6 <> 2')}) AND vec_id % 11 <> 3"
_CALL_X = _by_cohort(call_covariate("s * s % 7"), call_covariate("s * 5 % 11"))
_CALL_SQL = with_all(call_ctes(_CALL_V, _CALL_P, _CALL_MAF, 2), call_moments(_CALL_X), EFFECT_CTES, META_CTES) + META_SELECT


def _call_lists(geno, phen):
    """Per-cohort include lists and all-cohort exclude lists of the dense fixture."""
    def rows(df, key, a, b):
        k = F.col(key).cast("long")
        return df.select("cohort", key).where(F.when(F.col("cohort") == "A", k % a[0] != a[1]).otherwise(k % b[0] != b[1]))
    def out(df, key, m, r):
        return df.select(key).distinct().where(F.col(key).cast("long") % m == r)
    return {"variant_include": rows(geno, "variant", (3, 0), (4, 0)), "variant_exclude": out(geno, "variant", 10, 7),
            "phenotype_include": rows(phen, "phenotype", (5, 1), (6, 2)), "phenotype_exclude": out(phen, "phenotype", 11, 3)}


@query("dense_meta_filtered", _CALL_SQL + f" WHERE abs(beta / standard_error) > {_CALL_T}", pairs=True)
def dense_meta_filtered(spark, sf_dir):
    """Dense cohorts with missing calls and three covariates: include and exclude lists per cohort and for all, MAF window,
    imputation, names that every cohort has, a covariate chosen by cohort, singular designs and the t-threshold."""
    geno, phen, cov = fx.dense_calls(spark, sf_dir)
    index = spark.createDataFrame([("A", 1), ("B", 2)], "cohort string, idx int")
    return jobs.meta_analyse_dense(geno, phen, cov, maf=_CALL_MAF, availability="all", cov_index=index, t_thr=_CALL_T,
                                   **_call_lists(geno, phen))


@query("dense_meta_shared_filtered", _CALL_SQL, pairs=True)
def dense_meta_shared_filtered(spark, sf_dir):
    """The same filters on shared partial derivatives and encoded rows (the centre never sees a dosage)."""
    from ..functions.columns import impute_mean_array
    from ..operators.blocks import dense_partial_derivatives
    geno, phen, cov = fx.dense_calls(spark, sf_dir)
    geno = geno.withColumn("dosage", impute_mean_array("dosage"))
    pd_ = dense_partial_derivatives(geno, phen, cov, with_b4=False)
    enc = jobs.encode_site(None, geno, phen, seed=_KEY_SEED)
    index = spark.createDataFrame([("A", 1), ("B", 2)], "cohort string, idx int")
    return jobs.meta_analyse_shared(pd_, enc["genotype"], enc["phenotype"], maf=_CALL_MAF, availability="all", cov_index=index,
                                    **_call_lists(pd_["pd_test"], pd_["pd_pheno"]))


def _write_sites(spark, sf_dir, base):
    """Two sites as they would deliver: A encoded, B raw with its expression as a text matrix in another order of the samples."""
    from ..functions.columns import impute_mean_array
    from ..operators.blocks import dense_partial_derivatives
    from . import federated
    geno, phen, cov = fx.dense_calls(spark, sf_dir)
    ids = spark.range(32).select(F.col("id").alias("sample_pos"), F.concat(F.lit("s"), "id").alias("sample_id"))
    lists = _call_lists(geno, phen)
    rows = []
    for cohort in ("A", "B"):
        here = F.col("cohort") == cohort
        g = geno.where(here).withColumn("dosage", impute_mean_array("dosage"))
        p, at = phen.where(here), {k: f"{base}/{cohort}/{k}" for k in ("genotype", "expression", "pd", "snps.csv", "genes.csv")}
        federated.write_partial_derivatives(dense_partial_derivatives(g, p, cov.where(here), with_b4=False), ids, at["pd"])
        if cohort == "A":
            enc = jobs.encode_site(None, g, p, seed=_KEY_SEED)
            federated.write_genotype(enc["genotype"], ids, at["genotype"])
            federated.write_expression(enc["phenotype"], ids, at["expression"])
        else:
            turned = ids.select((31 - F.col("sample_pos")).alias("sample_pos"), "sample_id")
            federated.write_genotype(geno.where(here).withColumn("dosage", F.reverse("dosage")), turned, at["genotype"])
            at["expression"] += ".tsv"
            _write_matrix(p, at["expression"])
        lists["variant_include"].where(here & (F.col("variant").cast("long") % 10 != 7)).select(
            F.col("variant").alias("ID")).write.option("header", True).csv(at["snps.csv"])
        lists["phenotype_include"].where(here & (F.col("phenotype").cast("long") % 11 != 3)).select(
            F.col("phenotype").alias("ID")).write.option("header", True).csv(at["genes.csv"])
        rows.append((cohort, at["genotype"], at["expression"], at["pd"], int(cohort == "A"), at["snps.csv"], at["genes.csv"]))
    master = spark.createDataFrame(rows, "cohort string, genotype string, expression string, partial_derivatives string, encoded int, "
                                         "snp_inclusion string, gene_inclusion string")
    master.coalesce(1).write.option("sep", "\t").option("header", True).csv(f"{base}/master.tsv")
    index = spark.createDataFrame([("A\t1",), ("B\t2",)], "value string")
    index.coalesce(1).write.text(f"{base}/covariates.tsv")
    return f"{base}/master.tsv", f"{base}/covariates.tsv"


def _write_matrix(phenotype, path):
    """Samples × phenotypes as text: header, then a line per sample, the last sample first."""
    cells = phenotype.select("phenotype", F.posexplode("values").alias("at", "v"))
    lines = cells.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("phenotype", F.col("v").cast("string").alias("v")))).alias("r"))
    body = lines.select((-F.col("at").cast("long")).alias("o"), F.concat_ws(
        "\t", F.concat(F.lit("s"), F.col("at")), F.transform("r", lambda e: e["v"])).alias("value"))
    head = phenotype.agg(F.array_sort(F.collect_list("phenotype")).alias("n")).select(
        F.lit(-1000).cast("long").alias("o"), F.concat_ws("\t", F.lit("id"), "n").alias("value"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("o").select("value").write.text(path)


@query("federated_meta", _CALL_SQL, pairs=True)
def federated_meta(spark, sf_dir):
    """Master table to result: two sites (one encoded, one raw, with another order of samples) written to the shared folder, then
    analysed from the master table, the inclusion lists and the covariate index."""
    import uuid
    from ..session import shared_path
    from . import federated
    master, index = _write_sites(spark, sf_dir, shared_path(spark, f"sites-{uuid.uuid4().hex}"))
    return federated.federated_meta(spark, master, covariate_index=index, maf=_CALL_MAF, availability="all")


# Interactions by orthogonalised columns: with 1, c1, c2, g·c1, g·c2, g made orthogonal one after another, the last one's coefficient
# is its product with y over its square, and what y has left after all of them is the residual.
def _orthogonal(order: list[str]) -> str:
    """SQL of the CTEs o_<last>_<k>: lists, each orthogonal to those before it, for eg rows with columns c1, c2, z1, z2, g."""
    ctes, have = [], []
    source = "ez"
    for k, name in enumerate(order):
        minus = "".join(f" - list_dot_product({name}, q{h}) / list_dot_product(q{h}, q{h}) * q{h}[i]" for h in have)
        ctes.append(f"o_{order[-1]}_{k} AS (SELECT *, list_transform(range(1, len({name}) + 1), lambda i: {name}[i]{minus}) AS q{k} FROM {source})")
        source, have = f"o_{order[-1]}_{k}", [*have, k]
    return ",\n".join(ctes)


def _last_effect(order: list[str]) -> str:
    left = "".join(f" - pow(list_dot_product(q{k}, y), 2) / list_dot_product(q{k}, q{k})" for k in range(6))
    return f"""e_{order[-1]} AS (SELECT cohort, variant, phenotype, list_dot_product(q5, y) / list_dot_product(q5, q5) AS b,
       sqrt(abs(list_dot_product(y, y){left}) / 26 / list_dot_product(q5, q5)) AS se
       FROM (SELECT o.*, ep.phenotype, ep.y FROM o_{order[-1]}_5 o JOIN ep ON o.cohort = ep.cohort
             WHERE list_dot_product(q5, q5) > 1e-12 * list_dot_product({order[-1]}, {order[-1]})))"""


_ORDERS = [["one", "c1", "c2", *[z for z in ("z1", "z2", "g") if z != last], last] for last in ("g", "z1", "z2")]


@query("dense_interactions", with_all(call_ctes(maf=_CALL_MAF),
       f"""ez AS (SELECT *, list_transform(range(1, 33), lambda i: g[i] * c1[i]) AS z1, list_transform(range(1, 33), lambda i: g[i] * c2[i]) AS z2
       FROM (SELECT eg.*, {call_covariate('1')} AS one, {call_covariate('s * s % 7')} AS c1, {call_covariate('s * 5 % 11')} AS c2 FROM eg))""",
       *[_orthogonal(o) for o in _ORDERS], *[_last_effect(o) for o in _ORDERS])
       + f"""SELECT g.cohort, g.variant, g.phenotype, {R('g.b')} AS beta, {R('g.se')} AS standard_error, {R('z1.b')} AS beta_c1, {R('z1.se')} AS se_c1,
       {R('z2.b')} AS beta_c2, {R('z2.se')} AS se_c2 FROM e_g g JOIN e_z1 z1 ON g.cohort = z1.cohort AND g.variant = z1.variant AND g.phenotype = z1.phenotype
       JOIN e_z2 z2 ON g.cohort = z2.cohort AND g.variant = z2.variant AND g.phenotype = z2.phenotype""", pairs=True)
def dense_interactions(spark, sf_dir):
    """Dense model y ~ 1 + c1 + c2 + g·c1 + g·c2 + g per cohort: three variable terms, 3 × 3 Schur complements in stacks."""
    geno, phen, cov = fx.dense_calls(spark, sf_dir)
    out = jobs.cohort_effects_dense(geno, phen, cov.where("covariate != 'c3'"), factors=("c1", "c2"), maf=_CALL_MAF, columns=(
        "cohort", "variant", "phenotype", "beta", "standard_error", "betas_interaction", "ses_interaction"))
    b, se = F.col("betas_interaction"), F.col("ses_interaction")
    return out.select("cohort", "variant", "phenotype", "beta", "standard_error", b[0].alias("beta_c1"), se[0].alias("se_c1"),
                      b[1].alias("beta_c2"), se[1].alias("se_c2"))


@query("dense_mega_intercepts", with_all(
    call_ctes(maf=_CALL_MAF, cohorts=2), call_moments(call_covariate("s * s % 7")), _INTERCEPT_SQL)
    + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('beta / se')} AS t_stat,
       {R('n')} AS sample_size, {R('sg / (2.0 * n)')} AS maf FROM fse""", pairs=True)
def dense_mega_intercepts(spark, sf_dir):
    """One regression over dense cohorts with an intercept for each, from summed statistics in the tiles."""
    from ..operators.blocks import dense_mega
    geno, phen, cov = fx.dense_calls(spark, sf_dir)
    geno, phen = jobs._dense_inputs(geno, phen, maf=_CALL_MAF)
    return dense_mega(geno, phen, cov.where("covariate = 'c1'"), intercepts=True,
                      columns=("variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size", "maf"))


@query("encode_full_key", with_all(embed_ctes(split=True))
       + f"SELECT eg.cohort, eg.variant, ep.phenotype, {R('round(list_dot_product(eg.g, ep.y), 6)')} AS gy FROM eg JOIN ep ON eg.cohort = ep.cohort", pairs=True)
def encode_full_key(spark, sf_dir):
    """gᵀy from rows encoded with a full key: every sample mixed with every other, the key inverted block by block on executors;
    to six decimals, as sums that cancel keep the rounding of the much larger encoded values (about 1e-13)."""
    from ..functions.columns import rounded_half_up
    from ..operators.blocks import dot_products
    from ..operators.encode import encode_dense
    geno, phen = fx.embedding_rows(spark, sf_dir, split=True)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(31).cast("long")))
    key = geno.select("cohort").distinct().select("cohort", every.alias("i")).select("cohort", "i", every.alias("j"))
    key = key.withColumn("f", (F.pmod(F.xxhash64("cohort", "i", "j", F.lit(_KEY_SEED)), F.lit(9)) + 1).cast("double"))
    enc = encode_dense(geno, phen, seed=_KEY_SEED, key=key, key_block=16)
    d = dot_products(enc["genotype"].withColumnRenamed("dosage", "vec"), enc["phenotype"].withColumnRenamed("values", "vec"))
    return d.select("cohort", "variant", "phenotype", rounded_half_up("dot", 6).alias("gy"))


_MEGA_MISS = """pairs AS (SELECT vm.variant, pm.phenotype, sum(cm.n) AS n, sum(cm.sx) AS sx, sum(cm.sxx) AS sxx,
                 sum(vm.sg) AS sg, sum(vm.sgg) AS sgg, sum(vm.sgx) AS sgx, sum(pm.sy) AS sy, sum(pm.syy) AS syy,
                 sum(pm.sxy) AS sxy, sum(coalesce(gy.sgy, 0.0)) AS sgy
          FROM vm JOIN pm ON vm.cohort = pm.cohort JOIN cm ON cm.cohort = vm.cohort
          LEFT JOIN gy ON gy.cohort = vm.cohort AND gy.variant = vm.variant AND gy.phenotype = pm.phenotype
          GROUP BY vm.variant, pm.phenotype),
cmq AS (SELECT variant || '|' || phenotype AS cohort, n, sx, sxx FROM pairs),
vmq AS (SELECT variant || '|' || phenotype AS cohort, variant, sg, sgg, sgx FROM pairs),
pmq AS (SELECT variant || '|' || phenotype AS cohort, phenotype, sy, syy, sxy FROM pairs),
gyq AS (SELECT variant || '|' || phenotype AS cohort, variant, phenotype, sgy FROM pairs)"""


@query("mega_missingness", with_all(fixture_ctes(n_variants=None), MOMENTS_CTES, _MEGA_MISS,
                                    effect_ctes("cmq", "vmq", "pmq", "gyq"))
       + f"""SELECT variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('beta / se')} AS t_stat,
       {R('n')} AS sample_size FROM eff""")
def mega_missingness(spark, sf_dir):
    """Mega-analysis with missing variants (one variant per part; parts missing from some cohorts):
    each variant × phenotype pools exactly the cohorts that have both, A_cov included."""
    from ..operators.meta import pairwise_effects
    from ..operators.moments import partial_derivatives
    smp, geno, phen = fx.cohort_data(spark, sf_dir, n_variants=None)
    eff = pairwise_effects(partial_derivatives(smp, geno, phen, N_COV, by_variant=True))
    return eff.select("variant", "phenotype", "beta", "standard_error", "t_stat", "sample_size")


# ---------------------------------------------------------------- files read back

_CALLS_SQL = "SELECT cohort, CAST(vec_id AS VARCHAR) AS variant, unnest(range(0, len(c))) AS sample, unnest(c) AS dosage FROM ec"
_IDS = [f"s{i}" for i in range(32)]


def _numbered_calls(spark, sf_dir):
    """(cohort, variant_idx, variant, dosage): the calls of the dense fixture, variants numbered by cohort in id order."""
    from ..operators.ranks import row_index
    geno, _, _ = fx.dense_calls(spark, sf_dir)
    order = geno.select(F.col("variant").cast("long").alias("v")).distinct()
    index = row_index(order.orderBy("v"), "variant_idx")            # numbered over ranges, not in one window
    return geno.join(index, geno["variant"].cast("long") == index["v"]).select("cohort", "variant_idx", "variant", "dosage")


def _cells(rows):
    return rows.select("cohort", "variant", F.posexplode("dosage").alias("sample", "dosage")).withColumn("sample", F.col("sample").cast("long"))


def _text_file(df, order, path):
    """The column ``value`` as the lines of one text file, in order; only the ready lines meet in the task that writes them."""
    df.select(order, "value").repartition(1).sortWithinPartitions(order).select("value").write.text(path)


@query("plink_roundtrip", with_all(call_ctes()) + f"SELECT cohort, variant, sample, {R('dosage')} AS dosage FROM ({_CALLS_SQL})")
def plink_roundtrip(spark, sf_dir):
    """Calls written as PLINK files (BED by cohort, FAM, BIM) to the shared folder, ingested again and put back under their ids."""
    import uuid
    from ..session import shared_path
    from ..sources.bed import write_bed
    from .ingest import ingest_plink
    base = shared_path(spark, f"plink-{uuid.uuid4().hex}")
    rows = _numbered_calls(spark, sf_dir)
    cohorts = sorted(r.cohort for r in write_bed(rows, base).select("cohort").collect())
    out = None
    for c in cohorts:
        fam = spark.range(32).select("id", F.format_string("f%d s%d 0 0 1 -9", "id", "id").alias("value"))
        bim = rows.where(F.col("cohort") == c).select("variant_idx", F.concat_ws(
            "\t", F.lit("1"), "variant", F.lit("0"), F.col("variant_idx").cast("string"), F.lit("A"), F.lit("G")).alias("value"))
        _text_file(fam, "id", f"{base}/{c}.fam")
        _text_file(bim, "variant_idx", f"{base}/{c}.bim")
        t = ingest_plink(spark, f"{base}/{c}", c, variants_per_task=64)
        back = _cells(t["genotype"].join(t["probes"].select("variant_idx", F.col("id").alias("variant")), "variant_idx"))
        out = back if out is None else out.unionByName(back)
    return out


@query("vcf_ingest", with_all(call_ctes()) + f"""SELECT cohort, variant, sample, {R('dosage')} AS dosage, 's' || sample AS sample_id
       FROM ({_CALLS_SQL})""")
def vcf_ingest(spark, sf_dir):
    """Calls written as one VCF per cohort (GT; missing as ./.) and read back: probes, samples and dosages 2 - alternate alleles."""
    import uuid
    from ..session import shared_path
    from .ingest import ingest_vcf
    base = shared_path(spark, f"vcf-{uuid.uuid4().hex}")
    rows = _numbered_calls(spark, sf_dir)
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *_IDS])
    out = None
    for c in ("A", "B"):
        call = (lambda d: F.when(d == 9.0, F.lit("./.")).when(d == 2.0, F.lit("0/0")).when(d == 1.0, F.lit("0|1")).otherwise(F.lit("1/1")))
        body = rows.where(F.col("cohort") == c).select(F.col("variant_idx").alias("o"), F.concat_ws(
            "\t", F.lit("1"), F.col("variant_idx").cast("string"), "variant", F.lit("A"), F.lit("G"), F.lit("."), F.lit("PASS"), F.lit("."),
            F.lit("GT"), F.transform("dosage", call)).alias("value"))
        top = spark.createDataFrame([(-2, "##FORMAT=<ID=GT,Number=1,Type=String>"), (-1, head)], "o long, value string")
        _text_file(body.unionByName(top), "o", f"{base}/{c}.vcf")
        t = ingest_vcf(spark, f"{base}/{c}.vcf", c)
        back = _cells(t["genotype"].join(t["probes"].select("variant_idx", F.col("id").alias("variant")), "variant_idx"))
        back = back.join(t["samples"].select(F.col("sample_pos").alias("sample"), "sample_id"), "sample")
        out = back if out is None else out.unionByName(back)
    return out.select("cohort", "variant", "sample", "dosage", "sample_id")


@query("minimac_transpose", with_all(call_ctes()) + f"""SELECT cohort, variant, sample,
       {R('CASE WHEN dosage = 9 THEN -1 ELSE dosage END')} AS dosage FROM ({_CALLS_SQL})""")
def minimac_transpose(spark, sf_dir):
    """Calls written as Minimac info and dose files (a row per sample; missing as text) and transposed back to variant rows."""
    import uuid
    from ..session import shared_path
    from .ingest import ingest_minimac
    base = shared_path(spark, f"minimac-{uuid.uuid4().hex}")
    rows = _numbered_calls(spark, sf_dir)
    out = None
    for c in ("A", "B"):
        here = rows.where(F.col("cohort") == c)
        info = here.select(F.col("variant_idx").alias("o"), F.concat_ws(" ", "variant", F.lit("A G 0.5 0.5 0.9 0.8")).alias("value"))
        _text_file(info.unionByName(spark.createDataFrame([(-1, "SNP Al1 Al2 Freq1 MAF AvgCall Rsq")], "o long, value string")), "o", f"{base}/{c}.info")
        cells = here.select("variant_idx", F.posexplode("dosage").alias("s", "d"))
        said = F.when(F.col("d") == 9.0, F.lit("NA")).otherwise(F.col("d").cast("string"))
        dose = cells.groupBy("s").agg(F.array_sort(F.collect_list(F.struct("variant_idx", said.alias("v")))).alias("r"))
        dose = dose.select(F.col("s").alias("o"), F.concat_ws(" ", F.format_string("F%d->s%02d", "s", "s"), F.lit("DOSE"),
                                                              F.transform("r", lambda e: e["v"])).alias("value"))
        dose.select("value").write.text(f"{base}/{c}.dose")            # lines carry their sample, so their order is free
        t = ingest_minimac(spark, f"{base}/{c}.info", f"{base}/{c}.dose", c)
        back = _cells(t["genotype"].join(t["probes"].select("variant_idx", F.col("id").alias("variant")), "variant_idx"))
        out = back if out is None else out.unionByName(back)
    return out


# ---------------------------------------------------------------- log, subjects, ids on dense and long rows

@query("dense_cohort_log", with_all(call_ctes(maf=_CALL_MAF), call_moments(call_covariate("s * s % 7")), EFFECT_CTES)
       + f"""SELECT cohort, variant, phenotype, {R('beta')} AS beta, {R('se')} AS standard_error, {R('CAST(n AS DOUBLE)')} AS sample_size
       FROM eff WHERE se > 0 AND CAST(phenotype AS BIGINT) % 7 = 1""", pairs=True)
def dense_cohort_log(spark, sf_dir):
    """Per-cohort log of a gene list on dense rows: the genes are chosen before the tiles, so nothing else is computed."""
    geno, phen, cov = fx.dense_calls(spark, sf_dir)
    genes = phen.select("phenotype").distinct().where(F.col("phenotype").cast("long") % 7 == 1)
    eff = jobs.cohort_effects_dense(geno, phen, cov.where("covariate = 'c1'"), maf=_CALL_MAF, phenotype_include=genes, columns=(
        "cohort", "variant", "phenotype", "beta", "standard_error", "sample_size"))
    return jobs.per_cohort_effects(eff, phenotypes=genes, pairs=jobs.pairs_per_cohort(geno, phen, phenotypes=genes))


_FEWER = "eq AS (SELECT * REPLACE (list_filter(v, lambda x, i: i % 8 <> 3) AS v) FROM ev)"


@query("dense_subject_removal", with_all(embed_ctes(split=True).replace("eg AS (", _FEWER + ",\neg AS (", 1).replace(
    "FROM ev WHERE", "FROM eq WHERE"), META_CTES) + META_SELECT, pairs=True)
def dense_subject_removal(spark, sf_dir):
    """Dense meta-analysis without listed subjects (every eighth sample of each cohort, from the third on)."""
    from ..operators.blocks import dense_associate
    geno, phen = fx.embedding_rows(spark, sf_dir, split=True)
    pos = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(31).cast("long")))
    samples = geno.select("cohort").distinct().select("cohort", pos.alias("sample_pos"))
    samples = samples.withColumn("sample_id", F.concat("cohort", F.col("sample_pos").cast("string")))
    removed = samples.where(F.col("sample_pos") % 8 == 2).select("cohort", "sample_id")
    _, geno, phen = jobs.remove_subjects_dense(samples, removed, (geno, "dosage"), (phen, "values"))
    return dense_associate(geno, phen)


@query("harmonise_by_id", with_all(samples_cte(), _HARM_SQL.split(",\nmt AS")[0],
       """mi AS (SELECT p.cohort, r.ref_idx, r.ref_id, p.variant_idx,
                 CASE WHEN p.allele1 = r.allele1 AND p.allele2 = r.allele2 THEN 1 ELSE -1 END AS flip FROM probes p JOIN ref r ON p.id = r.ref_id
                 AND ((p.allele1 = r.allele1 AND p.allele2 = r.allele2) OR (p.allele1 = r.allele2 AND p.allele2 = r.allele1)))""")
       + """SELECT cohort, ref_idx, ref_id, arg_max(variant_idx, flip * 1e15 + variant_idx) AS variant_idx, max(flip) AS flip
       FROM mi GROUP BY cohort, ref_idx, ref_id""")
def harmonise_by_id(spark, sf_dir):
    """Probe ↔ reference map by variant id and alleles."""
    from ..operators.harmonise import harmonise
    return harmonise(fx.cohort_probes(spark, sf_dir), fx.reference_panel(spark, sf_dir), by="id")
