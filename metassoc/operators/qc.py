"""Cohort QC lists: SNP inclusion, gene inclusion, covariate picking and the per-cohort QC log.

Inputs are DataFrames with the QC file schemas (SNP QC: cohort, ID, MAF, HWE, MACH_R2, CALL, TYPED,
Genotype_Counts; gene QC: cohort, gene, nr_values, nr_unique_values; regulated PCs: cohort,
Phenotype, P-value).  Every step is a filter, an aggregate per cohort (K rows) or a semi/anti join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import natural_sort_key, parse_genotype_counts


@dataclass(frozen=True)
class QCThresholds:
    # Fixed defaults of the QC step.
    maf: float = 0.01
    hwe: float = 1e-6
    mach_r2: float = 0.4
    call: float = 1.0
    mac: float = 10.0
    gene_unique: float = 0.8
    regulated_p: float = 1e-7
    gen_pcs: int = 4
    exp_pcs: int = 20
    drop_regulated_pcs: bool = False


FIXED_MIN_MAF = 0.01          # first, unconditional MAF filter
N_GEN_PCS, N_EXP_PCS = 10, 100  # GenPC1..10 -> indices 1..10, ExpPC1..100 -> 11..110


def genotype_count_text(n0, n1, n2):
    """'AA: n0, AB: n1, BB: n2'."""
    return F.concat(F.lit("AA: "), n0.cast("string"), F.lit(", AB: "), n1.cast("string"),
                    F.lit(", BB: "), n2.cast("string"))


def snp_passing(snpqc: DataFrame, t: QCThresholds = QCThresholds()) -> DataFrame:
    """SNP QC filters (fixed MAF > 0.01, then MAF/HWE/MACH_R2/CALL) with parsed genotype counts."""
    hom1, het, hom2 = parse_genotype_counts(F.col("Genotype_Counts"))
    return (snpqc.where(F.col("MAF") > FIXED_MIN_MAF)
            .where((F.col("MAF") > t.maf) & (F.col("HWE") > t.hwe) & (F.col("MACH_R2") > t.mach_r2)
                   & (F.col("CALL") == t.call))
            .withColumn("hom1", hom1).withColumn("het", het).withColumn("hom2", hom2))


def minor_allele_counts(passing: DataFrame) -> DataFrame:
    """MAC = 2·min(hom1, hom2 over all rows of the ID) + het of each row (one row per input row)."""
    mins = passing.groupBy("cohort", "ID").agg(F.least(F.min("hom1"), F.min("hom2")).alias("_min_hom"))
    return passing.join(mins, ["cohort", "ID"]).withColumn("MAC", 2 * F.col("_min_hom") + F.col("het")).drop("_min_hom")


def snps_to_include(snpqc: DataFrame, t: QCThresholds = QCThresholds()) -> DataFrame:
    """(cohort, ID) rows kept: the ID passes when any of its rows has MAC > threshold."""
    mac = minor_allele_counts(snp_passing(snpqc, t))
    ok = mac.where(F.col("MAC") > t.mac).select("cohort", "ID").distinct()
    return mac.join(ok, ["cohort", "ID"], "left_semi")


def genes_to_include(geneqc: DataFrame, t: QCThresholds = QCThresholds()) -> DataFrame:
    """Genes with nr_unique_values > gene_unique · max(nr_values) of their cohort."""
    mx = geneqc.groupBy("cohort").agg(F.max("nr_values").alias("_max"))
    return (geneqc.join(F.broadcast(mx), "cohort")            # one row per cohort
            .where(F.col("nr_unique_values") > t.gene_unique * F.col("_max")).drop("_max"))


def regulated_pcs(genregpcs: DataFrame, t: QCThresholds = QCThresholds()) -> DataFrame:
    """(cohort, Phenotype, prefix, num) distinct PCs with P-value below the threshold."""
    prefix, num = natural_sort_key(F.col("Phenotype"))
    return (genregpcs.where(F.col("P-value") < t.regulated_p).select("cohort", "Phenotype").distinct()
            .withColumn("prefix", prefix).withColumn("num", num))


def pick_covariates(cohorts: DataFrame, genregpcs: DataFrame | None, t: QCThresholds = QCThresholds()) -> DataFrame:
    """(cohort, covariate, idx): the first ``gen_pcs`` GenPCs and first ``exp_pcs`` ExpPCs,
    optionally without the genetically regulated expression PCs of that cohort.  More than the covariate table has is an error."""
    if not (0 <= t.gen_pcs <= N_GEN_PCS and 0 <= t.exp_pcs <= N_EXP_PCS):
        raise ValueError(f"there are {N_GEN_PCS} GenPCs and {N_EXP_PCS} ExpPCs; {t.gen_pcs} and {t.exp_pcs} were asked for")
    first = lambda n: F.slice(F.sequence(F.lit(1), F.lit(max(n, 1))), 1, n)
    gen = F.transform(first(t.gen_pcs),
                      lambda i: F.struct(F.concat(F.lit("GenPC"), i.cast("string")).alias("covariate"), i.alias("idx")))
    exp = F.transform(first(t.exp_pcs),
                      lambda i: F.struct(F.concat(F.lit("ExpPC"), i.cast("string")).alias("covariate"),
                                         (i + N_GEN_PCS).alias("idx")))
    picked = (cohorts.select("cohort").distinct()
              .select("cohort", F.explode(F.concat(gen, exp)).alias("c"))
              .select("cohort", "c.covariate", "c.idx"))
    if t.drop_regulated_pcs and genregpcs is not None:
        reg = regulated_pcs(genregpcs, t).select("cohort", F.col("Phenotype").alias("covariate"))
        picked = picked.join(reg, ["cohort", "covariate"], "left_anti")
    return picked


def covariate_index_lines(picked: DataFrame) -> DataFrame:
    """One text line per cohort: cohort name, then its covariate indices, tab separated."""
    return (picked.groupBy("cohort").agg(F.array_sort(F.collect_list("idx")).alias("ix"))
            .select("cohort", F.concat_ws("\t", F.col("cohort"), F.array_join(F.col("ix"), "\t")).alias("line")))


def qc_log(snpqc: DataFrame, geneqc: DataFrame, genregpcs: DataFrame, t: QCThresholds = QCThresholds()) -> DataFrame:
    """Per cohort: N, SNPs after MAF > 0.01, SNPs kept, typed SNPs kept, rows with MAC > 10,
    kept SNPs with both homozygote counts > 5, genes before/after, regulated PCs (natural order)."""
    hom1, het, hom2 = parse_genotype_counts(F.col("Genotype_Counts"))
    base = snpqc.groupBy("cohort").agg(
        F.max(hom1 + het + hom2).cast("long").alias("N"),
        F.count(F.when(F.col("MAF") > FIXED_MIN_MAF, 1)).alias("nr_snps"))
    mac = minor_allele_counts(snp_passing(snpqc, t))
    mac10 = mac.groupBy("cohort").agg(F.count(F.when(F.col("MAC") > 10, 1)).alias("snps_mac_gt_10"))
    kept = snps_to_include(snpqc, t).groupBy("cohort").agg(
        F.count(F.lit(1)).alias("filtered_snps"),
        F.count(F.when(F.col("TYPED") == 1, 1)).alias("typed_snps"),
        F.count(F.when((F.col("hom1") > 5) & (F.col("hom2") > 5), 1)).alias("snps_both_hom_gt_5"))
    genes = geneqc.groupBy("cohort").agg(F.count(F.lit(1)).alias("genes_original"))
    gkept = genes_to_include(geneqc, t).groupBy("cohort").agg(F.count(F.lit(1)).alias("genes_filtered"))
    reg = (regulated_pcs(genregpcs, t).groupBy("cohort")
           .agg(F.array_sort(F.collect_list(F.struct("prefix", "num", "Phenotype"))).alias("_r"))
           .select("cohort", F.array_join(F.transform("_r", lambda s: s["Phenotype"]), ", ").alias("regulated_pcs")))
    out = base
    for d in (kept, mac10, genes, gkept, reg):
        out = out.join(d, "cohort", "left")
    counts = ["filtered_snps", "typed_snps", "snps_mac_gt_10", "snps_both_hom_gt_5", "genes_original", "genes_filtered"]
    return out.fillna(0, counts).fillna("", ["regulated_pcs"]).select(
        "cohort", "N", "nr_snps", "filtered_snps", "typed_snps", "snps_mac_gt_10", "snps_both_hom_gt_5",
        "genes_original", "genes_filtered", "regulated_pcs")
