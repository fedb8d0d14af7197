"""Genotype ingest: one cohort's PLINK, VCF or Minimac files -> the common cohort tables

* samples   (cohort, sample_pos, sample_id)
* probes    (cohort, variant_idx, id, chr, bp, allele1, allele2)
* genotype  (cohort, variant_idx, dosage array<double>)   dense rows in sample_pos order

written once as Parquet (genotype partitioned by cohort), after which every analysis reads them
with pruning.  Missing calls keep the code 9 in these tables; ``jobs.meta_analyse_dense`` replaces them
by the variant's mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import row_index
from ..sources import readers as rd


def ingest_plink(spark: SparkSession, prefix: str, cohort: str, variants_per_task: int = 4096) -> dict[str, DataFrame]:
    fam = rd.read_fam(spark, prefix + ".fam")
    bim = rd.read_bim(spark, prefix + ".bim")
    c = F.lit(cohort)
    return {
        "samples": fam.select(c.alias("cohort"), "sample_pos", F.col("individual").alias("sample_id")),
        "probes": bim.select(c.alias("cohort"), "variant_idx", F.col("ID").alias("id"), F.col("CHR").alias("chr"),
                             "bp", "allele1", "allele2"),
        "genotype": rd.read_bed(spark, prefix, variants_per_task).select(c.alias("cohort"), "variant_idx", "dosage"),
    }


def ingest_vcf(spark: SparkSession, path: str, cohort: str) -> dict[str, DataFrame]:
    v = rd.read_vcf(spark, path)
    c = F.lit(cohort)
    probes = v["probes"]
    return {
        "samples": v["samples"].select(c.alias("cohort"), F.col("sample_pos").cast("long"), "sample_id"),
        "probes": probes.select(c.alias("cohort"), "variant_idx", F.col("ID").alias("id"), F.col("CHR").alias("chr"),
                                "bp", "allele1", "allele2"),
        "genotype": v["genotype"].select(c.alias("cohort"), "variant_idx", "dosage"),
    }


def ingest_minimac(spark: SparkSession, info_path: str, dose_path: str, cohort: str) -> dict[str, DataFrame]:
    info = rd.read_minimac_info(spark, info_path)
    lines = rd.read_minimac_lines(spark, dose_path).where(F.size("dosages") > 0)
    samples = row_index(lines.select("sample_id").distinct().orderBy("sample_id"), "sample_pos")
    # samples get their places line by line, not entry by entry
    placed = lines.join(samples, "sample_id").select("sample_pos", "dosages")
    c = F.lit(cohort)
    return {
        "samples": samples.select(c.alias("cohort"), "sample_pos", "sample_id"),
        "probes": info.select(c.alias("cohort"), "variant_idx", F.col("ID").alias("id"),
                              F.lit(None).cast("string").alias("chr"), F.lit(None).cast("long").alias("bp"),
                              "allele1", "allele2"),
        "genotype": rd.to_dense(rd.dose_cells(placed), samples).select(c.alias("cohort"), "variant_idx", "dosage"),
    }


def write_cohort(tables: dict[str, DataFrame], path: str, mode: str = "append") -> None:
    """Persist the ingested tables (genotype partitioned by cohort, so analyses prune cohorts)."""
    tables["samples"].write.mode(mode).partitionBy("cohort").parquet(f"{path}/samples")
    tables["probes"].write.mode(mode).partitionBy("cohort").parquet(f"{path}/probes")
    tables["genotype"].write.mode(mode).partitionBy("cohort").parquet(f"{path}/genotype")


def read_cohorts(spark: SparkSession, path: str, cohorts: list[str] | None = None) -> dict[str, DataFrame]:
    out = {t: spark.read.parquet(f"{path}/{t}") for t in ("samples", "probes", "genotype")}
    if cohorts:
        out = {k: v.where(F.col("cohort").isin(cohorts)) for k, v in out.items()}
    return out
