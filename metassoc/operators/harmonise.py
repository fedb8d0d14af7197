"""Variant harmonisation against a reference panel (allele matching with flips).

probes     (cohort, variant_idx, id, chr, bp, allele1, allele2)   chr/bp may be NULL -> parsed from 'chr:bp' ids
reference  (ref_idx, ref_id, chr, bp, allele1, allele2)

A probe matches a reference row on (chr, bp) with the same allele pair (flip = +1) or the swapped
pair (flip = −1); a straight match wins over a swapped one; other allele pairs are unmatched.
Matching is one equi-join on (chr, bp, least(a1, a2), greatest(a1, a2)) — positions spread the
join evenly, so no key is hot — followed by one aggregate per (cohort, ref_idx).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import chr_bp_from_id, chromosome

MAP_COLUMNS = ["cohort", "ref_idx", "ref_id", "variant_idx", "flip"]


def with_positions(probes: DataFrame) -> DataFrame:
    """Fill chr/bp from ids of the form 'chr:bp[:...]' where they are missing; chr is text without 'chr'."""
    chrom, bp = chr_bp_from_id(F.col("id"))
    if "chr" not in probes.columns:
        return probes.withColumn("chr", chrom).withColumn("bp", bp)
    return (probes.withColumn("chr", F.coalesce(chromosome("chr"), chrom))
            .withColumn("bp", F.coalesce(F.col("bp").cast("long"), bp)))


def _pair(df: DataFrame) -> DataFrame:
    return (df.withColumn("_lo", F.least("allele1", "allele2"))
            .withColumn("_hi", F.greatest("allele1", "allele2")))


def harmonise(probes: DataFrame, reference: DataFrame, by: str = "position") -> DataFrame:
    """variant_map (cohort, ref_idx, ref_id, variant_idx, flip) in long form (absent = no row)."""
    keys = ["chr", "bp"] if by == "position" else ["id"]
    p = _pair(with_positions(probes) if by == "position" else probes).alias("p")
    reference = reference.withColumnRenamed("ref_id", "id") if by == "id" else reference.withColumn("chr", chromosome("chr"))
    r = _pair(reference).alias("r")
    cond = [F.col(f"p.{k}") == F.col(f"r.{k}") for k in keys + ["_lo", "_hi"]]
    j = p.join(r, cond)
    straight = (F.col("p.allele1") == F.col("r.allele1")) & (F.col("p.allele2") == F.col("r.allele2"))
    m = j.select(F.col("p.cohort").alias("cohort"), F.col("r.ref_idx").alias("ref_idx"),
                 F.col("r.id" if by == "id" else "r.ref_id").alias("ref_id"),
                 F.col("p.variant_idx").alias("variant_idx"),
                 F.when(straight, F.lit(1)).otherwise(F.lit(-1)).alias("flip"))
    # straight match wins; among equals the later probe index (last assignment in the reference tool)
    best = F.max_by(F.struct("variant_idx", "flip"), F.struct(F.col("flip"), F.col("variant_idx")))
    return (m.groupBy("cohort", "ref_idx", "ref_id").agg(best.alias("b"))
            .select("cohort", "ref_idx", "ref_id", F.col("b.variant_idx").alias("variant_idx"), F.col("b.flip").alias("flip")))


def unmatched(probes: DataFrame, vmap: DataFrame) -> DataFrame:
    """Probes found neither straight nor swapped in the reference."""
    return probes.join(vmap.select("cohort", "variant_idx").distinct(), ["cohort", "variant_idx"], "left_anti")


def flipped(probes: DataFrame, vmap: DataFrame) -> DataFrame:
    """Probes matched with swapped alleles, with their probe details."""
    f = vmap.where(F.col("flip") == -1).select("cohort", "variant_idx", "ref_id")
    return probes.join(f, ["cohort", "variant_idx"])


def map_counts(probes: DataFrame, reference: DataFrame, vmap: DataFrame) -> DataFrame:
    """Per cohort: common variants, reference rows not in probes, probes not in reference."""
    n_ref = reference.count()
    common = vmap.groupBy("cohort").agg(F.count(F.lit(1)).alias("common"),
                                        F.count_distinct("variant_idx").alias("_probes_used"))
    np_ = probes.groupBy("cohort").agg(F.count(F.lit(1)).alias("_np"))
    j = np_.join(common, "cohort", "left").fillna(0, ["common", "_probes_used"])
    return j.select("cohort", "common", (F.lit(n_ref) - F.col("common")).alias("ref_not_in_probes"),
                    (F.col("_np") - F.col("_probes_used")).alias("probes_not_in_ref"))
