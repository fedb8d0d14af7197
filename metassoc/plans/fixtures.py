"""Cohort views over the driver's TPC-H-like tables (the roles of FIXTURES.md §B).

cohort      region name (or nation name for the 25-cohort level) through customer → nation → region
sample      customer key
covariate   x = c_acctbal / 1000 (one covariate; with the intercept p = 2)
genotype    variant = 'v' || (l_partkey % n_variants); dosage = least(2, #lineitems of the customer
            in that bucket); 0 (absent row) when none; a call whose lineitems were all returned
            ('R') is missing (code 9) in the raw variant of the table
phenotype   one per o_orderpriority; y = Σ o_totalprice / 1e5 of the customer (absent row = 0)

All views are lazy DataFrames; the dimension tables nation (25 rows) and region (5 rows) have a
cardinality fixed by the schema, so they are the only tables broadcast without a measured check.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MISSING_DOSAGE

# Fixed values of the fixture design.
N_VARIANTS = 20
COVARIATES = ["acctbal"]
RETURNED_FLAG = "R"


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` (one DataFrame per session and path: file listing and footers are
    read once, and every query that reuses it gets the same lazy relation)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df


def cohort_dim(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """(nationkey, cohort): 25 rows."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    if level == "nation":
        return n.select("n_nationkey", F.col("n_name").alias("cohort"))
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("cohort"))


def samples(spark: SparkSession, sf_dir: str, level: str = "region", two_covariates: bool = False) -> DataFrame:
    """(cohort, sample_id, x array<double>); ``two_covariates`` adds x2 = c_nationkey / 10."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    d = cohort_dim(spark, sf_dir, level)
    xs = [F.col("c_acctbal") / 1000.0]
    if two_covariates:
        xs.append(F.col("c_nationkey").cast("double") / 10.0)
    return (c.join(F.broadcast(d), c.c_nationkey == d.n_nationkey)
            .select("cohort", F.col("c_custkey").alias("sample_id"), F.array(*xs).alias("x")))


def calls(spark: SparkSession, sf_dir: str, n_variants: int | None = N_VARIANTS) -> DataFrame:
    """(sample_id, vkey, cnt, all_returned): lineitems per customer and part bucket
    (``n_variants=None``: one variant per part).

    lineitem ⋈ orders on the order key, pre-aggregated to one row per (customer, bucket)
    before anything else is joined."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    vkey = F.col("l_partkey") if n_variants is None else F.col("l_partkey") % n_variants
    sold = li.join(o, li.l_orderkey == o.o_orderkey)
    if n_variants is None:          # sums before the shuffle save nothing: rows meet where samples are joined next
        sold = sold.repartition("o_custkey")
    return (sold.groupBy(F.col("o_custkey").alias("sample_id"), vkey.alias("vkey"))
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.bool_and(F.col("l_returnflag") == RETURNED_FLAG).alias("all_returned")))


def variant_label(vkey) -> F.Column:
    return F.concat(F.lit("v"), F.col(vkey).cast("string"))


def genotype(spark: SparkSession, sf_dir: str, level: str = "region", n_variants: int = N_VARIANTS,
             with_missing: bool = False, smp: DataFrame | None = None) -> DataFrame:
    """(cohort, sample_id, variant, dosage, x): non-zero calls only."""
    smp = smp if smp is not None else samples(spark, sf_dir, level)
    c = calls(spark, sf_dir, n_variants)
    dosage = F.least(F.lit(2), F.col("cnt")).cast("double")
    if with_missing:
        dosage = F.when(F.col("all_returned"), F.lit(MISSING_DOSAGE)).otherwise(dosage)
    return (c.join(smp, "sample_id")
            .select("cohort", "sample_id", variant_label("vkey").alias("variant"), dosage.alias("dosage"), "x"))


def phenotype(spark: SparkSession, sf_dir: str, level: str = "region", smp: DataFrame | None = None) -> DataFrame:
    """(cohort, sample_id, phenotype, y, x): one value per customer and order priority."""
    smp = smp if smp is not None else samples(spark, sf_dir, level)
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    y = (o.groupBy(F.col("o_custkey").alias("sample_id"), F.col("o_orderpriority").alias("phenotype"))
         .agg((F.sum("o_totalprice") / 1e5).alias("y")))
    return y.join(smp, "sample_id").select("cohort", "sample_id", "phenotype", "y", "x")


def cohort_data(spark: SparkSession, sf_dir: str, level: str = "region", n_variants: int | None = N_VARIANTS,
                persist: bool = True):
    """(samples, genotype, phenotype) of the fixture.

    The genotype and phenotype views are derived by joins and aggregates and are read twice by
    the analysis (moments and cross products), so they are persisted (memory, spilling to disk;
    recomputed from lineage if an executor is lost) — a stored genotype table would simply be
    scanned twice instead."""
    smp = samples(spark, sf_dir, level)
    geno = genotype(spark, sf_dir, level, n_variants, smp=smp)
    phen = phenotype(spark, sf_dir, level, smp=smp)
    if persist:
        geno, phen = geno.persist(StorageLevel.MEMORY_AND_DISK), phen.persist(StorageLevel.MEMORY_AND_DISK)
    return smp, geno, phen


def embedding_rows(spark: SparkSession, sf_dir: str, split: bool = False):
    """Dense rows from ``embeddings``: label < 5 are variants, the others phenotypes; the 64 vector
    positions are the samples.  ``split`` cuts the positions into two cohorts A (1-32) and B (33-64)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    if split:
        e = (e.select("vec_id", "label", F.lit("A").alias("cohort"), F.slice("v", 1, 32).alias("v"))
             .unionByName(e.select("vec_id", "label", F.lit("B").alias("cohort"), F.slice("v", 33, 32).alias("v"))))
    else:
        e = e.withColumn("cohort", F.lit("all"))
    key = F.col("vec_id").cast("string")
    geno = e.where(F.col("label") < 5).select("cohort", key.alias("variant"), F.col("v").alias("dosage"))
    phen = e.where(F.col("label") >= 5).select("cohort", key.alias("phenotype"), F.col("v").alias("values"))
    return geno, phen


# Fixed values of the fixture design: vector entries to calls, covariate i of sample s is (s * factor * (s if squared)) % modulus.
CALL_MISSING, CALL_EDGE = 0.01, 0.08
DENSE_COVARIATES = {"c1": "s * s % 7", "c2": "s * 5 % 11", "c3": "s * 3 % 4"}


def dense_calls(spark: SparkSession, sf_dir: str):
    """(genotype, phenotype, covariates): two dense cohorts from the halves of the embeddings.  An entry x of a variant row is the call
    9 (missing) if |x| < 0.01, 0 if x < -0.08, 2 if x > 0.08, else 1; phenotype rows are the entries; the covariates are
    small integers of the sample position."""
    geno, phen = embedding_rows(spark, sf_dir, split=True)
    call = (lambda x: F.when(F.abs(x) < CALL_MISSING, F.lit(MISSING_DOSAGE)).when(x < -CALL_EDGE, F.lit(0.0))
            .when(x > CALL_EDGE, F.lit(2.0)).otherwise(F.lit(1.0)))
    geno = geno.withColumn("dosage", F.transform("dosage", call))
    at = F.array(*[F.struct(F.lit(k).alias("covariate"), F.expr(f"transform(sequence(0, 31), s -> cast({e} AS double))").alias("values"))
                   for k, e in DENSE_COVARIATES.items()])
    cov = phen.select("cohort").distinct().select("cohort", F.explode(at).alias("_c")).select("cohort", "_c.covariate", "_c.values")
    return geno, phen, cov


# ---------------------------------------------------------------- harmonisation fixtures
# Fixed values of the fixture design.
BASES = "ACGT"
ALTERED_ALLELE = "N"


def _brand_num():
    return F.substring(F.col("p_brand"), 7, 4).cast("int")


def reference_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ref_idx, ref_id, chr, bp, allele1, allele2) from ``part``: chr = p_size % 22 + 1, bp = p_partkey,
    allele pair chosen from the brand number."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    b = _brand_num()
    return p.select(F.col("p_partkey").alias("ref_idx"),
                    F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("ref_id"),
                    (F.col("p_size") % 22 + 1).alias("chr"), F.col("p_partkey").alias("bp"),
                    F.substring(F.lit(BASES), b % 4 + 1, 1).alias("allele1"),
                    F.substring(F.lit(BASES), (b + 1) % 4 + 1, 1).alias("allele2"))


def sold_parts(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """(cohort, partkey): parts bought by the cohort's customers."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    smp = samples(spark, sf_dir, level).select("cohort", "sample_id")
    per_cust = (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("o_custkey").alias("sample_id"), F.col("l_partkey").alias("partkey")))
    return per_cust.join(smp, "sample_id").select("cohort", "partkey").distinct()


def cohort_probes(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """(cohort, variant_idx, id, chr, bp, allele1, allele2): the reference rows of parts sold in the
    cohort; allele2 altered when partkey % 7 = 0, alleles swapped when % 3 = 0."""
    ref = reference_panel(spark, sf_dir)
    s = sold_parts(spark, sf_dir, level)
    j = s.join(ref, s.partkey == ref.ref_idx)
    a2 = F.when(F.col("ref_idx") % 7 == 0, F.lit(ALTERED_ALLELE)).otherwise(F.col("allele2"))
    sw = F.col("variant_idx") % 3 == 0
    j = j.select("cohort", F.col("ref_idx").alias("variant_idx"), F.col("ref_id").alias("id"), "chr", "bp",
                 F.col("allele1").alias("_a1"), a2.alias("_a2"))
    return j.select("cohort", "variant_idx", "id", "chr", "bp",
                    F.when(sw, F.col("_a2")).otherwise(F.col("_a1")).alias("allele1"),
                    F.when(sw, F.col("_a1")).otherwise(F.col("_a2")).alias("allele2"))


# ---------------------------------------------------------------- QC fixtures

def snpqc_table(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """SNP QC file per cohort: ID, MAF (folded), HWE, MACH_R2, CALL, TYPED, Genotype_Counts.

    Counts come from the genotype; HWE, MACH_R2, CALL and TYPED are fixed arithmetic on the bucket."""
    smp, geno, _ = cohort_data(spark, sf_dir, level)
    n = smp.groupBy("cohort").agg(F.count(F.lit(1)).alias("n"))
    st = geno.groupBy("cohort", "variant").agg(
        F.count(F.when(F.col("dosage") == 1, 1)).alias("n1"), F.count(F.when(F.col("dosage") == 2, 1)).alias("n2"),
        F.count(F.lit(1)).alias("nz"), F.sum("dosage").alias("sg"))
    st = st.join(F.broadcast(n), "cohort")
    k = F.substring(F.col("variant"), 2, 10).cast("int")
    af = F.col("sg") / (2.0 * F.col("n"))
    from ..operators.qc import genotype_count_text
    return st.select(
        "cohort", F.col("variant").alias("ID"), F.least(af, 1 - af).alias("MAF"),
        (F.lit(1.0) / F.pow(F.lit(10.0), k % 9)).alias("HWE"),
        ((k % 10) / 10.0 + 0.05).alias("MACH_R2"),
        F.when(k % 13 == 0, F.lit(0.98)).otherwise(F.lit(1.0)).alias("CALL"),
        (k % 2).alias("TYPED"),
        genotype_count_text(F.col("n") - F.col("nz"), F.col("n1"), F.col("n2")).alias("Genotype_Counts"))


def geneqc_table(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """Gene QC per cohort: gene, nr_values (count of y), nr_unique_values (distinct y)."""
    _, _, phen = cohort_data(spark, sf_dir, level)
    return phen.groupBy("cohort", F.col("phenotype").alias("gene")).agg(
        F.count("y").alias("nr_values"), F.count_distinct("y").alias("nr_unique_values"))


def genregpcs_table(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """Regulated-PC table per cohort from ``supplier``: Phenotype ExpPC<suppkey % 100 + 1>,
    P-value 10^-(suppkey % 12)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    d = cohort_dim(spark, sf_dir, level)
    return (s.join(F.broadcast(d), s.s_nationkey == d.n_nationkey)
            .select("cohort", F.concat(F.lit("ExpPC"), (F.col("s_suppkey") % 100 + 1).cast("string")).alias("Phenotype"),
                    (F.lit(1.0) / F.pow(F.lit(10.0), F.col("s_suppkey") % 12)).alias("P-value")))


# ---------------------------------------------------------------- events as a second phenotype source

def event_phenotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, phenotype, y): per user and event type the mean event value."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    return e.groupBy(F.col("user_id").alias("sample_id"), F.col("event_type").alias("phenotype")).agg(
        F.avg("value").alias("y"))


def variant_probes(spark: SparkSession, sf_dir: str, n_variants: int = N_VARIANTS) -> DataFrame:
    """Probe annotation per bucket variant from ``part``: ID, allele1, allele2, Rsq."""
    ref = reference_panel(spark, sf_dir)
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ref_idx"), "p_retailprice")
    return (ref.join(p, "ref_idx").groupBy((F.col("ref_idx") % n_variants).alias("vkey"))
            .agg(F.min("allele1").alias("allele1"), F.max("allele2").alias("allele2"),
                 (F.avg("p_retailprice") / 2000.0).alias("Rsq"))
            .select(variant_label("vkey").alias("ID"), "allele1", "allele2", "Rsq"))


def reused(*dfs: DataFrame):
    """Persist derived views that an analysis reads more than once (moments and cross products)."""
    out = tuple(d.persist(StorageLevel.MEMORY_AND_DISK) for d in dfs)
    return out if len(out) > 1 else out[0]
