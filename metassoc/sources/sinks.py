"""Result sinks: Parquet result tables, phenotype-partitioned layout, summary CSV, per-phenotype CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

META_SCHEMA = StructType([StructField("variant", StringType()), StructField("phenotype", StringType()),
                          StructField("beta", DoubleType()), StructField("standard_error", DoubleType()),
                          StructField("i_squared", DoubleType()), StructField("sample_size", DoubleType())])
PER_COHORT_SCHEMA = StructType([StructField("cohort", StringType()), StructField("variant", StringType()),
                                StructField("phenotype", StringType()), StructField("beta", DoubleType()),
                                StructField("standard_error", DoubleType()), StructField("sample_size", DoubleType())])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a fixed result schema (error if a column is missing)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_meta(meta: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int = 10_000_000) -> None:
    """Meta result as Parquet (6-column schema)."""
    (conform(meta, META_SCHEMA).write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(path))


def write_per_cohort(effects: DataFrame, path: str, mode: str = "overwrite") -> None:
    conform(effects, PER_COHORT_SCHEMA).write.mode(mode).parquet(path)


def write_by_phenotype(results: DataFrame, path: str, mode: str = "overwrite",
                       max_records_per_file: int = 10_000_000) -> None:
    """Hive-style layout partitioned by phenotype.  Rows are range-partitioned by phenotype and variant, so a
    task writes few folders and a phenotype with many rows is spread over many tasks; files are sorted
    by variant (row-group pruning)."""
    (results.repartitionByRange("phenotype", "variant").sortWithinPartitions("phenotype", "variant")
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("phenotype").parquet(path))


def read_phenotypes(spark: SparkSession, path: str, phenotypes: list[str] | str) -> DataFrame:
    """Extract one or several phenotypes from the partitioned layout (partition pruning)."""
    ph = [phenotypes] if isinstance(phenotypes, str) else list(phenotypes)
    return spark.read.parquet(path).where(F.col("phenotype").isin(ph))


def write_summary_csv(summary: DataFrame, path: str, mode: str = "append") -> None:
    """Space-separated summary table with a header (appending shards)."""
    summary.write.mode(mode).option("sep", " ").option("header", True).csv(path)


def write_split_by_phenotype_csv(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder of CSV files per phenotype."""
    order = ["phenotype", *[c for c in summary.columns if c != "phenotype"][:1]]
    (summary.repartitionByRange(*order).write.mode(mode).option("sep", " ").option("header", True)
     .partitionBy("phenotype").csv(path))


def write_encoded(enc: dict, path: str, mode: str = "overwrite") -> None:
    """Encoded genotype (cohort, variant, pos, dosage) and phenotype (cohort, pos, phenotype, y)."""
    enc["genotype"].write.mode(mode).partitionBy("cohort").parquet(f"{path}/genotype")
    enc["phenotype"].write.mode(mode).partitionBy("cohort").parquet(f"{path}/phenotype")
