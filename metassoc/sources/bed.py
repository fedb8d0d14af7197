"""PLINK BED files as a Spark data source: byte ranges as partitions, opened through Arrow's file systems.

    spark.dataSource.register(BedSource)
    spark.read.format("bed").option("samples", n).option("variants", v).load("….bed")   ->  variant_idx, dosage array<double>

A variant is a row of ceil(samples / 4) bytes behind three header bytes, so every block of variants is one byte range and one
partition.  ``option("first", a)`` and ``option("last", b)`` read the variants a … b - 1 only; filters on ``variant_idx`` that Spark
pushes down (``spark.sql.python.filterPushdown.enabled``) drop the blocks outside.  Every partition checks the header.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    LessThan, LessThanOrEqual)

from ..functions.columns import MISSING_DOSAGE

BED_MAGIC = bytes([0x6C, 0x1B])
BED_SNP_MAJOR = 0x01
# 2-bit code (low bit first) -> dosage; 1 is PLINK's missing call.
BED_CODES = np.array([0.0, MISSING_DOSAGE, 1.0, 2.0])
HEADER = 3
ROWS_PER_BATCH = 256
SCHEMA = "variant_idx long, dosage array<double>"


def arrow_uri(spark: SparkSession, path: str) -> str:
    """The address of ``path`` behind links and mounts of the session's Hadoop file systems, as Arrow's file systems take it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = fs.resolvePath(p).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def open_input(uri: str):
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def lookup() -> np.ndarray:
    """256 × 4 table: byte -> the four decoded calls it packs (first sample in the low bits)."""
    b = np.arange(256)
    return BED_CODES[np.stack([(b >> (2 * k)) & 3 for k in range(4)], axis=1)]


class Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class BedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.samples = options["path"], int(options["samples"])
        self.first, self.last = int(options.get("first", 0)), int(options.get("last", options["variants"]))
        self.last = min(self.last, int(options["variants"]))
        self.block = int(options.get("variants_per_partition", 4096))
        self.wanted: set[int] | None = None

    def partitions(self) -> list[Range]:
        out = [Range(a, min(a + self.block, self.last)) for a in range(max(self.first, 0), max(self.last, 0), self.block)]
        if self.wanted is not None:
            out = [r for r in out if any(r.first <= i < r.last for i in self.wanted)]
        return out or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        width, table = math.ceil(self.samples / 4), lookup()
        if partition.first >= partition.last:
            return
        with open_input(self.uri) as f:
            head = f.read(HEADER)
            if head[:2] != BED_MAGIC:
                raise OSError(f"{self.uri} does not start like a BED file")
            if head[2] != BED_SNP_MAJOR:
                raise OSError(f"{self.uri} stores samples, not variants, as rows")
            f.seek(HEADER + partition.first * width)
            for a in range(partition.first, partition.last, ROWS_PER_BATCH):
                n = min(ROWS_PER_BATCH, partition.last - a)
                raw = np.frombuffer(f.read(n * width), np.uint8)
                if len(raw) != n * width:
                    raise OSError(f"{self.uri} ends before variant {a + n}")
                calls = table[raw.reshape(n, width)].reshape(n, width * 4)[:, :self.samples]
                ends = np.arange(n + 1, dtype=np.int32) * self.samples
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(a, a + n)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(calls).ravel()))],
                    names=["variant_idx", "dosage"])


class FilteringBedReader(BedReader):
    """Also takes filters on ``variant_idx``; Spark accepts it only where pushdown to Python sources is on."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("variant_idx",):
                if isinstance(f, EqualTo):
                    self.first, self.last = max(self.first, f.value), min(self.last, f.value + 1)
                elif isinstance(f, In):
                    self.wanted = set(f.value) if self.wanted is None else self.wanted & set(f.value)
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.first = max(self.first, f.value + isinstance(f, GreaterThan))
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    self.last = min(self.last, f.value + isinstance(f, LessThanOrEqual))
            yield f             # blocks are dropped here, rows by Spark


class BedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BedReader:
        options = dict(self.options)
        return (FilteringBedReader if options.get("pushdown") == "true" else BedReader)(options)


def read_bed_rows(spark: SparkSession, path: str, samples: int, variants: int, variants_per_partition: int = 4096,
                  first: int = 0, last: int | None = None) -> DataFrame:
    """Variants ``first`` … ``last`` - 1 of a BED file with the sizes of its FAM and BIM files; a file of another size is an error."""
    spark.dataSource.register(BedSource)
    size = spark.read.format("binaryFile").load(path).select("length").first()[0]           # listing only, no content
    if size != HEADER + math.ceil(samples / 4) * variants:
        raise OSError(f"{path}: size does not match {variants} variants × {samples} samples")
    pushdown = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()
    return (spark.read.format("bed").option("pushdown", pushdown).option("samples", samples).option("variants", variants).option("first", first)
            .option("last", variants if last is None else last).option("variants_per_partition", variants_per_partition)
            .load(arrow_uri(spark, path)))


def pack_calls(dosage: np.ndarray) -> np.ndarray:
    """(variants, ceil(samples / 4)) bytes of calls (variants, samples) in 0, 1, 2 and 9; any other value is missing."""
    code = np.full(dosage.shape, 1, np.uint8)
    for c in (0, 2, 3):
        code[dosage == BED_CODES[c]] = c
    padded = np.zeros((len(code), -(-code.shape[1] // 4) * 4), np.uint8)
    padded[:, :code.shape[1]] = code
    return (padded.reshape(len(code), -1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2).astype(np.uint8)


def write_bed(genotype: DataFrame, folder: str) -> DataFrame:
    """One BED file per cohort of dense rows (cohort, variant_idx, dosage), below ``folder``: (cohort, path, variants).

    A BED file is one sequence of rows, so a cohort's rows, sorted, are one task's stream, written as they come."""
    spark = genotype.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    base = arrow_uri(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, where = fs.FileSystem.from_uri(base)
        now, out, done, n = None, None, [], 0

        def close():
            if out is not None:
                out.close()
                done.append((now, f"{base}/{now}.bed", n))

        for batch in batches:
            for cohort, dosage in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if cohort != now or out is None:
                    close()
                    now, n, out = cohort, 0, system.open_output_stream(f"{where}/{cohort}.bed")
                    out.write(BED_MAGIC + bytes([BED_SNP_MAJOR]))
                out.write(pack_calls(dosage.values.to_numpy(zero_copy_only=False)[None, :]).tobytes())
                n += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string()),
                                          pa.array([d[2] for d in done], pa.int64())], names=["cohort", "path", "variants"])

    rows = genotype.select("cohort", "variant_idx", "dosage").repartition("cohort").sortWithinPartitions("cohort", "variant_idx")
    return rows.select("cohort", "dosage").mapInArrow(run, "cohort string, path string, variants long")
