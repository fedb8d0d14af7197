"""Session helpers: build a local session for tests/bench, find the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Conf a cluster deployment is expected to set; local runs fall back to defaults below.
_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "metassoc", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (never used on a cluster, where the launcher owns the conf)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system.  Where it is unset a private scratch
    folder is made for a local master; any other master is an error, because executors would not see it.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="metassoc-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``metassoc`` importable in the Python workers (the ``--py-files`` mechanism): the package
    is zipped once per application and added with ``addPyFile``, so pandas UDFs and
    ``applyInPandas`` functions resolve on every executor whatever the driver's working directory."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="metassoc-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of at most ``size`` where the launcher has left Spark's own bound of 64 MB: rows with long texts or arrays
    would fill it, once in the JVM and several times in the Python worker."""
    if spark.conf.get(BATCH_BYTES) == f"{64 << 20}b":
        spark.conf.set(BATCH_BYTES, size)


CODEC = "spark.sql.parquet.compression.codec"


def dense_files(spark: SparkSession, codec: str = "zstd") -> None:
    """Parquet written in ``codec`` where neither the launcher nor the session has named one.  For results with a row for every pair,
    whose size is that of their doubles: Spark's Snappy finds no runs in them, an entropy coder does (no value changes)."""
    if CODEC not in spark.conf.getAll:
        spark.conf.set(CODEC, codec)


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder (from the session, or a scratch one where unset), the package shipped, Arrow batches bounded."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    bound_batches(spark)
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
