"""Incremental per-phenotype layout of result shards.

Chunk jobs drop meta-result Parquet shards into a folder as they finish; this Structured
Streaming query picks up new shards (file source, fixed schema), and appends them to the
phenotype-partitioned layout.  With ``trigger(availableNow=True)`` it processes everything
present and stops, so it can run after each batch of chunks; the checkpoint (in the shared
checkpoint folder) makes it exactly-once across restarts and executor loss.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path
from ..sources.sinks import META_SCHEMA, conform


def shard_stream(spark: SparkSession, shard_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    return (spark.readStream.schema(META_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(shard_dir))


def layout_by_phenotype(spark: SparkSession, shard_dir: str, out_dir: str, checkpoint: str | None = None,
                        available_now: bool = True):
    """Start (and, with ``available_now``, finish) the shard -> partitioned-layout stream."""
    name = hashlib.md5(f"{shard_dir}\n{out_dir}".encode()).hexdigest()      # one progress log per source and target
    ckpt = checkpoint or shared_path(spark, "streams", f"layout_by_phenotype-{name}")
    q = (conform(shard_stream(spark, shard_dir), META_SCHEMA)
         .writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", ckpt)
         .partitionBy("phenotype").outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    query = q.start()
    if available_now:
        query.awaitTermination()
    return query
