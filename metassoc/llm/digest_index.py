"""Operator 11: exact dedup by a persistent digest index (DataFrame functions only).

The index is a Parquet table bucketed and sorted by the SHA-256 of the text, one row for each digest and batch:

    digest, keep_id (null in a batch that only brought more copies), rows, batch

A batch of documents becomes one row per distinct digest, aggregated before it is exchanged.  A sort-merge anti-join with
the index, which reads the index bucket by bucket without moving it, finds the digests never seen; these are appended with
the id that stays.  Later batches never take a text over from an earlier one.

Within a batch the largest id of equal texts stays.  A third of all rows may share one text: digests of more than
1/``HOT_SHARE`` of a batch's rows, of which there are at most ``HOT_SHARE``, meet their rows by a broadcast of that bounded
size, and all other digests by sort-merge join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metassoc.llm.common import slots, staged
from metassoc.session import prepare, shared_path

HOT_SHARE = 1000


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class DigestIndex:
    """The index below ``path`` (shared storage), empty if nothing is there yet.  An index written earlier, by this or another
    application, is opened with the ``id_type`` and the number of ``buckets`` it was written with."""

    def __init__(self, spark: SparkSession, path: str, id_type: str, buckets: int):
        self.spark, self.path, self.id_type, self.buckets = prepare(spark), path, id_type, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        quoted = "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"CREATE TABLE {self.name} (digest STRING, keep_id {id_type}, rows BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION {quoted}")

    @classmethod
    def create(cls, spark: SparkSession, id_type: str = "bigint", buckets: int | None = None) -> DigestIndex:
        """A new index below ``spark.checkpoint.dir``."""
        prepare(spark)
        return cls(spark, shared_path(spark, f"llm-digests-{uuid.uuid4().hex}"), id_type, buckets or slots(spark))

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def state(self) -> DataFrame:
        """(digest, keep_id, group_size) over all batches; grouped within the buckets, without an exchange."""
        return self.entries().groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("rows").alias("group_size"))

    def _append(self, rows: DataFrame) -> None:
        """One file per bucket: rows are exchanged as the buckets are hashed."""
        (rows.select("digest", "keep_id", "rows", "batch").repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Dedups a batch against the index, appends what is new, and gives the batch's rows as
        (id, digest, seen, first), written to the shared folder: ``seen``: the text was in the index before;
        ``first``: this row is the one of the batch that stays if not seen.

        Null and empty texts are equal.  A null id is the least; of rows with the same id and text one is ``first``.  Other
        columns are not read; an empty batch appends nothing."""
        name = uuid.uuid4().hex
        rows = staged(batch.select(F.col(id_col).cast(self.id_type).alias("id"), text_digest(F.col(text_col)).alias("digest"),
                                   F.monotonically_increasing_id().alias("row")), "digests")
        groups = staged(rows.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("rows")), "groups")
        known = self.entries().select("digest").distinct().hint("merge")
        fresh = groups.join(known, "digest", "left_anti").select("digest", F.col("last.id").alias("keep_id"), "rows")
        more = groups.join(known, "digest", "left_semi").select("digest", F.lit(None).cast(self.id_type).alias("keep_id"), "rows")
        marked = staged(fresh.withColumn("seen", F.lit(False)).union(more.withColumn("seen", F.lit(True))), "marked")
        self._append(marked.withColumn("batch", F.lit(name)))
        of_group = marked.select("digest", "seen", "rows").join(groups.select("digest", F.col("last.row").alias("last_row")), "digest")
        found = with_groups(rows, of_group, F.col("rows"), rows.count())
        return found.select("id", "digest", "seen", (F.col("row") == F.col("last_row")).alias("first"))

    def compact(self) -> DigestIndex:
        """A new index with one row per digest and one sorted file per bucket, under a new path."""
        new = DigestIndex.create(self.spark, self.id_type, buckets=self.buckets)
        new._append(self.state().select("digest", "keep_id", F.col("group_size").alias("rows"), F.lit("compacted").alias("batch")))
        return new

    def drop(self) -> None:
        """Forgets the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def with_groups(rows: DataFrame, groups: DataFrame, size: Column, total: int) -> DataFrame:
    """``rows`` with the columns of their digest's row in ``groups``: large groups, fewer than ``HOT_SHARE``, by broadcast."""
    hot = groups.where(size * HOT_SHARE > total)
    some = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(
        groups.where(size * HOT_SHARE <= total).hint("merge"), "digest")
    return rows.join(some, "digest").select(*rest.columns).union(rest)


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each text that the index doesn't know; the index then knows it."""
    found = index.add(docs, id_col, text_col)
    first, digest = f"first_{uuid.uuid4().hex}", f"digest_{uuid.uuid4().hex}"
    stays = found.where("first AND NOT seen").select(F.col("id").alias(first), "digest").withColumnRenamed("digest", digest + "_")
    named = docs.withColumn(digest, text_digest(F.col(text_col)))
    kept = named.join(stays, (F.col(digest) == F.col(digest + "_")) & F.col(id_col).cast(index.id_type).eqNullSafe(F.col(first)), "left_semi")
    return kept.dropDuplicates([id_col, digest]).select(*docs.columns)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_type: str = "bigint") -> DataFrame:
    """One row per document: (id_col, keep_id, group_size, kept, text_sha256), the largest id of equal texts staying.

    Ids are integers.  The upper half of the ids goes into a new index first, then the lower half and null ids, so that what an earlier batch
    holds has the larger ids.  A group without any id has a null keep_id; of repeated rows one is kept."""
    docs = docs.select(F.col(id_col).cast(id_type).alias("id"), F.col(text_col).alias("text"))
    middle = docs.agg(F.percentile_approx("id", 0.5)).first()[0]
    upper = F.coalesce(F.col("id") >= F.lit(middle).cast(id_type), F.lit(False))
    index = DigestIndex.create(docs.sparkSession, id_type)
    found = staged(index.add(docs.where(upper), "id").union(index.add(docs.where(~upper), "id")), "found")
    state = staged(index.state(), "state")
    index.drop()
    out = with_groups(found, state, F.col("group_size"), found.count())
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("first") & ~F.col("seen")).alias("kept"),
                      F.col("digest").alias("text_sha256"))
