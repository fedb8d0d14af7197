"""Corpus pipeline: language identification, near-duplicate removal, secret redaction, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame over all that the stage before kept, and is written as Parquet and read
again.  All stages but the last return the columns of ``documents``.  ``doc_id`` identifies a document; rows without one
are told apart by their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metassoc.llm import dartminhash, language, packing, secret_scan
from metassoc.llm.common import staged, table
from metassoc.llm.queries import vocabulary

MIN_SCORE = 0.5       # posterior of the predicted language below which a document is rejected


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, those whose language is uncertain, and those in no learned language: texts that are
    not very short and of which the predicted language knows less than of its own."""
    model = language.shared(docs, language.fit(docs))
    floors = language.floors(docs, model)
    found = language.predict(docs, model, keep=tuple(docs.columns), with_support=True)
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    if floors:
        floor = F.coalesce(F.create_map(*[F.lit(x) for k in sorted(floors) for x in (k, floors[k])])[F.col("lang_pred")], F.lit(0.0))
        sure &= (F.col("n_words") < language.LEAST_WORDS) | (F.col("support") >= floor)
    return found.where(sure).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates, that with the smallest id; a repeated row stays once."""
    # one id for each (doc_id, text): of different texts under one doc_id the first by hash has it, the others an id above all others
    key = F.md5(F.coalesce("text", F.lit("\0")))
    first = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(key).alias("__first"), F.max(key).alias("__last"))
    first = staged(first.where("__first != __last").select(F.col("doc_id").alias("__doc"), "__first"), "repeated-ids")
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    named = docs.join(first, docs["doc_id"] == first["__doc"], "left").withColumn(
        "__id", F.when(key != F.col("__first"), own).otherwise(F.coalesce("doc_id", F.xxhash64("text")))).drop("__doc", "__first")
    found = dartminhash.near_duplicates(named, id_col="__id")
    kept = found.where("kept").select(F.col("__id").alias("__kept")).distinct()
    return (named.join(kept, named["__id"] == kept["__kept"], "left_semi").dropDuplicates(["__id"]).select(*docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret found; all documents stay."""
    return secret_scan.redact(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences of 2048 ids, with their ids."""
    return packing.pack(packing.tokenize(docs, vocabulary("word_bpe_49k.json")))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secrets", secrets), ("packing", pack)]

# byte-pair encoding and minhash bands have no SQL; tests/llm/test_pipeline.py holds run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: the pieces of the packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
