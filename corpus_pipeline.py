"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.llm import catalog, exactdup, minhash, mixing, packing, toxicity
from opinion_spark.llm.common import table
from opinion_spark.session import checkpoint_dir, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below the limit; the model learns from the labelled rows of the training folds."""
    model = catalog.toxic_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, model, score_col="__toxicity")
    return scored.where(F.col("__toxicity") < catalog.TOXIC_FROM).drop("__toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, also where ids repeat or are null."""
    return exactdup.keep_rows(docs, exactdup.exact_duplicates(docs))


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: the id, or a hash of id and text from 2^62 on where the id is null or names several rows."""
    # stored, so that its size is known: where few ids are shared, no text is shuffled to tell them
    shared = materialize(docs.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__rows")).where(
        F.col("__id").isNull() | (F.col("__rows") > 1)).select("__id", F.lit(True).alias("__shared")))
    own = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit(""))), 2).bitwiseOR(F.lit(1 << 62))
    return docs.join(shared, F.col("doc_id").eqNullSafe(F.col("__id")), "left").withColumn(
        "__row", F.when(F.col("__shared"), own).otherwise(F.col("doc_id"))).drop("__id", "__shared")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates; shingles of five words, similarity 0.8.

    Rows are told by id, or by id and text where ids are null or repeat, so a row neither stays nor goes with its namesake.
    """
    rows = row_keys(docs)
    found = minhash.near_duplicates(rows, width=5, threshold=0.8, id_col="__row")
    kept = materialize(found.where("kept").select("__row").distinct())
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; rows that repeat an id follow its largest count."""
    sized = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    sized = catalog.with_quality(sized, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(sized, catalog.MIX_WEIGHTS, F.col("quality_weight"), catalog.MIX_SEED, size_col="size")
    times = mixed.groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies")).where("__copies > 0")
    taken = docs.join(times, F.col("doc_id").eqNullSafe(F.col("__id")))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(
        *docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, catalog.tokenizer(), capacity=2048)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("MinHash near-dedup", drop_near_copies),
          ("mixing sources to target weights", mix_sources), ("best-fit packing", pack_sequences)]

ORACLE_SQL = None  # a trained score and token ids are beyond SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
