"""What several operators share: tables, label folds, links to components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run of anything but ASCII white space
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the links.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each node
    sends its larger, then its smaller neighbours to the smallest node it knows,
    until nothing changes; the number of steps grows with the logarithm of the
    longest path. Each step is two aggregates joined back, so the links of a hub
    are never gathered, and is written out, so lineage stays short. Nodes that are
    their own component appear only if they have links. Self links, repeated
    links and nulls are ignored.
    """
    x, y = F.col(a), F.col(b)
    pairs = materialize(
        links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        .where(x.isNotNull() & y.isNotNull() & (x != y)).distinct())
    before = None
    while (now := _state(pairs)) != before:
        before = now
        both = pairs.union(pairs.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = materialize(small.union(low.toDF("u", "v")).distinct())
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.toDF("node", "component").union(roots)


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
