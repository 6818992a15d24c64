"""Sharding by extendible hashing: only shards over the byte limit split on another bit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.session import materialize

STEP = 12        # bits of the hash that one pass over the open rows reads
HASH_BITS = 60   # of the md5 of the key; after them, of the md5 of key and text


def _bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(prefix, depth, bytes, rows) of the shards over ``rows`` (h, h2, bytes).

    A shard is a prefix of ``depth`` bits. The table starts as one shard; a shard
    over ``limit`` bytes is split on its next bit, others are left alone. Each
    pass sums the bytes of the open shards under ``STEP`` more bits, finds at
    which of these bits each branch first fits, and hands on only those that are
    still too large; so the passes grow with the depth, not with the shards.
    A shard of one row, or whose rows share all bits, stays as it is.
    """
    closed, depth = None, 0
    open_ = rows.withColumn("at", F.lit(""))
    bits = F.concat(F.lpad(F.conv(F.col("h").cast("string"), 10, 2), HASH_BITS, "0"),
                    F.lpad(F.conv(F.col("h2").cast("string"), 10, 2), HASH_BITS, "0"))
    while depth < 2 * HASH_BITS:
        step = min(STEP, 2 * HASH_BITS - depth)
        deep = open_.groupBy(F.substring(bits, 1, depth + step).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
        levels = materialize(deep.withColumn(
            "depth", F.explode(F.sequence(F.lit(depth), F.lit(depth + step)))).groupBy(
            F.expr("substring(cell, 1, depth)").alias("prefix"), "depth").agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        large = levels.where((F.col("bytes") > limit) & (F.col("rows") > 1))
        parents = large.select("prefix", "depth").withColumn("child", F.explode(F.array(F.lit("0"), F.lit("1"))))
        born = parents.select(F.concat("prefix", "child").alias("prefix"))
        if depth == 0:
            born = born.union(levels.where("depth = 0").select("prefix"))
        fits = levels.join(born.distinct(), "prefix", "left_semi").where(
            (F.col("bytes") <= limit) | (F.col("rows") == 1))
        closed = fits if closed is None else closed.union(fits)
        depth += step
        still = materialize(large.where(F.col("depth") == depth))
        if still.isEmpty() or depth == 2 * HASH_BITS:
            return closed.union(still)
        open_ = materialize(rows.join(
            still.select(F.col("prefix").alias("p")), F.substring(bits, 1, depth) == F.col("p"), "left_semi"))
    return closed


def shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bytes, shard, depth, shard_bytes): the shard of each row, named by its hash bits.

    Bytes are those of the text in UTF-8. The hash is the md5 of the id, so a key
    stays in its shard; where rows that repeat an id exceed the limit together,
    the bits go on with the md5 of id and text. Rows equal in both cannot be told
    apart by any hash and share a shard, as does a row larger than the limit: only
    such shards exceed it.

    Null texts have no bytes; a null id counts as empty text. Other columns are
    not read. An empty table gives no rows.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("bytes"), _bits(key).alias("h"),
        _bits(F.concat(key, F.lit(":"), text)).alias("h2")))
    made = materialize(directory(rows.select("h", "h2", "bytes"), limit))
    bits = F.concat(F.lpad(F.conv(F.col("h").cast("string"), 10, 2), HASH_BITS, "0"),
                    F.lpad(F.conv(F.col("h2").cast("string"), 10, 2), HASH_BITS, "0"))
    return _find(rows.withColumn("bits", bits), made).select(
        F.col("id").alias(id_col), "bytes", F.col("prefix").alias("shard"), "depth",
        F.col("total").alias("shard_bytes"))


def _find(rows: DataFrame, made: DataFrame) -> DataFrame:
    """Each row with the shard whose prefix its bits have: one equality per depth in use.

    The depths differ by few bits, however many shards there are.
    """
    depths = sorted(r["depth"] for r in made.select("depth").distinct().collect())  # at most 2 * HASH_BITS
    tried = rows.withColumn("try", F.explode(F.array(*[F.lit(d) for d in depths] or [F.lit(0)])))
    tried = tried.withColumn("key", F.expr("substring(bits, 1, try)"))
    named = made.select(F.col("prefix"), "depth", F.col("bytes").alias("total"))
    return tried.join(named, (F.col("key") == F.col("prefix")) & (F.col("try") == F.col("depth")))


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` below ``path``, one folder per shard, and its rows in few files.

    Rows are matched to their shard by id; ids must be unique here.
    """
    where = shards(docs, limit, id_col, text_col).select(F.col(id_col).alias("__id"), F.col("shard").alias("__shard"))
    docs.join(where, F.col(id_col).eqNullSafe(F.col("__id"))).drop("__id").repartition("__shard").write.partitionBy(
        "__shard").parquet(path)
