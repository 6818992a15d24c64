"""Duplicate removal, samples, splits, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.operators.ranking import (
    first_per_key, mark_sample, row_index, sample_exact, top_per_key)


def drop_exact(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """First review of each (product, user, text)."""
    return first_per_key(df, ["product_id", "user_id", "review_text"], [F.col(id_col)])


def drop_near(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """First review of each (product, user, text length); nulls group together."""
    sized = df.withColumn("__length", F.length("review_text"))
    return first_per_key(sized, ["product_id", "user_id", "__length"], [F.col(id_col)]).drop("__length")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in every column; texts are compared and shuffled as their SHA-256."""
    keys = [F.sha2(F.col(c), 256).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes]
    distinct = df.select(*keys).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return distinct.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def proportional_sample(
    df: DataFrame, target: int, stratum: str = "rating", id_col: str = "review_id"
) -> DataFrame:
    """Stratified sample: max(1, int(target * n / N)) rows per stratum, then at most ``target``."""
    quota = F.greatest(F.lit(1), F.floor(F.lit(target) * F.col("n") / F.col("total")))
    picked = sample_exact(df, [stratum], quota, id_col)
    # only strata too small for a whole row can push the sum over the target
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("total"))
    planned = sizes.withColumn("total", total.scalar()).agg(F.sum(F.least("n", quota))).first()[0] or 0
    return picked if planned <= target else sample_exact(picked, [], F.lit(target), id_col, "trim")


def uniform_sample(df: DataFrame, n: int, id_col: str = "review_id", seed: str = "") -> DataFrame:
    """Exactly ``n`` rows (or all), the first by hash of id and seed."""
    return sample_exact(df, [], F.lit(n), id_col, seed)


def shuffled(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.orderBy(F.rand(seed))


def split_plain(df: DataFrame, test_share: float, id_col: str = "review_id", seed: str = "split") -> DataFrame:
    """Add ``is_test`` by the hash of the id: no shuffle, stable for every row."""
    bucket = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(10_000))
    return df.withColumn("is_test", bucket < int(test_share * 10_000))


def split_stratified(
    df: DataFrame, test_share: float, label: str, id_col: str = "review_id", seed: str = "split"
) -> DataFrame:
    """Add ``is_test``, true for exactly round(n * share) rows of each label."""
    return mark_sample(df, [label], F.round(F.col("n") * test_share), id_col, seed, "is_test")


def top_groups(df: DataFrame, key: str, min_count: int, n: int) -> DataFrame:
    """Groups with at least ``min_count`` rows, most rows first, then best mean."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("review_count"), F.avg("rating").alias("avg_rating"))
        .where(F.col("review_count") >= min_count)
        .orderBy(F.desc("review_count"), F.desc("avg_rating"), key).limit(n))


def most_frequent(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(n)


def top_n(df: DataFrame, key: str, score: str, item: str, n: int) -> DataFrame:
    """The ``n`` best items per key by score."""
    return top_per_key(df, [key], [F.desc(score), F.col(item)], n)


def latest_batch(df: DataFrame, batch: str, created: str) -> DataFrame:
    """All rows of the batch created last."""
    last = df.agg(F.max_by(batch, F.struct(created, batch)).alias("b"))
    return df.where(F.col(batch) == last.scalar())


def last_rows(df: DataFrame, ts: str, id_col: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(ts), F.desc(id_col)).limit(n)


def union_labelled(parts: dict[str, DataFrame], name: str = "source") -> DataFrame:
    """UNION ALL with a provenance column; columns missing in a part are null."""
    out: DataFrame | None = None
    for label, part in parts.items():
        part = part.withColumn(name, F.lit(label))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to union")
    return out


def aligned_counts(df: DataFrame, category: str, side: str, left: str, right: str) -> DataFrame:
    """Counts of every category on both sides, 0 where a side lacks it."""
    def one(value: str, name: str) -> DataFrame:
        return df.where(F.col(side) == value).groupBy(category).agg(F.count(F.lit(1)).alias(name))
    return (
        one(left, f"n_{left}").join(one(right, f"n_{right}"), category, "full_outer")
        .na.fill(0, [f"n_{left}", f"n_{right}"]))


def without_seen(candidates: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates that are not in ``seen``."""
    return candidates.join(seen.select(*keys).distinct(), keys, "left_anti")


def surrogate_id(df: DataFrame, order_col: str, id_col: str, start: int = 100_000) -> DataFrame:
    """Consecutive ids from ``start`` + 1 in the order of ``order_col``."""
    return row_index(df, [], order_col, id_col, "surrogate_id").withColumn(
        "surrogate_id", F.col("surrogate_id") + 1 + start)


def by(*cols: str) -> list[Column]:
    return [F.col(c) for c in cols]
