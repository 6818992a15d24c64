"""Join shapes of the library: lookups, semi and anti joins, table rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.functions import lexicons as L


def with_results(reviews: DataFrame, results: DataFrame, key: str = "review_id") -> DataFrame:
    """Reviews with their stored analysis rows (inner equi-join)."""
    return reviews.join(results, key)


def with_user_count(df: DataFrame, name: str = "user_review_count") -> DataFrame:
    """Each row with the number of reviews of its user.

    Counted with map-side combining and joined back, because a window over a
    hot user would put all its rows into one task.
    """
    counts = df.groupBy("user_id").agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, "user_id")


def with_product_name(df: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select("product_id", "product_name")
    return df.join(names, "product_id", "left").withColumn(
        "product_name",
        F.coalesce("product_name", F.concat(F.lit("Product "), F.col("product_id").cast("string"))))


def key_exists(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Each wanted key with a flag whether the table knows it."""
    known = df.join(keys.select(key), key, "left_semi").select(key).distinct()
    return keys.select(key).distinct().join(known.withColumn("found", F.lit(True)), key, "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))


def case_of(column: Column, mapping: dict[str, object], default: object = None) -> Column:
    """A fixed small mapping as a CASE expression; needs no join at all."""
    out: Column | None = None
    for key, value in mapping.items():
        out = F.when(column == key, F.lit(value)) if out is None else out.when(column == key, F.lit(value))
    return out if default is None else out.otherwise(F.lit(default))


def above_threshold(metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Metric rows whose value is above the threshold of their metric."""
    limit = case_of(F.col("metric_name"), thresholds)
    return metrics.withColumn("threshold", limit).where(F.col("metric_value") > F.col("threshold"))


def with_rule(alerts: DataFrame, rules: dict[str, tuple[int, int]] = L.ALERT_RULES,
              default: tuple[int, int] = L.DEFAULT_RULE) -> DataFrame:
    """Each alert with the cooldown and escalation minutes of its type."""
    kind = F.col("alert_type")
    return alerts.withColumns({
        "cooldown_minutes": case_of(kind, {k: v[0] for k, v in rules.items()}, default[0]),
        "escalation_minutes": case_of(kind, {k: v[1] for k, v in rules.items()}, default[1])})


def channel_table(spark: SparkSession, channels: dict[str, tuple[bool, list[str]]] = L.CHANNELS) -> DataFrame:
    rows = [(name, on, wants) for name, (on, wants) in channels.items()]
    return spark.createDataFrame(rows, "channel string, enabled boolean, severity_filter array<string>")


def route(alerts: DataFrame, channels: DataFrame) -> DataFrame:
    """One row per alert and enabled channel that wants its severity.

    The severity list is exploded first, so this is an equi-join on severity.
    The channel table is configuration: a handful of rows.
    """
    wanted = channels.where("enabled").select("channel", F.explode("severity_filter").alias("severity"))
    return alerts.join(F.broadcast(wanted), "severity")
