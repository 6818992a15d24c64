"""Row-window operators over logs, split so that one hot session is many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.operators.ranking import row_index


def with_row_halo(df: DataFrame, keys: list[str], index: str, before: int, block: int) -> tuple[DataFrame, list[str]]:
    """Cut each key into blocks of ``block`` rows and give every block the
    ``before`` rows ahead of it, marked ``__halo``. Frames that look back at
    most ``before`` rows are then exact inside a block."""
    own = F.floor(F.col(index) / block)
    next_block = own + 1
    in_halo = (F.col(index) % block) >= block - before
    blocks = F.when(in_halo, F.array(
        F.struct(own.alias("b"), F.lit(False).alias("h")), F.struct(next_block.alias("b"), F.lit(True).alias("h")))
    ).otherwise(F.array(F.struct(own.alias("b"), F.lit(False).alias("h"))))
    cut = df.withColumn("__x", F.explode(blocks)).withColumns({"__block": F.col("__x.b"), "__halo": F.col("__x.h")})
    return cut.drop("__x"), keys + ["__block"]


def blocking_score(log: DataFrame, key: str = "session_id", block: int = 10_000) -> DataFrame:
    """Signs of being blocked at each request, from the requests before it.

    Error rate and 429s of the last 20, mean time of the last 10 against the
    mean of the last 100; undecided before 10 requests.
    """
    placed = row_index(log, [key], "ts", "request_id")
    cut, keys = with_row_halo(placed, [key], "row_index", 99, block)
    w = Window.partitionBy(*keys).orderBy("row_index")
    last = lambda n: w.rowsBetween(-(n - 1), 0)
    code, took = F.col("status_code"), F.col("response_time")
    out = cut.withColumns({
        "error_rate": F.avg((code >= 400).cast("int")).over(last(20)),
        "too_many": F.sum((code == 429).cast("int")).over(last(20)) > 3,
        "recent_time": F.sum(took).over(last(10)) / 10,
        "mean_time": F.avg(took).over(last(100)),
    }).where(~F.col("__halo"))
    slow = F.round("recent_time", 9) > F.round(F.col("mean_time") * 2, 9)
    score = ((F.col("error_rate") > 0.5).cast("int") + slow.cast("int") + F.col("too_many").cast("int")) / 3
    decided = F.col("row_index") >= 9
    return out.select(
        key, "request_id", "error_rate", F.when(decided, score).otherwise(F.lit(0.0)).alias("confidence"),
        (decided & (score > 0.5)).alias("blocked"))


def rate_utilisation(log: DataFrame, key: str, seconds: int, max_requests: int, block_seconds: int = 3600) -> DataFrame:
    """Requests of the session in the window that ends at each request.

    Blocks of time hold the preceding ``seconds`` of requests as a halo, so a
    busy session spreads over its hours.
    """
    micros = F.unix_micros("ts")
    size = block_seconds * 1_000_000
    own = F.floor(micros / size)
    in_halo = micros % size >= size - seconds * 1_000_000
    blocks = F.when(in_halo, F.array(own, own + 1)).otherwise(F.array(own))
    cut = log.withColumns({"__t": micros, "__own": own}).withColumn("__block", F.explode(blocks))
    w = Window.partitionBy(key, "__block").orderBy("__t").rangeBetween(-seconds * 1_000_000, 0)
    return cut.withColumn("current_requests", F.count(F.lit(1)).over(w)).where(
        F.col("__block") == F.col("__own")).select(
        key, "request_id", "current_requests", (F.col("current_requests") / max_requests).alias("utilisation"))


def deviation_from_global_mean(df: DataFrame, column: str = "rating") -> DataFrame:
    """abs(value - mean of all rows); the mean is a scalar, not a window over everything."""
    mean = df.agg(F.avg(column).alias("m"))
    return df.withColumn(f"{column}_deviation", F.abs(F.col(column) - mean.scalar()))


def seconds_since_previous(alerts: DataFrame, keys: list[str], block_days: int = 1) -> DataFrame:
    """Seconds since the previous alert of the same key.

    Each day of a key is one window; a day's first alert takes the last alert
    of the most recent earlier day, from one row per key and day.
    """
    day = F.floor(F.unix_micros("ts") / (block_days * 86_400_000_000))
    marked = alerts.withColumn("__day", day)
    inside = Window.partitionBy(*keys, "__day").orderBy("ts", "event_id")
    ends = marked.groupBy(*keys, "__day").agg(F.max("ts").alias("__last"))
    across = Window.partitionBy(*keys).orderBy("__day")
    carried = ends.select(*keys, "__day", F.lag("__last").over(across).alias("__carried"))
    previous = F.coalesce(F.col("__previous"), F.col("__carried"))
    gap: Column = (F.unix_micros("ts") - F.unix_micros(previous)) / 1e6
    return (
        marked.withColumn("__previous", F.lag("ts").over(inside)).join(carried, keys + ["__day"])
        .withColumn("seconds_since_previous", gap).drop("__day", "__previous", "__carried"))


def user_bursts(df: DataFrame, date: str) -> DataFrame:
    """Per user: reviews, busiest day, duplicate share, rating variance, days active."""
    per_day = df.groupBy("user_id", F.to_date(date).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"),
        F.sum(F.col("rating") * F.col("rating")).alias("ss"))
    users = per_day.groupBy("user_id").agg(
        F.sum("n").alias("reviews"), F.max("n").alias("busiest_day"),
        (F.datediff(F.max("day"), F.min("day")) + 1).alias("days_active"),
        F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    pairs = df.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(
        F.sum(F.col("n") - 1).alias("repeats"))
    n = F.col("reviews")
    variance = F.when(n > 1, (F.col("ss") - F.col("s") * F.col("s") / n) / (n - 1))
    return users.join(pairs, "user_id").select(
        "user_id", "reviews", "busiest_day", "days_active", (n / F.col("days_active")).alias("reviews_per_day"),
        (F.col("repeats") / n).alias("repeat_ratio"), variance.alias("rating_variance"))
