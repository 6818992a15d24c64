"""Product, user, sentiment, fake, alert and crawl aggregates.

All are groupBy aggregates, so Spark combines each key inside the map tasks
before the shuffle and a hot product or user costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.functions import text as X
from opinion_spark.operators.ranking import row_index, top_per_key


def n_rows() -> Column:
    return F.count(F.lit(1))


def products_table(df: DataFrame, date: str = "date") -> DataFrame:
    """Per product: mean, count and deviation of ratings, texts, last date, name."""
    return df.groupBy("product_id").agg(
        F.round(F.avg("rating"), 2).alias("avg_rating"), F.count("rating").alias("total_reviews"),
        F.round(F.stddev_samp("rating"), 2).alias("rating_std"),
        F.count("review_text").alias("review_count"), F.max(date).alias("last_review_date"),
    ).withColumns({
        "product_name": F.concat(F.lit("Food Product "), F.col("product_id").cast("string")),
        "category": F.lit("Food & Beverages")})


def users_table(df: DataFrame, date: str = "date") -> DataFrame:
    return df.groupBy("user_id").agg(
        F.round(F.avg("rating"), 2).alias("avg_rating_given"), F.count("rating").alias("review_count"),
        F.round(F.avg(F.length("review_text")), 2).alias("avg_review_length"),
        F.max(date).alias("last_review_date"),
    ).withColumn("username", F.concat(F.lit("User_"), F.col("user_id").cast("string")))


def product_texts(df: DataFrame, per_part: int = 1000) -> DataFrame:
    """Per product the rating summary and its texts joined in id order.

    A product's text comes in numbered parts of at most ``per_part`` reviews,
    so a hot product does not have to fit into one row; the parts in order are
    the whole text.
    """
    summary = df.groupBy("product_id").agg(F.avg("rating").alias("avg_rating"), n_rows().alias("review_count"))
    placed = row_index(df.select("product_id", "review_id", "review_text"), ["product_id"], "review_id", "review_id")
    parts = (
        placed.withColumn("part", F.floor(F.col("row_index") / per_part))
        .groupBy("product_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("review_id", "review_text"))).alias("r")))
    return parts.select(
        "product_id", "part", F.array_join(F.col("r.review_text"), " ").alias("combined_text")
    ).join(summary, "product_id")


def dataset_info(df: DataFrame, date: str, approximate: bool = False) -> DataFrame:
    """Rows, columns, date range, distinct keys and nulls in one pass."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        n_rows().alias("total_rows"), F.lit(len(df.columns)).alias("n_columns"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        distinct("product_id").alias("n_products"), distinct("user_id").alias("n_users"),
        null_cells(df).alias("null_cells"))


def null_cells(df: DataFrame) -> Column:
    return F.sum(sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long")))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) from one pass over the table."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column_name", "nulls")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percent of each value."""
    counts = df.groupBy(column).agg(n_rows().alias("n"))
    return counts.withColumn("percent", F.col("n") / counts.agg(F.sum("n").alias("t")).scalar() * 100)


def sample_statistics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("rating").alias("avg_rating"), F.stddev_samp("rating").alias("rating_std"),
        F.avg(F.length("review_text")).alias("avg_length"),
        F.avg(X.word_count(F.col("review_text"))).alias("avg_words"),
        F.count_distinct("product_id").alias("n_products"))


def product_core(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id").agg(n_rows().alias("review_count"), F.avg("rating").alias("average_rating"))


def daily_trend(df: DataFrame, date: str, as_of: str, days: int = 30) -> DataFrame:
    """Per product and day of the last ``days`` days: reviews and mean rating."""
    day = F.to_date(date)
    return df.where(day >= F.date_sub(F.lit(as_of).cast("date"), days)).groupBy(
        "product_id", day.alias("day")).agg(n_rows().alias("review_count"), F.avg("rating").alias("avg_rating"))


def trend_direction(daily: DataFrame, points: int = 7) -> DataFrame:
    """Mean of the newest against the oldest ``points`` days of each product.

    The input has one row per product and day, so a product's window is small.
    """
    w = Window.partitionBy("product_id")
    marked = daily.withColumns({
        "old": F.row_number().over(w.orderBy("day")) <= points,
        "new": F.row_number().over(w.orderBy(F.desc("day"))) <= points})
    means = marked.groupBy("product_id").agg(
        F.avg(F.when(F.col("old"), F.col("avg_rating"))).alias("first_mean"),
        F.avg(F.when(F.col("new"), F.col("avg_rating"))).alias("last_mean"))
    gap = F.round(F.col("last_mean") - F.col("first_mean"), 9)
    return means.withColumn(
        "direction", F.when(gap > 0, "improving").when(gap < 0, "declining").otherwise("stable"))


def popularity(df: DataFrame, min_reviews: int = 5, prior: float = 3.5) -> DataFrame:
    """Mean rating pulled towards the prior for products with few reviews."""
    n, m = F.col("rating_count"), float(min_reviews)
    return (
        df.groupBy("product_id").agg(F.avg("rating").alias("avg_rating"), n_rows().alias("rating_count"))
        .where(n >= min_reviews)
        .withColumn("popularity_score", n / (n + m) * F.col("avg_rating") + m / (n + m) * prior)
        .withColumn("confidence", F.least(n / 100, F.lit(1.0))))


def popular_products(df: DataFrame, n: int = 10) -> DataFrame:
    return popularity(df).orderBy(F.desc(F.round("popularity_score", 9)), "product_id").limit(n)


def popular_fallback(df: DataFrame, n: int = 10, min_reviews: int = 5) -> DataFrame:
    return (
        product_core(df).where(F.col("review_count") >= min_reviews)
        .orderBy(F.desc("average_rating"), F.desc("review_count"), "product_id").limit(n))


def search_products(df: DataFrame, query: str, n: int = 20) -> DataFrame:
    """Products whose text or id matches, with counts and the sample of the first review."""
    hit = X.contains_ignore_case(F.col("review_text"), query) | X.contains_ignore_case(
        F.col("product_id").cast("string"), query)
    sample = F.concat(F.substring("review_text", 1, 100), F.lit("..."))
    return (
        df.where(hit).groupBy("product_id")
        .agg(n_rows().alias("review_count"), F.avg("rating").alias("avg_rating"),
             F.min_by(sample, "review_id").alias("sample_review"))
        .orderBy(F.desc("review_count"), F.desc("avg_rating"), "product_id").limit(n))


def rating_by_length(df: DataFrame) -> DataFrame:
    return df.groupBy(B.length_category(F.length("review_text")).alias("length_category")).agg(
        F.avg("rating").alias("avg_rating"), n_rows().alias("n"))


def business_kpis(df: DataFrame) -> DataFrame:
    """Key figures of the review table from one pass."""
    r, h, t = F.col("rating"), F.col("helpful_votes"), F.col("total_votes")
    return df.agg(
        F.avg(r).alias("avg_rating"), (F.avg((r >= 4).cast("int")) * 100).alias("positive_pct"),
        F.avg(F.length("review_text")).alias("avg_length"),
        F.count_distinct("product_id").alias("n_products"),
        F.count_distinct(F.when(r >= 4, F.col("product_id"))).alias("liked_products"),
        F.count_distinct(F.when(r <= 2, F.col("product_id"))).alias("disliked_products"),
        F.avg(F.when(h > 0, B.helpful_floor_one(h, t))).alias("avg_helpful_ratio"),
        F.count_if(t > 0).alias("voted"),
        F.mode(r, deterministic=True).alias("modal_rating"))


# ---- sentiment and fake results ------------------------------------------
def sentiment_stats(df: DataFrame) -> DataFrame:
    label = F.col("overall_sentiment")
    return df.agg(
        n_rows().alias("total"), F.avg("confidence").alias("avg_confidence"),
        F.avg("sentiment_score").alias("avg_score"),
        F.count_if(label == "POSITIVE").alias("positive"), F.count_if(label == "NEGATIVE").alias("negative"),
        F.count_if(label == "NEUTRAL").alias("neutral"))


def aspect_rows(df: DataFrame, aspects: str = "aspects", keep: tuple[str, ...] = ("review_id",)) -> DataFrame:
    """One row per mentioned aspect.

    The outer explode keeps Spark from deriving a size filter, which it would
    push below the scoring and so score every text a second time.
    """
    return df.select(*keep, F.explode_outer(aspects).alias("aspect", "v")).where("aspect IS NOT NULL").select(
        *keep, "aspect", F.col("v.sentiment").alias("sentiment"), F.col("v.confidence").alias("confidence"))


def aspect_stats(rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy(*keys, "aspect").agg(F.avg("sentiment").alias("avg_sentiment"), n_rows().alias("mentions"))


def top_aspects(rows: DataFrame, n: int = 5) -> DataFrame:
    """The most mentioned aspects of each product."""
    return top_per_key(
        aspect_stats(rows, ("product_id",)), ["product_id"], [F.desc("mentions"), F.col("aspect")], n)


def sentiment_by_product(df: DataFrame) -> DataFrame:
    """Count and percent of each sentiment per product."""
    counts = df.groupBy("product_id", "overall_sentiment").agg(n_rows().alias("n"))
    share = Window.partitionBy("product_id")  # at most three rows per product
    return counts.withColumn("percent", F.col("n") / F.sum("n").over(share) * 100)


def fake_by_product(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id").agg((F.avg("fake_probability") * 100).alias("fake_pct"), n_rows().alias("checked"))


def risk_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("risk_level").agg(
        n_rows().alias("n"), F.avg("fake_probability").alias("avg_fake_probability"), F.avg("confidence").alias("avg_confidence"))


def model_rollup(sentiment: DataFrame, fake: DataFrame) -> DataFrame:
    """One row of rounded averages over both result tables."""
    s = sentiment.agg(F.round(F.avg("confidence"), 3).alias("sentiment_confidence"), n_rows().alias("sentiment_rows"))
    f = fake.agg(
        F.struct(F.round(F.avg("fake_probability"), 3).alias("p"), F.round(F.avg("confidence"), 3).alias("c"),
                 n_rows().alias("n")).alias("f"))
    return s.withColumn("f", f.scalar()).select(
        "sentiment_confidence", "sentiment_rows", F.col("f.p").alias("avg_fake_probability"),
        F.col("f.c").alias("fake_confidence"), F.col("f.n").alias("fake_rows"))


def coverage(reviews: DataFrame, analysed: DataFrame, key: str = "review_id") -> DataFrame:
    """Percent of reviews that have a result, and its grade."""
    row = reviews.agg(n_rows().alias("reviews")).withColumn("analysed", analysed.agg(n_rows().alias("a")).scalar())
    pct = X.per(F.col("analysed").cast("double"), F.col("reviews")) * 100
    return row.withColumn("coverage_pct", pct).withColumn("grade", B.coverage_grade(pct))


# ---- recommendations, alerts, crawls -------------------------------------
def matrix_stats(ratings: DataFrame) -> DataFrame:
    """Size and sparsity of the user-item ratings, from the long form."""
    row = ratings.agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("product_id").alias("items"), n_rows().alias("ratings"))
    n, u, i = F.col("ratings"), F.col("users"), F.col("items")
    return row.withColumns({
        "sparsity_pct": (1 - n / (u * i)) * 100, "avg_per_user": n / u, "avg_per_item": n / i})


def recommendation_quality(recs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    out = recs.groupBy(*keys).agg(
        n_rows().alias("n"), F.avg("predicted_rating").alias("avg_predicted"), F.avg("confidence").alias("avg_confidence"),
        F.avg("recommendation_score").alias("avg_score"))
    return out.withColumn("grade", B.recommendation_grade(F.round("avg_predicted", 9), F.round("avg_confidence", 9)))


def alert_statistics(alerts: DataFrame, as_of: Column) -> DataFrame:
    """(kind, name, n): alerts per severity and type, open, resolved and last day."""
    day = F.count_if(F.col("ts") > as_of - F.expr("INTERVAL 24 HOURS"))
    flat = alerts.agg(
        n_rows().alias("total"), F.count_if("resolved").alias("resolved"), F.count_if(~F.col("resolved")).alias("active"),
        day.alias("last_24h")).unpivot([], ["total", "resolved", "active", "last_24h"], "name", "n").select(
        F.lit("all").alias("kind"), "name", "n")
    def one(kind: str, column: str) -> DataFrame:
        return alerts.groupBy(column).agg(n_rows().alias("n")).select(F.lit(kind).alias("kind"), F.col(column).alias("name"), "n")
    return flat.unionAll(one("severity", "severity")).unionAll(one("type", "alert_type"))


def label_summary(df: DataFrame, label: str, kind: str) -> DataFrame:
    """Per kind: rows, share of positives and mean text length."""
    return df.groupBy(kind).agg(
        n_rows().alias("n"), F.avg(F.col(label).cast("double")).alias("fake_ratio"),
        F.avg(F.length("review_text")).alias("avg_length"))


def monthly_mean(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.month(date).alias("month")).agg(F.avg("rating").alias("avg_rating"))


def drift_timeline(reports: DataFrame) -> DataFrame:
    return reports.withColumn("drift_pct", F.col("features_with_drift") / F.col("total_features") * 100)


def crawl_sessions(log: DataFrame) -> DataFrame:
    """Per session of a fetch log: requests, successes, reviews, rate."""
    span = F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))
    ok = F.count_if(F.col("status_code") < 400)
    return log.groupBy("session_id").agg(
        n_rows().alias("attempted"), ok.alias("successful"), F.sum("reviews_found").cast("long").alias("reviews"),
        F.count_if(F.col("status_code") >= 400).alias("errors"), F.avg("response_time").alias("avg_response_time"),
        (ok / n_rows() * 100).alias("success_rate"),
        F.when(span > 0, n_rows() / (span / 60e6)).otherwise(F.lit(0.0)).alias("requests_per_minute"))


def product_availability(historical: DataFrame, fresh: DataFrame) -> DataFrame:
    """Historical products with the number of newly seen reviews."""
    seen = fresh.groupBy("product_id").agg(n_rows().alias("new_reviews"))
    return historical.select("product_id").distinct().join(seen, "product_id", "left").select(
        "product_id", F.coalesce("new_reviews", F.lit(0)).alias("new_reviews"),
        F.when(F.col("new_reviews").isNull(), "inactive").otherwise("active").alias("availability"))
