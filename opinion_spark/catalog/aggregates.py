"""Aggregates, joins and windows over the review, metric and crawl views."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.registry import query
from opinion_spark.catalog.results import FAKE_SQL, SENTIMENT_SQL, fake_results, sentiment_results
from opinion_spark.operators import aggregates as G
from opinion_spark.operators import joins as J
from opinion_spark.operators import windows as W
from opinion_spark.operators.cleaning import rating_deviation

CORE = A.reviews_core
TEXT = A.reviews_text
LAST_DAY = "2001-11-04"


@query("popular_products", A.sql("reviews_core", """
SELECT product_id, avg(rating) AS avg_rating, count(*) AS rating_count,
  round(count(*) / (count(*) + 5.0) * avg(rating) + 5.0 / (count(*) + 5.0) * 3.5, 9) AS popularity_score,
  least(count(*) / 100, 1.0) AS confidence
FROM reviews_core GROUP BY product_id HAVING count(*) >= 5
ORDER BY popularity_score DESC, product_id LIMIT 10"""))
def q_popular(spark, sf):
    return G.popular_products(CORE(spark, sf)).withColumn("popularity_score", F.round("popularity_score", 9))


@query("popularity_all_products", A.sql("reviews_core", """
SELECT product_id, avg(rating) AS avg_rating, count(*) AS rating_count,
  round(count(*) / (count(*) + 5.0) * avg(rating) + 5.0 / (count(*) + 5.0) * 3.5, 9) AS popularity_score,
  least(count(*) / 100, 1.0) AS confidence
FROM reviews_core GROUP BY product_id HAVING count(*) >= 5"""))
def q_popularity(spark, sf):
    return G.popularity(CORE(spark, sf)).withColumn("popularity_score", F.round("popularity_score", 9))


@query("products_table", A.sql("reviews_text", """
SELECT product_id, round(avg(rating), 2) AS avg_rating, count(rating) AS total_reviews,
  round(stddev_samp(rating), 2) AS rating_std, count(review_text) AS review_count,
  CAST(max(date) AS DATE) AS last_review_date, 'Food Product ' || product_id AS product_name,
  'Food & Beverages' AS category FROM reviews_text GROUP BY product_id"""))
def q_products(spark, sf):
    return G.products_table(TEXT(spark, sf)).withColumn(
        "last_review_date", F.col("last_review_date").cast("date"))


@query("users_table", A.sql("reviews_text", """
SELECT user_id, round(avg(rating), 2) AS avg_rating_given, count(rating) AS review_count,
  round(avg(length(review_text)), 2) AS avg_review_length, CAST(max(date) AS DATE) AS last_review_date,
  'User_' || user_id AS username FROM reviews_text GROUP BY user_id"""))
def q_users(spark, sf):
    return G.users_table(TEXT(spark, sf)).withColumn("last_review_date", F.col("last_review_date").cast("date"))


@query("product_texts", A.sql("reviews_text", """
SELECT product_id, 0::bigint AS part, md5(string_agg(review_text, ' ' ORDER BY review_id)) AS combined_text,
  avg(rating) AS avg_rating, count(*) AS review_count FROM reviews_text GROUP BY product_id"""))
def q_texts(spark, sf):
    return G.product_texts(TEXT(spark, sf)).withColumn("combined_text", F.md5("combined_text"))


@query("dataset_info", A.sql("reviews_core", """
SELECT count(*) AS total_rows, 7 AS n_columns, CAST(min(review_date) AS DATE) AS first_date,
  CAST(max(review_date) AS DATE) AS last_date, count(DISTINCT product_id) AS n_products,
  count(DISTINCT user_id) AS n_users, 0::bigint AS null_cells FROM reviews_core"""))
def q_info(spark, sf):
    d = G.dataset_info(CORE(spark, sf), "review_date")
    return d.withColumns({c: F.col(c).cast("date") for c in ("first_date", "last_date")})


@query("rating_distribution", A.sql("reviews_core", """
SELECT rating, count(*) AS n, count(*) / (SELECT count(*) FROM reviews_core) * 100 AS percent
FROM reviews_core GROUP BY rating"""))
def q_dist(spark, sf):
    return G.distribution(CORE(spark, sf), "rating")


@query("sample_statistics", A.sql("reviews_text", """
SELECT avg(rating) AS avg_rating, round(stddev_samp(rating), 6) AS rating_std, avg(length(review_text)) AS avg_length,
  avg(len(regexp_extract_all(review_text, '\\S+'))) AS avg_words, count(DISTINCT product_id) AS n_products
FROM reviews_text"""))
def q_stats(spark, sf):
    return G.sample_statistics(TEXT(spark, sf)).withColumn("rating_std", F.round("rating_std", 6))


@query("null_counts", A.sql("raw_reviews", """
SELECT 'UserId' AS column_name, count(*) FILTER (UserId IS NULL) AS nulls FROM raw_reviews
UNION ALL SELECT 'Summary', count(*) FILTER (Summary IS NULL) FROM raw_reviews
UNION ALL SELECT 'Score', count(*) FILTER (Score IS NULL) FROM raw_reviews
UNION ALL SELECT 'Id', 0 FROM (SELECT 1)"""))
def q_nulls(spark, sf):
    return G.null_counts(A.raw_reviews(spark, sf).select("Id", "UserId", "Score", "Summary"))


@query("sentiment_stats", A.sql("reviews_text", """
SELECT count(*) AS total, round(avg(confidence), 6) AS avg_confidence, round(avg(sentiment_score), 6) AS avg_score,
  count(*) FILTER (overall_sentiment = 'POSITIVE') AS positive,
  count(*) FILTER (overall_sentiment = 'NEGATIVE') AS negative,
  count(*) FILTER (overall_sentiment = 'NEUTRAL') AS neutral FROM sentiment""", SENTIMENT_SQL))
def q_sent_stats(spark, sf):
    return G.sentiment_stats(sentiment_results(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("avg_confidence", "avg_score")})


ASPECTS_SQL = """aspect_rows AS (
  SELECT review_id, product_id, unnest(map_keys(aspects)) AS aspect, aspect_score AS sentiment FROM sentiment)"""


@query("aspect_stats", A.sql("reviews_text", """
SELECT aspect, round(avg(sentiment), 6) AS avg_sentiment, count(*) AS mentions FROM aspect_rows GROUP BY aspect""",
    SENTIMENT_SQL, ASPECTS_SQL))
def q_aspects(spark, sf):
    rows = G.aspect_rows(sentiment_results(spark, sf))
    return G.aspect_stats(rows).withColumn("avg_sentiment", F.round("avg_sentiment", 6))


@query("top_aspects_per_product", A.sql("reviews_text", """
SELECT product_id, aspect, round(avg(sentiment), 6) AS avg_sentiment, count(*) AS mentions
FROM aspect_rows GROUP BY product_id, aspect
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, aspect) <= 5""",
    SENTIMENT_SQL, ASPECTS_SQL))
def q_top_aspects(spark, sf):
    rows = G.aspect_rows(sentiment_results(spark, sf), keep=("review_id", "product_id"))
    return G.top_aspects(rows).withColumn("avg_sentiment", F.round("avg_sentiment", 6))


@query("product_core", A.sql("reviews_core", """
SELECT product_id, count(*) AS review_count, avg(rating) AS average_rating FROM reviews_core GROUP BY product_id"""))
def q_core(spark, sf):
    return G.product_core(CORE(spark, sf))


DAILY = f"""daily AS (SELECT product_id, CAST(review_date AS DATE) AS day, count(*) AS review_count,
  avg(rating) AS avg_rating FROM reviews_core
  WHERE CAST(review_date AS DATE) >= DATE '{LAST_DAY}' - 365 GROUP BY ALL)"""


@query("daily_trend", A.sql("reviews_core", "SELECT * FROM daily", DAILY))
def q_daily(spark, sf):
    return G.daily_trend(CORE(spark, sf), "review_date", LAST_DAY, 365)


@query("trend_direction", A.sql("reviews_core", """
SELECT product_id, round(avg(avg_rating) FILTER (o <= 7), 6) AS first_mean,
  round(avg(avg_rating) FILTER (n <= 7), 6) AS last_mean,
  CASE sign(round(avg(avg_rating) FILTER (n <= 7) - avg(avg_rating) FILTER (o <= 7), 9))
    WHEN 1 THEN 'improving' WHEN -1 THEN 'declining' ELSE 'stable' END AS direction
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY day) AS o,
             row_number() OVER (PARTITION BY product_id ORDER BY day DESC) AS n FROM daily)
GROUP BY product_id""", DAILY))
def q_direction(spark, sf):
    daily = G.daily_trend(CORE(spark, sf), "review_date", LAST_DAY, 365)
    return G.trend_direction(daily).withColumns({c: F.round(c, 6) for c in ("first_mean", "last_mean")})


@query("popular_fallback", A.sql("reviews_core", """
SELECT product_id, count(*) AS review_count, avg(rating) AS average_rating FROM reviews_core
GROUP BY product_id HAVING count(*) >= 5
ORDER BY average_rating DESC, review_count DESC, product_id LIMIT 10"""))
def q_fallback(spark, sf):
    return G.popular_fallback(CORE(spark, sf))


@query("search_products", A.sql("reviews_text", """
SELECT product_id, count(*) AS review_count, avg(rating) AS avg_rating,
  arg_min(substr(review_text, 1, 100) || '...', review_id) AS sample_review FROM reviews_text
WHERE review_text ILIKE '%flavor%' OR product_id ILIKE '%flavor%'
GROUP BY product_id ORDER BY review_count DESC, avg_rating DESC, product_id LIMIT 20"""))
def q_search(spark, sf):
    return G.search_products(TEXT(spark, sf), "flavor")


@query("rating_by_length", A.sql("reviews_text", """
SELECT CASE WHEN length(review_text) = 0 THEN NULL WHEN length(review_text) <= 50 THEN 'short'
  WHEN length(review_text) <= 150 THEN 'medium' WHEN length(review_text) <= 500 THEN 'long'
  ELSE 'very_long' END AS length_category, avg(rating) AS avg_rating, count(*) AS n
FROM reviews_text GROUP BY 1"""))
def q_by_length(spark, sf):
    return G.rating_by_length(TEXT(spark, sf))


@query("business_kpis", A.sql("reviews_text", """
SELECT avg(rating) AS avg_rating, avg(CAST(rating >= 4 AS INT)) * 100 AS positive_pct,
  avg(length(review_text)) AS avg_length, count(DISTINCT product_id) AS n_products,
  count(DISTINCT product_id) FILTER (rating >= 4) AS liked_products,
  count(DISTINCT product_id) FILTER (rating <= 2) AS disliked_products,
  round(avg(helpful_votes / greatest(total_votes, 1)) FILTER (helpful_votes > 0), 6) AS avg_helpful_ratio,
  count(*) FILTER (total_votes > 0) AS voted,
  (SELECT rating FROM reviews_text GROUP BY rating ORDER BY count(*) DESC, rating LIMIT 1) AS modal_rating
FROM reviews_text"""))
def q_kpis(spark, sf):
    return G.business_kpis(TEXT(spark, sf)).withColumn("avg_helpful_ratio", F.round("avg_helpful_ratio", 6))


@query("sentiment_by_product", A.sql("reviews_text", """
SELECT product_id, overall_sentiment, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY product_id) * 100 AS percent
FROM sentiment GROUP BY product_id, overall_sentiment""", SENTIMENT_SQL))
def q_sent_product(spark, sf):
    return G.sentiment_by_product(sentiment_results(spark, sf))


@query("fake_by_product", A.sql("reviews_text", """
SELECT product_id, round(avg(fake_probability) * 100, 6) AS fake_pct, count(*) AS checked
FROM fake JOIN reviews_text USING (review_id) GROUP BY product_id""", FAKE_SQL))
def q_fake_product(spark, sf):
    joined = J.with_results(TEXT(spark, sf).select("review_id", "product_id"), fake_results(spark, sf))
    return G.fake_by_product(joined).withColumn("fake_pct", F.round("fake_pct", 6))


@query("risk_distribution", A.sql("reviews_text", """
SELECT risk_level, count(*) AS n, round(avg(fake_probability), 6) AS avg_fake_probability,
  round(avg(confidence), 6) AS avg_confidence FROM fake GROUP BY risk_level""", FAKE_SQL))
def q_risk(spark, sf):
    return G.risk_distribution(fake_results(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("avg_fake_probability", "avg_confidence")})


@query("model_rollup", A.sql("reviews_text", """
SELECT (SELECT round(avg(confidence), 3) FROM sentiment) AS sentiment_confidence,
  (SELECT count(*) FROM sentiment) AS sentiment_rows, round(avg(fake_probability), 3) AS avg_fake_probability,
  round(avg(confidence), 3) AS fake_confidence, count(*) AS fake_rows FROM fake""", SENTIMENT_SQL, FAKE_SQL))
def q_rollup(spark, sf):
    return G.model_rollup(sentiment_results(spark, sf), fake_results(spark, sf))


@query("analysis_coverage", """
SELECT (SELECT count(*) FROM documents) AS reviews, count(*) AS analysed,
  count(*) / (SELECT count(*) FROM documents) * 100 AS coverage_pct,
  CASE WHEN count(*) / (SELECT count(*) FROM documents) * 100 > 80 THEN 'Excellent'
       WHEN count(*) / (SELECT count(*) FROM documents) * 100 > 50 THEN 'Good' ELSE 'Limited' END AS grade
FROM labels""")
def q_coverage(spark, sf):
    return G.coverage(A.read(spark, sf, "documents"), A.read(spark, sf, "labels"))


@query("rating_matrix_stats", A.sql("reviews_core", """
SELECT u AS users, i AS items, n AS ratings, (1 - n / (u * i)) * 100 AS sparsity_pct,
  n / u AS avg_per_user, n / i AS avg_per_item
FROM (SELECT count(DISTINCT user_id) AS u, count(DISTINCT product_id) AS i,
             count(DISTINCT (user_id, product_id)) AS n FROM reviews_core)"""))
def q_matrix(spark, sf):
    return G.matrix_stats(CORE(spark, sf).select("user_id", "product_id").distinct())


@query("label_summary", A.sql("reviews_text fake_labels", """
SELECT lang, count(*) AS n, avg(is_fake::double) AS fake_ratio, avg(length(review_text)) AS avg_length
FROM fake_labels GROUP BY lang"""))
def q_labels(spark, sf):
    return G.label_summary(A.fake_labels(spark, sf), "is_fake", "lang")


@query("monthly_mean_rating", A.sql("reviews_core", """
SELECT CAST(month(review_date) AS INT) AS month, avg(rating) AS avg_rating FROM reviews_core GROUP BY 1"""))
def q_monthly(spark, sf):
    return G.monthly_mean(CORE(spark, sf), "review_date")


@query("drift_timeline", A.sql("metric_stream", """
SELECT CAST(ts AS DATE) AS day, count(*) FILTER (status <> 'healthy') AS features_with_drift,
  count(*) AS total_features, count(*) FILTER (status <> 'healthy') / count(*) * 100 AS drift_pct
FROM metric_stream GROUP BY 1"""))
def q_timeline(spark, sf):
    reports = A.metric_stream(spark, sf).groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("status") != "healthy").alias("features_with_drift"), F.count(F.lit(1)).alias("total_features"))
    return G.drift_timeline(reports)


@query("crawl_sessions", A.sql("fetch_log", """
SELECT session_id, count(*) AS attempted, count(*) FILTER (status_code < 400) AS successful,
  CAST(sum(reviews_found) AS BIGINT) AS reviews, count(*) FILTER (status_code >= 400) AS errors,
  round(avg(response_time), 6) AS avg_response_time, count(*) FILTER (status_code < 400) / count(*) * 100 AS success_rate,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 60e6), 9) AS requests_per_minute
FROM fetch_log GROUP BY session_id"""))
def q_sessions(spark, sf):
    return G.crawl_sessions(A.fetch_log(spark, sf)).withColumns({
        "avg_response_time": F.round("avg_response_time", 6), "requests_per_minute": F.round("requests_per_minute", 9)})


@query("product_availability", A.sql("reviews_core", """
SELECT product_id, coalesce(n, 0) AS new_reviews, CASE WHEN n IS NULL THEN 'inactive' ELSE 'active' END AS availability
FROM (SELECT DISTINCT product_id FROM reviews_core) LEFT JOIN (
  SELECT product_id, count(*) AS n FROM reviews_core WHERE review_date >= TIMESTAMP '2001-06-01' GROUP BY 1)
USING (product_id)"""))
def q_avail(spark, sf):
    r = CORE(spark, sf)
    return G.product_availability(r, r.where(F.col("review_date") >= "2001-06-01"))


# ---- joins ----------------------------------------------------------------
@query("reviews_with_sentiment", A.sql("reviews_text", """
SELECT review_id, r.rating, overall_sentiment, confidence FROM reviews_text r JOIN sentiment USING (review_id)""",
    SENTIMENT_SQL))
def q_join_sent(spark, sf):
    return J.with_results(
        TEXT(spark, sf).select("review_id", "rating"),
        sentiment_results(spark, sf).select("review_id", "overall_sentiment", "confidence"))


@query("reviews_with_fake_result", A.sql("reviews_text", """
SELECT review_id, r.rating, fake_probability, risk_level FROM reviews_text r JOIN fake USING (review_id)""", FAKE_SQL))
def q_join_fake(spark, sf):
    return J.with_results(
        TEXT(spark, sf).select("review_id", "rating"),
        fake_results(spark, sf).select("review_id", "fake_probability", "risk_level"))


@query("user_review_counts", A.sql("reviews_core", """
SELECT review_id, user_id, count(*) OVER (PARTITION BY user_id) AS user_review_count FROM reviews_core"""))
def q_user_counts(spark, sf):
    return J.with_user_count(CORE(spark, sf).select("review_id", "user_id"))


@query("product_name_lookup", A.sql("reviews_core", """
SELECT review_id, product_id, coalesce(p_name, 'Product ' || product_id) AS product_name
FROM reviews_core LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON product_id = p_partkey"""))
def q_names(spark, sf):
    names = A.read(spark, sf, "part").where("p_size > 10").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
    return J.with_product_name(CORE(spark, sf).select("review_id", "product_id"), names)


@query("user_exists", A.sql("reviews_core", """
SELECT c_custkey AS user_id, c_custkey IN (SELECT user_id FROM reviews_core) AS found FROM customer"""))
def q_exists(spark, sf):
    wanted = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return J.key_exists(CORE(spark, sf).select("user_id"), wanted, "user_id")


@query("metrics_above_threshold", A.sql("metric_stream", """
SELECT event_id, metric_name, metric_value, threshold FROM metric_stream JOIN (VALUES
  ('cpu_usage', 85.0::double), ('memory_usage', 85.0), ('disk_usage', 90.0)) t(metric_name, threshold) USING (metric_name)
WHERE metric_value > threshold"""))
def q_threshold(spark, sf):
    return J.above_threshold(
        A.metric_stream(spark, sf).select("event_id", "metric_name", "metric_value"), J.L.SYSTEM_THRESHOLDS)


# ---- windows --------------------------------------------------------------
@query("rating_deviation", A.sql("reviews_core", """
SELECT review_id, round(rating - avg(rating) OVER (PARTITION BY product_id), 9) AS rating_deviation FROM reviews_core"""))
def q_deviation(spark, sf):
    return rating_deviation(CORE(spark, sf).select("review_id", "product_id", "rating")).select(
        "review_id", F.round("rating_deviation", 9).alias("rating_deviation"))


@query("global_rating_deviation", A.sql("reviews_core", """
SELECT review_id, abs(rating - (SELECT avg(rating) FROM reviews_core)) AS rating_deviation FROM reviews_core"""))
def q_global(spark, sf):
    return W.deviation_from_global_mean(CORE(spark, sf).select("review_id", "rating")).drop("rating")


@query("blocking_score", A.sql("fetch_log", """
SELECT session_id, request_id, error_rate, CASE WHEN rn >= 10 THEN score ELSE 0.0 END AS confidence,
  rn >= 10 AND score > 0.5 AS blocked
FROM (SELECT session_id, request_id, error_rate, rn, (CAST(error_rate > 0.5 AS INT)
        + CAST(round(recent, 9) > round(mean * 2, 9) AS INT) + CAST(many > 3 AS INT)) / 3 AS score
  FROM (SELECT session_id, request_id, row_number() OVER w AS rn,
    avg(CAST(status_code >= 400 AS INT)) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS error_rate,
    sum(CAST(status_code = 429 AS INT)) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS many,
    sum(response_time) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) / 10 AS recent,
    avg(response_time) OVER (w ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS mean
  FROM fetch_log WINDOW w AS (PARTITION BY session_id ORDER BY ts, md5(request_id::varchar), request_id)))"""))
def q_blocking(spark, sf):
    return W.blocking_score(A.fetch_log(spark, sf), block=200)


@query("rate_utilisation", A.sql("fetch_log", """
SELECT session_id, request_id, count(*) OVER w AS current_requests, count(*) OVER w / 10 AS utilisation
FROM fetch_log WINDOW w AS (PARTITION BY session_id ORDER BY epoch_us(ts)
  RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)"""))
def q_rate(spark, sf):
    return W.rate_utilisation(A.fetch_log(spark, sf), "session_id", 3600, 10, block_seconds=86_400)


@query("seconds_since_previous", A.sql("metric_stream", """
SELECT event_id, round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY metric_name, component
  ORDER BY ts, event_id))) / 1e6, 6) AS seconds_since_previous FROM metric_stream"""))
def q_previous(spark, sf):
    return W.seconds_since_previous(A.metric_stream(spark, sf), ["metric_name", "component"]).select(
        "event_id", F.round("seconds_since_previous", 6).alias("seconds_since_previous"))


@query("user_bursts", A.sql("reviews_core", """
SELECT user_id, n AS reviews, busiest_day, days AS days_active, n / days AS reviews_per_day,
  (n - pairs) / n AS repeat_ratio, round(v, 6) AS rating_variance
FROM (SELECT user_id, count(*) AS n, CAST(date_diff('day', min(review_date), max(review_date)) + 1 AS INT) AS days,
        count(DISTINCT product_id) AS pairs, var_samp(rating) AS v FROM reviews_core GROUP BY 1)
JOIN (SELECT user_id, max(c) AS busiest_day FROM (SELECT user_id, count(*) AS c FROM reviews_core
      GROUP BY user_id, CAST(review_date AS DATE)) GROUP BY 1) USING (user_id)"""))
def q_bursts(spark, sf):
    return W.user_bursts(CORE(spark, sf), "review_date").withColumn("rating_variance", F.round("rating_variance", 6))
