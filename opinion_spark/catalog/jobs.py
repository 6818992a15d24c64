"""Fake-detection, HTML, streaming and whole-job queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.features import TEXT_FEATURES
from opinion_spark.catalog.registry import query
from opinion_spark.catalog.results import FAKE_SQL, SENTIMENT_SQL, fake_results, sentiment_results
from opinion_spark.catalog.serve import COOLED, RAISED
from opinion_spark.operators import alerts as X
from opinion_spark.operators import fakes as M
from opinion_spark.operators import recommend as R
from opinion_spark.operators import sentiment as N
from opinion_spark.plans import jobs as J
from opinion_spark.session import checkpoint_dir, materialize, spread
from opinion_spark.sources import html as H
from opinion_spark.sources import tables as S
from opinion_spark.streaming import metrics as W

TEXT = A.reviews_text

# ---- fake features ---------------------------------------------------------
_SQL = {name: pair[1] for name, pair in TEXT_FEATURES.items()}
_TEXT_SQL = {
    "text_length": _SQL["char_count"], "text_word_count": _SQL["token_count"],
    "text_sentence_count": _SQL["sentence_count_pieces"], "text_avg_word_length": _SQL["avg_token_length"],
    "text_caps_ratio": _SQL["caps_ratio"], "text_punct_ratio": _SQL["mark_ratio"],
    "text_exclamation_ratio": _SQL["exclamation_ratio"],
    "text_generic_food_phrase_count": _SQL["phrase_hits_generic"], "text_spam_indicator_count": _SQL["phrase_hits_spam"],
    "text_excessive_punct_count": _SQL["phrase_hits_punctuation"],
    "text_competitor_keyword_count": _SQL["phrase_hits_competitor"], "text_food_spam_count": _SQL["phrase_hits_food_spam"],
    "text_sentiment_compound": _SQL["polarity_compound"],
    "text_sentiment_extreme": f"CAST(abs({_SQL['polarity_compound']}) > 0.8 AS INT)",
}
ALL_FEATURES = """features AS (
  SELECT review_id, """ + ", ".join(f"({sql})::double AS {name}" for name, sql in _TEXT_SQL.items()) + """,
    u.n::double AS user_review_count, u.a AS user_avg_rating, coalesce(u.v, 1.0) AS user_rating_variance,
    u.days::double AS user_days_active, u.n / u.days AS user_reviews_per_day,
    rating::double AS review_rating, helpful_votes::double AS review_helpful_votes,
    total_votes::double AS review_total_votes, helpful_votes / greatest(total_votes, 1) AS review_helpfulness_ratio,
    rating - avg(rating) OVER (PARTITION BY product_id) AS review_rating_deviation
  FROM reviews_text JOIN (SELECT user_id, count(*) AS n, avg(rating) AS a, var_samp(rating) AS v,
    date_diff('day', min(date), max(date)) + 1 AS days FROM reviews_text GROUP BY 1) u USING (user_id))"""


@query("fake_features", A.sql(
    "reviews_text", "SELECT review_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in M.FEATURES) + " FROM features",
    ALL_FEATURES))
def q_features(spark, sf):
    f = M.all_features(TEXT(spark, sf))
    return f.select("review_id", *[F.round(c, 6).alias(c) for c in M.FEATURES])


@query("user_behaviour", A.sql("reviews_core", """
SELECT user_id, n::double AS user_review_count, a AS user_avg_rating, round(v, 6) AS user_rating_variance,
  days::double AS user_days_active, n / days AS user_reviews_per_day
FROM (SELECT user_id, count(*) AS n, avg(rating) AS a, var_samp(rating) AS v,
  date_diff('day', min(review_date), max(review_date)) + 1 AS days FROM reviews_core GROUP BY 1)"""))
def q_behaviour(spark, sf):
    return M.user_behaviour(A.reviews_core(spark, sf), "review_date").withColumn(
        "user_rating_variance", F.round("user_rating_variance", 6))


@query("ordered_features", A.sql("reviews_text", """
SELECT review_id, length(review_text)::double AS text_length, 0.0::double AS user_review_count,
  coalesce(nullif(rating, 3), 0)::double AS review_rating FROM reviews_text"""))
def q_ordered(spark, sf):
    src = TEXT(spark, sf).select(
        "review_id", F.length("review_text").alias("text_length"),
        F.when(F.col("rating") != 3, F.col("rating")).alias("review_rating"))
    return M.ordered_features(src).select("review_id", "text_length", "user_review_count", "review_rating")


def _labelled(spark, sf) -> DataFrame:
    labels = A.read(spark, sf, "labels").select(
        F.col("doc_id").alias("review_id"), (1 - F.col("quality")).alias("is_fake"))
    return M.all_features(TEXT(spark, sf)).join(labels, "review_id")


@query("fake_training_set", A.sql("reviews_text fake_labels", """
SELECT label, count(*) AS n, round(avg(text_length), 6) AS avg_length FROM (
  SELECT 0.0::double AS label, text_length FROM (SELECT f.* FROM features f JOIN fake_labels USING (review_id) WHERE is_fake = 0
    ORDER BY md5(review_id || 'real'), review_id LIMIT 100)
  UNION ALL SELECT 1.0, text_length FROM (SELECT f.* FROM features f JOIN fake_labels USING (review_id) WHERE is_fake = 1
    ORDER BY md5(review_id || 'fake'), review_id LIMIT 100)) GROUP BY label""", ALL_FEATURES))
def q_training(spark, sf):
    f = _labelled(spark, sf)
    data = M.training_set(f.where("is_fake = 0"), f.where("is_fake = 1"), 200)
    return data.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("text_length"), 6).alias("avg_length"))


_FITS: dict[tuple[str, str], tuple] = {}


def _trained(spark, sf):
    """Features, model, cross-validation and metrics; fitted once for each session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITS:
        _FITS[key] = _fit(spark, sf)
    return _FITS[key]


def _fit(spark, sf):
    features = materialize(M.all_features(TEXT(spark, sf)))
    labels = A.read(spark, sf, "labels").select(
        F.col("doc_id").alias("review_id"), (1 - F.col("quality")).alias("is_fake"))
    marked = features.join(labels, "review_id")
    data = materialize(M.training_set(marked.where("is_fake = 0"), marked.where("is_fake = 1")))
    return features, *M.train(data), data


@query("fake_model_metrics")
def q_metrics(spark, sf):
    return _trained(spark, sf)[3]


@query("fake_predictions")
def q_predictions(spark, sf):
    """Train, save, load again, score every review."""
    features, model, *_ = _trained(spark, sf)
    path = f"{checkpoint_dir(spark)}/fake-model-{uuid.uuid4().hex}"
    M.save_model(model, path)
    return M.predict(M.load_model(path), features)


@query("fake_feature_importance")
def q_importance(spark, sf):
    return M.importances(_trained(spark, sf)[1], spark)


@query("save_fake_results", A.sql("reviews_text", """
SELECT review_id, CASE WHEN fake_probability > 0.7 THEN 2 ELSE 1 END AS version, risk_level FROM fake""", FAKE_SQL))
def q_save(spark, sf):
    first = fake_results(spark, sf).withColumn("version", F.lit(1))
    again = first.where("fake_probability > 0.7").withColumn("version", F.lit(2))
    return S.upsert(first, again, ["review_id"], [F.desc("version")]).select("review_id", "version", "risk_level")


# ---- HTML ------------------------------------------------------------------
def _escaped(c: str):
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def review_pages(spark, sf) -> DataFrame:
    """The review texts put into review-page markup; some pages leave a paragraph, a cell or the container open."""
    r = TEXT(spark, sf)
    return r.select(
        F.col("review_id").alias("page_id"), "product_id",
        F.concat(
            F.lit('<html><body><div data-hook="review" class="a-section review"><span class="a-profile-name">'),
            F.col("user_id"), F.lit('</span><i class="a-icon a-icon-star a-star-'), F.col("rating").cast("string"),
            F.lit('"></i><a data-hook="review-title"><span>5.0 out of 5 stars</span> Title '), F.col("user_id"),
            F.lit('</a><span data-hook="review-date">Reviewed in the United States on '),
            F.date_format("date", "MMMM d, yyyy"), F.lit("</span>"),
            F.when(r.review_id % 2 == 0, "<p><li><td>").otherwise(""), F.lit('<span data-hook="review-body">'),
            _escaped("review_text"), F.lit('</span><span data-hook="helpful-vote-statement">'),
            F.when(F.col("helpful_votes") == 1, "One person found this helpful").otherwise(
                F.concat(F.col("helpful_votes").cast("string"), F.lit(" people found this helpful"))),
            F.lit("</span>"), F.when(r.review_id % 5 == 0, "").otherwise("</div></body></html>")).alias("html"))


@query("extract_page_reviews", A.sql("reviews_text", r"""
SELECT review_id AS page_id, product_id, user_id, rating, 'Title ' || user_id AS review_title, helpful_votes,
  md5(body) AS review_text, helpful_votes AS total_votes, CAST(date AS DATE) AS review_date, false AS verified_purchase
FROM (SELECT *, regexp_replace(review_text, '^\s+|\s+$', '', 'g') AS body FROM reviews_text) WHERE length(body) >= 10"""))
def q_extract(spark, sf):
    return H.extract_reviews(review_pages(spark, sf), "2013-01-01").withColumn("review_text", F.md5("review_text"))


@query("page_fields", r"""
SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
  md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'),
    '^ | $', '', 'g')) AS visible_text,
  CAST(len(regexp_extract_all(html, '(?i)<p[ >]')) AS INT) AS paragraphs FROM pages""")
def q_page_fields(spark, sf):
    return H.page_fields(spread(A.read(spark, sf, "pages").select("page_id", "html"), "page_id")).withColumn("visible_text", F.md5("visible_text"))


@query("review_urls", A.sql("reviews_core", """
SELECT product_id, page::int AS page, 'https://shop.example/product-reviews/' || product_id || '?pageNumber=' || page AS url
FROM (SELECT product_id, unnest(range(1, 1 + greatest(1, ceil(count(*) / 10))::int)) AS page FROM reviews_core
      GROUP BY product_id)"""))
def q_urls(spark, sf):
    products = A.reviews_core(spark, sf).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return H.review_urls(products, "https://shop.example", F.col("n"))


# ---- streams ---------------------------------------------------------------
def _events_stream(spark, sf) -> DataFrame:
    return A.metric_rows(W.read_table(spark, sf, "events"))


def _run(spark, stream: DataFrame, build, name: str) -> DataFrame:
    """All of a stream, to the last window."""
    base = f"{checkpoint_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    W.write_all(build, stream, f"{base}/out", f"{base}/state", f"{base}/markers")
    return spark.read.schema(build(stream).schema).parquet(f"{base}/out")


@query("stream_recent_metrics", A.sql("metric_stream", """
SELECT epoch(time_bucket(INTERVAL '1 hour', ts))::bigint AS window_start, metric_name, count(*) AS n,
  round(avg(metric_value), 6) AS avg_value FROM metric_stream GROUP BY 1, 2"""))
def q_stream_windows(spark, sf):
    out = _run(spark, _events_stream(spark, sf), W.windowed_metrics, "windows")
    return out.select(F.unix_timestamp("window_start").alias("window_start"), "metric_name", "n",
                      F.round("avg_value", 6).alias("avg_value"))


@query("stream_alert_cooldown", A.sql("metric_stream", """
SELECT event_id, alert_type, component FROM cooled""",
    RAISED, COOLED, recursive=True))
def q_stream_cooldown(spark, sf):
    out = _run(spark, X.raised_alerts(_events_stream(spark, sf)), W.cooled_alerts, "cooldown")
    return out.select("event_id", "alert_type", "component")


@query("stream_escalations", A.sql("metric_stream", """
SELECT alert_type || '_' || component || '_' || CAST(floor(epoch(ts)) AS BIGINT) AS alert_id, epoch_us(min(ts)) AS raised
FROM raised GROUP BY 1""", RAISED))
def q_stream_escalations(spark, sf):
    raised = X.raised_alerts(_events_stream(spark, sf)).select("alert_id", "alert_type", "ts")
    return _run(spark, raised.withColumn("kind", F.lit("raised")), W.escalations, "escalation")


@query("stream_score_reviews", A.sql("reviews_text", """
SELECT review_id, overall_sentiment, confidence FROM sentiment""", SENTIMENT_SQL))
def q_stream_score(spark, sf):
    raw = W.read_table(spark, sf, "documents")
    base = f"{checkpoint_dir(spark)}/stream-score-{uuid.uuid4().hex}"
    W.score_live_reviews(A.text_rows(raw), N.analyze, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("review_id", "overall_sentiment", "confidence")


@query("stream_monitoring_cycle", A.sql("metric_stream", """
SELECT count(*) FILTER (metric_name <> 'health') AS metrics_collected, count(*) FILTER (metric_name = 'health') AS health_checks,
  (SELECT count(*) FROM raised) AS alerts_raised FROM metric_stream""", RAISED))
def q_stream_cycle(spark, sf):
    base = f"{checkpoint_dir(spark)}/stream-cycle-{uuid.uuid4().hex}"
    W.monitoring_cycle(_events_stream(spark, sf), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out/summary").select("metrics_collected", "health_checks", "alerts_raised")


# ---- whole jobs ------------------------------------------------------------
@query("product_analytics", A.sql("reviews_text", """
SELECT product_id, review_count, average_rating, round(fake_pct, 6) AS fake_pct, round(positive_pct, 6) AS positive_pct,
  aspects AS top_aspects, trend_days,
  CASE WHEN fake_pct < 2 THEN 'LOW' WHEN fake_pct < 5 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_band FROM
  (SELECT product_id, count(*) AS review_count, avg(rating) AS average_rating FROM reviews_text GROUP BY 1)
  JOIN (SELECT product_id, avg(fake_probability) * 100 AS fake_pct FROM fake JOIN reviews_text USING (review_id) GROUP BY 1)
    USING (product_id)
  JOIN (SELECT product_id, count(*) FILTER (overall_sentiment = 'POSITIVE') / count(*) * 100 AS positive_pct
    FROM sentiment GROUP BY 1) USING (product_id)
  LEFT JOIN (SELECT product_id, string_agg(aspect, ',' ORDER BY n DESC, aspect) AS aspects FROM (
    SELECT product_id, aspect, count(*) AS n FROM (SELECT product_id, unnest(map_keys(aspects)) AS aspect FROM sentiment)
    GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, aspect) <= 5) GROUP BY 1)
    USING (product_id)
  LEFT JOIN (SELECT product_id, count(DISTINCT CAST(date AS DATE))::int AS trend_days FROM reviews_text
    WHERE CAST(date AS DATE) >= DATE '2012-12-31' - 30 GROUP BY 1) USING (product_id)""", SENTIMENT_SQL, FAKE_SQL))
def q_analytics(spark, sf):
    reviews = TEXT(spark, sf)
    fake = reviews.select("review_id", "product_id").join(fake_results(spark, sf), "review_id")
    out = J.product_analytics(reviews, sentiment_results(spark, sf), fake, "date", "2012-12-31")
    return out.select(
        "product_id", "review_count", "average_rating", F.round("fake_pct", 6).alias("fake_pct"),
        F.round(F.coalesce(F.try_element_at("sentiment_pct", F.lit("POSITIVE")), F.lit(0.0)), 6).alias("positive_pct"),
        F.array_join("top_aspects", ",").alias("top_aspects"),
        F.when(F.col("trend").isNotNull(), F.size("trend")).alias("trend_days"), "risk_band")


@query("etl_report")
def q_etl(spark, sf):
    from opinion_spark.catalog.cleaning import AS_OF, standard
    return J.run_etl(standard(spark, sf), f"{checkpoint_dir(spark)}/etl-{uuid.uuid4().hex}", AS_OF, target=None)


@query("training_run_report")
def q_training_run(spark, sf):
    labels = A.read(spark, sf, "labels").select(
        F.col("doc_id").alias("review_id"), (1 - F.col("quality")).alias("is_fake"))
    return J.run_training(
        TEXT(spark, sf), labels, f"{checkpoint_dir(spark)}/training-{uuid.uuid4().hex}")


@query("validation_run_report")
def q_validation_run(spark, sf):
    """All three models; the detector is judged by its own scores of the rows it was not fitted on."""
    _, model, _, _, data = _trained(spark, sf)
    fakes = M.predict(model, M.held_out(data), keep=("review_id", "label")).withColumnRenamed("label", "is_fake")
    ratings = R.user_item_ratings(A.reviews_core(spark, sf))
    recs = R.popular_for(ratings.select("user_id").distinct(), R.popular(A.reviews_core(spark, sf)))
    wanted = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return J.run_validation(
        sentiment_results(spark, sf).select("rating", "overall_sentiment", "confidence"), fakes, wanted, recs)


# ---- sinks, read back ------------------------------------------------------
def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_scan", """SELECT doc_id, md5(text) AS text, lang, n_chars FROM documents""")
def q_csv(spark, sf):
    """Documents written as CSV, line breaks and quotes included, and scanned."""
    docs = A.read(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    path = _scratch(spark, "csv")
    docs.write.option("header", True).option("escape", '"').csv(path)
    return S.read_csv(spark, path, "doc_id long, text string, lang string, n_chars long").withColumn("text", F.md5("text"))


@query("load_reviews", A.sql("reviews_text", """
SELECT product_id, user_id, rating, md5(review_text) AS review_text, CAST(date AS DATE) AS date FROM reviews_text"""))
def q_load(spark, sf):
    """The first existing of several candidate files, standardised."""
    path = _scratch(spark, "primary")
    TEXT(spark, sf).select(
        F.col("review_id").alias("Id"), F.col("product_id").alias("ProductId"), F.col("user_id").alias("UserId"),
        F.col("rating").alias("Score"), F.unix_timestamp("date").alias("Time"), F.col("review_text").alias("Text")
    ).write.option("header", True).option("escape", '"').csv(path)
    schema = "Id long, ProductId string, UserId string, Score int, Time long, Text string"
    df, _ = S.load_reviews(spark, [(f"{path}-absent", schema), (path, schema)], "2013-01-01")
    return df.select("product_id", "user_id", "rating", F.md5("review_text").alias("review_text"),
                     F.col("date").cast("date").alias("date"))


@query("table_replace_and_append", """
SELECT lang, 2 * count(*) AS n FROM documents GROUP BY lang""")
def q_sink(spark, sf):
    path = _scratch(spark, "table")
    docs = A.read(spark, sf, "documents").select("doc_id", "lang")
    S.write_table(docs.withColumn("lang", F.lit("old")), path)
    S.write_table(docs, path)
    S.append_table(docs, path)
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("json_report", A.sql("reviews_core", """
SELECT rating, count(*) AS n FROM reviews_core GROUP BY rating"""))
def q_json_report(spark, sf):
    path = _scratch(spark, "report")
    S.write_report(A.reviews_core(spark, sf).groupBy("rating").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("rating int, n long").json(path)


@query("training_export", A.sql("reviews_text fake_labels", """
SELECT is_fake, rating, count(*) AS n FROM fake_labels GROUP BY ALL"""))
def q_export(spark, sf):
    path = _scratch(spark, "export")
    S.write_training_csv(A.fake_labels(spark, sf), path, ["review_id", "rating", "is_fake"])
    back = spark.read.schema("review_id long, rating int, is_fake int").option("header", True).csv(f"{path}/features")
    return back.groupBy("is_fake", "rating").agg(F.count(F.lit(1)).alias("n"))


@query("save_drift_results")
def q_save_drift(spark, sf):
    """Two analyses saved; the detail rows of both and one report row each."""
    path = _scratch(spark, "drift")
    results, report = J.run_drift(A.text_sides(spark, sf))
    for analysis in ("first", "second"):
        J.save_drift(spark, results, report, analysis, path)
    detail = spark.read.parquet(f"{path}/drift_results").groupBy("analysis_id").agg(F.count(F.lit(1)).alias("rows"))
    return detail.join(spark.read.parquet(f"{path}/drift_analysis").select("analysis_id", "severity"), "analysis_id")


@query("replace_stored_recommendations", A.sql("reviews_core", """
SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, product_id FROM reviews_core
  WHERE review_date >= TIMESTAMP '2000-01-01' OR user_id NOT IN (
    SELECT user_id FROM reviews_core WHERE review_date >= TIMESTAMP '2000-01-01')) GROUP BY user_id"""))
def q_replace_recs(spark, sf):
    path = _scratch(spark, "recs")
    r = A.reviews_core(spark, sf)
    old, new = (r.where(c).select("user_id", "product_id").distinct() for c in (
        "review_date < '2000-01-01'", "review_date >= '2000-01-01'"))
    J.replace_recommendations(old, new, path)
    return spark.read.parquet(path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
