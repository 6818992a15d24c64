"""Quality, sentiment, evaluation and drift queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.features import BL, ISSUES_CTE, WORDS, count_sql, hits_sql
from opinion_spark.catalog.registry import query
from opinion_spark.catalog.results import FAKE_SQL, SENTIMENT_SQL, fake_results, sentiment_results
from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.operators import drift as T
from opinion_spark.operators import evaluate as E
from opinion_spark.operators import quality as Q
from opinion_spark.operators import sentiment as N
from opinion_spark.plans.jobs import run_drift
from opinion_spark.session import spread
from opinion_spark.sources import tables as S

CORE, TEXT = A.reviews_core, A.reviews_text


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---- quality ---------------------------------------------------------------
def _checked(spark, sf):
    r = A.raw_reviews(spark, sf)
    return r.select(
        F.when(F.col("Id") % 10 == 0, "").otherwise(F.col("ProductId")).alias("product_id"),
        F.col("Score").try_cast("double").alias("rating"), F.col("Text").alias("review_text"),
        F.col("UserId").alias("user_id"),
        F.when(F.col("UserId").isNull(), "soon").otherwise("2012-01-01").alias("review_date"))


CHECKED = """checked AS (SELECT CASE WHEN Id % 10 = 0 THEN '' ELSE ProductId END AS product_id,
  try_cast(Score AS double) AS rating, "Text" AS review_text, UserId AS user_id FROM raw_reviews)"""


@query("review_report", A.sql("raw_reviews", f"""
SELECT count(*) AS total_rows,
  count(*) FILTER (coalesce(rating BETWEEN 1 AND 5, false) AND product_id <> ''
    AND regexp_matches(review_text, '[^{BL}]')) AS valid_rows,
  count(*) FILTER (NOT coalesce(rating BETWEEN 1 AND 5, false)) AS invalid_ratings,
  count(*) FILTER (product_id = '') AS missing_product_ids,
  count(*) FILTER (NOT regexp_matches(review_text, '[^{BL}]')) AS empty_texts,
  count(*) FILTER (user_id IS NULL) AS invalid_dates, avg(length(review_text)) AS avg_review_length,
  round((count(*) FILTER (rating IS NULL) + count(*) FILTER (user_id IS NULL)) / (count(*) * 5) * 100, 6) AS missing_pct,
  1 AS errors, 3 AS warnings,
  count(*) - count(DISTINCT (product_id, rating, review_text, user_id)) AS duplicate_rows FROM checked""", CHECKED))
def q_review_report(spark, sf):
    return rounded(Q.review_report(_checked(spark, sf)), "missing_pct")


def _named(spark, sf):
    part = A.read(spark, sf, "part")
    return part.select(
        (F.col("p_partkey") - F.col("p_partkey") % 2 * (F.col("p_size") % 2)).alias("product_id"),
        F.when(F.col("p_size") == 1, " ").otherwise(F.col("p_name")).alias("name"))


@query("product_report", """
WITH named AS (SELECT p_partkey - p_partkey % 2 * (p_size % 2) AS product_id,
                      CASE WHEN p_size = 1 THEN ' ' ELSE p_name END AS name FROM part)
SELECT count(*) AS total_rows, count(*) FILTER (name <> ' ') AS valid_rows,
  count(*) FILTER (name = ' ') AS missing_names, count(*) - count(DISTINCT product_id) AS duplicate_ids FROM named""")
def q_product_report(spark, sf):
    return Q.product_report(_named(spark, sf).withColumn("product_id", F.col("product_id").cast("string")))


@query("validation_report_by_type")
def q_validation(spark, sf):
    return Q.validation_report(_checked(spark, sf), "review")


@query("dataset_checks", A.sql("reviews_text", """
SELECT 'required_columns' AS check_name, true AS passed, 'All required columns present' AS message
UNION ALL SELECT 'data_types', true, 'Rating column has valid integers 1-5'
UNION ALL SELECT 'non_empty', true, 'Food reviews dataset has ' || count(*) || ' rows' FROM reviews_text
UNION ALL SELECT 'text_quality', avg(length(review_text)) >= 20,
  'Average food review length: ' || printf('%.1f', avg(length(review_text))) || ' chars' FROM reviews_text
UNION ALL SELECT 'rating_distribution', count(DISTINCT rating) >= 3, 'Distinct ratings: ' || count(DISTINCT rating)
FROM reviews_text"""))
def q_checks(spark, sf):
    return Q.dataset_checks(TEXT(spark, sf))


@query("check_pass_summary", """
SELECT 5::bigint AS total, 5::bigint AS passed_checks, 1.0::double AS pass_rate, 'ALL_PASS' AS verdict FROM
  (SELECT count(*) FROM documents)""")
def q_pass(spark, sf):
    return Q.pass_summary(Q.dataset_checks(TEXT(spark, sf)))


@query("completeness", A.sql("raw_reviews", """
SELECT 1 - (count(*) FILTER (UserId IS NULL) + count(*) FILTER (Summary IS NULL)) / (count(*) * 9) AS completeness
FROM raw_reviews"""))
def q_complete(spark, sf):
    return Q.completeness(A.raw_reviews(spark, sf))


@query("consistency", A.sql("reviews_text", """
SELECT round((avg(CAST(rating BETWEEN 1 AND 5 AS INT)) + avg(CAST(length(review_text) BETWEEN 10 AND 5000 AS INT))) / 2, 9)
  AS consistency FROM reviews_text"""))
def q_consistent(spark, sf):
    return rounded(Q.consistency(TEXT(spark, sf)), "consistency", digits=9)


@query("timeliness", A.sql("reviews_core", """
SELECT greatest(0.0, 1 - date_diff('day', CAST(max(review_date) AS DATE), DATE '2002-03-01') / 365) AS timeliness,
  CAST(date_diff('day', CAST(max(review_date) AS DATE), DATE '2002-03-01') AS INT) AS days_old FROM reviews_core"""))
def q_timely(spark, sf):
    return Q.timeliness(CORE(spark, sf), "review_date", "2002-03-01")


@query("overall_quality", A.sql("reviews_text", """
SELECT *, round((completeness + consistency + accuracy + timeliness) / 4, 9) AS overall FROM (
  SELECT 1.0::double AS completeness, 0.8::double AS accuracy,
    (avg(CAST(rating BETWEEN 1 AND 5 AS INT)) + avg(CAST(length(review_text) BETWEEN 10 AND 5000 AS INT))) / 2
      AS consistency,
    greatest(0.0, 1 - date_diff('day', CAST(max(date) AS DATE), DATE '2013-01-01') / 365) AS timeliness
  FROM reviews_text)"""))
def q_overall(spark, sf):
    return rounded(Q.overall_quality(TEXT(spark, sf), "date", "2013-01-01"), "overall", digits=9)


@query("text_quality_share", A.sql("reviews_text", """
SELECT count(*) AS rows, avg(CAST(len(issues) = 0 AS INT)) AS valid_share,
  avg(greatest(0, 100 - list_sum(list_transform(issues, lambda i: CASE i
    WHEN 'Too short (< 10 characters)' THEN 30 WHEN 'Too long (> 5000 characters)' THEN 10
    WHEN 'No alphabetic characters' THEN 50 WHEN 'Excessive repeated characters' THEN 20
    WHEN 'All caps text' THEN 15 ELSE 25 END) || [0]))) AS avg_score FROM quality_issues""", ISSUES_CTE))
def q_share(spark, sf):
    return Q.text_quality_share(TEXT(spark, sf))


@query("final_report", A.sql("reviews_text", """
SELECT count(*) AS final_records, (SELECT count(*) FROM documents) AS original_records,
  count(*) / (SELECT count(*) FROM documents) AS retention_rate, avg(rating) AS avg_rating,
  count(DISTINCT product_id) AS products, count(DISTINCT user_id) AS users,
  CAST(min(date) AS DATE) AS first_date, CAST(max(date) AS DATE) AS last_date,
  avg(length(review_text)) AS avg_review_length,
  (SELECT string_agg(product_id, ',' ORDER BY n DESC, product_id) FROM (SELECT product_id, count(*) AS n
   FROM reviews_text WHERE rating >= 2 GROUP BY 1 ORDER BY n DESC, product_id LIMIT 5)) AS most_reviewed
FROM reviews_text WHERE rating >= 2"""))
def q_final_report(spark, sf):
    r = TEXT(spark, sf)
    out = Q.final_report(r, r.where("rating >= 2"), "date")
    return out.withColumns({c: F.col(c).cast("date") for c in ("first_date", "last_date")})


def _secret_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, k, p.replace("'", "''")) for i, (k, p) in enumerate(L.SECRET_PATTERNS))
    return f"""
WITH patterns(pattern_no, secret_type, pattern) AS (VALUES {rows}),
lines AS (SELECT doc_id, generate_subscripts(l, 1)::int AS line, unnest(l) AS line_text FROM (
  SELECT doc_id, string_split(replace(text, 'token = ', 'access_token = '), chr(10)) AS l FROM documents)),
hits AS (SELECT doc_id, line, pattern_no, secret_type,
  unnest(regexp_extract_all(line_text, '(?i)' || pattern)) AS hit FROM lines, patterns)
SELECT doc_id, line, pattern_no, secret_type,
  CASE WHEN length(hit) > 50 THEN substr(hit, 1, 50) || '...' ELSE hit END AS match FROM hits"""


@query("secret_scan", _secret_sql())
def q_secrets(spark, sf):
    docs = spread(A.read(spark, sf, "documents").select("doc_id", "text"), "doc_id").select(
        "doc_id", F.replace("text", F.lit("token = "), F.lit("access_token = ")).alias("text"))
    return Q.secret_scan(docs, "doc_id", "text")


# ---- sentiment -------------------------------------------------------------
@query("sentiment_analysis", A.sql("reviews_text", """
SELECT review_id, overall_sentiment, confidence, sentiment_score,
  array_to_string(list_sort(map_keys(aspects)), ',') AS aspects, CASE WHEN len(map_keys(aspects)) > 0
    THEN aspect_score END AS aspect_score FROM sentiment""", SENTIMENT_SQL))
def q_sentiment(spark, sf):
    r = N.analyze(TEXT(spark, sf))
    keys = F.map_keys("aspects")
    return r.select(
        "review_id", "overall_sentiment", "confidence", "sentiment_score",
        F.array_join(F.array_sort(keys), ",").alias("aspects"),
        F.when(F.size(keys) > 0, F.element_at(F.map_values("aspects"), 1)["sentiment"]).alias("aspect_score"))


@query("sentiment_by_ids", A.sql("reviews_text", """
SELECT review_id, overall_sentiment, confidence FROM sentiment
WHERE review_id IN (SELECT doc_id FROM labels)""", SENTIMENT_SQL))
def q_sent_ids(spark, sf):
    ids = A.read(spark, sf, "labels").select(F.col("doc_id").alias("review_id"))
    return N.analyze(S.scan_by_ids(TEXT(spark, sf), ids)).select("review_id", "overall_sentiment", "confidence")


@query("save_sentiment_results", A.sql("reviews_text", """
SELECT review_id, overall_sentiment, CASE WHEN rating >= 4 THEN 2 ELSE 1 END AS version FROM sentiment""",
    SENTIMENT_SQL))
def q_save_sent(spark, sf):
    first = sentiment_results(spark, sf).select("review_id", "overall_sentiment", "rating", F.lit(1).alias("version"))
    again = first.where("rating >= 4").withColumn("version", F.lit(2))
    return S.upsert(first, again, ["review_id"], [F.desc("version")]).drop("rating")


@query("aspect_json_round_trip", A.sql("reviews_text", """
SELECT review_id, CAST(len(map_keys(aspects)) AS INT) AS n_aspects FROM sentiment""", SENTIMENT_SQL))
def q_json(spark, sf):
    stored = N.aspects_json(N.analyze(TEXT(spark, sf)).select("review_id", "aspects"))
    return N.parse_aspects(stored).select("review_id", F.size("aspects").alias("n_aspects"))


@query("sentiment_rating_correlation", A.sql("reviews_text", """
SELECT round(corr(CASE overall_sentiment WHEN 'POSITIVE' THEN 4.5 WHEN 'NEGATIVE' THEN 1.5 ELSE 3.0 END, rating), 6)
  AS correlation FROM sentiment""", SENTIMENT_SQL))
def q_corr(spark, sf):
    return rounded(N.rating_correlation(sentiment_results(spark, sf)), "correlation")


def _length_scorer():
    """A stand-in for a model: the label follows the length of the text."""
    def score(texts: pd.Series) -> pd.DataFrame:
        n = texts.str.len()
        return pd.DataFrame({"label": n.mod(3).map({0: "LABEL_0", 1: "LABEL_1", 2: "LABEL_2"}), "score": 0.8})
    return score


@query("sentiment_by_model", A.sql("reviews_text", """
SELECT review_id, CASE length(review_text) % 3 WHEN 0 THEN 'NEGATIVE' WHEN 2 THEN 'POSITIVE' ELSE 'NEUTRAL' END
  AS overall_sentiment, 0.8::double AS confidence,
  round(CASE length(review_text) % 3 WHEN 0 THEN 1.4 WHEN 2 THEN 4.6 ELSE 3.0 END::double, 6) AS sentiment_score
FROM reviews_text"""))
def q_model(spark, sf):
    return rounded(N.score_with_model(TEXT(spark, sf), _length_scorer).drop("failed"), "sentiment_score")


@query("fused_review_analysis", A.sql("reviews_text", """
SELECT review_id, CAST(length(review_text) AS INT) AS review_length, overall_sentiment, sentiment_score,
  fake_probability, risk_level,
  CASE WHEN fake_probability < 0.3 THEN 'Likely Authentic' WHEN fake_probability < 0.7 THEN 'Questionable'
    ELSE 'Likely Fake' END AS authenticity,
  CASE WHEN length(review_text) > 100 THEN 'Detailed' WHEN length(review_text) > 50 THEN 'Moderate' ELSE 'Brief' END
    AS detail,
  CASE WHEN (sentiment_score - 3) / 2 > 0.2 AND fake_probability < 0.3 THEN 'High Value Review'
    WHEN (sentiment_score - 3) / 2 < -0.2 AND fake_probability < 0.3 THEN 'Critical Feedback'
    WHEN fake_probability > 0.7 THEN 'Treat with Caution' ELSE 'Standard Review' END AS value_label
FROM sentiment JOIN fake USING (review_id) JOIN reviews_text USING (review_id)""", SENTIMENT_SQL, FAKE_SQL))
def q_fused(spark, sf):
    s = N.analyze(TEXT(spark, sf).withColumn("review_length", F.length("review_text")), ("review_id", "review_length"))
    return N.fused_analysis(s, fake_results(spark, sf))


# ---- evaluation ------------------------------------------------------------
def _predicted(spark, sf):
    return sentiment_results(spark, sf).select(
        B.rating_sentiment(F.col("rating")).alias("label"), F.col("overall_sentiment").alias("prediction"))


PREDICTED = """predicted AS (SELECT CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE'
  ELSE 'NEUTRAL' END AS label, overall_sentiment AS prediction FROM sentiment)"""
CLASSES = """classes AS (SELECT c AS cls, count(*) FILTER (label = c) AS support,
  count(*) FILTER (prediction = c) AS predicted, count(*) FILTER (label = c AND prediction = c) AS hit
  FROM predicted, (SELECT unnest(['POSITIVE', 'NEGATIVE', 'NEUTRAL']) AS c) GROUP BY c),
report AS (SELECT cls, support, coalesce(hit / nullif(predicted, 0), 0.0) AS precision,
  coalesce(hit / nullif(support, 0), 0.0) AS recall,
  coalesce(2 * (hit / nullif(predicted, 0)) * (hit / nullif(support, 0)) /
    nullif(hit / nullif(predicted, 0) + hit / nullif(support, 0), 0), 0.0) AS f1 FROM classes)"""


@query("confusion_matrix", A.sql("reviews_text", """
SELECT label, prediction, count(*) AS n FROM predicted GROUP BY ALL""", SENTIMENT_SQL, PREDICTED))
def q_confusion(spark, sf):
    return E.confusion(_predicted(spark, sf))


@query("class_report", A.sql("reviews_text", "SELECT * FROM report", SENTIMENT_SQL, PREDICTED, CLASSES))
def q_classes(spark, sf):
    return E.class_report(E.confusion(_predicted(spark, sf)))


@query("weighted_scores", A.sql("reviews_text", """
SELECT round(sum(precision * support) / sum(support), 9) AS precision, round(sum(recall * support) / sum(support), 9) AS recall,
  round(sum(f1 * support) / sum(support), 9) AS f1, CAST(sum(support) AS BIGINT) AS samples,
  (SELECT avg(CAST(label = prediction AS INT)) FROM predicted) AS accuracy FROM report""",
    SENTIMENT_SQL, PREDICTED, CLASSES))
def q_weighted(spark, sf):
    return rounded(E.weighted_scores(E.confusion(_predicted(spark, sf))), "precision", "recall", "f1", digits=9)


def _scored_labels(spark, sf):
    return A.fake_labels(spark, sf).select("review_id", "is_fake").join(
        fake_results(spark, sf).select("review_id", "fake_probability"), "review_id")


SCORED = "scored AS (SELECT is_fake, fake_probability AS p FROM fake_labels JOIN fake USING (review_id))"


@query("binary_scores", A.sql("reviews_text fake_labels", """
SELECT tp, fp, tn, fn, (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
  2 * tp / (2 * tp + fp + fn) AS f1
FROM (SELECT count(*) FILTER (p > 0.5 AND is_fake = 1) AS tp, count(*) FILTER (p > 0.5 AND is_fake = 0) AS fp,
  count(*) FILTER (p <= 0.5 AND is_fake = 0) AS tn, count(*) FILTER (p <= 0.5 AND is_fake = 1) AS fn FROM scored)""",
    FAKE_SQL, SCORED))
def q_binary(spark, sf):
    return E.binary_scores(_scored_labels(spark, sf), "is_fake", "fake_probability")


@query("roc_auc", A.sql("reviews_text fake_labels", """
SELECT round((sum(r) FILTER (is_fake = 1) - count(*) FILTER (is_fake = 1) * (count(*) FILTER (is_fake = 1) + 1) / 2)
  / (count(*) FILTER (is_fake = 1) * count(*) FILTER (is_fake = 0)), 9) AS auc
FROM (SELECT is_fake, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM scored)""",
    FAKE_SQL, SCORED))
def q_auc(spark, sf):
    return rounded(E.roc_auc(_scored_labels(spark, sf), "is_fake", "fake_probability"), "auc", digits=9)


@query("validation_datasets", A.sql("reviews_text fake_labels", """
SELECT is_fake, count(*) AS n, CAST(count(*) FILTER (rn <= round(0.3 * c)) AS BIGINT) AS n_test FROM (
  SELECT is_fake, row_number() OVER (PARTITION BY is_fake ORDER BY md5(review_id || 'valid'), review_id) AS rn,
         count(*) OVER (PARTITION BY is_fake) AS c FROM fake_labels) GROUP BY is_fake"""))
def q_valid_sets(spark, sf):
    from opinion_spark.operators.dedup import split_stratified
    split = split_stratified(A.fake_labels(spark, sf).select("review_id", "is_fake"), 0.3, "is_fake", seed="valid")
    return split.groupBy("is_fake").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"))


def _model_results(spark, sf):
    s = E.weighted_scores(E.confusion(_predicted(spark, sf))).select(
        F.lit("sentiment_analyzer").alias("model_name"), "accuracy", F.col("f1").alias("f1_score"),
        F.col("samples").alias("sample_size"))
    f = E.binary_scores(_scored_labels(spark, sf), "is_fake", "fake_probability").select(
        F.lit("fake_detector").alias("model_name"), "accuracy", F.col("f1").alias("f1_score"),
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("sample_size"))
    return s.unionByName(f)


@query("model_validation_report", A.sql("reviews_text fake_labels", """
SELECT 2::bigint AS models, round(avg(a), 4) AS overall_accuracy, round(avg(f), 4) AS overall_f1,
  CAST(sum(n) AS BIGINT) AS total_samples, string_agg(hint, '; ' ORDER BY name) AS recommendations FROM (
  SELECT name, a, f, n, concat_ws('; ',
      CASE WHEN a < 0.7 THEN name || ': Consider retraining with more data or feature engineering' END,
      CASE WHEN f < 0.6 THEN name || ': F1-score indicates class imbalance, consider balanced sampling' END) AS hint
  FROM (SELECT 'sentiment_analyzer' AS name, (SELECT avg(CAST(label = prediction AS INT)) FROM predicted) AS a,
          sum(f1 * support) / sum(support) AS f, sum(support) AS n FROM report
        UNION ALL SELECT 'fake_detector', avg(CAST((p > 0.5) = (is_fake = 1) AS INT)),
          2 * count(*) FILTER (p > 0.5 AND is_fake = 1) / (count(*) FILTER (p > 0.5) + count(*) FILTER (is_fake = 1)),
          count(*) FROM scored))""", SENTIMENT_SQL, PREDICTED, CLASSES, FAKE_SQL, SCORED))
def q_valid_report(spark, sf):
    return E.validation_report(_model_results(spark, sf))


@query("model_insights", A.sql("reviews_text fake_labels", """
SELECT name AS model_name, round(a, 4) AS accuracy, round(f, 4) AS f1_score, CAST(n AS BIGINT) AS sample_size,
  one || '; ' || two AS key_insights
FROM (SELECT 'sentiment_analyzer' AS name, (SELECT avg(CAST(label = prediction AS INT)) FROM predicted) AS a,
        sum(f1 * support) / sum(support) AS f, sum(support) AS n,
        (SELECT 'Average confidence: ' || printf('%.3f', avg(confidence)) FROM sentiment) AS one,
        (SELECT 'Rating correlation: ' || printf('%.3f', corr(CASE overall_sentiment WHEN 'POSITIVE' THEN 4.5
          WHEN 'NEGATIVE' THEN 1.5 ELSE 3.0 END, rating)) FROM sentiment) AS two FROM report
      UNION ALL SELECT 'fake_detector', avg(CAST((p > 0.5) = (is_fake = 1) AS INT)),
        2 * count(*) FILTER (p > 0.5 AND is_fake = 1) / (count(*) FILTER (p > 0.5) + count(*) FILTER (is_fake = 1)), count(*),
        'AUC Score: ' || printf('%.3f', (SELECT (sum(r) FILTER (is_fake = 1)
            - count(*) FILTER (is_fake = 1) * (count(*) FILTER (is_fake = 1) + 1) / 2)
            / (count(*) FILTER (is_fake = 1) * count(*) FILTER (is_fake = 0)) FROM (SELECT is_fake,
              rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM scored))),
        'Detection accuracy: ' || printf('%.3f', avg(CAST((p > 0.5) = (is_fake = 1) AS INT))) FROM scored)""",
    SENTIMENT_SQL, PREDICTED, CLASSES, FAKE_SQL, SCORED))
def q_insights(spark, sf):
    sentiment, scored = sentiment_results(spark, sf), _scored_labels(spark, sf)
    details = F.create_map(
        F.lit("avg_confidence"), sentiment.agg(F.avg("confidence").alias("c")).scalar(),
        F.lit("rating_correlation"), N.rating_correlation(sentiment).scalar(),
        F.lit("auc_score"), E.roc_auc(scored, "is_fake", "fake_probability").scalar())
    return E.model_insights(_model_results(spark, sf).withColumn("details", details))


@query("validation_sets", A.sql("reviews_text fake_labels", """
SELECT 'sentiment' AS dataset, review_id, label, row_number() OVER (PARTITION BY label
    ORDER BY md5(review_id || 'sentiment'), review_id) <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test
FROM (SELECT review_id, CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label
      FROM reviews_text)
UNION ALL SELECT 'rating_prediction', review_id, CAST(rating AS VARCHAR),
  row_number() OVER (ORDER BY md5(review_id || 'rating'), review_id) <= round(0.2 * count(*) OVER ()) FROM reviews_text
UNION ALL SELECT 'fake_detection', review_id, CAST(is_fake AS VARCHAR), row_number() OVER (PARTITION BY is_fake
    ORDER BY md5(review_id || 'fake'), review_id) <= round(0.3 * count(*) OVER (PARTITION BY is_fake)) FROM fake_labels"""))
def q_all_valid_sets(spark, sf):
    return E.validation_sets(TEXT(spark, sf), A.fake_labels(spark, sf))


@query("system_coverage", A.sql("reviews_text", """
SELECT (SELECT count(*) FROM sentiment) > 0 AS sentiment_analysis,
  (SELECT count(*) FROM fake WHERE fake_probability > 1) > 0 AS fake_detection, false AS recommendations,
  CASE WHEN (SELECT count(*) FROM reviews_text) > 0 THEN 'operational' ELSE 'failed' END AS data_pipeline_status""",
    SENTIMENT_SQL, FAKE_SQL))
def q_coverage_flags(spark, sf):
    """One full, one empty and one absent result table next to the reviews."""
    tables = {"reviews": TEXT(spark, sf), "sentiment_analysis": sentiment_results(spark, sf),
              "fake_detection": fake_results(spark, sf).where("fake_probability > 1")}
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return E.system_coverage(counts)


@query("training_report", A.sql("reviews_text", """
SELECT count(*) AS steps, count(*) FILTER (n >= 200) AS successful, count(*) FILTER (n >= 200) / count(*) AS success_rate,
  CASE WHEN count(*) FILTER (n >= 200) = count(*) THEN 'success' ELSE 'partial_success' END AS status
FROM (SELECT rating, count(*) AS n FROM reviews_text GROUP BY 1)"""))
def q_train_report(spark, sf):
    steps = TEXT(spark, sf).groupBy("rating").agg((F.count(F.lit(1)) >= 200).alias("succeeded"))
    return E.training_report(steps)


SAMPLES = """samples AS (SELECT CAST(label = prediction AS INT) AS correct, s.confidence, fake_probability AS p
  FROM (SELECT review_id, confidence, overall_sentiment AS prediction, CASE WHEN rating >= 4 THEN 'POSITIVE'
    WHEN rating <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label FROM sentiment) s JOIN fake USING (review_id))"""


@query("scored_sample_metrics", A.sql("reviews_text", """
UNPIVOT (SELECT 'both' AS model_name, count(*) AS sample_size, round(avg(correct), 6) AS accuracy,
  round(avg(confidence), 6) AS avg_confidence, round(avg(p), 6) AS avg_fake_probability,
  count(*) FILTER (p > 0.7)::double AS high_risk, count(*) FILTER (p < 0.3)::double AS low_risk,
  round(min(p), 6) AS min_probability, round(max(p), 6) AS max_probability FROM samples)
ON accuracy, avg_confidence, avg_fake_probability, high_risk, low_risk, min_probability, max_probability
INTO NAME metric_name VALUE metric_value""", SENTIMENT_SQL, FAKE_SQL, SAMPLES))
def q_samples(spark, sf):
    s = sentiment_results(spark, sf).select(
        "review_id", "confidence",
        (F.col("overall_sentiment") == B.rating_sentiment(F.col("rating"))).cast("int").alias("correct"))
    scored = s.join(fake_results(spark, sf).select("review_id", "fake_probability"), "review_id")
    return rounded(E.sample_metrics(scored, "both"), "metric_value")


# ---- drift -----------------------------------------------------------------
DF_SQL = f"""drift_features AS (
  SELECT review_id, side, date, rating, helpful_votes, total_votes, length(review_text) AS text_length,
    {WORDS} AS word_count, {count_sql('[.]')} + 1 AS sentence_count, {count_sql('!')} AS exclamation_count,
    {count_sql(chr(92) + 'p{Lu}')} / greatest(length(review_text), 1) AS caps_ratio,
    helpful_votes / (total_votes + 1) AS helpful_ratio,
    {hits_sql('lower(review_text)', L.DRIFT_POSITIVE)} AS positive_food_words,
    {hits_sql('lower(review_text)', L.DRIFT_NEGATIVE)} AS negative_food_words,
    CASE WHEN rating <= 2 THEN 'low' WHEN rating <= 3 THEN 'medium' WHEN rating <= 4 THEN 'high' ELSE 'very_high' END
      AS rating_category,
    CASE WHEN length(review_text) = 0 THEN NULL WHEN length(review_text) <= 50 THEN 'short'
      WHEN length(review_text) <= 150 THEN 'medium' WHEN length(review_text) <= 500 THEN 'long'
      ELSE 'very_long' END AS text_length_category,
    abs(rating - avg(rating) OVER (PARTITION BY side)) AS rating_deviation,
    year(date) AS year, month(date) AS month, isodow(date) - 1 AS day_of_week
  FROM text_sides)"""
LONG_SQL = "long_features AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, side, {f}::double AS value FROM drift_features" for f in T.NUMERIC) + ")"
KS_SQL = """ks AS (SELECT feature, max(n1) AS n1, max(n2) AS n2, max(abs(cb / n1 - cc / n2)) AS d FROM (
  SELECT feature, value, sum(b) OVER w AS cb, sum(c) OVER w AS cc,
    sum(b) OVER (PARTITION BY feature) AS n1, sum(c) OVER (PARTITION BY feature) AS n2
  FROM (SELECT feature, value, count(*) FILTER (side = 'baseline') AS b, count(*) FILTER (side = 'comparison') AS c
        FROM long_features GROUP BY ALL) WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY feature),
ks_p AS (SELECT *, CASE WHEN d * d * n1 * n2 / (n1 + n2) < 1e-3 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(
  list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END)::double
    * exp(-2.0::double * k * k * (d * d * n1 * n2 / (n1 + n2))))))) END AS p FROM ks)"""
CHI_LONG = "cat_features AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, side, {f} AS category FROM drift_features WHERE {f} IS NOT NULL" for f in T.CATEGORICAL) + ")"
CHI_SQL = """chi AS (SELECT feature, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2, count(*) - 1 AS dof,
  sum((b - e1) ** 2 / e1 + (c - e2) ** 2 / e2) AS chi2 FROM (
   SELECT *, (b + c) / (n1 + n2) * n1 AS e1, (b + c) / (n1 + n2) * n2 AS e2 FROM (
    SELECT feature, category, count(*) FILTER (side = 'baseline') AS b, count(*) FILTER (side = 'comparison') AS c,
      sum(count(*) FILTER (side = 'baseline')) OVER (PARTITION BY feature) AS n1,
      sum(count(*) FILTER (side = 'comparison')) OVER (PARTITION BY feature) AS n2
    FROM cat_features GROUP BY feature, category)) GROUP BY feature)"""
DRIFT_CTES = (DF_SQL, LONG_SQL, KS_SQL, CHI_LONG, CHI_SQL)


def _features(spark, sf):
    return T.drift_features(A.text_sides(spark, sf))


@query("drift_sides", A.sql("reviews_core", f"""
SELECT * FROM (SELECT review_id, 'baseline' AS side FROM reviews_core WHERE review_date < TIMESTAMP '{A.DRIFT_SPLIT}'
  ORDER BY md5(review_id || 'baseline'), review_id LIMIT 2000)
UNION ALL SELECT * FROM (SELECT review_id, 'comparison' FROM reviews_core
  WHERE review_date >= TIMESTAMP '{A.DRIFT_SPLIT}' ORDER BY review_date DESC, review_id LIMIT 500)"""))
def q_sides(spark, sf):
    r = CORE(spark, sf).select("review_id", "review_date")
    return T.select_sides(r, "review_date", A.DRIFT_SPLIT, 2000, 500).drop("review_date")


@query("drift_features", A.sql("text_sides", """
SELECT review_id, side, rating, text_length::int AS text_length, word_count, sentence_count, exclamation_count, caps_ratio,
  helpful_ratio, round(rating_deviation, 9) AS rating_deviation, positive_food_words, negative_food_words,
  year::int AS year, month::int AS month, day_of_week::int AS day_of_week, rating_category, text_length_category
FROM drift_features""", DF_SQL))
def q_features(spark, sf):
    return rounded(_features(spark, sf), "rating_deviation", digits=9).drop(
        "date", "helpful_votes", "total_votes", "question_count")


@query("ks_test_sweep", A.sql("text_sides", """
SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(d, 9) AS magnitude, round(p, 6) AS p_value,
  'ks_test' AS test FROM ks_p""", *DRIFT_CTES))
def q_ks(spark, sf):
    out = T.ks_test(T.value_counts(_features(spark, sf), T.NUMERIC))
    return rounded(rounded(out, "magnitude", digits=9), "p_value")


@query("ks_test_relational", A.sql("drift_sides", """
SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(d, 9) AS magnitude, round(p, 6) AS p_value,
  'ks_test' AS test FROM ks_p""", """long_features AS (
    SELECT 'rating' AS feature, side, rating::double AS value FROM drift_sides
    UNION ALL SELECT 'helpful_votes', side, helpful_votes FROM drift_sides
    UNION ALL SELECT 'product_id', side, product_id FROM drift_sides)""", KS_SQL))
def q_ks_core(spark, sf):
    counts = T.value_counts(A.drift_sides(spark, sf), ["rating", "helpful_votes", "product_id"])
    return rounded(rounded(T.ks_test(counts), "magnitude", digits=9), "p_value")


@query("chi_square_test", A.sql("text_sides", """
SELECT feature, n1, n2, dof, round(chi2, 6) AS chi2, round(chi2 / (n1 + n2), 9) AS magnitude FROM chi""", *DRIFT_CTES))
def q_chi(spark, sf):
    out = T.chi2_test(_features(spark, sf)).drop("p_value", "test")
    return rounded(rounded(out, "chi2"), "magnitude", digits=9)


@query("drift_descriptives", A.sql("text_sides", """
SELECT feature, count(*) FILTER (side = 'baseline') AS baseline_samples,
  count(*) FILTER (side = 'comparison') AS comparison_samples,
  round(avg(value) FILTER (side = 'baseline'), 6) AS baseline_mean,
  round(avg(value) FILTER (side = 'comparison'), 6) AS comparison_mean,
  round(stddev_samp(value) FILTER (side = 'baseline'), 5) AS baseline_std,
  round(stddev_samp(value) FILTER (side = 'comparison'), 5) AS comparison_std,
  round(abs(avg(value) FILTER (side = 'comparison') - avg(value) FILTER (side = 'baseline')), 6) AS mean_shift
FROM long_features GROUP BY feature""", *DRIFT_CTES))
def q_desc(spark, sf):
    out = T.descriptives(T.value_counts(_features(spark, sf), T.NUMERIC))
    out = rounded(out, "baseline_mean", "comparison_mean", "mean_shift")
    return rounded(out, "baseline_std", "comparison_std", digits=5)


def _scored_sides(spark, sf):
    return N.analyze(A.text_sides(spark, sf), ("review_id", "side", "rating"))


CONCEPT = """concept AS (SELECT avg(CAST(overall_sentiment = CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2
    THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS INT)) FILTER (date < TIMESTAMP '2012-01-01') AS b,
  avg(CAST(overall_sentiment = CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END
    AS INT)) FILTER (date >= TIMESTAMP '2012-01-01') AS c
  FROM (SELECT s.*, date FROM sentiment s JOIN reviews_text USING (review_id)))"""


@query("concept_drift", A.sql("reviews_text", """
SELECT round(b, 9) AS baseline_accuracy, round(c, 9) AS comparison_accuracy, round(abs(b - c), 9) AS magnitude,
  abs(b - c) > 0.1 AS drift_detected FROM concept""", SENTIMENT_SQL, CONCEPT))
def q_concept(spark, sf):
    out = T.concept_drift(_scored_sides(spark, sf)).select(
        "baseline_accuracy", "comparison_accuracy", "magnitude", "drift_detected")
    return rounded(out, "baseline_accuracy", "comparison_accuracy", "magnitude", digits=9)


TEMPORAL = """temporal AS (SELECT (SELECT corr(b, c) FROM (
    SELECT avg(rating) FILTER (side = 'baseline') AS b, avg(rating) FILTER (side = 'comparison') AS c
    FROM {v} GROUP BY month({d})) WHERE b IS NOT NULL AND c IS NOT NULL) AS season,
  regr_slope(rating, i) FILTER (side = 'baseline') AS bt, regr_slope(rating, i) FILTER (side = 'comparison') AS ct
  FROM (SELECT side, rating, row_number() OVER (PARTITION BY side
    ORDER BY {d}, md5(review_id::varchar), review_id) - 1 AS i FROM {v}))"""


@query("temporal_drift", A.sql("drift_sides", """
SELECT round(season, 6) AS seasonal_correlation, round(bt, 9) AS baseline_trend, round(ct, 9) AS comparison_trend,
  round(abs(ct - bt), 9) AS trend_change, round(1 - abs(season), 6) AS magnitude,
  1 - abs(season) > 0.3 OR abs(ct - bt) > 0.1 AS drift_detected FROM temporal""",
    TEMPORAL.format(v="drift_sides", d="review_date")))
def q_temporal(spark, sf):
    out = T.temporal_drift(A.drift_sides(spark, sf), "review_date").drop("feature", "drift_type", "test", "p_value")
    out = rounded(out, "seasonal_correlation", "magnitude")
    return rounded(out, "baseline_trend", "comparison_trend", "trend_change", digits=9)


@query("drift_results")
def q_results(spark, sf):
    return run_drift(A.text_sides(spark, sf))[0]


@query("drift_report")
def q_report(spark, sf):
    return run_drift(A.text_sides(spark, sf))[1]
