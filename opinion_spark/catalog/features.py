"""Scalar feature functions, each over the whole text or fact table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.registry import add, query
from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X

BL = r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def hits_sql(col: str, phrases: list[str]) -> str:
    """Number of phrases contained in ``col``, as SQL."""
    quoted = ", ".join("'" + p.replace("'", "''") + "'" for p in phrases)
    return f"CAST(len(list_filter([{quoted}], lambda p: contains({col}, p))) AS INT)"


def count_sql(pattern: str, col: str = "review_text") -> str:
    return f"CAST(len(regexp_extract_all({col}, '{pattern}')) AS INT)"


def ratio_sql(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0.0 END"


WORDS = count_sql(f"[^{BL}]+")
POS, NEG = (hits_sql("lower(review_text)", w) for w in (L.SENTIMENT_POSITIVE, L.SENTIMENT_NEGATIVE))

# name -> (Spark column, the same in SQL)
TEXT_FEATURES: dict[str, tuple[Callable[..., Column], str]] = {
    "char_count": (lambda t: F.length(t), "CAST(length(review_text) AS INT)"),
    "word_count": (lambda t: X.word_count(t), WORDS),
    "sentence_count_runs": (lambda t: X.sentence_runs(t), f"{count_sql('[.!?]+')} + 1"),
    "sentence_count_dots": (lambda t: X.sentence_dots(t), f"{count_sql('[.]')} + 1"),
    "sentence_count_pieces": (
        lambda t: X.sentence_pieces(t),
        f"CAST(len(list_filter(string_split(review_text, '.'), lambda s: regexp_matches(s, '[^{BL}]')))"
        " AS INT)"),
    "avg_word_length": (
        lambda t: X.avg_word_length(t),
        ratio_sql(f"length(regexp_replace(review_text, '[{BL}]', '', 'g'))", WORDS)),
    "punctuation_ratio": (
        lambda t: X.punctuation_ratio(t),
        ratio_sql(count_sql("[!-/:-@\\[-`{-~]"), "length(review_text)")),
    "mark_ratio": (lambda t: X.mark_ratio(t), ratio_sql(count_sql("[!?.,;:]"), "length(review_text)")),
    "capital_ratio": (lambda t: X.capital_ratio(t), ratio_sql(count_sql(r"\p{Lu}"), count_sql(r"\p{L}"))),
    "caps_ratio": (lambda t: X.caps_ratio(t), f"{count_sql(chr(92) + 'p{Lu}')} / greatest(length(review_text), 1)"),
    "exclamation_count": (lambda t: X.matches(t, "!"), count_sql("!")),
    "exclamation_ratio": (lambda t: X.exclamation_ratio(t), ratio_sql(count_sql("!"), "length(review_text)")),
    "question_count": (lambda t: X.matches(t, r"\?"), count_sql("[?]")),
    "repeated_word_count": (
        lambda t: X.repeated_words(t),
        "(SELECT CAST(count(*) AS INT) FROM (SELECT w FROM (SELECT unnest(regexp_extract_all("
        f"lower(review_text), '[^{BL}]+')) AS w) GROUP BY w HAVING count(*) > 1))"),
    "phrase_hits_generic": (lambda t: X.phrase_hits(F.lower(t), L.GENERIC_PHRASES),
                            hits_sql("lower(review_text)", L.GENERIC_PHRASES)),
    "phrase_hits_spam": (lambda t: X.phrase_hits(F.lower(t), L.SPAM_PHRASES),
                         hits_sql("lower(review_text)", L.SPAM_PHRASES)),
    "phrase_hits_punctuation": (lambda t: X.phrase_hits(F.lower(t), L.PUNCTUATION_RUNS),
                                hits_sql("lower(review_text)", L.PUNCTUATION_RUNS)),
    "phrase_hits_competitor": (lambda t: X.phrase_hits(F.lower(t), L.COMPETITOR_PHRASES),
                               hits_sql("lower(review_text)", L.COMPETITOR_PHRASES)),
    "phrase_hits_food_spam": (lambda t: X.phrase_hits(F.lower(t), L.FOOD_SPAM_PHRASES),
                              hits_sql("lower(review_text)", L.FOOD_SPAM_PHRASES)),
    "lexicon_hits_drift_positive": (lambda t: X.phrase_hits(F.lower(t), L.DRIFT_POSITIVE),
                                    hits_sql("lower(review_text)", L.DRIFT_POSITIVE)),
    "lexicon_hits_drift_negative": (lambda t: X.phrase_hits(F.lower(t), L.DRIFT_NEGATIVE),
                                    hits_sql("lower(review_text)", L.DRIFT_NEGATIVE)),
    "lexicon_hits_positive": (lambda t: X.phrase_hits(F.lower(t), L.SENTIMENT_POSITIVE), POS),
    "lexicon_hits_negative": (lambda t: X.phrase_hits(F.lower(t), L.SENTIMENT_NEGATIVE), NEG),
    "token_count": (lambda t: X.token_count(t), count_sql(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]", "lower(review_text)")),
    "avg_token_length": (
        lambda t: X.avg_token_length(t),
        ratio_sql(r"length(regexp_replace(review_text, '\s', '', 'g'))",
                  count_sql(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]", "lower(review_text)"))),
    "polarity_compound": (
        lambda t: X.polarity(t), f"({POS} - {NEG})::double / sqrt(({POS} - {NEG})::double * ({POS} - {NEG}) + 15.0)"),
    "length_category": (
        lambda t: B.length_category(F.length(t)),
        "CASE WHEN length(review_text) = 0 THEN NULL WHEN length(review_text) <= 50 THEN 'short' "
        "WHEN length(review_text) <= 150 THEN 'medium' WHEN length(review_text) <= 500 THEN 'long' "
        "ELSE 'very_long' END"),
    "numbers_in_text": (
        lambda t: F.array_join(F.transform(X.numbers_in(t), X.whole_number), ","),
        r"array_to_string(list_transform(regexp_extract_all(review_text, '\d+(?:\.\d+)?'), "
        "lambda x: CAST(CAST(round_even(CAST(x AS DOUBLE), 0) AS BIGINT) AS VARCHAR)), ',')"),
    "normalized_rating_text": (
        lambda t: X.normalize_rating(t),
        r"(SELECT CASE WHEN n <= 1 THEN greatest(1, trunc(n * 5)::int) WHEN n <= 5 THEN trunc(n)::int "
        r"WHEN n <= 10 THEN trunc(n / 2)::int WHEN n <= 100 THEN trunc(n / 20)::int END FROM (SELECT "
        r"nullif(regexp_extract(review_text, '\d+(?:\.\d+)?'), '')::double AS n))"),
    "text_preview": (lambda t: X.preview(t, 100),
                     "CASE WHEN length(review_text) > 100 THEN substr(review_text, 1, 100) || '...' "
                     "ELSE review_text END"),
    "search_ignore_case": (lambda t: X.contains_ignore_case(t, "great taste"),
                           "contains(lower(review_text), 'great taste')"),
    "valid_scraped_review": (
        lambda t: X.is_valid_review(t),
        f"length(regexp_replace(review_text, '^[{BL}]+|[{BL}]+$', '', 'g')) >= 10 AND "
        + hits_sql("lower(review_text)", L.SCRAPE_SPAM) + " = 0"),
    "ascii_text": (
        lambda t: F.md5(X.ascii_text(t)),
        f"md5(trim(regexp_replace(regexp_replace(regexp_replace(review_text, '[{BL}]+', ' ', 'g'), "
        "'^ | $', '', 'g'), '[^\\x00-\\x7F]', '', 'g')))"),
    "expanded_contractions": (
        lambda t: F.md5(X.expand_contractions(t)),
        "md5(" + "".join("replace(" for _ in L.CONTRACTIONS) + "review_text" + "".join(
            ", '{}', '{}')".format(a.replace("'", "''"), b) for a, b in L.CONTRACTIONS) + ")"),
    "safe_user_id": (lambda t: X.safe_user_id(F.col("review_title")),
                     r"regexp_replace(review_title, '[^\p{L}\p{N}_\-]', '_', 'g')"),
    "repeated_characters": (
        lambda t: F.rlike(F.lower(t), F.lit(X.REPEATED)),
        # every distinct character of the text, checked for a run of six
        "len(list_filter(list_distinct(regexp_extract_all(lower(review_text), '(?s)[^\\n]')), "
        "lambda c: contains(lower(review_text), repeat(c, 6)))) > 0"),
}


def _text_feature(column: Callable[..., Column]):
    return lambda spark, sf: A.reviews_text(spark, sf).select(
        "review_id", column(F.col("review_text")).alias("value"))


def _core_feature(column: Callable[..., Column]):
    return lambda spark, sf: A.reviews_core(spark, sf).select(
        "review_id", column(F.col("helpful_votes"), F.col("total_votes"), F.col("rating")).alias("value"))


for _name, (_column, _sql) in TEXT_FEATURES.items():
    add(_name, _text_feature(_column),
        A.sql("reviews_text", f"SELECT review_id, {_sql} AS value FROM reviews_text"))


CORE_FEATURES: dict[str, tuple[Callable[..., Column], str]] = {
    "helpfulness_if_voted": (lambda h, t, r: B.helpful_if_voted(h, t),
                             "CASE WHEN total_votes > 0 THEN helpful_votes / total_votes ELSE 0.0 END"),
    "helpfulness_floor_one": (lambda h, t, r: B.helpful_floor_one(h, t), "helpful_votes / greatest(total_votes, 1)"),
    "helpfulness_plus_one": (lambda h, t, r: B.helpful_plus_one(h, t), "helpful_votes / (total_votes + 1)"),
    "extreme_rating": (lambda h, t, r: B.extreme_rating(r), "CASE WHEN rating IN (1, 5) THEN 1 ELSE 0 END"),
    "rating_category": (lambda h, t, r: B.rating_category(r),
                        "CASE WHEN rating <= 2 THEN 'low' WHEN rating <= 3 THEN 'medium' "
                        "WHEN rating <= 4 THEN 'high' ELSE 'very_high' END"),
    "rating_sentiment": (lambda h, t, r: B.rating_sentiment(r),
                         "CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE' "
                         "ELSE 'NEUTRAL' END"),
    "sentiment_value": (lambda h, t, r: B.sentiment_value(B.rating_sentiment(r)),
                        "CASE WHEN rating >= 4 THEN 4.5::double WHEN rating <= 2 THEN 1.5 ELSE 3.0 END"),
    "rating_badge": (lambda h, t, r: B.rating_badge(r),
                     "CASE WHEN rating >= 4 THEN 'excellent' WHEN rating >= 3 THEN 'good' ELSE 'poor' END"),
    "votes_log1p": (lambda h, t, r: F.round(F.log1p(t), 6), "round(ln(1 + total_votes), 6)"),
    "display_names": (lambda h, t, r: F.concat(F.lit("Food Product "), "product_id", F.lit(" / User_"), "user_id"),
                      "'Food Product ' || product_id || ' / User_' || user_id"),
    "rating_deviation_abs": (lambda h, t, r: F.abs(r - 3), "abs(rating - 3)"),
}
for _name, (_column, _sql) in CORE_FEATURES.items():
    add(_name, _core_feature(_column),
        A.sql("reviews_core", f"SELECT review_id, {_sql} AS value FROM reviews_core"))


@query("date_parts", A.sql("metric_stream", """
SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
       CAST(isodow(ts) - 1 AS INT) AS day_of_week, isodow(ts) >= 6 AS is_weekend,
       CAST(hour(ts) AS INT) AS review_hour FROM metric_stream"""))
def date_parts(spark, sf) -> DataFrame:
    ts = F.col("ts")
    return A.metric_stream(spark, sf).select(
        "event_id", F.year(ts).alias("year"), F.month(ts).alias("month"),
        B.weekday_monday_zero(ts).alias("day_of_week"),
        (F.weekday(ts) >= 5).alias("is_weekend"), F.hour(ts).alias("review_hour"))


@query("sentiment_to_rating", A.sql("metric_stream", """
SELECT event_id,
  CASE metric_name WHEN 'cpu_usage' THEN least(greatest(4.0 + (metric_value / 100 - 0.5) * 2, 1.0), 5.0)
       WHEN 'disk_usage' THEN least(greatest(2.0 - (metric_value / 100 - 0.5) * 2, 1.0), 5.0)
       ELSE 3.0 END AS score,
  CASE metric_name WHEN 'cpu_usage' THEN 'POSITIVE' WHEN 'disk_usage' THEN 'NEGATIVE'
       ELSE 'NEUTRAL' END AS label
FROM metric_stream"""))
def sentiment_to_rating(spark, sf) -> DataFrame:
    name = F.col("metric_name")
    label = B.normalize_model_label(
        F.when(name == "cpu_usage", "label_2").when(name == "disk_usage", "neg").otherwise("LABEL_1"))
    return A.metric_stream(spark, sf).select(
        "event_id", B.sentiment_to_rating(label, F.col("metric_value") / 100).alias("score"),
        label.alias("label"))


@query("probability_labels", A.sql("metric_stream", """
SELECT event_id, p, CASE WHEN p < 0.3 THEN 'LOW' WHEN p < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk,
  greatest(p, 1 - p) AS confidence,
  CASE WHEN p < 0.3 THEN 'Likely Authentic' WHEN p < 0.7 THEN 'Questionable' ELSE 'Likely Fake' END
    AS authenticity,
  CASE WHEN n > 100 THEN 'Detailed' WHEN n > 50 THEN 'Moderate' ELSE 'Brief' END AS detail,
  CASE WHEN (s - 3) / 2 > 0.2 AND p < 0.3 THEN 'High Value Review'
       WHEN (s - 3) / 2 < -0.2 AND p < 0.3 THEN 'Critical Feedback'
       WHEN p > 0.7 THEN 'Treat with Caution' ELSE 'Standard Review' END AS value_label,
  CASE WHEN s >= 4.0 AND p * 20 < 3 AND n > 50 THEN 'Highly Recommended'
       WHEN s >= 3.5 AND p * 20 < 5 THEN 'Good Choice' WHEN p * 20 > 10 THEN 'Exercise Caution'
       ELSE 'Mixed Results' END AS verdict,
  CASE WHEN p * 20 < 2 THEN 'LOW' WHEN p * 20 < 5 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_band,
  CASE WHEN p >= 0.8 THEN 'Excellent' WHEN p >= 0.6 THEN 'Good' ELSE 'Needs Improvement' END
    AS model_status,
  CASE WHEN p > 0.8 AND s < 1 THEN 'Excellent' WHEN p > 0.6 AND s < 2 THEN 'Good'
       ELSE 'Needs Improvement' END AS speed_grade,
  CASE WHEN p < 0.05 THEN 'High Quality' WHEN p < 0.1 THEN 'Good Quality' ELSE 'Mixed Quality' END
    AS fake_grade
FROM (SELECT event_id, (value % 100) / 100 AS p, value % 5 AS s,
             CAST(trunc(value) % 150 AS INT) AS n FROM events)"""))
def probability_labels(spark, sf) -> DataFrame:
    v = F.col("value")
    base = A.read(spark, sf, "events").select(
        "event_id", ((v % 100) / 100).alias("p"), (v % 5).alias("s"), (v.cast("int") % 150).alias("n"))
    p, s, n = F.col("p"), F.col("s"), F.col("n")
    return base.select(
        "event_id", "p", B.risk_level(p).alias("risk"), B.risk_confidence(p).alias("confidence"),
        B.authenticity(p).alias("authenticity"), B.detail_level(n).alias("detail"),
        B.review_value(s, p).alias("value_label"), B.product_verdict(s, p * 20, n).alias("verdict"),
        B.product_risk_band(p * 20).alias("risk_band"), B.model_status(p).alias("model_status"),
        B.sentiment_grade(p, s).alias("speed_grade"), B.fake_rate_grade(p).alias("fake_grade"))


@query("scraped_text_parsing", A.sql("reviews_core", r"""
SELECT review_id, CAST(review_date AS DATE) AS parsed_date,
  CASE WHEN helpful_votes = 1 THEN 1 ELSE helpful_votes END AS votes,
  'Item ' || product_id AS title
FROM reviews_core"""))
def scraped_text_parsing(spark, sf) -> DataFrame:
    """Write the scraped forms of date, votes and title, then parse them back."""
    h, r = F.col("helpful_votes"), F.col("rating")
    said = A.reviews_core(spark, sf).select(
        "review_id",
        F.concat(F.lit("Reviewed in the United States on "), F.date_format("review_date", "MMMM d, yyyy"))
        .alias("date_text"),
        F.when(h == 1, "One person found this helpful").when(h == 0, "Helpful?")
        .otherwise(F.concat(h.cast("string"), F.lit(" people found this helpful"))).alias("vote_text"),
        F.concat(r.cast("string"), F.lit(".0 out of 5 stars Item "), "product_id").alias("title_text"))
    return said.select(
        "review_id", X.scraped_date(F.col("date_text")).alias("parsed_date"),
        X.helpful_votes(F.col("vote_text")).alias("votes"),
        X.clean_title(F.col("title_text")).alias("title"))


ISSUES_SQL = f"""
SELECT review_id, list_filter([
  CASE WHEN size < 10 THEN 'Too short (< 10 characters)' WHEN size > 5000 THEN 'Too long (> 5000 characters)' END,
  CASE WHEN NOT regexp_matches(review_text, '[a-zA-Z]') THEN 'No alphabetic characters' END,
  CASE WHEN len(list_filter(list_distinct(regexp_extract_all(lower(review_text), '(?s)[^\\n]')),
       lambda c: contains(lower(review_text), repeat(c, 6)))) > 0 THEN 'Excessive repeated characters' END,
  CASE WHEN length(review_text) > 20 AND regexp_matches(review_text, '\\p{{L}}')
       AND upper(review_text) = review_text THEN 'All caps text' END,
  CASE WHEN len(regexp_extract_all(review_text, '[^a-zA-Z0-9\\s.,!?]')) / greatest(length(review_text), 1)
       > 0.3 THEN 'Too many special characters' END], lambda x: x IS NOT NULL) AS issues
FROM (SELECT *, length(regexp_replace(review_text, '^[{BL}]+|[{BL}]+$', '', 'g')) AS size FROM reviews_text)"""
ISSUES_CTE = f"quality_issues AS ({ISSUES_SQL})"


@query("text_quality", A.sql("reviews_text", """
SELECT review_id, array_to_string(issues, '|') AS issues, len(issues) = 0 AS valid,
  CAST(greatest(0, 100 - list_sum(list_transform(issues, lambda i: CASE i
    WHEN 'Too short (< 10 characters)' THEN 30 WHEN 'Too long (> 5000 characters)' THEN 10
    WHEN 'No alphabetic characters' THEN 50 WHEN 'Excessive repeated characters' THEN 20
    WHEN 'All caps text' THEN 15 ELSE 25 END) || [0])) AS INT) AS quality_score
FROM quality_issues""", ISSUES_CTE))
def text_quality(spark, sf) -> DataFrame:
    issues = F.col("found")
    return A.reviews_text(spark, sf).select(
        "review_id", X.quality_issues(F.col("review_text")).alias("found")).select(
        "review_id", F.array_join(issues, "|").alias("issues"), (F.size(issues) == 0).alias("valid"),
        X.quality_score(issues).alias("quality_score"))
