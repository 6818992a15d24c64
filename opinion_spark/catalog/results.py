"""Stored-result views used by several sections: sentiment rows and fake rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.features import NEG, POS, hits_sql
from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.operators import sentiment as N


def sentiment_results(spark, sf) -> DataFrame:
    return N.analyze(A.reviews_text(spark, sf), keep=("review_id", "product_id", "user_id", "rating"))


_ASPECTS = ", ".join(
    f"CASE WHEN {hits_sql('low', words)} > 0 THEN '{aspect}' END" for aspect, words in L.ASPECT_KEYWORDS.items())
SENTIMENT_SQL = f"""sentiment_base AS (
  SELECT *, CASE WHEN p > n THEN 4.0 + least(p * 0.2, 1.0) WHEN n > p THEN 2.0 - least(n * 0.2, 1.0)
              ELSE 3.0 END::double AS raw,
    CASE WHEN p = n THEN 0.5 ELSE least(0.7::double + greatest(p, n) * 0.1::double, 0.9::double) END AS confidence,
    CASE WHEN p > n THEN 'POSITIVE' WHEN n > p THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS overall_sentiment
  FROM (SELECT *, lower(review_text) AS low, {POS} AS p, {NEG} AS n FROM reviews_text)),
sentiment AS (
  SELECT review_id, product_id, user_id, rating, overall_sentiment, confidence,
    least(greatest(raw, 1.0), 5.0)::double AS aspect_score,
    CASE overall_sentiment WHEN 'POSITIVE' THEN least(greatest(4.0 + (confidence - 0.5) * 2, 1.0), 5.0)
      WHEN 'NEGATIVE' THEN least(greatest(2.0 - (confidence - 0.5) * 2, 1.0), 5.0) ELSE 3.0 END::double
      AS sentiment_score,
    map_from_entries(list_transform(list_filter([{_ASPECTS}], lambda x: x IS NOT NULL),
      lambda a: {{'k': a, 'v': 1}})) AS aspects
  FROM sentiment_base)"""


def fake_results(spark, sf) -> DataFrame:
    """Stored fake-detection rows with a probability taken from the text's md5,
    so that joins and aggregates over results do not depend on a trained model."""
    p = A.digits(F.col("text"), 5) / F.lit(16777216.0)
    return A.read(spark, sf, "documents").select(
        F.col("doc_id").alias("review_id"), p.alias("fake_probability")).withColumns({
            "confidence": B.risk_confidence(F.col("fake_probability")),
            "risk_level": B.risk_level(F.col("fake_probability"))})


FAKE_SQL = """fake AS (
  SELECT review_id, p AS fake_probability, greatest(p, 1 - p) AS confidence,
    CASE WHEN p < 0.3 THEN 'LOW' WHEN p < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level
  FROM (SELECT doc_id AS review_id, CAST('0x' || substr(md5(text), 5, 6) AS bigint) / 16777216.0::double AS p
        FROM documents))"""
