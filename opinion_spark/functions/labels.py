"""Bins, labels and small arithmetic rules as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def helpful_if_voted(h: Column, t: Column) -> Column:
    return F.when(t > 0, h / t).otherwise(F.lit(0.0))


def helpful_floor_one(h: Column, t: Column) -> Column:
    return h / F.greatest(t, F.lit(1))


def helpful_plus_one(h: Column, t: Column) -> Column:
    return h / (t + 1)


def extreme_rating(r: Column) -> Column:
    return r.isin(1, 5).cast("int")


def rating_category(r: Column) -> Column:
    """(0,2] low, (2,3] medium, (3,4] high, (4,5] very_high, else null."""
    return (
        F.when((r > 0) & (r <= 2), "low").when((r > 2) & (r <= 3), "medium")
        .when((r > 3) & (r <= 4), "high").when((r > 4) & (r <= 5), "very_high")
    )


def length_category(n: Column) -> Column:
    """(0,50] short, (50,150] medium, (150,500] long, above very_long, 0 null."""
    return (
        F.when((n > 0) & (n <= 50), "short").when((n > 50) & (n <= 150), "medium")
        .when((n > 150) & (n <= 500), "long").when(n > 500, "very_long")
    )


def rating_sentiment(r: Column) -> Column:
    return F.when(r >= 4, "POSITIVE").when(r <= 2, "NEGATIVE").otherwise("NEUTRAL")


def sentiment_value(label: Column) -> Column:
    return F.when(label == "POSITIVE", 4.5).when(label == "NEGATIVE", 1.5).otherwise(3.0)


def sentiment_to_rating(label: Column, confidence: Column) -> Column:
    raw = (
        F.when(label == "POSITIVE", 4.0 + (confidence - 0.5) * 2)
        .when(label == "NEGATIVE", 2.0 - (confidence - 0.5) * 2)
        .otherwise(F.lit(3.0))
    )
    return F.least(F.greatest(raw, F.lit(1.0)), F.lit(5.0))


def normalize_model_label(label: Column) -> Column:
    up = F.upper(label)
    return (
        F.when(up.isin("LABEL_2", "POSITIVE", "POS"), "POSITIVE")
        .when(up.isin("LABEL_0", "NEGATIVE", "NEG"), "NEGATIVE").otherwise("NEUTRAL")
    )


def risk_level(p: Column) -> Column:
    return F.when(p < 0.3, "LOW").when(p < 0.7, "MEDIUM").otherwise("HIGH")


def risk_confidence(p: Column) -> Column:
    return F.greatest(p, 1 - p)


def authenticity(p: Column) -> Column:
    return F.when(p < 0.3, "Likely Authentic").when(p < 0.7, "Questionable").otherwise("Likely Fake")


def detail_level(n: Column) -> Column:
    return F.when(n > 100, "Detailed").when(n > 50, "Moderate").otherwise("Brief")


def review_value(score: Column, p: Column) -> Column:
    """Label from the 1-5 sentiment score, centred to [-1, 1], and p(fake)."""
    centred = (score - 3) / 2
    return (
        F.when((centred > 0.2) & (p < 0.3), "High Value Review")
        .when((centred < -0.2) & (p < 0.3), "Critical Feedback")
        .when(p > 0.7, "Treat with Caution").otherwise("Standard Review")
    )


def product_verdict(rating: Column, fake_pct: Column, n: Column) -> Column:
    return (
        F.when((rating >= 4.0) & (fake_pct < 3) & (n > 50), "Highly Recommended")
        .when((rating >= 3.5) & (fake_pct < 5), "Good Choice")
        .when(fake_pct > 10, "Exercise Caution").otherwise("Mixed Results")
    )


def product_risk_band(fake_pct: Column) -> Column:
    return F.when(fake_pct < 2, "LOW").when(fake_pct < 5, "MEDIUM").otherwise("HIGH")


def rating_badge(r: Column) -> Column:
    return F.when(r >= 4, "excellent").when(r >= 3, "good").otherwise("poor")


def model_status(v: Column) -> Column:
    return F.when(v >= 0.8, "Excellent").when(v >= 0.6, "Good").otherwise("Needs Improvement")


def sentiment_grade(conf: Column, seconds: Column) -> Column:
    return (
        F.when((conf > 0.8) & (seconds < 1), "Excellent")
        .when((conf > 0.6) & (seconds < 2), "Good").otherwise("Needs Improvement")
    )


def fake_rate_grade(p: Column) -> Column:
    return F.when(p < 0.05, "High Quality").when(p < 0.10, "Good Quality").otherwise("Mixed Quality")


def coverage_grade(pct: Column) -> Column:
    return F.when(pct > 80, "Excellent").when(pct > 50, "Good").otherwise("Limited")


def recommendation_grade(rating: Column, confidence: Column) -> Column:
    return (
        F.when((rating >= 4) & (confidence >= 0.7), "Excellent")
        .when((rating >= 3.5) & (confidence >= 0.5), "Good").otherwise("Mixed")
    )


def weekday_monday_zero(ts: Column) -> Column:
    return F.weekday(ts)


def epoch_or_text(seconds: Column | None, text: Column | None, as_of: str) -> Column:
    """Epoch seconds if given, else a parsed text, else ``as_of``."""
    options = []
    if seconds is not None:
        options.append(F.timestamp_seconds(seconds))
    if text is not None:
        options.append(F.try_to_timestamp(text))
        options.append(F.try_to_timestamp(text, F.lit("MM d, yyyy")))
        options.append(F.try_to_timestamp(text, F.lit("MM dd yyyy")))
    return F.coalesce(*options, F.lit(as_of).cast("timestamp"))
