"""Drift between a baseline and a comparison side of the same table."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X
from opinion_spark.operators.dedup import uniform_sample
from opinion_spark.operators.ranking import row_index, running_totals
from opinion_spark.session import materialize


def n_rows() -> Column:
    return F.count(F.lit(1))
BASE, COMP = "baseline", "comparison"
NUMERIC = [
    "rating", "text_length", "word_count", "sentence_count", "helpful_votes", "total_votes",
    "helpful_ratio", "exclamation_count", "caps_ratio", "positive_food_words", "negative_food_words",
]
CATEGORICAL = ["rating_category", "text_length_category"]


def select_sides(
    df: DataFrame, date: str, split: str, baseline_size: int | None = None, comparison_size: int | None = None,
    id_col: str = "review_id",
) -> DataFrame:
    """Rows before and from the split date, each optionally a sample: the
    baseline at random, the comparison the latest rows."""
    base = df.where(F.col(date) < F.lit(split).cast("timestamp"))
    comp = df.where(F.col(date) >= F.lit(split).cast("timestamp"))
    if baseline_size is not None:
        base = uniform_sample(base, baseline_size, id_col, "baseline")
    if comparison_size is not None:
        comp = comp.orderBy(F.desc(date), id_col).limit(comparison_size)
    return base.withColumn("side", F.lit(BASE)).unionByName(comp.withColumn("side", F.lit(COMP)))


def drift_features(df: DataFrame, date: str = "date") -> DataFrame:
    """The features compared between the sides."""
    t = F.col("review_text")
    hits = X.words_and_hits(F.lower(t), {"positive_food_words": L.DRIFT_POSITIVE, "negative_food_words": L.DRIFT_NEGATIVE})
    rows = materialize(df.select(  # the texts are read once, for the means as well
        "review_id", "side", date, "rating", "helpful_votes", "total_votes", F.length(t).alias("text_length"),
        X.marks(t).alias("__marks"), hits.alias("__hits")).select("*", "__hits.*"))
    means = rows.groupBy("side").agg(F.avg("rating").alias("__mean"))
    out = rows.join(F.broadcast(means), "side")  # two rows: one per side
    m, length = F.col("__marks"), F.col("text_length")
    return out.select(
        "review_id", "side", date, "rating", "helpful_votes", "total_votes", "text_length", "word_count",
        (X.of_marks(m, ".") + 1).alias("sentence_count"), X.of_marks(m, "!").alias("exclamation_count"),
        X.of_marks(m, "?").alias("question_count"), (X.capitals_of_marks(m) / F.greatest(length, F.lit(1))).alias("caps_ratio"),
        B.helpful_plus_one(F.col("helpful_votes"), F.col("total_votes")).alias("helpful_ratio"),
        F.abs(F.col("rating") - F.col("__mean")).alias("rating_deviation"),
        "positive_food_words", "negative_food_words",
        F.year(date).alias("year"), F.month(date).alias("month"), F.weekday(date).alias("day_of_week"),
        B.rating_category(F.col("rating")).alias("rating_category"),
        B.length_category(length).alias("text_length_category"))


# ---- numeric features: Kolmogorov-Smirnov --------------------------------
def value_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, b, c): counts per side, for all features in one shuffle."""
    long = df.select("side", *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        ["side"], features, "feature", "value").where("value IS NOT NULL")
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == BASE).alias("b"), F.count_if(F.col("side") == COMP).alias("c"))


def ks_p_value(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Kolmogorov's series 2 * sum (-1)^(k-1) exp(-2 k^2 x^2), x = D sqrt(n1 n2 / (n1 + n2))."""
    x2 = d * d * n1 * n2 / (n1 + n2)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x2))
    return F.when(x2 < 1e-3, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_test(counts: DataFrame) -> DataFrame:
    """D and p per feature, from the counts per distinct value."""
    counts = materialize(counts)
    totals = counts.groupBy("feature").agg(F.sum("b").alias("n1"), F.sum("c").alias("n2"))
    curves = running_totals(counts, ["feature"], "value", ["b", "c"]).join(F.broadcast(totals), "feature")
    gap = F.abs(F.col("b_upto") / F.col("n1") - F.col("c_upto") / F.col("n2"))
    both = (F.col("n1") > 0) & (F.col("n2") > 0)
    out = curves.groupBy("feature", "n1", "n2").agg(F.max(F.when(both, gap)).alias("d"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    return out.select(
        "feature", "n1", "n2", F.coalesce("d", F.lit(0.0)).alias("magnitude"),
        F.when(F.col("d").isNull(), F.lit(1.0)).otherwise(ks_p_value(F.col("d"), n1, n2)).alias("p_value"),
        F.when(F.col("d").isNull(), "insufficient_data").otherwise("ks_test").alias("test"))


# ---- categorical features: chi-square ------------------------------------
@F.pandas_udf(DoubleType())
def chi2_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of chi-square, by the closed forms for whole degrees of freedom.

    Runs on one row per feature."""
    def tail(x: float, k: int) -> float:
        if k < 1 or x <= 0:
            return 1.0
        half = x / 2
        if k % 2 == 0:
            term = total = math.exp(-half)
            for i in range(1, k // 2):
                term *= half / i
                total += term
            return total
        total = math.erfc(math.sqrt(half))
        term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
        for i in range((k - 1) // 2):
            total += term
            term *= half / (i + 1.5)
        return total
    return pd.Series([tail(float(x), int(k)) for x, k in zip(stat, dof)])


def chi2_test(df: DataFrame, features: list[str] = CATEGORICAL) -> DataFrame:
    """Chi-square over aligned category counts; Yates' correction for two categories."""
    long = df.select("side", *features).unpivot(["side"], features, "feature", "category").where("category IS NOT NULL")
    cells = long.groupBy("feature", "category").agg(
        F.count_if(F.col("side") == BASE).cast("double").alias("b"),
        F.count_if(F.col("side") == COMP).cast("double").alias("c"))
    totals = cells.groupBy("feature").agg(F.sum("b").alias("n1"), F.sum("c").alias("n2"), n_rows().alias("k"))
    joined = cells.join(F.broadcast(totals), "feature")  # one row per feature
    share = (F.col("b") + F.col("c")) / (F.col("n1") + F.col("n2"))
    gap = F.abs(F.col("b") - share * F.col("n1"))
    fix = F.when(F.col("k") == 2, F.least(F.lit(0.5), gap)).otherwise(F.lit(0.0))
    part = F.pow(gap - fix, 2) * (1 / (share * F.col("n1")) + 1 / (share * F.col("n2")))
    both = (F.col("n1") > 0) & (F.col("n2") > 0)
    out = joined.groupBy("feature", "n1", "n2", "k").agg(F.sum(F.when(both, part)).alias("chi2"))
    return out.select(
        "feature", F.col("n1").cast("long").alias("n1"), F.col("n2").cast("long").alias("n2"), "chi2",
        (F.col("k") - 1).alias("dof"),
        F.coalesce(F.col("chi2") / (F.col("n1") + F.col("n2")), F.lit(0.0)).alias("magnitude"),
        F.coalesce(chi2_p_value(F.coalesce("chi2", F.lit(0.0)), F.col("k") - 1), F.lit(1.0)).alias("p_value"),
        F.when(F.col("chi2").isNull(), "insufficient_data").otherwise("chi2_test").alias("test"))


def descriptives(counts: DataFrame) -> DataFrame:
    """n, mean and deviation of each feature on both sides, from the value counts."""
    v = F.col("value")
    def moments(n: str, side: str) -> list[Column]:
        total, s, ss = F.sum(n), F.sum(v * F.col(n)), F.sum(v * v * F.col(n))
        variance = F.when(total > 1, F.greatest(F.lit(0.0), (ss - s * s / total) / (total - 1)))
        return [total.alias(f"{side}_samples"), F.when(total > 0, s / total).alias(f"{side}_mean"),
                F.sqrt(variance).alias(f"{side}_std")]
    return counts.groupBy("feature").agg(*moments("b", BASE), *moments("c", COMP)).withColumn(
        "mean_shift", F.abs(F.col(f"{COMP}_mean") - F.col(f"{BASE}_mean")))


def distribution_drift(features: DataFrame, alpha: float = 0.05, numeric: list[str] = NUMERIC,
                       categorical: list[str] = CATEGORICAL) -> DataFrame:
    """One result row per feature: test, magnitude, p, drift flag."""
    both = ks_test(value_counts(features, numeric)).select("feature", "test", "magnitude", "p_value")
    if categorical:
        both = both.unionByName(chi2_test(features, categorical).select("feature", "test", "magnitude", "p_value"))
    return both.select(
        "feature", F.lit("distribution").alias("drift_type"), "test", "magnitude", "p_value",
        (F.col("p_value") < alpha).alias("drift_detected"))


# ---- concept and temporal drift ------------------------------------------
def concept_drift(scored: DataFrame, max_drop: float = 0.10) -> DataFrame:
    """Change of the share of reviews whose sentiment label fits their rating."""
    right = (F.col("overall_sentiment") == B.rating_sentiment(F.col("rating"))).cast("int")
    row = scored.agg(
        F.coalesce(F.avg(F.when(F.col("side") == BASE, right)), F.lit(0.0)).alias("baseline_accuracy"),
        F.coalesce(F.avg(F.when(F.col("side") == COMP, right)), F.lit(0.0)).alias("comparison_accuracy"))
    drop = F.abs(F.col("baseline_accuracy") - F.col("comparison_accuracy"))
    return row.select(
        F.lit("sentiment_model_performance").alias("feature"), F.lit("concept").alias("drift_type"),
        F.lit("performance_comparison").alias("test"), drop.alias("magnitude"),
        F.when(drop > max_drop, 0.05).otherwise(0.1).alias("p_value"), (drop > max_drop).alias("drift_detected"),
        "baseline_accuracy", "comparison_accuracy")


def rating_shift(distribution: DataFrame) -> DataFrame:
    """The rating row again as a concept signal, if it drifts."""
    return distribution.where((F.col("feature") == "rating") & F.col("drift_detected")).select(
        F.lit("rating_distribution_concept").alias("feature"), F.lit("concept").alias("drift_type"),
        F.lit("rating_shift_analysis").alias("test"), "magnitude", "p_value", F.lit(True).alias("drift_detected"))


def temporal_drift(df: DataFrame, date: str, id_col: str = "review_id") -> DataFrame:
    """Correlation of the monthly means of both sides and change of the trend slope."""
    monthly = df.groupBy(F.month(date).alias("month")).agg(
        F.avg(F.when(F.col("side") == BASE, F.col("rating"))).alias("b"),
        F.avg(F.when(F.col("side") == COMP, F.col("rating"))).alias("c"))
    both = monthly.where("b IS NOT NULL AND c IS NOT NULL")
    season = both.agg(F.when(n_rows() > 1, F.corr("b", "c")).otherwise(F.lit(0.0)).alias("r"))
    placed = row_index(df.select("side", id_col, date, "rating"), ["side"], date, id_col)
    def slope(side: str) -> Column:
        one = F.col("side") == side
        return F.coalesce(F.regr_slope(
            F.when(one, F.col("rating").cast("double")), F.when(one, F.col("row_index").cast("double"))), F.lit(0.0))
    trends = placed.agg(slope(BASE).alias("baseline_trend"), slope(COMP).alias("comparison_trend"))
    row = trends.withColumns({
        "seasonal_correlation": season.scalar(),
        "trend_change": F.abs(F.col("comparison_trend") - F.col("baseline_trend"))})
    magnitude = 1 - F.abs("seasonal_correlation")
    found = (magnitude > 0.3) | (F.col("trend_change") > 0.1)
    return row.select(
        F.lit("temporal_patterns").alias("feature"), F.lit("temporal").alias("drift_type"),
        F.lit("temporal_correlation_analysis").alias("test"), magnitude.alias("magnitude"),
        F.when(found, 0.05).otherwise(0.1).alias("p_value"), found.alias("drift_detected"),
        "seasonal_correlation", "baseline_trend", "comparison_trend", "trend_change")


# ---- report ---------------------------------------------------------------
RESULT = ["feature", "drift_type", "test", "magnitude", "p_value", "drift_detected"]


def drift_report(results: DataFrame) -> DataFrame:
    """Counts, share, severity and retraining advice over all result rows."""
    share = F.count_if("drift_detected") / F.greatest(n_rows(), F.lit(1))
    row = results.agg(
        n_rows().alias("total_features"), F.count_if("drift_detected").alias("features_with_drift"),
        share.alias("drift_share"), F.count_if(F.col("magnitude") > 0.5).alias("high_magnitude"),
        F.count_if(F.col("p_value") < 0.01).alias("significant"),
        F.count_if(F.col("drift_type") == "concept").alias("concept_signals"),
        F.count_if((F.col("drift_type") == "distribution") & F.col("drift_detected")).alias("distribution_drifts"))
    s = F.col("drift_share")
    return row.withColumns({
        "severity": F.when(s >= 0.7, "CRITICAL").when(s >= 0.4, "HIGH").when(s >= 0.2, "MEDIUM").otherwise("LOW"),
        "retrain": s >= 0.4})


# ---- fixed values: advice per severity -----------------------------------
ADVICE = {
    "CRITICAL": ["IMMEDIATE ACTION: Retrain all models with recent data",
                 "Implement emergency monitoring and rollback procedures",
                 "Review data pipeline for quality issues"],
    "HIGH": ["Schedule model retraining within 1 week", "Increase monitoring frequency to daily",
             "Investigate root causes of drift"],
    "MEDIUM": ["Plan model retraining within 1 month", "Monitor key performance metrics closely",
               "Consider gradual model updates"],
    "LOW": ["Continue regular monitoring schedule", "Document drift patterns for future reference"],
}
CONCEPT_ADVICE = "Concept drift detected - review model assumptions and feature relevance"
RATING_ADVICE = "Rating distribution changed - review sentiment model calibration"
TEXT_ADVICE = "Text patterns changed - consider updating text preprocessing and features"


def drift_advice(results: DataFrame, severity: Column) -> DataFrame:
    """The recommendations of a report, in order, as one array."""
    found = F.col("drift_detected")
    facts = results.agg(
        F.max((F.col("drift_type") == "concept") & found).alias("concept"),
        F.array_sort(F.collect_list(F.when(F.col("magnitude") > 0.7, F.col("feature")))).alias("large"),
        F.max((F.col("feature") == "rating") & found).alias("rating"),
        F.max(F.contains("feature", F.lit("text")) & found).alias("text"))
    by_severity = F.array(*[F.lit(s) for s in ADVICE["LOW"]])
    for level in ("MEDIUM", "HIGH", "CRITICAL"):
        by_severity = F.when(severity == level, F.array(*[F.lit(s) for s in ADVICE[level]])).otherwise(by_severity)
    extra = F.array_compact(F.array(
        F.when(F.col("concept"), F.lit(CONCEPT_ADVICE)),
        F.when(F.size("large") > 0, F.concat(
            F.lit("High magnitude drift in: "), F.array_join("large", ", "), F.lit(" - investigate data sources"))),
        F.when(F.col("rating"), F.lit(RATING_ADVICE)), F.when(F.col("text"), F.lit(TEXT_ADVICE))))
    return facts.select(F.concat(by_severity, extra).alias("recommendations"))
