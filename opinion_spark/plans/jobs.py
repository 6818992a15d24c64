"""Whole jobs: ETL, training, validation, drift, product analytics.

``as_of`` stands for "now" everywhere, so a job gives the same result when it
is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.operators import aggregates as G
from opinion_spark.operators import cleaning as C
from opinion_spark.operators import drift as T
from opinion_spark.operators import evaluate as E
from opinion_spark.operators import fakes as M
from opinion_spark.operators import quality as Q
from opinion_spark.operators import recommend as R
from opinion_spark.operators import sentiment as N
from opinion_spark.session import materialize
from opinion_spark.sources import tables as S


def run_etl(raw: DataFrame, out: str, as_of: str, target: int | None = None) -> DataFrame:
    """Clean, check, write reviews / products / users, return the report row.

    Fails before anything is written if a check fails. The written review table
    feeds the later steps, so the cleaning runs once.
    """
    spark = raw.sparkSession
    cleaned = materialize(C.clean_reviews(raw, as_of, target))
    failed = [r["check_name"] for r in Q.dataset_checks(cleaned).where("NOT passed").collect()]
    if failed:
        raise ValueError(f"dataset checks failed: {failed}")
    S.write_table(cleaned, f"{out}/reviews", partition_by=["year"])
    S.write_table(G.products_table(cleaned), f"{out}/products")
    S.write_table(G.users_table(cleaned), f"{out}/users")
    quality = Q.overall_quality(cleaned, "date", as_of)
    report = Q.final_report(raw, cleaned, "date").withColumn(
        "quality", quality.select(F.struct(*quality.columns).alias("q")).scalar())
    S.write_report(report, f"{out}/report")
    return spark.read.json(f"{out}/report")


def product_analytics(reviews: DataFrame, sentiment: DataFrame, fake: DataFrame, date: str, as_of: str) -> DataFrame:
    """One row per product: counts, sentiment shares, fake percent, top aspects, trend.

    ``sentiment`` and ``fake`` carry product_id. Every part is aggregated per
    product first, so the final joins are between one-row-per-product tables.
    """
    core = G.product_core(reviews)
    shares = G.sentiment_by_product(sentiment).groupBy("product_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("overall_sentiment", "percent")))).alias("sentiment_pct"))
    aspects = G.top_aspects(G.aspect_rows(sentiment, keep=("product_id",))).groupBy("product_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("mentions")).alias("k"), "aspect", "avg_sentiment"))).alias("a"))
    trend = G.daily_trend(reviews, date, as_of).groupBy("product_id").agg(
        F.array_sort(F.collect_list(F.struct("day", "review_count", "avg_rating"))).alias("trend"))
    out = (
        core.join(shares, "product_id", "left")
        .join(G.fake_by_product(fake).select("product_id", "fake_pct"), "product_id", "left")
        .join(aspects.select("product_id", F.col("a.aspect").alias("top_aspects")), "product_id", "left")
        .join(trend, "product_id", "left"))
    pct = F.coalesce("fake_pct", F.lit(0.0))
    return out.withColumns({
        "fake_pct": pct, "risk_band": B.product_risk_band(pct),
        "verdict": B.product_verdict(F.col("average_rating"), pct, F.col("review_count"))})


def drift_inputs(sides: DataFrame, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """The numeric drift features and the sentiment rows, each computed once."""
    features = materialize(T.drift_features(sides, date))
    scored = N.analyze(sides, ("review_id", "side", "rating")).select("side", "rating", "overall_sentiment")
    return features, scored


def run_drift(sides: DataFrame, date: str = "date", alpha: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """All drift results and the one-row report with its advice."""
    features, scored = drift_inputs(sides, date)
    distribution = materialize(T.distribution_drift(features, alpha))  # one row per feature
    results = materialize(
        distribution.select(*T.RESULT).unionByName(T.rating_shift(distribution))
        .unionByName(T.concept_drift(scored).select(*T.RESULT))
        .unionByName(T.temporal_drift(features.select("review_id", "side", date, "rating"), date).select(*T.RESULT)))
    report = T.drift_report(results)
    severity = report.select("severity").scalar()
    return results, report.withColumn(
        "recommendations", T.drift_advice(results, severity).select("recommendations").scalar())


def run_training(
    reviews: DataFrame, labels: DataFrame, out: str, limit: int | None = None, folds: int = 5, grid=None, recommend_for: DataFrame | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Score sentiment, train the fake detector, recommend; return the step report.

    ``labels``: review_id, is_fake. All labelled reviews train the detector, or a sample of ``limit`` of them on
    request. All reviews are scored, not a sample. All five methods are blended. ``vectors``: (product_id, vector) of the items; without
    it they are the content features of the reviews themselves.
    """
    spark = reviews.sparkSession
    S.write_table(N.aspects_json(N.analyze(reviews)), f"{out}/sentiment_analysis")
    features = materialize(M.all_features(reviews))
    marked = features.join(labels, "review_id")
    data = materialize(M.training_set(marked.where("is_fake = 0"), marked.where("is_fake = 1"), limit))
    model, _, metrics = M.train(data, folds=folds, grid=grid)
    M.save_model(model, f"{out}/fake_model")
    S.write_table(M.predict(model, features), f"{out}/fake_detection")
    ratings = materialize(R.user_item_ratings(reviews))
    wanted = ratings.select("user_id").distinct() if recommend_for is None else recommend_for
    if vectors is None:
        texts = reviews.select("product_id", F.col("review_text").alias("combined_text"))
        stats = G.product_core(reviews).withColumnRenamed("average_rating", "avg_rating")
        vectors = R.item_features(texts, stats)
    vectors = materialize(vectors)
    near, similar = R.item_tables(vectors)
    recs = R.hybrid({
        "user_based": R.user_based(ratings, R.user_neighbours(ratings), 20),
        "item_based": R.item_based(ratings, near, 20),
        "content_based": R.content_based(ratings, similar, reviews, 20),
        "matrix_factorization": R.matrix_factorization(ratings, 20),
        "popular": R.popular_for(wanted, R.popular(reviews))}, neighbours=near)
    S.write_table(recs.join(wanted, "user_id", "left_semi"), f"{out}/user_recommendations")
    steps = None
    for name in ("sentiment_analysis", "fake_detection", "user_recommendations"):
        one = spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("step"), "rows", (F.col("rows") > 0).alias("succeeded"))
        steps = one if steps is None else steps.unionAll(one)
    held = reviews.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("reviews").alias("table_name"), "rows")
    coverage = E.system_coverage(steps.select(F.col("step").alias("table_name"), "rows").unionByName(held))
    report = E.training_report(steps).withColumns({
        "fake_metrics": metrics.select(F.struct(*metrics.columns).alias("m")).scalar(),
        "system_evaluation": coverage.select(F.struct(*coverage.columns).alias("c")).scalar()})
    S.write_report(report, f"{out}/training_report")
    return report


def run_validation(scored: DataFrame, fakes: DataFrame, requested: DataFrame, recs: DataFrame) -> DataFrame:
    """Evaluate sentiment rows, fake rows and recommendations; one report row with the insights of each model.

    ``scored``: rating, overall_sentiment, confidence; ``fakes``: is_fake,
    fake_probability, as ``fakes.predict`` gives it on rows the model was not fitted on.
    """
    scored, fakes = materialize(scored), materialize(fakes)
    cells = materialize(E.confusion(
        scored.select(B.rating_sentiment(F.col("rating")).alias("label"), F.col("overall_sentiment").alias("prediction"))))
    confidence = scored.agg(F.avg("confidence").alias("c"))
    s = E.weighted_scores(cells).select(
        F.lit("sentiment_analyzer").alias("model_name"), "accuracy", F.col("f1").alias("f1_score"),
        F.col("samples").alias("sample_size"), F.create_map(
            F.lit("avg_confidence"), confidence.scalar(),
            F.lit("rating_correlation"), N.rating_correlation(scored).scalar()).alias("details"))
    f = E.binary_scores(fakes, "is_fake", "fake_probability").select(
        F.lit("fake_detector").alias("model_name"), "accuracy", F.col("f1").alias("f1_score"),
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("sample_size"),
        F.create_map(F.lit("auc_score"), E.roc_auc(fakes, "is_fake", "fake_probability").scalar()).alias("details"))
    r = E.recommender_scores(requested, recs).select(
        F.lit("recommendation_engine").alias("model_name"), F.col("success_rate").alias("accuracy"),
        F.col("pseudo_f1").alias("f1_score"), F.col("users").alias("sample_size"), F.create_map(
            F.lit("success_rate"), F.col("success_rate"), F.lit("avg_diversity"), F.col("avg_diversity")).alias("details"))
    results = materialize(s.unionByName(f).unionByName(r))  # one row per model
    insights = E.model_insights(results)
    models = insights.agg(F.array_sort(F.collect_list(F.struct(*insights.columns))).alias("m"))
    return E.validation_report(results).withColumn("model_results", models.scalar())


def replace_recommendations(stored: DataFrame, fresh: DataFrame, path: str) -> None:
    """Replace the rows of the users in ``fresh``; all other users keep theirs."""
    S.write_table(materialize(S.replace_rows(stored, fresh, "user_id")), path)


def save_drift(spark: SparkSession, results: DataFrame, report: DataFrame, analysis_id: str, out: str) -> None:
    """Append the detail rows and upsert the report row of an analysis."""
    detail = results.withColumn("analysis_id", F.lit(analysis_id))
    S.append_table(detail, f"{out}/drift_results")
    row = report.withColumn("analysis_id", F.lit(analysis_id))
    S.write_table(row, f"{out}/drift_analysis/analysis_id={analysis_id}")


