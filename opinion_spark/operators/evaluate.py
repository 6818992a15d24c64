"""Model evaluation from prediction rows (label, prediction, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.functions import text as X
from opinion_spark.operators.dedup import split_stratified, uniform_sample, union_labelled
from opinion_spark.operators.ranking import mark_sample, running_totals
from opinion_spark.session import materialize


def n_rows() -> Column:
    return F.count(F.lit(1))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(n_rows().alias("n"))


def class_report(cells: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class, from the confusion cells."""
    ends = cells.select("label", F.col("label").alias("cls"), "prediction", "n").select(
        F.explode(F.array(
            F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                     F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                     F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")))).alias("e")).select("e.*")
    totals = ends.groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    p = X.per(F.col("hit").cast("double"), F.col("predicted"))
    r = X.per(F.col("hit").cast("double"), F.col("support"))
    return totals.select("cls", "support", p.alias("precision"), r.alias("recall")).withColumn(
        "f1", X.per(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def weighted_scores(cells: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and f1."""
    def mean(c: str):
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")
    right = cells.agg(
        (F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).alias("a"))
    return class_report(cells).agg(
        mean("precision").alias("precision"), mean("recall").alias("recall"), mean("f1").alias("f1"),
        F.sum("support").alias("samples")).withColumn("accuracy", right.scalar())


def binary_scores(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """TP, FP, TN, FN and the metrics at a threshold."""
    yes, pos = F.col(score) > threshold, F.col(label) == 1
    row = df.agg(
        F.count_if(yes & pos).alias("tp"), F.count_if(yes & ~pos).alias("fp"),
        F.count_if(~yes & ~pos).alias("tn"), F.count_if(~yes & pos).alias("fn"))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return row.withColumns({
        "accuracy": X.per(tp + tn, tp + tn + fp + fn), "precision": X.per(tp, tp + fp), "recall": X.per(tp, tp + fn),
        "f1": X.per(2 * tp, 2 * tp + fp + fn)})


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by the rank sum with average ranks; 0.5 if one class is empty."""
    by_score = materialize(df.groupBy(F.col(score).alias("score")).agg(
        n_rows().alias("n"), F.count_if(F.col(label) == 1).alias("pos")))
    ranked = running_totals(by_score, [], "score", ["n"])
    average_rank = F.col("n_upto") - (F.col("n") - 1) / 2
    sums = ranked.agg(
        F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q"),
        F.sum(F.col("pos") * average_rank).alias("r"))
    p, q, r = F.col("p"), F.col("q"), F.col("r")
    return sums.select(F.when((p > 0) & (q > 0), (r - p * (p + 1) / 2) / (p * q)).otherwise(0.5).alias("auc"))


def recommender_scores(requested: DataFrame, recs: DataFrame) -> DataFrame:
    """Success rate, recommendations per user, mean rating and confidence, diversity."""
    per_user = recs.groupBy("user_id").agg(
        n_rows().alias("n"), (F.count_distinct("product_id") / n_rows()).alias("diversity"),
        F.sum("predicted_rating").alias("rating_sum"), F.sum("confidence").alias("confidence_sum"))
    joined = requested.select("user_id").distinct().join(per_user, "user_id", "left")
    served = F.count("n")
    row = joined.agg(
        n_rows().alias("users"), served.alias("served"), (served / n_rows()).alias("success_rate"),
        X.per(F.sum("n").cast("double"), served).alias("recs_per_user"),
        F.coalesce(F.sum("rating_sum") / F.sum("n"), F.lit(0.0)).alias("avg_predicted"),
        F.coalesce(F.sum("confidence_sum") / F.sum("n"), F.lit(0.0)).alias("avg_confidence"),
        F.coalesce(F.avg("diversity"), F.lit(0.0)).alias("avg_diversity"))
    p, r = F.col("avg_confidence"), F.col("success_rate")
    return row.withColumn("pseudo_f1", X.per(2 * p * r, p + r))


def validation_report(results: DataFrame) -> DataFrame:
    """One row over the results of all models: means and improvement hints.

    ``results``: model_name, accuracy, f1_score, sample_size - one row per model.
    """
    weak = F.when(F.col("accuracy") < 0.7, F.concat(
        "model_name", F.lit(": Consider retraining with more data or feature engineering")))
    unbalanced = F.when(F.col("f1_score") < 0.6, F.concat(
        "model_name", F.lit(": F1-score indicates class imbalance, consider balanced sampling")))
    hints = F.flatten(F.array_sort(F.collect_list(F.array_compact(F.array(weak, unbalanced)))))
    return results.agg(
        n_rows().alias("models"), F.round(F.avg("accuracy"), 4).alias("overall_accuracy"),
        F.round(F.avg("f1_score"), 4).alias("overall_f1"), F.sum("sample_size").alias("total_samples"),
        hints.alias("h")).withColumn("recommendations", F.array_join(F.when(F.size("h") > 0, F.col("h")).otherwise(
            F.array(F.lit("All models performing well - consider production deployment"))), "; ")).drop("h")


INSIGHTS = {  # ---- fixed values: label and measure of each model's insights ----
    "sentiment_analyzer": [("Average confidence", "avg_confidence"), ("Rating correlation", "rating_correlation")],
    "fake_detector": [("AUC Score", "auc_score"), ("Detection accuracy", "accuracy")],
    "recommendation_engine": [("Success rate", "success_rate"), ("Recommendation diversity", "avg_diversity")],
}


def model_insights(results: DataFrame) -> DataFrame:
    """(model_name, accuracy, f1_score, sample_size, key_insights): two measures of each model as one line.

    ``results``: as for ``validation_report``, with ``details``, a map from measure to
    value. A measure that is absent counts as 0; other models have no insights.
    """
    def told(label: str, measure: str) -> Column:
        value = F.col("accuracy") if measure == "accuracy" else F.try_element_at("details", F.lit(measure))
        return F.format_string(f"{label}: %.3f", F.coalesce(value.cast("double"), F.lit(0.0)))
    lines = F.lit("")
    for model, measures in INSIGHTS.items():
        lines = F.when(F.col("model_name") == model, F.concat_ws("; ", *[told(*m) for m in measures])).otherwise(lines)
    return results.select("model_name", F.round("accuracy", 4).alias("accuracy"), F.round("f1_score", 4).alias("f1_score"),
                          "sample_size", lines.alias("key_insights"))


def validation_sets(reviews: DataFrame, fakes: DataFrame, test_share: float = 0.2, fake_test_share: float = 0.3,
                    real: int | None = None, fake: int | None = None, id_col: str = "review_id") -> DataFrame:
    """(dataset, id, label, is_test): the three sets on which models are validated.

    ``sentiment`` is split within the sentiment of the rating, ``rating_prediction``
    over all reviews, ``fake_detection`` within real and fake rows. ``reviews``:
    id, rating; ``fakes``: id, is_fake. ``real`` and ``fake`` ask for samples of so
    many rows; by default every row takes part.
    """
    rated = reviews.select(id_col, F.col("rating").cast("string").alias("label"))
    felt = reviews.select(id_col, B.rating_sentiment(F.col("rating")).alias("label"))
    asked = {1: fake, 0: real}
    parts = [fakes.where(F.col("is_fake") == k) if n is None else uniform_sample(
        fakes.where(F.col("is_fake") == k), n, id_col, f"validation {k}") for k, n in asked.items()]
    mixed = parts[0].unionByName(parts[1]).select(id_col, F.col("is_fake").cast("string").alias("label"))
    return union_labelled({
        "sentiment": split_stratified(felt, test_share, "label", id_col, "sentiment"),
        "rating_prediction": mark_sample(
            rated, [], F.round(F.col("n") * test_share), id_col, "rating", "is_test"),
        "fake_detection": split_stratified(mixed, fake_test_share, "label", id_col, "fake")}, "dataset")


def system_coverage(counts: DataFrame) -> DataFrame:
    """One row over (table_name, rows): which models have results, and whether there are reviews at all."""
    def some(table: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("table_name") == table, F.col("rows") > 0)), F.lit(False))
    return counts.agg(
        some("sentiment_analysis").alias("sentiment_analysis"), some("fake_detection").alias("fake_detection"),
        some("user_recommendations").alias("recommendations"),
        F.when(some("reviews"), "operational").otherwise("failed").alias("data_pipeline_status"))


def training_report(results: DataFrame) -> DataFrame:
    """Success rate and status over the steps of a training run (step, succeeded)."""
    ok = F.count_if("succeeded")
    return results.agg(
        n_rows().alias("steps"), ok.alias("successful"), (ok / n_rows()).alias("success_rate"),
        F.when(ok == n_rows(), "success").otherwise("partial_success").alias("status"))


def sample_metrics(scored: DataFrame, model: str) -> DataFrame:
    """Metric rows of scored samples: share correct, mean confidence, mean score.

    ``scored``: correct 0/1, confidence, fake_probability.
    """
    p = F.col("fake_probability")
    row = scored.agg(
        F.avg(F.col("correct").cast("double")).alias("accuracy"), F.avg("confidence").alias("avg_confidence"),
        F.avg(p).alias("avg_fake_probability"), F.count_if(p > 0.7).cast("double").alias("high_risk"),
        F.count_if(p < 0.3).cast("double").alias("low_risk"), F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"), n_rows().alias("sample_size"))
    names = ["accuracy", "avg_confidence", "avg_fake_probability", "high_risk", "low_risk",
             "min_probability", "max_probability"]
    return row.unpivot(["sample_size"], names, "metric_name", "metric_value").withColumn("model_name", F.lit(model))
