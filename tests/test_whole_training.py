"""Training reads every labelled review; a sample is drawn on request only."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from opinion_spark.catalog import jobs as Q
from opinion_spark.operators import fakes as M
from opinion_spark.plans import jobs as J


class Fitted(Exception):
    """Ends a job where it would train."""


@pytest.fixture
def fitted_on(monkeypatch):
    def stop(data, **_):
        raise Fitted({r["label"]: r["count"] for r in data.groupBy("label").count().collect()})

    monkeypatch.setattr(M, "train", stop)


def reviews(spark, n):
    return spark.range(n).select(
        F.col("id").alias("review_id"), F.concat(F.lit("p"), F.col("id") % 7).alias("product_id"),
        F.concat(F.lit("u"), F.col("id") % 11).alias("user_id"), (1 + F.col("id") % 5).cast("int").alias("rating"),
        F.concat(F.lit("fresh and good "), F.col("id")).alias("review_text"), F.lit(1).alias("helpful_votes"),
        F.lit(2).alias("total_votes"), F.lit("2012-01-01").cast("timestamp").alias("date"), F.lit("en").alias("lang"))


def labels(spark, n):
    return spark.range(n).select(F.col("id").alias("review_id"), F.when(F.col("id") % 13 == 0, 1).otherwise(0).alias("is_fake"))


def test_training_set_holds_all_rows(spark):
    rows = spark.range(2600).withColumnRenamed("id", "review_id")
    whole = M.training_set(rows.where("review_id % 13 > 0"), rows.where("review_id % 13 = 0"))
    assert dict(whole.groupBy("label").count().collect()) == {0.0: 2400, 1.0: 200}
    assert dict(M.training_set(rows, rows, 20).groupBy("label").count().collect()) == {0.0: 10, 1.0: 10}


def test_queries_that_train_fit_on_all_labelled_rows(spark, fitted_on, monkeypatch):
    table = labels(spark, 2600).select(F.col("review_id").alias("doc_id"), (1 - F.col("is_fake")).alias("quality"))
    monkeypatch.setattr(Q, "TEXT", lambda *_: reviews(spark, 2600))
    monkeypatch.setattr(Q.A, "read", lambda *_: table)
    with pytest.raises(Fitted) as found:
        Q._fit(spark, "")
    assert found.value.args[0] == {0.0: 2400, 1.0: 200}


def test_training_job_fits_on_all_labelled_rows(spark, fitted_on, tmp_path):
    with pytest.raises(Fitted) as found:
        J.run_training(reviews(spark, 2600), labels(spark, 2600), str(tmp_path))
    assert found.value.args[0] == {0.0: 2400, 1.0: 200}


def test_forests_of_the_grid_are_let_go(spark):
    rows = spark.range(60).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("label")).coalesce(1).cache()
    forest = RandomForestClassifier(featuresCol="raw", labelCol="label", seed=3, numTrees=2)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [1, 25, 30]).addGrid(forest.minInstancesPerNode, [1, 2]).build()
    points = M.ForestPipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="raw"), forest]).fitMultiple(rows, grid)
    assert sorted(i for i, _ in points) == list(range(len(grid)))
    assert len(points.deepest) == 2 and not any(points.deepest.values())
    rows.unpersist()
