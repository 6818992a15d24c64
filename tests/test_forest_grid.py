"""The grid over the forest fits each distinct model once."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from opinion_spark.operators import fakes as M


def test_grid_shares_forests_no_limit_cuts(spark, monkeypatch):
    rows = spark.range(120).select(
        F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(89)).cast("double").alias("b"),
        F.when(F.col("id") % 11 == 0, 1 - F.col("id") % 2).otherwise(F.col("id") % 2).cast("double").alias("label")).coalesce(1).cache()
    forest = RandomForestClassifier(featuresCol="raw", labelCol="label", seed=3, numTrees=4)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [2, 25, 30]).addGrid(forest.minInstancesPerNode, [1, 4]).build()
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="raw"), forest]
    alone = [M.Pipeline(stages=stages).fit(rows, point).stages[-1].toDebugString.split("\n", 1)[1] for point in grid]
    fits = []
    fit = RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    models = dict(M.ForestPipeline(stages=stages).fitMultiple(rows, grid))
    assert [models[i].stages[-1].toDebugString.split("\n", 1)[1] for i in range(len(grid))] == alone
    assert len(fits) == 4  # the depths 25 and 30 cut no tree, the depth 2 does
    rows.unpersist()
