"""Fake-review features, training, scoring and saved models."""

from __future__ import annotations

import threading
from collections import Counter
from concurrent.futures import Future

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X
from opinion_spark.operators.cleaning import rating_deviation
from opinion_spark.operators.dedup import split_stratified, uniform_sample
from opinion_spark.session import materialize

TEXT_FEATURES = [
    "text_length", "text_word_count", "text_sentence_count", "text_avg_word_length",
    "text_caps_ratio", "text_punct_ratio", "text_exclamation_ratio",
    "text_generic_food_phrase_count", "text_spam_indicator_count", "text_excessive_punct_count",
    "text_competitor_keyword_count", "text_food_spam_count",
    "text_sentiment_compound", "text_sentiment_extreme",
]
# feature -> value where a user is unknown
USER_FEATURES = {
    "user_review_count": 0.0, "user_avg_rating": 3.0, "user_rating_variance": 1.0,
    "user_days_active": 30.0, "user_reviews_per_day": 0.1,
}
REVIEW_FEATURES = [
    "review_rating", "review_helpful_votes", "review_total_votes",
    "review_helpfulness_ratio", "review_rating_deviation",
]
FEATURES = TEXT_FEATURES + list(USER_FEATURES) + REVIEW_FEATURES


def text_features(df: DataFrame) -> DataFrame:
    """Add the 14 text features; a null or empty text gives zeros."""
    t = F.coalesce(F.col("review_text"), F.lit(""))
    low = F.col("__low")
    df = df.withColumn("__low", F.lower(t)).withColumns({
        "text_length": F.length(low), "text_word_count": X.token_count(low),
        "text_sentence_count": X.sentence_pieces(low), "text_avg_word_length": X.avg_token_length(low),
        "text_caps_ratio": X.caps_ratio(t), "text_punct_ratio": X.mark_ratio(low),
        "text_exclamation_ratio": X.exclamation_ratio(low),
        "text_generic_food_phrase_count": X.phrase_hits(low, L.GENERIC_PHRASES),
        "text_spam_indicator_count": X.phrase_hits(low, L.SPAM_PHRASES),
        "text_excessive_punct_count": X.phrase_hits(low, L.PUNCTUATION_RUNS),
        "text_competitor_keyword_count": X.phrase_hits(low, L.COMPETITOR_PHRASES),
        "text_food_spam_count": X.phrase_hits(low, L.FOOD_SPAM_PHRASES),
        "text_sentiment_compound": X.polarity(low),
    })
    return df.withColumn(
        "text_sentiment_extreme", (F.abs("text_sentiment_compound") > 0.8).cast("int")).drop("__low")


def user_behaviour(reviews: DataFrame, date: str = "date") -> DataFrame:
    """Per user: count, mean and variance of ratings, active days, reviews per day."""
    n = F.count(F.lit(1)).cast("double")
    days = (F.datediff(F.max(date), F.min(date)) + 1).cast("double")
    return reviews.groupBy("user_id").agg(
        n.alias("user_review_count"), F.avg("rating").alias("user_avg_rating"),
        F.var_samp("rating").alias("user_rating_variance"), days.alias("user_days_active"),
        (n / days).alias("user_reviews_per_day"))


def user_features(df: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Add the 5 user features, with defaults where the user is unknown."""
    out = df.join(behaviour, "user_id", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in USER_FEATURES.items()})


def review_features(df: DataFrame) -> DataFrame:
    """Add the 5 features of rating and votes."""
    df = df if "rating_deviation" in df.columns else rating_deviation(df)
    h, t = F.col("helpful_votes"), F.col("total_votes")
    return df.withColumns({
        "review_rating": F.coalesce(F.col("rating").cast("double"), F.lit(3.0)),
        "review_helpful_votes": F.coalesce(h, F.lit(0)), "review_total_votes": F.coalesce(t, F.lit(0)),
        "review_helpfulness_ratio": F.coalesce(B.helpful_floor_one(h, t), F.lit(0.0)),
        "review_rating_deviation": F.coalesce(F.col("rating_deviation"), F.lit(0.0))})


def all_features(reviews: DataFrame, keep: tuple[str, ...] = ("review_id",), date: str = "date") -> DataFrame:
    """The 24 features of every review, as doubles in model order.

    The joins run on the narrow columns; texts are turned into numbers first,
    so no text travels through a shuffle.
    """
    narrow = text_features(reviews).drop("review_text")
    full = review_features(user_features(narrow, user_behaviour(reviews, date)))
    return full.select(*keep, *[F.col(c).cast("double").alias(c) for c in FEATURES])


def ordered_features(df: DataFrame, keep: tuple[str, ...] = ("review_id",)) -> DataFrame:
    """Any frame brought to the model's columns: absent or null becomes 0."""
    cols = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c)
        for c in FEATURES]
    return df.select(*keep, *cols)


def training_set(real: DataFrame, fake: DataFrame, limit: int | None = None) -> DataFrame:
    """All real reviews (label 0) and all labelled fakes (label 1); ``train`` evens their numbers out by weights.

    On request a sample of at most ``limit`` rows, half of each kind.
    """
    if limit is not None:
        real, fake = (uniform_sample(df, limit // 2, seed=seed) for df, seed in ((real, "real"), (fake, "fake")))
    return ordered_features(real).withColumn("label", F.lit(0.0)).unionByName(
        ordered_features(fake).withColumn("label", F.lit(1.0)))


def class_weights(df: DataFrame) -> DataFrame:
    """Add ``weight`` = N / (classes * rows of the class)."""
    sizes = df.groupBy("label").agg(F.count(F.lit(1)).alias("__n"))
    stats = sizes.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k")).alias("s"))
    weights = sizes.withColumn("s", stats.scalar()).select(
        "label", (F.col("s.n") / (F.col("s.k") * F.col("__n"))).alias("weight"))
    return df.join(F.broadcast(weights), "label")  # one row per class


def default_grid(forest: RandomForestClassifier):
    """Trees x depth x leaf size; depth 30 is the deepest Spark allows."""
    return (
        ParamGridBuilder().addGrid(forest.numTrees, [100, 200]).addGrid(forest.maxDepth, [10, 20, 30])
        .addGrid(forest.minInstancesPerNode, [1, 2]).build())


class ForestPipeline(Pipeline):
    """A pipeline that ends in a forest; of a grid over the forest it fits each distinct model once.

    The stages before the forest are fitted once per data set. Of grid points that differ only in their
    depth limit the deepest is fitted first: a limit that no tree of it passes would give the same forest
    again, as trees grow level by level from one seed, so that forest stands for it. Other points are fitted.
    """

    def fitMultiple(self, dataset, paramMaps):
        *first, forest = self.getStages()
        if any(p.parent != forest.uid for m in paramMaps for p in m):
            return super().fitMultiple(dataset, paramMaps)
        return _GridModels(Pipeline(stages=first).fit(dataset), forest, dataset, paramMaps)


class _GridModels:
    """(index, model) of each grid point, the deepest first; threads may call it together."""

    def __init__(self, prepared: PipelineModel, forest: RandomForestClassifier, dataset: DataFrame, grid):
        self.prepared, self.forest, self.grid = prepared, forest, grid
        self.rows = prepared.transform(dataset)
        self.order = iter(sorted(range(len(grid)), key=lambda i: -self._depth(i)))
        self.lock = threading.Lock()
        self.deepest: dict[frozenset, Future] = {}  # of each kind (depth of its trees, its forest if a point ahead can share it)
        self.ahead = Counter(self._kind(i) for i in range(len(grid)))

    def _depth(self, index: int) -> int:
        return self.grid[index].get(self.forest.maxDepth, self.forest.getMaxDepth())

    def _kind(self, index: int) -> frozenset:
        return frozenset((p.name, v) for p, v in self.grid[index].items() if p.name != "maxDepth")

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            index = next(self.order)
            kind = self._kind(index)
            leads = kind not in self.deepest
            whole = self.deepest.setdefault(kind, Future())
        model = None
        if leads:
            try:
                model = self._fit(index)
                depth = max(tree.depth for tree in model.trees)
                shared = any(self._kind(i) == kind and self._depth(i) >= depth for i in range(len(self.grid)) if i != index)
                whole.set_result((depth, model if shared else None))
            except BaseException as failed:  # those that wait for it must end too
                whole.set_exception(failed)
                raise
        else:
            depth, model = whole.result()
            if depth > self._depth(index):
                model = self._fit(index)
        with self.lock:
            self.ahead[kind] -= 1
            if not self.ahead[kind]:
                self.deepest[kind] = None  # a forest goes with its last point
        return index, PipelineModel([*self.prepared.stages, model])

    def _fit(self, index: int):
        return self.forest.fit(self.rows, self.grid[index])


def _split(features: DataFrame, test_share: float) -> DataFrame:
    return split_stratified(features, test_share, "label")


def held_out(features: DataFrame, test_share: float = 0.2) -> DataFrame:
    """The rows of a training set that ``train`` does not fit on."""
    return _split(features, test_share).where("is_test").drop("is_test")


def train(
    features: DataFrame, folds: int = 5, parallelism: int = 2, seed: int = 42, grid=None, test_share: float = 0.2
) -> tuple[PipelineModel, CrossValidatorModel, DataFrame]:
    """Cross-validated random forest on a stratified split.

    Returns the best model, the cross-validation and one row of metrics. The
    weighted training rows, stored so that no plan of a fit repeats theirs, and the node of each row in each tree are the only cached data.
    ``parallelism`` models are fitted at a time: each fit is spread over all cores itself, and every further one takes memory
    of the driver.
    """
    split = _split(features, test_share)
    fit_rows = materialize(class_weights(split.where(~F.col("is_test")))).cache()
    forest = RandomForestClassifier(
        featuresCol="scaled", labelCol="label", weightCol="weight", seed=seed, numTrees=100, cacheNodeIds=True)
    pipeline = ForestPipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True), forest])
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    try:
        search = CrossValidator(
            estimator=pipeline, estimatorParamMaps=default_grid(forest) if grid is None else grid(forest),
            evaluator=auc, numFolds=folds, parallelism=parallelism, seed=seed).fit(fit_rows)
    finally:
        fit_rows.unpersist()
    model = search.bestModel
    best = max(range(len(search.avgMetrics)), key=lambda i: search.avgMetrics[i])
    scored = model.transform(split).select(
        "label", "is_test", "prediction", vector_to_array("probability")[1].alias("p"))
    hit = (F.col("label") == F.col("prediction")).cast("int")
    report = scored.agg(
        F.avg(F.when(~F.col("is_test"), hit)).alias("train_accuracy"),
        F.avg(F.when(F.col("is_test"), hit)).alias("test_accuracy"),
        F.count(F.lit(1)).alias("samples"),
    ).withColumns({
        "test_auc": F.lit(float(auc.evaluate(model.transform(split.where("is_test"))))),
        "cv_mean": F.lit(float(search.avgMetrics[best])), "cv_std": F.lit(float(search.stdMetrics[best]))})
    return model, search, report


def predict(model: PipelineModel, features: DataFrame, keep: tuple[str, ...] = ("review_id",)) -> DataFrame:
    """p(fake), confidence and risk level of every row; 0.5 where no score exists."""
    scored = model.transform(ordered_features(features, keep))
    p = F.coalesce(vector_to_array("probability")[1], F.lit(0.5))
    return scored.select(*keep, p.alias("fake_probability")).withColumns({
        "confidence": B.risk_confidence(F.col("fake_probability")),
        "risk_level": B.risk_level(F.col("fake_probability"))})


def importances(model: PipelineModel, spark: SparkSession, n: int = 10) -> DataFrame:
    """The ``n`` features that matter most."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(FEATURES, values))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(n)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
