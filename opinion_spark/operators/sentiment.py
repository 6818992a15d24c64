"""Sentiment and aspect scoring of review texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X

Scorer = Callable[[pd.Series], pd.DataFrame]


def lexicon_counts(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Add ``pos`` and ``neg``, computed once per row and used by every score."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    return df.withColumns({
        "__low": low,
        "pos": X.phrase_hits(low, L.SENTIMENT_POSITIVE), "neg": X.phrase_hits(low, L.SENTIMENT_NEGATIVE)})


def lexicon_label(pos: Column, neg: Column) -> Column:
    return F.when(pos > neg, "POSITIVE").when(neg > pos, "NEGATIVE").otherwise("NEUTRAL")


def lexicon_confidence(pos: Column, neg: Column) -> Column:
    return F.when(pos == neg, F.lit(0.5)).otherwise(
        F.least(F.lit(0.7) + F.greatest(pos, neg) * F.lit(0.1), F.lit(0.9)))


def aspect_map(low: Column, pos: Column, neg: Column, keywords: dict[str, list[str]] = L.ASPECT_KEYWORDS) -> Column:
    """Map of the mentioned aspects. Score and confidence come from the whole
    text, so all aspects of a review share them."""
    score = (
        F.when(pos > neg, F.lit(4.0) + F.least(pos * F.lit(0.2), F.lit(1.0)))
        .when(neg > pos, F.lit(2.0) - F.least(neg * F.lit(0.2), F.lit(1.0)))
        .otherwise(F.lit(3.0)))
    value = F.struct(
        F.least(F.greatest(score, F.lit(1.0)), F.lit(5.0)).alias("sentiment"),
        lexicon_confidence(pos, neg).alias("confidence"))
    entries = [
        F.when(X.phrase_hits(low, words) > 0, F.struct(F.lit(aspect).alias("key"), value.alias("value")))
        for aspect, words in keywords.items()]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def analyze(df: DataFrame, keep: tuple[str, ...] = ("review_id",)) -> DataFrame:
    """Label, confidence, 1-5 score and aspects of every review, no Python."""
    pos, neg = F.col("pos"), F.col("neg")
    scored = lexicon_counts(df).select(
        *keep, lexicon_label(pos, neg).alias("overall_sentiment"),
        lexicon_confidence(pos, neg).alias("confidence"), aspect_map(F.col("__low"), pos, neg).alias("aspects"))
    return scored.withColumn(
        "sentiment_score", B.sentiment_to_rating(F.col("overall_sentiment"), F.col("confidence")))


def scored_batch(scorer: Scorer, texts: pd.Series) -> pd.DataFrame:
    """(label, score, failed) of a batch; a batch that fails is halved until the bad texts stand alone.

    With few bad texts among n this takes about 2 log2(n) calls for each of them.
    """
    out = pd.DataFrame({"label": "UNKNOWN", "score": 0.5, "failed": True}, index=range(len(texts)))
    todo = [(0, len(texts))]
    while todo:
        lo, hi = todo.pop()
        if lo == hi:
            continue
        try:
            got = scorer(texts.iloc[lo:hi])
            if len(got) != hi - lo:
                raise ValueError(f"the scorer gave {len(got)} rows for {hi - lo} texts")
            label, score = got["label"].to_numpy(), got["score"].to_numpy(float)
        except Exception:  # noqa: BLE001 - any text can break a model; it is marked, not lost
            if hi - lo > 1:
                todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
            continue
        out.iloc[lo:hi, 0], out.iloc[lo:hi, 1], out.iloc[lo:hi, 2] = label, score, False
    return out


def score_with_model(df: DataFrame, load: Callable[[], Scorer], keep: str = "review_id long") -> DataFrame:
    """Score with any model. ``load`` runs once per task and returns a function
    from texts to a frame (label, score); an error in it ends the job. A text that the model can't
    score gets (NEUTRAL, 0.5) and ``failed``; the others of its batch have their own scores."""
    name = keep.split()[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for batch in batches:
            got = scored_batch(scorer, batch["review_text"])
            yield pd.DataFrame({name: batch[name].to_numpy(), "label": got["label"].astype(object).to_numpy(),
                                "confidence": got["score"].to_numpy(float), "failed": got["failed"].to_numpy(bool)})

    raw = df.select(name, "review_text").mapInPandas(run, f"{keep}, label string, confidence double, failed boolean")
    label = B.normalize_model_label(F.col("label"))
    return raw.select(
        name, label.alias("overall_sentiment"), "confidence",
        B.sentiment_to_rating(label, F.col("confidence")).alias("sentiment_score"), "failed")


def aspects_json(df: DataFrame) -> DataFrame:
    """Storage form: the aspect map as JSON text."""
    return df.withColumn("aspects_json", F.to_json("aspects")).drop("aspects")


def parse_aspects(df: DataFrame) -> DataFrame:
    """Back from JSON text; a malformed text gives null, hence no aspect rows."""
    schema = "map<string,struct<sentiment:double,confidence:double>>"
    return df.withColumn("aspects", F.from_json("aspects_json", schema))


def rating_correlation(df: DataFrame) -> DataFrame:
    """Correlation of the numeric sentiment with the rating."""
    return df.agg(F.corr(B.sentiment_value(F.col("overall_sentiment")), "rating").alias("correlation"))


def fused_analysis(sentiment: DataFrame, fake: DataFrame) -> DataFrame:
    """Sentiment and fake result of a review with its combined labels."""
    p = F.col("fake_probability")
    return sentiment.select("review_id", "review_length", "overall_sentiment", "sentiment_score").join(
        fake.select("review_id", "fake_probability", "risk_level"), "review_id").withColumns({
            "authenticity": B.authenticity(p), "detail": B.detail_level(F.col("review_length")),
            "value_label": B.review_value(F.col("sentiment_score"), p)})
