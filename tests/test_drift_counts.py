"""The features of a text in fewer passes: the same counts as one expression each."""

import sys

from pyspark.sql import functions as F

from opinion_spark.functions import text as X
from opinion_spark.operators import drift as T


def test_counts_equal_those_of_single_expressions(spark):
    blanks = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    assert sorted(blanks) == sorted(X.BLANK_CHARS)
    texts = [None, "", " ", "a", "Great!? ÄÉ. \U0001d400 GREATLY bad BADİ stale​fresh", "".join(f"w{c}" for c in blanks), *blanks]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    low, t = F.lower("t"), F.col("t")
    lists = {"p": ["great", "fresh"], "n": ["bad", "stale", "awful"]}
    out = df.select("i", X.word_count(t).alias("word_count"), *[X.phrase_hits(low, v).alias(k) for k, v in lists.items()],
                    X.sentence_dots(t).alias("dots"), X.matches(t, "!").alias("marks"), X.matches(t, r"\p{Lu}").alias("capitals"))
    got = df.select("i", X.words_and_hits(low, lists).alias("h"), X.marks(t).alias("m")).select(
        "i", "h.*", X.of_marks(F.col("m"), ".") + 1, X.of_marks(F.col("m"), "!"), X.capitals_of_marks(F.col("m")))
    assert sorted(got.collect(), key=lambda r: r[0]) == sorted(map(tuple, out.collect()), key=lambda r: r[0])


def test_texts_are_read_once(spark):
    reads = spark.sparkContext.accumulator(0)
    @F.udf("string")
    def seen(text):
        reads.add(1)
        return text
    df = spark.range(20).select(
        F.col("id").alias("review_id"), F.when(F.col("id") % 2 == 0, "baseline").otherwise("comparison").alias("side"),
        F.lit("2020-01-01").cast("timestamp").alias("date"), seen(F.lit("Good. Bad!")).alias("review_text"),
        F.lit(1).alias("helpful_votes"), F.lit(2).alias("total_votes")).withColumn("rating", F.length("review_text") % 5)
    assert T.drift_features(df).collect()[0]["sentence_count"] == 2
    assert reads.value <= 20
