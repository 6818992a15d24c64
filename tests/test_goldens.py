"""Known answers for cleaning, parsing and validation rules."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.functions import text as X
from opinion_spark.operators import alerts as A
from opinion_spark.operators import cleaning as C
from opinion_spark.operators import drift as T
from opinion_spark.operators import quality as Q


def one(spark, column, **values):
    row = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], row).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, clean", [
    ("Tom &amp; Jerry", "Tom Jerry"),
    ("café  ①", "cafe 1"),
    ("see http://a.b/c?d=1 now", "see  now"),
    ("mail me@x.org please!!!", "mail  please!"),
    ("what???? well.....", "what? well..."),
    ("don't can't Can't I'm we'll they've", "do not cannot Ca not I am we will they have"),
    (None, ""),
])
def test_clean_text(spark, raw, clean):
    assert one(spark, X.clean_text(F.col("t")), t=raw).replace("  ", " ") == clean.replace("  ", " ")


@pytest.mark.parametrize("text, rating", [
    ("4.0 out of 5 stars", 4), ("0.5", 2), ("0.1", 1), ("8/10", 4), ("90%", 4), ("1000", None), ("none", None)])
def test_normalize_rating(spark, text, rating):
    assert one(spark, X.normalize_rating(F.col("t")), t=text) == rating


def test_scraped_parsing(spark):
    text = "Reviewed in the United States on January 15, 2025"
    assert str(one(spark, X.scraped_date(F.col("t")), t=text)) == "2025-01-15"
    assert one(spark, X.scraped_date(F.col("t")), t="no date here") is None
    assert one(spark, X.helpful_votes(F.col("t")), t="12 people found this helpful") == 12
    assert one(spark, X.helpful_votes(F.col("t")), t="One person found this helpful") == 1
    assert one(spark, X.clean_title(F.col("t")), t="5.0 out of 5 stars Nice") == "Nice"
    assert one(spark, X.safe_user_id(F.col("t")), t="Ann B. é-1") == "Ann_B__é-1"


def test_good_sentence_has_full_quality(spark):
    issues = X.quality_issues(F.col("t"))
    text = "This is a good product with excellent quality!"
    assert one(spark, issues, t=text) == []
    assert one(spark, X.quality_score(issues), t=text) == 100
    assert one(spark, X.word_count(F.col("t")), t=text) == 8


@pytest.mark.parametrize("text, score", [
    ("short", 70), ("AAAAAAA AAAAAAA AAAAAAA AAAA", 65), ("12345 67890 12345", 50), ("", 20)])
def test_quality_penalties(spark, text, score):
    assert one(spark, X.quality_score(X.quality_issues(F.col("t"))), t=text) == score


def test_whitespace_is_unicode(spark):
    assert one(spark, X.word_count(F.col("t")), t="a b c\x1cd e") == 5
    assert one(spark, X.strip(F.col("t")), t="  x 　") == "x"


def test_repeated_words(spark):
    assert one(spark, X.repeated_words(F.col("t")), t="a b A c b b d") == 2
    assert one(spark, X.repeated_words(F.col("t")), t="") == 0


def test_review_report_of_five_rows(spark):
    rows = [("PROD001", 5, "Great product!", "USER001", "2023-01-01"),
            ("PROD002", 4, "Good quality", "USER002", "2023-01-02"),
            ("PROD003", 3, "", "USER003", "2023-01-03"),
            ("", 2, "Poor quality", "USER004", "2023-01-04"),
            ("PROD005", 1, "Terrible", "USER005", "2023-01-05")]
    df = spark.createDataFrame(
        rows, "product_id string, rating int, review_text string, user_id string, review_date string")
    r = Q.review_report(df).first()
    assert (r["total_rows"], r["valid_rows"], r["errors"], r["warnings"]) == (5, 3, 0, 2)
    assert r["duplicate_rows"] == 0


def test_dataset_checks_fail(spark):
    df = spark.createDataFrame([("p", "u", 9, "bad")], "product_id string, user_id string, rating int, review_text string")
    got = {r["check_name"]: r["passed"] for r in Q.dataset_checks(df).collect()}
    assert got == {"required_columns": True, "data_types": False, "non_empty": True, "text_quality": False,
                   "rating_distribution": False}


def test_missing_columns_are_reported(spark):
    df = spark.createDataFrame([(1,)], "rating int")
    with pytest.raises(ValueError):
        C.final_types(df)
    assert not Q.dataset_checks(df).where("check_name = 'required_columns'").first()["passed"]


def test_rating_coercion_rounds_half_to_even(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",), ("0.9",), ("5.4",), ("x",), (None,)], "rating string")
    assert [r["rating"] for r in C.coerce_rating(df).collect()] == [2, 4]


def test_one_decimal_rounds_like_exact_binary(spark):
    values = [89.55, 95.55, 90.35, 0.25, 0.35, 20.65, 57.05, 99.95, 0.05, 1.0, 12.349999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["x"] for r in df.select(A.one_decimal(F.col("v")).alias("x")).collect()]
    assert got == [f"{v:.1f}" for v in values]


@pytest.mark.parametrize("x, dof, p", [
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
    (9.487729036781154, 4, 0.05), (11.070497693516351, 5, 0.05), (6.634896601021214, 1, 0.01)])
def test_chi_square_tail(spark, x, dof, p):
    df = spark.createDataFrame([(x, float(dof))], "x double, d double")
    assert math.isclose(df.select(T.chi2_p_value("x", "d").alias("p")).first()["p"], p, rel_tol=1e-9)


def test_ks_p_value(spark):
    df = spark.createDataFrame([(1.3580986393225505, 1.0)], "x double, one double")
    # D with sqrt(n1 n2 / (n1 + n2)) = 1: the 5% point of Kolmogorov's distribution
    p = df.select(T.ks_p_value(F.col("x"), F.col("one") * 2, F.col("one") * 2).alias("p")).first()["p"]
    assert math.isclose(p, 0.05, rel_tol=1e-6)


def test_sentiment_to_rating_is_clamped(spark):
    df = spark.createDataFrame([("POSITIVE", 1.0), ("NEGATIVE", 1.0), ("NEUTRAL", 0.9)], "l string, c double")
    got = [r["x"] for r in df.select(B.sentiment_to_rating(F.col("l"), F.col("c")).alias("x")).collect()]
    assert got == [5.0, 1.0, 3.0]


def test_component_health(spark):
    from opinion_spark.operators.alerts import checked_health
    rows = [("cpu_usage", 84.9, None, "healthy"), ("cpu_usage", 96.0, None, "critical"), ("memory_usage", 85.0, False, "warning"),
            ("disk_usage", 98.0, False, "warning"), ("disk_usage", 98.1, False, "critical"), ("response_time", 0.99, False, "healthy"),
            ("response_time", 1.0, False, "warning"), ("response_time", 0.1, True, "critical"), ("confidence", 0.5, False, "warning"),
            ("confidence", 0.51, False, "healthy"), ("users", 0.0, False, "warning"), ("users", 3.0, None, "healthy"), ("other", 1.0, None, None)]
    df = spark.createDataFrame(rows, "kind string, value double, failed boolean, want string")
    got = checked_health(df).collect()
    assert [r["status"] for r in got] == [r["want"] for r in got]
    assert {r["error_message"] for r in got} == {None, "High cpu usage: 96.0%", "High memory usage: 85.0%", "High disk usage: 98.0%",
                                                 "High disk usage: 98.1%"}
