"""Sources, sinks, streams and whole jobs."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from opinion_spark import adapters
from opinion_spark import schemas
from opinion_spark.operators import alerts as A
from opinion_spark.operators import cleaning as C
from opinion_spark.operators import evaluate as E
from opinion_spark.operators import fakes as M
from opinion_spark.operators import sentiment as N
from opinion_spark.plans import jobs as J
from opinion_spark.sources import html as H
from opinion_spark.sources import tables as S
from opinion_spark.streaming import metrics as W

AS_OF = "2013-01-01"
CSV = '''reviewerID,asin,reviewerName,helpful,reviewText,overall,summary,unixReviewTime,reviewTime
A1,0001,Ann,"[2, 3]","Great taste, ""really"" fresh.
Two lines",5,Good,1346976000,"09 7, 2012"
A2,0002,Bob,,Stale and bland stuff,1,Bad,1346976001,"09 7, 2012"
'''


def tiny_grid(forest):
    return ParamGridBuilder().addGrid(forest.numTrees, [10]).addGrid(forest.maxDepth, [4]).build()


def test_csv_scan_standardises(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV)
    df, missing = S.load_reviews(spark, [
        (str(tmp_path / "absent.csv"), schemas.PRIMARY_REVIEWS_CSV), (str(path), schemas.SAMPLE_REVIEWS_CSV)], AS_OF)
    rows = df.orderBy("user_id").collect()
    assert missing == [] and len(rows) == 2
    assert rows[0]["product_id"] == "0001" and "Two lines" in rows[0]["review_text"]
    assert rows[0]["date"] == dt.datetime(2012, 9, 7)
    assert rows[0]["total_votes"] == 0
    with pytest.raises(FileNotFoundError):
        S.first_existing(spark, [str(tmp_path / "no")])
    assert S.read_csv(spark, str(path), schemas.SAMPLE_REVIEWS_CSV, first=1).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    path = str(tmp_path / "t")
    S.write_table(df, path)
    S.append_table(df.where("id = 2"), path)
    assert spark.read.parquet(path).count() == 3
    S.write_report(df, str(tmp_path / "r"))
    assert S.read_reports(spark, str(tmp_path / "r")).count() >= 1
    S.write_training_csv(df, str(tmp_path / "c"), ["v"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c" / "features")).columns == ["v"]
    J.replace_recommendations(
        spark.createDataFrame([("u", "old"), ("w", "kept")], "user_id string, product_id string"),
        spark.createDataFrame([("u", "new")], "user_id string, product_id string"), str(tmp_path / "recs"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "recs")).collect()} == {("u", "new"), ("w", "kept")}


def test_upsert_keeps_the_last_write(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, ver int")
    new = spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "id long, v string, ver int")
    got = {tuple(r)[:2] for r in S.upsert(old, new, ["id"], [F.desc("ver")]).collect()}
    assert got == {(1, "a"), (2, "c"), (3, "d")}
    assert [r["id"] for r in S.absent_rows(old, new, ["id"]).collect()] == [3]


def test_cleaning_is_idempotent(spark, small):
    from opinion_spark.catalog.cleaning import standard
    once = C.normalize_texts(standard(spark, small).where("review_text IS NOT NULL"))
    twice = C.normalize_texts(once)
    changed = once.select("review_id", F.col("review_text").alias("a")).join(
        twice.select("review_id", F.col("review_text").alias("b")), "review_id").where("trim(a) <> trim(b)")
    # a removed address can leave a doubled blank, which a second run squeezes
    assert changed.where("regexp_replace(trim(a), ' +', ' ') <> b").count() == 0


def test_html_fallbacks(spark):
    page = ('<div class="Review-card"><span class="a-profile-name">Ann &amp; Co</span>'
            '<span data-hook="review-body">Nice <b>tea</b> &lt;3 indeed.<br> Read more here</span>'
            '<span data-hook="avp-badge">Verified</span></div><div class="other">x</div>')
    short = '<div data-hook="review"><span data-hook="review-body">tiny</span></div>'
    df = spark.createDataFrame([(1, "p", page), (2, "q", short), (3, "r", None)], "page_id long, product_id string, html string")
    rows = H.extract_reviews(df, AS_OF).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["user_id"] == "Ann___Co" and r["rating"] == 3 and r["review_title"] == "No Title"
    assert r["review_text"].startswith("Nice") and "Read more" not in r["review_text"]
    assert r["verified_purchase"] and str(r["review_date"]) == AS_OF


def _review(user: str, body: str, end: str = "</div>") -> str:
    return (f'<div data-hook="review"><span class="a-profile-name">{user}</span><p><li>'
            f'<span data-hook="review-body">{body}</span>{end}')


def test_html_broken_markup_loses_no_review(spark):
    pages = [
        _review("a", "first long text") + _review("b", "second long text"),       # <p>, <li> never closed
        _review("a", "first long text", "") + _review("b", "second long text"),   # a container never closed
        '<div data-hook="review"><div>' + _review("a", "inner long text") + "</div></div>",  # one inside another
        _review("a", "cut long text", "")[:-7],                                   # the page ends inside the body
    ]
    df = spark.createDataFrame([(i, "p", x) for i, x in enumerate(pages)], "page_id long, product_id string, html string")
    found = sorted((r["page_id"], r["user_id"], r["review_text"]) for r in H.extract_reviews(df, AS_OF).collect())
    assert found == [
        (0, "a", "first long text"), (0, "b", "second long text"), (1, "a", "first long text"),
        (1, "b", "second long text"), (2, "a", "inner long text"), (2, "a", "inner long text"), (3, "a", "cut long text")]


def test_served_kinds(spark):
    from opinion_spark.operators import recommend as R
    wanted = spark.createDataFrame([(1,), (2,)], "user_id long")
    stored = spark.createDataFrame([(1, 7, 4.0, 0.8, 3.2)], "user_id long, product_id long, predicted_rating double, "
                                   "confidence double, recommendation_score double")
    best = spark.createDataFrame([(9, 6, 4.5)], "product_id long, review_count long, average_rating double")
    kinds = {tuple(r) for r in R.served(wanted, stored, best).collect()}
    assert kinds == {(1, 7, 4.0, 0.8, "stored"), (2, 9, 4.5, 0.5, "popular_fallback")}
    kinds = {tuple(r) for r in R.served(wanted, stored, best, fresh=stored).collect()}
    assert kinds == {(1, 7, 4.0, 0.8, "fresh_hybrid"), (2, None, None, None, "none_available")}


def test_model_failure_gives_neutral(spark):
    def load():
        def scorer(texts):
            raise RuntimeError("no model")
        return scorer
    df = spark.createDataFrame([(1, "x")], "review_id long, review_text string")
    assert tuple(N.score_with_model(df, load).first()) == (1, "NEUTRAL", 0.5, 3.0, True)


def test_one_bad_text_does_not_blank_its_batch(spark):
    def load():
        import pandas as pd

        def scorer(texts):
            if (texts == "poison").any():
                raise RuntimeError("bad text")
            return pd.DataFrame({"label": "POSITIVE", "score": texts.str.len() / 100})
        return scorer
    rows = [(i, "poison" if i == 617 else "x" * (1 + i % 50)) for i in range(1000)]
    df = spark.createDataFrame(rows, "review_id long, review_text string").coalesce(1)
    got = {r["review_id"]: r for r in N.score_with_model(df, load).collect()}
    assert [i for i, r in got.items() if r["failed"]] == [617] and got[617]["overall_sentiment"] == "NEUTRAL"
    assert all(r["confidence"] == (1 + i % 50) / 100 and r["overall_sentiment"] == "POSITIVE" for i, r in got.items() if i != 617)

    def broken():
        raise OSError("no such model")
    with pytest.raises(Exception, match="no such model"):
        N.score_with_model(df, broken).collect()


def test_etl(spark, small, tmp_path):
    from opinion_spark.catalog.cleaning import standard
    report = J.run_etl(standard(spark, small), str(tmp_path), AS_OF, target=100).first()
    reviews = spark.read.parquet(str(tmp_path / "reviews"))
    assert reviews.count() == report["final_records"] <= 100
    assert spark.read.parquet(str(tmp_path / "products")).agg(F.sum("total_reviews")).first()[0] == reviews.count()
    assert spark.read.parquet(str(tmp_path / "users")).count() == reviews.select("user_id").distinct().count()
    short = standard(spark, small).withColumn("review_text", F.concat(F.lit("only ten "), "review_id"))
    with pytest.raises(ValueError):
        J.run_etl(short, str(tmp_path / "bad"), AS_OF)


def test_training_orders_suspicious_above_authentic(spark, small, tmp_path):
    base = adapters.reviews_text(spark, small)
    fakes = base.withColumns({
        "review_text": F.lit("Buy now! Amazing amazing!!! Best food ever, click here. Highly recommend!!!"),
        "review_id": F.col("review_id") + 1_000_000, "rating": F.lit(5)})
    reviews = base.unionByName(fakes)
    labels = reviews.select("review_id", (F.col("review_id") >= 1_000_000).cast("int").alias("is_fake"))
    report = J.run_training(reviews, labels, str(tmp_path), limit=200, folds=2, grid=tiny_grid).first()
    assert report["status"] == "success" and report["fake_metrics"]["test_auc"] >= 0.9
    scores = spark.read.parquet(str(tmp_path / "fake_detection"))
    mean = dict(scores.groupBy((F.col("review_id") >= 1_000_000).alias("f")).agg(F.avg("fake_probability")).collect())
    assert mean[True] > mean[False]
    model = M.load_model(str(tmp_path / "fake_model"))
    top = M.importances(model, spark).collect()
    assert len(top) == 10 and top[0]["importance"] >= top[-1]["importance"]


def test_training_blends_all_five_methods(spark, small, tmp_path):
    base = adapters.reviews_text(spark, small)
    labels = base.select("review_id", (F.col("review_id") % 2).cast("int").alias("is_fake"))
    J.run_training(base, labels, str(tmp_path), limit=60, folds=2, grid=tiny_grid).first()
    recs = spark.read.parquet(str(tmp_path / "user_recommendations"))
    named = {m for r in recs.select("reason").distinct().collect() for m in r[0].removeprefix("Recommended by ").split(", ")}
    assert named == {"user_based", "item_based", "content_based", "matrix_factorization", "popular"}
    assert recs.where(F.size("similar_products") > 0).count() == recs.count()


# ---- streams ---------------------------------------------------------------
def metric_files(spark, small, tmp_path, parts=6, shuffle_minutes=0):
    """The metric rows as several files in time order, each a batch of the stream."""
    rows = adapters.metric_stream(spark, small)
    jitter = F.pmod(F.xxhash64("event_id"), F.lit(max(1, shuffle_minutes * 60)))
    spot = F.ntile(parts).over(__import__("pyspark").sql.Window.orderBy(F.unix_timestamp("ts") + jitter))
    marked = rows.withColumn("spot", spot).cache()
    for i in range(1, parts + 1):
        target = str(tmp_path / "in")
        marked.where(F.col("spot") == i).drop("spot").coalesce(1).write.mode("append").parquet(target)
        for name in os.listdir(target):
            if name.endswith(".parquet"):
                stamp = os.stat(f"{target}/{name}")
                if stamp.st_mtime > 1_000_000_000 and not getattr(metric_files, name, False):
                    setattr(metric_files, name, True)
                    os.utime(f"{target}/{name}", (900_000_000 + i, 900_000_000 + i))
    return rows, W.read_stream(spark, str(tmp_path / "in"), schemas.METRICS, files=1)


def run(stream, tmp_path, name):
    q = W.write_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-state"))
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name)), q


def test_stream_cooldown_equals_batch(spark, small, tmp_path):
    rows, stream = metric_files(spark, small, tmp_path, shuffle_minutes=9)
    W.write_all(W.cooled_alerts, A.raised_alerts(stream), *(str(tmp_path / n) for n in ("cool", "state", "marks")))
    mine = [r["event_id"] for r in spark.read.parquet(str(tmp_path / "cool")).collect()]
    want = [r["event_id"] for r in A.after_cooldown(A.raised_alerts(rows)).collect()]
    assert want and sorted(mine) == sorted(want)


def test_stream_windows_equal_batch(spark, small, tmp_path):
    rows, stream = metric_files(spark, small, tmp_path)
    W.write_all(W.windowed_metrics, stream, *(str(tmp_path / n) for n in ("win", "state", "marks")))
    got = spark.read.parquet(str(tmp_path / "win"))
    want = {(r["window_start"], r["metric_name"]): r["n"] for r in A.recent_metrics(rows).collect()}
    mine = {(r["window_start"], r["metric_name"]): r["n"] for r in got.collect()}
    assert mine == want and got.count() == len(want)


def test_stream_escalation(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    def row(name, kind, minute, alert_type="system_threshold"):
        return (name, alert_type, t0 + dt.timedelta(minutes=minute), kind)
    files = [[row("open", "raised", 0), row("closed", "raised", 0), row("late", "raised", 0)],
             [row("closed", "resolved", 30)], [row("late", "resolved", 61)], [row("clock", "raised", 500)]]
    schema = "alert_id string, alert_type string, ts timestamp, kind string"
    for i, part in enumerate(files):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = W.read_stream(spark, str(tmp_path / "in"), schema, files=10)
    got, _ = run(W.escalations(stream), tmp_path, "esc")
    assert {r["alert_id"] for r in got.collect()} == {"open", "late"}


def test_live_scoring_is_incremental(spark, small, tmp_path):
    reviews = adapters.reviews_text(spark, small).select("review_id", "review_text")
    schema = "review_id long, review_text string"
    first, both = reviews.where("review_id < 120"), reviews.where("review_id >= 60")
    for part in (first, both):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = W.read_stream(spark, str(tmp_path / "in"), schema)
        W.score_live_reviews(stream, N.analyze, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == reviews.count() == out.select("review_id").distinct().count()
    again = out.where("review_id >= 120 and review_id < 130").select("review_id")
    reviews.join(again, "review_id").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for file in sorted((tmp_path / "out" / "epoch=0").rglob("*.parquet")):
        file.write_bytes(b"")  # earlier output isn't read
    W.score_live_reviews(stream, N.analyze, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sum(spark.read.parquet(str(p)).count() for p in sorted((tmp_path / "out").glob("epoch=*"))[2:]) == 0


def test_checkpoint_folder_of_the_session_wins(tmp_path):
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from opinion_spark.session import local_session, materialize\n"
        "from opinion_spark.functions.text import clean_text\n"
        "from opinion_spark.operators.recommend import item_neighbours\n"
        "s = local_session(2, 2, **{'spark.checkpoint.dir': sys.argv[2]})\n"
        "d = s.createDataFrame([('a&amp;b it is',)], 't string')\n"
        "print(materialize(d.select(clean_text(d.t).alias('x'))).first().x)\n"
        "v = s.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], 'product_id long, vector array<double>')\n"
        "print(item_neighbours(v).count())\n")
    done = subprocess.run(
        [sys.executable, "-c", code, str(__import__("pathlib").Path(__file__).resolve().parents[1]), str(tmp_path / "ck")],
        cwd="/", capture_output=True, text=True, timeout=300)
    assert "ab it is" in done.stdout and done.stdout.strip().endswith("4"), done.stderr[-2000:]
    assert any((tmp_path / "ck").rglob("*.parquet"))


def test_validation_run_tells_insights_of_all_models(spark):
    scored = spark.createDataFrame(
        [(5, "POSITIVE", 0.9), (1, "NEGATIVE", 0.7), (3, "POSITIVE", 0.5), (4, "POSITIVE", 0.9)],
        "rating int, overall_sentiment string, confidence double")
    fakes = spark.createDataFrame([(1.0, 0.9), (1.0, 0.4), (0.0, 0.2), (0.0, 0.6)], "is_fake double, fake_probability double")
    wanted = spark.createDataFrame([(1,), (2,)], "user_id int")
    recs = spark.createDataFrame([(1, 7, 4.0, 0.5), (1, 8, 3.0, 0.7)],
                                 "user_id int, product_id int, predicted_rating double, confidence double")
    row = J.run_validation(scored, fakes, wanted, recs).first()
    told = {m["model_name"]: m["key_insights"] for m in row["model_results"]}
    assert told == {
        "sentiment_analyzer": "Average confidence: 0.750; Rating correlation: 0.878",
        "fake_detector": "AUC Score: 0.750; Detection accuracy: 0.500",
        "recommendation_engine": "Success rate: 0.500; Recommendation diversity: 1.000"}
    assert row["models"] == 3 and "fake_detector: Consider retraining" in row["recommendations"]


def test_held_out_rows_are_those_the_model_was_not_fitted_on(spark):
    rows = [(i, float(i % 2)) for i in range(200)]
    data = spark.createDataFrame(rows, "review_id long, label double")
    out = M.held_out(data)
    assert out.count() == 40 and out.columns == data.columns
    fitted = M._split(data, 0.2).where("NOT is_test")
    assert out.join(fitted, "review_id").count() == 0 and fitted.count() == 160


def test_validation_sets_sample_on_request(spark):
    reviews = spark.createDataFrame([(i, i % 5 + 1) for i in range(100)], "review_id long, rating int")
    fakes = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)], "review_id long, is_fake int")
    out = Counter((r["dataset"], r["label"], r["is_test"]) for r in E.validation_sets(
        reviews, fakes, real=50, fake=20).collect() if r["dataset"] != "rating_prediction")
    assert out == {("sentiment", "POSITIVE", True): 8, ("sentiment", "POSITIVE", False): 32,
                   ("sentiment", "NEGATIVE", True): 8, ("sentiment", "NEGATIVE", False): 32,
                   ("sentiment", "NEUTRAL", True): 4, ("sentiment", "NEUTRAL", False): 16,
                   ("fake_detection", "0", True): 15, ("fake_detection", "0", False): 35,
                   ("fake_detection", "1", True): 6, ("fake_detection", "1", False): 14}
