"""Queries over tables of any layout and size: what a task holds doesn't follow one key or one alert."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
from pyspark.sql import functions as F

from opinion_spark.functions import text as X
from opinion_spark.operators import ranking as K
from opinion_spark.operators import similarity as M
from opinion_spark.streaming import metrics as W


def test_numbers_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, "909955422195631423488 and 2.5, 3.5"), (2, "123456789012"), (3, None)], "id int, t string")
    got = df.orderBy("id").select(F.transform(X.numbers_in(F.col("t")), X.whole_number).alias("n")).collect()
    assert [r["n"] for r in got] == [["909955422195631400000", "2", "4"], ["123456789012"], None]


def test_a_table_streams_as_a_file_and_as_a_folder(spark, tmp_path):
    rows = spark.range(40).withColumn("text", F.lit("a"))
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "part"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "part").glob("*.parquet")).rename(tmp_path / "one" / "documents.parquet")
    for layout in ("many", "one"):
        stream = W.read_table(spark, str(tmp_path / layout), "documents")
        W.write_available(stream, str(tmp_path / layout / "out"), str(tmp_path / layout / "state")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / layout / "out"))
        assert sorted(r["id"] for r in got.collect()) == list(range(40))


def test_escalations_hold_buckets_of_alerts(spark, tmp_path):
    """Many alerts, few states; resolved, resolved too late, and never raised."""
    t0 = dt.datetime(2024, 1, 1)
    first = [(f"a{i}", "system_threshold", t0 + dt.timedelta(seconds=i), "raised") for i in range(300)]
    first += [(f"a{i}", "system_threshold", t0 + dt.timedelta(minutes=30 if i % 2 else 90), "resolved") for i in range(100)]
    first += [("stray", "system_threshold", t0, "resolved")]
    schema = "alert_id string, alert_type string, ts timestamp, kind string"
    spark.createDataFrame(first, schema).write.parquet(str(tmp_path / "in"))
    stream = W.read_stream(spark, str(tmp_path / "in"), schema)
    query = W.write_available(W.escalations(stream, buckets=3), str(tmp_path / "half"), str(tmp_path / "halfstate"))
    query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert max(states) <= 3
    W.write_all(lambda s: W.escalations(s, buckets=3), stream, *(str(tmp_path / n) for n in ("out", "state", "marks")))
    got = {r["alert_id"]: r["raised"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    start = spark.sql("SELECT unix_micros(timestamp'2024-01-01 00:00:00')").first()[0]
    assert got == {f"a{i}": start + i * 1_000_000 for i in range(300) if i >= 100 or i % 2 == 0}


def test_samples_do_not_shuffle_rows_by_their_stratum(spark):
    """One stratum holds nearly all rows; they meet the cuts by stratum and hash bucket."""
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 100 == 0, 1).otherwise(2).alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (K.sample_exact(rows, ["k"], F.floor(F.col("n") / 2), "id"),
                    K.mark_sample(rows, ["k"], F.floor(F.col("n") / 2), "id").where("sampled")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
            assert keys and all("__part" in k for k in keys)
            assert {r["k"]: r["n"] for r in out.groupBy("k").agg(F.count("*").alias("n")).collect()} == {1: 25, 2: 2475}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blocks_of_dense_vectors_meet_by_part(spark, monkeypatch):
    """Vectors without structure: every pair of blocks is compared, but tasks take parts of many blocks."""
    v = np.random.default_rng(3).normal(size=(500, 16))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 9)
    want = {(i, int(j)) for i in range(500) for j in np.lexsort((np.arange(500), -sims[i]))[:5]}
    data = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "product_id long, vector array<double>")
    numbers, plain = [], M._cogrouped
    monkeypatch.setattr(M, "_cogrouped", lambda x, y, pairs: numbers.append(pairs) or plain(x, y, pairs))
    got = [(r["product_id"], r["other"]) for r in M.dense_neighbours(
        data, "product_id", "vector", 5, keep_self=True, per_block=15, per_pivot=30).collect()]
    assert len(got) == 2500 and set(got) == want
    assert numbers and max(numbers) <= 36
