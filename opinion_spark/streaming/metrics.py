"""Metric and alert streams: windows, cooldown, escalation, live scoring.

The batch operators hold the rules; these functions add event time, watermark
and state. A row later than the watermark is dropped and counted by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from opinion_spark.operators import alerts as A
from opinion_spark.operators.joins import with_rule
from opinion_spark.sources import tables as S

DELAY = "10 minutes"
END = "2250-01-01 00:00:00"  # of the final marker: its watermark closes all windows and waits


def read_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream, an explicit schema, bounded files per trigger."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files).parquet(folder))


def read_table(spark: SparkSession, folder: str, table: str, files: int = 1000) -> DataFrame:
    """``table``.parquet of a folder as a stream, be it one file or a folder of files.

    A stream can start at a folder or at a pattern only; the brackets make a pattern of the name.
    """
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(
        f"{folder}/[{table[0]}]{table[1:]}.parquet")


def windowed_metrics(stream: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = DELAY) -> DataFrame:
    """Per window and metric: count, mean, extremes; a window is final once the watermark passes it."""
    return A.recent_metrics(stream.withWatermark("ts", delay), size, slide)


def _marked(rows: DataFrame, delay: str) -> DataFrame:
    """With the watermark, to which a final marker counts, and without the marker itself (the filter reads the event
    time, so it stays above the watermark)."""
    return rows.withWatermark("ts", delay).where(F.col("ts") < F.lit(END).cast("timestamp"))


def cooled_alerts(alerts: DataFrame, delay: str = DELAY) -> DataFrame:
    """Alerts that pass the cooldown of their key, decided in event-time order.

    Alerts wait in the state until the watermark has passed them, so rows that
    arrive out of order within the delay give the same result as a batch run.
    The state of a key is the last passing time and the alerts of the delay.
    """
    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, ts, ids, waits = state.get if state.exists else (None, [], [], [])
        ts, ids, waits = list(ts), list(ids), list(waits)
        if not state.hasTimedOut:
            for pdf in frames:
                ts += pdf["t"].tolist()
                ids += pdf["event_id"].tolist()
                waits += pdf["wait"].tolist()
        mark = state.getCurrentWatermarkMs() * 1000
        passed, rest = [], []
        for t, event_id, wait in sorted(zip(ts, ids, waits)):
            if t >= mark:
                rest.append((t, event_id, wait))
            elif last is None or t - last >= wait:
                last = t
                passed.append((t, event_id))
        state.update((last, [r[0] for r in rest], [r[1] for r in rest], [r[2] for r in rest]))
        if rest:
            state.setTimeoutTimestamp(max(rest[0][0] // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({
            "alert_type": key[0], "component": key[1], "t": [p[0] for p in passed], "event_id": [p[1] for p in passed]})

    ready = with_rule(alerts).withColumns({
        "t": F.unix_micros("ts"), "wait": F.col("cooldown_minutes").cast("long") * A.MINUTE})
    return _marked(ready, delay).groupBy("alert_type", "component").applyInPandasWithState(
        fold, "alert_type string, component string, t long, event_id long",
        "last long, ts array<long>, ids array<long>, waits array<long>",
        "append", GroupStateTimeout.EventTimeTimeout)


def escalations(events: DataFrame, delay: str = DELAY, buckets: int = 1024) -> DataFrame:
    """Alerts still open when the watermark passes their escalation time.

    ``events``: alert_id, alert_type, ts, kind ('raised' or 'resolved'). An alert leaves the
    state when it is resolved or escalated. One state holds the open alerts of a bucket of ids,
    so that Python runs once per bucket and batch and not once per alert; ``buckets`` is fixed
    for the life of a checkpoint.
    """
    columns = ["alert_id", "raised", "resolved", "wait"]
    empty = pd.DataFrame({"alert_id": pd.Series([], dtype=object), **{c: pd.Series([], dtype="Int64") for c in columns[1:]}})

    def track(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [empty]
        if state.exists:
            ids, *times = state.get
            parts.append(pd.DataFrame({"alert_id": pd.Series(list(ids), dtype=object), **{
                c: pd.Series([None if x is None else int(x) for x in t], dtype="Int64") for c, t in zip(columns[1:], times)}}))
        if not state.hasTimedOut:
            for pdf in frames:
                t, resolves = pdf["t"].astype("Int64"), (pdf["kind"] == "resolved").to_numpy(bool)
                parts.append(pd.DataFrame({
                    "alert_id": pdf["alert_id"].astype(object), "raised": t.mask(resolves), "resolved": t.mask(~resolves),
                    "wait": pdf["wait"].astype("Int64")}))
        alerts = pd.concat(parts, ignore_index=True).groupby("alert_id", sort=False, dropna=False).agg(
            {"raised": "min", "resolved": "min", "wait": "last"}).reset_index()
        mark = state.getCurrentWatermarkMs() * 1000
        due = alerts["raised"].fillna(alerts["resolved"]) + alerts["wait"]
        open_still = (due >= mark).to_numpy(bool)
        late = ~open_still & (alerts["raised"].notna() & ~(alerts["resolved"] <= due).fillna(False)).to_numpy(bool)
        if open_still.any():
            kept = alerts[open_still]
            state.update((kept["alert_id"].tolist(), *(
                [None if x is pd.NA else int(x) for x in kept[c]] for c in columns[1:])))
            state.setTimeoutTimestamp(max(int(due[open_still].min()) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield alerts.loc[late, ["alert_id", "raised"]].astype({"raised": "int64"})

    ready = with_rule(events).withColumns({
        "t": F.unix_micros("ts"), "wait": F.col("escalation_minutes").cast("long") * A.MINUTE})
    return _marked(ready, delay).withColumn("bucket", F.pmod(F.xxhash64("alert_id"), F.lit(buckets))).groupBy(
        "bucket").applyInPandasWithState(
        track, "alert_id string, raised long",
        "ids array<string>, raised array<long>, resolved array<long>, waits array<long>", "append",
        GroupStateTimeout.EventTimeTimeout)


# ---- end of input ----------------------------------------------------------
def until_marker(stream: DataFrame, folder: str) -> DataFrame:
    """``stream`` together with the final markers of a folder, for the operators that wait for the watermark.

    The operators above emit a window or an alert only once the watermark has
    passed it, so the last ones of an input that ends stay in the state. A
    marker is a row with a time and nothing else; the rows that it makes itself are never emitted.
    """
    S.write_table(stream.sparkSession.createDataFrame([], stream.schema), folder)
    marks = stream.sparkSession.readStream.schema(stream.schema).option("pathGlobFilter", "*.parquet").parquet(folder)
    return stream.unionByName(marks)


def write_marker(spark: SparkSession, schema: str | StructType, folder: str, at: str = END) -> None:
    """The final marker: written once, when no more input will come; what comes later is late."""
    blank = spark.createDataFrame([()], StructType([])).select(F.lit(at).cast("timestamp").alias("ts"))
    fields = spark.createDataFrame([], schema).schema
    blank.select(*[F.col(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).write.mode(
        "append").parquet(folder)


def write_all(build: Callable[[DataFrame], DataFrame], stream: DataFrame, path: str, checkpoint: str, markers: str) -> None:
    """Run ``build(stream)`` over all data now present and then to its end: nothing stays in the state."""
    spark = stream.sparkSession
    out = build(until_marker(stream, markers))
    write_available(out, path, checkpoint).awaitTermination()
    write_marker(spark, stream.schema, markers)
    write_available(out, path, checkpoint).awaitTermination()


# ---- sinks -----------------------------------------------------------------
def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over all data now present, into Parquet, exactly once."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def score_live_reviews(
    reviews: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: str = "review_id"
) -> StreamingQuery:
    """Score new reviews and append those not scored before.

    The keys seen so far are the stream's state: a set by hash of the key, versioned with the
    checkpoint, so a batch reads its own files only and never the earlier output.
    Each batch writes its own folder, so a repeated batch replaces its rows.
    """
    def handle(batch: DataFrame, epoch: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return each_batch(reviews.dropDuplicates([key]), handle, checkpoint)


def monitoring_cycle(metrics: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Per batch: raised alerts and a summary row, each in the batch's own folder."""
    def handle(batch: DataFrame, epoch: int) -> None:
        alerts = A.raised_alerts(batch)
        batch.persist()  # one read of the batch for both outputs
        try:
            alerts.write.mode("overwrite").parquet(f"{path}/alerts/epoch={epoch}")
            A.cycle_summary(batch, alerts).write.mode("overwrite").parquet(f"{path}/summary/epoch={epoch}")
        finally:
            batch.unpersist()
    return each_batch(metrics, handle, checkpoint)


