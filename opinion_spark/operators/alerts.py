"""Alerts from metric rows: thresholds, cooldown, gate, escalation, routing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.functions import lexicons as L
from opinion_spark.operators.joins import above_threshold, case_of, channel_table, route, with_rule
from opinion_spark.operators.ranking import first_per_key
from opinion_spark.session import materialize

MINUTE = 60_000_000  # microseconds


def severity_rank(severity: Column) -> Column:
    return case_of(severity, L.SEVERITY_RANK, 0)


def alert_id(kind: Column, component: Column, ts: Column) -> Column:
    return F.concat_ws("_", kind, component, F.unix_timestamp(ts).cast("string"))


def one_decimal(v: Column) -> Column:
    """A number >= 0 with one decimal, rounded by the exact binary value.

    Java rounds the printed decimal instead, so 89.55, which is stored a little
    below that, would become 89.6. ``error`` is what the product by 10 lost.
    """
    high = v * 134217729.0 - (v * 134217729.0 - v)
    tens = v * 10.0
    error = (high * 10.0 - tens) + (v - high) * 10.0
    whole = F.floor(tens)
    rest = tens - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    k = whole + up.cast("long")
    return F.concat(F.floor(k / 10).cast("string"), F.lit("."), (k % 10).cast("string"))


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", alert_id(F.col("alert_type"), F.col("component"), F.col("ts")).alias("alert_id"),
        "alert_type", "severity", "component", "message", "metric_value", "threshold", "ts")


def system_alerts(metrics: DataFrame, thresholds: dict[str, float] = L.SYSTEM_THRESHOLDS) -> DataFrame:
    """cpu, memory and disk above their threshold; high if more than 10 above."""
    v, t = F.col("metric_value"), F.col("threshold")
    name = F.initcap(F.replace("metric_name", F.lit("_"), F.lit(" ")))
    return _finish(above_threshold(metrics, thresholds).withColumns({
        "alert_type": F.lit("system_threshold"), "severity": F.when(v > t + 10, "high").otherwise("medium"),
        "component": F.col("metric_name"),
        "message": F.format_string("%s is %s%% (threshold: %s%%)", name, one_decimal(v), one_decimal(t))}))


def model_alerts(metrics: DataFrame, threshold: float = L.ACCURACY_THRESHOLD) -> DataFrame:
    """Accuracy below the threshold; high at or below 0.5."""
    v = F.col("metric_value")
    low = metrics.where((F.col("metric_name") == "accuracy") & (v < threshold))
    return _finish(low.withColumns({
        "alert_type": F.lit("model_performance"), "severity": F.when(v > 0.5, "medium").otherwise("high"),
        "threshold": F.lit(threshold),
        "message": F.format_string(
            "%s accuracy dropped to %s%% (threshold: 70%%)", F.col("component"), one_decimal(v * 100))}))


def health_alerts(metrics: DataFrame) -> DataFrame:
    bad = metrics.where((F.col("metric_name") == "health") & F.col("status").isin("warning", "critical"))
    return _finish(bad.withColumns({
        "alert_type": F.lit("health_check"),
        "severity": F.when(F.col("status") == "critical", "critical").otherwise("medium"),
        "threshold": F.lit(None).cast("double"),
        "message": F.format_string("%s health check %s: Unknown issue", F.col("component"), F.col("status"))}))


def raised_alerts(metrics: DataFrame) -> DataFrame:
    return system_alerts(metrics).unionAll(model_alerts(metrics)).unionAll(health_alerts(metrics))


def health_status(value: Column, threshold: Column | float, critical: float = 95.0) -> Column:
    """healthy below the threshold, critical above the critical level, else warning."""
    return F.when(value > critical, "critical").when(value < threshold, "healthy").otherwise("warning")


def component_health(kind: Column, value: Column, failed: Column | None = None) -> Column:
    """The status of a health check by the rule of its kind; null for kinds without one.

    cpu, memory and disk: percent in use, each with its own threshold and critical level.
    ``response_time``: seconds that the database took. ``confidence``: of a model in a test text.
    ``users``: how many the recommender knows. A check that failed is critical whatever its kind.
    """
    status = F.lit(None).cast("string")
    for name, threshold in L.SYSTEM_THRESHOLDS.items():
        status = F.when(kind == name, health_status(value, threshold, L.CRITICAL_ABOVE[name])).otherwise(status)
    for name, good in (("response_time", value < L.RESPONSE_SECONDS), ("confidence", value > L.LEAST_CONFIDENCE),
                       ("users", value > 0)):
        status = F.when(kind == name, F.when(good, "healthy").otherwise("warning")).otherwise(status)
    return status if failed is None else F.when(failed, "critical").otherwise(status)


def checked_health(checks: DataFrame) -> DataFrame:
    """``checks`` (component, kind, value, failed, ...) with ``status`` and the error message of what isn't healthy."""
    named = F.element_at(F.create_map(*[F.lit(x) for k in L.SYSTEM_THRESHOLDS for x in (k, k.split("_")[0])]), F.col("kind"))
    status = component_health(F.col("kind"), F.col("value"), F.coalesce("failed", F.lit(False)))
    return checks.withColumn("status", status).withColumn("error_message", F.when(
        named.isNotNull() & (F.col("status") != "healthy"),
        F.concat(F.lit("High "), named, F.lit(" usage: "), one_decimal(F.col("value")), F.lit("%"))))


# ---- cooldown --------------------------------------------------------------
# An alert passes if at least the cooldown has gone by since the last alert of
# its key that passed; a suppressed alert does not restart the clock. That is a
# sequential rule, so a hot key would be one long loop in one task. Time is cut
# into blocks instead. Step 1 finds, for every block on its own, which alert
# ends the chain that starts at a given first alert: a table that maps the time from
# which an alert may pass to the last one that does. Step 2 composes the tables of
# FAN neighbours into one, level by level up to a root, and then sends the last passing time
# back down, so that no task reads more than FAN tables (an associative scan).
# Step 3 replays every block from its known start.

KEYS = ["alert_type", "component"]
FAN = 16  # tables that are composed at a time
CHAINS = "alert_type string, component string, block long, wait long, first long, last long"


def _next_index(times: np.ndarray, wait: int) -> np.ndarray:
    """Index of the first alert at least ``wait`` after each one."""
    return np.searchsorted(times, times + wait, side="left")


def _chain_table(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """For each possible first passing alert of a block, the last passing one."""
    times = np.sort(pdf["t"].to_numpy())
    wait, start = int(pdf["wait"].iloc[0]), int(pdf["block_start"].iloc[0])
    n = len(times)
    step = _next_index(times, wait)
    end = np.where(step < n, step, np.arange(n))
    while True:  # doubling: each round follows twice as many links
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    return _table(key, times, times[end], wait, start)


def _table(key: tuple, first: np.ndarray, last: np.ndarray, wait: int, start: int) -> pd.DataFrame:
    """Rows (first, last) of a block that begins at ``start``: who may pass from t on, ends at the last of the next first.

    Nobody waits longer than one cooldown after the start, so one row beyond it is enough.
    """
    m = min(len(first), int(np.searchsorted(first, start + wait, side="left")) + 1)
    first, last = first[:m], last[:m]
    keep = np.append(last[1:] != last[:-1], True)  # last entry of each run of equal ends
    return pd.DataFrame({
        "alert_type": key[0], "component": key[1], "block": key[2], "wait": wait,
        "first": first[keep], "last": last[keep]})


def _through(first: np.ndarray, last: np.ndarray, known: np.ndarray, wait: int) -> np.ndarray:
    """The last passing time after a block, for each one before it."""
    place = np.searchsorted(first, known + wait, side="left")
    return np.where(place < len(first), last[np.minimum(place, len(first) - 1)], known)


def _children(pdf: pd.DataFrame):
    for block, rows in pdf.sort_values(["block", "first"]).groupby("block", sort=True):
        yield int(block), rows["first"].to_numpy(), rows["last"].to_numpy()


def _composed(span: int):
    """The tables of up to ``FAN`` neighbours as one; ``span`` is the time that the new block covers."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        wait = int(pdf["wait"].iloc[0])
        first = last = np.empty(0, np.int64)
        for _, f, to in _children(pdf):
            later = np.searchsorted(f, first[-1] if len(first) else -(2**62), side="right")
            last = np.append(_through(f, to, last, wait), to[later:])
            first = np.append(first, f[later:])
        return _table(key, first, last, wait, key[2] * span)
    return run


def _downward(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The last alert that passed before each of the children, from that before their parent."""
    known, wait, out = pdf["known"].iloc[0], int(pdf["wait"].iloc[0]), []
    known = None if pd.isna(known) else int(known)
    for block, first, last in _children(pdf):
        out.append((key[0], key[1], block, known))
        known = int(_through(first, last, np.array([-(2**62) if known is None else known]), wait)[0])
    return pd.DataFrame(out, columns=["alert_type", "component", "block", "known"]).astype({"known": "Int64"})


def _known_before(chains: DataFrame, size: int) -> DataFrame:
    """(key, block, known): the last passing time before each block, by an upward and a downward sweep."""
    levels = [materialize(chains)]
    parent = F.floor(F.col("block") / FAN)
    low, high = levels[0].agg(F.min("block"), F.max("block")).first()
    span = size
    while low is not None and low != high:
        span *= FAN
        levels.append(materialize(levels[-1].withColumn("parent", parent).groupBy(*KEYS, "parent").applyInPandas(
            _composed(span), CHAINS)))
        low, high = low // FAN, high // FAN
    known = levels[-1].select(*KEYS, "block").distinct().withColumn("known", F.lit(None).cast("long"))
    for tables in levels[-2::-1]:
        above = known.withColumnRenamed("block", "parent")
        known = materialize(tables.withColumn("parent", parent).join(above, KEYS + ["parent"]).groupBy(
            *KEYS, "parent").applyInPandas(_downward, "alert_type string, component string, block long, known long"))
    return known


def _replay(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The passing times of one block."""
    times, wait = np.sort(pdf["t"].to_numpy()), int(pdf["wait"].iloc[0])
    known = pdf["known"].iloc[0]
    at = 0 if pd.isna(known) else int(np.searchsorted(times, int(known) + wait, side="left"))
    step, passed = _next_index(times, wait), []
    while at < len(times):
        passed.append(times[at])
        at = int(step[at])
    return pd.DataFrame({"alert_type": key[0], "component": key[1], "t": np.array(passed, dtype="int64")})


def _block_size(times: DataFrame, rows_per_block: int) -> int:
    """Block length in microseconds, so that no key has many more rows in a block."""
    hour = 60 * MINUTE
    peak = times.groupBy(*KEYS, F.floor(F.col("t") / hour)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return int(min(2160 * hour, max(MINUTE, hour * rows_per_block / (peak or 1))))


def after_cooldown(alerts: DataFrame, block_minutes: int | None = None, rows_per_block: int = 500_000) -> DataFrame:
    """The alerts that pass the cooldown of their (type, component)."""
    ruled = with_rule(alerts).withColumns({
        "t": F.unix_micros("ts"), "wait": F.col("cooldown_minutes").cast("long") * MINUTE})
    # alerts of one instant: only the first can pass
    ruled = first_per_key(ruled, KEYS + ["t"], [F.col("event_id")])
    times = materialize(ruled.select(*KEYS, "t", "wait"))
    size = _block_size(times, rows_per_block) if block_minutes is None else block_minutes * MINUTE
    times = times.withColumn("block", F.floor(F.col("t") / size)).withColumn("block_start", F.col("block") * size)
    known = _known_before(times.groupBy(*KEYS, "block").applyInPandas(_chain_table, CHAINS), size)
    passed = times.join(known, KEYS + ["block"]).groupBy(*KEYS, "block").applyInPandas(
        _replay, "alert_type string, component string, t long")
    return ruled.join(passed, KEYS + ["t"], "left_semi").drop("t", "wait", "cooldown_minutes", "escalation_minutes")


def past_gate(cooled: DataFrame, block_minutes: int = 24 * 60) -> DataFrame:
    """Of the alerts past the cooldown, those that are new for their component.

    The active alert of a component gives way only to another type or a higher
    severity. So the active type is that of the alert before, and the active
    severity the highest of the current run of one type.

    A segmented scan: windows run over one block of a component. A block is summed up by the
    types at its ends and the highest severity of its last run; such sums are
    carried on over the blocks, and the first run of a block goes on from what is carried in.
    """
    size = block_minutes * MINUTE
    marked = materialize(cooled.withColumns({
        "__rank": severity_rank(F.col("severity")), "__block": F.floor(F.unix_micros("ts") / size)}))
    order = [F.col("ts"), F.col("event_id")]
    inside = Window.partitionBy("component", "__block").orderBy(*order)
    changes = F.coalesce(F.col("alert_type") != F.lag("alert_type").over(inside), F.lit(True))
    runs = materialize(marked.withColumn("__new", changes).withColumn(
        "__run", F.sum(F.col("__new").cast("int")).over(inside)))
    ends = runs.groupBy("component", "__block").agg(
        F.min_by("alert_type", F.struct(*order)).alias("head"), F.max_by("alert_type", F.struct(*order)).alias("tail"),
        F.max("__run").alias("n"))
    last = runs.groupBy("component", "__block", "__run").agg(F.max("__rank").alias("top")).groupBy(
        "component", "__block").agg(F.max_by("top", "__run").alias("top"))
    blocks = Window.partitionBy("component").orderBy("__block")  # a row per block
    begins = F.coalesce((F.col("n") > 1) | (F.col("head") != F.lag("tail").over(blocks)), F.lit(True))
    segments = ends.join(last, ["component", "__block"]).withColumn("segment", begins.cast("int")).withColumn(
        "segment", F.sum("segment").over(blocks))
    upto = Window.partitionBy("component", "segment").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    carried = segments.withColumn("upto", F.max("top").over(upto)).select(
        "component", "__block", F.lag("tail").over(blocks).alias("__type"), F.lag("upto").over(blocks).alias("__carried"))
    before = Window.partitionBy("component", "__block", "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    goes_on = (F.col("__run") == 1) & F.coalesce(F.col("alert_type") == F.col("__type"), F.lit(False))
    top = F.greatest(F.col("__top"), F.when(goes_on, F.col("__carried")))
    return runs.withColumn("__top", F.max("__rank").over(before)).join(carried, ["component", "__block"]).where(
        (F.col("__new") & ~goes_on) | (F.col("__rank") > top)).select(*cooled.columns)


def filtered_alerts(metrics: DataFrame) -> DataFrame:
    """Raised alerts after cooldown and gate, unresolved and not escalated."""
    return past_gate(after_cooldown(raised_alerts(metrics))).withColumns({
        "resolved": F.lit(False), "escalated": F.lit(False)})


# ---- lifecycle -------------------------------------------------------------
def escalate(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Set ``escalated`` on open alerts older than the minutes of their rule."""
    age = F.unix_micros(as_of) - F.unix_micros("ts")
    due = ~F.col("resolved") & ~F.col("escalated") & (age > F.col("escalation_minutes").cast("long") * MINUTE)
    return with_rule(alerts).withColumn("escalated", F.col("escalated") | due).drop(
        "cooldown_minutes", "escalation_minutes")


def resolve(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Apply (alert_id, notes, resolved_at); the latest resolution of an id counts."""
    last = resolutions.groupBy("alert_id").agg(
        F.max_by("notes", "resolved_at").alias("notes"), F.max("resolved_at").alias("resolved_at"))
    return alerts.join(last, "alert_id", "left").withColumn(
        "resolved", F.col("resolved") | F.col("resolved_at").isNotNull())


def notifications(alerts: DataFrame) -> DataFrame:
    """Delivery log: one row per alert and channel that wants it."""
    return route(alerts, channel_table(alerts.sparkSession)).select("alert_id", "event_id", "channel", "severity")


def dashboard_alerts(drift: DataFrame, accuracy: DataFrame) -> DataFrame:
    """HIGH alert for a HIGH drift severity, MEDIUM for accuracy below 0.8.

    ``drift``: source_id, severity; ``accuracy``: source_id, accuracy."""
    a = drift.where(F.col("severity") == "HIGH").select(
        "source_id", F.lit("drift").alias("alert_type"), F.lit("HIGH").alias("level"))
    b = accuracy.where(F.col("accuracy") < 0.8).select(
        "source_id", F.lit("accuracy").alias("alert_type"), F.lit("MEDIUM").alias("level"))
    return a.unionByName(b)


def recent_metrics(metrics: DataFrame, size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Count, mean and extremes of each metric per time window; batch or stream."""
    when = F.window("ts", size, slide) if slide else F.window("ts", size)
    return metrics.groupBy(when.alias("w"), "metric_name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("metric_value").alias("avg_value"),
        F.min("metric_value").alias("min_value"), F.max("metric_value").alias("max_value")).select(
        F.col("w.start").alias("window_start"), "metric_name", "n", "avg_value", "min_value", "max_value")


def cycle_summary(metrics: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: metric rows, health checks and alerts of a cycle."""
    row = metrics.agg(
        F.count_if(F.col("metric_name") != "health").alias("metrics_collected"),
        F.count_if(F.col("metric_name") == "health").alias("health_checks"))
    return row.withColumn("alerts_raised", alerts.agg(F.count(F.lit(1)).alias("n")).scalar())


