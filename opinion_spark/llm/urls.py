"""URL filters: captures joined as of their fetch time with dated list entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.session import materialize

FOREVER = "9999-12-31 00:00:00"


def host(url: Column) -> Column:
    """Lower-case host of an http(s) URL, without user, port and final dot; null if there is none."""
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(found, r"\.$", ""), F.lit(""))


def keys(url: Column) -> Column:
    """What a list entry can name: the URL without scheme, query and fragment, and the host with its parents."""
    labels = F.split(host(url), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("host:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    path = F.regexp_replace(F.regexp_extract(url, r"://(?:[^/?#@]*@)?([^?#]*)", 1), r"/+$", "")
    return F.when(host(url).isNotNull(), F.concat(parents, F.array(F.concat(F.lit("page:"), path))))


def validity(entries: DataFrame) -> DataFrame:
    """(key, list_name, valid_from, valid_to) from dated changes (key, list_name, action, at).

    An ``add`` is in force until the next change of its key on its list; a
    ``remove`` ends it. Changes that repeat the state before them start nothing
    new. Of changes at one time ``remove`` counts last. Rows with a null key, list,
    time or another action are left out. A window holds the history of one entry.
    """
    usable = entries.where("key is not null and list_name is not null and at is not null and action in ('add', 'remove')")
    states = usable.groupBy("key", "list_name", "at").agg(F.max("action").alias("action"))
    entry = Window.partitionBy("key", "list_name").orderBy("at")
    turns = states.withColumn("was", F.lag("action").over(entry)).where("was is null or was != action")
    spans = turns.withColumn("valid_to", F.coalesce(F.lead("at").over(entry), F.lit(FOREVER).cast("timestamp")))
    return spans.where("action = 'add'").select("key", "list_name", F.col("at").alias("valid_from"), "valid_to")


def temporal_filter(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    time_col: str = "fetched_at") -> DataFrame:
    """(id, url, fetched_at, lists, entries, blocked) of every capture as of its fetch time.

    ``lists`` names, in order, the lists with an entry for the URL, its host or a
    parent domain in force at the fetch (``valid_from <= t < valid_to``); ``entries``
    counts those entries. Captures meet intervals of their own keys only, and of
    these only the months that both touch, so a host that holds a third of all
    captures is joined by (key, month), and a long history of one entry is never
    gathered. Lists are reduced per distinct (URL keys, time) before they go back.

    A URL that is null or has no host, and a null fetch time, match nothing: no
    lists, 0 entries, not blocked. Repeated captures are answered one by one;
    repeated entries count once. Without entries nothing is blocked; without
    captures there are no rows. Other columns of both tables are not read.
    """
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("t"))
    times = rows.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()  # months without captures are not needed
    lo, hi = F.lit(times["lo"]).cast("timestamp"), F.lit(times["hi"]).cast("timestamp")
    spans = validity(entries).where((F.col("valid_from") <= hi) & (F.col("valid_to") > lo))
    spread = materialize(spans.withColumn("month", F.explode(F.sequence(
        F.trunc(F.greatest("valid_from", lo), "month"), F.trunc(F.least("valid_to", hi), "month"),
        F.expr("interval 1 month")))).select("key", "month", "list_name", "valid_from", "valid_to"))
    asked = rows.where("t is not null").select("url", "t").distinct().select(
        "url", "t", F.explode(keys(F.col("url"))).alias("key"), F.trunc("t", "month").alias("month"))
    hits = asked.join(spread, ["key", "month"]).where("valid_from <= t and t < valid_to")
    told = hits.groupBy("url", "t").agg(
        F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("lists"), F.count("*").alias("n"))
    return rows.join(told, ["url", "t"], "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("t").alias(time_col),
        F.coalesce("lists", F.lit("")).alias("lists"), F.coalesce("n", F.lit(0)).cast("long").alias("entries"),
        F.col("n").isNotNull().alias("blocked"))
