"""Review, metric and vector views over the supplied tables.

Each view comes twice: as a Spark DataFrame and as the text of a SQL CTE that
another engine can run. Ids, ratings and votes of the text view are taken from
the md5 of the text, so exact copies of a text share product, user and rating
and the copies in the data act as natural duplicate reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.session import spread

# Phrase added to a text, picked by the md5 of the text, so that lexicon,
# aspect, URL, mail, punctuation and contraction rules all occur.
PHRASES = [
    " Great taste and fresh!! Highly recommend.",
    " Stale and bland, terrible value for the price.",
    " The packaging was damaged but delivery was fast.",
    " Buy now! Amazing amazing flavor!!!",
    "",
    " I don't love the texture. See http://x.co/a or mail a@b.co",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def digits(text: Column, start: int) -> Column:
    """A number below 2**24 from six hex digits of the md5 of ``text``."""
    return F.conv(F.substring(F.md5(text), start, 6), 16, 10).cast("long")


def reviews_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review facts without text; the four key parts together are unique."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    lines = spread(lines, "l_orderkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    qty = F.col("l_quantity").cast("int")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("review_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("user_id"),
        (1 + (F.col("l_orderkey") * 3 + F.col("l_linenumber") * 7 + F.col("l_partkey")) % 5)
        .cast("int").alias("rating"),
        F.col("l_shipdate").cast("timestamp").alias("review_date"),
        (qty % 10).alias("helpful_votes"),
        (qty % 10 + F.col("l_linenumber") % 4).alias("total_votes"),
    )


REVIEWS_CORE_SQL = """reviews_core AS (
  SELECT concat_ws('-', l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar,
                   l_suppkey::varchar) AS review_id,
         l_partkey AS product_id, o_custkey AS user_id,
         CAST(1 + (l_orderkey*3 + l_linenumber*7 + l_partkey) % 5 AS INT) AS rating,
         l_shipdate AS review_date,
         CAST(CAST(l_quantity AS INT) % 10 AS INT) AS helpful_votes,
         CAST(CAST(l_quantity AS INT) % 10 + l_linenumber % 4 AS INT) AS total_votes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def reviews_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with their whole text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return text_rows(spread(docs, "doc_id"))


def text_rows(docs: DataFrame) -> DataFrame:
    """The text view of a table or stream of documents."""
    pick = digits(F.col("text"), 19) % len(PHRASES)
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (pick + 1).cast("int"))
    helpful = (F.col("n_chars") % 7).cast("int")
    return docs.select(
        F.col("doc_id").alias("review_id"),
        F.concat(F.lit("P"), digits(F.col("text"), 1) % 40).alias("product_id"),
        F.concat(F.lit("U"), digits(F.col("text"), 7) % 97).alias("user_id"),
        (1 + digits(F.col("text"), 13) % 5).cast("int").alias("rating"),
        F.concat("text", phrase).alias("review_text"),
        F.concat("source", F.lit(" review no. "), F.col("doc_id").cast("string"), F.lit(" / "), F.md5("text")).alias("review_title"),
        helpful.alias("helpful_votes"),
        (helpful + (F.col("n_chars") % 3).cast("int")).alias("total_votes"),
        F.date_add(F.lit("2011-01-01").cast("date"), (digits(F.col("text"), 25) % 730).cast("int"))
        .cast("timestamp").alias("date"),
        F.col("lang"),
    )


def _sql_digits(start: int) -> str:
    return f"CAST('0x' || substr(md5(text), {start}, 6) AS bigint)"


_CASES = " ".join(
    "WHEN {} THEN '{}'".format(i, p.replace("'", "''")) for i, p in enumerate(PHRASES))
REVIEWS_TEXT_SQL = f"""reviews_text AS (
  SELECT doc_id AS review_id,
         'P' || ({_sql_digits(1)} % 40) AS product_id,
         'U' || ({_sql_digits(7)} % 97) AS user_id,
         CAST(1 + {_sql_digits(13)} % 5 AS INT) AS rating,
         text || CASE {_sql_digits(19)} % 6 {_CASES} END AS review_text,
         source || ' review no. ' || doc_id || ' / ' || md5(text) AS review_title,
         CAST(n_chars % 7 AS INT) AS helpful_votes,
         CAST(n_chars % 7 + n_chars % 3 AS INT) AS total_votes,
         CAST(DATE '2011-01-01' + CAST({_sql_digits(25)} % 730 AS INT) AS TIMESTAMP) AS date,
         lang
  FROM documents)"""


def fake_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("review_id"), (1 - F.col("quality")).cast("int").alias("is_fake"))
    return reviews_text(spark, sf_dir).join(labels, "review_id")


FAKE_LABELS_SQL = """fake_labels AS (
  SELECT r.*, CAST(1 - quality AS INT) AS is_fake
  FROM reviews_text r JOIN labels ON r.review_id = labels.doc_id)"""


def metric_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(read(spark, sf_dir, "events"))


def metric_rows(events: DataFrame) -> DataFrame:
    """Monitoring rows from a table or stream of events."""
    name = F.col("event_type")
    slot = F.col("event_id") % 10
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("c"), F.col("user_id") % 10).alias("component"),
        F.when(name == "click", "cpu_usage").when(name == "view", "memory_usage")
        .when(name == "error", "disk_usage").when(name == "purchase", "accuracy")
        .otherwise("health").alias("metric_name"),
        F.when(name == "purchase", (F.col("value") % 100) / 100)
        .otherwise(F.col("value") % 100).alias("metric_value"),
        F.when(slot == 0, "critical").when(slot < 3, "warning").otherwise("healthy").alias("status"),
    )


METRIC_STREAM_SQL = """metric_stream AS (
  SELECT event_id, ts, 'c' || (user_id % 10) AS component,
         CASE event_type WHEN 'click' THEN 'cpu_usage' WHEN 'view' THEN 'memory_usage'
              WHEN 'error' THEN 'disk_usage' WHEN 'purchase' THEN 'accuracy'
              ELSE 'health' END AS metric_name,
         CASE WHEN event_type = 'purchase' THEN (value % 100) / 100 ELSE value % 100 END
           AS metric_value,
         CASE WHEN event_id % 10 = 0 THEN 'critical' WHEN event_id % 10 < 3 THEN 'warning'
              ELSE 'healthy' END AS status
  FROM events)"""


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl log: one row per page request of a session."""
    value = F.col("value")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") % 20).alias("session_id"),
        F.col("user_id").alias("target_id"),
        F.when(F.col("event_type") == "error", F.when(value < 250, 429).otherwise(500))
        .otherwise(200).cast("int").alias("status_code"),
        (value / 100).alias("response_time"),
        F.when(F.col("event_type") == "view", (value % 20).cast("int")).otherwise(0)
        .alias("reviews_found"),
    )


FETCH_LOG_SQL = """fetch_log AS (
  SELECT event_id AS request_id, ts, user_id % 20 AS session_id, user_id AS target_id,
         CAST(CASE WHEN event_type = 'error' THEN CASE WHEN value < 250 THEN 429 ELSE 500 END
              ELSE 200 END AS INT) AS status_code,
         value / 100 AS response_time,
         CASE WHEN event_type = 'view' THEN CAST(trunc(value % 20) AS INT) ELSE 0 END
           AS reviews_found
  FROM events)"""


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("product_id"), F.col("embedding").cast("array<double>").alias("vector"))


ITEM_VECTORS_SQL = """item_vectors AS (
  SELECT vec_id AS product_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"""

DRIFT_SPLIT = "1998-06-01"


def drift_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational reviews marked as baseline or comparison by date."""
    return reviews_core(spark, sf_dir).withColumn(
        "side", F.when(F.col("review_date") < F.lit(DRIFT_SPLIT).cast("timestamp"), "baseline")
        .otherwise("comparison"))


DRIFT_SIDES_SQL = f"""drift_sides AS (
  SELECT *, CASE WHEN review_date < TIMESTAMP '{DRIFT_SPLIT}' THEN 'baseline'
            ELSE 'comparison' END AS side FROM reviews_core)"""

TEXT_SPLIT = "2012-01-01"


def text_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texted reviews marked as baseline or comparison by date."""
    return reviews_text(spark, sf_dir).withColumn(
        "side", F.when(F.col("date") < F.lit(TEXT_SPLIT).cast("timestamp"), "baseline")
        .otherwise("comparison"))


TEXT_SIDES_SQL = f"""text_sides AS (
  SELECT *, CASE WHEN date < TIMESTAMP '{TEXT_SPLIT}' THEN 'baseline'
            ELSE 'comparison' END AS side FROM reviews_text)"""


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texted reviews as a raw source holds them: text-typed, dirty, dialect names."""
    r = reviews_text(spark, sf_dir)
    tail = F.col("review_id") % 50
    return r.select(
        F.col("review_id").alias("Id"),
        F.col("product_id").alias("ProductId"),
        F.when(tail == 4, None).otherwise(F.col("user_id")).alias("UserId"),
        F.when(tail == 3, "bad").when(tail == 5, "7").when(tail == 6, "4.5")
        .otherwise(F.col("rating").cast("string")).alias("Score"),
        F.when(tail == 7, " \t ").otherwise(F.col("review_text")).alias("Text"),
        F.when(tail == 8, None).otherwise(F.col("review_title")).alias("Summary"),
        F.when(tail == 9, "x").otherwise((F.col("helpful_votes") + 1).cast("string"))
        .alias("HelpfulnessNumerator"),
        F.col("total_votes").cast("string").alias("HelpfulnessDenominator"),
        F.unix_timestamp("date").alias("Time"),
    )


RAW_REVIEWS_SQL = """raw_reviews AS (
  SELECT review_id AS Id, product_id AS ProductId,
         CASE WHEN review_id % 50 <> 4 THEN user_id END AS UserId,
         CASE review_id % 50 WHEN 3 THEN 'bad' WHEN 5 THEN '7' WHEN 6 THEN '4.5'
              ELSE rating::varchar END AS Score,
         CASE WHEN review_id % 50 = 7 THEN ' ' || chr(9) || ' ' ELSE review_text END AS "Text",
         CASE WHEN review_id % 50 <> 8 THEN review_title END AS Summary,
         CASE WHEN review_id % 50 = 9 THEN 'x' ELSE (helpful_votes + 1)::varchar END
           AS HelpfulnessNumerator,
         total_votes::varchar AS HelpfulnessDenominator,
         CAST(epoch(date) AS BIGINT) AS "Time"
  FROM reviews_text)"""

VIEWS_SQL = {
    "reviews_core": REVIEWS_CORE_SQL,
    "reviews_text": REVIEWS_TEXT_SQL,
    "fake_labels": FAKE_LABELS_SQL,
    "metric_stream": METRIC_STREAM_SQL,
    "fetch_log": FETCH_LOG_SQL,
    "item_vectors": ITEM_VECTORS_SQL,
    "drift_sides": DRIFT_SIDES_SQL,
    "text_sides": TEXT_SIDES_SQL,
    "raw_reviews": RAW_REVIEWS_SQL,
}
_NEEDS = {
    "fake_labels": ["reviews_text"], "raw_reviews": ["reviews_text"],
    "text_sides": ["reviews_text"], "drift_sides": ["reviews_core"],
}


def sql(views: str, body: str, *ctes: str, recursive: bool = False) -> str:
    """``WITH <views>, <ctes> <body>``; views are given as names, with what they need."""
    names: list[str] = []
    for view in views.split():
        for name in _NEEDS.get(view, []) + [view]:
            if name not in names:
                names.append(name)
    parts = [VIEWS_SQL[n] for n in names] + list(ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body
