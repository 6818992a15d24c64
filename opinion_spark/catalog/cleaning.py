"""Cleaning, standardisation, scans and upserts over the dirty review view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.features import BL
from opinion_spark.catalog.registry import query
from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X
from opinion_spark.operators import cleaning as C
from opinion_spark.operators import dedup as D
from opinion_spark.sources import tables as S

AS_OF = "2013-01-01"

STANDARD = """standard AS (
  SELECT Id AS review_id, ProductId AS product_id, UserId AS user_id, Score AS rating,
         "Text" AS review_text, Summary AS review_title, HelpfulnessNumerator AS helpful_votes,
         HelpfulnessDenominator AS total_votes, to_timestamp("Time")::timestamp AS date
  FROM raw_reviews)"""


def standard(spark, sf) -> DataFrame:
    raw = C.standardize_columns(A.raw_reviews(spark, sf), AS_OF)
    return raw.withColumnRenamed("Id", "review_id").drop("timestamp")


def digest(df: DataFrame) -> DataFrame:
    """Texts as md5, to keep results small without leaving any text out."""
    return df.withColumn("review_text", F.md5("review_text"))


STRIP = f"regexp_replace(review_text, '^[{BL}]+|[{BL}]+$', '', 'g')"


@query("standardize_columns", A.sql("raw_reviews", """
SELECT review_id, product_id, user_id, rating, md5(review_text) AS review_text, review_title,
       helpful_votes, total_votes, CAST(date AS DATE) AS date FROM standard""", STANDARD))
def q_standardize(spark, sf):
    return digest(standard(spark, sf)).withColumn("date", F.col("date").cast("date"))


@query("standardize_columns_defaults", A.sql("reviews_core", """
SELECT product_id, rating, 0 AS helpful_votes, 0 AS total_votes, '' AS review_title,
       CAST(review_date AS DATE) AS date FROM reviews_core"""))
def q_standardize_defaults(spark, sf):
    other = A.reviews_core(spark, sf).select(
        F.col("product_id").alias("asin"), F.col("rating").alias("overall"),
        F.date_format("review_date", "MM d, yyyy").alias("reviewTime"))
    return C.standardize_columns(other, AS_OF).drop("reviewTime").withColumn(
        "date", F.col("date").cast("date"))


@query("copy_columns", A.sql("reviews_core", """
SELECT product_id AS asin, product_id, rating AS overall, rating, user_id FROM reviews_core"""))
def q_copy(spark, sf):
    src = A.reviews_core(spark, sf).select(
        F.col("product_id").alias("asin"), F.col("rating").alias("overall"), "user_id")
    return C.copy_columns(src)


@query("resolve_columns", """
SELECT doc_id AS review_id, md5(text) AS review_text FROM documents""")
def q_resolve(spark, sf):
    src = A.read(spark, sf, "documents").select(F.col("doc_id").alias("rowid"), "text")
    return digest(C.resolve_columns(src))


@query("null_drop_counts", A.sql("raw_reviews", """
SELECT count(*) FILTER (product_id IS NULL) AS dropped_product_id,
       count(*) FILTER (product_id IS NOT NULL AND user_id IS NULL) AS dropped_user_id,
       count(*) FILTER (product_id IS NOT NULL AND user_id IS NOT NULL AND rating IS NULL) AS dropped_rating,
       count(*) FILTER (product_id IS NOT NULL AND user_id IS NOT NULL AND rating IS NOT NULL
                        AND review_text IS NULL) AS dropped_review_text,
       count(*) FILTER (product_id IS NOT NULL AND user_id IS NOT NULL AND rating IS NOT NULL
                        AND review_text IS NOT NULL) AS rows_left
FROM standard""", STANDARD))
def q_null_counts(spark, sf):
    return C.null_drop_counts(standard(spark, sf))


@query("drop_null_required", A.sql("raw_reviews", """
SELECT review_id FROM standard WHERE product_id IS NOT NULL AND user_id IS NOT NULL
  AND rating IS NOT NULL AND review_text IS NOT NULL""", STANDARD))
def q_drop_null(spark, sf):
    return C.drop_null_required(standard(spark, sf)).select("review_id")


@query("fill_optional", A.sql("raw_reviews", """
SELECT review_id, coalesce(review_title, '') AS review_title, coalesce(helpful_votes, '0') AS helpful_votes
FROM standard""", STANDARD))
def q_fill(spark, sf):
    return C.fill_optional(standard(spark, sf), AS_OF).select("review_id", "review_title", "helpful_votes")


@query("drop_blank_text", A.sql("raw_reviews", f"SELECT review_id FROM standard WHERE {STRIP} <> ''", STANDARD))
def q_blank(spark, sf):
    return C.drop_blank_text(standard(spark, sf)).select("review_id")


@query("coerce_rating", A.sql("raw_reviews", """
SELECT review_id, CAST(round_even(r, 0) AS INT) AS rating
FROM (SELECT review_id, try_cast(rating AS double) AS r FROM standard) WHERE r BETWEEN 1 AND 5""", STANDARD))
def q_rating(spark, sf):
    return C.coerce_rating(standard(spark, sf)).select("review_id", "rating")


VOTES = """votes AS (
  SELECT review_id, CAST(trunc(coalesce(try_cast(helpful_votes AS double), 0)) AS INT) AS helpful_votes,
         CAST(trunc(coalesce(try_cast(total_votes AS double), 0)) AS INT) AS total_votes FROM standard)"""


@query("coerce_votes", A.sql("raw_reviews", "SELECT * FROM votes", STANDARD, VOTES))
def q_votes(spark, sf):
    return C.coerce_votes(standard(spark, sf)).select("review_id", "helpful_votes", "total_votes")


@query("repair_votes", A.sql("raw_reviews", """
SELECT review_id, helpful_votes, CASE WHEN helpful_votes > total_votes THEN helpful_votes
  ELSE total_votes END AS total_votes FROM votes""", STANDARD, VOTES))
def q_repair(spark, sf):
    return C.repair_votes(C.coerce_votes(standard(spark, sf))).select(
        "review_id", "helpful_votes", "total_votes")


@query("coerce_date", A.sql("raw_reviews", f"""
SELECT review_id, CASE WHEN user_id IS NULL THEN DATE '{AS_OF}' ELSE CAST(date AS DATE) END AS date
FROM standard""", STANDARD))
def q_date(spark, sf):
    text = F.when(F.col("user_id").isNull(), "no date").otherwise(F.col("date").cast("string"))
    return C.coerce_date(standard(spark, sf).withColumn("date", text), AS_OF).select(
        "review_id", F.col("date").cast("date").alias("date"))


# the regex steps after NFKD; accents leave as the marks that NFKD splits off
CLEAN = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    f"regexp_replace(regexp_replace(strip_accents(review_text), '[{BL}]+', ' ', 'g'), '^ | $', '', 'g'), "
    r"'http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+', '', 'g'), "
    r"'\S+@\S+', '', 'g'), '!{2,}', '!', 'g'), '\?{2,}', '?', 'g'), '\.{3,}', '...', 'g'), "
    r"""'[^\p{L}\p{N}_\s.,!?''"-]', '', 'g')""")
EXPAND = "replace(" * len(L.CONTRACTIONS) + "{}" + "".join(
    ", '{}', '{}')".format(a.replace("'", "''"), b) for a, b in L.CONTRACTIONS)
CLEANED_TEXT = EXPAND.format(CLEAN)


@query("clean_text", A.sql("reviews_text", f"""
SELECT review_id, md5({CLEANED_TEXT}) AS review_text FROM reviews_text"""))
def q_clean_text(spark, sf):
    return A.reviews_text(spark, sf).select(
        "review_id", F.md5(X.clean_text(F.col("review_text"))).alias("review_text"))


@query("clean_texts_min_length", A.sql("reviews_text", f"""
SELECT review_id FROM (SELECT review_id, {CLEANED_TEXT} AS c FROM reviews_text) WHERE length(c) >= 10"""))
def q_clean_texts(spark, sf):
    return C.clean_texts(A.reviews_text(spark, sf)).select("review_id")


INLIERS = """inliers AS (
  SELECT r.* FROM reviews_text r, (SELECT quantile_cont(length(review_text), 0.005) AS lo,
    quantile_cont(length(review_text), 0.995) AS hi FROM reviews_text)
  WHERE length(review_text) BETWEEN lo AND hi)"""


@query("drop_length_outliers", A.sql("reviews_text", "SELECT review_id FROM inliers", INLIERS))
def q_outliers(spark, sf):
    return C.drop_length_outliers(A.reviews_text(spark, sf)).select("review_id")


@query("drop_heavy_users", A.sql("reviews_text", """
SELECT review_id FROM inliers WHERE user_id IN (SELECT user_id FROM per_user WHERE n <=
  (SELECT quantile_cont(n, 0.95) FROM per_user))""", INLIERS,
  "per_user AS (SELECT user_id, count(*) AS n FROM inliers GROUP BY user_id)"))
def q_heavy(spark, sf):
    return C.drop_heavy_users(C.drop_length_outliers(A.reviews_text(spark, sf))).select("review_id")


@query("final_types", A.sql("reviews_core", """
SELECT review_id, product_id::varchar AS product_id, user_id::varchar AS user_id, rating,
  'bought ' || product_id AS review_text FROM reviews_core"""))
def q_final(spark, sf):
    src = A.reviews_core(spark, sf).select(
        "review_id", "product_id", "user_id", F.col("rating").cast("double").alias("rating"),
        F.concat(F.lit("bought "), "product_id").alias("review_text"))
    return C.final_types(src)


@query("light_clean", A.sql("raw_reviews", f"""
SELECT review_id, md5(CASE WHEN {STRIP} = 'nan' THEN '' ELSE {STRIP} END) AS review_text,
       CAST(trunc(coalesce(try_cast(rating AS double), 0)) AS INT) AS rating,
       coalesce(user_id, 'nan') AS user_id FROM standard""", STANDARD))
def q_light(spark, sf):
    return digest(C.light_clean(standard(spark, sf))).select("review_id", "review_text", "rating", "user_id")


@query("standardize_scraped", A.sql("reviews_text", f"""
SELECT product_id, user_id, rating, md5({STRIP}) AS review_text,
  regexp_replace(review_title, '^[{BL}]+|[{BL}]+$', '', 'g') AS review_title,
  helpful_votes, helpful_votes AS total_votes
FROM reviews_text WHERE length({STRIP}) > 10"""))
def q_scraped(spark, sf):
    src = A.reviews_text(spark, sf).select(
        F.col("product_id").alias("asin"), F.col("user_id").alias("reviewer"), "rating",
        F.col("review_text").alias("text"), F.col("review_title").alias("title"),
        F.col("helpful_votes").alias("helpful"))
    return digest(C.standardize_scraped(src))


@query("simple_predicates", A.sql("reviews_core", """
SELECT count(*) FILTER (rating >= 4) AS positive, count(*) FILTER (rating <= 2) AS negative,
       count(*) FILTER (helpful_votes > 0) AS with_helpful, count(*) FILTER (total_votes > 0) AS voted
FROM reviews_core"""))
def q_predicates(spark, sf):
    r = A.reviews_core(spark, sf)
    return r.agg(
        F.count_if(F.col("rating") >= 4).alias("positive"), F.count_if(F.col("rating") <= 2).alias("negative"),
        F.count_if(F.col("helpful_votes") > 0).alias("with_helpful"),
        F.count_if(F.col("total_votes") > 0).alias("voted"))


CLEAN_STEPS = [
    STANDARD,
    """d1 AS (SELECT * FROM standard QUALIFY row_number() OVER (
         PARTITION BY product_id, user_id, review_text ORDER BY review_id) = 1)""",
    """d2 AS (SELECT * FROM d1 QUALIFY row_number() OVER (
         PARTITION BY product_id, user_id, length(review_text) ORDER BY review_id) = 1)""",
    f"""typed AS (SELECT review_id, product_id, user_id, CAST(round_even(r, 0) AS INT) AS rating,
         {CLEANED_TEXT} AS review_text, date,
         CAST(trunc(coalesce(try_cast(helpful_votes AS double), 0)) AS INT) AS helpful_votes,
         greatest(CAST(trunc(coalesce(try_cast(helpful_votes AS double), 0)) AS INT),
                  CAST(trunc(coalesce(try_cast(total_votes AS double), 0)) AS INT)) AS total_votes
         FROM (SELECT *, try_cast(rating AS double) AS r FROM d2
               WHERE product_id IS NOT NULL AND user_id IS NOT NULL AND review_text IS NOT NULL
                 AND {STRIP} <> '') WHERE r BETWEEN 1 AND 5)""",
    """sized AS (SELECT t.* FROM typed t, (SELECT quantile_cont(length(review_text), 0.005) AS lo,
         quantile_cont(length(review_text), 0.995) AS hi FROM typed WHERE length(review_text) >= 10)
         WHERE length(review_text) >= 10 AND length(review_text) BETWEEN lo AND hi)""",
    "per_user AS (SELECT user_id, count(*) AS n FROM sized GROUP BY user_id)",
    """cleaned AS (SELECT * FROM sized WHERE user_id IN (SELECT user_id FROM per_user
         WHERE n <= (SELECT quantile_cont(n, 0.95) FROM per_user)))""",
]


@query("clean_reviews", A.sql("raw_reviews", f"""
SELECT review_id, product_id, user_id, rating, md5(review_text) AS review_text, helpful_votes, total_votes,
  CAST(len(regexp_extract_all(review_text, '[^{BL}]+')) AS INT) AS word_count,
  round(rating - avg(rating) OVER (PARTITION BY product_id), 6) AS rating_deviation,
  CAST(year(date) AS INT) AS year FROM cleaned""", *CLEAN_STEPS))
def q_clean(spark, sf):
    done = C.clean_reviews(standard(spark, sf), AS_OF, target=None)
    return digest(done).select(
        "review_id", "product_id", "user_id", "rating", "review_text", "helpful_votes", "total_votes",
        "word_count", F.round("rating_deviation", 6).alias("rating_deviation"), "year")


@query("cleaning_summary", A.sql("raw_reviews", """
SELECT (SELECT count(*) FROM standard) AS original_rows, count(*) AS final_rows,
  count(*) / (SELECT count(*) FROM standard) AS retention_rate,
  (count(*) - (count(*) - count(DISTINCT (product_id, user_id, review_text))))
    / (SELECT count(*) FROM standard) AS quality_score
FROM cleaned""", *CLEAN_STEPS))
def q_summary(spark, sf):
    raw = standard(spark, sf)
    return C.cleaning_summary(raw, C.clean_reviews(raw, AS_OF, target=None))


# ---- scans, evolution, upserts -------------------------------------------
@query("scan_with_predicate", A.sql("reviews_text", """
SELECT review_id, product_id, rating FROM reviews_text
WHERE review_text IS NOT NULL AND length(review_text) > 200 ORDER BY review_id"""))
def q_scan(spark, sf):
    return S.scan(A.reviews_text(spark, sf), ["review_id", "product_id", "rating"], "review_text", 200, "review_id")


@query("scan_by_ids", A.sql("reviews_text", """
SELECT review_id, md5(review_text) AS review_text FROM reviews_text
WHERE review_id IN (SELECT doc_id FROM labels)"""))
def q_ids(spark, sf):
    ids = A.read(spark, sf, "labels").select(F.col("doc_id").alias("review_id"))
    return digest(S.scan_by_ids(A.reviews_text(spark, sf).select("review_id", "review_text"), ids))


@query("scan_first_by_id", A.sql("reviews_text", """
SELECT review_id, rating FROM reviews_text ORDER BY review_id LIMIT 500"""))
def q_first(spark, sf):
    return S.first_by_id(A.reviews_text(spark, sf).select("review_id", "rating"), 500)


@query("add_missing_columns", A.sql("reviews_core", """
SELECT review_id, rating, false AS verified_purchase, CAST('live' AS varchar) AS source FROM reviews_core"""))
def q_evolve(spark, sf):
    return C.add_missing_columns(
        A.reviews_core(spark, sf).select("review_id", "rating"),
        {"rating": ("int", 0), "verified_purchase": ("boolean", False), "source": ("string", "live")})


@query("upsert_by_key", A.sql("reviews_core", """
SELECT product_id, user_id, review_id, rating FROM reviews_core
QUALIFY row_number() OVER (PARTITION BY product_id, user_id ORDER BY review_date DESC, review_id DESC) = 1"""))
def q_upsert(spark, sf):
    r = A.reviews_core(spark, sf).select("product_id", "user_id", "review_id", "rating", "review_date")
    old = r.where(F.col("review_date") < "1998-01-01")
    new = r.where(F.col("review_date") >= "1998-01-01")
    return S.upsert(old, new, ["product_id", "user_id"], [F.desc("review_date"), F.desc("review_id")]).drop(
        "review_date")


@query("insert_if_absent", A.sql("reviews_core", """
SELECT product_id, user_id, count(*) AS n FROM reviews_core n
WHERE review_date >= TIMESTAMP '1998-01-01' AND NOT EXISTS (
  SELECT 1 FROM reviews_core o WHERE o.review_date < TIMESTAMP '1998-01-01'
   AND o.product_id = n.product_id AND o.user_id = n.user_id)
GROUP BY product_id, user_id"""))
def q_insert(spark, sf):
    r = A.reviews_core(spark, sf).select("product_id", "user_id", "review_date")
    old = r.where(F.col("review_date") < "1998-01-01")
    new = r.where(F.col("review_date") >= "1998-01-01")
    return S.absent_rows(old, new, ["product_id", "user_id"]).groupBy("product_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("replace_user_rows", A.sql("reviews_core", """
SELECT user_id, count(*) AS n, CAST(sum(rating) AS BIGINT) AS stars FROM reviews_core r
WHERE review_date >= TIMESTAMP '2000-01-01' OR user_id NOT IN (
  SELECT user_id FROM reviews_core WHERE review_date >= TIMESTAMP '2000-01-01')
GROUP BY user_id"""))
def q_replace(spark, sf):
    r = A.reviews_core(spark, sf).select("user_id", "rating", "review_date")
    old = r.where(F.col("review_date") < "2000-01-01")
    new = r.where(F.col("review_date") >= "2000-01-01")
    return S.replace_rows(old, new, "user_id").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"))


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in
    ("lineitem", "orders", "documents", "events")) + " UNION ALL SELECT 'absent', 0")
def q_counts(spark, sf):
    names = ["lineitem", "orders", "documents", "events", "absent"]
    return S.table_counts(spark, {n: f"{sf}/{n}.parquet" for n in names})


@query("table_profile")
def q_profile(spark, sf):
    return S.table_profile({n: A.read(spark, sf, n) for n in ("documents", "orders", "labels")})


@query("report_scan", """
SELECT conv_id, turn, role FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 3""")
def q_reports(spark, sf):
    """JSON documents, newest three, with nested fields picked out."""
    rows = A.read(spark, sf, "conversations")
    docs = rows.select(F.to_json(F.struct("conv_id", F.struct("turn", "role").alias("step"))).alias("doc"))
    return S.newest_reports(docs, "doc", "conv_id long, step struct<turn: long, role: string>",
                            ["conv_id", "step.turn"], {"conv_id": "conv_id", "turn": "step.turn", "role": "step.role"})


# ---- duplicates, samples, top-k, set operations --------------------------
@query("dedup_exact", A.sql("reviews_text", """
SELECT review_id FROM reviews_text QUALIFY row_number() OVER (
  PARTITION BY product_id, user_id, review_text ORDER BY review_id) = 1"""))
def q_dedup(spark, sf):
    return D.drop_exact(A.reviews_text(spark, sf).select(
        "review_id", "product_id", "user_id", "review_text")).select("review_id")


@query("dedup_near", A.sql("reviews_text", """
SELECT review_id FROM reviews_text QUALIFY row_number() OVER (
  PARTITION BY product_id, user_id, length(review_text) ORDER BY review_id) = 1"""))
def q_near(spark, sf):
    return D.drop_near(A.reviews_text(spark, sf)).select("review_id")


@query("duplicate_rows", A.sql("reviews_text", """
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT product_id, user_id, rating, review_text, date
  FROM reviews_text)) AS duplicate_rows FROM reviews_text"""))
def q_dup_rows(spark, sf):
    return D.duplicate_rows(A.reviews_text(spark, sf).select(
        "product_id", "user_id", "rating", "review_text", "date"))


@query("sample_proportional", A.sql("reviews_core", """
SELECT review_id, rating FROM (SELECT review_id, rating,
    row_number() OVER (PARTITION BY rating ORDER BY md5(review_id), review_id) AS rn,
    count(*) OVER (PARTITION BY rating) AS n, count(*) OVER () AS total FROM reviews_core)
WHERE rn <= greatest(1, floor(2000 * n / total))"""))
def q_stratified(spark, sf):
    return D.proportional_sample(A.reviews_core(spark, sf).select("review_id", "rating"), 2000)


@query("sample_uniform", A.sql("reviews_core", """
SELECT review_id, product_id FROM reviews_core ORDER BY md5(review_id || 's1'), review_id LIMIT 1500"""))
def q_uniform(spark, sf):
    return D.uniform_sample(A.reviews_core(spark, sf).select("review_id", "product_id"), 1500, seed="s1")


@query("shuffle_rows")
def q_shuffle(spark, sf):
    return D.shuffled(A.reviews_core(spark, sf).select("review_id", "rating"))


@query("split_plain")
def q_split(spark, sf):
    return D.split_plain(A.reviews_core(spark, sf).select("review_id", "rating"), 0.2).groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"))


@query("split_stratified", A.sql("reviews_text fake_labels", """
SELECT review_id, is_fake, row_number() OVER (PARTITION BY is_fake
  ORDER BY md5(review_id || 'split'), review_id) <= round(0.2 * count(*) OVER (PARTITION BY is_fake)) AS is_test
FROM fake_labels"""))
def q_split_strat(spark, sf):
    return D.split_stratified(A.fake_labels(spark, sf).select("review_id", "is_fake"), 0.2, "is_fake")


@query("top_products_by_count", A.sql("reviews_core", """
SELECT product_id, count(*) AS review_count, avg(rating) AS avg_rating FROM reviews_core
GROUP BY product_id HAVING count(*) >= 5
ORDER BY review_count DESC, avg_rating DESC, product_id LIMIT 50"""))
def q_top_groups(spark, sf):
    return D.top_groups(A.reviews_core(spark, sf), "product_id", 5, 50)


@query("most_reviewed_products", A.sql("reviews_text", """
SELECT product_id, count(*) AS n FROM reviews_text GROUP BY product_id ORDER BY n DESC, product_id LIMIT 5"""))
def q_most(spark, sf):
    return D.most_frequent(A.reviews_text(spark, sf), "product_id", 5)


@query("top_items_per_user", A.sql("reviews_core", """
SELECT user_id, product_id, score FROM (SELECT user_id, product_id, avg(rating) AS score
  FROM reviews_core GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) <= 5"""))
def q_topn(spark, sf):
    scored = A.reviews_core(spark, sf).groupBy("user_id", "product_id").agg(F.avg("rating").alias("score"))
    return D.top_n(scored, "user_id", "score", "product_id", 5)


@query("latest_batch", A.sql("metric_stream", """
SELECT event_id, component FROM metric_stream WHERE component =
  (SELECT component FROM metric_stream ORDER BY ts DESC, component DESC LIMIT 1)"""))
def q_latest(spark, sf):
    return D.latest_batch(A.metric_stream(spark, sf), "component", "ts").select("event_id", "component")


@query("last_rows_by_time", A.sql("metric_stream", """
SELECT event_id, metric_name FROM metric_stream ORDER BY ts DESC, event_id DESC LIMIT 100"""))
def q_last(spark, sf):
    return D.last_rows(A.metric_stream(spark, sf), "ts", "event_id", 100).select("event_id", "metric_name")


@query("union_labelled", A.sql("reviews_text reviews_core", """
SELECT 'text' AS source, lang, rating, count(*) AS n FROM reviews_text GROUP BY ALL
UNION ALL SELECT 'core', NULL, rating, count(*) FROM reviews_core GROUP BY ALL"""))
def q_union(spark, sf):
    both = D.union_labelled({
        "text": A.reviews_text(spark, sf).select("rating", "lang"),
        "core": A.reviews_core(spark, sf).select("rating")})
    return both.groupBy("source", "lang", "rating").agg(F.count(F.lit(1)).alias("n"))


@query("aligned_category_counts", A.sql("text_sides", """
SELECT product_id, count(*) FILTER (side = 'baseline') AS n_baseline,
       count(*) FILTER (side = 'comparison') AS n_comparison FROM text_sides GROUP BY product_id"""))
def q_aligned(spark, sf):
    return D.aligned_counts(A.text_sides(spark, sf), "product_id", "side", "baseline", "comparison")


@query("surrogate_ids", A.sql("reviews_core", """
SELECT review_id, row_number() OVER (ORDER BY review_date, md5(review_id), review_id) + 100000 AS surrogate_id
FROM reviews_core"""))
def q_surrogate(spark, sf):
    return D.surrogate_id(A.reviews_core(spark, sf).select("review_id", "review_date"), "review_date", "review_id").select(
        "review_id", "surrogate_id")
