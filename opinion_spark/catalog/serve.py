"""Alert and recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinion_spark import adapters as A
from opinion_spark.catalog.registry import query
from opinion_spark.functions import lexicons as L
from opinion_spark.operators import aggregates as G
from opinion_spark.operators import alerts as X
from opinion_spark.operators import evaluate as E
from opinion_spark.operators import recommend as R
from opinion_spark.operators import similarity as M
from opinion_spark.session import materialize

CORE = A.reviews_core

RAISED = """raised AS (
  SELECT event_id, 'system_threshold' AS alert_type, CASE WHEN v > t + 10 THEN 'high' ELSE 'medium' END AS severity,
    name AS component, label || ' is ' || printf('%.1f', v) || '% (threshold: ' || printf('%.1f', t) || '%)' AS message,
    v AS metric_value, t AS threshold, ts
  FROM (SELECT event_id, ts, metric_value AS v, metric_name AS name FROM metric_stream) JOIN (VALUES
    ('cpu_usage', 85.0::double, 'Cpu Usage'), ('memory_usage', 85.0, 'Memory Usage'), ('disk_usage', 90.0, 'Disk Usage'))
    th(name, t, label) USING (name) WHERE v > t
  UNION ALL
  SELECT event_id, 'model_performance', CASE WHEN metric_value > 0.5 THEN 'medium' ELSE 'high' END, component,
    component || ' accuracy dropped to ' || printf('%.1f', metric_value * 100) || '% (threshold: 70%)',
    metric_value, 0.7, ts FROM metric_stream WHERE metric_name = 'accuracy' AND metric_value < 0.7
  UNION ALL
  SELECT event_id, 'health_check', CASE WHEN status = 'critical' THEN 'critical' ELSE 'medium' END, component,
    component || ' health check ' || status || ': Unknown issue', metric_value, NULL, ts
  FROM metric_stream WHERE metric_name = 'health' AND status IN ('warning', 'critical'))"""
# the fold, one alert per step: state is the time of the last alert that passed
COOLED = """seq AS (SELECT *, row_number() OVER (PARTITION BY alert_type, component ORDER BY ts, event_id) AS rn,
    CASE alert_type WHEN 'model_performance' THEN 30 WHEN 'health_check' THEN 10 ELSE 15 END AS minutes FROM raised),
fold AS (
  SELECT event_id, alert_type, component, rn, ts AS last_ts, true AS pass FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.event_id, s.alert_type, s.component, s.rn,
    CASE WHEN s.ts - f.last_ts >= to_minutes(s.minutes) THEN s.ts ELSE f.last_ts END,
    s.ts - f.last_ts >= to_minutes(s.minutes)
  FROM fold f JOIN seq s ON s.alert_type = f.alert_type AND s.component = f.component AND s.rn = f.rn + 1),
cooled AS (SELECT r.* FROM raised r JOIN fold USING (event_id, alert_type) WHERE pass)"""
GATED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY ts, event_id) AS rn,
    CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END AS sev FROM cooled),
gate AS (
  SELECT event_id, component, rn, alert_type AS act, sev AS asev, true AS pass FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.event_id, r.component, r.rn,
    CASE WHEN r.sev > g.asev OR r.alert_type <> g.act THEN r.alert_type ELSE g.act END,
    CASE WHEN r.sev > g.asev OR r.alert_type <> g.act THEN r.sev ELSE g.asev END,
    r.sev > g.asev OR r.alert_type <> g.act
  FROM gate g JOIN ranked r ON r.component = g.component AND r.rn = g.rn + 1),
gated AS (SELECT c.* FROM ranked c JOIN gate USING (event_id, component, rn) WHERE pass)"""


def metrics(spark, sf):
    return A.metric_stream(spark, sf)


def asql(body, *ctes):
    return A.sql("metric_stream", body, RAISED, *ctes, recursive=True)


@query("system_alerts", asql("""
SELECT event_id, alert_type, severity, component, message, metric_value, threshold,
  alert_type || '_' || component || '_' || CAST(floor(epoch(ts)) AS BIGINT) AS alert_id
FROM raised WHERE alert_type = 'system_threshold'"""))
def q_system(spark, sf):
    return X.system_alerts(metrics(spark, sf)).drop("ts")


@query("model_alerts", asql("""
SELECT event_id, severity, component, message, metric_value, threshold FROM raised WHERE alert_type = 'model_performance'"""))
def q_model(spark, sf):
    return X.model_alerts(metrics(spark, sf)).drop("ts", "alert_id", "alert_type")


@query("health_alerts", asql("""
SELECT event_id, severity, component, message FROM raised WHERE alert_type = 'health_check'"""))
def q_health(spark, sf):
    return X.health_alerts(metrics(spark, sf)).select("event_id", "severity", "component", "message")


@query("health_status", A.sql("metric_stream", """
SELECT event_id, CASE WHEN metric_value > 95 THEN 'critical' WHEN metric_value < 85 THEN 'healthy' ELSE 'warning' END
  AS health FROM metric_stream WHERE metric_name IN ('cpu_usage', 'memory_usage')"""))
def q_status(spark, sf):
    return metrics(spark, sf).where(F.col("metric_name").isin("cpu_usage", "memory_usage")).select(
        "event_id", X.health_status(F.col("metric_value"), 85.0).alias("health"))


@query("component_health", A.sql("metric_stream", """
SELECT event_id, kind, CASE WHEN metric_name = 'health' AND status = 'critical' THEN 'critical'
    WHEN kind IN ('cpu_usage', 'memory_usage') THEN CASE WHEN value > 95 THEN 'critical' WHEN value < 85 THEN 'healthy' ELSE 'warning' END
    WHEN kind = 'disk_usage' THEN CASE WHEN value > 98 THEN 'critical' WHEN value < 90 THEN 'healthy' ELSE 'warning' END
    WHEN kind = 'response_time' THEN CASE WHEN value < 1.0 THEN 'healthy' ELSE 'warning' END
    ELSE CASE WHEN value > 0.5 THEN 'healthy' ELSE 'warning' END END AS status
FROM (SELECT *, CASE metric_name WHEN 'health' THEN 'response_time' WHEN 'accuracy' THEN 'confidence' ELSE metric_name END AS kind,
    CASE metric_name WHEN 'health' THEN metric_value / 50 ELSE metric_value END AS value FROM metric_stream)"""))
def q_component_health(spark, sf):
    """Every row as a health check: health rows as the database's response time, accuracy as a model's confidence."""
    name, value = F.col("metric_name"), F.col("metric_value")
    checks = metrics(spark, sf).select(
        "event_id", "component", F.when(name == "health", "response_time").when(name == "accuracy", "confidence").otherwise(name).alias("kind"),
        F.when(name == "health", value / 50).otherwise(value).alias("value"),
        ((name == "health") & (F.col("status") == "critical")).alias("failed"))
    return X.checked_health(checks).select("event_id", "kind", "status")


@query("alert_cooldown", asql("SELECT event_id, alert_type, component FROM cooled", COOLED))
def q_cooldown(spark, sf):
    return X.after_cooldown(X.raised_alerts(metrics(spark, sf))).select("event_id", "alert_type", "component")


@query("alert_gate", asql("SELECT event_id, alert_type, component, severity FROM gated", COOLED, GATED))
def q_gate(spark, sf):
    return X.filtered_alerts(metrics(spark, sf)).select("event_id", "alert_type", "component", "severity")


@query("alert_statistics", asql("""
SELECT 'severity' AS kind, severity AS name, count(*) AS n FROM raised GROUP BY 2
UNION ALL SELECT 'type', alert_type, count(*) FROM raised GROUP BY 2
UNION ALL SELECT 'all', 'total', count(*) FROM raised
UNION ALL SELECT 'all', 'resolved', count(*) FILTER (severity = 'medium') FROM raised
UNION ALL SELECT 'all', 'active', count(*) FILTER (severity <> 'medium') FROM raised
UNION ALL SELECT 'all', 'last_24h', count(*) FILTER (ts > TIMESTAMP '2024-01-29 00:00:00') FROM raised"""))
def q_statistics(spark, sf):
    alerts = X.raised_alerts(metrics(spark, sf)).withColumn("resolved", F.col("severity") == "medium")
    return G.alert_statistics(alerts, F.lit("2024-01-30").cast("timestamp"))


@query("alert_escalation", asql("""
SELECT event_id, alert_type, severity <> 'medium' AND TIMESTAMP '2024-01-15 12:00:00' - ts > to_minutes(CASE alert_type
  WHEN 'model_performance' THEN 120 WHEN 'health_check' THEN 30 ELSE 60 END) AS escalated FROM raised"""))
def q_escalate(spark, sf):
    alerts = X.raised_alerts(metrics(spark, sf)).withColumns({
        "resolved": F.col("severity") == "medium", "escalated": F.lit(False)})
    return X.escalate(alerts, F.lit("2024-01-15 12:00:00").cast("timestamp")).select(
        "event_id", "alert_type", "escalated")


@query("alert_resolution", asql("""
SELECT alert_id, bool_or(event_id % 3 = 0) AS resolved FROM (SELECT alert_type || '_' || component || '_'
  || CAST(floor(epoch(ts)) AS BIGINT) AS alert_id, event_id FROM raised) GROUP BY alert_id"""))
def q_resolve(spark, sf):
    alerts = X.raised_alerts(metrics(spark, sf)).withColumn("resolved", F.lit(False))
    notes = alerts.where("event_id % 3 = 0").select(
        "alert_id", F.lit("checked").alias("notes"), F.col("ts").alias("resolved_at"))
    return X.resolve(alerts, notes).groupBy("alert_id").agg(F.bool_or("resolved").alias("resolved"))


@query("alert_notifications", asql("""
SELECT event_id, channel, severity FROM raised JOIN (VALUES ('console', 'medium'), ('console', 'high'), ('console', 'critical'),
  ('log', 'low'), ('log', 'medium'), ('log', 'high'), ('log', 'critical')) c(channel, severity) USING (severity)"""))
def q_notify(spark, sf):
    return X.notifications(X.raised_alerts(metrics(spark, sf))).drop("alert_id")


@query("dashboard_alerts", A.sql("metric_stream", """
SELECT event_id AS source_id, 'drift' AS alert_type, 'HIGH' AS level FROM metric_stream WHERE status = 'critical'
UNION ALL SELECT event_id, 'accuracy', 'MEDIUM' FROM metric_stream WHERE metric_name = 'accuracy' AND metric_value < 0.8"""))
def q_dashboard(spark, sf):
    m = metrics(spark, sf)
    return X.dashboard_alerts(
        m.select(F.col("event_id").alias("source_id"),
                 F.when(F.col("status") == "critical", "HIGH").otherwise("LOW").alias("severity")),
        m.where("metric_name = 'accuracy'").select(
            F.col("event_id").alias("source_id"), F.col("metric_value").alias("accuracy")))


@query("recent_metrics", A.sql("metric_stream", """
SELECT epoch(time_bucket(INTERVAL '1 hour', ts))::bigint AS window_start, metric_name, count(*) AS n,
  round(avg(metric_value), 6) AS avg_value, round(min(metric_value), 6) AS min_value, round(max(metric_value), 6) AS max_value
FROM metric_stream GROUP BY 1, 2"""))
def q_recent(spark, sf):
    out = X.recent_metrics(metrics(spark, sf)).withColumn("window_start", F.unix_timestamp("window_start"))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_value", "min_value", "max_value")})


@query("cycle_summary", asql("""
SELECT count(*) FILTER (metric_name <> 'health') AS metrics_collected, count(*) FILTER (metric_name = 'health') AS health_checks,
  (SELECT count(*) FROM raised) AS alerts_raised FROM metric_stream"""))
def q_cycle(spark, sf):
    m = metrics(spark, sf)
    return X.cycle_summary(m, X.raised_alerts(m))


# ---- recommendations -------------------------------------------------------
UI = "ui AS (SELECT user_id, product_id, avg(rating) AS rating FROM reviews_core GROUP BY ALL)"
UU = """w AS (SELECT user_id, product_id, rating / sqrt(sum(rating * rating) OVER (PARTITION BY user_id)) AS w FROM ui),
usim AS (SELECT a.user_id, b.user_id AS other, round(sum(a.w * b.w), 9) AS sim FROM w a JOIN w b USING (product_id)
  WHERE a.user_id <> b.user_id GROUP BY 1, 2 HAVING round(sum(a.w * b.w), 9) >= 0.1),
unear AS (SELECT * FROM usim QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, other) <= 19)"""
II = """unit AS (SELECT product_id, list_transform(vector, lambda x: x / sqrt(list_dot_product(vector, vector))) AS v
  FROM item_vectors),
isim AS (SELECT a.product_id, b.product_id AS other, round(list_dot_product(a.v, b.v), 9) AS sim FROM unit a, unit b),
inear AS (SELECT * FROM isim QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY sim DESC, other) <= 20)"""


def best(scored: str, n: int = 10) -> str:
    return f"""SELECT user_id, product_id, ws / ss AS predicted_rating, least(ss, 1.0) AS confidence FROM {scored}
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(ws / ss, 9) DESC, product_id) <= {n}"""


USER_RECS = """urec0 AS (SELECT n.user_id, r.product_id, sum(r.rating * sim) AS ws, sum(sim) AS ss
  FROM unear n JOIN ui r ON r.user_id = n.other
  WHERE NOT EXISTS (SELECT 1 FROM ui s WHERE s.user_id = n.user_id AND s.product_id = r.product_id) GROUP BY 1, 2)"""
ITEM_RECS = """irec0 AS (SELECT r.user_id, n.other AS product_id, sum(r.rating * sim) AS ws, sum(sim) AS ss
  FROM ui r JOIN inear n USING (product_id) WHERE sim > 0.1 AND n.other <> n.product_id
    AND NOT EXISTS (SELECT 1 FROM ui s WHERE s.user_id = r.user_id AND s.product_id = n.other) GROUP BY 1, 2)"""
POP = """pop AS (SELECT product_id, avg(rating) AS predicted_rating, least(count(*) / 100, 1.0) AS confidence FROM reviews_core
  GROUP BY 1 HAVING count(*) >= 5 ORDER BY round(count(*) / (count(*) + 5.0) * avg(rating) + 5.0 / (count(*) + 5.0) * 3.5, 9)
  DESC, product_id LIMIT 10)"""
CONTENT = """crec AS (SELECT user_id, product_id, least(m.a, 5.0) AS predicted_rating, least(score, 1.0) AS confidence FROM (
    SELECT r.user_id, s.other AS product_id, sum(sim) AS score FROM ui r JOIN isim s USING (product_id)
    WHERE r.rating >= 4 AND sim > 0.1 AND s.other <> s.product_id AND NOT EXISTS (
      SELECT 1 FROM ui x WHERE x.user_id = r.user_id AND x.product_id = s.other) GROUP BY 1, 2)
  JOIN (SELECT product_id, avg(rating) AS a FROM reviews_core GROUP BY 1) m USING (product_id)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(least(score, 1.0), 9) DESC, product_id) <= {n}),
crec_all AS (SELECT * FROM crec UNION ALL
  SELECT user_id, pop.* FROM (SELECT user_id FROM ui GROUP BY 1 HAVING max(rating) < 4), pop)"""


def ratings(spark, sf):
    return R.user_item_ratings(CORE(spark, sf))


def rsql(views, body, *ctes):
    return A.sql(views, body, UI, *ctes)


def shorten(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def fin(body: str) -> str:
    return f"SELECT user_id, product_id, round(predicted_rating, 6) AS predicted_rating, round(confidence, 6) AS confidence FROM ({body})"


@query("user_item_ratings", rsql("reviews_core", "SELECT user_id, product_id, rating FROM ui"))
def q_ui(spark, sf):
    return ratings(spark, sf)


@query("user_neighbours", rsql("reviews_core", "SELECT user_id, other, round(sim, 6) AS sim FROM unear", UU))
def q_un(spark, sf):
    return shorten(R.user_neighbours(ratings(spark, sf)), "sim")


@query("user_neighbours_hot_items", rsql("reviews_core", "SELECT user_id, other, round(sim, 6) AS sim FROM unear", UU))
def q_un_hot(spark, sf):
    """The same neighbours with most items treated as hot: the block path."""
    return shorten(R.user_neighbours(ratings(spark, sf), hot_degree=32, per_block=400), "sim")


@query("item_neighbours", A.sql("item_vectors", "SELECT product_id, other, round(sim, 6) AS sim FROM inear", II))
def q_in(spark, sf):
    return shorten(R.item_neighbours(A.item_vectors(spark, sf)), "sim")


@query("recommend_user_based", rsql("reviews_core", fin(best("urec0")), UU, USER_RECS))
def q_user(spark, sf):
    r = materialize(ratings(spark, sf))
    return shorten(R.user_based(r, R.user_neighbours(r)), "predicted_rating", "confidence")


@query("recommend_item_based", rsql("reviews_core item_vectors", fin(best("irec0")), II, ITEM_RECS))
def q_item(spark, sf):
    r = ratings(spark, sf)
    return shorten(R.item_based(r, R.item_neighbours(A.item_vectors(spark, sf))), "predicted_rating", "confidence")


@query("recommend_content_based", rsql("reviews_core item_vectors", fin("SELECT * FROM crec_all"), II, POP, CONTENT.format(n=10)))
def q_content(spark, sf):
    similar = R.similar_items(A.item_vectors(spark, sf))
    c = R.content_based(ratings(spark, sf), similar, CORE(spark, sf))
    return shorten(c, "predicted_rating", "confidence")


@query("recommend_popular", A.sql("reviews_core", "SELECT product_id, round(predicted_rating, 6) AS predicted_rating, confidence FROM pop", POP))
def q_pop(spark, sf):
    return shorten(R.popular(CORE(spark, sf)), "predicted_rating")


@query("recommend_factorization")
def q_als(spark, sf):
    return R.matrix_factorization(ratings(spark, sf))


def blended(spark, sf, n=10, factorize=False):
    """All methods that have an exact SQL twin, blended; on request with ALS as well."""
    reviews = CORE(spark, sf)
    r = materialize(R.user_item_ratings(reviews))
    near, similar = R.item_tables(A.item_vectors(spark, sf))
    methods = {
        "user_based": R.user_based(r, R.user_neighbours(r), 2 * n),
        "item_based": R.item_based(r, near, 2 * n),
        "content_based": R.content_based(r, similar, reviews, 2 * n),
        "popular": R.popular_for(r.select("user_id").distinct(), R.popular(reviews, n)),
    }
    if factorize:
        methods["matrix_factorization"] = R.matrix_factorization(r, 2 * n)
    return R.hybrid(methods, n, neighbours=near)


@query("recommend_hybrid_all_methods")
def q_hybrid_all(spark, sf):
    return blended(spark, sf, factorize=True)


HYBRID = f"""blend AS (SELECT user_id, product_id, sum(predicted_rating * wt) / sum(wt) AS predicted_rating,
    avg(confidence) AS confidence, string_agg(method, ', ' ORDER BY method) AS methods FROM (
  SELECT *, 'user_based' AS method, 0.3 AS wt FROM ({best("urec0", 20)})
  UNION ALL SELECT *, 'item_based', 0.3 FROM ({best("irec0", 20)})
  UNION ALL SELECT *, 'content_based', 0.1 FROM crec_all
  UNION ALL SELECT user_id, pop.*, 'popular', 0.05 FROM (SELECT DISTINCT user_id FROM ui), pop) GROUP BY 1, 2),
hyb AS (SELECT *, predicted_rating * confidence AS score FROM blend QUALIFY row_number() OVER (
  PARTITION BY user_id ORDER BY round(predicted_rating * confidence, 9) DESC, product_id) <= 10)"""
POP20 = POP.replace("pop AS", "pop20 AS").replace("LIMIT 10", "LIMIT 20")
CONTENT20 = CONTENT.format(n=20).replace("user_id, pop.*", "user_id, pop20.*").replace("< 4), pop)", "< 4), pop20)")


@query("recommend_hybrid", rsql("reviews_core item_vectors", """
SELECT user_id, h.product_id, round(predicted_rating, 6) AS predicted_rating, round(confidence, 6) AS confidence,
  round(score, 6) AS recommendation_score, 'Recommended by ' || methods AS reason,
  coalesce((SELECT string_agg(other, ',' ORDER BY sim DESC, other) FROM (SELECT * FROM inear n
    WHERE n.product_id = h.product_id AND n.other <> n.product_id ORDER BY sim DESC, other LIMIT 3)), '') AS similar_products
FROM hyb h""", UU, II, USER_RECS, ITEM_RECS, POP, POP20, CONTENT20, HYBRID))
def q_hybrid(spark, sf):
    out = shorten(blended(spark, sf), "predicted_rating", "confidence", "recommendation_score")
    return out.withColumn("similar_products", F.array_join(F.col("similar_products").cast("array<string>"), ","))


def stored(spark, sf):
    """Stored recommendations of the users of one nation group."""
    r = ratings(spark, sf)
    some = A.read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return r.join(some, "user_id", "left_semi").select(
        "user_id", "product_id", F.col("rating").alias("predicted_rating"), F.lit(0.5).alias("confidence"),
        (F.col("rating") * 0.5).alias("recommendation_score"))


BEST_RATED = """best AS (SELECT product_id, avg(rating) AS average_rating FROM reviews_core GROUP BY product_id
  HAVING count(*) >= 5 ORDER BY avg(rating) DESC, count(*) DESC, product_id LIMIT 10)"""
STORED = """stored AS (SELECT user_id, product_id, rating AS predicted_rating, 0.5 AS confidence, rating * 0.5 AS score FROM ui
  WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))"""


@query("recommend_stored_or_popular", rsql("reviews_core", """
SELECT user_id, product_id, round(predicted_rating, 6) AS predicted_rating, confidence::double AS confidence, 'stored' AS kind
FROM stored QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, product_id) <= 10
UNION ALL SELECT c_custkey, product_id, round(average_rating, 6), 0.5::double, 'popular_fallback' FROM customer, best
WHERE c_custkey NOT IN (SELECT user_id FROM stored)""", BEST_RATED, STORED))
def q_served(spark, sf):
    wanted = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return shorten(R.served(wanted, stored(spark, sf), G.popular_fallback(CORE(spark, sf))), "predicted_rating")


@query("recommend_cold_start", rsql("reviews_core", """
SELECT wanted.user_id, product_id, round(predicted_rating, 6) AS predicted_rating, confidence FROM (
  SELECT c_custkey AS user_id FROM customer UNION ALL SELECT s_suppkey + 100000000 FROM supplier) wanted, pop
WHERE user_id NOT IN (SELECT user_id FROM ui)""", POP))
def q_cold(spark, sf):
    """Customers and suppliers ask; those without any rating get the popular list."""
    wanted = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")).unionAll(
        A.read(spark, sf, "supplier").select(F.col("s_suppkey") + 100_000_000))
    cold = wanted.join(ratings(spark, sf).select("user_id").distinct(), "user_id", "left_anti")
    return shorten(R.popular_for(cold, R.popular(CORE(spark, sf))), "predicted_rating")


@query("unseen_items", rsql("reviews_core", """
SELECT i.user_id, count(*) AS n FROM (SELECT user_id, other FROM ui JOIN inear USING (product_id) GROUP BY ALL) i
WHERE NOT EXISTS (SELECT 1 FROM ui s WHERE s.user_id = i.user_id AND s.product_id = i.other) GROUP BY 1""",
    A.VIEWS_SQL["item_vectors"], II))
def q_unseen(spark, sf):
    from opinion_spark.operators.dedup import without_seen
    r = ratings(spark, sf)
    near = R.item_neighbours(A.item_vectors(spark, sf)).select("product_id", "other")
    candidates = r.join(near, "product_id").select("user_id", F.col("other").alias("product_id")).distinct()
    return without_seen(candidates, r, ["user_id", "product_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("recommendation_quality", rsql("reviews_core", """
SELECT count(*) AS n, round(avg(predicted_rating), 6) AS avg_predicted, round(avg(confidence), 6) AS avg_confidence,
  round(avg(score), 6) AS avg_score, CASE WHEN avg(predicted_rating) >= 4 AND avg(confidence) >= 0.7 THEN 'Excellent'
   WHEN avg(predicted_rating) >= 3.5 AND avg(confidence) >= 0.5 THEN 'Good' ELSE 'Mixed' END AS grade FROM stored""", STORED))
def q_quality(spark, sf):
    return shorten(G.recommendation_quality(stored(spark, sf)), "avg_predicted", "avg_confidence", "avg_score")


@query("recommender_evaluation", rsql("reviews_core", """
SELECT count(*) AS users, count(n) AS served, count(n) / count(*) AS success_rate, sum(n) / count(n) AS recs_per_user,
  round(sum(p) / sum(n), 6) AS avg_predicted, 0.5::double AS avg_confidence, 1.0::double AS avg_diversity,
  round(2 * 0.5 * (count(n) / count(*)) / (0.5 + count(n) / count(*)), 6) AS pseudo_f1
FROM customer LEFT JOIN (SELECT user_id, count(*) AS n, sum(predicted_rating) AS p FROM stored GROUP BY 1) s
  ON c_custkey = user_id""", STORED))
def q_eval(spark, sf):
    wanted = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return shorten(E.recommender_scores(wanted, stored(spark, sf)), "avg_predicted", "pseudo_f1")


TEXT_FEATURES = [f"""grams AS (
  SELECT product_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
  FROM (SELECT product_id, list_filter(regexp_extract_all(lower(review_text), '[\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}]{{2,}}'),
          lambda x: NOT list_contains([{", ".join(f"'{w}'" for w in L.STOP_WORDS)}], x)) AS w FROM reviews_text))""", """
vocabulary AS (
  SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS position FROM grams GROUP BY term
  QUALIFY position < 1000)""", """
tf AS (SELECT product_id, position, count(*) AS tf FROM grams JOIN vocabulary USING (term) GROUP BY ALL)""", """
idf AS (
  SELECT position, ln((1 + (SELECT count(DISTINCT product_id) FROM reviews_text)) / (1 + count(*))) + 1 AS idf
  FROM tf GROUP BY position)""", """
text_weights AS (
  SELECT product_id, position, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY product_id)) AS weight
  FROM tf JOIN idf USING (position))""", """
item_numbers AS (
  SELECT product_id, avg(rating) AS a, ln(1 + count(*)) AS c FROM reviews_text GROUP BY product_id)""", """
item_vectors AS (
  SELECT * FROM text_weights
  UNION ALL SELECT product_id, 1000, (a - (SELECT avg(a) FROM item_numbers)) / (SELECT stddev_pop(a) FROM item_numbers)
  FROM item_numbers
  UNION ALL SELECT product_id, 1001, (c - (SELECT avg(c) FROM item_numbers)) / (SELECT stddev_pop(c) FROM item_numbers)
  FROM item_numbers)"""]


def text_features(spark, sf):
    reviews = A.reviews_text(spark, sf)
    texts = reviews.select("product_id", F.col("review_text").alias("combined_text"))
    stats = G.product_core(reviews).withColumnRenamed("average_rating", "avg_rating")
    return R.item_features(texts, stats)


@query("item_content_features", A.sql("reviews_text", """
SELECT product_id, position, round(weight, 6) AS weight FROM item_vectors WHERE weight != 0""", *TEXT_FEATURES))
def q_features(spark, sf):
    out = text_features(spark, sf).select("product_id", F.explode("vector").alias("position", "weight"))
    return shorten(out, "weight")


@query("item_text_neighbours")
def q_text_near(spark, sf):
    return M.dense_neighbours(text_features(spark, sf), "product_id", "vector", 10)
