"""Operators that split hot groups give what a plain computation gives."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opinion_spark.operators import alerts as A
from opinion_spark.operators import dedup as D
from opinion_spark.operators import innerproduct as P
from opinion_spark.operators import ranking as K
from opinion_spark.operators import recommend as R
from opinion_spark.operators import similarity as M
from opinion_spark.operators import windows as W


@pytest.fixture(scope="module")
def hot(spark):
    """One key, and one value of it, hold about a third of all rows."""
    rng = random.Random(3)
    rows = [(i, 0 if i % 3 == 0 else rng.randrange(50), 7 if i % 3 == 0 else rng.randrange(1000)) for i in range(6000)]
    return spark.createDataFrame(rows, "id long, k long, v long").cache()


@pytest.mark.parametrize("buckets", [2, 8, 300, None])
def test_running_totals(hot, buckets):
    counts = hot.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).cache()
    got = {(r["k"], r["v"]): r["n_upto"] for r in K.running_totals(counts, ["k"], "v", ["n"], buckets).collect()}
    w = Window.partitionBy("k").orderBy("v")
    want = {(r["k"], r["v"]): r["x"] for r in counts.withColumn("x", F.sum("n").over(w)).collect()}
    assert got == want


def test_running_totals_with_null_keys_and_values(spark):
    rows = [(None if i % 3 else "a", None if i % 7 == 0 else i, 1) for i in range(400)]
    counts = spark.createDataFrame(rows, "k string, v long, n long").groupBy("k", "v").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("k").orderBy("v")
    want = Counter(map(tuple, counts.withColumn("n_upto", F.sum("n").over(w)).collect()))
    assert Counter(map(tuple, K.running_totals(counts, ["k"], "v", ["n"], 9).collect())) == want
    none = counts.where("false")
    assert K.running_totals(none, ["k"], "v", ["n"]).count() == 0 == K.row_index(none, [], "v", "k").count()


def test_ranks_do_not_shuffle_rows_by_their_key(spark, hot):
    """Rows meet by range alone; with broadcasts off no exchange of them is on the key, and no loop join is left."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = hot.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).cache()
        for out in (K.running_totals(counts, ["k"], "v", ["n"], 16), K.running_totals(counts, [], "v", ["n"]),
                    K.row_index(hot, ["k"], "v", "id"), K.row_index(hot, [], "v", "id")):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
            for on in re.findall(r"hashpartitioning\(([^)]*)\)", plan):
                assert on.startswith("__bucket"), on
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    sizes = K.ranged(hot, ["k", "v", "id"], 30).groupBy("__bucket").count().agg(F.max("count")).first()[0]
    assert sizes < 4 * 6000 / 30


@pytest.mark.parametrize("buckets", [None, 40])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_row_index(hot, keys, buckets):
    got = {r["id"]: r["row_index"] for r in K.row_index(hot, keys, "v", "id", buckets=buckets).collect()}
    order = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    w = order.orderBy("v", F.md5(F.col("id").cast("string")))
    want = {r["id"]: r["x"] - 1 for r in hot.withColumn("x", F.row_number().over(w)).collect()}
    assert got == want


@pytest.mark.parametrize("target", [1, 10, 500, 6000, 10_000])
def test_uniform_sample_is_exact(hot, target):
    got = {r["id"] for r in D.uniform_sample(hot, target, "id", "s").collect()}
    order = sorted(range(6000), key=lambda i: __import__("hashlib").md5(f"{i}s".encode()).hexdigest())
    assert got == set(order[:target])


def test_stratified_sample_and_split(hot):
    sizes = Counter(r["k"] for r in hot.select("k").collect())
    sample = Counter(r["k"] for r in D.proportional_sample(hot, 900, "k", "id").collect())
    assert sample == {k: max(1, 900 * n // 6000) for k, n in sizes.items()}
    split = D.split_stratified(hot, 0.25, "k", "id")
    assert split.count() == 6000
    test = Counter(r["k"] for r in split.where("is_test").collect())
    assert all(abs(test[k] - n * 0.25) <= 0.5 for k, n in sizes.items())


def test_trim_when_every_stratum_keeps_a_row(spark):
    df = spark.range(100).select("id", F.col("id").alias("rating"))
    assert D.proportional_sample(df, 30, "rating", "id").count() == 30


def test_dedup_plan_limits_before_the_shuffle(spark, small):
    from __spark_entry__ import queries
    plan = queries()["dedup_exact"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", plan, re.S)


def test_duplicate_rows_are_told_by_digest(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (1, None, 1.0), (1, None, 1.0), (1, "", 1.0), (None, "a", 1.0), (2, "a", None)] + [(3, "b" * 9999, 2.0)] * 50
    df = spark.createDataFrame(rows, "a long, t string, x double")
    out = D.duplicate_rows(df)
    assert out.first()[0] == 51
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan.split("HashAggregate")[-1]


def test_no_cartesian_products(spark, small):
    from __spark_entry__ import queries
    for name in ("recommend_stored_or_popular", "ks_test_sweep", "global_rating_deviation", "alert_notifications",
                 "recommend_content_based", "rating_distribution", "user_neighbours_hot_items"):
        plan = queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


# ---- cooldown --------------------------------------------------------------
def plain_cooldown(rows, minutes):
    last, passed = {}, set()
    for t, i, kind, comp in sorted(rows):
        key = (kind, comp)
        if key not in last or t - last[key] >= minutes[kind] * 60:
            last[key] = t
            passed.add(i)
    return passed


@pytest.mark.parametrize("block", [1, 7, 60, 1440, None])
def test_cooldown_in_blocks(spark, block):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        kind = "system_threshold" if i % 3 else "health_check"
        comp = "hot" if i % 3 else f"c{rng.randrange(4)}"
        rows.append((rng.randrange(200_000), i, kind, comp))
    rows += [(rows[5][0], 9000, rows[5][2], rows[5][3])]
    df = spark.createDataFrame(rows, "s long, event_id long, alert_type string, component string").withColumn(
        "ts", F.timestamp_seconds("s"))
    got = {r["event_id"] for r in A.after_cooldown(df, block).collect()}
    assert got == plain_cooldown(rows, {"system_threshold": 15, "health_check": 10})


def test_cooldown_of_one_key_over_many_blocks(spark, monkeypatch):
    """10,000 blocks of a key: every task reads the tables of a few neighbours only, and the result is the plain one."""
    rng = random.Random(4)
    rows = [(m * 60 + rng.randrange(60), m, "system_threshold", "one") for m in range(0, 10_000)]
    rows += [(m * 60 + rng.randrange(60), 20_000 + m, "system_threshold", "one") for m in range(10_000) if rng.random() < 0.3]
    df = spark.createDataFrame(rows, "s long, event_id long, alert_type string, component string").withColumn(
        "ts", F.timestamp_seconds("s"))
    seen = spark.sparkContext.accumulator(0)
    fan, children = A.FAN, A._children

    def counted(pdf):
        assert pdf["block"].nunique() <= fan
        seen.add(1)
        return children(pdf)
    monkeypatch.setattr(A, "_children", counted)
    got = {r["event_id"] for r in A.after_cooldown(df, 1).collect()}
    assert got == plain_cooldown(rows, {"system_threshold": 15})


def test_chain_tables_compose_in_any_grouping():
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(6)
    wait, size, key = 50, 20, ("t", "c")
    for _ in range(30):
        times = np.unique(rng.integers(0, 640, rng.integers(1, 200)))
        blocks = {}
        for b in np.unique(times // size):
            mine = times[times // size == b]
            blocks[int(b)] = A._chain_table((*key, int(b)), pd.DataFrame({"t": mine, "wait": wait, "block_start": int(b) * size}))
        whole = A._composed(640)((*key, 0), pd.concat(blocks.values()))
        halves = [pd.concat([t for b, t in blocks.items() if b // 16 == h]) for h in (0, 1) if any(b // 16 == h for b in blocks)]
        nested = A._composed(640)((*key, 0), pd.concat(
            A._composed(320)((*key, int(h["block"].iloc[0]) // 16), h) for h in halves))
        for ready in rng.integers(-60, wait, 20):
            last = None
            for t in times:
                if t >= ready if last is None else t - last >= wait:
                    last = t
            for table in (whole, nested):
                place = np.searchsorted(table["first"], ready)
                assert (int(table["last"].iloc[place]) if place < len(table) else None) == last


@pytest.mark.parametrize("minutes", [1, 30, 24 * 60, 10**7])
def test_gate_in_blocks(spark, minutes):
    rng = random.Random(9)
    rows = [(rng.randrange(0, 50_000) if i % 5 else 700, i, rng.choice("aab"), rng.choice(["low", "medium", "high", "critical"]),
             "hot" if i % 3 else f"c{rng.randrange(3)}") for i in range(900)]
    df = spark.createDataFrame(rows, "s long, event_id long, alert_type string, severity string, component string").withColumn(
        "ts", F.timestamp_seconds("s"))
    rank = {r["severity"]: r["n"] for r in df.select("severity", A.severity_rank(F.col("severity")).alias("n")).distinct().collect()}
    active, want = {}, set()
    for _, i, kind, severity, comp in sorted(rows):
        before = active.get(comp)
        if before is None or before[0] != kind:
            active[comp] = (kind, rank[severity])
            want.add(i)
        elif rank[severity] > before[1]:
            active[comp] = (kind, rank[severity])
            want.add(i)
    out = A.past_gate(df, minutes)
    assert out.columns == df.columns and {r["event_id"] for r in out.collect()} == want


# ---- neighbours ------------------------------------------------------------
def plain_neighbours(ratings, k, min_sim):
    by_user = defaultdict(dict)
    for u, i, r in ratings:
        by_user[u][i] = r
    norm = {u: math.sqrt(sum(r * r for r in v.values())) for u, v in by_user.items()}
    out = set()
    for u in by_user:
        sims = []
        for v in by_user:
            common = by_user[u].keys() & by_user[v].keys()
            if u != v and common:
                s = round(sum(by_user[u][i] * by_user[v][i] for i in common) / norm[u] / norm[v], 9)
                if s >= min_sim:
                    sims.append((-s, v))
        out |= {(u, v, round(-s, 6)) for s, v in sorted(sims)[:k]}
    return out


@pytest.mark.parametrize("hot_degree", [5, 30, 10_000])
def test_neighbours_with_hot_items(spark, hot_degree):
    rng = random.Random(5)
    seen = {}
    for u in range(150):
        if u % 3 == 0:
            seen[u, 0] = float(rng.randint(1, 5))  # a third of the users rate item 0, many nothing else
        for _ in range(rng.randrange(0 if u % 3 == 0 else 1, 6)):
            seen[u, int(rng.paretovariate(0.7)) % 60] = float(rng.randint(1, 5))
    ratings = [(u, i, r) for (u, i), r in seen.items()]
    df = spark.createDataFrame(ratings, "user_id long, product_id long, rating double")
    got = {(r["user_id"], r["other"], round(r["sim"], 6))
           for r in R.user_neighbours(df, 5, 0.1, hot_degree=hot_degree, per_block=40).collect()}
    assert got == plain_neighbours(ratings, 5, 0.1)


@pytest.mark.parametrize("per_part", [3, 2000])
def test_liked_sums(spark, per_part):
    rng = random.Random(8)
    vec = {i: [rng.gauss(0, 1) for _ in range(6)] for i in range(40)}
    ratings = {(u, rng.randrange(45)): float(rng.randint(1, 5)) for u in range(25) for _ in range(8)}
    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.hypot(*a) / math.hypot(*b)
    want = set()
    for u in range(25):
        seen = {i for (v, i) in ratings if v == u}
        liked = [i for i in seen if ratings[u, i] >= 4 and i in vec]
        scores = {}
        for j in vec:
            s = sum(c for c in (round(cos(vec[i], vec[j]), 9) for i in liked) if c > 0.1)
            if j not in seen and s > 0:
                scores[j] = s
        best = sorted(scores, key=lambda j: (-round(min(scores[j], 1.0), 9), j))[:5]
        want |= {(u, j, round(scores[j], 6)) for j in best}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in ratings.items()], "user_id long, product_id long, rating double")
    vectors = spark.createDataFrame(list(vec.items()), "product_id long, vector array<double>")
    similar = M.angular_pairs(M.AngularIndex(vectors, "product_id", "vector", per_block=15, per_pivot=8), 0.1)
    got = {(r["user_id"], r["product_id"], round(r["score"], 6)) for r in M.liked_sums(
        df, similar, 5, group_rows=20, rows_per_part=per_part).collect()}
    assert got == want


def clustered(n, groups, width, seed):
    """Vectors in tight groups, with a few of length zero and a few equal ones."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(groups, 24))[np.arange(n) % groups] + width * rng.normal(size=(n, 24))
    v[::97] = 0
    v[5] = v[5 + groups]
    return v


def plain_dense(v, k, keep_self):
    length = np.linalg.norm(v, axis=1, keepdims=True)
    unit = np.divide(v, length, out=np.zeros_like(v), where=length > 0)
    sims = np.round(unit @ unit.T, 9)
    out = set()
    for i, row in enumerate(sims):
        found = [j for j in sorted(range(len(v)), key=lambda j: (-row[j], j)) if keep_self or j != i][:k]
        out |= {(i, j, round(float(row[j]), 6) + 0.0) for j in found}
    return out, sims


@pytest.mark.parametrize("width, keep_self", [(0.05, True), (1.0, False), (8.0, False)])
def test_angular_index_loses_nothing(spark, width, keep_self):
    v = clustered(600, 30, width, 4)
    want, sims = plain_dense(v, 6, keep_self)
    data = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "product_id long, vector array<double>")
    index = M.AngularIndex(data, "product_id", "vector", per_block=40, per_pivot=20)
    got = {(r["product_id"], r["other"], round(r["sim"], 6) + 0.0) for r in M.angular_neighbours(index, 6, keep_self).collect()}
    assert got == want
    pairs = Counter((r["product_id"], r["other"]) for r in M.angular_pairs(index, 0.3).collect())
    assert set(pairs.values()) <= {1}
    assert set(pairs) == {(i, j) for i, j in zip(*np.nonzero(sims > 0.3)) if i != j}


def test_angular_index_skips_far_blocks(spark):
    """Twice as many groups, each as large: the pairs of blocks that are compared don't grow with the square."""
    compared = []
    for groups in (20, 40):
        v = clustered(groups * 25, groups, 0.02, 7)[1:]  # without the vector of length zero at the front
        v = v[np.abs(v).sum(1) > 0]
        data = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "product_id long, vector array<double>")
        index = M.AngularIndex(data, "product_id", "vector", per_block=40, per_pivot=5)
        floors = index.stats.select("block", F.lit(0.9).alias("floor"))
        blocks, pairs = index.stats.count(), index.pairs(floors).count()
        assert pairs < 0.5 * blocks * (blocks - 1) / 2
        compared.append(pairs)
    assert compared[1] < 3 * compared[0]


def test_hot_blocks_that_cannot_reach_a_floor_are_skipped(spark):
    """Two hot items with raters of their own, and many light ones: blocks meet only where they can matter."""
    rng = random.Random(2)
    ratings = [(u, u % 2, 5.0) for u in range(400)] + [(u, 100 + u, float(rng.randint(1, 5))) for u in range(400) if u % 4]
    ratings += [(u, 1000 + 10 * u + x, 5.0) for u in range(300, 400) for x in range(10)]
    df = spark.createDataFrame(ratings, "user_id long, product_id long, rating double")
    weights = R.unit_weights(df, "user_id", "product_id", "rating")
    got = {(r["user_id"], r["other"], round(r["sim"], 6))
           for r in M.sparse_neighbours(weights, "user_id", "product_id", 5, 0.1, hot_degree=50, per_block=25).collect()}
    assert got == plain_neighbours(ratings, 5, 0.1)
    hot = weights.where("product_id < 2").groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("product_id", "w"))).alias("hot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__size"))
    placed = M._hot_blocks(hot, "user_id", 5, 25)
    assert placed.groupBy("block").count().agg(F.max("count")).first()[0] <= 25 and placed.count() == 400
    blocks = placed.select("block").distinct().count()
    floors = placed.select("block").distinct().withColumn("floor", F.lit(0.1))
    assert M._hot_pairs(placed, floors, "user_id").count() < 0.5 * blocks * (blocks - 1) / 2


def test_item_features_are_sparse_and_fixed(spark, small):
    """Ties at the end of the vocabulary go by the term, whatever the partitioning; maps give what arrays give."""
    from opinion_spark import adapters
    from opinion_spark.operators import aggregates as G
    reviews = adapters.reviews_text(spark, small)
    texts = reviews.select("product_id", F.col("review_text").alias("combined_text"))
    one = Counter((r["product_id"], r["position"], r["term"], round(r["weight"], 9)) for r in R.item_terms(texts, 40).collect())
    two = Counter((r["product_id"], r["position"], r["term"], round(r["weight"], 9))
                  for r in R.item_terms(texts.repartition(11), 40).collect())
    assert one == two and {p for _, p, _, _ in one} == set(range(40))
    stats = G.product_core(reviews).withColumnRenamed("average_rating", "avg_rating")
    maps = R.item_features(texts, stats, 40)
    arrays = maps.select("product_id", F.transform(F.sequence(F.lit(0), F.lit(41)), lambda i: F.coalesce(
        F.try_element_at("vector", i.cast("int")), F.lit(0.0))).alias("vector"))
    def near(vectors):
        return Counter(map(tuple, M.dense_neighbours(vectors, "product_id", "vector", 4, per_block=30, per_pivot=25).collect()))
    assert near(maps) == near(arrays)


@pytest.mark.parametrize("n, per_block, per_chunk", [(3, 7, 20), (5, 1024, 2048), (60, 16, 50)])
def test_best_unseen_is_the_whole_product(spark, n, per_block, per_chunk):
    """Against the full product: many blocks, a user that has seen nearly all, ties, zero and null vectors."""
    rng = np.random.default_rng(8)
    items = np.round(rng.gamma(0.5, 1.0, (80, 4)) * rng.pareto(2.0, (80, 1)), 3)
    items[5] = items[6] = items[7]
    users = np.round(rng.gamma(0.7, 1.0, (60, 4)), 3)
    users[9] = 0
    seen = {(u, i) for u in range(60) for i in rng.choice(80, 6, replace=False).tolist()} | {(3, i) for i in range(78)}
    vectors = "vector array<float>"
    left = spark.createDataFrame([(u, v.tolist()) for u, v in enumerate(users)] + [(60, None)], f"u int, {vectors}")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)] + [(80, None)], f"i int, {vectors}")
    pairs = spark.createDataFrame(sorted(seen) + [(0, 999), (3, 0)], "u int, i int")
    got = {(r["u"], r["i"], r["score"]) for r in P.best_unseen(left, right, pairs, n, per_block, per_chunk).collect()}
    product = np.round(users.astype(np.float32).astype(float) @ items.astype(np.float32).astype(float).T, M.DIGITS)
    want = set()
    for u in range(60):
        free = sorted((-product[u, i], i) for i in range(80) if (u, i) not in seen and product[u, i] > 0)
        want |= {(u, i, -s) for s, i in free[:n]}
    assert {(u, i) for u, i, _ in got} == {(u, i) for u, i, _ in want}
    assert sorted(s for _, _, s in got) == pytest.approx(sorted(s for _, _, s in want), abs=2e-9)


def test_best_unseen_stops_at_short_items(spark, monkeypatch):
    """Long items first: the blocks of short ones are met by nobody."""
    items = spark.range(4000).select(F.col("id").cast("int").alias("i"), F.array(
        F.when(F.col("id") < 50, 10.0).otherwise(0.01).cast("float")).alias("vector"))
    users = spark.range(30).select(F.col("id").cast("int").alias("u"), F.array(F.lit(1.0).cast("float")).alias("vector"))
    numbers, plain = [], P._cogrouped
    monkeypatch.setattr(P, "_cogrouped", lambda x, y, pairs: numbers.append(pairs) or plain(x, y, pairs))
    out = P.best_unseen(users, items, spark.createDataFrame([(0, 0)], "u int, i int"), 10, per_block=50)
    assert out.count() == 300 and numbers == [1]
    assert P.best_unseen(users, items.where("false"), spark.createDataFrame([], "u int, i int"), 10).count() == 0


@pytest.mark.parametrize("text_ids", [False, True])
def test_factorization_skips_seen_items(spark, small, text_ids):
    from opinion_spark import adapters
    r = R.user_item_ratings(adapters.reviews_core(spark, small))
    if text_ids:
        r = r.withColumns({c: F.concat(F.lit("x"), c) for c in ("user_id", "product_id")})
    recs = R.matrix_factorization(r, n=5, rank=5, iterations=2)
    assert recs.join(r, ["user_id", "product_id"]).count() == 0
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5


# ---- windows over logs -----------------------------------------------------
@pytest.mark.parametrize("block", [100, 10_000])
def test_blocking_score_does_not_depend_on_blocks(spark, small, block):
    from opinion_spark import adapters
    log = adapters.fetch_log(spark, small).withColumn("session_id", F.lit(1))
    got = {r["request_id"]: (round(r["error_rate"], 9), r["blocked"]) for r in W.blocking_score(log, block=block).collect()}
    rows = sorted(log.collect(), key=lambda r: (r["ts"], __import__("hashlib").md5(str(r["request_id"]).encode()).hexdigest()))
    for n, row in enumerate(rows):
        last20 = rows[max(0, n - 19):n + 1]
        rate = sum(r["status_code"] >= 400 for r in last20) / len(last20)
        mean100 = [r["response_time"] for r in rows[max(0, n - 99):n + 1]]
        recent = sum(r["response_time"] for r in rows[max(0, n - 9):n + 1]) / 10
        score = (rate > 0.5) + (round(recent, 9) > round(sum(mean100) / len(mean100) * 2, 9)) + (
            sum(r["status_code"] == 429 for r in last20) > 3)
        assert got[row["request_id"]] == (round(rate, 9), n >= 9 and score / 3 > 0.5)
