"""Recommendations for every user in one job."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import NGram, RegexTokenizer, SQLTransformer, StopWordsRemover
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions import lexicons as L
from opinion_spark.operators.aggregates import popular_products
from opinion_spark.operators.innerproduct import best_unseen
from opinion_spark.operators.ranking import row_index, top_per_key
from opinion_spark.operators.similarity import (
    DIGITS, AngularIndex, SimilarItems, angular_neighbours, dense_neighbours, liked_sums, sparse_neighbours,
    unit_weights)
from opinion_spark.session import checkpoint_dir, materialize

REC = ["user_id", "product_id", "predicted_rating", "confidence"]


def user_item_ratings(reviews: DataFrame) -> DataFrame:
    """Mean rating per (user, item): the long form of the rating matrix."""
    return reviews.groupBy("user_id", "product_id").agg(F.avg("rating").alias("rating"))


def user_neighbours(ratings: DataFrame, k: int = 19, min_sim: float = 0.1, **tuning: int) -> DataFrame:
    """The k most similar other users of each user."""
    return sparse_neighbours(
        unit_weights(ratings, "user_id", "product_id", "rating"), "user_id", "product_id", k, min_sim, **tuning)


def item_neighbours(vectors: DataFrame, k: int = 20, keep_self: bool = True) -> DataFrame:
    """The k most similar items of each item; the item itself counts as one."""
    return dense_neighbours(vectors, "product_id", "vector", k, keep_self)


def item_tables(vectors: DataFrame, k: int = 20, min_sim: float = 0.1) -> tuple[DataFrame, SimilarItems]:
    """The neighbours of each item, stored, and all pairs of items above ``min_sim``, from one index."""
    index = AngularIndex(vectors, "product_id", "vector")
    return materialize(angular_neighbours(index, k, keep_self=True)), SimilarItems(index, min_sim)


def _weighted(candidates: DataFrame, ratings: DataFrame, n: int) -> DataFrame:
    """Similarity-weighted mean rating of unseen candidates, best n per user."""
    unseen = candidates.groupBy("user_id", "product_id").agg(
        F.sum(F.col("rating") * F.col("sim")).alias("ws"), F.sum("sim").alias("ss")
    ).where("ss > 0").join(ratings.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    scored = unseen.select(
        "user_id", "product_id", (F.col("ws") / F.col("ss")).alias("predicted_rating"),
        F.least("ss", F.lit(1.0)).alias("confidence"))
    return top_per_key(
        scored, ["user_id"], [F.desc(F.round("predicted_rating", DIGITS)), F.col("product_id")], n)


def user_based(ratings: DataFrame, neighbours: DataFrame, n: int = 10) -> DataFrame:
    """From the ratings of similar users.

    A neighbour with d ratings has a cosine of at least 0.1 only to users that
    share about d / 100 of them or more, so the joined rows stay within a fixed
    multiple of the ratings, however many ratings one user has.
    """
    theirs = ratings.select(F.col("user_id").alias("other"), "product_id", "rating")
    return _weighted(neighbours.join(theirs, "other"), ratings, n)


def item_based(
    ratings: DataFrame, neighbours: DataFrame, n: int = 10, min_sim: float = 0.1, group_rows: int = 8000, rows_per_user: int = 2000,
) -> DataFrame:
    """From the items most similar to each rated item.

    Only ratings of items that have or are a neighbour count; they are worked out once. Users are scored in groups
    of about ``group_rows`` such ratings, each with the list of its item, so no row per candidate is shuffled. Users
    with more than ``rows_per_user``, and ratings without a user, are spread over tasks by candidate instead.
    """
    near = neighbours.where((F.col("sim") > min_sim) & (F.col("other") != F.col("product_id")))
    lists = materialize(near.groupBy("product_id").agg(  # as many entries as an item has neighbours
        F.collect_list("other").alias("others"), F.collect_list("sim").alias("sims")))
    known = materialize(lists.select("product_id").union(lists.select(F.explode("others"))).distinct())
    mine = materialize(ratings.select("user_id", "product_id", F.col("rating").cast("double").alias("rating")).join(
        known, "product_id", "left_semi"))
    many = materialize(mine.groupBy("user_id").agg(F.count(F.lit(1)).alias("c")).where(
        (F.col("c") > rows_per_user) | F.col("user_id").isNull()).select("user_id"))
    few = mine.where("user_id IS NOT NULL").join(many, "user_id", "left_anti")
    best = _group_weighted(few, lists, n, max(1, -(-mine.count() // group_rows)))
    if many.isEmpty():
        return best
    rest = mine.join(many.withColumnRenamed("user_id", "__user"), F.col("user_id").eqNullSafe(F.col("__user")), "left_semi")
    pairs = lists.select("product_id", F.explode(F.arrays_zip("others", "sims")).alias("p"))
    candidates = rest.join(pairs, "product_id").select(
        "user_id", F.col("p.others").alias("product_id"), "rating", F.col("p.sims").alias("sim"))
    return best.unionByName(_weighted(candidates, rest, n))


def _group_weighted(ratings: DataFrame, lists: DataFrame, n: int, groups: int) -> DataFrame:
    """``_weighted`` for users that lie in ``groups``; a rating brings its item's list, and those without one still mark an item as seen."""
    spark = ratings.sparkSession
    user, item = dict(ratings.dtypes)["user_id"], dict(lists.dtypes)["others"][len("array<"):-1]
    grouped = ratings.join(lists, "product_id", "left").select(
        F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("g"), "user_id", F.col("product_id").cast(item).alias("product_id"),
        "rating", "others", "sims")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return grouped.repartition(min(groups, 4 * tasks), "g").groupBy("g").applyInArrow(
        lambda rows: _best_weighted(rows, n),
        f"user_id {user}, product_id {item}, predicted_rating double, confidence double")


def _best_weighted(rows: pa.Table, n: int) -> pa.Table:
    """The n best unseen candidates of each user of a group; all of a user's rows are here."""
    column = {c: pa.concat_arrays(rows[c].chunks) for c in rows.column_names}
    who, others = column["user_id"].dictionary_encode(), column["others"].flatten()
    ids = pa.concat_arrays([others, column["product_id"]]).dictionary_encode()
    order = pc.sort_indices(ids.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at, items = place[ids.indices.to_numpy()], ids.dictionary.take(pa.array(order))
    sizes = pc.fill_null(pc.list_value_length(column["others"]), 0).to_numpy()
    users = who.indices.to_numpy().astype(np.int64) * len(items)
    cell = np.repeat(users, sizes) + at[:len(others)]
    order = np.argsort(cell)
    cell, sim = cell[order], column["sims"].flatten().to_numpy()[order]
    begins = np.flatnonzero(np.diff(cell, prepend=-1))
    if not len(begins):
        return pa.table({"user_id": column["user_id"][:0], "product_id": column["product_id"][:0],
                         "predicted_rating": np.zeros(0), "confidence": np.zeros(0)})
    given = column["rating"].is_valid().to_numpy(zero_copy_only=False)
    value = np.where(given, column["rating"].fill_null(0.0).to_numpy(), 0.0)
    ws, ss = np.add.reduceat(np.repeat(value, sizes)[order] * sim, begins), np.add.reduceat(sim, begins)
    rated = np.logical_or.reduceat(np.repeat(given, sizes)[order], begins)  # a candidate of null ratings only has no value
    cell, seen, fresh = cell[begins], users + at[len(others):], ss > 0
    here = np.minimum(np.searchsorted(cell, seen), len(cell) - 1)
    fresh[here[cell[here] == seen]] = False
    cell, ws, ss, rated = cell[fresh], ws[fresh], ss[fresh], rated[fresh]
    u, i, predicted = cell // len(items), cell % len(items), ws / ss  # users ascend, then items
    order = np.argsort(np.where(rated, -np.round(predicted, DIGITS), np.inf), kind="stable")
    order = order[np.argsort(u[order].astype(np.uint16 if len(who.dictionary) < 1 << 16 else np.int64), kind="stable")]
    order = order[np.arange(len(order)) - np.searchsorted(u, np.arange(len(who.dictionary)))[u] < n]
    return pa.table({
        "user_id": who.dictionary.take(pa.array(u[order])), "product_id": items.take(pa.array(i[order])),
        "predicted_rating": pa.array(predicted[order], mask=~rated[order]), "confidence": np.minimum(ss[order], 1.0)})


def popular(reviews: DataFrame, n: int = 10) -> DataFrame:
    """The popular list as (product_id, predicted_rating, confidence)."""
    return popular_products(reviews, n).select(
        "product_id", F.col("avg_rating").alias("predicted_rating"), "confidence")


def popular_for(users: DataFrame, top: DataFrame) -> DataFrame:
    """The same short list for each user: one array of n items, no cross join."""
    rows = top.agg(F.collect_list(F.struct("product_id", "predicted_rating", "confidence")).alias("r"))
    return users.select("user_id", F.explode(rows.scalar()).alias("r")).select("user_id", "r.*")


def similar_items(vectors: DataFrame, min_sim: float = 0.1) -> SimilarItems:
    """All pairs of different items above ``min_sim``, in both directions; they are worked out where they are read."""
    return SimilarItems(AngularIndex(vectors, "product_id", "vector"), min_sim)


def content_based(
    ratings: DataFrame, similar: DataFrame | SimilarItems, reviews: DataFrame, n: int = 10, like: float = 4.0, **tuning: int
) -> DataFrame:
    """Unseen items similar to the liked ones, by the pairs of ``similar_items`` or a table of them; users without liked items get the
    popular list."""
    means = materialize(reviews.groupBy("product_id").agg(F.avg("rating").alias("avg_rating")))
    known = means.select("product_id")  # reviewed products only
    scored = liked_sums(ratings, similar, n, like, only=known, **tuning).join(means, "product_id").select(
        "user_id", "product_id", F.least("avg_rating", F.lit(5.0)).alias("predicted_rating"),
        F.least("score", F.lit(1.0)).alias("confidence"))
    without = ratings.groupBy("user_id").agg(F.max("rating").alias("m")).where(F.col("m") < like).select("user_id")
    return scored.unionByName(popular_for(without, popular(reviews, n)))


def _numbered(ratings: DataFrame, key: str) -> DataFrame:
    """(key, number): a 32-bit number for each id, as ALS needs one, in hash order whatever the type of the ids."""
    ids = materialize(ratings.select(key).distinct().withColumn("__x", F.xxhash64(key)))
    return row_index(ids, [], "__x", key, "number").select(key, F.col("number").cast("int"))


def matrix_factorization(ratings: DataFrame, n: int = 10, rank: int = 50, iterations: int = 10, seed: int = 42) -> DataFrame:
    """Non-negative ALS on the observed ratings; the n best unseen items of each user, by exact inner products."""
    checkpoint_dir(ratings.sparkSession)
    users = materialize(_numbered(ratings, "user_id").withColumnRenamed("number", "u"))
    items = materialize(_numbered(ratings, "product_id").withColumnRenamed("number", "i"))
    coded = materialize(ratings.join(users, "user_id").join(items, "product_id").select(
        "u", "i", F.col("rating").cast("float").alias("rating")))
    model = ALS(
        rank=rank, maxIter=iterations, nonnegative=True, userCol="u", itemCol="i", ratingCol="rating",
        seed=seed, coldStartStrategy="drop", checkpointInterval=2).fit(coded)  # at each checkpoint the shuffles before it are dropped
    best = best_unseen(
        model.userFactors.select(F.col("id").alias("u"), F.col("features").alias("vector")),
        model.itemFactors.select(F.col("id").alias("i"), F.col("features").alias("vector")), coded.select("u", "i"), n)
    return best.join(users, "u").join(items, "i").select(
        "user_id", "product_id", F.col("score").alias("predicted_rating"),
        F.least(F.col("score") / 5, F.lit(1.0)).alias("confidence"))


def item_terms(texts: DataFrame, terms: int = 1000) -> DataFrame:
    """(product_id, position, term, weight): TF-IDF of words and word pairs, each product's weights of length 1.

    ``texts``: (product_id, combined_text) with one or more parts per product.
    Terms are counted per part and summed, so no product text is put together. The
    vocabulary is the ``terms`` most frequent ones, equal ones in order of the term,
    and a term's position is its rank from 0.
    """
    tokens = Pipeline(stages=[
        RegexTokenizer(inputCol="combined_text", outputCol="words", pattern=r"(?U)\b\w\w+\b", gaps=False),
        StopWordsRemover(inputCol="words", outputCol="kept", stopWords=L.STOP_WORDS),
        NGram(n=2, inputCol="kept", outputCol="pairs"),
        SQLTransformer(statement="SELECT product_id, explode(concat(kept, pairs)) AS term FROM __THIS__"),
    ]).fit(texts).transform(texts.where("combined_text IS NOT NULL"))
    frequent = materialize(tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "term").limit(terms))
    places = frequent.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "term")))["term"].alias("t"))
    vocabulary = materialize(places.select(F.posexplode("t").alias("position", "term")))
    counts = materialize(tokens.join(F.broadcast(vocabulary), "term").groupBy(  # ``terms`` rows
        "product_id", "position", "term").agg(F.count(F.lit(1)).alias("tf")))
    n_products = texts.select("product_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    idf = counts.groupBy("position").agg(F.count(F.lit(1)).alias("df")).select(
        "position", (F.log((1 + n_products.scalar()) / (1 + F.col("df"))) + 1).alias("idf"))
    weighted = counts.join(F.broadcast(idf), "position").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy("product_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "product_id").select(
        "product_id", "position", "term", (F.col("w") / F.col("norm")).alias("weight"))


def item_features(texts: DataFrame, stats: DataFrame, terms: int = 1000) -> DataFrame:
    """(product_id, vector): the ``item_terms`` next to the scaled mean rating and log count.

    The vector is a map from position to weight without zeros; the two scaled
    values stand at ``terms`` and ``terms`` + 1.
    """
    numeric = stats.agg(F.struct(
        F.avg("avg_rating").alias("ma"), F.stddev_pop("avg_rating").alias("sa"),
        F.avg(F.log1p("review_count")).alias("mc"), F.stddev_pop(F.log1p("review_count")).alias("sc")).alias("s"))
    def scaled(value, mean: str, std: str):
        return F.when(F.col(f"s.{std}") > 0, (value - F.col(f"s.{mean}")) / F.col(f"s.{std}")).otherwise(F.lit(0.0))
    extra = stats.withColumn("s", numeric.scalar()).select("product_id", F.create_map(
        F.lit(terms), scaled(F.col("avg_rating"), "ma", "sa"),
        F.lit(terms + 1), scaled(F.log1p("review_count"), "mc", "sc")).alias("extra"))
    # at most ``terms`` entries per product
    sparse = item_terms(texts, terms).groupBy("product_id").agg(
        F.map_from_entries(F.collect_list(F.struct("position", "weight"))).alias("m"))
    return extra.join(sparse, "product_id", "left").select("product_id", F.map_filter(
        F.map_concat(F.coalesce("m", F.create_map().cast("map<int,double>")), "extra"), lambda _, w: w != 0).alias("vector"))


# ---- blending --------------------------------------------------------------
def hybrid(
    methods: dict[str, DataFrame], n: int = 10, weights: dict[str, float] = L.METHOD_WEIGHTS,
    neighbours: DataFrame | None = None, names: DataFrame | None = None,
) -> DataFrame:
    """Blend the lists of all methods; one shuffle on (user, product).

    rating = weighted mean over the methods that name the item, confidence =
    plain mean, score = rating * confidence.
    """
    rows: DataFrame | None = None
    for method, recs in methods.items():
        one = recs.select(*REC, F.lit(method).alias("method"), F.lit(weights[method]).alias("weight"))
        rows = one if rows is None else rows.unionByName(one)
    blended = rows.groupBy("user_id", "product_id").agg(
        (F.sum(F.col("predicted_rating") * F.col("weight")) / F.sum("weight")).alias("predicted_rating"),
        F.avg("confidence").alias("confidence"), F.array_sort(F.collect_set("method")).alias("m")).select(
        "user_id", "product_id", "predicted_rating", "confidence",
        (F.col("predicted_rating") * F.col("confidence")).alias("recommendation_score"),
        F.concat(F.lit("Recommended by "), F.array_join("m", ", ")).alias("reason"))
    best = top_per_key(
        blended, ["user_id"], [F.desc(F.round("recommendation_score", DIGITS)), F.col("product_id")], n)
    if neighbours is not None:
        kind = dict(neighbours.dtypes)["other"]
        similar = top_per_key(
            neighbours.where(F.col("other") != F.col("product_id")), ["product_id"],
            [F.desc("sim"), F.col("other")], 3).groupBy("product_id").agg(
            F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("d"), "other"))).alias("s"))
        best = best.join(similar, "product_id", "left").withColumn(
            "similar_products", F.coalesce(F.col("s.other"), F.array().cast(f"array<{kind}>"))).drop("s")
    if names is not None:
        from opinion_spark.operators.joins import with_product_name
        best = with_product_name(best, names)
    return best


def served(requested: DataFrame, stored: DataFrame, fallback: DataFrame, n: int = 10,
           fresh: DataFrame | None = None) -> DataFrame:
    """Stored recommendations per requested user, else the best rated products.

    ``fallback`` has (product_id, average_rating), as ``aggregates.popular_fallback``
    gives; its rows are served with confidence 0.5. With ``fresh``, newly computed
    recommendations are served instead, kind ``fresh_hybrid``; a user without any
    has one row of kind ``none_available`` without a product.
    """
    if fresh is not None:
        new = served(requested, fresh, fallback, n).where("kind = 'stored'").withColumn("kind", F.lit("fresh_hybrid"))
        return requested.select("user_id").distinct().join(new, "user_id", "left").withColumn(
            "kind", F.coalesce("kind", F.lit("none_available")))
    popular_rows = fallback.select("product_id", F.col("average_rating").alias("predicted_rating"),
                                   F.lit(0.5).alias("confidence"))
    own = top_per_key(
        stored.join(requested.select("user_id"), "user_id", "left_semi"), ["user_id"],
        [F.desc(F.round("recommendation_score", DIGITS)), F.col("product_id")], n)
    lacking = requested.select("user_id").join(stored.select("user_id").distinct(), "user_id", "left_anti")
    return own.select("user_id", "product_id", "predicted_rating", "confidence", F.lit("stored").alias("kind")).unionByName(
        popular_for(lacking, popular_rows).withColumn("kind", F.lit("popular_fallback")))
