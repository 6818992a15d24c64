"""Every query with an SQL twin gives the rows of the twin; the others give rows."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from pyspark.sql import functions as F

from opinion_spark import adapters
from opinion_spark.catalog.features import CORE_FEATURES, TEXT_FEATURES
from __spark_entry__ import entry, oracle_sql, queries
from tools.check import TABLES, plain

QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    yield con
    con.close()


SCALAR = set(TEXT_FEATURES) | set(CORE_FEATURES)  # together in test_scalar_features


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SCALAR))
def test_matches_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    mine = Counter(plain(tuple(row[c] for c in cols)) for row in df.collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    theirs = Counter(plain(tuple(row[i] for i in order)) for row in result.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("view, features, args", [
    ("reviews_text", TEXT_FEATURES, ["review_text"]),
    ("reviews_core", CORE_FEATURES, ["helpful_votes", "total_votes", "rating"])])
def test_scalar_features(spark, small, duck, view, features, args):
    cols = list(features)
    df = getattr(adapters, view)(spark, small).select(
        "review_id", *[features[n][0](*[F.col(a) for a in args]).alias(n) for n in cols])
    mine = Counter(plain(tuple(r)) for r in df.collect())
    body = ", ".join(f"{features[n][1]} AS {n}" for n in cols)
    theirs = Counter(plain(r) for r in duck.execute(
        adapters.sql(view, f"SELECT review_id, {body} FROM {view}")).fetchall())
    assert mine == theirs


SLOW = {"fake_model_metrics", "fake_feature_importance", "training_run_report"}  # covered in test_jobs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).limit(1).count() == 1


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    scores = [r["popularity_score"] for r in rows]
    assert scores == sorted(scores, reverse=True)
