"""Scans, sinks and key-based table updates."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.operators.ranking import first_per_key
from opinion_spark.schemas import REQUIRED_REVIEW_COLUMNS


# ---- scans ---------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: str, first: int | None = None) -> DataFrame:
    """CSV with quoted line breaks and doubled quotes; optionally the first rows only."""
    df = (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').csv(path))
    return df if first is None else df.limit(first)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    for path in paths:
        if _exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exist: {paths}")


def load_reviews(
    spark: SparkSession, candidates: list[tuple[str, str]], as_of: str, first: int | None = None
) -> tuple[DataFrame, list[str]]:
    """First existing CSV of (path, schema), standardised; also the missing required columns."""
    from opinion_spark.operators.cleaning import standardize_columns

    path = first_existing(spark, [p for p, _ in candidates])
    df = standardize_columns(read_csv(spark, path, dict(candidates)[path], first), as_of)
    return df, [c for c in REQUIRED_REVIEW_COLUMNS if c not in df.columns]


def scan(df: DataFrame, columns: list[str], text: str, min_length: int, order: str, limit: int | None = None) -> DataFrame:
    """Columns of the rows whose text is present and longer than ``min_length``."""
    out = df.where(F.col(text).isNotNull() & (F.length(text) > min_length)).select(*columns).orderBy(order)
    return out if limit is None else out.limit(limit)


def scan_by_ids(df: DataFrame, ids: DataFrame, id_col: str = "review_id") -> DataFrame:
    """The rows of the given ids.

    The id list is not forced to broadcast: Spark does so only while it is small.
    """
    return df.join(ids.select(id_col), id_col, "left_semi")


def first_by_id(df: DataFrame, limit: int, id_col: str = "review_id") -> DataFrame:
    """The first ``limit`` rows by id, for callers that ask for a batch without naming ids."""
    return df.orderBy(id_col).limit(limit)


def table_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, n) for each path, 0 when the table does not exist; any other error is raised."""
    out: DataFrame | None = None
    for name, path in paths.items():
        try:
            one = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            one = spark.range(1).select(F.lit(0).cast("long").alias("n"))
        one = one.select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def table_profile(tables: dict[str, DataFrame], sample_rows: int = 3) -> DataFrame:
    """Per table: row count, column list and the first rows as JSON."""
    out: DataFrame | None = None
    for name, df in tables.items():
        sample = df.limit(sample_rows).agg(F.collect_list(F.to_json(F.struct(*df.columns))).alias("s"))
        one = df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), "n", F.lit(", ".join(f"{c} {t}" for c, t in df.dtypes)).alias("columns"),
            sample.scalar().alias("sample"))
        out = one if out is None else out.unionAll(one)
    return out


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Every JSON report file as one text document."""
    return spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "doc")


def newest_reports(
    docs: DataFrame, column: str, schema: str, order: list[str], fields: dict[str, str], n: int = 3
) -> DataFrame:
    """Nested fields of the newest ``n`` JSON documents."""
    parsed = docs.select(F.from_json(column, schema).alias("d")).select("d.*")
    return parsed.orderBy(*[F.desc(c) for c in order]).limit(n).select(
        *[F.col(path).alias(name) for name, path in fields.items()])


# ---- sinks ---------------------------------------------------------------
def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Small report rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_training_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The full rows and a projection on the feature columns, each as CSV."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/full")
    df.select(*columns).write.mode("overwrite").option("header", True).csv(f"{path}/features")


# ---- updates by key ------------------------------------------------------
def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """Both tables with one row per key, the newest."""
    return first_per_key(old.unionByName(new), keys, newest_first)


def absent_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The new rows whose key is not in the old table."""
    return new.join(old.select(*keys).distinct(), keys, "left_anti")


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Drop the old rows of every key in ``new``, then add the new rows."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)
