"""Validation reports and data-quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X
from opinion_spark.operators.aggregates import null_cells
from opinion_spark.operators.dedup import duplicate_rows
from opinion_spark.schemas import REQUIRED_REVIEW_COLUMNS


def n_rows() -> Column:
    return F.count(F.lit(1))


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (X.strip(F.col(c).cast("string")) == "")


def _missing(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def review_report(df: DataFrame, date: str | None = "review_date") -> DataFrame:
    """One row: totals, error and warning counts, valid rows, quality figures."""
    missing = [c for c in ("product_id", "rating", "review_text") if c not in df.columns]
    if missing:
        return df.agg(n_rows().alias("total_rows"), F.lit(f"Missing required columns: {missing}").alias("error"))
    good_rating = F.coalesce(F.col("rating").between(1, 5), F.lit(False))
    bad_date = F.lit(False)
    if date and date in df.columns:
        bad_date = F.try_to_timestamp(F.col(date).cast("string")).isNull()
    row = df.agg(
        n_rows().alias("total_rows"),
        F.count_if(good_rating & ~_missing("product_id") & ~_blank("review_text")).alias("valid_rows"),
        F.count_if(~good_rating).alias("invalid_ratings"),
        F.count_if(_missing("product_id")).alias("missing_product_ids"),
        F.count_if(_blank("review_text")).alias("empty_texts"),
        F.count_if(bad_date).alias("invalid_dates"),
        F.avg(F.length("review_text")).alias("avg_review_length"),
        (null_cells(df) / (n_rows() * len(df.columns)) * 100).alias("missing_pct"))
    flag = lambda c: (F.col(c) > 0).cast("int")
    return row.withColumns({
        "errors": flag("invalid_ratings"),
        "warnings": flag("missing_product_ids") + flag("empty_texts") + flag("invalid_dates"),
        "duplicate_rows": duplicate_rows(df).scalar()})


def product_report(df: DataFrame) -> DataFrame:
    """One row: totals, duplicate ids, missing names, valid rows."""
    row = df.agg(
        n_rows().alias("total_rows"), F.count_if(~_missing("product_id") & ~_blank("name")).alias("valid_rows"),
        F.count_if(_blank("name")).alias("missing_names"))
    per_id = df.groupBy("product_id").agg(n_rows().alias("n"))
    return row.withColumn("duplicate_ids", per_id.agg(F.sum(F.col("n") - 1).alias("d")).scalar())


def validation_report(df: DataFrame, kind: str = "review") -> DataFrame:
    """Report by data type, with the columns and their types."""
    report = review_report(df) if kind == "review" else product_report(df)
    return report.withColumns({
        "data_type": F.lit(kind), "columns": F.array(*[F.lit(f"{c}: {t}") for c, t in df.dtypes])})


def dataset_checks(df: DataFrame) -> DataFrame:
    """(check_name, passed, message) rows; the figures come from one pass."""
    missing = [c for c in REQUIRED_REVIEW_COLUMNS if c not in df.columns]
    whole = dict(df.dtypes).get("rating") in ("int", "bigint", "smallint", "tinyint")
    def has(c: str) -> bool:
        return c in df.columns
    rating = F.col("rating") if has("rating") else F.lit(None).cast("int")
    text = F.col("review_text") if has("review_text") else F.lit(None).cast("string")
    facts = df.agg(
        n_rows().alias("n"), F.bool_and(F.coalesce(rating.between(1, 5), F.lit(False))).alias("in_range"),
        F.coalesce(F.avg(F.length(text)), F.lit(0.0)).alias("length"), F.count_distinct(rating).alias("ratings"))
    def check(name: str, passed: Column, message: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), message.alias("message"))
    length = F.format_string("%.1f", F.col("length"))
    checks = [
        check("required_columns", F.lit(not missing), F.lit(
            f"Missing columns: {missing}" if missing else "All required columns present")),
        check("data_types", F.lit(whole) & F.coalesce("in_range", F.lit(False)), F.lit(
            "Rating column has valid integers 1-5" if whole else "Invalid rating data type")),
        check("non_empty", F.col("n") > 0, F.when(F.col("n") > 0, F.concat(
            F.lit("Food reviews dataset has "), F.col("n"), F.lit(" rows"))).otherwise("Dataset is empty"))]
    if has("review_text"):
        checks.append(check("text_quality", F.col("length") >= 20, F.when(F.col("length") >= 20, F.concat(
            F.lit("Average food review length: "), length, F.lit(" chars"))).otherwise(F.concat(
                F.lit("Food reviews too short: "), length, F.lit(" chars")))))
    if has("rating"):
        checks.append(check("rating_distribution", F.col("ratings") >= 3, F.concat(
            F.lit("Distinct ratings: "), F.col("ratings"))))
    return facts.select(F.inline(F.array(*checks)))


def completeness(df: DataFrame) -> DataFrame:
    return df.agg((1 - null_cells(df) / (n_rows() * len(df.columns))).alias("completeness"))


def consistency(df: DataFrame) -> DataFrame:
    rating = F.coalesce(F.col("rating").between(1, 5), F.lit(False)).cast("int")
    length = F.coalesce(F.length("review_text").between(10, 5000), F.lit(False)).cast("int")
    return df.agg(((F.avg(rating) + F.avg(length)) / 2).alias("consistency"))


def timeliness(df: DataFrame, date: str, as_of: str) -> DataFrame:
    """Falls from 1 to 0 in the year after the newest date."""
    days = F.datediff(F.lit(as_of).cast("date"), F.max(date))
    return df.agg(F.greatest(F.lit(0.0), 1 - days / 365).alias("timeliness"), days.alias("days_old"))


def overall_quality(df: DataFrame, date: str, as_of: str, accuracy: float = 0.8) -> DataFrame:
    """The four scores and their mean, from one pass. Accuracy is an input."""
    rating = F.coalesce(F.col("rating").between(1, 5), F.lit(False)).cast("int")
    length = F.coalesce(F.length("review_text").between(10, 5000), F.lit(False)).cast("int")
    days = F.datediff(F.lit(as_of).cast("date"), F.max(date))
    row = df.agg(
        (1 - null_cells(df) / (n_rows() * len(df.columns))).alias("completeness"),
        ((F.avg(rating) + F.avg(length)) / 2).alias("consistency"), F.lit(accuracy).alias("accuracy"),
        F.greatest(F.lit(0.0), 1 - days / 365).alias("timeliness"))
    parts = ["completeness", "consistency", "accuracy", "timeliness"]
    return row.withColumn("overall", sum((F.col(c) for c in parts), F.lit(0.0)) / len(parts))


def text_quality_share(df: DataFrame) -> DataFrame:
    """Share of texts without issue and mean score."""
    scored = df.select(X.quality_issues(F.col("review_text")).alias("issues"))
    return scored.agg(
        n_rows().alias("rows"), F.avg((F.size("issues") == 0).cast("int")).alias("valid_share"),
        F.avg(X.quality_score(F.col("issues"))).alias("avg_score"))


def final_report(original: DataFrame, cleaned: DataFrame, date: str) -> DataFrame:
    """One row of retention and business figures, with the five most reviewed products."""
    row = cleaned.agg(
        n_rows().alias("final_records"), F.avg("rating").alias("avg_rating"),
        F.count_distinct("product_id").alias("products"), F.count_distinct("user_id").alias("users"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.avg(F.length("review_text")).alias("avg_review_length"))
    top = cleaned.groupBy("product_id").agg(n_rows().alias("n")).orderBy(F.desc("n"), "product_id").limit(5)
    names = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "product_id"))).alias("t"))
    row = row.withColumns({
        "original_records": original.agg(n_rows().alias("n")).scalar(), "t": names.scalar()})
    return row.withColumns({
        "retention_rate": F.col("final_records") / F.col("original_records"),
        "most_reviewed": F.array_join(F.transform("t", lambda s: s["product_id"].cast("string")), ",")}).drop("t")


def pass_summary(checks: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pass rate of checks and its verdict."""
    rate = F.col("pass_rate")
    return checks.groupBy(*keys).agg(
        n_rows().alias("total"), F.count_if("passed").alias("passed_checks"),
        F.avg(F.col("passed").cast("int")).alias("pass_rate")).withColumn(
        "verdict", F.when(rate == 1, "ALL_PASS").when(rate >= 0.8, "MOSTLY_PASS").otherwise("FAILED"))


def secret_scan(df: DataFrame, id_col: str, text: str, patterns: list[tuple[str, str]] = L.SECRET_PATTERNS) -> DataFrame:
    """Credentials in a text table: one row per match with line, type and preview.

    Lines are scanned one by one, so a match cannot span lines. A cheap first
    filter keeps only lines that can match before the patterns run in full.
    """
    lines = df.select(id_col, F.posexplode(F.split(text, "\n")).alias("pos", "line_text"))
    any_of = "(?i)" + "|".join(f"(?:{p})" for _, p in patterns)
    found = F.array(*[
        F.struct(
            F.lit(i).alias("pattern_no"), F.lit(kind).alias("secret_type"),
            F.regexp_extract_all("line_text", F.lit(f"(?i)({p})"), F.lit(1)).alias("hits"))
        for i, (kind, p) in enumerate(patterns)])
    hits = lines.where(F.rlike("line_text", F.lit(any_of))).select(
        id_col, (F.col("pos") + 1).alias("line"), F.explode(found).alias("f"))
    return hits.select(
        id_col, "line", F.col("f.pattern_no").alias("pattern_no"), F.col("f.secret_type").alias("secret_type"),
        F.explode("f.hits").alias("hit")).select(
        id_col, "line", "pattern_no", "secret_type", X.preview(F.col("hit"), 50).alias("match"))
