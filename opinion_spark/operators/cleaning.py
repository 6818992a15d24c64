"""Column standardisation and the cleaning steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions import labels as B
from opinion_spark.functions import lexicons as L
from opinion_spark.functions import text as X
from opinion_spark.operators import dedup
from opinion_spark.schemas import REQUIRED_REVIEW_COLUMNS
from opinion_spark.session import materialize


def standardize_columns(df: DataFrame, as_of: str) -> DataFrame:
    """Rename either source dialect to the standard names and add defaults."""
    names = {s: d for s, d in L.COLUMN_DIALECTS.items() if s in df.columns}
    df = df.withColumnsRenamed(names)
    for column, default in [("helpful_votes", 0), ("total_votes", 0), ("review_title", "")]:
        if column not in df.columns:
            df = df.withColumn(column, F.lit(default))
    return df.withColumn("date", parse_date(df, as_of))


def parse_date(df: DataFrame, as_of: str) -> Column:
    """Timestamp from epoch seconds or text; ``as_of`` when neither parses."""
    kinds = dict(df.dtypes)
    for name in ("timestamp", "date", "reviewTime"):
        kind = kinds.get(name)
        if kind is None:
            continue
        if kind in ("int", "bigint", "double", "float"):
            return B.epoch_or_text(F.col(name), None, as_of)
        if kind == "string":
            return B.epoch_or_text(None, F.col(name), as_of)
        return F.coalesce(F.col(name).cast("timestamp"), F.lit(as_of).cast("timestamp"))
    return F.lit(as_of).cast("timestamp")


def copy_columns(df: DataFrame) -> DataFrame:
    """Add standard names next to the source names, only where absent."""
    new = {d: F.col(s) for s, d in L.COPY_DIALECTS.items() if s in df.columns and d not in df.columns}
    return df.withColumns(new)


def resolve_columns(
    df: DataFrame, ids: tuple[str, ...] = ("id", "review_id", "rowid"),
    texts: tuple[str, ...] = ("review_text", "text", "content", "body"),
) -> DataFrame:
    """Find the id and text column among candidate names and rename both."""
    lower = {c.lower(): c for c in df.columns}
    id_col = next((lower[c] for c in ids if c in lower), None)
    text_col = next((lower[c] for c in texts if c in lower), None)
    if id_col is None or text_col is None:
        raise ValueError(f"no id or text column among {df.columns}")
    return df.withColumnsRenamed({id_col: "review_id", text_col: "review_text"})


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def add_missing_columns(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """Schema evolution: absent columns get a typed default."""
    return df.withColumns(
        {c: F.lit(v).cast(t) for c, (t, v) in defaults.items() if c not in df.columns})


def null_drop_counts(df: DataFrame, fields: list[str] = REQUIRED_REVIEW_COLUMNS) -> DataFrame:
    """Rows dropped by each required field, in order, from one pass."""
    kept, cols = F.lit(True), []
    for field in fields:
        cols.append(F.count_if(kept & F.col(field).isNull()).alias(f"dropped_{field}"))
        kept = kept & F.col(field).isNotNull()
    return df.agg(*cols, F.count_if(kept).alias("rows_left"))


def drop_null_required(df: DataFrame, fields: list[str] = REQUIRED_REVIEW_COLUMNS) -> DataFrame:
    return df.dropna(subset=fields)


def fill_optional(df: DataFrame, as_of: str) -> DataFrame:
    fills = {}
    for column, value in [("review_title", F.lit("")), ("helpful_votes", F.lit("0")),
                          ("total_votes", F.lit("0")), ("date", F.lit(as_of).cast("timestamp"))]:
        if column in df.columns:
            fills[column] = F.coalesce(F.col(column), value.cast(dict(df.dtypes)[column]))
    return df.withColumns(fills)


def drop_blank_text(df: DataFrame, column: str = "review_text") -> DataFrame:
    return df.where(X.strip(F.col(column)) != "")


def coerce_rating(df: DataFrame) -> DataFrame:
    """Non-numeric dropped, 1..5 kept before rounding half to even."""
    number = F.col("rating").cast("string").try_cast("double")
    return (
        df.withColumn("rating", number).where(F.col("rating").between(1, 5))
        .withColumn("rating", F.bround("rating", 0).cast("int")))


def coerce_votes(df: DataFrame) -> DataFrame:
    def vote(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)).cast("int")
    return df.withColumns({c: vote(c) for c in ("helpful_votes", "total_votes") if c in df.columns})


def repair_votes(df: DataFrame) -> DataFrame:
    """The total is never below the helpful votes."""
    return df.withColumn("total_votes", F.greatest("total_votes", "helpful_votes"))


def coerce_date(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("date", parse_date(df.drop("timestamp"), as_of))


def normalize_texts(df: DataFrame) -> DataFrame:
    """Normalise text and title."""
    texts = [c for c in ("review_text", "review_title") if c in df.columns]
    return df.withColumns({c: X.clean_text(F.col(c)) for c in texts})


def clean_texts(df: DataFrame, min_length: int = 10) -> DataFrame:
    """Normalise texts; drop reviews shorter than ``min_length`` afterwards."""
    return normalize_texts(df).where(F.length("review_text") >= min_length)


def text_length(df: DataFrame) -> Column:
    """The stored length if the table has it: narrower to read than the text."""
    return F.col("review_length") if "review_length" in df.columns else F.length("review_text")


def length_bounds(df: DataFrame, low: float = 0.005, high: float = 0.995) -> DataFrame:
    """Exact percentiles of the text length, from the counts per length."""
    lengths = df.groupBy(text_length(df).alias("n")).agg(F.count(F.lit(1)).alias("c"))
    return lengths.agg(F.percentile("n", [low, high], F.col("c")).alias("bounds"))


def drop_length_outliers(df: DataFrame, low: float = 0.005, high: float = 0.995) -> DataFrame:
    bounds = length_bounds(df, low, high)
    return (
        df.withColumn("__b", bounds.scalar())
        .where(text_length(df).between(F.col("__b")[0], F.col("__b")[1])).drop("__b"))


def drop_heavy_users(df: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Drop users with more reviews than the quantile of reviews per user."""
    per_user = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    spread = per_user.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    limit = spread.agg(F.percentile("n", F.lit(quantile), F.col("c")).alias("limit"))
    kept = per_user.where(F.col("n") <= limit.scalar()).select("user_id")
    return df.join(kept, "user_id", "left_semi")


def final_types(df: DataFrame) -> DataFrame:
    """Cast to the table types, check the required columns, drop blank rows."""
    df = require_columns(df, REQUIRED_REVIEW_COLUMNS)
    return df.withColumns({
        "rating": F.col("rating").cast("int"),
        "product_id": F.col("product_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "review_text": F.col("review_text").cast("string"),
    }).where((F.col("product_id") != "") & (F.col("user_id") != "")).transform(drop_blank_text)


def product_mean(df: DataFrame) -> DataFrame:
    """Add ``product_avg``: an aggregate joined back, so a hot product is combined
    before the shuffle and its join partition can be split at run time."""
    means = df.groupBy("product_id").agg(F.avg("rating").alias("product_avg"))
    return df.join(means, "product_id")


def rating_deviation(df: DataFrame) -> DataFrame:
    return product_mean(df).withColumn("rating_deviation", F.col("rating") - F.col("product_avg")).drop("product_avg")


def derived_features(df: DataFrame) -> DataFrame:
    """The derived columns of the cleaned review table."""
    t, h, n = F.col("review_text"), F.col("helpful_votes"), F.col("total_votes")
    return rating_deviation(df.withColumns({
        "review_length": F.length(t),
        "word_count": X.word_count(t),
        "sentence_count": X.sentence_runs(t),
        "avg_word_length": X.avg_word_length(t),
        "punctuation_ratio": X.punctuation_ratio(t),
        "capital_ratio": X.capital_ratio(t),
        "helpfulness_ratio": B.helpful_if_voted(h, n),
        "year": F.year("date"), "month": F.month("date"),
        "day_of_week": F.weekday("date"), "is_weekend": (F.weekday("date") >= 5).cast("int"),
    }))


def drop_duplicates(df: DataFrame) -> DataFrame:
    return dedup.drop_near(dedup.drop_exact(df))


def clean_reviews(df: DataFrame, as_of: str, target: int | None = None, min_length: int = 10) -> DataFrame:
    """All cleaning steps in order. ``target`` None keeps every row (no sample step).

    The normalised texts are written once; the percentile, the user counts, the
    sample and the product means then read only the narrow columns they need.
    """
    typed = (
        drop_duplicates(df)
        .transform(drop_null_required).transform(fill_optional, as_of).transform(drop_blank_text)
        .transform(coerce_rating).transform(coerce_votes).transform(repair_votes)
        .transform(coerce_date, as_of).transform(normalize_texts))
    staged = materialize(typed.withColumn("review_length", F.length("review_text")))
    kept = (
        staged.where(F.col("review_length") >= min_length)
        .transform(drop_length_outliers).transform(drop_heavy_users))
    if target is not None:
        kept = dedup.proportional_sample(kept, target)
    return kept.transform(derived_features).transform(final_types)


def cleaning_summary(original: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Retention and quality of a cleaning run; the quality may be below 0."""
    def tally(df: DataFrame, name: str) -> DataFrame:
        nulls = sum((F.col(c).isNull().cast("long") for c in REQUIRED_REVIEW_COLUMNS), F.lit(0))
        return df.agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias(f"{name}_nulls"))
    keys = ["product_id", "user_id", "review_text"]
    dups = cleaned.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("d")).agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("dups"))
    row = tally(cleaned, "final").select(
        "final_rows", "final_nulls", dups.scalar().alias("dups"),
        tally(original, "original").select("original_rows").scalar().alias("original_rows"))
    return row.select(
        "original_rows", "final_rows",
        X.per(F.col("final_rows").cast("double"), F.col("original_rows")).alias("retention_rate"),
        X.per((F.col("final_rows") - F.col("final_nulls") - F.col("dups")).cast("double"),
              F.col("original_rows")).alias("quality_score"))


def light_clean(df: DataFrame) -> DataFrame:
    """Trim, turn 'nan' into '', fill bad ratings with 0, parse dates; ids stay."""
    out = {}
    for c in ("review_text", "review_title"):
        if c in df.columns:
            t = X.strip(F.coalesce(F.col(c).cast("string"), F.lit("")))
            out[c] = F.when(t == "nan", "").otherwise(t)
    if "rating" in df.columns:
        out["rating"] = F.coalesce(F.col("rating").cast("string").try_cast("double"), F.lit(0.0)).cast("int")
    for c in ("product_id", "user_id"):
        if c in df.columns:
            out[c] = X.strip(F.coalesce(F.col(c).cast("string"), F.lit("nan")))
    if "review_date" in df.columns:
        out["review_date"] = F.try_to_timestamp(F.col("review_date").cast("string"))
    return df.withColumns(out)


def standardize_scraped(df: DataFrame) -> DataFrame:
    """Scraped frame to the review layout: total = helpful, text longer than 10."""
    text = X.strip(F.col("text"))
    return df.select(
        F.col("asin").alias("product_id"), F.col("reviewer").alias("user_id"), "rating",
        text.alias("review_text"), X.strip(F.col("title")).alias("review_title"),
        F.col("helpful").alias("helpful_votes"), F.col("helpful").alias("total_votes"),
    ).where(F.length("review_text") > 10)
