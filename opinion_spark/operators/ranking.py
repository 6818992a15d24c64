"""Ranks, running totals and exact samples that never sort one hot group in one task.

A plain ``row_number() over (partition by k order by v)`` puts all rows of a key
into one task. Here the rows are stored in ranges of key and value, the ranges
are counted with map-side combining, and only one row per range is accumulated.
A row's place is what its key gathered in the ranges before plus its place
inside its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.session import materialize

_ONE = "__all"


def _with_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    return (df, keys) if keys else (df.withColumn(_ONE, F.lit(1)), [_ONE])


def hash_order(id_col: str, seed: str = "") -> Column:
    """Hex text that orders rows at random but the same in every run."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark turns the rank filter into a group limit that also runs before the
    shuffle, so each map task sends at most one row per key.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key; each map task sends at most ``n`` per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")


_PART, _AT = "__bucket", "__at"
_IN_PART = (1 << 33) - 1  # monotonically_increasing_id keeps the row's place in its partition below this bit


def ranged(df: DataFrame, by: list[str], buckets: int | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop``, stored in ascending order of ``by``, nulls first, with its bucket and its place inside it.

    Spark cuts the rows into ranges of about equal size; a key that holds many rows gets
    several ranges, and rows that agree in all of ``by`` share one.
    """
    cut = df.repartitionByRange(*([buckets] if buckets else []), *by).sortWithinPartitions(*by)
    stored = materialize(cut.drop(*drop).withColumn(_AT, F.monotonically_increasing_id()))
    return stored.withColumn(_PART, F.shiftright(_AT, 33)).withColumn(_AT, F.col(_AT).bitwiseAND(F.lit(_IN_PART)))


def _carried(totals: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """(bucket, __key, __<m>): what the key that opens a bucket has gathered in the buckets before it.

    ``totals`` has one row per bucket and key, and the place of the key's first
    row. Only the first and the last key of a bucket can go on beyond it, so the
    windows run over one row per bucket.
    """
    key = F.struct(*keys)
    ends = totals.groupBy(_PART).agg(
        F.min_by(key, _AT).alias("first"),
        F.max_by(F.struct(key.alias("key"), *measures), _AT).alias("last"))
    same = Window.partitionBy("last.key").orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gathered = ends.select(_PART, "first", F.struct(
        F.col("last.key").alias("key"), *[F.sum(f"last.{m}").over(same).alias(m) for m in measures]).alias("upto"))
    before = gathered.withColumn("upto", F.lag("upto").over(Window.orderBy(_PART)))
    return materialize(before.where(F.col("first").eqNullSafe(F.col("upto.key"))).select(
        _PART, F.col("first").alias("__key"), *[F.col(f"upto.{m}").alias(f"__{m}") for m in measures]))


def _add_carried(rows: DataFrame, carried: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Add what was carried into a bucket to the columns of the rows of the key that opens it."""
    opens = F.struct(*keys).eqNullSafe(F.col("__key"))
    return rows.join(carried, _PART, "left").withColumns({
        column: F.col(column) + F.when(opens, F.col(f"__{m}")).otherwise(F.lit(0)) for column, m in measures.items()
    }).drop("__key", _PART, _AT, _ONE, *[f"__{m}" for m in measures.values()])


def running_totals(
    df: DataFrame, keys: list[str], order_col: str, measures: list[str], buckets: int | None = None
) -> DataFrame:
    """Add ``<m>_upto``, the total of each measure up to and including the row.

    ``df`` must hold one row per (keys, order_col), as after a groupBy. The rows
    lie in ranges of (keys, order_col); any cut gives the same, exact totals.
    """
    df, keys = _with_keys(df, keys)
    rows = ranged(df, [*keys, order_col], buckets)
    totals = rows.groupBy(_PART, *keys).agg(F.min(_AT).alias(_AT), *[F.sum(m).alias(m) for m in measures])
    inside = Window.partitionBy(_PART, *keys).orderBy(_AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = rows.withColumns({f"{m}_upto": F.sum(m).over(inside) for m in measures})
    return _add_carried(added, _carried(totals, keys, measures), keys, {f"{m}_upto": m for m in measures})


def row_index(df: DataFrame, keys: list[str], order_col: str, id_col: str, name: str = "row_index",
              buckets: int | None = None) -> DataFrame:
    """Add the 0-based place of each row by (order_col, md5(id), id) within its key; null values come first.

    Ties of ``order_col`` follow the md5 of the id, so a hot value is cut into as
    many ranges as its rows ask for.
    """
    df, keys = _with_keys(df, keys)
    rows = ranged(df.withColumn("__hash", hash_order(id_col)), [*keys, order_col, "__hash", id_col], buckets, ("__hash",))
    totals = rows.groupBy(_PART, *keys).agg(F.min(_AT).alias(_AT), F.count(F.lit(1)).alias("n"))
    if keys == [_ONE]:  # the place inside the range is known from the stored order
        placed = rows.withColumn(name, F.col(_AT))
    else:
        placed = rows.withColumn(name, F.row_number().over(Window.partitionBy(_PART, *keys).orderBy(_AT)) - 1)
    return _add_carried(placed.withColumn(name, F.col(name).cast("long")),
                        _carried(totals, keys, ["n"]), keys, {name: "n"})


def _hash_parts(df: DataFrame, id_col: str, seed: str) -> DataFrame:
    return df.withColumn("__hash", hash_order(id_col, seed)).withColumn(
        "__part", F.coalesce(F.substring("__hash", 1, 3), F.lit("")))  # rows without an id come first and are never drawn


def _cut_parts(parts: DataFrame, strata: list[str], quota: Column) -> DataFrame:
    """Per stratum and hash bucket, up to the one in which the sample ends, the rows that the sample takes
    from it: all of them (null) or, from the last bucket, the first ``__left``. ``quota`` is a column over ``n``
    (rows of the stratum) and ``total`` (rows of all strata). A stratum has at most 4096 buckets, so rows that
    are joined to these by stratum and bucket never meet in one task by stratum."""
    counts = materialize(parts.groupBy(*strata, "__part").agg(F.count(F.lit(1)).alias("c")))
    sizes = counts.groupBy(*strata).agg(F.sum("c").alias("n"))
    total = counts.agg(F.sum("c").alias("total"))
    quotas = sizes.withColumn("total", total.scalar()).select(
        *strata, F.least("n", quota.cast("long")).alias("__quota"))
    upto = Window.partitionBy(*strata).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("__upto") - F.col("c")
    return materialize(
        counts.withColumn("__upto", F.sum("c").over(upto)).join(quotas, strata).where(start < F.col("__quota"))
        .select(*strata, "__part", F.when(F.col("__upto") >= F.col("__quota"), F.col("__quota") - start).alias("__left")))


def sample_exact(df: DataFrame, strata: list[str], quota: Column, id_col: str, seed: str = "") -> DataFrame:
    """Exactly the quota of rows of each stratum, the first by hash of id and seed.

    One pass counts hash buckets, one pass keeps the rows up to the last bucket;
    only these rows, no more than the sample and one bucket, are ranked.
    """
    keyed, keys = _with_keys(df, strata)
    parts = _hash_parts(keyed, id_col, seed)
    near = parts.join(_cut_parts(parts, keys, quota), [*keys, "__part"]).where("__hash IS NOT NULL")
    place = Window.partitionBy(*keys, "__part").orderBy("__hash", id_col)
    return (
        near.withColumn("__place", F.row_number().over(place))
        .where(F.col("__left").isNull() | (F.col("__place") <= F.col("__left")))
        .select(*df.columns))


def mark_sample(
    df: DataFrame, strata: list[str], quota: Column, id_col: str, seed: str = "", name: str = "sampled"
) -> DataFrame:
    """All rows, with a flag that is true for exactly the quota of each stratum."""
    keyed, keys = _with_keys(df, strata)
    parts = _hash_parts(keyed, id_col, seed)
    cuts = _cut_parts(parts, keys, quota)
    edge = parts.select(*keys, id_col, "__hash", "__part").join(
        cuts.where("__left IS NOT NULL"), [*keys, "__part"]).where("__hash IS NOT NULL")
    place = Window.partitionBy(*keys, "__part").orderBy("__hash", id_col)
    here = F.struct(F.col("__hash").alias("h"), F.col(id_col).alias("i"))
    last = edge.withColumn("__place", F.row_number().over(place)).where(F.col("__place") == F.col("__left")).select(
        *keys, "__part", here.alias("__last"))
    marks = materialize(cuts.join(last, [*keys, "__part"], "left").select(
        *keys, "__part", F.col("__left").isNull().alias("__whole"), "__last"))
    return parts.join(marks, [*keys, "__part"], "left").withColumn(
        name, F.coalesce(F.col("__whole") | (here <= F.col("__last")), F.lit(False))).select(*df.columns, name)
