"""Mix sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.llm.common import WORD
from opinion_spark.session import materialize

KEY_BITS = 30            # binary places of a sampling key
LEVELS = (28, 14, 0)     # shifts of the three cuts of a key


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def sampling_key(identity: Column, weight: Column, seed: int) -> Column:
    """Exponential key -ln(u) / weight of Efraimidis and Spirakis, as a whole number.

    ``u`` comes from the md5 of seed and identity, so that runs agree.
    """
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")))
                                    .cast("binary")), 1, 12), 16, 10).cast("double")
    u = (bits + F.lit(1.0)) / F.lit(float(2**48))
    return F.floor(-F.log(u) / weight * F.lit(float(2**KEY_BITS))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take ``weights`` in turn. The targets
    share the sum of all sizes by weight; one that passes ``max_epochs`` times its
    source is held there and the excess goes to the others by weight. Sorted by
    size for weight, the sources held come first, so one pass finds them. The
    windows hold one row per source.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(every) - 1) % len(weights)
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    asked = sizes.select("source", "source_size", share.alias("w")).withColumns({
        "most": F.col("source_size").cast("double") * max_epochs,
        "total": F.sum("source_size").over(Window.partitionBy()).cast("double")})
    by_room = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, Window.unboundedFollowing)
    asked = asked.select(
        "*", F.row_number().over(by_room).alias("place"),
        ((F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(onward)).alias("each"))
    held = F.col("most") <= F.col("w") * F.col("each")
    first = F.min(F.when(~held, F.struct("place", "each"))).over(Window.partitionBy())
    return asked.select("source", "source_size", F.when(held, F.col("most")).otherwise(
        F.col("w") * first["each"]).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), quality: Column | None = None, seed: int = 7,
        max_epochs: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        size_col: str | None = None) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken): how often the mix takes each row, and how many words.

    Size is the number of words, or ``size_col`` where they are counted already. A source whose target is k times its size and a
    rest takes every document k times (complete epochs) and the rest from one more
    pass: documents in the order of their exponential keys, which ``quality`` (a
    positive number; null counts as 1) brings forward, until the running size is
    as near to the rest as whole documents allow.

    The running sums are cut in three levels of the key: each level sums the sizes
    of at most a few thousand key ranges per source and goes on in the range where
    the rest runs out; only the rows of the last range, of one key, are ranked.
    Equal keys go by id, then size. No source is ever sorted or gathered whole.

    Null texts and empty texts have size 0 and take nothing. A null source is a
    source. Rows that repeat an id have one key and follow each other. An empty
    table gives no rows; sources without words have target 0.
    """
    weight = F.greatest(F.coalesce(quality.cast("double") if quality is not None else F.lit(1.0), F.lit(1.0)),
                        F.lit(1e-3))
    rows = materialize(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("skey"),
        (F.col(size_col) if size_col else n_words(F.col(text_col))).alias("size"), sampling_key(F.col(id_col), weight, seed).alias("key")))
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    plan = materialize(targets(sizes, weights, max_epochs).withColumns({
        "skey": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long")}).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))

    cut = plan.select("skey", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("passed"), "rest")
    last = None
    for shift in LEVELS:
        inside = rows.join(cut, "skey")
        if last is not None:
            inside = inside.where(F.shiftright("key", last) == F.col("at"))
        ranges = inside.groupBy("skey", F.shiftright("key", shift).alias("range")).agg(
            F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("passed").alias("passed"))
        upto = Window.partitionBy("skey").orderBy("range")
        ranges = ranges.withColumn("till", F.col("passed") + F.sum("size").over(upto))
        over = ranges.where(F.col("till") > F.col("rest")).groupBy("skey").agg(
            F.min("range").alias("at"), F.min(F.col("till") - F.col("size")).alias("passed"),
            F.first("rest").alias("rest"))
        cut, last = materialize(over), shift
    edge = rows.join(cut, "skey").where(F.col("key") == F.col("at"))
    run = Window.partitionBy("skey").orderBy("id", "size")
    ranked = edge.withColumn("till", F.col("passed") + F.sum("size").over(
        run.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.select("id", "skey", "size", "key", (
        F.col("till") - F.col("size") / 2 <= F.col("rest")).alias("picked"))
    clear = rows.drop("source").join(cut.select("skey", "at"), "skey", "left").where(
        F.col("at").isNull() | (F.col("key") != F.col("at"))).select(
        "id", "skey", "size", "key", (F.col("at").isNotNull() & (F.col("key") < F.col("at"))).alias("picked"))
    copies = F.col("epochs") + F.when(F.col("picked"), 1).otherwise(0)
    return clear.union(ranked).join(plan, "skey").select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"))
