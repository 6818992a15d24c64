"""Source divergence audit: term distributions of sources compared through bitsets of equal counts."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.operators.ranking import top_per_key
from opinion_spark.session import materialize

BITS = 64            # terms of a bitset word
WORDS = 64           # words compared in one call
TILE = 128           # sources on a side of a call
HELD = 200_000       # terms that a counting task holds before it sends them on
CELLS = 1 << 21      # cells of a product held at once
SCALE = 1_000_000_000
SMOOTH = 5

# letters stay, A-Z as a-z; other ASCII separates terms; bytes of longer characters stay
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters and of characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and document counts of the terms of each (lang, source), added up within the task.

    What is held is sent on when it reaches ``HELD`` terms; the empty term stands
    for the group itself.
    """
    held: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def sent() -> pa.RecordBatch:
        names = [(lang, source, term, n, docs[term]) for (lang, source), (found, docs) in held.items()
                 for term, n in found.items()]
        held.clear()
        lang, source, term, n, docs = zip(*names) if names else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
             pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            found, docs = held[lang.as_py(), source.as_py()]
            words = terms(text.as_py())
            size -= len(found)
            found.update(words)
            found[b""] += 0
            docs.update(set(words))
            size += len(found)
            if size >= HELD:
                yield sent()
                size = 0
                found = docs = None
    if held:
        yield sent()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs); a row with the empty term for each group that occurs."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return plain.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)) in exact decimals."""
    whole = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", (whole(count) + SMOOTH) * F.lit(SCALE), whole(total + SMOOTH * kept)) + 1


def numbered(vocabulary: DataFrame) -> DataFrame:
    """(lang, term, lang_n, slice, word, bit): a place for each kept term.

    Terms are dealt to ranges by falling count, so that the terms of a word have
    few different counts; each range numbers its own terms.
    """
    ranged = vocabulary.repartitionByRange("lang", F.desc("lang_n"), "term").withColumn("range", F.spark_partition_id())
    at = F.row_number().over(Window.partitionBy("lang", "range").orderBy(F.desc("lang_n"), "term")) - 1
    word = F.floor(F.col("at") / BITS)
    return ranged.withColumn("at", at).select(
        "lang", "term", "lang_n", F.concat_ws(".", "range", F.floor(word / WORDS)).alias("slice"),
        (word % WORDS).cast("int").alias("word"), (F.col("at") % BITS).cast("int").alias("bit"))


def _joint(levels: pd.DataFrame, groups: pd.DataFrame) -> np.ndarray:
    """Sums of |p - q| over the terms of some words for each pair of groups (rows of ``groups``).

    ``levels``: word, g (row of groups), p, bits: the terms of a word that have one
    count in a group; those that a group lacks are the complement. AND and popcount of
    two levels is the number of terms in their joint cell.
    """
    size, zero = len(groups), groups["p"].to_numpy()
    total = np.zeros((size, size), np.int64)
    word = levels["word"].to_numpy()
    order = np.lexsort((levels["g"].to_numpy(), word))
    word, g = word[order], levels["g"].to_numpy()[order]
    bits, p = levels["bits"].to_numpy()[order].view(np.uint64), levels["p"].to_numpy()[order]
    cuts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1], [True])))
    full = levels["full"].to_numpy()[order].view(np.uint64)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        lacking = np.full(size, full[lo])
        np.bitwise_and.at(lacking, g[lo:hi], ~bits[lo:hi])
        owner = np.concatenate((g[lo:hi], np.arange(size)))
        by = np.argsort(owner, kind="stable")
        owner, b = owner[by], np.concatenate((bits[lo:hi], lacking))[by]
        q = np.concatenate((p[lo:hi], zero))[by]
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        step = max(1, CELLS // len(owner))
        for at in range(0, len(owner), step):
            cell = np.bitwise_count(b[at:at + step, None] & b[None]) * np.abs(q[at:at + step, None] - q[None])
            np.add.at(total, owner[at:at + step], np.add.reduceat(cell, starts, axis=1))
    return total


def _pair_sums(key: tuple, levels: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Of one slice the sums for the pairs between the sources of two tiles."""
    lang, _, x, y = key
    kinds = {"lang": object, "a": object, "b": object, "value": "int64"}
    if levels.empty or len(groups) < 2:
        return pd.DataFrame({c: [] for c in kinds}).astype(kinds)
    groups = groups.sort_values("source").reset_index(drop=True)
    place = pd.Series(groups.index, groups["source"])
    total = _joint(levels.assign(g=place[levels["source"]].to_numpy()), groups)
    names, tile = groups["source"].to_numpy(dtype=object), groups["tile"].to_numpy()
    a, b = np.nonzero(np.triu(np.ones_like(total), 1))
    if x != y:
        across = tile[a] != tile[b]
        a, b = a[across], b[across]
    return pd.DataFrame({"lang": lang, "a": names[a], "b": names[b], "value": total[a, b]}).astype(kinds)


def _to_tiles(df: DataFrame, tiles: DataFrame) -> DataFrame:
    """A copy of each row for each pair of tiles that its own is part of; up to ``TILE`` sources there is one."""
    return df.join(tiles, "lang").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns(
        {"x": F.least("tile", "other"), "y": F.greatest("tile", "other")}).drop("other", "tiles")


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of a language differ in their terms.

    Each language keeps the terms of at least ``least_docs`` of its documents. In
    part ``pair`` the item is each other source of the language, the value the
    sum of |p - q| over all kept terms; in part ``term`` the items are the ``top`` terms
    that the source has and uses most above its language. p is the smoothed
    share in whole billionths, plus one.

    Tasks count the terms of their texts by group; a term is then a bit, and the
    terms that have one count in a group are a bitset, cut into words. Two groups'
    joint cells are AND and popcount of their bitsets, times |p - q| of the two
    counts; absent terms are the complement. Words are compared in slices of
    4,096 terms and tiles of ``TILE`` sources, and only sums leave a task.

    Null text, lang and source are ''. Rows count each by itself, repeated or not; ids
    and other columns are not read. A group without terms has counts of zero. A
    language with one source has no pairs; without kept terms all values are 0.
    An empty table gives no rows.
    """
    counts = materialize(term_counts(docs))
    worded = counts.where("term != ''")
    vocabulary = materialize(numbered(worded.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(F.col("d") >= least_docs).drop("d")))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    placed = materialize(worded.join(vocabulary, ["lang", "term"]).drop("docs"))
    totals = placed.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("lang").orderBy("source")  # a row per source
    groups = materialize(counts.where("term = ''").select("lang", "source").join(
        totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
        .withColumn("tile", F.floor((F.row_number().over(order) - 1) / TILE).cast("int")))

    rated = placed.join(groups.drop("tile"), ["lang", "source"]).withColumn(
        "p", probability(F.col("n"), F.col("total"), F.col("kept")))
    above = rated.withColumn("value", F.col("p") - probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
    terms_ = top_per_key(above.where("value > 0").select("lang", "source", F.col("term").alias("item"), "value"),
                         ["lang", "source"], [F.desc("value"), F.col("item")], top).withColumn("part", F.lit("term"))

    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    full = vocabulary.groupBy("lang", "slice", "word").agg(F.bit_or(one).alias("full"))
    levels = rated.groupBy("lang", "slice", "word", "source", "n").agg(
        F.bit_or(one).alias("bits"), F.first("p").alias("p")).join(
        groups.select("lang", "source", "tile"), ["lang", "source"]).join(full, ["lang", "slice", "word"])
    slices = full.select("lang", "slice").distinct()
    zeros = groups.where("kept > 0").select("lang", "source", "tile", probability(
        F.lit(0), F.col("total"), F.col("kept")).alias("p")).join(slices, "lang")
    keys = ["lang", "slice", "x", "y"]
    sums = _to_tiles(levels, tiles).select(*keys, "source", "word", "p", "bits", "full").groupBy(*keys).cogroup(
        _to_tiles(zeros, tiles).select(*keys, "source", "tile", "p").groupBy(*keys)).applyInPandas(
        _pair_sums, "lang string, a string, b string, value long")
    none = groups.where("kept = 0").select("lang", "source")
    named = none.select("lang", F.col("source").alias("b"))
    empty = none.withColumnRenamed("source", "a").join(named, "lang").where("a < b").withColumn("value", F.lit(0))
    pairs = materialize(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).unionByName(empty))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    mirrored = pairs.select("lang", F.explode(both).alias("s"), "value").select(
        "lang", "s.source", "s.item", "value", F.lit("pair").alias("part"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return mirrored.unionByName(terms_.select(*mirrored.columns)).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), place.cast("int").alias("rank"))
