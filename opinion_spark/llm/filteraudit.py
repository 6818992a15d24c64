"""Filter interaction audit: every order of a few filters from one Gray-code walk over their subsets."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import SPACE
from opinion_spark.session import materialize

LETTERS = "ABCDE"
DUPLICATE = 4  # the bit of E, which needs the whole table; the others are read off one text


def text_failures(text: Column) -> list[Column]:
    """A to D of one text: too short, repetitive, shouting, odd signs. Null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    n = F.size(words)
    return [n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n,
            100 * F.regexp_count(t, F.lit("[A-Z]")) > 5 * F.char_length(t), t.rlike(r"[#$%&*|]")]


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters that they fail.

    Copies are told by the SHA-256 of the text. Rows with equal digest, part and
    labels are counted together before copies meet, so a text with millions of
    copies sends a row per part and label on; the first id of a digest is then
    known from these few rows.
    """
    found = text_failures(F.col(text_col))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(found)), F.lit(0))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        mask.cast("int").alias("mask"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"))
    # rows without an id match no label; they are spread by digest and not sent to one task
    rows = rows.withColumn("known", F.col("id").isNotNull()).withColumn("at", F.coalesce("id", F.xxhash64("digest")))
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("at")).agg(
        F.coalesce(F.max("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic")).withColumn("known", F.lit(True))
    alike = ["digest", "mask", "part", "good", "toxic"]
    single = rows.join(told, ["at", "known"], "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}).groupBy(*alike, "id").agg(F.count("*").alias("c"))
    groups = materialize(single.groupBy(*alike).agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("c")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c"))).alias("first")))
    lowest = groups.groupBy("digest").agg(F.min("first.id").alias("low"))
    passing = F.col("unnamed") + F.when(F.col("first.id") == F.col("low"), F.col("first.c")).otherwise(0)
    split = groups.join(lowest, "digest").withColumn("p", passing).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("p").alias("n")),
            F.struct(F.col("mask").bitwiseOR(1 << DUPLICATE).alias("mask"), (F.col("n") - F.col("p")).alias("n"))))
        .alias("cell")).select("part", "good", "toxic", "cell.*")
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Survivors under every subset of filters; ``cells`` has a row of counts for each failure mask.

    One filter is switched at a time. Each cell counts its failures among the
    filters that are on; its rows leave the survivors as the counter leaves zero
    and come back as it returns there. Row s of the result is the state with the
    filters of the bits of s.
    """
    masks = np.arange(len(cells))
    active, alive = np.zeros(len(cells), np.int64), cells.sum(0)
    states = np.zeros_like(cells)
    states[0] = alive
    on = 0
    for step in range(1, len(cells)):
        bit = (step & -step).bit_length() - 1
        on ^= 1 << bit
        fails = (masks >> bit & 1).astype(bool)
        if on >> bit & 1:
            alive = alive - cells[fails & (active == 0)].sum(0)
            active[fails] += 1
        else:
            active[fails] -= 1
            alive = alive + cells[fails & (active == 0)].sum(0)
        states[on] = alive
    return states


def order_steps(cells: np.ndarray, letters: str = LETTERS) -> pd.DataFrame:
    """All orders and steps of one part: differences of the stored states, nothing is filtered again.

    ``cells``: a row (n, good, toxic) for each mask.
    """
    states = gray_walk(cells)
    bits = range(len(letters))
    rows = []
    for order in permutations(bits):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            lost = states[before] - states[after]
            rows.append(("".join(letters[b] for b in order), step, f, states[after][0], *lost))
            before = after
    out = pd.DataFrame(rows, columns=["filter_order", "step", "f", "kept", "removed", "good_lost", "toxic_lost"])
    masks = np.arange(len(cells))
    fails = np.array([cells[(masks >> f & 1) == 1, 0].sum() for f in bits])
    out["redundant"] = fails[out["f"]] - out["removed"]
    out["unique_fails"] = np.array([cells[1 << f, 0] for f in bits])[out["f"]]
    out["shapley"] = out.groupby("f")["removed"].transform("sum")
    return out.drop(columns="f")


STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def audit_cells(cells: DataFrame, letters: str = LETTERS, measures: Sequence[str] = ("n", "good", "toxic")) -> DataFrame:
    """One row per part, order and step from at most 2^filters cells a part."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        full = np.zeros((1 << len(letters), len(measures)), np.int64)
        full[rows["mask"].to_numpy()] = rows[list(measures)].to_numpy()
        return order_steps(full, letters).assign(part=key[0])[[c.split()[0] for c in STEPS.split(", ")]]

    return cells.groupBy("part").applyInPandas(run, STEPS)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """What each of the filters A to E removes in each of their 120 orders, by part.

    Texts are read once, for the failure masks; a part is then 32 cells, and the
    walk over the 32 subsets answers all 600 steps. Null texts are empty, null
    parts are the part ''. A row without an id is no copy of others and makes none;
    rows that repeat an id and a text are no copies of each other. Of labels that
    repeat an id the largest count; labels of unknown ids are not read, nor are
    other columns. An empty table has no parts and gives no rows.
    """
    return audit_cells(materialize(failure_cells(docs, labels, id_col, text_col, part_col)))
