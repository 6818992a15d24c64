"""Rows of repeated and null ids in the near-duplicate stage of the pipeline."""

from __future__ import annotations

import numpy as np


def test_near_copies_are_told_by_row(spark):
    from corpus_pipeline import drop_near_copies

    def text(seed, *last):
        rng = np.random.default_rng(seed)
        return " ".join(["".join(rng.choice(list("abcde"), 5)) for _ in range(100)] + list(last))
    rows = [(1, text(1)), (5, text(1, "x")), (5, text(2)), (None, text(3)), (None, text(3, "y")), (None, text(4)),
            (6, text(2, "z")), (7, None), (7, "")]
    data = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, component long, rows int").repartition(4)
    kept = drop_near_copies(spark, data, "")
    assert kept.columns == data.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert (1, text(1)) in left and (5, text(1, "x")) not in left
    assert sum(t in (text(2), text(2, "z")) for _, t in left) == 1
    assert sum(t in (text(3), text(3, "y")) for _, t in left) == 1
    assert (None, text(4)) in left and sum(i == 7 for i, _ in left) == 2
