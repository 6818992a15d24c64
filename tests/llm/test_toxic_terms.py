"""The lexicon automaton against plain edit distance and enumeration, long runs, and folds."""

from __future__ import annotations

import time
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_spark.llm import langid, toxicity
from opinion_spark.llm.common import fold


def one_edit(a, b):
    """One insertion, deletion, substitution or swap of neighbours makes b of a."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[at + 1:] == b[at + 1:] or a[at:at + 2] == b[at:at + 2][::-1] and a[at + 2:] == b[at + 2:]
    a, b = sorted((a, b), key=len)
    return a[at:] == b[at + 1:]


def test_find_against_edit_distance():
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abc"), rng.integers(3, 9))): float(rng.integers(3, 20)) for _ in range(60)}
    trie = toxicity.Trie(words, {})
    tries = ["".join(rng.choice(list("abcd"), rng.integers(1, 10))) for _ in range(3000)] + list(words)
    for w in tries:
        near = max((x for t, x in words.items() if len(t) >= toxicity.FUZZY_FROM and one_edit(t, w)), default=0.0)
        assert trie.find(w) == (words.get(w, 0.0), near), w


def masked_plainly(words, stems, run, start):
    """Every way to read signs as a letter or as nothing, tried in turn."""
    best = (0.0, start)
    for end in range(start + 1, len(run) + 1):
        piece = run[start:end]
        if piece.isalnum() or not piece[-1].isalnum() or (end < len(run) and run[end].isalnum()):
            continue
        weight = 0.0
        for kept in product((False, True), repeat=sum(not c.isalnum() for c in piece)):
            kept, pattern = iter(kept), []
            for c in piece:
                if c.isalnum():
                    pattern.append(c)
                elif next(kept):
                    pattern.append(None)
            for terms, whole in ((words, True), (stems, False)):
                for t, w in terms.items():
                    head = pattern[:len(t)]
                    if (len(pattern) == len(t) if whole else len(head) == len(t)) and all(
                            p is None or p == x for p, x in zip(head, t)):
                        hidden = head.count(None)
                        if len(head) - hidden >= max(2, hidden):
                            weight = max(weight, w)
        if weight > best[0]:
            best = (weight, end)
    return best


def test_masked_against_enumeration():
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("ab"), rng.integers(3, 7))): float(rng.integers(3, 20)) for _ in range(8)}
    stems = {"abba": 9.5, "bab": 4.5}
    trie = toxicity.Trie(words, stems)
    for _ in range(1500):
        run = "".join(rng.choice(list("aab-*"), rng.integers(1, 9)))
        for start in range(len(run)):
            if run[start].isalnum():
                assert trie.masked(run, start) == masked_plainly(words, stems, run, start), (run, start)


@pytest.mark.parametrize("part, tail", [("a-", "a"), ("stem-", "x"), ("-", "b"), ("stemx*", ""), ("a--b", "-"), ("grum-", "pf")])
def test_long_masked_runs_take_linear_time(part, tail):
    rng = np.random.default_rng(1)
    words = {"".join(rng.choice(list("abcdefgmprstu"), rng.integers(4, 12))): 5.0 for _ in range(2000)} | {"grumpf": 8.0}
    trie = toxicity.Trie(words, {"stem": 6.0, "gru": 3.0})

    def took(n):
        begin = time.perf_counter()
        toxicity._hits("a" + part * n + tail, trie, {})
        return time.perf_counter() - begin
    took(500)
    assert took(20_000) < 1 + 40 * took(1_000)


def test_labels_of_held_out_rows_change_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    learn = fold(F.col("doc_id"), 3) != 1
    turned = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxicity.toxicity(docs, toxicity.fit(docs, x, learn)).select("doc_id", "score").collect() for x in (labels, turned))
    assert sorted(one) == sorted(other)

    known = fold(F.col("doc_id"), 4) != 2
    mixed = docs.withColumn("lang", F.when(known, F.col("lang")).otherwise(F.lit("xx")))
    one, other = (langid.language(docs, langid.fit(x, known)).select("doc_id", "lang_pred", "score").collect() for x in (docs, mixed))
    assert sorted(one) == sorted(other)
