"""Toxicity: a lexicon trie read through Levenshtein automata, hits weighed in context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.session import materialize

SIGN = r"[^\w\s\"“”„«»‹›'’]|_"  # may mask a letter, or stand between two
TOKEN = re.compile(rf"[^\W_]+(?:(?:{SIGN})+[^\W_]+)*|[\"“”„«»‹›]")
WORD = re.compile(r"[^\W_]+")
CLOSED_BY = {"\"": "\"", "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹"}
QUOTES = frozenset(CLOSED_BY)
PARAGRAPH = re.compile(r"\n[^\S\n]*\n")
SQL_TOKEN = r"[\p{L}\p{N}]+"
WINDOW = 12            # words before a hit that are its context
FUZZY_FROM = 5         # letters from which a term is also found with one edit
STEM_FROM = 4          # letters of the shortest stem
MIN_DOCS = 3           # toxic documents that a term must occur in
MIN_ODDS = 3.0         # least log odds of a term
MAX_WORDS_KEPT = 300_000
MAX_RUN_KEPT = 40      # letters and signs of the longest masked word whose hits are kept
MAX_STATES = 200_000


class Trie:
    """Lexicon words and stems; ``find`` runs the automaton of all strings one edit away.

    The automaton is the intersection of the trie with the Levenshtein automata
    of its words, made deterministic step by step: a state is the set of (node,
    edits made, letter owed) that the letters read so far allow, and each new
    (state, letter) is worked out once and kept. A swap of neighbours is one edit:
    its first letter owes the second. A stem also accepts every word that goes on.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], edits: int = 1):
        self.edges: list[dict[str, int]] = [{}]
        self.word: list[float | None] = [None]
        self.stem: list[float | None] = [None]
        self.depth = [0]
        self.longest = [0]
        for store, terms in ((self.word, words), (self.stem, stems)):
            for term, weight in sorted(terms.items()):
                node = 0
                for letter in term:
                    self.longest[node] = max(self.longest[node], len(term))
                    if letter not in self.edges[node]:
                        self.edges[node][letter] = len(self.edges)
                        self.edges.append({})
                        self.word.append(None)
                        self.stem.append(None)
                        self.depth.append(self.depth[node] + 1)
                        self.longest.append(0)
                    node = self.edges[node][letter]
                self.longest[node] = max(self.longest[node], len(term))
                store[node] = weight
        self.edits = edits
        self.usual: frozenset[str] = frozenset()  # words of clean texts, one edit from a listed one
        self._forget()

    def _forget(self) -> None:
        self.sets: list[frozenset] = []
        self.known: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.out: list[tuple[float, float]] = []
        self.start = self._state(self._closed({(0, 0, "")}))

    def _closed(self, pairs: set) -> frozenset:
        """With the letters of the lexicon that a misspelling leaves out."""
        todo, done = list(pairs), set(pairs)
        while todo:
            node, edits, owed = todo.pop()
            if not owed and edits < self.edits and self.longest[node] >= FUZZY_FROM:
                for child in self.edges[node].values():
                    if (child, edits + 1, "") not in done and self.longest[child] >= FUZZY_FROM:
                        done.add((child, edits + 1, ""))
                        todo.append((child, edits + 1, ""))
        best: dict[tuple[int, str], int] = {}
        for node, edits, owed in done:
            best[node, owed] = min(edits, best.get((node, owed), 9))
        return frozenset((node, edits, owed) for (node, owed), edits in best.items())

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.known:
            self.known[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.steps.append({})
            ends = [(n, e) for n, e, owed in pairs if not owed]
            exact = [store[n] for n, e in ends for store in (self.word, self.stem) if e == 0 and store[n] is not None]
            near = [self.word[n] for n, e in ends if e and self.word[n] is not None and self.depth[n] >= FUZZY_FROM]
            self.out.append((max(exact, default=0.0), max(near, default=0.0)))
        return self.known[pairs]

    def _step(self, state: int, letter: str) -> int:
        after: set[tuple[int, int, str]] = set()
        for node, edits, owed in self.sets[state]:
            if owed:
                if owed == letter:
                    after.add((node, edits, ""))
                continue
            child = self.edges[node].get(letter)
            if child is not None:
                after.add((child, edits, ""))
            if edits == 0 and self.stem[node] is not None:
                after.add((node, 0, ""))  # a stem goes on
            if edits < self.edits and self.longest[node] >= FUZZY_FROM:
                after.add((node, edits + 1, ""))
                for first, c in self.edges[node].items():
                    if self.longest[c] >= FUZZY_FROM:
                        after.add((c, edits + 1, ""))
                        swapped = self.edges[c].get(letter)
                        if swapped is not None and first != letter and self.longest[swapped] >= FUZZY_FROM:
                            after.add((swapped, edits + 1, first))
        to = self.steps[state][letter] = self._state(self._closed(after))
        return to

    def find(self, word: str) -> tuple[float, float]:
        """(weight if listed or on a stem, weight if one edit from a word); 0: no."""
        if len(self.sets) > MAX_STATES:
            self._forget()
        state, steps = self.start, self.steps
        for letter in word:
            to = steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if not self.sets[state]:
                break
        return self.out[state]

    def masked(self, run: str, start: int) -> tuple[float, int]:
        """(weight, end) of the heaviest term written from ``start`` on with signs between its letters; 0: none.

        Each sign stands for one letter or for none. At least two letters and half
        of the term must be shown, and the term must end where a part of the run ends.
        A term has few letters and each part shows one at least, so a call reads a few parts of the
        run; a stem once met waits for the next end of a part, and signs that add nothing
        are passed over, so a run takes time in proportion to its length.
        """
        found, signs, stem = (0.0, start), False, 0.0
        states = {(0, 0): 0}  # node, letters masked -> letters shown
        at = start
        while at < len(run) and (states or stem > found[0]):
            letter, after = run[at], {}
            shows = letter.isalnum()
            signs = signs or not shows
            for (node, hidden), shown in states.items():
                if shows:
                    child = self.edges[node].get(letter)
                    to = [] if child is None else [(child, hidden, shown + 1)]
                else:
                    to = [(node, hidden, shown)] + [(c, hidden + 1, shown) for c in self.edges[node].values()]
                for n, h, k in to:
                    after[n, h] = max(k, after.get((n, h), 0))
            if not shows and after == states:
                while at + 1 < len(run) and not run[at + 1].isalnum():
                    at += 1
            states = after
            stem = max([stem, *(self.stem[n] for (n, h), k in states.items() if self.stem[n] is not None and k >= max(2, h))])
            if signs and shows and (at + 1 == len(run) or not run[at + 1].isalnum()):
                weight = max((self.word[n] for (n, h), k in states.items() if self.word[n] is not None and k >= max(2, h)),
                             default=0.0)
                if max(weight, stem) > found[0]:
                    found = (max(weight, stem), at + 1)
            at += 1
        return found


@dataclass
class Model:
    """Lexicon with log odds, words that only look misspelled, and the logistic weights of a document's features."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    usual: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0] * N_FEATURES)
    bias: float = -8.0


N_FEATURES = 4
CAP, UNIT = 60.0, 5.0   # log odds at which a feature stops growing, and its unit
PRIOR = np.array([2.0, 1.5, 0.2, 0.5])  # weights to which little data leave the fit
_TRIES: dict[int, tuple[Trie, dict]] = {}


def _lookup(token: str, trie: Trie, seen: dict) -> tuple[float, float]:
    hit = seen.get(token)
    if hit is None:
        if len(seen) > MAX_WORDS_KEPT:
            seen.clear()
        hit = trie.find(token)
        hit = seen[token] = (hit[0], 0.0) if token in trie.usual else hit
    return hit


def _hits(run: str, trie: Trie, seen: dict) -> list[tuple[float, float]]:
    """(listed, misspelled) weights of each word of a run; a masked word counts at its first part.

    A word with signs between its letters is read as one, as a misspelling, where
    it weighs more than each of its parts by itself.
    """
    key = ("masked", run)
    if key in seen:
        return seen[key]
    parts = list(WORD.finditer(run))
    hits = [_lookup(m[0], trie, seen) for m in parts]
    n = 0
    while n < len(parts) - 1:
        weight, end = trie.masked(run, parts[n].start())
        last = n
        while last + 1 < len(parts) and parts[last + 1].end() <= end:
            last += 1
        if weight / 2 > max(max(hit[0], hit[1] / 2) for hit in hits[n:last + 1]):
            hits[n:last + 1] = [(0.0, weight)] + [(0.0, 0.0)] * (last - n)
            n = last
        n += 1
    if len(run) <= MAX_RUN_KEPT and len(seen) <= MAX_WORDS_KEPT:
        seen[key] = hits
    return hits


def _pairs(text: str, marks: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Quotations as (words before the opening mark, words before the closing one), apart and ascending.

    ``marks``: place in the text, mark, words before it. A mark closes the last
    open one of its form, at any distance; straight marks pair within a paragraph,
    in turn where the letters next to them don't tell which way they face. A mark
    that stands alone, as one for inches, has no effect.
    """
    breaks = [m.start() for m in PARAGRAPH.finditer(text)] if any(mark == "\"" for _, mark, _ in marks) else []
    paragraph = 0
    opened: dict[str, list[int]] = {mark: [] for mark in CLOSED_BY}
    pairs = []
    for at, mark, words in marks:
        while paragraph < len(breaks) and breaks[paragraph] < at:
            paragraph += 1
            opened["\""].clear()
        before = at > 0 and text[at - 1].isalnum()
        after = at + 1 < len(text) and text[at + 1].isalnum()
        closed = max((o for o in opened if opened[o] and mark in CLOSED_BY[o]), key=lambda o: opened[o][-1], default=None)
        if mark == "\"" and after and not before:
            opened[mark][:] = [words]
        elif closed:
            pairs.append((opened[closed].pop(), words))
        elif (after and not before) if mark in "”»›" else (after or not before):  # those three open rarely
            opened[mark].append(words)
    apart: list[tuple[int, int]] = []
    for start, end in sorted(pairs):
        if apart and start <= apart[-1][1]:
            apart[-1] = (apart[-1][0], max(end, apart[-1][1]))
        else:
            apart.append((start, end))
    return apart


def features(text: str, trie: Trie, seen: dict) -> tuple[float, ...]:
    """Sums over the whole text: listed hits, misspelled hits, quoted hits, and the worst window.

    A hit between an opening and its closing quotation mark counts as quoted: it
    is spoken about. The worst window is the largest sum of unquoted weights within
    ``WINDOW`` words, which tells abuse from a single word.
    """
    text = text.lower()
    hits: list[tuple[int, tuple[float, float]]] = []
    marks: list[tuple[int, str, int]] = []
    place = 0
    for m in TOKEN.finditer(text):
        token = m[0]
        if token in QUOTES:
            marks.append((m.start(), token, place))
            continue
        for hit in [_lookup(token, trie, seen)] if token.isalnum() else _hits(token, trie, seen):
            place += 1
            if hit != (0.0, 0.0):
                hits.append((place, hit))
    listed = near = quoted = worst = 0.0
    recent: list[tuple[int, float]] = []
    pairs, pair = _pairs(text, marks) if hits and marks else [], 0
    for place, hit in hits:
        weight = max(hit[0], hit[1] / 2)
        while pair < len(pairs) and pairs[pair][1] < place:
            pair += 1
        if pair < len(pairs) and pairs[pair][0] < place:
            quoted += weight
            continue
        if hit[0]:
            listed += hit[0]
        else:
            near += hit[1]
        recent = [(at, w) for at, w in recent if place - at < WINDOW] + [(place, weight)]
        worst = max(worst, sum(w for _, w in recent))
    return tuple(min(x, CAP) / UNIT for x in (listed, near, quoted, worst))


def _scorer(model: Model):
    key = hash((tuple(sorted(model.words.items())), tuple(sorted(model.stems.items())), tuple(model.usual)))
    if key not in _TRIES:
        _TRIES.clear()
        trie = Trie(model.words, model.stems)
        trie.usual = frozenset(model.usual)
        _TRIES[key] = (trie, {})
    return _TRIES[key]


def _rows(model: Model, with_features: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seen = _scorer(model)
        weights = np.array(model.weights)
        for batch in batches:
            x = np.array([features(t, trie, seen) if t else (0.0,) * N_FEATURES
                          for t in batch.column("text").to_pylist()], float).reshape(-1, N_FEATURES)
            if with_features:
                out = {"id": batch.column("id"), "y": batch.column("y")} | {
                    f"x{i}": pa.array(x[:, i]) for i in range(N_FEATURES)}
            else:
                out = {"id": batch.column("id"), "score": pa.array(1 / (1 + np.exp(-(x @ weights + model.bias))))}
            yield pa.RecordBatch.from_pydict(out)
    return run


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 2.0) -> tuple[list[float], float]:
    """Logistic regression by Newton steps, pulled towards ``PRIOR``; no weight is negative."""
    z = np.hstack([x, np.ones((len(x), 1))])
    to = np.append(PRIOR, -4.0)
    pull = np.append(np.full(x.shape[1], ridge), 0.1)
    beta = to.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (y - p) - pull * (beta - to))
        beta += np.clip(step, -2, 2)
        beta[:-1] = np.maximum(beta[:-1], 0.0)
    return beta[:-1].tolist(), float(beta[-1])


def _near(trie: Trie):
    """Rows whose term is one edit from a listed word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([trie.find(term)[1] > 0 for term in batch.column("term").to_pylist()], pa.bool_()))
    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample: int = 20_000, max_terms: int = 4_000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn lexicon and weights from the labelled rows for which ``train`` (over ``labels``) holds.

    ``sample`` bounds the labelled rows: those with the smallest md5 of the id are
    taken, so that reruns agree. A term is a word, or a stem that several words
    share, found in at least ``MIN_DOCS`` toxic documents of the sample with log
    odds of ``MIN_ODDS`` or more, and more often than chance gives any of the terms
    tried (log likelihood ratio above the log of their number). Words of two or
    more clean documents that are one edit from a term are no misspellings of it;
    ``max_terms`` bounds the lexicon. Null labels
    and ids without a document are left out; without both classes the lexicon is
    empty and every score is near 0.
    """
    chosen = labels.where(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    chosen = materialize(chosen.orderBy(F.md5(F.col("id").cast("string").cast("binary"))).limit(sample))
    texts = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), "id"))  # at most ``sample`` ids
    counts = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    if not clean or not toxic:
        return Model()
    words = texts.select("y", F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower("text"), F.lit(SQL_TOKEN), F.lit(0)))).alias("term"))
    counted = materialize(words.where(F.char_length("term") >= 3).groupBy("term").agg(
        F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"), F.lit(1).alias("forms")))
    odds = (F.log((F.col("bad") + 0.5) / (toxic + 1.0)) - F.log((F.col("good") + 0.5) / (clean + 1.0))).alias("odds")

    tried = counted.where(F.col("bad") + F.col("good") >= MIN_DOCS).count()
    share, seen = toxic / (toxic + clean), F.col("bad") + F.col("good")
    chance = F.col("bad") * F.log(F.col("bad") / seen / share) + F.when(
        F.col("good") > 0, F.col("good") * F.log(F.col("good") / seen / (1 - share))).otherwise(0.0)

    def telling(df: DataFrame) -> DataFrame:
        return df.where(F.col("bad") >= MIN_DOCS).select("term", "forms", "bad", "good", odds, chance.alias("chance")).where(
            (F.col("odds") >= MIN_ODDS) & (F.col("chance") >= math.log(max(1, tried)) + 1))

    found = telling(counted).orderBy(F.desc("chance"), "term").limit(max_terms).collect()
    stems = counted.select(F.explode(F.sequence(F.lit(STEM_FROM), F.lit(10))).alias("n"), "term", "bad", "good").where(
        F.char_length("term") >= F.col("n")).groupBy(F.expr("substring(term, 1, n)").alias("term")).agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("forms"))
    shared = telling(stems.where("forms >= 4")).orderBy(F.desc("chance"), "term").limit(max_terms).collect()
    kept: dict[str, float] = {}
    for r in shared:  # of stems within each other the one with most evidence
        if not any(r["term"].startswith(t) or t.startswith(r["term"]) for t in kept):
            kept[r["term"]] = r["odds"]
    told = {r["term"]: r["odds"] for r in found}
    # the forms of a stem stay words of their own, so that their misspellings are found; the stem is their evidence
    of_stem = F.lit(False)
    for n in sorted({len(k) for k in kept}):
        of_stem |= F.expr(f"substring(term, 1, {n})").isin([k for k in kept if len(k) == n])
    forms = counted.where(of_stem & (F.col("bad") > 0)).select("term", "bad", odds).where(
        F.col("odds") >= MIN_ODDS).orderBy(F.desc("bad"), "term").limit(25 * max_terms)
    model = Model({r["term"]: r["odds"] for r in forms.collect()} | told, kept)
    trie = Trie(model.words, model.stems)
    usual = counted.where("good >= 2").select("term", "good").mapInArrow(_near(trie), "term string, good long").orderBy(F.desc("good"), "term").limit(25 * max_terms)
    model.usual = sorted(r["term"] for r in usual.select("term", "good").collect())
    seen = texts.mapInArrow(_rows(model, True), "id long, y int, " + ", ".join(
        f"x{i} double" for i in range(N_FEATURES)))
    seen = seen.orderBy(*seen.columns).limit(sample).toPandas()  # ids that repeat add no rows
    model.weights, model.bias = _logistic(seen[[f"x{i}" for i in range(N_FEATURES)]].to_numpy(), seen["y"].to_numpy())
    return model


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): probability of abuse of every whole text; no other column is read.

    Null and empty texts have the score of a text without hits. Rows that repeat
    an id are scored one by one. An empty table gives no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(_rows(model, False), "id long, score double").withColumnRenamed("id", id_col)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity_score") -> DataFrame:
    """``docs`` with a score column, computed from the text alone."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie, seen = _scorer(model)
        weights = np.array(model.weights)
        for part in texts:
            x = np.array([features(t, trie, seen) if t else (0.0,) * N_FEATURES for t in part]).reshape(-1, N_FEATURES)
            yield pd.Series(1 / (1 + np.exp(-(x @ weights + model.bias))))

    return docs.withColumn(score_col, score(F.col(text_col).cast("string")))
