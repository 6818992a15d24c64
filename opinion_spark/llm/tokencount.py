"""Token counts by a count-only Viterbi over the matches of an Aho-Corasick automaton."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"         # stands for the space before a word
UNKNOWN_BELOW = 10.0    # an unknown character scores this much less than the worst piece
MAX_WORDS = 600_000
MARKS = ".,;:!?"

_LOADED: dict[tuple, "Counter"] = {}


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, in the order of their ids, and the unknown piece."""

    pieces: tuple[tuple[str, float], ...]
    unk_id: int


def load_vocabulary(path: str) -> Vocabulary:
    """The normal pieces of a sentencepiece file and their scores, read as unigram scores.

    Control and byte pieces match no text; they keep their places, with a string
    that no text holds.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        normal = not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        pieces.append((model.id_to_piece(i) if normal else f"\x00{i}", model.get_score(i) if normal else 0.0))
    return Vocabulary(tuple(pieces), model.unk_id())


class Counter:
    """Counts the pieces of the best segmentation, word by word."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_BELOW
        self.single = {p for p, _ in vocabulary.pieces if len(p) == 1}
        self.letters = {c for p, _ in vocabulary.pieces if p[0] != "\x00" for c in p}
        self.known: dict[str, int] = {}
        self.bonds = {p[i:i + 2] for p, _ in vocabulary.pieces if p[0] != "\x00" for i in range(len(p) - 1)}
        self.segments: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of one word, its mark included.

        The automaton enumerates the vocabulary's matches; the dynamic program
        carries, for each end, the best score, the number of pieces on that path,
        and whether it ends in an unknown character: a run of those is one piece.
        Matches are taken by start, and a path replaces another only if its score
        is higher, so of equal scores the one whose last piece starts first stays,
        as in the tokenizer. A character that no piece covers alone counts as
        unknown from its start.
        """
        core = word.rstrip(MARKS)
        if len(core) < len(word) and word[len(core) - 1:len(core) + 1] not in self.bonds:  # no piece has both
            return self.word(core) + self._segment(word[len(core):])
        if not self.letters.issuperset(word):  # no piece spans a character that none has
            return sum(1 if alien else self._segment("".join(run)) for alien, run in groupby(
                word, lambda c: c not in self.letters))
        return self._segment(word)

    def _segment(self, word: str) -> int:
        found = self.segments.get(word)
        if found is None:
            if len(self.segments) > MAX_WORDS:
                self.segments.clear()
            found = self.segments[word] = self._best(word)
        return found

    def _best(self, word: str) -> int:
        n = len(word)
        if self.single.issuperset(word):  # no unknown characters: one pass, the longest match of an end comes first
            top, pieces = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for end, (length, score) in self.automaton.iter(word):
                start = end + 1 - length
                if top[start] + score > top[end + 1]:
                    top[end + 1], pieces[end + 1] = top[start] + score, pieces[start] + 1
            return pieces[n]
        starts: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (length, score) in self.automaton.iter(word):
            starts[end - length + 1].append((length, score))
        best: list[float | None] = [None] * (n + 1)
        count, unknown = [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            here = best[at]
            if here is None:
                continue
            single = False
            for length, score in sorted(starts[at]):
                single |= length == 1
                old = best[at + length]
                if old is None or here + score > old:
                    best[at + length], count[at + length], unknown[at + length] = here + score, count[at] + 1, False
            if not single:
                old = best[at + 1]
                if old is None or here + self.unknown > old:
                    best[at + 1] = here + self.unknown
                    count[at + 1] = count[at] + (not unknown[at])
                    unknown[at + 1] = True
        return count[n]

    def text(self, text: str) -> int:
        """Pieces of a text: each space or mark starts a word, as does the text itself."""
        if not text:
            return 0
        known, total = self.known, 0
        text = text.replace(MARK, " ")
        for part in text[text[0] == " ":].split(" "):
            n = known.get(part)
            if n is None:
                if len(known) > MAX_WORDS:
                    known.clear()
                n = self.word(MARK + part)
                core = part.rstrip(MARKS)
                if core == part or core in known:  # rare words with marks after them are not kept
                    known[part] = n
            total += n
        return total


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, n_tokens): pieces of every whole text under a unigram vocabulary.

    A space becomes the mark of the word after it, the text starts with a mark, and
    no piece crosses a mark. Only counts are kept, no pieces. Null and empty texts
    have 0 tokens. Rows that repeat an id are counted one by one; null ids are
    kept. Other columns are not read. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = Counter(load_vocabulary(path))
        count = _LOADED[path].text
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
                "n_tokens": pa.array([count(t or "") for t in texts], pa.int64())})

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, n_chars long, n_tokens long").withColumnRenamed("id", id_col)
