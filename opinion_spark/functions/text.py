"""Column functions over review text. All are native expressions except the
HTML-unescape / NFKD step, which no built-in covers, and ``words_and_hits``."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from opinion_spark.functions import lexicons as L

# Whitespace as a Unicode-aware split sees it: (?U) widens \s, which misses only
# the four separators. Spelling the ranges out instead is ten times slower.
BLANKS = r"\s\x1c-\x1f"
SPACE = f"(?U)[{BLANKS}]"
WORD = f"(?U)[^{BLANKS}]+"
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000")
ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]"


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def per(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


# ---- counts and ratios ---------------------------------------------------
def word_count(t: Column) -> Column:
    return matches(t, WORD)


def sentence_runs(t: Column) -> Column:
    """Runs of closing punctuation, plus one."""
    return matches(t, r"[.!?]+") + 1


def sentence_dots(t: Column) -> Column:
    """Dots plus one."""
    return matches(t, r"\.") + 1


def sentence_pieces(t: Column) -> Column:
    """Non-blank pieces between dots."""
    return matches(t, f"(?U)[^.]*[^.{BLANKS}][^.]*")


def avg_word_length(t: Column) -> Column:
    return per(F.length(F.regexp_replace(t, SPACE, "")), word_count(t))


def punctuation_ratio(t: Column) -> Column:
    return per(matches(t, ASCII_PUNCTUATION), F.length(t))


def mark_ratio(t: Column) -> Column:
    return per(matches(t, r"[!?.,;:]"), F.length(t))


def capital_ratio(t: Column) -> Column:
    """Capitals among letters."""
    return per(matches(t, r"\p{Lu}"), matches(t, r"\p{L}"))


def marks(t: Column) -> Column:
    """The dots, exclamation and question marks and capitals of a text alone: what counts these reads a short text then."""
    return F.regexp_replace(t, r"[^.!?\p{Lu}]+", "")


def of_marks(marks: Column, char: str) -> Column:
    """How often a character occurs, in the short text that ``marks`` gives."""
    return F.length(marks) - F.length(F.replace(marks, F.lit(char), F.lit("")))


def capitals_of_marks(marks: Column) -> Column:
    return F.length(marks) - of_marks(marks, ".") - of_marks(marks, "!") - of_marks(marks, "?")


def caps_ratio(t: Column) -> Column:
    """Capitals among all characters."""
    return matches(t, r"\p{Lu}") / F.greatest(F.length(t), F.lit(1))


def exclamation_ratio(t: Column) -> Column:
    return per(matches(t, "!"), F.length(t))


def repeated_words(t: Column) -> Column:
    """Number of distinct lower-cased words that occur more than once.

    One pass over the sorted words: a word counts at its second occurrence.
    """
    words = F.sort_array(F.regexp_extract_all(F.lower(t), F.lit(f"({WORD})"), F.lit(1)))
    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("n"))

    def step(acc: Column, word: Column) -> Column:
        run = F.when(acc["word"] == word, acc["run"] + 1).otherwise(1)
        return F.struct(
            word.alias("word"), run.alias("run"),
            (acc["n"] + F.when(run == 2, 1).otherwise(0)).alias("n"))

    return F.aggregate(words, start, step, lambda acc: acc["n"])


def token_count(t: Column) -> Column:
    """Words and single punctuation marks."""
    return matches(F.lower(t), r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")


def avg_token_length(t: Column) -> Column:
    return per(F.length(F.regexp_replace(t, r"\s", "")), token_count(t))


def phrase_hits(t: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur in the text (not how often)."""
    hits = F.lit(0)
    for phrase in phrases:
        hits = hits + F.contains(t, F.lit(phrase)).cast("int")
    return hits


def words_and_hits(low: Column, lists: dict[str, list[str]]) -> Column:
    """``word_count`` of a lower-cased text and ``phrase_hits`` of each list as one struct, in one pass.

    A split without a separator cuts at ``BLANK_CHARS``, as ``WORD`` does.
    """
    names = ["word_count", *lists]

    @F.pandas_udf(", ".join(f"{name} int" for name in names))
    def count(texts: pd.Series) -> pd.DataFrame:
        there = texts[texts.notna()]
        rows = [(len(x.split()), *(sum(p in x for p in phrases) for phrases in lists.values())) for x in there]
        return pd.DataFrame(rows, index=there.index, columns=names, dtype="Int32").reindex(texts.index)

    return count(low)


def polarity(t: Column) -> Column:
    """Lexicon score s / sqrt(s^2 + 15) in (-1, 1)."""
    low = F.lower(t)
    s = (phrase_hits(low, L.SENTIMENT_POSITIVE) - phrase_hits(low, L.SENTIMENT_NEGATIVE)).cast("double")
    return s / F.sqrt(s * s + F.lit(15.0))


# ---- cleaning ------------------------------------------------------------
@F.pandas_udf(StringType())
def unescape_nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda s: unicodedata.normalize("NFKD", html.unescape(s)), na_action="ignore")


URL = (r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+")


def strip_patterns(t: Column) -> Column:
    """Whitespace, URLs, mail addresses, punctuation runs and odd characters."""
    t = F.trim(F.regexp_replace(t, f"{SPACE}+", " "))
    t = F.regexp_replace(t, URL, "")
    t = F.regexp_replace(t, r"\S+@\S+", "")
    t = F.regexp_replace(t, "!{2,}", "!")
    t = F.regexp_replace(t, r"\?{2,}", "?")
    t = F.regexp_replace(t, r"\.{3,}", "...")
    return F.regexp_replace(t, r"""[^\p{L}\p{N}_\s.,!?'"-]""", "")


def expand_contractions(t: Column, pairs: list[tuple[str, str]] | None = None) -> Column:
    for short, full in pairs or L.CONTRACTIONS:
        t = F.replace(t, F.lit(short), F.lit(full))
    return t


def clean_text(t: Column) -> Column:
    """Full normaliser; null becomes ''."""
    return expand_contractions(strip_patterns(unescape_nfkd(F.coalesce(t, F.lit("")))))


def ascii_text(t: Column) -> Column:
    squeezed = F.trim(F.regexp_replace(t, f"{SPACE}+", " "))
    return F.trim(F.regexp_replace(squeezed, r"[^\x00-\x7F]", ""))


def is_valid_review(t: Column, min_length: int = 10) -> Column:
    """Long enough and free of scrape spam."""
    return F.coalesce(
        (F.length(strip(t)) >= min_length) & (phrase_hits(F.lower(t), L.SCRAPE_SPAM) == 0),
        F.lit(False))


def contains_ignore_case(t: Column, query: str) -> Column:
    """LIKE '%query%' without case; % and _ in the query are plain characters."""
    safe = query.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.ilike(t, F.lit(f"%{safe}%"))


# ---- parsing -------------------------------------------------------------
def numbers_in(t: Column) -> Column:
    return F.transform(
        F.regexp_extract_all(t, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)), lambda x: x.cast("double"))


def whole_number(x: Column) -> Column:
    """A number rounded to the nearest whole one, halves to even, as text; beyond 64 bits in all its digits."""
    return F.when(F.abs(x) < 2.0 ** 63, F.bround(x).try_cast("long").cast("string")).otherwise(F.format_string("%.0f", x))


def normalize_rating(t: Column) -> Column:
    """First number of a rating text, brought to the 1-5 scale."""
    n = F.try_element_at(numbers_in(t), F.lit(1))
    return (
        F.when(n <= 1, F.greatest(F.lit(1), (n * 5).cast("int")))
        .when(n <= 5, n.cast("int"))
        .when(n <= 10, (n / 2).cast("int"))
        .when(n <= 100, (n / 20).cast("int"))
    )


def scraped_date(t: Column) -> Column:
    """The date after the last ' on ', as in '... on January 15, 2025'."""
    return F.try_to_timestamp(F.element_at(F.split(t, " on "), -1), F.lit("MMMM d, yyyy")).cast("date")


def helpful_votes(t: Column) -> Column:
    first = F.regexp_extract(t, r"(\d+)", 1)
    many = F.contains(t, F.lit("people found this helpful")) & (first != "")
    return (
        F.when(many, F.expr("0").cast("int") + first.try_cast("int"))
        .when(F.contains(t, F.lit("One person found this helpful")), 1)
        .otherwise(0)
    )


def safe_user_id(t: Column, length: int | None = None) -> Column:
    """Letters, digits, ``_`` and ``-`` stay; with a length, users who share their first characters become one."""
    safe = F.regexp_replace(t, r"[^\p{L}\p{N}_\-]", "_")
    return safe if length is None else F.substring(safe, 1, length)


def clean_title(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"[1-5]\.0 out of 5 stars", ""))


def preview(t: Column, size: int = 100) -> Column:
    return F.when(F.length(t) > size, F.concat(F.substring(t, 1, size), F.lit("..."))).otherwise(t)


# ---- text quality --------------------------------------------------------
REPEATED = r"(?s)([^\n])\1{5,}"


def quality_issues(t: Column) -> Column:
    """Array of the issues found in a text."""
    size = F.length(strip(t))
    letters = F.rlike(t, F.lit(r"\p{L}"))
    # what is left once all runs of plain characters are gone
    odd = per(F.length(F.regexp_replace(t, f"(?U)[a-zA-Z0-9.,!?{BLANKS}]+", "")), F.length(t))
    return F.array_compact(F.array(
        F.when(size < 10, F.lit("Too short (< 10 characters)"))
        .when(size > 5000, F.lit("Too long (> 5000 characters)")),
        F.when(~F.rlike(t, F.lit("[a-zA-Z]")), F.lit("No alphabetic characters")),
        F.when(F.rlike(F.lower(t), F.lit(REPEATED)), F.lit("Excessive repeated characters")),
        F.when((F.length(t) > 20) & letters & (F.upper(t) == t), F.lit("All caps text")),
        F.when(odd > 0.3, F.lit("Too many special characters")),
    ))


# ---- fixed values: points lost per issue --------------------------------
ISSUE_PENALTY = {
    "Too short (< 10 characters)": 30,
    "Too long (> 5000 characters)": 10,
    "No alphabetic characters": 50,
    "Excessive repeated characters": 20,
    "All caps text": 15,
    "Too many special characters": 25,
}


def quality_score(issues: Column) -> Column:
    """100 minus the penalties of the issues, at least 0."""
    score = F.lit(100)
    for issue, penalty in ISSUE_PENALTY.items():
        score = score - F.when(F.array_contains(issues, issue), penalty).otherwise(0)
    return F.greatest(score, F.lit(0))
