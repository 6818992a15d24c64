"""Exact duplicates: look-ups in a minimal perfect hash over known digests."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import SPACE
from opinion_spark.session import materialize

BLOCK_KEYS = 512   # digests per block of the hash, on average
BUCKET_KEYS = 4    # digests that share one displacement, on average
MAX_SEEDS = 2000  # few are tried in full blocks; small ones try more, and quickly
PRIME, STRIDE = 2**31 - 1, 1_640_531_527  # products of a residue and 28 bits stay below 2^59

BLOCKS = ("block long, m int, buckets int, seed int, d0 array<int>, d1 array<int>, "
          "slot_digest array<binary>, slot_winner array<long>, slot_chars array<long>, slot_rows array<long>")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(id, chars, sha): length in code points, SHA-256 of the text without ASCII white space; then the columns ``more``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.char_length(text).cast("long").alias("chars"),
        F.sha2(F.regexp_replace(text, SPACE, ""), 256).alias("sha"), *more)


def winners(rows: DataFrame) -> DataFrame:
    """(sha, winner, chars, rows): of each digest the longest row, then the smallest id."""
    longest = rows.groupBy("sha").agg(F.max("chars").alias("chars"), F.count("*").alias("rows"))
    same = rows.groupBy("sha", "chars").agg(F.min("id").alias("winner"))
    return longest.join(same, ["sha", "chars"])


def _word(sha, i: int):
    """28 bits of a digest, from seven of its hex digits."""
    return F.conv(F.substring(sha, 7 * i + 1, 7), 16, 10).cast("long")


def _spread(base, turn, seed):
    """A value below ``PRIME`` that every seed changes whatever the number of slots, in Python, numpy and columns alike."""
    return (base + (seed * STRIDE + 1) % PRIME * turn) % PRIME


def _place(m: int, buckets: int, words: list, seed) -> tuple:
    """(bucket, f1, f2) of the six words of a digest."""
    return (_spread(words[1], words[5], seed) % buckets, _spread(words[2], words[3], seed) % m,
            _spread(words[4], words[5], seed) % m)


def displacements(words: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(seed, d0, d1, slot of each key) of one block: hash and displace, fullest buckets first.

    A key's slot is (f1 + d0 * f2 + d1) mod m with the two displacements of its
    bucket; all d1 of one d0 are tried at once against the slots still free.
    """
    m = len(words)
    buckets = max(1, -(-m // BUCKET_KEYS))
    shift = np.arange(m)
    for seed in range(MAX_SEEDS):
        at, f1, f2 = _place(m, buckets, list(words.T), seed)
        members = pd.Series(np.arange(m)).groupby(at).agg(list)
        order = members.map(len).sort_values(ascending=False, kind="stable").index
        free, slots = np.ones(m, bool), np.zeros(m, np.int64)
        d0, d1 = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for bucket in order:
            keys = members[bucket]
            for step in range(m if len(keys) > 1 else 1):
                base = (f1[keys] + step * f2[keys]) % m
                if len(set(base.tolist())) < len(keys):
                    continue
                fits = free[(base[:, None] + shift) % m].all(0)
                if fits.any():
                    d0[bucket], d1[bucket] = step, fits.argmax()
                    slots[keys] = (base + d1[bucket]) % m
                    free[slots[keys]] = False
                    break
            else:
                break  # another seed
        else:
            return seed, d0, d1, slots
    raise ValueError("no perfect hash was found: repeated digests in one block")


def _build(block: pd.DataFrame) -> pd.DataFrame:
    words = block[[f"w{i}" for i in range(6)]].to_numpy(np.int64)
    seed, d0, d1, slots = displacements(words)
    placed = block.iloc[np.argsort(slots)]
    winner = [None if pd.isna(x) else int(x) for x in placed["winner"]]
    return pd.DataFrame([{
        "block": int(block["block"].iloc[0]), "m": len(block), "buckets": len(d0), "seed": seed,
        "d0": d0.tolist(), "d1": d1.tolist(), "slot_digest": [bytes(x) for x in placed["digest"]],
        "slot_winner": winner, "slot_chars": placed["chars"].tolist(), "slot_rows": placed["rows"].tolist()}])


def perfect_hash(known: DataFrame) -> tuple[DataFrame, int]:
    """(blocks, number of blocks) of a minimal perfect hash over ``winners`` rows.

    Every digest has a slot of its own and there are no empty slots; a slot holds
    the full digest, the winner's id, its length and its number of rows. Blocks
    are built independently, each from about ``BLOCK_KEYS`` digests whatever the
    size of the table. An empty table gives no blocks.
    """
    number = max(1, known.count() // BLOCK_KEYS)
    keyed = known.select(
        F.pmod(_word(F.col("sha"), 0) * 268_435_456 + _word(F.col("sha"), 6), F.lit(number)).alias("block"),
        F.unhex("sha").alias("digest"), F.col("winner").cast("long").alias("winner"), "chars", "rows",
        *[_word(F.col("sha"), i).alias(f"w{i}") for i in range(6)])
    return materialize(keyed.groupBy("block").applyInPandas(_build, BLOCKS)), number


def look_up(rows: DataFrame, blocks: DataFrame, number: int) -> DataFrame:
    """``rows`` with ``member``, ``winner``, ``winner_chars`` and ``known_rows`` of their slot.

    A row is a member if the digest in its slot is its own, byte for byte. The
    join on the block is split by Spark where copies crowd one block.
    """
    sha = F.col("sha")
    at = rows.withColumn("block", F.pmod(_word(sha, 0) * 268_435_456 + _word(sha, 6), F.lit(number)))
    w = [_word(sha, i) for i in range(6)]
    bucket, f1, f2 = _place(F.col("m"), F.col("buckets"), w, F.col("seed").cast("long"))
    bucket = bucket.cast("int")
    slot = ((f1 + F.get("d0", bucket) * f2 + F.get("d1", bucket)) % F.col("m")).cast("int")
    member = F.coalesce(F.get("slot_digest", slot) == F.unhex(sha), F.lit(False))
    return at.join(blocks, "block", "left").select(
        *rows.columns, member.alias("member"), F.when(member, F.get("slot_winner", slot)).alias("winner"),
        F.when(member, F.get("slot_chars", slot)).alias("winner_chars"),
        F.when(member, F.get("slot_rows", slot)).alias("known_rows"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     history: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without ASCII white space. Of a group
    the row with the most code points stays, then the one with the smallest id.
    ``history`` (columns sha, winner, chars, rows, as ``winners`` returns) names
    texts seen before: their repeats are removed and ``keep_id`` is the old
    winner, group_size counts old and new rows; texts it does not know are grouped
    among themselves. Without it the table is its own history: all its digests
    are indexed and every row is looked up.

    Null texts count as empty; empty texts are one group. Rows that repeat an id
    are rows of their own with the same decision (``keep_rows`` keeps one of
    them). Rows with a null id lose to others of equal length; a group of null
    ids alone has a null ``keep_id`` and its rows are kept. Other columns are not
    read. An empty table gives no rows.
    """
    rows = materialize(digests(docs, id_col, text_col))
    own = history is None
    blocks, number = perfect_hash(materialize(winners(rows)) if own else history)
    found = materialize(look_up(rows, blocks, number))
    strangers = winners(found.where(~F.col("member"))).select(
        "sha", F.col("winner").alias("new_winner"), F.col("rows").alias("new_rows"))
    members = found.where("member")
    if own:
        known = members.select("id", F.col("winner").alias("keep_id"), F.col("known_rows").alias("group_size"), "sha")
    else:
        seen = members.groupBy("sha").agg(F.count("*").alias("more"))
        known = members.join(seen, "sha").select(
            "id", F.col("winner").alias("keep_id"), (F.col("known_rows") + F.col("more")).alias("group_size"), "sha")
    new = found.where(~F.col("member")).join(strangers, "sha").select(
        "id", F.col("new_winner").alias("keep_id"), F.col("new_rows").alias("group_size"), "sha")
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    told = known.withColumn("kept", kept if own else F.lit(False)).union(new.withColumn("kept", kept))
    return told.select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"))


def merged_duplicates(docs: DataFrame, history: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, as ``exact_duplicates``, where the rows of the condition ``history`` came first.

    The perfect hash holds the digests of the history alone. All rows are looked
    up: those of the history find their own slot, later rows either a slot whose
    digest is theirs, byte for byte, or none. Texts without a slot are grouped
    among themselves. A later row that is longer than its slot's winner, or as
    long with a smaller id, takes its place, so the decisions are those of all
    rows at once, whichever rows are the history.

    Rows for which ``history`` is null count as later ones. Null and empty texts,
    repeated and null ids are treated as in ``exact_duplicates``; without history,
    or with nothing but history, the result is the same. An empty table gives no rows.
    """
    old = F.coalesce(history, F.lit(False))
    rows = materialize(digests(docs.withColumn("__old", old), id_col, text_col, "__old"))
    blocks, number = perfect_hash(materialize(winners(rows.where("__old"))))
    found = materialize(look_up(rows, blocks, number))
    later = materialize(winners(found.where(~F.col("__old"))).select(
        "sha", F.col("winner").alias("__id"), F.col("chars").alias("__chars"), F.col("rows").alias("__rows")))
    at = found.join(later, "sha", "left")  # one row per digest of later rows
    longer = F.col("__chars") > F.col("winner_chars")
    smaller = (F.col("__chars") == F.col("winner_chars")) & (
        F.col("winner").isNull() | (F.col("__id") < F.col("winner")))
    new = ~F.col("member") | F.coalesce(longer | smaller, F.lit(False))
    keep = F.when(new, F.col("__id")).otherwise(F.col("winner"))
    size = F.coalesce("known_rows", F.lit(0)) + F.coalesce("__rows", F.lit(0))
    return at.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), size.cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id and text are kept; of rows that repeat both, the longest text.

    Rows that share an id, or have none, are told apart by their digest, so that
    different texts all stay. Rows equal in id, digest and length are taken in the
    order of their columns as JSON.
    """
    wanted = materialize(decisions.where("kept").groupBy(
        F.col(id_col).alias("__keep"), F.col("text_sha256").alias("__keep_sha")).agg(F.count("*").alias("__rows")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = docs.withColumn("__sha", F.sha2(F.regexp_replace(text, SPACE, ""), 256)).join(
        wanted, F.col(id_col).eqNullSafe(F.col("__keep")) & (F.col("__sha") == F.col("__keep_sha")), "left_semi")
    if wanted.where("__rows > 1").isEmpty():
        return kept.drop("__sha")
    row = F.struct(*docs.columns)
    return kept.groupBy(id_col, "__sha").agg(
        F.max_by(row, F.struct(F.char_length(text), F.to_json(row))).alias("__row")).select("__row.*")
