"""Near duplicates: banded MinHash, sequential Bayesian verification, exact check."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from math import comb, exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import components
from opinion_spark.session import materialize

BANDS, ROWS = 32, 5     # two texts of similarity 0.8 meet in no band with probability 3e-6
BATCH = 32              # signature values compared before each decision
BITS = 128              # functions of which a band row carries one bit: the first batch
MISS = 1e-6             # chosen probability to prune a pair that is similar
STEP = 2                # words of 64 bits compared before each decision across components
WIDE = 2048             # functions of which one bit is kept to compare across components
SIDE = 512              # rows on each side of a block that is compared at once
CHUNK = 2048

_RNG = np.random.default_rng(20240229)
_STEPS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_MULT = (_RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_WIDE_MULT = (_RNG.integers(0, 2**32, WIDE, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_WIDE_ADD = _RNG.integers(0, 2**32, WIDE, dtype=np.uint64).astype(np.uint32)
_SEEDS = _RNG.integers(1, 2**63, 2, dtype=np.uint64)  # of two independent families of word hashes
_NEAR = 64                                            # places in a word that are looked up
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True

SKETCH = "id long, n_shingles long, h1 long, h2 long, sig binary, bands array<long>, x long, y long"
WIDE_SKETCH = "id long, h1 long, n_shingles long, tags binary, wide binary"
ELECTED = "key long, id long, n_shingles long, x long, y long, a long, b long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def _table(family: int) -> np.ndarray:
    """A random number for each byte at each of the first places of a word."""
    return _mix(_mix(np.arange(_NEAR * 256, dtype=np.uint64) + _SEEDS[family]) + _SEEDS[family])


def word_hashes(text: str, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, A-Z read as a-z: the sum of a random number for each byte and its place.

    Words that differ differ in some place, so they are equal here with probability
    2^-64, whatever the words are; the two families are independent of each other.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    gap = np.concatenate(([True], _SPACE[raw], [True]))
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    if not len(starts):
        return np.empty(0, np.uint64)
    at = _places(starts, len(raw))
    cell = (at << 8) | _LOWER[raw]
    values = _table(family)[cell & (_NEAR * 256 - 1)]
    far = np.flatnonzero(at >= _NEAR)
    if len(far):
        values[far] = _mix(_mix(cell[far].astype(np.uint64) + _SEEDS[family]) + _SEEDS[family])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return _mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))


def _places(starts: np.ndarray, n: int) -> np.ndarray:
    """How far each byte is from the start of its word."""
    begin = np.zeros(n, np.int64)
    begin[starts] = starts
    return np.arange(n) - np.maximum.accumulate(begin)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the distinct runs of ``width`` words, sorted; a shorter text is one run."""
    if not len(words):
        return words
    width = min(width, len(words))
    runs = len(words) - width + 1
    total = np.full(runs, width, np.uint64)
    for i in range(width):
        total += words[i:i + runs] * _STEPS[i % 64] ** np.uint64(1 + i // 64)
    return np.unique(_mix(total))


def signature(hashes: np.ndarray, mult: np.ndarray = _MULT, add: np.ndarray = _ADD) -> np.ndarray:
    """MinHash values under multiply-add functions of 32 bits."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(mult), 2**32 - 1, np.uint32)
    step = CHUNK * len(_MULT) // len(mult)
    for at in range(0, len(low), step):
        np.minimum(best, (mult[:, None] * low[at:at + step] + add[:, None]).min(1), out=best)
    return best


def sequence_hash(words: np.ndarray) -> np.int64:
    """A hash of the whole sequence of words."""
    return _mix(words ^ _mix(np.arange(1, len(words) + 1, dtype=np.uint64))).sum(dtype=np.uint64).astype(np.int64)


def band_keys(sig: np.ndarray) -> np.ndarray:
    return _mix((sig.reshape(BANDS, ROWS).astype(np.uint64) * _STEPS[:ROWS]).sum(1, dtype=np.uint64)
                + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEPS[ROWS]).astype(np.int64)


def _first_bits(sig: np.ndarray) -> np.ndarray:
    """One bit of each value, packed."""
    return np.packbits((sig >> np.uint32(16)).astype(np.uint8) & 1)


def _sketches(width: int):
    kinds = {"n_shingles": pa.int64(), "h1": pa.int64(), "h2": pa.int64(), "sig": pa.binary(),
             "bands": pa.list_(pa.int64()), "x": pa.int64(), "y": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = word_hashes(text.as_py() or "")
                sets = shingles(words, width)
                sig = signature(sets)
                short, bands = (sig >> np.uint32(16)).astype(np.uint16).tobytes(), band_keys(sig)
                h2 = sequence_hash(word_hashes(text.as_py() or "", 1))
                out.append((len(sets), sequence_hash(words), h2, short if len(sets) else None,
                            bands if len(sets) else None, *_first_bits(sig[:BITS]).view(np.int64)))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | {
                k: pa.array([row[at] for row in out], kind) for at, (k, kind) in enumerate(kinds.items())})
    return run


def _wide_sketches(width: int):
    """Set size, band keys and one bit of ``WIDE`` MinHash values."""
    kinds = {"h1": pa.int64(), "n_shingles": pa.int64(), "tags": pa.binary(), "wide": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = word_hashes(text.as_py() or "")
                sets = shingles(words, width)
                out.append((sequence_hash(words), len(sets), band_keys(signature(sets)).tobytes(),
                            _first_bits(signature(sets, _WIDE_MULT, _WIDE_ADD)).tobytes()))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | {
                k: pa.array([row[at] for row in out], kind) for at, (k, kind) in enumerate(kinds.items())})
    return run


def _full_sets(width: int):
    """Shingle sets by the second family, so that what made a pair a candidate by chance doesn't confirm it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(word_hashes(t.as_py() or "", 1), width).astype(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "shingles": pa.array(
                sets, pa.list_(pa.int64()))})
    return run


@cache
def least_matches(compared: int, threshold: float, miss: float) -> int:
    """Fewest matches of ``compared`` values that leave a similar pair likely enough.

    With a uniform prior, P(similarity >= t | m of n match) is the chance that a
    binomial of n + 1 trials with probability t is at most m.
    """
    n, chance = compared + 1, 0.0
    for m in range(compared + 1):
        chance += exp(lgamma(n + 1) - lgamma(m + 1) - lgamma(n - m + 1)
                      + m * log(threshold) + (n - m) * log(1 - threshold))
        if chance >= miss:
            return m
    return compared


def survivors(left: np.ndarray, right: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Places of the pairs (rows of both arrays) that no batch of values rules out."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for at in range(0, left.shape[1], BATCH):
        upto = min(at + BATCH, left.shape[1])
        matches = matches + (left[alive, at:upto] == right[alive, at:upto]).sum(1)
        keep = matches >= least_matches(upto, threshold, miss)
        alive, matches = alive[keep], matches[keep]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BANDS * ROWS)


def _pruned(threshold: float, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = survivors(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")), threshold, miss)
            yield batch.select(["a", "b"]).take(pa.array(kept))
    return run


@cache
def most_differing(threshold: float, miss: float) -> int:
    """Bits that may differ: a similar pair differs in more with probability ``miss`` at most."""
    chance, p = 1.0, (1 - threshold) / 2
    for d in range(BITS + 1):
        chance -= comb(BITS, d) * p**d * (1 - p) ** (BITS - d)
        if chance <= miss:
            return d
    return BITS


def _sizes_fit(a: np.ndarray, b: np.ndarray, share: int) -> np.ndarray:
    """Whether the set sizes allow the similarity, for each of a with each of b."""
    return 100 * np.minimum.outer(a, b) >= share * np.maximum.outer(a, b)


def elect(ids: np.ndarray, sizes: np.ndarray, bits: np.ndarray, most: int, share: int) -> tuple[np.ndarray, np.ndarray]:
    """The leader of each member (itself, if it leads or stands alone), by first bits and sizes.

    The member with most likely partners leads these, then the next of those left.
    """
    differ = sum(np.bitwise_count(w[:, None] ^ w[None]).astype(np.int16) for w in bits.T)
    likely = (differ <= most) & _sizes_fit(sizes, sizes, share) & (ids[:, None] != ids[None])
    lead, free = np.arange(len(ids)), likely.any(1)
    partners = np.where(free, likely.sum(1), -1)
    while (first := partners.argmax()) >= 0 and partners[first] > 0:
        to = np.flatnonzero(likely[first] & free)
        lead[to] = first
        gone = np.append(to, first)
        free[gone] = False
        partners -= likely[:, gone].sum(1)
        partners[gone] = -1
        partners[~free] = -1
    return lead


def _elections(threshold: float, miss: float):
    """Links of band members to leaders; leaders whose band goes on in another block are sent on.

    Rows come sorted by band. A block is the next ``SIDE`` rows of one band at most; the
    first and the last band of a task may go on in other tasks.
    """
    most, share = most_differing(threshold, miss), round(100 * threshold)
    fields = [f.split()[0] for f in ELECTED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(rows: pa.Table, cut: bool) -> pa.RecordBatch:
            col = {c: rows.column(c).to_numpy() for c in fields[:5]}
            lead = elect(col["id"], col["n_shingles"], np.stack([col["x"], col["y"]], 1).view(np.uint64), most, share)
            own = np.arange(len(lead))
            to = np.flatnonzero(lead != own)
            on = np.flatnonzero(lead == own) if cut else own[:0]
            gap = [pa.nulls(len(to), pa.int64())] * 5
            links = pa.RecordBatch.from_arrays([*gap, pa.array(col["id"][lead[to]]), pa.array(col["id"][to])], fields)
            sent = pa.RecordBatch.from_arrays([*(pa.array(col[c][on]) for c in fields[:5]),
                                               *[pa.nulls(len(on), pa.int64())] * 2], fields)
            return pa.concat_batches([links, sent])

        rest, began, chunked = None, False, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            keys = rows.column("key").to_numpy()
            at = 0
            for end in np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)):
                last = end == len(keys)
                while end - at >= SIDE + last:
                    yield of(rows.slice(at, SIDE), True)
                    at, chunked = at + SIDE, keys[at]
                if not last:
                    cut = not began or keys[end - 1] == chunked
                    if end - at > (not cut):
                        yield of(rows.slice(at, end - at), cut)
                    at, began = end, True
            rest = rows.slice(at)
        if rest is not None and rest.num_rows:
            yield of(rest, True)
    return run


def _leader_links(members: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) of members of a band and their leaders, about one for each member of a family.

    Rows are dealt to ranges of (band, id), so a band with a large part of all rows is
    spread over many tasks by itself; each block elects its leaders alone. Leaders of bands that
    go on elsewhere meet in the next round, as long as each round leaves at most half
    of them. What is not linked here is compared across components later.
    """
    links, before, now = [], None, members.count()
    while before is None or 0 < 2 * now <= before:
        told = materialize(members.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(
            _elections(threshold, miss), ELECTED))
        links.append(told.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        members = told.where("key is not null").drop("a", "b")
        before, now = now, members.count()
    return reduce(DataFrame.unionByName, links).distinct()


def _across(threshold: float, miss: float):
    """All pairs of a block across components that no batch of bits rules out.

    One bit of a value is compared, so values of unlike shingles match once in two
    times and the threshold is that of the bits. A pair that shares several bands
    is compared in the first of them.
    """
    share, chance = round(100 * threshold), (1 + threshold) / 2

    def pairs(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        col = {c: block.column(c).to_numpy() for c in ("key", "id", "n_shingles", "component", "few", "left")}
        bits = np.frombuffer(b"".join(block.column("wide").to_pylist()), np.uint64).reshape(block.num_rows, -1)
        tags = np.frombuffer(b"".join(block.column("tags").to_pylist()), np.int64).reshape(block.num_rows, BANDS)
        x, y = np.flatnonzero(col["left"] == 1), np.flatnonzero(col["left"] == 0)
        differ = sum(np.bitwise_count(w[x, None] ^ w[None, y]).astype(np.int32) for w in bits.T[:STEP])
        likely = _sizes_fit(col["n_shingles"][x], col["n_shingles"][y], share)
        likely &= col["component"][x, None] != col["component"][None, y]
        likely &= (col["few"][None, y] == 0) | (col["id"][x, None] < col["id"][None, y])  # else found the other way round
        i, j = np.nonzero(likely & (64 * STEP - differ >= least_matches(64 * STEP, chance, miss)))
        differ, i, j = differ[i, j], x[i], y[j]
        first = tags[i, (tags[i] == tags[j]).argmax(1)] == col["key"][0]
        i, j, differ = i[first], j[first], differ[first]
        for at in range(STEP, bits.shape[1], STEP):
            differ = differ + np.bitwise_count(bits[i, at:at + STEP] ^ bits[j, at:at + STEP]).sum(1, dtype=np.int32)
            upto = 64 * (at + STEP)
            keep = upto - differ >= least_matches(upto, chance, miss)
            i, j, differ = i[keep], j[keep], differ[keep]
        return col["id"][i], col["id"][j]
    return pairs


def _in_blocks(pairs):
    """``pairs`` of each block; rows come sorted by block, and a block has about twice ``SIDE`` rows."""
    def of(block: pa.Table) -> pa.RecordBatch:
        a, b = pairs(block)
        return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables(
                [rest, pa.Table.from_batches([batch])])
            if not rows.num_rows:
                continue
            keys = np.stack([rows.column(c).to_numpy() for c in ("key", "l", "r")], 1)
            cuts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1))
            for at in np.flatnonzero(np.diff(cuts) > 1):
                yield of(rows.slice(cuts[at], cuts[at + 1] - cuts[at]))
            rest = rows.slice(cuts[-1])
        if rest is not None and rest.num_rows > 1:
            yield of(rest)
    return run


def across_blocks(parted: DataFrame) -> DataFrame:
    """Blocks in which the members outside a band's largest component meet all members of the band.

    ``parted`` has key, id, component, n (rows of the band), largest (its component) and
    in_largest (rows of it). Rows outside the largest component are the left side; all are
    the right side. With few outside, each row of the right is in one block and the number of rows grows
    with the band's, not with its square; rows of one component are never put side by side
    for their own sake.
    """
    few = F.col("component") != F.col("largest")
    ls, rs = (F.ceil(n / SIDE).cast("int") for n in (F.col("n") - F.col("in_largest"), F.col("n")))

    def copies(n, left: int, l_of, r_of):
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            F.lit(left).alias("left"), l_of(i).alias("l"), r_of(i).alias("r")))

    mine_l, mine_r = F.pmod(F.xxhash64("id"), ls).cast("int"), F.pmod(F.xxhash64("id"), rs).cast("int")
    right = copies(ls, 0, lambda i: i, lambda i: mine_r)
    both = F.when(few, F.concat(right, copies(rs, 1, lambda i: mine_l, lambda i: i))).otherwise(right)
    kept = [c for c in parted.columns if c not in ("n", "largest", "in_largest")]
    return parted.select(*kept, few.cast("int").alias("few"), F.explode(both).alias("at")).select(*kept, "few", "at.*")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of ``docs``.

    1. Texts with the same words are one class, named by its smallest id.
    2. Classes that share a band are candidates. Band rows carry set size and one
       bit of ``BITS`` signature values, a first batch of the comparison; within
       a band, members are compared on these in blocks of bounded size and linked to a few
       leaders, so at most one pair per member leaves a block; leaders meet again in rounds.
    3. The pairs' signatures are compared in batches of ``BATCH`` values; a pair is
       pruned once the posterior probability that its similarity reaches
       ``threshold`` is below ``miss``.
    4. Survivors are verified on their full shingle sets; verified links give
       components.
    5. Bands whose members still lie in several components have all their pairs
       across components compared, so that no link between components is left
       out: members outside a band's largest component meet all of the band. Only the
       members of these bands are sent on, with one bit of ``WIDE``
       further signature values; these are compared in batches inside the block
       by the same bound, and the survivors go through step 4.

    Words are told by 64-bit hashes that are random in each byte and place. Equal texts
    agree in two independent ones of these; step 4 uses another one than step 2.

    A text's set is its distinct runs of ``width`` words (A-Z lower-cased), the
    whole sequence if it is shorter. Null texts and texts without words have empty
    sets, are linked with nothing and are their own component. Rows that repeat an
    id with equal words share their decision; if their words differ, each row has
    its own class, and links of either are links of the id. Rows with a null id
    have the component of their text's class; a class of null ids alone is linked
    with nothing, its component is null and it is kept. Other columns are not
    read. An empty table gives no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(narrow.mapInArrow(_sketches(width), SKETCH))
    worded = rows.where("n_shingles > 0")
    classes = materialize(worded.groupBy("h1", "h2").agg(F.min("id").alias("rep")))
    reps = worded.join(classes.where("rep is not null"), ["h1", "h2"]).where("id = rep")
    sigs = materialize(reps.select("id", "n_shingles", "sig", "bands", "x", "y", "h1", "h2").dropDuplicates(["id", "h1"]))
    one = sigs.select("id", "n_shingles", "sig")

    members = sigs.select("id", "n_shingles", "x", "y", F.explode("bands").alias("key"))
    compared = materialize(_leader_links(members, threshold, miss))
    links = _verified(narrow, _likely(compared, one, threshold, miss), width, threshold)
    told = materialize(components(links))

    labelled = sigs.join(told.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "h1", F.coalesce("component", "id").alias("component"), F.explode("bands").alias("key"))
    mixed = materialize(labelled.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.sum("c").alias("n"), F.max(F.struct("c", "component")).alias("most"), F.count("*").alias("of"))
        .where("of > 1").select("key", "n", F.col("most.component").alias("largest"), F.col("most.c").alias("in_largest")))
    parted = materialize(labelled.join(mixed, "key"))
    wide = materialize(narrow.join(materialize(parted.select("id").distinct()), "id", "left_semi").mapInArrow(
        _wide_sketches(width), WIDE_SKETCH).dropDuplicates(["id", "h1"]))
    more = across_blocks(parted.join(wide, ["id", "h1"]).drop("h1")).repartition("key", "l", "r").sortWithinPartitions(
        "key", "l", "r").mapInArrow(_in_blocks(_across(threshold, miss)), "a long, b long").distinct()
    more = materialize(more.join(compared, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        late = _verified(narrow, more, width, threshold)
        if not late.isEmpty():
            told = materialize(components(links.unionByName(late)))

    rep_of = classes.join(told, F.col("rep") == F.col("node"), "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component"))
    found = rows.join(rep_of, ["h1", "h2"], "left").select(
        "id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id")).alias("c"))
    return found.select(F.col("id").alias(id_col), "n_shingles", F.col("c").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("c")).alias("kept"))


def _likely(pairs: DataFrame, one: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs left by sizes and by the sequential comparison of signatures."""
    share = round(100 * threshold)
    a = one.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sig_a"))
    b = one.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sig_b"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= share * F.greatest("na", "nb"))
    return materialize(both.select("a", "b", "sig_a", "sig_b").mapInArrow(_pruned(threshold, miss), "a long, b long"))


def _verified(narrow: DataFrame, pairs: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity; only their texts are read again."""
    pairs = materialize(pairs)
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = materialize(narrow.join(materialize(ids), "id", "left_semi").dropDuplicates(["id", "text"]).mapInArrow(
        _full_sets(width), "id long, shingles array<long>"))
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    share = round(100 * threshold)
    return materialize(pairs.join(a, "a").join(b, "b").where(
        100 * both >= share * (F.size("sa") + F.size("sb") - both)).select("a", "b"))
