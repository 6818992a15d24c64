"""Best-fit packing of token pieces into sequences by linear grouping."""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.session import materialize

GROUPS = 128          # groups of large pieces, equal in number
SMALL_SHARE = 16      # pieces up to capacity / 16 are small
MAX_WORDS = 1_000_000  # words whose ids a worker remembers
END = b"\0\0\0\0"     # id 0 after each document

_TOKENIZERS: dict[str, Encoder] = {}
# Fixed: the vocabulary's own split of a text, within Latin-1.
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_TOKEN = re.compile(f"[{_LETTERS}]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'s|'t|'re|'ve|'m|'ll|'d|"
                    f"[^\t-\r \x85\xa0{_LETTERS}0-9\xb2\xb3\xb9\xbc-\xbe]+")
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ODD = re.compile("[\x1c-\x1f]")  # white space for str.split, not for the tokenizer


class Encoder:
    """The tokenizer's ids of a text, as little-endian bytes, remembered word by word.

    It reads lower case, drops white space and never merges across the parts of
    its split, so the ids of a text are those of its parts, and those of a new
    part are asked for once. Texts with characters beyond Latin-1, or with what may
    be a special token, are cut at white space only.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown: dict[int, str] = {}
        for c in map(chr, range(256)):
            if not _SPACES.match(c):
                self.shown |= dict(zip(c.encode(), level.pre_tokenize_str(c)[0][0]))
        self.known: dict[str, bytes] = {}
        self.wide: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.known[part] = array("I", [
            t.id for t in self.merge(part.encode().decode("latin-1").translate(self.shown))]).tobytes()
        return ids

    def _split(self, chunk: str) -> bytes:
        """A chunk without white space; it is remembered whole if its parts were known before."""
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        parts = _TOKEN.findall(chunk)
        ids = [self.known.get(p) for p in parts]
        if None not in ids:
            whole = self.known[chunk] = b"".join(ids)
            return whole
        return b"".join([self._part(p) if i is None else i for p, i in zip(parts, ids)])

    def _wide(self, chunk: str) -> bytes:
        if len(self.wide) > MAX_WORDS // 4:
            self.wide.clear()
        ids = self.wide[chunk] = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" in text or not _latin(text):
            get, new = self.wide.get, self._wide
        else:
            text, get, new = text.lower(), self.known.get, self._split
        chunks = [c for c in _SPACES.split(text) if c] if _ODD.search(text) else text.split()
        ids = list(map(get, chunks))
        if None in ids:
            ids = [new(c) if i is None else i for c, i in zip(chunks, ids)]
        return b"".join(ids)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _encoder(path: str):
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoder(path)
    return _TOKENIZERS[path].encode


PIECES = "id long, piece int, start long, length int, crc long, part int, nth long"


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _encoder(path), TaskContext.get().partitionId()
        count: dict[int, int] = defaultdict(int)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("id", "piece", "start", "length", "crc", "nth")}
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py() or "") + END
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    length = len(own) // 4
                    out["id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(length)
                    out["crc"].append(zlib.crc32(own))
                    out["nth"].append(count[length])
                    count[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["id"], pa.int64()), pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int32()), pa.array(out["crc"], pa.int64()),
                 pa.array([part] * len(out["id"]), pa.int32()), pa.array(out["nth"], pa.int64())],
                ["id", "piece", "start", "length", "crc", "part", "nth"])
    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sequence's place among those with the same gap in this task."""
    part, count = TaskContext.get().partitionId(), defaultdict(int)
    for batch in batches:
        gaps = batch.column("gap").to_pylist()
        nth = []
        for g in gaps:
            nth.append(count[g])
            count[g] += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("sequence"), batch.column("gap"), pa.array([part] * len(gaps), pa.int32()),
             pa.array(nth, pa.int64())], ["sequence", "gap", "part", "nth"])


def _ranked(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``rank``: place among the rows of ``key``, from task-wise places and task totals.

    Only (task, key) totals meet in a window; no key is sorted or gathered.
    """
    totals = rows.groupBy("part", key).agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("part", key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    kept = [c for c in rows.columns if c not in ("part", "nth")]
    return rows.join(first, ["part", key]).select(*kept, (F.col("first") + F.col("nth")).alias("rank"))


def best_pattern(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How many of each size fill a sequence best, the largest size left being one of them.

    Sums that can be reached are the bits of a number; sizes ascend, so tracing
    back from the fullest sum prefers large sizes.
    """
    use = [0] * len(sizes)
    top = max(i for i, n in enumerate(counts) if n)
    use[top] = 1
    room = capacity - sizes[top]
    mask, reach = (1 << (room + 1)) - 1, [1]
    for i in range(top + 1):
        bits = reach[-1]
        for k in range(1, min(counts[i] - use[i], room // sizes[i]) + 1):
            bits |= reach[-1] << (k * sizes[i])
        reach.append(bits & mask)
    left = reach[-1].bit_length() - 1
    for i in range(top, -1, -1):
        for k in range(min(counts[i] - use[i], left // sizes[i]), -1, -1):
            if reach[i] >> (left - k * sizes[i]) & 1:
                left -= k * sizes[i]
                use[i] += k
                break
    return use


@dataclass
class LargePlan:
    """Where the large piece of each rank goes: bounded by the number of groups, not of pieces."""

    first: dict[int, int] = field(default_factory=dict)  # rank of the first piece of each length
    cardinality: int = 1
    uses: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)  # group: (rank, sequence, each)
    sequences: int = 0


def plan_large(lengths: dict[int, int], capacity: int, groups: int = GROUPS) -> LargePlan:
    """Group pieces of descending length by equal number, round up, and choose configurations."""
    plan, rank = LargePlan(), 0
    for length in sorted(lengths, reverse=True):
        plan.first[length] = rank
        rank += lengths[length]
    if not rank:
        return plan
    plan.cardinality = -(-rank // groups)
    starts = sorted((r, length) for length, r in plan.first.items())
    n_groups = -(-rank // plan.cardinality)
    rounded = [starts[bisect_right(starts, (g * plan.cardinality, capacity + 1)) - 1][1] for g in range(n_groups)]
    order = list(range(n_groups))[::-1]  # ascending sizes
    sizes = [rounded[g] for g in order]
    counts = [min(plan.cardinality, rank - g * plan.cardinality) for g in order]
    plan.uses = {g: [] for g in range(n_groups)}
    used = [0] * n_groups
    while any(counts):
        pattern = best_pattern(sizes, counts, capacity)
        times = min(n // u for n, u in zip(counts, pattern) if u)
        for i, u in enumerate(pattern):
            if u:
                plan.uses[order[i]].append((used[i], plan.sequences, u))
                used[i] += u * times
                counts[i] -= u * times
        plan.sequences += times
    return plan


@dataclass
class SmallPlan:
    """Where the small piece of each length and rank goes: gap and rank of an open sequence, or a new one."""

    uses: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)  # length: (rank, gap, first, each)
    new: int = 0


def plan_small(lengths: dict[int, int], gaps: dict[int, int], capacity: int) -> SmallPlan:
    """Best fit over the counts of gaps: the smallest gap that takes the length, as often as it does.

    A cohort is a range of sequences that had one gap at first and have taken the
    same pieces since; gap -1 stands for new sequences.
    """
    plan = SmallPlan()
    cohorts: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # gap now: (gap at first, first rank, n)
    for gap, n in gaps.items():
        if gap and n:
            cohorts[gap].append((gap, 0, n))
    for length in sorted(lengths, reverse=True):
        left, done, spots = lengths[length], 0, plan.uses.setdefault(length, [])
        while left:
            gap = min((g for g in cohorts if g >= length and cohorts[g]), default=None)
            if gap is None:
                need = -(-left // (capacity // length))
                cohorts[capacity].append((-1, plan.new, need))
                plan.new += need
                continue
            origin, first, n = cohorts[gap].pop()
            each = min(gap // length, left)
            take = min(n, left // each)
            spots.append((done, origin, first, each))
            done += take * each
            left -= take * each
            cohorts[gap - each * length].append((origin, first, take))
            if n > take:
                cohorts[gap].append((origin, first + take, n - take))
    return plan


def _place_large(plan: LargePlan):
    starts = {g: [u[0] for u in uses] for g, uses in plan.uses.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                group, r = divmod(plan.first[length] + rank, plan.cardinality)
                start, sequence, each = plan.uses[group][bisect_right(starts[group], r) - 1]
                to.append(sequence + (r - start) // each)
            yield batch.append_column("sequence", pa.array(to, pa.int64()))
    return run


def _place_small(plan: SmallPlan, new_from: int):
    starts = {length: [u[0] for u in uses] for length, uses in plan.uses.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gaps, places = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                start, gap, first, each = plan.uses[length][bisect_right(starts[length], rank) - 1]
                gaps.append(gap)
                places.append(first + (rank - start) // each + (new_from if gap < 0 else 0))
            yield batch.append_column("gap", pa.array(gaps, pa.int32())).append_column(
                "place", pa.array(places, pa.int64()))
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, groups: int = GROUPS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece of a document.

    A document is its token ids and id 0. Documents longer than ``capacity`` are
    cut into pieces of that length, the last one shorter. Pieces are packed into
    few sequences: large ones are sorted by length into ``groups`` of equal
    number, each group is rounded up to its longest piece, and configurations of
    these few sizes are chosen one by one, each filling a sequence best around
    the largest size left and used as often as the groups allow. The actual
    pieces then take the places of their group, and the small ones go by best fit
    into the gaps that these leave.

    Both plans are made from counts of lengths and of gaps, at most ``capacity``
    numbers each, whatever the number of pieces. Every piece finds its place from
    its rank among the pieces of its length; ranks come from per-task counts. A
    length that a third of all rows share is spread over tasks as any other.

    Null and empty texts are the id 0 alone. Rows that repeat an id are packed
    one by one; null ids are kept. Other columns are not read. An empty table
    gives no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = materialize(narrow.mapInArrow(_pieces(tokenizer, capacity), PIECES))
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    small = capacity // SMALL_SHARE
    large_plan = plan_large({k: n for k, n in counted.items() if k > small}, capacity, groups)
    ranked = materialize(_ranked(pieces, "length"))
    body = "id long, piece int, start long, length int, crc long, rank long"
    large = materialize(ranked.where(F.col("length") > small).mapInArrow(
        _place_large(large_plan), f"{body}, sequence long"))
    gaps = large.groupBy("sequence").agg((F.lit(capacity) - F.sum("length")).cast("int").alias("gap"))
    open_ = materialize(gaps.where("gap > 0").mapInArrow(
        _numbered, "sequence long, gap int, part int, nth long"))
    room = {r["gap"]: r["n"] for r in open_.groupBy("gap").agg(F.count("*").alias("n")).collect()}
    small_plan = plan_small({k: n for k, n in counted.items() if k <= small}, room, capacity)
    spots = ranked.where(F.col("length") <= small).mapInArrow(
        _place_small(small_plan, large_plan.sequences), f"{body}, gap int, place long")
    spots = materialize(spots)
    into = _ranked(open_, "gap").select("gap", F.col("rank").alias("place"), "sequence")
    fitted = spots.where("gap >= 0").join(into, ["gap", "place"]).select(*large.columns)
    fresh = spots.where("gap < 0").select("id", "piece", "start", "length", "crc", "rank",
                                          F.col("place").alias("sequence"))
    every = large.union(fitted).union(fresh)
    order = Window.partitionBy("sequence").orderBy(F.desc("length"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    return every.select(
        F.col("id").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("sequence").alias("sequence_id"),
        F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset"))
