"""Document fingerprints: Order MinHash with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.session import materialize

K = 8            # code points of a k-mer
TUPLES = 32      # values of a fingerprint; the top five bits of a k-mer's hash name its tuple
PER_TUPLE = 2    # k-mers of a value
KEPT = 768       # k-mers of a longer text that are dealt to tuples first, on average
PLACE_BITS = 25  # lower bits of a packed k-mer: its place in the text
LONGEST = 1 << 24  # places beyond are scaled down
TUPLE_SHIFT = 59
PLACE_MASK = (1 << PLACE_BITS) - 1
HASH_MASK = ((1 << TUPLE_SHIFT) - 1) ^ PLACE_MASK


def _none() -> Column:
    """No k-mer, in an array that can't hold nulls: such arrays are sorted as plain numbers."""
    return F.filter(F.array(F.lit(0).cast("long")), lambda x: F.lit(False))


def kmers(points: Column, n: Column, first: Column, length: Column) -> Column:
    """The k-mers of a text of n code points from place ``first`` on, each as one number: 5 bits of tuple, 34 of hash,
    25 of place.

    ``points`` holds four bytes per code point, so that a k-mer is cut out in
    constant time. Places in a text beyond 2^24 code points (``length``) are scaled down.
    """
    def packed(cut, place):
        return lambda at: F.xxhash64(F.substring(cut, at, F.lit(4 * K))).bitwiseAND(F.lit(~PLACE_MASK)).bitwiseOR(
            place(F.shiftright(at, 2).cast("long")))

    def of(place):  # as a variable: a binary column would be copied whole for each k-mer
        return F.get(F.transform(F.array(points), lambda cut: F.transform(places, packed(cut, place))), 0)

    last = F.greatest(n - K, F.lit(0))
    places = F.sequence(first * 4 + 1, last * 4 + 1, F.lit(4))
    scale = F.ceil(F.log2(length / F.lit(float(LONGEST)))).cast("double")
    return F.when((n == 0) | (first > last), _none()).when(
        length <= LONGEST, of(lambda i: i)).otherwise(
        of(lambda i: F.coalesce(F.floor(i / F.pow(F.lit(2.0), scale)), F.lit(0).cast("long"))))


def _new(s: Column, x: Column, i: Column) -> Column:
    """Whether no k-mer before it in the sorted array is the same."""
    return (i == 0) | (F.shiftright(x.bitwiseXOR(F.get(s, i - 1)), PLACE_BITS) != 0)


def _same(s: Column, x: Column, i: Column) -> Column:
    """Whether the k-mer before it in the sorted array is the same; null for the first."""
    return F.shiftright(x.bitwiseXOR(F.get(s, i - 1)), PLACE_BITS) == 0


def _numbered(d: Column) -> Column:
    """Sorted repeated k-mers, hashed anew with the number of their occurrence."""
    starts = F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda i: _new(d, F.get(d, i), i))
    return F.when(F.size(d) > 0, F.get(F.transform(F.array(starts), lambda b: F.flatten(F.transform(
        b, lambda at, j: F.transform(
            F.slice(d, at + 1, F.coalesce(F.get(b, j + 1), F.size(d)) - at),
            lambda x, o: F.xxhash64(F.shiftrightunsigned(x, PLACE_BITS), o + 1).bitwiseAND(F.lit(~PLACE_MASK)).bitwiseOR(
                x.bitwiseAND(F.lit(PLACE_MASK))))))), 0)).otherwise(_none())


def _smallest(s: Column) -> Column:
    """Of each tuple of sorted k-mers the ``PER_TUPLE`` smallest by hash, then by place."""
    return F.filter(s, lambda x, i: (i < PER_TUPLE) | (
        F.shiftright(F.get(s, i - PER_TUPLE), TUPLE_SHIFT) != F.shiftright(x, TUPLE_SHIFT)))


def _values(found: Column) -> Column:
    """The chosen k-mers of each tuple, put back into text order and hashed together."""
    def value(p: Column) -> Column:
        a, b = F.get(p, 0), F.get(p, 1)
        in_order = a.bitwiseAND(F.lit(PLACE_MASK)) <= b.bitwiseAND(F.lit(PLACE_MASK))
        ha, hb = F.shiftrightunsigned(a, PLACE_BITS), F.shiftrightunsigned(b, PLACE_BITS)
        return F.when(F.size(p) == 0, F.lit(None).cast("long")).when(F.size(p) == 1, F.xxhash64(ha)).when(
            in_order, F.xxhash64(ha, hb)).otherwise(F.xxhash64(hb, ha))

    return F.transform(F.transform(F.sequence(F.lit(0), F.lit(TUPLES - 1)), lambda j: F.filter(
        found, lambda x: F.shiftrightunsigned(x, TUPLE_SHIFT) == j)), value)


def with_order_minhash(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """Add an Order MinHash for each name: an array of ``TUPLES`` numbers, null where a tuple has no k-mer.

    ``made`` gives the packed k-mers of the whole text. The occurrences of a k-mer
    are numbered along the text, and each is hashed with its number (the first has
    the hash of the k-mer itself). Each tuple takes its
    ``PER_TUPLE`` smallest occurrence-numbered k-mers, puts them back
    into text order and hashes them together, so that moved and repeated passages
    count, as in the edit distance, and not the set of k-mers alone (Marcais et
    al., 2019). One hash serves all tuples: its top bits name the tuple. A text of under some hundred
    k-mers therefore leaves tuples with one k-mer or none, and these hold no order.

    Every k-mer of the whole text is hashed, and all are sorted to number them. Of
    a long text those with a small hash are dealt to tuples first; if they don't
    fill all tuples, all are. A text shorter than a k-mer is one k-mer; a null or
    empty text has only nulls. Each step is a column of its own: sorts then run
    compiled, on arrays of plain numbers, and nothing is worked out twice.

    A text takes four bytes a code point for its cut form and eight a k-mer for each array,
    and the cut form must be below 2^31 bytes: texts beyond 2^29 code points end in an error.
    """
    def step(df: DataFrame, **now) -> DataFrame:
        return df.withColumns({f"__{k}_{name}": of(lambda c, name=name: F.col(f"__{c}_{name}"))
                               for name in made for k, of in now.items()})

    def small(c, x: Column) -> Column:
        return x.bitwiseAND(F.lit(HASH_MASK)) <= c("few")

    def few(c) -> Column:
        n = F.greatest(F.size(c("s")), F.lit(1))
        return F.least(F.lit(float(HASH_MASK)), F.lit(float(HASH_MASK)) * KEPT / n).cast("long")

    df = df.withColumns({f"__k_{name}": packed for name, packed in made.items()})
    df = step(df, s=lambda c: F.sort_array(c("k")))
    df = step(df, few=few)
    # first occurrences with a small hash, and all later ones: of these alone the first has a large hash
    df = step(df, u=lambda c: F.filter(c("s"), lambda x, i: small(c, x) | _same(c("s"), x, i)))
    df = step(df, d=lambda c: F.filter(c("u"), lambda x, i: ~small(c, x) | _same(c("u"), x, i)))
    df = step(df, a=lambda c: _numbered(c("d")))
    df = step(df, t=lambda c: F.sort_array(F.concat(
        F.filter(c("u"), lambda x, i: small(c, x) & _new(c("u"), x, i)), F.filter(c("a"), lambda x: small(c, x)))))
    df = step(df, f=lambda c: _smallest(c("t")))
    df = step(df, r=lambda c: F.when(
        (F.size(c("f")) == TUPLES * PER_TUPLE) | (F.size(c("s")) <= KEPT), _none()).otherwise(
        F.sort_array(F.concat(F.filter(c("s"), lambda x, i: _new(c("s"), x, i)), c("a")))))
    df = step(df, f=lambda c: F.when(F.size(c("r")) > 0, _smallest(c("r"))).otherwise(c("f")))
    return df.withColumns({name: _values(F.col(f"__f_{name}")) for name in made}).drop(
        *[f"__{k}_{name}" for name in made for k in ("k", "s", "few", "u", "d", "a", "t", "f", "r")])


def shown(values: Column) -> Column:
    """A fingerprint as text: 32 bits of each tuple in hex, ``-`` where there is none."""
    return F.array_join(F.transform(values, lambda v: F.coalesce(
        F.substring(F.lpad(F.lower(F.hex(v)), 16, "0"), 9, 8), F.lit("-"))), ".")


def likeness(one: Column, other: Column) -> Column:
    """Share of equal values among the tuples that either has; two empty texts are alike."""
    both = F.arrays_zip(F.split(one, r"\.").alias("x"), F.split(other, r"\.").alias("y"))
    some = F.filter(both, lambda p: (p["x"] != "-") | (p["y"] != "-"))
    return F.when(F.size(some) == 0, F.lit(1.0)).otherwise(
        F.size(F.filter(some, lambda p: p["x"] == p["y"])) / F.size(some))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every whole text; one row per row of ``docs``.

    Null texts count as empty; equal texts have equal fingerprints. Other columns
    are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.char_length(text).alias("n"), F.encode(text, "UTF-32").alias("points"))
    hashed = with_order_minhash(rows, {"fingerprint": kmers(F.col("points"), F.col("n"), F.lit(0), F.col("n"))})
    return hashed.select(id_col, F.col("n").cast("long").alias("n_chars"), shown(F.col("fingerprint")).alias("fingerprint"))


def successors(ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, next_id) over the distinct ids, ascending, nulls first; the first follows the last.

    Ids are dealt to ranges; each range looks at its own next id, and its last
    one at the first id of the range after it.
    """
    ranged = materialize(ids.select(F.col(id_col).alias("id")).distinct().repartitionByRange("id").withColumn(
        "part", F.spark_partition_id()))
    firsts = ranged.groupBy("part").agg(F.min(F.struct("id")).alias("f"))
    after = Window.orderBy("part")  # a row per range
    firsts = firsts.select("part", F.coalesce(F.lead("f").over(after), F.min("f").over(Window.partitionBy())).alias("f"))
    within = Window.partitionBy("part").orderBy("id")
    return ranged.withColumn("n", F.lead(F.struct("id")).over(within)).join(F.broadcast(firsts), "part").select(
        "id", F.coalesce("n", "f")["id"].alias("next_id"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last quarter of code points replaced by as many (or
    all) from the start of the next document by id. Returns id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Only the part of the next text that is asked for is shuffled. Null texts count
    as empty; a null id is the smallest id; of rows that repeat an id the smallest
    text and fingerprint stand for the id as a next document, and each row has its
    own result. A single document follows itself. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    sizes = materialize(rows.select("id", F.char_length("text").alias("n")))
    order = materialize(successors(sizes, "id"))
    asked = sizes.groupBy("id").agg(F.floor(F.max("n") / 4).cast("int").alias("most"))
    asked = materialize(order.join(asked, order["id"].eqNullSafe(asked["id"])).select(
        order["id"].alias("before"), order["next_id"].alias("of"), "most"))
    heads = rows.join(asked, F.col("id").eqNullSafe(F.col("of"))).select(
        "before", F.expr("left(text, most)").alias("head")).groupBy("before").agg(F.min("head").alias("head"))
    both = rows.join(heads, F.col("id").eqNullSafe(F.col("before")), "left").select(
        "id", "text", F.char_length("text").alias("n"), "head")
    changed = both.select(
        "id", "text", "n", (F.col("n") - F.floor(F.col("n") / 4)).cast("int").alias("same"), F.coalesce("head", F.lit("")).alias("head"))
    changed = changed.select("id", "text", "n", "same", F.expr("concat(left(text, same), left(head, n - same))").alias("edited"))
    cut = changed.select("id", "n", "same", F.char_length("edited").alias("m"), F.sha2("edited", 256).alias("edited_sha256"),
                         F.encode("text", "UTF-32").alias("points"), F.encode("edited", "UTF-32").alias("edited_points"))
    # k-mers that lie in the part that stays are worked out once; places beyond 2^24 are scaled by the own length
    alone, n, m = F.col("n") > LONGEST, F.col("n"), F.col("m")
    from_ = F.when(alone, F.lit(0)).otherwise(F.greatest(F.col("same") - K + 1, F.lit(0)))
    shared = F.when(alone | (F.col("same") < K), _none()).otherwise(kmers(F.col("points"), F.col("same"), F.lit(0), n))
    parts = cut.select("id", "n", "edited_sha256", shared.alias("both"), kmers(F.col("points"), n, from_, n).alias("own"),
                       kmers(F.col("edited_points"), m, from_, m).alias("other"))
    made = materialize(with_order_minhash(parts, {
        "fingerprint": F.concat("both", "own"), "edited_fingerprint": F.concat("both", "other")}).select(
        "id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", shown(F.col("fingerprint")).alias("fingerprint"),
        shown(F.col("edited_fingerprint")).alias("edited_fingerprint")))
    following = made.groupBy("id").agg(F.min("fingerprint").alias("next_fingerprint")).select(
        F.col("id").alias("following"), "next_fingerprint")
    of = order.select(F.col("id").alias("before"), "next_id").join(
        following, F.col("next_id").eqNullSafe(F.col("following"))).select("before", "next_fingerprint")
    return made.join(of, F.col("id").eqNullSafe(F.col("before"))).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
