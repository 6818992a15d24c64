"""The numbered operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, cycle
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_spark.llm import (catalog, exactdup, fingerprints, langid, minhash, mixing, packing, sharding, tokencount,
                               toxicity, urls)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, sig string, rank int, part int"


def words(n: int, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdeé"), 4)) for _ in range(n)]


BASE = words(120, 1)
TEXTS = [" ".join(BASE), " ".join(BASE), " ".join(BASE).upper(), "\n".join(BASE) + "  ", " ".join(BASE[:-3] + ["x1", "x2", "x3"]),
         " ".join(BASE[:60] + words(60, 2)), None, "", "one two", "One  TWO", "...", " ".join(words(30_000, 3)), "a" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], ["b", "a", None][i % 3], 0, 1, "s", 2, 3) for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", "b", 0, 1, "s", 2, 3), (None, "no id here at all", "en", "a", 0, 1, "s", 2, 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def wanted(sizes):
    """Words that each source gives: shares by weight, none above three times its size."""
    weight = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), cycle((5, 2, 1))))
    want, left, open_ = {}, sum(sizes.values()), set(sizes)
    while True:
        over = [s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) > 3 * sizes[s]]
        if not over:
            return want | {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        for s in over:
            want[s] = 3.0 * sizes[s]
        left -= sum(want[s] for s in over)
        open_ -= set(over)


def near_components(texts, width):
    """The smallest id reachable from each, all sets held against all."""
    sets = {}
    for i, t in texts.items():
        w = split((t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            low[y] = x
    return {i: root(i) for i in sets}


def pieces(tok, text):
    ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
    return [(n, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
            for n, at in enumerate(range(0, len(ids), 2048))]


def test_mixing(docs, empty):
    out = mixing.mix(docs, (5, 2, 1), F.lit(1.0)).collect()
    assert len(out) == docs.count() and mixing.mix(empty).count() == 0
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len(split(r["text"]))
    want = wanted(sizes)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max(r["size"] for r in out)
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes)
    again = mixing.mix(docs.repartition(5), (5, 2, 1), F.lit(1.0)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_exact_dedup(docs, empty):
    out = exactdup.exact_duplicates(docs).collect()
    assert len(out) == docs.count() and exactdup.exact_duplicates(empty).count() == 0
    groups = defaultdict(list)
    for r in docs.collect():
        t = r["text"] or ""
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()].append(
            (-len(t), r["doc_id"] is None, r["doc_id"]))
    for r in out:
        g = sorted(groups[r["text_sha256"]], key=lambda x: (x[0], x[1], x[2] or 0))
        assert (r["keep_id"], r["group_size"], r["kept"]) == (g[0][2], len(g), r["doc_id"] == g[0][2])
    assert exactdup.keep_rows(docs, exactdup.exact_duplicates(docs)).count() == len(groups)


def test_kept_rows_with_repeated_and_null_ids(spark):
    rows = [(None, "a b", 1), (None, "c d", 1), (5, "x", 1), (5, "x ", 1), (5, "y", 1), (6, "y", 2), (7, None, 1), (8, " ", 1)]
    data = spark.createDataFrame(rows, "doc_id long, text string, rows int").repartition(3)
    kept = exactdup.keep_rows(data, exactdup.exact_duplicates(data))
    assert kept.columns == data.columns and Counter(map(tuple, kept.collect())) == Counter(
        rows[i] for i in (0, 1, 3, 4, 7))


def test_exact_dedup_with_history(docs, spark):
    old = exactdup.winners(exactdup.digests(docs.where("doc_id < 2")))
    out = {r["doc_id"]: r for r in exactdup.exact_duplicates(docs.where("doc_id >= 2"), history=old).collect()}
    assert (out[3]["keep_id"], out[3]["kept"]) == (0, False) and (out[4]["keep_id"], out[4]["kept"]) == (4, True)


@pytest.mark.parametrize("history", ["doc_id % 2 = 0", "doc_id % 3 = 1", "doc_id >= 3", "true", "false", "text IS NULL", "doc_id IS NULL"])
def test_exact_dedup_merges_later_rows_into_the_history(docs, empty, history):
    want = Counter(map(tuple, exactdup.exact_duplicates(docs).collect()))  # held against brute force above
    merged = exactdup.merged_duplicates(docs, F.expr(history))
    assert merged.columns == exactdup.exact_duplicates(docs).columns
    assert Counter(map(tuple, merged.collect())) == want
    assert exactdup.merged_duplicates(empty, F.expr(history)).count() == 0


def test_a_longer_later_row_takes_the_slot(spark):
    rows = [(2, "a b"), (4, "ab"), (1, "ab"), (3, " a b"), (5, "a  b"), (6, "cd"), (8, None), (7, "")]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exactdup.merged_duplicates(
        data, F.col("doc_id") % 2 == 0).collect()}
    assert out == {1: (3, 5, False), 2: (3, 5, False), 3: (3, 5, True), 4: (3, 5, False), 5: (3, 5, False),
                   6: (6, 1, True), 7: (7, 2, True), 8: (7, 2, False)}


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(5)
    for m in (1, 2, 7, 600):
        _, _, _, slots = exactdup.displacements(rng.integers(0, 2**28, (m, 6)))
        assert sorted(slots) == list(range(m))
    for m in [2, 3, 4, 5, 6, 8, 12, 16] * 60:  # few keys, whose places must part at some seed
        _, _, _, slots = exactdup.displacements(rng.integers(0, 2**28, (m, 6)))
        assert sorted(slots) == list(range(m))


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, empty, width):
    rows = [(r["doc_id"], split((r["text"] or "").translate({i: i + 32 for i in range(65, 91)}))) for r in docs.collect()]
    sets = {i: {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for i, w in rows}
    ids = sorted(i for i in sets if i is not None)
    comp = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    out = minhash.near_duplicates(docs, width=width).collect()
    assert len(out) == docs.count() and minhash.near_duplicates(empty).count() == 0
    for r in out:
        assert r["n_shingles"] == len(sets[r["doc_id"]]) and r["component_id"] == comp.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_crowded_bands(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SIDE", 8)
    rows = [(i, " ".join(BASE[:110] + words(6, 100 + i))) for i in range(60)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    assert {r["component_id"] for r in out} == {0}


def family(n):
    """Copies of one text with one to nine tenths of a similarity, so that some are linked and some are not."""
    out = []
    for i in range(n):
        rng = np.random.default_rng(1000 + i)
        w = list(BASE)
        for at in rng.choice(len(w), rng.integers(0, 5), replace=False):
            w[at] = f"new{i}{at}"
        out.append((i, " ".join(w)))
    return out


def test_a_family_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SIDE", 8)
    rows = family(150)
    want = near_components(dict(rows), 4)
    assert len(set(want.values())) > 5
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(data, width=4).collect()} == want


def test_blocks_across_components_grow_with_the_band(spark):
    def leaving(n, few=10):
        rows = [(1, i, i if i < few else -1, n, -1, n - few) for i in range(n)]
        return minhash.across_blocks(spark.createDataFrame(
            rows, "key long, id long, component long, n long, largest long, in_largest long")).count()
    one, two, four = (leaving(n) for n in (2000, 4000, 8000))
    assert two < 2.2 * one and four < 4.4 * one


def test_blocks_across_components_hold_every_pair(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SIDE", 4)
    component = [i % 7 if i % 3 == 0 else 99 for i in range(40)]
    inside = component.count(99)
    rows = minhash.across_blocks(spark.createDataFrame(
        [(1, i, c, 40, 99, inside) for i, c in enumerate(component)],
        "key long, id long, component long, n long, largest long, in_largest long")).collect()
    at = defaultdict(lambda: (set(), set()))
    for r in rows:
        at[r["l"], r["r"]][1 - r["left"]].add(r["id"])
    met = Counter((x, y) for left, right in at.values() for x in left for y in right)
    assert max(met.values()) == 1
    assert all((a, b) in met or (b, a) in met for a, b in combinations(range(40), 2) if component[a] != component[b])


def test_elections_in_any_batches():
    import pyarrow as pa
    rng = np.random.default_rng(2)
    n = 400
    keys = np.sort(rng.integers(0, 12, n))
    keys[100:250] = keys[100]
    keys.sort()
    full = rng.integers(0, 2**62, (4, 2))[rng.integers(0, 4, n)]
    rows = pa.table({"key": keys, "id": np.arange(n), "n_shingles": np.full(n, 50), "x": full[:, 0], "y": full[:, 1]})
    for size in (1, 7, 400):
        out = pa.Table.from_batches(minhash._elections(0.8, 1e-6)(iter(rows.to_batches(size)))).to_pylist()
        links, on = [r for r in out if r["a"] is not None], [r for r in out if r["a"] is None]
        led = {r["b"] for r in links}
        assert len(led) == len(links) and all(keys[r["a"]] == keys[r["b"]] and (full[r["a"]] == full[r["b"]]).all() for r in links)
        assert {r["id"] for r in on} == {i for i in range(n) if i not in led and keys[i] in (keys[0], keys[-1])}


def test_elections_of_a_band_in_several_blocks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(minhash, "SIDE", 8)
    keys, ids = np.repeat([1, 2, 3], [3, 50, 20]), np.arange(73)
    kind = ids % 3
    rows = pa.table({"key": keys, "id": ids, "n_shingles": np.full(73, 50), "x": kind * (2**62 - 1) // 2, "y": -kind})
    for size in (1, 5, 8, 73):
        out = pa.Table.from_batches(minhash._elections(0.8, 1e-6)(iter(rows.to_batches(size)))).to_pylist()
        led, on = {r["b"] for r in out if r["a"] is not None}, {r["id"] for r in out if r["a"] is None}
        assert led | on == set(range(73)) and not led & on and len(on) <= 3 * 12


def test_word_hashes_tell_words_that_collide_as_polynomials():
    """A Thue-Morse word and its complement are equal under any polynomial modulo 2^64."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    for of in (0, 1):
        x, y, z, low, high = (minhash.word_hashes(t, of) for t in (f"{a} q", f"\t{b}  q", "é" * 300, "abc Éq", "ABC Éq"))
        assert x[0] != y[0] and x[1] == y[1] and len(z) == 1 and (low == high).all()
    assert minhash.word_hashes("abc", 0)[0] != minhash.word_hashes("abc", 1)[0]
    assert len(minhash.word_hashes(" \n ")) == 0 and len(minhash.word_hashes("")) == 0


def test_packing(docs, empty, spark):
    from tokenizers import Tokenizer
    path = catalog.tokenizer()
    tok = Tokenizer.from_file(path)
    many = docs.union(spark.createDataFrame(
        [(1000 + i, " ".join(words(5 + (i * 37) % 700, i)), "en", "a", 0, 1, "s", 2, 3) for i in range(150)], SCHEMA))
    out = packing.pack(many, path, 2048).collect()
    assert packing.pack(empty, path).count() == 0
    want = defaultdict(list)
    for r in many.collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        for at in range(0, len(ids), 2048):
            own = ids[at:at + 2048]
            want[r["doc_id"], at // 2048].append((at, len(own), zlib.crc32(own.tobytes())))
    got, places = defaultdict(list), defaultdict(list)
    for r in out:
        got[r["doc_id"], r["piece"]].append((r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= 1.04 * sum(r["length"] for r in out) / 2048 + 1


def test_encoder_is_the_tokenizers():
    from tokenizers import Tokenizer
    path = catalog.tokenizer()
    tok, encode = Tokenizer.from_file(path), packing._encoder(path)
    rng = np.random.default_rng(9)
    cases = ["İstanbul ΣΑΣ ς", "<|endoftext|>. a<|startoftext|>b", "don't. it's, I'LL", "é ﬁ À. µ ª²", "x\x1cy\x85z", " ́a"]
    cases += ["".join(map(chr, rng.integers(1, 400, 50))) for _ in range(300)]
    for text in cases:
        assert encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def order_minhash(text):
    """A fingerprint one k-mer at a time."""
    import struct
    from xxhash import xxh64_intdigest

    def signed(x):
        return x - 2**64 if x >= 2**63 else x

    def of_longs(*values):
        seed = 42
        for v in values:
            seed = xxh64_intdigest(struct.pack("<q", v), seed)
        return signed(seed)
    k = fingerprints.K
    n, seen, tuples = len(text), Counter(), defaultdict(list)
    for place in range(max(1, n - k + 1) if n else 0):
        base = xxh64_intdigest(text[place:place + k].encode("utf-32-be"), 42) >> 25
        if seen[base]:
            value = xxh64_intdigest(struct.pack("<i", seen[base]), of_longs(base) % 2**64) >> 25
        else:
            value = base
        seen[base] += 1
        tuples[value >> 34].append((value, place))
    out = []
    for j in range(32):
        chosen = sorted(sorted(tuples[j])[:2], key=lambda x: x[1])
        out.append(f"{of_longs(*(v for v, _ in chosen)) % 2**32:08x}" if chosen else "-")
    return ".".join(out)


def test_fingerprints_against_a_loop(spark):
    rng = np.random.default_rng(9)
    texts = ["", "a", "abcdefg", "abcdefgh", "abcdefghi", "ab" * 700, "x" * 3000, "日本語😀" * 5, " ".join(BASE * 3),
             " ".join(words(900, 4)), " ".join(words(50, 5)) + " " + " ".join(BASE) * 12]
    texts += ["".join(rng.choice(list("ab é😀"), rng.integers(1, 40))) for _ in range(30)]
    texts += ["".join(rng.choice(list("abcdefg "), rng.integers(700, 1500))) for _ in range(6)]
    data = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(data).collect()}
    assert found == {i: order_minhash(t) for i, t in enumerate(texts)}

    def alike(x, y):
        both = [(a, b) for a, b in zip(x.split("."), y.split(".")) if (a, b) != ("-", "-")]
        return sum(a == b for a, b in both) / len(both) if both else 1.0
    for r in fingerprints.edited_fingerprints(data).collect():
        t, following = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % len(texts)]
        q = len(t) // 4
        edited = order_minhash(t[:len(t) - q] + following[:q])
        assert (r["fingerprint"], r["edited_fingerprint"]) == (found[r["doc_id"]], edited)
        assert r["near_edited"] == pytest.approx(alike(found[r["doc_id"]], edited))
        assert r["near_next"] == pytest.approx(alike(found[r["doc_id"]], order_minhash(following)))


def test_places_of_very_long_texts_are_scaled(spark, monkeypatch):
    text = "".join(np.random.default_rng(1).choice(list("abcdef "), 3000))
    data = spark.createDataFrame([(1, text), (2, text[::-1])], "doc_id long, text string")
    plain = {r["doc_id"]: r["edited_fingerprint"] for r in fingerprints.edited_fingerprints(data).collect()}
    monkeypatch.setattr(fingerprints, "LONGEST", 1024)
    scaled = fingerprints.edited_fingerprints(data).collect()
    assert all(len(r["edited_fingerprint"].split(".")) == 32 for r in scaled) and len(plain) == len(scaled)
    edited = {1: text[:2250] + text[::-1][:750], 2: text[::-1][:2250] + text[:750]}
    again = spark.createDataFrame(list(edited.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["edited_fingerprint"] for r in scaled} == {
        r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(again).collect()}


def test_fingerprints(docs, empty):
    out = fingerprints.edited_fingerprints(docs).collect()
    assert len(out) == docs.count() and fingerprints.edited_fingerprints(empty).count() == 0
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = sorted(text, key=lambda i: (i is not None, i or 0))
    after = dict(zip(order, order[1:] + order[:1]))
    seen = {}
    for r in out:
        t, nxt = text[r["doc_id"]], text[after[r["doc_id"]]]
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert seen.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        if edited == t:
            assert r["near_edited"] == 1
    by = {r["doc_id"]: r for r in out}
    assert by[0]["near_next"] == 1 and by[11]["near_edited"] > 0.2 > by[11]["near_next"]


def test_fingerprints_number_the_occurrences(spark):
    a, b = " ".join(words(40, 7)) + " ", " ".join(words(40, 8)) + " "
    texts = [a * 3, a * 30, a * 3, (a + b) * 2, a * 2 + b * 2, "xyzw" * 3, "xyzw" * 300, a * 30 + "tail"]
    data = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    f = fingerprints.fingerprints(data).withColumnRenamed("fingerprint", "f").select("doc_id", "f")
    near = {(r[0], r[1]): r[2] for r in f.alias("x").crossJoin(f.alias("y")).select(
        F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), fingerprints.likeness(F.col("x.f"), F.col("y.f"))).collect()}
    assert near[0, 2] == 1 and near[0, 1] < 0.5 and near[3, 4] < 0.9 and near[5, 6] < 0.9 and near[1, 7] > 0.9


def test_toxicity(spark, docs, empty):
    rows = [(i, " ".join(words(30, i) + (["grumpf", "snarkle"] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(400)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(data, data.select("doc_id", "toxic"), F.lit(True))
    assert any("grumpf".startswith(t) for t in (*model.words, *model.stems))
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(data, model).collect()}
    assert all((found[i] >= 0.7) == bool(y) for i, _, y in rows)
    trie = toxicity.Trie({"grumpf": 5.0}, {"snark": 4.0})
    near = {w: trie.find(w) for w in ("grumpf", "grunpf", "grumpff", "grmpf", "gumpfr", "snarkling", "snar")}
    assert near["grumpf"][0] == 5 and near["snarkling"][0] == 4 and near["snar"] == near["gumpfr"] == (0, 0)
    assert all(near[w] == (0, 5) for w in ("grunpf", "grumpff", "grmpf"))
    quoted, plain = (toxicity.features(t, trie, {}) for t in ('they said "you grumpf" once', "you grumpf once"))
    assert quoted[0] == 0 < quoted[2] and plain[0] > 0 == plain[2]
    assert toxicity.toxicity(docs, model).count() == docs.count() and toxicity.toxicity(empty, model).count() == 0
    assert toxicity.fit(empty, data.select("doc_id", "toxic"), F.lit(True)) == toxicity.Model()


def test_toxicity_of_inflected_and_misspelled_forms(spark):
    forms = ["idiot", "idiots", "idiotic", "idiocy"]
    rows = [(i, " ".join(words(30, i) + ([forms[i // 4 % 4]] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(400)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(data, data.select("doc_id", "toxic"), F.lit(True))
    assert any("idiots".startswith(t) for t in model.stems)
    trie = toxicity.Trie(model.words, model.stems)
    assert all(trie.find(w)[0] > 0 for w in (*forms, "idiotically"))
    for w in ("idot", "ldiot", "idxot", "iidiot", "idoit", "diiot", "idoits", "idiotc", "idixcy"):
        assert trie.find(w)[1] > 0 and sum(toxicity.features(f"you {w} there", trie, {})[:2]) > 0, w
    for w in ("idxxt", "dxiot", "odiit", "tidio"):
        assert trie.find(w) == (0, 0), w
    trie = toxicity.Trie({"idiot": 5.0, "crap": 4.0}, {})
    for w in ("i.d.i.o.t", "id*ot", "i**ot", "id_iot", "cr@p", "x-i.d*ot-y"):
        plain = toxicity.features(f"you {w}, there", trie, {})
        assert plain[0] == 0 < plain[1] == toxicity.features(f"you {w}, there " + "x" * 50, trie, {})[1], w
    for w in ("i***t", "c*p", "well-known", "id*o", "idi* ot", "i.d.i.o"):
        assert toxicity.features(f"you {w} there", trie, {}) == (0, 0, 0, 0), w
    assert toxicity.features("idiot-like", trie, {})[:2] == (1, 0)


@pytest.mark.parametrize("left, right", ['""', "“”", "„“", "„”", "””", "«»", "»«", "‹›"])
def test_quotation_of_any_length(left, right):
    trie, long = toxicity.Trie({"grumpf": 5.0}, {}), " ".join(BASE[:40])

    def sums(text):  # unquoted and quoted hits
        x = toxicity.features(text, trie, {})
        return x[0], x[2]
    assert sums(f"they said {left}{long} grumpf {long}{right} once") == (0, 1)
    assert sums(f"they said {left}{long}{right} you grumpf") == (1, 0)
    assert sums(f"they said {left}{long} grumpf") == sums(f"a 5{right} grumpf, and 6{right} grumpf"[:13]) == (1, 0)
    assert sums(f"{left}a{right} grumpf {left}grumpf{right} grumpf, {left}b{right}") == (2, 1)
    assert sums(f'a 5" disc, "{long}" grumpf "x"') == (1, 0)
    assert sums(f'he said "{long}\n\nyou grumpf" then') == (1, 0)


def test_language(docs, empty, small, spark):
    full = spark.read.parquet(f"{small}/documents.parquet")
    out = catalog.op7_language(spark, small).join(full, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.9
    model = langid.fit(docs, F.lit(True))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.language(docs, model).collect()}
    assert found[6] == found[7] == found[10] == ("und", 0.0) and found[0][0] in ("en", "fr")
    assert langid.language(empty, langid.fit(empty, F.lit(True))).count() == 0


def test_sharding(docs, empty):
    out = sharding.shards(docs, 6000).collect()
    assert len(out) == docs.count() and sharding.shards(empty, 10).count() == 0
    total = defaultdict(list)
    for r in out:
        total[r["shard"]].append(r["bytes"])
    for shard, sizes in total.items():
        assert sum(sizes) <= 6000 or len(sizes) == 1
        assert not any(o != shard and o.startswith(shard) for o in total)


def test_url_lists(spark):
    day = "2024-01-%02d 00:00:00"
    entries = spark.sql("select * from values " + ", ".join(f"('{k}', '{n}', '{a}', timestamp'{day % d}')" for k, n, a, d in [
        ("host:bad.example", "m", "add", 5), ("host:bad.example", "m", "remove", 10), ("host:bad.example", "m", "add", 20),
        ("host:example", "s", "add", 8), ("page:a.b/x", "t", "add", 1), ("page:a.b/x", "t", "add", 2)]) +
        " as t(key, list_name, action, at)")
    shots = [("http://www.bad.example/p?q", 4, ""), ("http://www.bad.example/p?q", 5, "m"), ("https://bad.example", 9, "m,s"),
             ("http://bad.example:80/", 10, "s"), ("http://BAD.example/", 25, "m,s"), ("http://a.b/x/?y", 3, "t"),
             (None, 3, ""), ("nonsense", 3, ""), ("http://a.b/x", None, "")]
    pages = spark.createDataFrame([(i, u, day % d if d else None, 1) for i, (u, d, _) in enumerate(shots)],
                                  "page_id long, url string, at string, n long").withColumn(
        "fetched_at", F.col("at").cast("timestamp"))
    out = {r["page_id"]: r["lists"] for r in urls.temporal_filter(pages, entries).collect()}
    assert out == {i: want for i, (_, _, want) in enumerate(shots)}
    assert urls.temporal_filter(pages.limit(0), entries).count() == 0
    assert urls.temporal_filter(pages, entries.limit(0)).where("blocked").count() == 0


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers
    path = catalog.tokenizer("piece_bpe_32k.model")
    vocabulary = tokencount.load_vocabulary(path)
    other = Tokenizer(models.Unigram(list(vocabulary.pieces), unk_id=vocabulary.unk_id, byte_fallback=False))
    other.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = tokencount.Counter(vocabulary)
    for text in [*filter(None, TEXTS[:11]), " a", "a  b", "日本 語x", "\n\n x\ty", "...a, b!?", "𝒳𝒳 x", "▁x ▁"]:
        assert counter.text(text) == len(other.encode(text, add_special_tokens=False).ids)
    out = tokencount.token_counts(docs, path).collect()
    assert len(out) == docs.count() and tokencount.token_counts(empty, path).count() == 0
    assert all(r["n_tokens"] == counter.text((TEXTS + [None])[r["doc_id"]] or "") for r in out if r["doc_id"] is not None)


def test_pipeline(spark, small):
    import corpus_pipeline as P
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = catalog.toxic_model(docs, spark.read.parquet(f"{small}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, model).collect() if r["score"] >= catalog.TOXIC_FROM}
    got = P.drop_toxic(spark, docs, small)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == {
        r["doc_id"] for r in docs.collect()} - bad

    left = [r for r in docs.collect() if r["doc_id"] not in bad]
    groups = defaultdict(list)
    for r in left:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append((-len(r["text"] or ""), r["doc_id"]))
    first = {min(g)[1] for g in groups.values()}
    left = [r for r in left if r["doc_id"] in first]
    low = near_components({r["doc_id"]: r["text"] for r in left}, 5)
    left = [r for r in left if low[r["doc_id"]] == r["doc_id"]]

    grade = {}
    for r in spark.read.parquet(f"{small}/labels.parquet").where("quality is not null").collect():
        grade[r["doc_id"]] = max(r["quality"], grade.get(r["doc_id"], 0))
    by_source, sizes = defaultdict(list), defaultdict(int)
    for r in left:
        n = len(split(r["text"]))
        u = (int(hashlib.md5(f"{catalog.MIX_SEED}:{r['doc_id']}".encode()).hexdigest()[:12], 16) + 1) / 2**48
        weight = {1: 1.0, 0: 0.25}.get(grade.get(r["doc_id"]), 0.5)
        by_source[r["source"]].append((floor(-log(u) / weight * 2**30), r["doc_id"], n, r["text"]))
        sizes[r["source"]] += n
    targets, want = wanted(sizes), Counter()
    tok = Tokenizer.from_file(catalog.tokenizer())
    for source, members in by_source.items():
        epochs = int(targets[source] // sizes[source]) if sizes[source] else 0
        till, rest = 0, targets[source] - epochs * sizes[source]
        for _, doc_id, n, text in sorted(members):
            till += n
            copies = epochs + (sizes[source] > 0 and till - n / 2 <= rest)
            for piece in pieces(tok, text):
                want[doc_id, *piece] += copies
    out = P.run(spark, small).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == +want
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= 1.1 * sum(r["length"] for r in out) / 2048 + 1
