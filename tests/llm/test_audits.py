"""The filter audit, the source divergence and the page extraction against brute force and edge cases."""

from __future__ import annotations

import re
import time
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pandas as pd
import pytest

from opinion_spark.llm import divergence, extraction, filteraudit

SCHEMA = "doc_id long, text string, lang string, source string, part string, mask int, term string, n int, value int, tile int"
LABELS = "doc_id long, quality int, toxic int, part string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    vocabulary = ["Ab", "aB", "cde", "füx", "ÄB", "z", "日本", "x1y", "$", "QED", "w-v"] + [f"w{i}" for i in range(70)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 120))) for _ in range(150)]
    texts += [None, "", " \t\n", "word " * 60, " ".join(f"t{i}" for i in range(60)), "A" * 3000, texts[3], texts[3], None, ""]
    found = [(i, t, [None, "en", "fr", ""][i % 4], [None, "s", "t", "é", "u"][i % 5]) for i, t in enumerate(texts)]
    found += [(3, texts[3], "en", "s"), (None, texts[3], "fr", "t"), (None, "alone", "fr", "t"), (7, "other text", "en", None)]
    return [(*r, "p", 1, "t", 2, 3, 4) for r in found]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


LABELLED = [(3, 1, 0, "x"), (3, 0, 1, "x"), (5, 1, 1, "x"), (9, None, 1, "x"), (None, 1, 1, "x"), (999, 1, 1, "x"), (153, 1, None, "x")]


def failures(rows):
    """(part, set of letters failed, good, toxic) of each row, one by one."""
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _, _ in LABELLED if q == 1}
    toxic = {i for i, _, t, _ in LABELLED if t == 1}
    for i, text, _, source, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A"} if len(w) < 50 else set()
        fails |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        fails |= {"E"} if i is not None and first[t] < i else set()
        yield source or "", fails, i is not None and i in good, i is not None and i in toxic


def test_filter_audit(spark, docs, rows):
    labels = spark.createDataFrame(LABELLED, LABELS)
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filteraudit.filter_audit(docs, labels).collect()}
    parts = defaultdict(list)
    for part, *rest in failures(rows):
        parts[part].append(rest)
    assert len(got) == 600 * len(parts)
    share = Counter()
    for part, its in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = its
            for step, f in enumerate(order, 1):
                out = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                r = got[part, order, step]
                assert (r["kept"], r["removed"], r["good_lost"], r["toxic_lost"]) == (
                    len(left), len(out), sum(x[1] for x in out), sum(x[2] for x in out))
                assert r["redundant"] == sum(f in x[0] for x in its) - len(out)
                assert r["unique_fails"] == sum(x[0] == {f} for x in its)
                share[part, f] += len(out)
    assert all(r["shapley"] == share[part, order[step - 1]] for (part, order, step), r in got.items())


def test_filter_audit_of_nothing(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    assert filteraudit.filter_audit(docs.where("false"), labels).count() == 0
    assert filteraudit.filter_audit(docs, labels).where("good_lost + toxic_lost > 0").count() == 0


def test_gray_walk_holds_every_subset():
    cells = np.random.default_rng(1).integers(0, 9, (32, 2))
    for s, state in enumerate(filteraudit.gray_walk(cells)):
        assert (state == sum((cells[m] for m in range(32) if not m & s), np.zeros(2, int))).all()


def expected_divergence(rows, least, top):
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        groups[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
    out = set()
    for lang in {x for x, _ in groups}:
        kept = {t for t, n in df[lang].items() if n >= least}
        counts = {s: Counter({t: n for t, n in c.items() if t in kept}) for (x, s), c in groups.items() if x == lang}

        def shares(c):
            return {t: 1 + (10**9 * (c[t] + 5)) // (c.total() + 5 * len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), Counter()))
        for s in counts:
            told = {"pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s],
                    "term": [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]}
            for part, its in told.items():
                its.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, o, v, i) for i, (v, o) in enumerate(its[:top if part == "term" else None], 1)}
    return out


@pytest.mark.parametrize("least,held,tile", [(10, 200_000, 128), (1, 40, 2), (10_000, 40, 128)])
def test_divergence(docs, rows, monkeypatch, least, held, tile):
    monkeypatch.setattr(divergence, "TILE", tile)
    got = divergence.divergence(docs, least, top=7).select("lang", "source", "part", "item", "value", "rank").collect()
    want = expected_divergence(rows, least, 7)
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_divergence_of_nothing_and_of_one_source(spark, docs):
    assert divergence.divergence(docs.where("false")).count() == 0
    one = spark.createDataFrame([(1, "a a b", "en", "s")] * 40, "doc_id long, text string, lang string, source string")
    assert divergence.divergence(one).count() == 0


def test_counts_are_the_same_however_often_they_are_sent_on(docs, monkeypatch):
    whole = set(map(tuple, divergence.term_counts(docs).collect()))
    real = divergence._count

    def small(batches):
        divergence.HELD = 25
        return real(batches)
    monkeypatch.setattr(divergence, "_count", small)
    assert set(map(tuple, divergence.term_counts(docs).collect())) == whole


def test_joint_cells_against_a_loop():
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 4, (5, 3, 64))  # source, word, term
    share = rng.integers(1, 10**9, (5, 4))
    levels = pd.DataFrame([
        (w, g, share[g, c], int(sum(1 << int(b) for b in np.flatnonzero(counts[g, w] == c)) - (1 << 64 if counts[g, w, 63] == c else 0)), -1)
        for w in range(3) for g in range(5) for c in range(1, 4)], columns=["word", "g", "p", "bits", "full"])
    got = divergence._joint(levels[levels["bits"] != 0], pd.DataFrame({"p": share[:, 0]}))
    p = np.array([share[g][counts[g].ravel()] for g in range(5)])
    assert (got == np.abs(p[:, None] - p[None]).sum(2)).all()


SENTENCE = "The council met on Monday, and after a long debate it agreed to build the bridge. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


CASES = {
    # an article among the usual rest
    "article": (page(
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy now. Really, buy!</div>"
        f"<article><h1>Title</h1><p>{SENTENCE * 3}</p><ul><li>One</li><li>Two &amp; three</li></ul><p>Short.</p>"
        "<aside>See more</aside><div class='comments'><p>First! Great, great post.</p></div></article>"
        "<form><p>Your mail, please.</p><button>Go</button></form><footer>&copy; us</footer>"),
        ["Title", (SENTENCE * 3).strip(), "One", "Two & three", "Short."]),
    # no telling elements: paths alone decide
    "plain": (page(
        "<div id='top'><a href='/a'>Alpha</a> <a href='/b'>Beta</a></div>"
        f"<div class='story'><h2>Heading</h2><p>{SENTENCE * 2}</p><p>{SENTENCE}<a href='/x'>link</a>.</p><blockquote>Quoted, too.</blockquote></div>"
        "<div class='foot'><span>Imprint</span></div>"),
        ["Heading", (SENTENCE * 2).strip(), SENTENCE + "link.", "Quoted, too."]),
    # layout classes name a sidebar and are none; the real one goes
    "layout": (page(
        f"<div class='with-sidebar'><div class='sidebar'><p>Elsewhere, today.</p></div><main><p>{SENTENCE}</p></main></div>"),
        [SENTENCE.strip()]),
    "captions": (page(f"<article>{'<p>' + SENTENCE * 6 + '</p>'}{'<div class=g><figure><figcaption>A view</figcaption></figure></div>' * 30}</article>"),
                 [(SENTENCE * 6).strip()] + ["A view"] * 30),
    "broken": (f"<body><article><p><b>Bold.<br><p>{SENTENCE}<p>Last <i>one</p></article><footer>foo", ["Bold.", SENTENCE.strip(), "Last one"]),
    "references": (page("<article><p>a&nbsp;&lt;b&gt;\n\t c&#233; &amp;amp; &unknown; AT&T</p></article>"), ["a <b> cé &amp; &unknown; AT&T"]),
    "script": (page('<article><p>Before.</p><script>var t="</p><p>no</p>"; if (a<b) {}</script><!-- <p>no</p> --><p>After.</p></article>'),
               ["Before.", "After."]),
    "quotes": (page('<article><p title="a > b">In.</p><p title="it\'s">Out.</p></article>'), ["In.", "Out."]),
    "table": (page(f"<article><p>{SENTENCE}</p><table><tr><td>1<td>2<tr><td>3</table></article>"), [SENTENCE.strip(), "1", "2", "3"]),
    "bare": ("just text, no tags", ["just text, no tags"]),
    "cut": ("<html><body><article><p>Whole.</p><p>Cut o", ["Whole.", "Cut o"]),
    "cut tag": ("<html><body><article><p>Whole.</p><p cla", ["Whole."]),
    "none": (None, []), "empty": ("", []), "blank": (page(" \n "), []), "menu only": (page("<nav><a href='/'>Home</a></nav>"), []),
}


@pytest.mark.parametrize("name", CASES)
def test_main_blocks(name):
    html, want = CASES[name]
    assert extraction.main_blocks(html) == want


def test_short_article_beside_a_longer_advert():
    html = page(f"<div class='ad'>{SENTENCE * 5}</div><article><p>Tiny.</p></article><div class='box'>{SENTENCE * 5}</div>")
    assert extraction.main_blocks(html) == ["Tiny."]


@pytest.mark.parametrize("part", ['<a "', "<div>", "<i>", "<", "<!--", "<script>", "<p>x", "<div>x", "&", "</b>", "<p><table><td><div>", "<a href=x>y"])
def test_long_pages_take_linear_time(part):
    def took(n):
        begin = time.perf_counter()
        extraction.main_blocks(part * n)
        return time.perf_counter() - begin
    took(1000)
    assert took(120_000) < 0.5 + 40 * took(6_000)


def test_pages_of_the_tables(spark, small):
    """Every article of the given pages, read with a plain expression, comes back whole and alone."""
    from html import unescape
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for r in extraction.main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"(?s)<article>(.*?)(</article>|$)", r["html"])[1]
        pieces = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>|<br>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(x for x in pieces if x) and r["n_chars"] == len(r["text"])


def test_rows_of_pages(spark):
    data = spark.createDataFrame(
        [(1, "u", CASES["article"][0], "t"), (1, "u", CASES["article"][0], "t"), (None, None, None, "t"), (2, None, "", "t")],
        "page_id long, url string, html string, text string")
    out = extraction.main_text(data).collect()
    assert [(r["page_id"], r["url"], r["n_chars"] > 0) for r in out] == [(1, "u", True), (1, "u", True), (None, None, False), (2, None, False)]
    assert out[2]["text"] == "" and extraction.main_text(data.where("false")).count() == 0
