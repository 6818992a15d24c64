"""Language identification: a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.session import materialize

WINDOW = 256            # bytes of a window
WIDTHS = (2, 3, 4)      # bytes that a filter sees
FILTERS = 8             # filters of each width
AT_ONCE = 512           # windows per matrix


@dataclass
class Model:
    """Filters, their bias, and the softmax layer, for the labels in ``langs``."""

    langs: list[str] = field(default_factory=list)
    filters: dict[int, np.ndarray] = field(default_factory=dict)   # width: (width, 256, FILTERS)
    shift: dict[int, np.ndarray] = field(default_factory=dict)
    dense: np.ndarray | None = None
    bias: np.ndarray | None = None


def windows(text: str, size: int = WINDOW) -> np.ndarray:
    """The whole text as rows of ``size`` bytes, ASCII lower-cased; the last one filled up with spaces."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    out = np.full((max(1, -(-len(raw) // size)), size), 32, np.uint8)
    out.reshape(-1)[:len(raw)] = raw
    return out


def _maps(filters: np.ndarray, x: np.ndarray) -> np.ndarray:
    """(rows, places, filters): the convolution of one-hot bytes is a sum of table rows."""
    width = len(filters)
    span = x.shape[1] - width + 1
    total = filters[0][x[:, :span]]
    for i in range(1, width):
        total = total + filters[i][x[:, i:i + span]]
    return total


def _pairs(filters: np.ndarray) -> list[np.ndarray]:
    """The tables of two neighbouring bytes each, so that a window needs half the look-ups."""
    tables = []
    for i in range(0, len(filters), 2):
        two = filters[i][:, None, :] + (filters[i + 1][None] if i + 1 < len(filters) else 0.0 * filters[i][None])
        tables.append(two.reshape(65536, -1).astype(np.float32))
    return tables


def pooled(model: Model, x: np.ndarray, tables: dict[int, list[np.ndarray]] | None = None) -> np.ndarray:
    """Largest value of each filter over a window, not below zero."""
    out = []
    for width in WIDTHS:
        if tables is None:
            best = _maps(model.filters[width], x).max(1)
        else:
            pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            span = x.shape[1] - width + 1
            total = None
            for k, t in enumerate(tables[width]):
                at = 2 * k
                if at + 1 < width:
                    rows = np.take(t, pair[:, at:at + span], axis=0)
                else:  # the last byte stands alone: any second byte, all give the same row
                    rows = np.take(t[::256], x[:, at:at + span], axis=0)
                total = rows if total is None else total + rows
            best = total.max(1)
        out.append(np.maximum(best + model.shift[width], 0.0))
    return np.hstack(out)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], labels: list[str], epochs: int = 6, per_text: int = 4, seed: int = 11) -> Model:
    """Fit by mini-batch Adam on windows of the texts; the gradient flows through each filter's best place."""
    langs = sorted(set(labels))
    if not langs:
        return Model()
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for text, label in zip(texts, labels):
        w = windows(text)
        pick = w if len(w) <= per_text else w[np.sort(rng.choice(len(w), per_text, replace=False))]
        xs.append(pick)
        ys += [langs.index(label)] * len(pick)
    x, y = np.vstack(xs), np.array(ys)
    n_out = len(langs)
    model = Model(langs, {w: rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS},
                  {w: np.zeros(FILTERS) for w in WIDTHS}, rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n_out)),
                  np.zeros(n_out))
    params = [*model.filters.values(), *model.shift.values(), model.dense, model.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.bincount(y, minlength=n_out) / len(y)
    weight, step = 1 / np.maximum(share, 1e-6) ** 0.5, 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            bx, by = x[at], y[at]
            tops, acts = {}, []
            for w in WIDTHS:
                m = _maps(model.filters[w], bx)
                tops[w] = m.argmax(1)
                acts.append(np.take_along_axis(m, tops[w][:, None], 1)[:, 0] + model.shift[w])
            raw = np.hstack(acts)
            h = np.maximum(raw, 0)
            p = _softmax(h @ model.dense + model.bias)
            p[np.arange(len(by)), by] -= 1
            p *= weight[by][:, None] / len(by)
            back = (p @ model.dense.T) * (raw > 0)
            grads_f, grads_s = [], []
            for k, w in enumerate(WIDTHS):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                gf = np.zeros_like(model.filters[w])
                for i in range(w):
                    byte = np.take_along_axis(bx, tops[w] + i, 1)
                    np.add.at(gf[i], (byte, np.arange(FILTERS)[None]), g)
                grads_f.append(gf)
                grads_s.append(g.sum(0))
            step += 1
            for q, g, m1, m2 in zip(params, [*grads_f, *grads_s, h.T @ p, p.sum(0)], first, second):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                q -= 0.01 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, train_rows: Column, sample: int = 3_000, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Train on at most ``sample`` labelled rows, the smallest by md5 of the id among ``train_rows``.

    Rows without language or text are left out. Of a sampled text, windows drawn
    from its whole length are learned; texts beyond 2 MB are left out of the
    sample, so that its size is bounded.
    """
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    usable = train_rows & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (
        F.octet_length(text_col) <= 2_000_000)
    chosen = docs.where(usable).select(F.col(id_col).alias("id"), order.alias("o"), F.col(lang_col).alias("lang"))
    chosen = materialize(chosen.orderBy("o", "lang").limit(sample).select("id", "lang").distinct())
    # windows are drawn where the texts are, so that the driver gets a few per row
    texts = docs.where(train_rows & (F.octet_length(text_col) <= 2_000_000)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    got = texts.mapInArrow(_drawn, "id long, lang string, text binary").orderBy("id", "text").limit(sample).toPandas()
    return train([bytes(b).decode("utf-8", "replace") for b in got["text"]], got["lang"].tolist())


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        drawn = []
        for text in batch.column("text").to_pylist():
            w = windows(text)
            keep = np.unique(np.linspace(0, len(w) - 1, min(len(w), 6)).astype(int))
            drawn.append(w[keep].tobytes())
        yield pa.RecordBatch.from_pydict({"id": batch.column("id").cast(pa.int64()), "lang": batch.column("lang"),
                                          "text": pa.array(drawn, pa.binary())})


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and probability of each whole text: the mean log probability of its windows."""
    tables = {w: _pairs(model.filters[w]) for w in WIDTHS} if model.langs else {}
    return _predict(model, tables, texts)


def _predict(model: Model, tables: dict, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not model.langs:
        return names, scores
    held, owner, rows = [], [], 0
    total = np.zeros((len(texts), len(model.langs)))

    def flush() -> None:
        nonlocal rows
        if held:
            x, who = np.vstack(held), np.concatenate(owner)
            for at in range(0, len(x), AT_ONCE):
                p = _softmax(pooled(model, x[at:at + AT_ONCE], tables) @ model.dense + model.bias)
                np.add.at(total, who[at:at + AT_ONCE], np.log(np.maximum(p, 1e-9)))
            held.clear()
            owner.clear()
            rows = 0

    lengths = np.ones(len(texts))
    for i, text in enumerate(texts):
        if text and any(c.isalpha() for c in text):
            w = windows(text)
            held.append(w)
            owner.append(np.full(len(w), i))
            lengths[i] = len(w)
            rows += len(w)
            names[i] = ""
            if rows >= 4 * AT_ONCE:
                flush()
    flush()
    p = _softmax(total / lengths[:, None])
    for i, name in enumerate(names):
        if name == "":
            names[i], scores[i] = model.langs[int(p[i].argmax())], float(p[i].max())
    return names, scores


def language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the language of every whole text; no other column is read.

    A text is cut into windows of ``WINDOW`` bytes; in each, filters of several
    widths slide over the bytes, the largest value of each filter goes through
    the softmax, and the log probabilities of the windows are averaged. Null
    texts and texts without a letter are ``und`` with score 0, as is every text
    if there was nothing to learn from. Rows that repeat an id are predicted one
    by one. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {w: _pairs(model.filters[w]) for w in WIDTHS} if model.langs else {}
        for batch in batches:
            names, scores = _predict(model, tables, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "lang_pred": pa.array(names, pa.string()),
                                              "score": pa.array(scores, pa.float64())})

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
