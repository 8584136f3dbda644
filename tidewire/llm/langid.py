"""Language identification by a byte convolutional network.

Texts are UTF-8 bytes in windows of 256 that overlap by one filter less a byte. A window goes
through filters of widths 2, 3 and 4 over byte embeddings, max pooling and a softmax; a text gets
the mean of the probabilities of all its windows, weighted by their bytes. Trained in numpy on
labelled texts.

Scoring needs no embeddings: a filter over two bytes is a table of 65,536 rows, a filter over
four is the sum of two such tables, so a batch of windows is a few table look-ups.

Training takes at most MAX_TEXTS labelled texts, none above MAX_CHARS characters, the first by a
hash of the id, and the first LANG_TEXTS of every language, so that a rare one is learned at any
size: at most MAX_TEXTS plus LANG_TEXTS times the languages, with a fixed number of steps.

Nulls: a text that is null or has no letter is `und` with score 0. Null languages do not train; if
there is none at all, every text is `und`. Repeated rows are judged each. An empty table gives an
empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import fold, sampled, self_contained

WIDTHS, FILTERS, EMBEDDING, WINDOW = (2, 3, 4), 12, 8, 256
MAX_TEXTS, LANG_TEXTS, MAX_CHARS = 2000, 20, 20_000
STEPS, BATCH, RATE = 700, 64, 0.01
UNKNOWN = "und"
# Windows scored at once.
CHUNK = 256

self_contained(__name__)


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, padded with zero bytes, and how many bytes each has."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    flat = np.zeros(step * (n - 1) + WINDOW, dtype=np.uint8)
    flat[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    starts = step * np.arange(n)
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[starts], np.minimum(len(data) - starts, WINDOW).clip(1)


class Network:
    """Parameters and the training pass."""

    def __init__(self, classes: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (256, EMBEDDING))
        self.filters = [rng.normal(0, 0.3, (w * EMBEDDING, FILTERS)) for w in WIDTHS]
        self.offsets = [np.zeros(FILTERS) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes))
        self.out_offset = np.zeros(classes)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.offsets, self.out, self.out_offset]

    def gradients(self, rows: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over windows `rows` with classes `y`."""
        n = len(rows)
        pooled, caches = [], []
        for w, k, b in zip(WIDTHS, self.filters, self.offsets):
            spots = np.lib.stride_tricks.sliding_window_view(rows, w, axis=1)
            x = self.embedding[spots].reshape(n, spots.shape[1], -1)
            z = x @ k
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0] + b
            pooled.append(np.maximum(top, 0))
            caches.append((spots, x, best, top > 0))
        h = np.concatenate(pooled, axis=1)
        logits = h @ self.out + self.out_offset
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), y] -= 1
        p /= n
        d_h = p @ self.out.T
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_offsets = [], []
        for i, (w, k, (spots, x, best, on)) in enumerate(zip(WIDTHS, self.filters, caches)):
            d = d_h[:, i * FILTERS:(i + 1) * FILTERS] * on
            d_offsets.append(d.sum(axis=0))
            picked = np.take_along_axis(x, best[:, :, None], axis=1)
            d_filters.append(np.einsum("nfe,nf->ef", picked, d))
            bytes_ = np.take_along_axis(spots, best[:, :, None], axis=1)
            d_x = (d[:, :, None] * k.T[None]).reshape(n, FILTERS, w, EMBEDDING)
            np.add.at(d_embedding, bytes_.reshape(-1), d_x.reshape(-1, EMBEDDING))
        return [d_embedding, *d_filters, *d_offsets, h.T @ p, p.sum(axis=0)]

    def tables(self) -> dict:
        """What scoring needs: per filter width its tables by byte pair (or single byte), and the softmax."""
        found = []
        for w, k, b in zip(WIDTHS, self.filters, self.offsets):
            single = [(self.embedding @ k[j * EMBEDDING:(j + 1) * EMBEDDING]).astype(np.float32) for j in range(w)]
            parts = [((single[j][:, None] + single[j + 1][None, :]).reshape(65536, FILTERS), j, True) for j in range(0, w - 1, 2)]
            if w % 2:
                parts.append((single[-1], w - 1, False))
            found.append((w, parts, b.astype(np.float32)))
        return {"widths": found, "out": self.out.astype(np.float32), "out_offset": self.out_offset.astype(np.float32)}


def train(texts: list[str], languages: list[str]) -> dict | None:
    classes = sorted(set(languages))
    if not classes:
        return None
    each = [windows(t.encode("utf-8", "replace"))[0] for t in texts]
    rows = np.concatenate(each)
    y = np.repeat([classes.index(c) for c in languages], [len(e) for e in each])
    rng = np.random.default_rng(3)
    by_class = [np.flatnonzero(y == c) for c in range(len(classes))]
    network = Network(len(classes))
    parameters = network.parameters()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    for step in range(1, STEPS + 1):
        # Classes in turn, so that rare ones train as much; some windows are cut short as short texts are.
        picked = np.array([rng.choice(by_class[c]) for c in rng.integers(len(classes), size=BATCH)])
        batch = rows[picked].copy()
        for i in np.flatnonzero(rng.random(BATCH) < 0.3):
            batch[i, rng.integers(8, WINDOW):] = 0
        for p, g, (m, v) in zip(parameters, network.gradients(batch, y[picked]), moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"classes": classes, **network.tables()}


def probabilities(model: dict, rows: np.ndarray) -> np.ndarray:
    """Probabilities of the classes for each window."""
    wide = rows.astype(np.int32)
    pair = wide[:, :-1] * 256 + wide[:, 1:]
    pooled = []
    for w, parts, b in model["widths"]:
        spots = WINDOW - w + 1
        z = None
        for values, at, two in parts:
            found = np.take(values, (pair if two else wide)[:, at:at + spots], axis=0)
            z = found if z is None else np.add(z, found, out=z)
        pooled.append(np.maximum(z.max(axis=1) + b, 0))
    logits = np.concatenate(pooled, axis=1) @ model["out"] + model["out_offset"]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def predict(model: dict | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model is None:
        return names, scores
    wanted = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    # Short texts share a chunk of windows; a long text fills several.
    pending, total = [], np.zeros((len(texts), len(model["classes"])))
    held = 0

    def flush() -> None:
        nonlocal pending, held
        if pending:
            shares = probabilities(model, np.concatenate([r for _, r, _ in pending]))
            owner = np.concatenate([np.full(len(r), i) for i, r, _ in pending])
            np.add.at(total, owner, shares * np.concatenate([n for _, _, n in pending])[:, None])
        pending, held = [], 0

    for i in wanted:
        rows, sizes = windows(texts[i].encode("utf-8", "replace"))
        for at in range(0, len(rows), CHUNK):
            pending.append((i, rows[at:at + CHUNK], sizes[at:at + CHUNK]))
            held += len(pending[-1][1])
            if held >= CHUNK:
                flush()
    flush()
    for i in wanted:
        p = total[i]
        names[i], scores[i] = model["classes"][int(p.argmax())], float(p.max() / p.sum())
    return names, scores


def of_each_language(rows: DataFrame) -> DataFrame:
    """The first LANG_TEXTS of `rows`(doc_id, text, lang) of every language; texts of other rows are not moved."""
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(*by))
    ids = rows.where("doc_id IS NOT NULL").select("doc_id", "lang").distinct().withColumn("n", nth).where(F.col("n") <= LANG_TEXTS).drop("n")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(*by, "text"))
    return rows.join(F.broadcast(ids), ["doc_id", "lang"]).withColumn("n", nth).where(F.col("n") <= LANG_TEXTS).orderBy("lang", "n").select("doc_id", "text", "lang")


def fit(docs: DataFrame) -> dict | None:
    """Trains on a bounded sample of the rows outside fold 0 that have a language."""
    usable = (fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & (F.char_length("text") <= MAX_CHARS) & F.col("text").rlike(r"\p{L}")
    rows = docs.where(usable).select("doc_id", "text", "lang")
    found = sampled(rows, rows.select("doc_id"), MAX_TEXTS).collect()
    known = {(r.doc_id, r.text, r.lang) for r in found}
    found += [r for r in of_each_language(rows).collect() if (r.doc_id, r.text, r.lang) not in known]
    return train([r.text for r in found], [r.lang for r in found])


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
