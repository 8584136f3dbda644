"""Toxicity by subword-bag embeddings and a linear softmax, trained together in numpy.

A word is the mean of the vectors of its character n-grams (3 to 5, with word borders, hashed in
2**18 buckets), so an unseen spelling shares most of its vector with known ones. A window of 24
words is the mean of its distinct words, padded with zero vectors where there are fewer, and a
linear softmax over that mean gives its odds. A text is as toxic as its worst window, so length
does not dilute it; training weighs the windows of a text by the same odds. Every window of every
text is scored.

As the softmax is linear, a trained bucket is one number (its vector against the class weights):
scoring adds numbers per word, remembered for words seen before.

Training takes at most MAX_PER_CLASS labelled texts a class, none above MAX_CHARS characters, the
first by a hash of the id: a bounded sample, with a fixed number of steps. It runs in the driver, which
holds four bytes for each n-gram of each distinct word; all else by n-gram is made for CHUNK of them at a time.

Nulls: a null or empty text has no window and gets the score of a window without evidence. Null
labels do not train. With labels of fewer than two kinds every score is 0. Repeated rows are
scored each. An empty table gives an empty result. Other columns play no part, whatever their
names; `accepted` hands them on. Texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import fold, named, self_contained

NGRAMS, BUCKETS, DIM = (3, 4, 5), 1 << 18, 6
WINDOW = 24
MAX_PER_CLASS, MAX_CHARS = 1500, 20_000
STEPS, RATE, DECAY, MIN_TEXTS = 150, 2.0, 0.002, 5
# N-grams that training looks at together, and words whose n-grams are hashed together.
CHUNK, WORDS_AT_ONCE = 100_000, 5_000
# Words remembered by a worker, in each of two halves.
CACHE = 100_000
_STRIP = ".,;:!?\"'()[]{}<>*_~`-%&$#@/\\|=+…“”‘’«»¡¿"

self_contained(__name__)


def tokens(text: str) -> list[str]:
    return text.lower().split()


def subwords(words: list[str], ngrams=NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the n-grams of all words, one after the other, and how many each word has.

    All words are laid out in one array of code points, and the n-grams of one length are hashed at
    once; those that run across a border between words are left out.
    """
    marked = [f"<{w.strip(_STRIP)}>" for w in words]
    sizes = np.array([len(m) for m in marked])
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
    ids, whose = [], []
    for n in ngrams:
        at = np.flatnonzero(left >= n)
        mixed = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            mixed = (mixed ^ points[at + k]) * np.uint64(0x100000001B3)
            mixed ^= mixed >> np.uint64(29)
        ids.append(mixed % np.uint64(buckets))
        whose.append(owner[at])
    whose = np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return np.concatenate(ids)[order].astype(np.int64), np.bincount(whose, minlength=len(words))


def word_means(values: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of `values[ids]` over the n-grams of each word; words without any get 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values[ids], axis=0, dtype=np.float64)])
    end = np.cumsum(counts)
    return (total[end] - total[end - counts]) / np.maximum(counts, 1).reshape(-1, *[1] * (values.ndim - 1))


def _vocabulary_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As `subwords`, with bucket numbers of four bytes."""
    ids, counts = [], []
    for at in range(0, len(words), WORDS_AT_ONCE):
        part, sizes = subwords(words[at:at + WORDS_AT_ONCE])
        ids.append(part.astype(np.int32))
        counts.append(sizes)
    return np.concatenate(ids), np.concatenate(counts)


def _chunks(counts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Runs of words with some CHUNK n-grams: first word, end, first n-gram, end."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], CHUNK)), len(counts)))
    return [(a, b, ends[a], ends[b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def _grams_by_text(docs: list[np.ndarray], ids: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    ends = np.cumsum(counts)
    for doc in docs:
        yield np.concatenate([ids[ends[w] - counts[w]:ends[w]] for w in np.unique(doc)])


def train(texts: list[str], labels: list[int], seed: int = 7) -> tuple[np.ndarray, float] | None:
    """(bucket scores, bias): log odds are the bias plus the mean bucket score; None without both labels."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in tokens(t)], dtype=np.int64) for t in texts]
    kept = [i for i, d in enumerate(docs) if len(d)]
    docs, y = [docs[i] for i in kept], np.array([labels[i] for i in kept], dtype=np.float64)
    if len(set(y)) < 2:
        return None
    ids, counts = _vocabulary_grams(list(vocabulary))
    n_words = len(vocabulary)
    del vocabulary
    # Buckets seen in few texts only teach those texts by heart; they stay at zero.
    texts_with = np.zeros(BUCKETS, dtype=np.int64)
    for part in _grams_by_text(docs, ids, counts):
        texts_with[np.unique(part)] += 1
    used = np.flatnonzero(texts_with >= MIN_TEXTS)
    if not len(used):
        return None
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    grams = number[ids]
    del ids
    per_word = np.concatenate([np.bincount(np.repeat(np.arange(b - a), counts[a:b])[grams[at:end] >= 0], minlength=b - a) for a, b, at, end in _chunks(counts)])
    grams = grams[grams >= 0]
    weight_in_word = (1 / np.maximum(counts, 1)).astype(np.float32)
    chunks = _chunks(per_word)
    words = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    per_doc = -(-sizes // WINDOW)
    doc_of = np.repeat(np.arange(len(docs)), per_doc)
    first = np.repeat(np.cumsum(sizes) - sizes, per_doc) + WINDOW * (np.arange(len(doc_of)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc))
    window_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    # A window is a set of words: repeats count once.
    pairs = window_of * n_words + words
    pairs.sort()
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    window_of, words = np.divmod(pairs, n_words)
    del pairs
    doc_start = np.cumsum(per_doc) - per_doc
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))

    E = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    W, bias = rng.normal(0, 0.3, DIM).astype(np.float32), 0.0
    speed = [np.zeros_like(E), np.zeros_like(W), 0.0]
    scale = [0.0, 0.0, 0.0]

    def means(per_bucket: np.ndarray) -> np.ndarray:
        out = np.empty(n_words)
        for a, b, at, end in chunks:
            own = np.repeat(np.arange(b - a), per_word[a:b])
            out[a:b] = np.bincount(own, weights=per_bucket[grams[at:end]] * weight_in_word[a:b][own], minlength=b - a)
        return out

    def by_bucket(per_word_error: np.ndarray) -> np.ndarray:
        """One n-gram after the other, so that sums do not depend on CHUNK."""
        out = np.zeros(len(used))
        share_of_gram = per_word_error * weight_in_word
        for a, b, at, end in chunks:
            np.add.at(out, grams[at:end], np.repeat(share_of_gram[a:b], per_word[a:b]))
        return out.astype(np.float32)

    def forward() -> np.ndarray:
        return np.bincount(window_of, weights=means(E @ W)[words], minlength=len(first)) / WINDOW + bias

    for step in range(1, STEPS + 1):
        odds = forward()
        # The worst windows stand for the text; early on, all of them do.
        sharp = odds * min(1.0, step / 20) * 2
        sharp = np.exp(sharp - np.maximum.reduceat(sharp, doc_start)[doc_of])
        weight = sharp / np.add.reduceat(sharp, doc_start)[doc_of]
        doc_odds = np.add.reduceat(weight * odds, doc_start)
        error = (1 / (1 + np.exp(-np.clip(doc_odds, -30, 30))) - y) * share
        d_window = error[doc_of] * weight / WINDOW
        d_word = np.bincount(words, weights=d_window[window_of], minlength=n_words)
        d_bucket = by_bucket(d_word)
        gradients = [d_bucket[:, None] * W, E.T @ d_bucket, error.sum()]
        # One step size per parameter block, so that buckets move as far as their evidence goes.
        for i, g in enumerate(gradients):
            speed[i] = 0.9 * speed[i] + 0.1 * g
            scale[i] = max(0.95 * scale[i], float(np.abs(g).max()))
        falling = RATE * min(1.0, 1.5 * (1 - step / (STEPS + 1)))
        rates = [falling * s / max(c, 1e-12) for s, c in zip(speed, scale)]
        E, W, bias = E * (1 - DECAY) - rates[0], W * (1 - DECAY) - 0.1 * rates[1], bias - 0.3 * rates[2]
    odds = forward()
    worst = np.maximum.reduceat(odds, doc_start)
    # Half way between nearly all clean and nearly all toxic texts of the sample.
    middle = (np.quantile(worst[y == 0], 0.999) + np.quantile(worst[y == 1], 0.02)) / 2
    scores = np.zeros(BUCKETS, dtype=np.float32)
    scores[used] = E @ W
    return scores, float(bias - middle)


class Scorer:
    """Scores texts, with a memory of words in two halves, so that common words are not forgotten."""

    def __init__(self, scores: np.ndarray, bias: float):
        self.scores, self.bias = scores, bias
        self.known: dict[str, float] = {}
        self.older: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        """Makes all `words` known."""
        if len(self.known) + len(words) > CACHE:
            self.older, self.known = self.known, {}
        missing = []
        for w in words:
            if w not in self.known:
                old = self.older.get(w)
                if old is None:
                    missing.append(w)
                else:
                    self.known[w] = old
        for at in range(0, len(missing), 20_000):
            part = missing[at:at + 20_000]
            self.known.update(zip(part, word_means(self.scores, *subwords(part)).tolist()))

    def odds(self, words: list[str]) -> float:
        if not words:
            return self.bias
        known = self.known
        windows = [set(words[at:at + WINDOW]) for at in range(0, len(words), WINDOW)]
        return self.bias + max(sum(map(known.__getitem__, w)) for w in windows) / WINDOW

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = []
        for at in range(0, len(texts), 50):
            part = [tokens(t or "") for t in texts[at:at + 50]]
            self.learn({w for words in part for w in words})
            out += [self.odds(words) for words in part]
        return 1 / (1 + np.exp(-np.clip(np.array(out, dtype=np.float64), -30, 30)))


def scorer_of(shared: dict) -> Scorer | None:
    """The scorer of a broadcast model, kept with its memory by the worker."""
    if shared["model"] is not None and "scorer" not in shared:
        shared["scorer"] = Scorer(*shared["model"])
    return shared.get("scorer")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """Trains on a bounded sample of the labelled rows outside fold 0: ids are chosen for both
    classes at once, then their texts fetched."""
    marked = named(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = named(docs, "doc_id", "text").where((fold(F.col("doc_id")) != 0) & (F.char_length("text") <= MAX_CHARS))

    def first(table: DataFrame, *more: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", *more))
        return table.withColumn("n", nth).where(F.col("n") <= MAX_PER_CLASS)

    chosen = first(rows.select("doc_id").join(marked, "doc_id").distinct()).drop("n")
    # At most two classes of ids; repeated rows of them are cut again.
    found = first(rows.join(F.broadcast(chosen), "doc_id"), "text").orderBy("toxic", "n").collect()
    return train([r.text for r in found], [r.toxic for r in found])


def scored(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """Every row, its columns renamed _0, _1, ... by position, and `score` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})
    text = docs.columns.index("text")
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            texts = batch.column(text)
            scores = np.zeros(len(texts)) if scorer is None else scorer.score(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return rows.mapInArrow(run, f"{fields}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    docs = named(docs, "doc_id", "text")
    rows = scored(docs, fit(docs, labels)).withColumnRenamed("_0", "doc_id")
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, in the columns of `docs`."""
    rows = scored(docs, fit(docs, labels)).where("score < 0.5")
    return rows.select(*[F.col(f"_{i}").alias(name) for i, name in enumerate(docs.columns)])
