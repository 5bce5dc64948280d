"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams. A window of words is the average of
the embeddings of all its n-grams, and a linear softmax over that average says how
likely the window is toxic. Embeddings and softmax are trained jointly, in numpy, on
windows of a bounded sample of labelled documents. Misspelt and inflected words that
never occurred in training still share n-gram vectors with those that did.

Labels are per document, so training pools the windows of a document, from their mean at
first towards their maximum at last.

A document scores as its most toxic window, over the whole text, so that the length of
a text does not thin out what it contains.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import fresh, mapped, release_memory

WINDOW = 3
STRIDE = 1
GRAMS = (3, 4, 5)
BUCKETS = 1 << 19
DIMENSIONS = 2
STEPS = 80
#: Per step, the embedding of a bucket that n word-document pairs hold shrinks by decay * (1 + RARE / n).
RARE = 10
CALIBRATE = 6
SHARPNESS = (0.3, 3.0)
#: Bounds of the training sample: documents per label, and windows of one document per label, spread over its text.
SAMPLE_DOCS = {0: 2500, 1: 800}
SAMPLE_WINDOWS = {0: 160, 1: 200}
FOLDS = 5
#: Words whose sums a task keeps before it starts afresh.
CACHED_WORDS = 400_000
LONGEST_WORD = 64
#: Entries of an index that a sum of the training takes at a time, so that its copies stay small.
BLOCK = 1 << 16


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows whose labels are never learnt from; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == 0, F.lit(True))


def grams(word: str) -> list[int]:
    """Buckets of a word's n-grams. Of a word beyond LONGEST_WORD characters every stretch counts alike."""
    marked = f"<{word}>"
    if len(marked) <= GRAMS[0]:
        return [zlib.crc32(marked.encode()) % BUCKETS]
    return [
        zlib.crc32(marked[i : i + n].encode()) % BUCKETS for n in GRAMS for i in range(len(marked) - n + 1)
    ]


def words_of(text: str | None) -> list[str]:
    """Lower-case words; a stretch without blanks beyond LONGEST_WORD is cut into several words."""
    words = (text or "").lower().split()
    if any(len(w) > LONGEST_WORD for w in words):
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return words


def window_starts(n: int) -> range:
    """Starts of the windows over n words; the last window ends with the text."""
    return range(0, max(n - WINDOW + STRIDE, 0) + 1, STRIDE) if n > WINDOW else range(1)


def _sample_windows(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words, most = words_of(text), SAMPLE_WINDOWS[toxic]
            starts = window_starts(len(words))
            step = -(-len(starts) // most)
            found.append("\n".join(" ".join(words[s : s + WINDOW]) for s in starts[::step]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.string())],
            names=["doc_id", "toxic", "windows"],
        )


def known_labels(labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(doc_id, toxic) that may be learnt from; null ids, null labels and held-out rows may not."""
    return labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), folds)
    )


def training_sample(docs: DataFrame, known: DataFrame) -> list[tuple[int, int, list[str]]]:
    """(doc_id, toxic, windows) of at most SAMPLE_DOCS documents, chosen by a hash of their id.

    One row per labelled id that has a document, whatever repeats: the text with the smallest hash.
    Labels without a document take no place.
    """
    order = F.md5(F.col("doc_id").cast("string"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    one = hashed.groupBy("doc_id").agg(F.min("hash").alias("hash"))
    labelled = one.join(known.distinct(), "doc_id")
    parts = [
        labelled.filter(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(n) for toxic, n in SAMPLE_DOCS.items()
    ]
    chosen = parts[0].unionByName(parts[1])
    texts = hashed.join(F.broadcast(chosen), ["doc_id", "hash"]).select("doc_id", "toxic", "text")
    cut = texts.transform(mapped, _sample_windows, "doc_id long, toxic int, windows string")
    # Rows that agree in doc_id and text come together before they reach the driver.
    rows = cut.groupBy("doc_id", "toxic").agg(F.min("windows").alias("windows")).collect()
    return sorted((r["doc_id"], r["toxic"], r["windows"].split("\n")) for r in rows)


@dataclass(frozen=True)
class Model:
    """The softmax's log odds as a sum over buckets: embeddings and weights multiplied out."""

    bucket_odds: np.ndarray
    bias: float

    def odds(self, texts: list[str | None], cache: dict[str, tuple[float, int]]) -> list[float]:
        """Log odds of each text's most toxic window."""
        table, out = self.bucket_odds, []
        for text in texts:
            words = words_of(text)
            if not words:
                out.append(self.bias)
                continue
            if len(cache) > CACHED_WORDS:
                cache.clear()
            for word in set(words).difference(cache):
                ids = grams(word)
                cache[word] = float(table[ids].sum()), len(ids)
            pairs = np.array([cache[w] for w in words])
            sums = np.vstack([np.zeros((1, 2)), pairs.cumsum(axis=0)])
            starts = np.array(window_starts(len(words)))
            total = sums[np.minimum(starts + WINDOW, len(words))] - sums[starts]
            out.append(float((total[:, 0] / np.maximum(total[:, 1], 1)).max()) + self.bias)
        return out


def _summed(index: np.ndarray, weights: Callable[[slice], np.ndarray], size: int) -> np.ndarray:
    """`np.bincount` in the same order of additions, but block by block, as it copies index and weights."""
    out = np.zeros(size)
    for at in range(0, len(index), BLOCK):
        part = slice(at, at + BLOCK)
        np.add.at(out, index[part].astype(np.intp), weights(part))
    return out


class _Bags:
    """Windows as averages over n-grams, by way of their distinct words. Words and n-grams are kept in packed arrays only."""

    def __init__(self, documents: Iterable[list[str]]):
        place: dict[str, int] = {}
        words, sizes, word_docs = array("i"), array("i"), array("i")
        for listed in documents:
            first = len(words)
            for window in listed:
                before = len(words)
                words.extend(place.setdefault(w, len(place)) for w in window.split(" ") if w)
                if len(words) == before:
                    words.append(place.setdefault("", len(place)))
                sizes.append(len(words) - before)
            word_docs.extend([0] * (len(place) - len(word_docs)))
            for w in set(words[first:]):
                word_docs[w] += 1
        found, word_sizes = array("i"), array("i")
        for word in place:
            before = len(found)
            found.extend(grams(word))
            word_sizes.append(len(found) - before)
        self.word_sizes, self.grams, self.words = (np.frombuffer(x, dtype=np.int32) for x in (word_sizes, found, words))
        self.word_of_gram = np.repeat(np.arange(len(word_sizes), dtype=np.int32), self.word_sizes)
        self.window_of_word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        # A bucket that few documents hold says more about them than about the label; its embedding shrinks faster.
        held_by = np.frombuffer(word_docs, dtype=np.int32)
        self.docs = _summed(self.grams, lambda part: held_by[self.word_of_gram[part]], BUCKETS)
        self.totals = _summed(self.window_of_word, lambda part: self.word_sizes[self.words[part]], len(sizes))

    def average(self, table: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.totals), table.shape[1]))
        for d, column in enumerate(table.T):
            per_word = _summed(self.word_of_gram, lambda part: column[self.grams[part]], len(self.word_sizes))
            out[:, d] = _summed(self.window_of_word, lambda part: per_word[self.words[part]], len(out)) / self.totals
        return out

    def spread(self, grad: np.ndarray) -> np.ndarray:
        """Gradient of the embeddings, from that of the averages."""
        out = np.empty((BUCKETS, grad.shape[1]))
        for d, column in enumerate(grad.T):
            share = column / self.totals
            per_word = _summed(self.words, lambda part: share[self.window_of_word[part]], len(self.word_sizes))
            out[:, d] = _summed(self.grams, lambda part: per_word[self.word_of_gram[part]], BUCKETS)
        return out


def train(
    sample: list[tuple[int, int, list[str]]],
    share: float = 0.5,
    steps: int = STEPS,
    rate: float = 0.1,
    decay: float = 0.02,
    seed: int = 7,
) -> Model:
    """Full-batch Adam over embeddings, weights and bias. One class or no rows give a constant model.

    A document's odds pool those of its windows by a log mean exponential that sharpens
    from the mean to the maximum, so that a toxic document need not be toxic throughout.
    `share` is the toxic share of all labelled documents. Every CALIBRATE-th document is
    left out and only sets the scale of the odds.
    """
    held = [row for i, row in enumerate(sample) if row[2] and i % CALIBRATE == 0]
    sample = [row for i, row in enumerate(sample) if row[2] and i % CALIBRATE]
    label = np.array([t for _, t, _ in sample])
    if len(set(label.tolist())) < 2:
        constant = 4.0 if len(label) and label[0] == 1 else -4.0
        return Model(np.zeros(BUCKETS, dtype=np.float32), constant)
    sizes = np.array([len(listed) for _, _, listed in sample])
    starts = np.concatenate([[0], sizes.cumsum()[:-1]])
    doc = np.repeat(np.arange(len(sample)), sizes)
    bags = _Bags(listed for _, _, listed in sample)
    del sample  # the windows; only the bags are needed from here on
    class_weight = 0.5 / np.bincount(label)[label]
    rng = np.random.default_rng(seed)
    # No cut by count: what a bucket may weigh falls smoothly with its documents, at any size of the sample.
    shrink = np.minimum(decay * (1 + RARE / np.maximum(bags.docs, 1)), 0.9)[:, None]
    seen = bags.docs[:, None] > 0
    params = [rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)), rng.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)]
    params[0] *= seen
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        sharp = SHARPNESS[0] * (SHARPNESS[1] / SHARPNESS[0]) ** (step / steps)
        h = bags.average(params[0])
        z = h @ params[1] + params[2]
        odds = z[:, 1] - z[:, 0]
        top = np.maximum.reduceat(odds, starts)
        part = np.exp(sharp * (odds - top[doc]))
        total = np.add.reduceat(part, starts)
        pooled = top + np.log(total / sizes) / sharp
        slope = class_weight * (1 / (1 + np.exp(-np.clip(pooled, -50, 50))) - label)
        d_odds = slope[doc] * part / total[doc]
        dz = np.stack([-d_odds, d_odds], axis=1)
        for i, g in enumerate([bags.spread(dz @ params[1].T), h.T @ dz, dz.sum(axis=0)]):
            means[i] *= 0.9
            means[i] += 0.1 * g
            squares[i] *= 0.99
            squares[i] += 0.01 * g * g
            size = np.sqrt(squares[i] / (1 - 0.99**step))
            size += 1e-8
            move = means[i] / (1 - 0.9**step)
            move /= size
            move *= rate
            params[i] *= 1 - shrink if i == 0 else 1
            params[i] -= move
    odds_of = (params[0] @ (params[1][:, 1] - params[1][:, 0])).astype(np.float32)
    model = Model(odds_of, float(params[2][1] - params[2][0]))
    return calibrated(model, held, share)


def calibrated(model: Model, held: list[tuple[int, int, list[str]]], share: float) -> Model:
    """Scales and shifts the odds to fit documents that were not trained on, at the labels' true shares."""
    label = np.array([t for _, t, _ in held], dtype=float)
    if len(set(label.tolist())) < 2:
        return model
    cache: dict[str, tuple[float, int]] = {}
    x = np.array([max(model.odds(listed, cache)) for _, _, listed in held])
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label).mean())
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        grad = np.array([(weight * (p - label) * x).sum() + (a - 1), (weight * (p - label)).sum() + 0.1 * b])
        curve = weight * p * (1 - p)
        hess = np.array([[(curve * x * x).sum() + 1, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 0.1]])
        move = np.linalg.solve(hess, grad)
        a, b = max(a - move[0], 0.05), b - move[1]
    return Model((model.bucket_odds * a).astype(np.float32), model.bias * a + b)


def score(docs: DataFrame, model: Model, name: str = "toxic_score") -> DataFrame:
    """The documents with a score from 0 to 1 in the column `name`; needs the column text.

    Null and empty texts score as the model's bias. A column of this name is replaced.
    """
    docs = docs.drop(name)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.bucket_odds, model.bias))

    def run(batches):
        cache: dict[str, tuple[float, int]] = {}
        own = Model(*shared.value)
        for batch in batches:
            odds = np.array(own.odds(batch.column("text").to_pylist(), cache), dtype=float)
            values = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.transform(mapped, run, schema)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of the labelled rows that are not held out; see `training_sample` for its bounds."""
    known = known_labels(labels)
    share = known.agg(F.avg("toxic")).first()[0]
    model = train(training_sample(docs, known), share or 0.5)
    release_memory()
    return model


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, columns unchanged."""
    name = fresh(docs, "__toxic")
    scored = score(docs, learn(docs, labels), name)
    return scored.filter(F.col(name) < threshold).select(*docs.columns)
