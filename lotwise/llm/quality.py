"""Text classifier on supervised subword embeddings.

A word's features are the word itself and its character n-grams with its ends
marked, each hashed to one of `BUCKETS` learned vectors. A document is the mean
of its features' vectors, a softmax over two classes gives the score, and both
layers are learned together by stochastic gradient descent in numpy.

The classifier is fitted on a bounded sample: of each class the `SAMPLE`
labelled documents with the smallest hashes of their ids, each by its whole text
(`SAMPLE` is within what Spark limits before a shuffle, so a label that most rows
bear is no hot key). Classes weigh the same in the fit; the share of each among
all labelled documents then shifts the softmax to the prior of the data.

As the mean and the softmax's inputs are linear, a word adds the same amount to
a document wherever it stands; scoring looks this up for each distinct word in
a table that is emptied at `TABLE` words. All words of every text count, with
all their n-grams, also where a word is a whole unspaced text; words longer than
`LONG` bytes are summed in blocks of `BLOCK` bytes and not kept in the table.

Scale. Fitting reads the labels, and the texts of the sample through a
broadcast of its at most 2 * `SAMPLE` ids. Scoring is one pass without a
shuffle.

Defined cases. Empty, blank and null texts get the prior. Rows without a label
or id do not take part in the fit; of one document's labels the largest counts.
With no label or one class, the score is the share of label 1 (0.5 without
labels). All rows stay; other columns pass through untouched.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (2, 3, 4)
SAMPLE = 1000
EPOCHS = 8
RATE = 0.5
TABLE = 1 << 18
LONG = 64
BLOCK = 1 << 16

#: The table of the byte-wise crc32; its checks are linear, so start and end cancel out.
_STEP = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)


def word_features(word: bytes) -> list[int]:
    """Buckets of the word and of its marked character n-grams."""
    marked = b"<" + word + b">"
    out = [zlib.crc32(word) & (BUCKETS - 1)]
    for n in GRAMS:
        out += [zlib.crc32(marked[i : i + n]) & (BUCKETS - 1) for i in range(len(marked) - n + 1)]
    return out


def _checks(codes: np.ndarray, n: int) -> np.ndarray:
    """crc32 of each run of n bytes."""
    out = np.full(len(codes) - n + 1, 0xFFFFFFFF, np.uint32)
    for i in range(n):
        out = _STEP[(out ^ codes[i : len(codes) - n + 1 + i]) & 0xFF] ^ (out >> 8)
    return ~out


def long_features(word: bytes) -> Iterator[np.ndarray]:
    """What `word_features` gives, in blocks."""
    yield np.array([zlib.crc32(word) & (BUCKETS - 1)])
    codes = np.frombuffer(b"<" + word + b">", np.uint8)
    for low in range(0, len(codes), BLOCK):
        for n in GRAMS:
            block = codes[low : low + BLOCK + n - 1]
            if len(block) >= n:
                yield _checks(block, n) & np.uint32(BUCKETS - 1)


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of each among all its features."""
    counts, found, times = np.zeros(BUCKETS, np.int64), [], []

    def add() -> None:
        np.add.at(counts, np.array(found, np.int64), np.array(times, np.int64))
        found.clear(), times.clear()

    for word, n in Counter(text.encode().split()).items():
        if len(word) > LONG:
            for block in long_features(word):
                counts[:] += n * np.bincount(block, minlength=BUCKETS)
        else:
            own = word_features(word)
            found += own
            times += [n] * len(own)
        if len(found) > BLOCK:
            add()
    add()
    buckets = np.flatnonzero(counts).astype(np.int32)
    n = counts[buckets]
    return buckets, (n / max(1, n.sum())).astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [text_features(t.as_py() or "") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([b for b, _ in made], pa.list_(pa.int32())),
                pa.array([s for _, s in made], pa.list_(pa.float32())),
            ],
            ["label", "buckets", "shares"],
        )


class Classifier:
    """Learned vectors and softmax weights, folded into one number per bucket."""

    def __init__(self, per_bucket: np.ndarray, bias: float):
        self.per_bucket, self.bias = per_bucket, bias

    def score(self, weight: float, features: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(weight / max(1, features) + self.bias, -50, 50))))


def learn(samples: list[tuple[int, np.ndarray, np.ndarray]], prior: float, seed: int = 1) -> Classifier:
    """samples: label (0 or 1), buckets, shares. prior: the share of label 1 among all."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights, biases = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    n = np.bincount([s[0] for s in samples], minlength=2)
    prior = min(max(prior, 0.01), 0.99)
    if not n.all():
        return Classifier(np.zeros(BUCKETS), float(np.log(prior / (1 - prior))))
    balance = len(samples) / (2 * n)
    steps = EPOCHS * len(samples)
    for step in range(steps):
        if step % len(samples) == 0:
            order = rng.permutation(len(samples))
        label, buckets, shares = samples[order[step % len(samples)]]
        mean = shares @ vectors[buckets]
        out = weights @ mean + biases
        share = np.exp(out - out.max())
        share /= share.sum()
        share[label] -= 1
        slope = RATE * (1 - step / steps) * balance[label] * share
        back = weights.T @ slope
        weights -= np.outer(slope, mean)
        biases -= slope
        # a bucket's step is as large as its share of the text; times the text's features, as in the mean's gradient
        vectors[buckets] -= np.outer(shares * len(buckets) ** 0.5, back)
    folded = vectors @ (weights[1] - weights[0])
    return Classifier(folded, float(biases[1] - biases[0] + np.log(prior / (1 - prior))))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label") -> Classifier:
    """docs: the documents to learn from; labels: key, label (0 or 1)."""
    marked = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("doc"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
    counted = {r["label"]: r["n"] for r in marked.join(texts.select("doc"), "doc", "left_semi").groupBy("label").agg(F.count("*").alias("n")).collect()}
    first = Window.partitionBy("label").orderBy(F.xxhash64("doc"), "doc")
    sample = (
        marked.join(texts.select("doc"), "doc", "left_semi")
        .select("doc", "label", F.row_number().over(first).alias("rank"))
        .where(F.col("rank") <= SAMPLE)
        .select("doc", "label")
    )
    # at most 2 * SAMPLE rows
    rows = (
        texts.join(F.broadcast(sample), "doc")
        .select("label", "text")
        .mapInArrow(_features, "label int, buckets array<int>, shares array<float>")
        .toArrow()
        .combine_chunks()
    )
    # views of the Arrow buffers, not Python numbers
    buckets, shares = (rows.column(c).combine_chunks() for c in ("buckets", "shares"))
    samples = [
        (label, buckets[i].values.to_numpy(), shares[i].values.to_numpy()) for i, label in enumerate(rows.column("label").to_pylist())
    ]
    samples = sorted((s for s in samples if len(s[1])), key=lambda s: (s[0], len(s[1]), s[1].tobytes(), s[2].tobytes()))
    total = sum(counted.values())
    return learn(samples, counted.get(1, 0) / total if total else 0.5)


class WordWeights(dict):
    """Each word's number of features and what they add up to."""

    def __init__(self, model: Classifier):
        super().__init__()
        self.per_bucket = model.per_bucket

    def __missing__(self, word: bytes) -> complex:
        # real: the sum; imaginary: the number of features
        if len(word) > LONG:
            blocks = [(self.per_bucket[b].sum(dtype=np.float64), len(b)) for b in long_features(word)]
            return complex(sum(w for w, _ in blocks), sum(n for _, n in blocks))
        found = word_features(word)
        out = self[word] = complex(self.per_bucket[found].sum(), len(found))
        return out


def scored(docs: DataFrame, model: Classifier, text: str = "text") -> Column:
    """The probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        words = WordWeights(own)
        for batch in texts:
            out = []
            for t in batch:
                total = sum(map(words.__getitem__, (t.as_py() or "").encode().split()), 0j)
                out.append(own.score(total.real, total.imag))
                if len(words) > TABLE:
                    words.clear()
            yield pa.array(out, pa.float64())

    return score(F.coalesce(F.col(text).cast("string"), F.lit("")))
