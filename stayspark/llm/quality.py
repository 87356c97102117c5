"""Quality classifier: supervised subword embeddings.

A document's features are its chunks, their byte n-grams (2 to 4, with marks at both ends), hashed into buckets, and one
feature for every chunk that repeats the one before it. Every bucket has a learned vector; a document is the average of its
features' vectors, and a softmax layer over it gives the probability of each label. Vectors and layer are trained together by
numpy stochastic gradient descent. Since the layer is linear, a chunk's share of the result is one number, which workers cache.

Defined results: null, empty and blank texts have no feature and get the bias' probability; repeated rows get equal scores;
an empty table gives no row; without both labels among the training rows every score is the share of label 1 (or 0.5); other
columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from stayspark.llm.common import ChunkValues, cached, kept_rows, labelled, scored, table

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
WIDTH = 8
EPOCHS = 4
RATE = 0.5
MOST_TRAINING = 3000  # the bound of the labelled sample
THRESHOLD = 0.3
REPEAT = BUCKETS  # the bucket of repeated chunks


def features(chunks: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(index of chunk, bucket) of every feature of the chunks."""
    size = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 2
    codes = np.frombuffer(b"<" + b"><".join(chunks) + b">", np.uint8).astype(np.uint64)
    of, end = np.repeat(np.arange(len(chunks)), size), np.repeat(np.cumsum(size), size)
    owner, bucket = [np.arange(len(chunks))], [np.fromiter(map(zlib.crc32, chunks), np.uint64, len(chunks))]
    place = np.arange(len(codes))
    for n in GRAMS:
        h = np.full(max(0, len(codes) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + codes[k : k + len(h)]
        inside = place[: len(h)] + n <= end[: len(h)]
        owner.append(of[: len(h)][inside])
        bucket.append(h[inside])
    mixed = np.concatenate(bucket) * np.uint64(0x9E3779B97F4A7C15)
    return np.concatenate(owner), (mixed >> np.uint64(40)).astype(np.int64) % buckets


@dataclass
class Model:
    """What a feature adds to the log-odds of label 1, and the bias."""

    weight: np.ndarray
    bias: float

    @property
    def key(self) -> int:
        return zlib.crc32(self.weight.tobytes())

    def chunk_values(self, chunks: list[bytes]) -> np.ndarray:
        owner, bucket = features(chunks)
        n = len(chunks)
        return np.stack([np.bincount(owner, self.weight[bucket], n), np.bincount(owner, minlength=n), np.fromiter(map(zlib.crc32, chunks), np.float64, n)], axis=1)

    def score(self, batch: list[bytes]) -> np.ndarray:
        cache = cached("quality", self.key, lambda: ChunkValues(self.chunk_values, 3))
        split = [t.split() for t in batch]
        values = cache.lookup(list(chain.from_iterable(split)))
        ends = np.cumsum([len(x) for x in split])
        odds = np.full(len(batch), self.bias)
        for k, (i, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if end > i:
                total, n = values[i:end, :2].sum(axis=0)
                again = int((values[i + 1 : end, 2] == values[i : end - 1, 2]).sum())
                odds[k] += (total + again * self.weight[REPEAT]) / (n + again)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and each one's share of its features."""
    chunks = text.split()
    if not chunks:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    _, bucket = features(chunks)
    again = sum(a == b for a, b in zip(chunks, chunks[1:], strict=False))
    counts = np.bincount(np.append(bucket, np.full(again, REPEAT)), minlength=BUCKETS + 1)
    at = np.flatnonzero(counts)
    return at.astype(np.uint16 if BUCKETS < 65535 else np.int64), (counts[at] / counts.sum()).astype(np.float32)


def descend(vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray, at: np.ndarray, part: np.ndarray, y: int, rate: float) -> None:
    """One step of stochastic gradient descent on the cross-entropy of one document, in place. Vectors take steps larger by the
    root of the document's number of features, since each has so small a part of it; the bias takes a tenth."""
    own = vectors[at]
    mean = part @ own
    z = mean @ layer + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    p[y] -= 1
    back = layer @ p
    layer -= rate * np.outer(mean, p)
    bias -= rate * 0.1 * p
    vectors[at] = own - (rate * len(at) ** 0.5) * part[:, None] * back


def fit(rows: list[tuple[bytes, int]], seed: int = 7) -> Model:
    share = float(np.mean([y for _, y in rows])) if rows else 0.5
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS + 1), float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS + 1, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.array([0.0, np.log(share / (1 - share))], np.float32)
    made = [(*document_features(t), y) for t, y in rows]
    steps = 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(made)):
            at, part, y = made[k]
            rate = RATE * (1 - steps / (EPOCHS * len(made)))
            steps += 1
            if not len(at):
                continue
            descend(vectors, layer, bias, at, part, y, rate)
    odds = layer[:, 1] - layer[:, 0]
    return Model((vectors @ odds).astype(np.float64), float(bias[1] - bias[0]))


def classify(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    return scored(docs, fit(labelled(docs, labels, "quality", most)).score, threshold)


def drop_low(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that `classify` would predict label 1 for."""
    return kept_rows(docs, fit(labelled(docs, labels, "quality", most)).score, threshold, above=True)


def op10_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
