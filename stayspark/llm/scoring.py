"""Language-model scoring by masked pseudo-likelihood.

A small network reads the RADIUS words on both sides of a position and predicts the word in the middle; a document's score is
the sum, over every word, of the logarithm of its probability given its neighbours. The vocabulary comes from counts over all
documents; words outside it go to hashed buckets. Output is a two-level softmax: a word's class, then the word in its class.
A word outside the vocabulary has its bucket's probability times its share of the bucket's words, by the counts of all words:
that share does not depend on its neighbours. Shares of at most NEAR of the most frequent such words are broadcast, others are joined.

Training goes over all documents, and every word of each is a target once. Each round, every task of a round's share of the documents (a hash decides) takes steps of
numpy gradient descent from the same weights, and the weights are averaged, by the number of positions, over the tasks.
What is gathered (word counts and tasks' weights) grows with the corpus; sums over both are made by Spark, in a shuffle.

Defined results: null, empty and blank texts have no words, log-probability 0 and a null mean; repeated rows get equal
scores; an empty table gives no row; positions beyond the ends hold a mark; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, materialise, slices, table, texts, unit_hash, with_bytes

RADIUS = 2
CLASSES, A_CLASS = 32, 32  # equal, and powers of two
OTHER = 64  # buckets for words outside the vocabulary; a power of two
NEAR = 100_000  # words outside the vocabulary whose shares every task holds
WORDS = CLASSES * A_CLASS
EDGE = WORDS  # the input mark beyond the ends
WIDTH, HIDDEN = 12, 24
NUMBERS = np.arange((EDGE + 1) * WIDTH).reshape(-1, WIDTH)  # places of each input's vector
ROUNDS = 3
STEP = 512
RATE = 1.0
BLOCK = 4096
COUNTED = 300_000  # words that a task counts before it hands them on


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; counted in each task, then summed in a shuffle. Memory of a task is bounded: when it has
    met too many words it hands its counts on and begins anew."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for whole in batches:
            for batch in slices(whole):
                counts.update(chain.from_iterable(t.lower().split() for t in texts(batch)))
                if len(counts) > COUNTED:
                    yield arrow_rows(schema, word=list(counts), n=list(counts.values()))
                    counts.clear()
        if counts:
            yield arrow_rows(schema, word=list(counts), n=list(counts.values()))

    return with_bytes(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> dict[bytes, int]:
    """The most frequent words, ties by the word; bounded by WORDS - OTHER."""
    rows = (word_counts(docs) if counts is None else counts).orderBy(F.desc("n"), "word").limit(WORDS - OTHER).collect()
    # Dealt to classes in turn, so that no class has all frequent words.
    return {bytes(w): OTHER + k for k, (w, _) in enumerate(rows)}


def shares_in_buckets(counts: DataFrame, words: dict[bytes, int]) -> tuple[DataFrame, dict[bytes, float]]:
    """(word, log) of every word outside the vocabulary, log being that of its share of its bucket; and at most NEAR of the most frequent."""
    bucket = F.crc32("word") % OTHER
    rest = counts.where(~F.col("word").isin(list(words))) if words else counts
    total = dict(rest.groupBy(bucket.alias("bucket")).agg(F.sum("n")).collect())
    # Words of one count are taken together, so that no task sends more than are kept.
    left, least = NEAR, None
    for n, of in sorted(rest.groupBy("n").count().collect(), reverse=True):
        left -= of
        if left < 0:
            break
        least = n
    near = {}
    if least is not None:
        rows = rest.where(F.col("n") >= least).select("word", "n").collect()
        near = {bytes(w): float(np.log(n / total[zlib.crc32(w) % OTHER])) for w, n in sorted(rows)}
    totals = F.array(*[F.lit(float(total.get(b, 1))) for b in range(OTHER)])
    return rest.select("word", F.log(F.col("n") / F.get(totals, bucket.cast("int"))).alias("log")), near


def less_top(z: np.ndarray) -> np.ndarray:
    """z less the largest along its last axis but one, whose length is a power of two: halves are compared. Whole rows are, so that
    numpy works on long stretches."""
    top = z
    while top.shape[-2] > 1:
        half = top.shape[-2] // 2
        top = np.maximum(top[..., :half, :], top[..., half:, :])
    return z - top


def shares(z: np.ndarray) -> np.ndarray:
    """Softmax over the last axis but one."""
    e = less_top(z)
    np.exp(e, out=e)
    e /= (np.ones(z.shape[-2], np.float32) @ e)[..., None, :]
    return e


def by_class(kind: np.ndarray) -> np.ndarray:
    """Positions in the order of their classes."""
    return np.argsort(kind.astype(np.uint8), kind="stable")  # bytes are sorted by counting


class Network:
    def __init__(self, parts: list[np.ndarray] | None = None, seed: int = 3) -> None:
        if parts is None:
            random = np.random.default_rng(seed)
            shapes = [(EDGE + 1, WIDTH), (2 * RADIUS * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, A_CLASS), (CLASSES, A_CLASS)]
            parts = [(random.normal(0, 0.1, s) if len(s) > 1 and s != (CLASSES, A_CLASS) else np.zeros(s)).astype(np.float32) for s in shapes]
        self.embed, self.into, self.into_bias, self.classes, self.class_bias, self.inner, self.inner_bias = parts

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.into, self.into_bias, self.classes, self.class_bias, self.inner, self.inner_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        out, at = [], 0
        for p in Network().parts:
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Network(out)

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.embed.take(around, axis=0).reshape(len(around), -1)
        return x, np.tanh(x @ self.into + self.into_bias)

    def log_prob(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target given the words around it."""
        _, h = self.hidden(around)
        kind, inside = target % CLASSES, target // CLASSES
        order = by_class(kind)
        h, kind, inside = h.take(order, axis=0), kind[order], inside[order]
        z = less_top(self.classes.T @ h.T + self.class_bias[:, None])
        each = z[kind, np.arange(len(h))]
        each -= np.log(np.ones(CLASSES, np.float32) @ np.exp(z, out=z))
        ends = np.searchsorted(kind, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            i, k = ends[c], ends[c + 1]
            if i < k:
                z = less_top(self.inner[c].T @ h[i:k].T + self.inner_bias[c][:, None])
                each[i:k] += z[inside[i:k], np.arange(k - i)]
                each[i:k] -= np.log(np.ones(A_CLASS, np.float32) @ np.exp(z, out=z))
        out = np.empty_like(each)
        out[order] = each
        return out

    def learn(self, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of gradient descent on a batch."""
        n = len(target)
        x, h = self.hidden(around)
        kind, inside = target % CLASSES, target // CLASSES
        # One padded block of rows a class, so that all classes are multiplied at once.
        size = np.bincount(kind, minlength=CLASSES)
        order = by_class(kind)
        most = int(size.max())
        row = np.empty(n, np.int64)
        row[order] = np.arange(n) + np.repeat(np.arange(CLASSES) * most - (np.cumsum(size) - size), size)
        own = np.zeros((CLASSES, most, HIDDEN), np.float32)
        own.reshape(-1, HIDDEN)[row] = h
        # Both levels' softmax at once, on the real rows only.
        z = np.empty((2, CLASSES, n), np.float32)
        np.matmul(self.classes.T, h.T, out=z[0])
        z[0] += self.class_bias[:, None]
        z[1] = ((own @ self.inner).reshape(-1, A_CLASS).take(row, axis=0) + self.inner_bias.take(kind, axis=0)).T
        p, q = shares(z)
        p[kind, np.arange(n)] -= 1
        q[inside, np.arange(n)] -= 1
        padded = np.zeros((CLASSES, most, A_CLASS), np.float32)
        padded.reshape(-1, A_CLASS)[row] = q.T
        back = p.T @ self.classes.T
        back += (padded @ self.inner.transpose(0, 2, 1)).reshape(-1, HIDDEN).take(row, axis=0)
        ones = np.ones(n, np.float32)
        d_classes, d_bias = (p @ h).T, p @ ones
        self.inner -= rate / n * (own.transpose(0, 2, 1) @ padded)
        self.inner_bias -= rate / n * (np.ones(most, np.float32) @ padded)
        back *= 1 - h * h
        d_x = (back @ self.into.T).reshape(n * 2 * RADIUS, WIDTH)
        self.classes -= rate / n * d_classes
        self.class_bias -= rate / n * d_bias
        self.into -= rate / n * (x.T @ back)
        self.into_bias -= rate / n * (ones @ back)
        into = NUMBERS.take(around.ravel(), axis=0).ravel()
        self.embed -= rate / n * np.bincount(into, d_x.ravel(), self.embed.size).reshape(-1, WIDTH).astype(np.float32)


def word_ids(words: dict[bytes, int], batch: list[bytes], near: dict[bytes, float] | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Ids of all words of some texts, with RADIUS marks before, between and after texts; each word's text; the words; and
    the log of each word's share of its bucket: 0 in the vocabulary, NaN for words that `near` lacks."""
    split = [t.lower().split() for t in batch]
    chunks = list(chain.from_iterable(split))
    size = np.array([len(x) for x in split], np.int64)
    of = np.repeat(np.arange(len(batch)), size)
    ids = np.fromiter(map(words.get, chunks, repeat(-1)), np.int64, len(chunks))
    rare = np.flatnonzero(ids < 0)
    others = list(compress(chunks, (ids < 0).tolist()))
    ids[rare] = np.fromiter(map(zlib.crc32, others), np.int64, len(others)) & (OTHER - 1)
    logs = np.zeros(len(chunks))
    if near is not None:
        logs[rare] = np.fromiter(map(near.get, others, repeat(np.nan)), np.float64, len(others))
    out = np.full(len(chunks) + RADIUS * (len(batch) + 1), EDGE, np.int64)
    out[np.arange(len(chunks)) + RADIUS * (of + 1)] = ids
    return out, of, chunks, logs


def windows(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ids.take(at[:, None] + np.array([k for k in range(-RADIUS, RADIUS + 1) if k]))


def train(docs: DataFrame, words: dict[bytes, int], rounds: int = ROUNDS) -> np.ndarray:
    """Weights after `rounds` of averaged local descent; every document is in the share of one round."""
    schema = pa.schema([("part", pa.int32()), ("weights", pa.binary()), ("n", pa.int64())])
    spark, flat = docs.sparkSession, Network().flat()
    for r in range(rounds):
        start = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], r: int = r, start=start) -> Iterator[pa.RecordBatch]:
            net, n = Network.of(start.value), 0
            for whole in batches:
                for batch in slices(whole):
                    ids, _, _, _ = word_ids(words, texts(batch))
                    at = np.flatnonzero(ids != EDGE)
                    at = at[np.random.default_rng(len(at)).permutation(len(at))]
                    for k in range(0, len(at), STEP):
                        part = at[k : k + STEP]
                        net.learn(windows(ids, part), ids[part], RATE * 0.6**r)
                    n += len(at)
            if n:
                yield arrow_rows(schema, part=[TaskContext.get().partitionId()], weights=[net.flat().tobytes()], n=[n])

        share = with_bytes(docs).where(F.floor(unit_hash("doc_id", "text", seed=11) * rounds) == r)
        made = share.mapInArrow(run, "part int, weights binary, n long")
        flat = averaged(made, len(flat), flat)
        start.unpersist()
    return flat


def averaged(made: DataFrame, size: int, before: np.ndarray) -> np.ndarray:
    """The mean of weights by n: sums are made in groups of 32 tasks, again and again, so no task holds many."""
    schema = "part int, weights binary, n long"
    out_schema = pa.schema([("part", pa.int32()), ("weights", pa.binary()), ("n", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for part, weights, n in zip(*[batch.column(k).to_pylist() for k in ("part", "weights", "n")], strict=True):
                total, count = sums.get(part, (np.zeros(size), 0))
                sums[part] = total + np.frombuffer(weights, np.float32).astype(np.float64) * n, count + n
        for part, (total, count) in sums.items():
            yield arrow_rows(out_schema, part=[part], weights=[(total / count).astype(np.float32).tobytes()], n=[count])

    made = materialise(made, "weights")
    tasks = made.count()
    while tasks > 1:
        groups = -(-tasks // 32)
        made = materialise(made.withColumn("part", F.pmod("part", F.lit(groups))).repartition(groups, "part").mapInArrow(add, schema), "weights")
        tasks = groups if groups > 1 else 1
    rows = made.collect()
    if not rows:
        return before
    total = sum(n for _, _, n in rows)
    return sum(np.frombuffer(w, np.float32).astype(np.float64) * (n / total) for _, w, n in rows)


def score(docs: DataFrame, words: dict[bytes, int], flat: np.ndarray, counts: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of every row; `counts` are the word counts of all docs."""
    rest, near = shares_in_buckets(materialise(word_counts(docs), "counts") if counts is None else counts, words)
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_prob", pa.float64()), ("far", pa.list_(pa.binary()))])
    held = docs.sparkSession.sparkContext.broadcast((flat, words, near))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, words, near = held.value
        net, row = Network.of(flat), TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in slices(whole):
                ids, of, chunks, logs = word_ids(words, texts(batch), near)
                at = np.flatnonzero(ids != EDGE)
                each = np.concatenate([np.zeros(0), *[net.log_prob(windows(ids, at[k : k + BLOCK]), ids[at[k : k + BLOCK]]) for k in range(0, len(at), BLOCK)]])
                n = np.bincount(of, minlength=batch.num_rows)
                total = np.bincount(of, each + np.nan_to_num(logs), batch.num_rows)
                far: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
                for k in np.flatnonzero(np.isnan(logs)).tolist():
                    far[of[k]].append(chunks[k])
                yield arrow_rows(schema, row=np.arange(row, row + batch.num_rows), doc_id=batch.column("doc_id"), n_words=n, log_prob=total, far=far)
                row += batch.num_rows

    # Written once, so that row numbers stay what they are.
    made = materialise(with_bytes(docs).mapInArrow(run, "row long, doc_id long, n_words long, log_prob double, far array<binary>"), "scored")
    more = made.select("row", F.explode("far").alias("word")).join(rest, "word").groupBy("row").agg(F.sum("log").alias("more"))
    total = F.col("log_prob") + F.coalesce("more", F.lit(0.0))
    both = made.drop("far").join(more, "row", "left").select("doc_id", "n_words", total.alias("log_prob"))
    return both.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    counts = materialise(word_counts(docs), "counts")
    words = vocabulary(docs, counts)
    return score(docs, words, train(docs, words, rounds), counts)


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))
