"""Toxicity: a support vector machine with a subsequence string kernel and Nyström landmarks.

The kernel of two words is the normalised gap-weighted subsequence kernel of order 3: every subsequence of three letters
counts with DECAY to the power of the stretch that it takes, so inserted characters and gaps weaken a match without ending it.
What is not a letter leaves a gap. A sentence's kernel is that of its best word: a sentence is a bag of words (runs of
three or more single letters are one word with gaps), and a document a bag of sentences. Sentences of clean documents are
clean; of a toxic document the sentence with the worst word is toxic, found anew in every round (multiple-instance learning).

Landmarks are words; with W the landmarks' kernel matrix, W^(-1/2) k(word, landmarks) is a word's Nyström vector. The machine
is linear in it, hence in k, and k is an inner product of subsequence counts: so the machine folds into one weight for each
subsequence, and a word's margin is a weighted sum over its own subsequences. That is exact, and workers cache it.

Defined results: null, empty and letterless texts get the lowest score; where the rows of a label have no word, all get the share of toxic rows; repeated rows get equal scores; an empty table gives
no row; without both labels among the training rows every score is the share of label 1 (or 0); words longer than 24 letters
are taken in overlapping windows of 24; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from stayspark.llm.common import ChunkValues, cached, kept_rows, labelled, scored, table

ORDER = 3
DECAY = 0.6
LETTERS = 40
LONGEST = 24
LANDMARKS = 300
STEM, A_STEM = 4, 3
NEAR_BEST = 2.0  # words whose log-odds are so near the best's stand for toxic sentences from the beginning
ROUNDS = 4
EASY = 1000  # clean words at first, and the worst ones added in every round
MOST_TRAINING = 3000  # the bound of the labelled sample
THRESHOLD = 0.5
PLACES = 1 << 18  # places of subsequences that are worked on at once
A_BLOCK = 64  # words whose rows of all the landmarks' subsequences are held at once
OUTER = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@lru_cache(4096)
def letter(c: str) -> int:
    """1 to 26 for Latin letters with or without accents, 27 to 39 for other letters, 0 for a gap."""
    base = unicodedata.normalize("NFD", c)[0].lower()
    return ord(base) - 96 if "a" <= base <= "z" else 27 + ord(base) % 13 if base.isalpha() else 0


def word(chunk: bytes) -> str:
    return OUTER.sub("", chunk.decode("utf-8", "replace").lower())


@lru_cache(64)
def places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All places of three letters in a word of n, and each one's weight."""
    at = np.array(list(combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1.0)


def own_kernel(codes: np.ndarray) -> np.ndarray:
    """The kernel of each row of codes with itself, by the recursion over prefixes."""
    n, size = codes.shape
    same = [[(codes[:, a] == codes[:, b]) & (codes[:, a] > 0) for b in range(size)] for a in range(size)]
    before = [[np.ones(n)] * (size + 1) for _ in range(size + 1)]
    for _ in range(ORDER - 1):
        now = [[np.zeros(n)] * (size + 1) for _ in range(size + 1)]
        for a in range(1, size + 1):
            run = np.zeros(n)
            for b in range(1, size + 1):
                run = DECAY * run + DECAY**2 * before[a - 1][b - 1] * same[a - 1][b - 1]
                now[a][b] = DECAY * now[a - 1][b] + run
        before = now
    out = np.zeros(n)
    for a in range(1, size + 1):
        for b in range(1, size + 1):
            out += DECAY**2 * before[a - 1][b - 1] * same[a - 1][b - 1]
    return out


def windows(w: str) -> list[str]:
    return [w] if len(w) <= LONGEST else [w[k : k + LONGEST] for k in range(0, len(w) - LONGEST // 2, LONGEST // 2)]


def spectra(words: list[str]):
    """(indices, subsequences, weights) by length of word; weights are divided by the word's own norm."""
    by: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by.setdefault(len(w), []).append(k)
    for size, members in by.items():
        if size < ORDER:
            continue
        at, weight = places(size)
        step = max(1, PLACES // len(at))
        for k in range(0, len(members), step):
            part = members[k : k + step]
            codes = np.array([[letter(c) for c in words[i]] for i in part], np.int64)
            picked = [codes[:, at[:, j]] for j in range(ORDER)]
            ids = (picked[0] * LETTERS + picked[1]) * LETTERS + picked[2]
            norm = np.sqrt(own_kernel(codes))
            whole = (picked[0] > 0) & (picked[1] > 0) & (picked[2] > 0)
            yield np.array(part), ids, weight * whole / np.where(norm > 0, norm, 1)[:, None]


def dense(words: list[str], column: np.ndarray, columns: int) -> np.ndarray:
    """One row of normalised subsequence weights for each word; column[id] is a subsequence's place, `columns` for none."""
    out = np.zeros((len(words), columns + 1))
    for part, ids, weight in spectra(words):
        flat = np.arange(len(part))[:, None] * (columns + 1) + column[ids]
        out[part] = np.bincount(flat.ravel(), weight.ravel(), len(part) * (columns + 1)).reshape(len(part), -1)
    return out[:, :columns]


def nystrom_rows(words: list[str], column: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """The Nyström vectors of words; their wide rows are made a block at a time."""
    out = np.zeros((len(words), len(fold)))
    for k in range(0, len(words), A_BLOCK):
        out[k : k + A_BLOCK] = dense(words[k : k + A_BLOCK], column, fold.shape[1]) @ fold.T
    return out


@dataclass
class Model:
    weight: np.ndarray  # of each subsequence
    bias: float
    slope: float  # from a document's margin to log-odds
    shift: float

    @property
    def key(self) -> int:
        return zlib.crc32(self.weight.tobytes() + np.array([self.bias, self.slope, self.shift]).tobytes())

    def margins(self, words: list[str]) -> np.ndarray:
        parts, of = [], []
        for k, w in enumerate(words):
            for p in windows(w):
                parts.append(p)
                of.append(k)
        margin = np.zeros(len(parts))
        for at, ids, weight in spectra(parts):
            margin[at] = (self.weight[ids] * weight).sum(axis=1)
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, of, margin)
        return out + self.bias

    def chunk_values(self, chunks: list[bytes]) -> np.ndarray:
        """Margin of each chunk's word, and whether it is a single letter."""
        words = [word(c) for c in chunks]
        distinct = list(dict.fromkeys(words))
        margin = dict(zip(distinct, self.margins(distinct), strict=True))
        return np.array([(margin[w], len(w) == 1) for w in words], np.float32).reshape(-1, 2)

    def document_margins(self, batch: list[bytes]) -> np.ndarray:
        cache = cached("toxicity", self.key, lambda: ChunkValues(self.chunk_values, 2, np.float32))
        split = [t.split() for t in batch]
        values = cache.lookup(list(chain.from_iterable(split)))
        ends = np.cumsum([len(x) for x in split])
        out = np.full(len(batch), self.bias)
        for k, (i, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if end > i:
                out[k] = max(out[k], values[i:end, 0].max())
                if runs := spelled(split[k], values[i:end, 1] > 0):
                    out[k] = max(out[k], float(self.margins(runs).max()))
        return out

    def score(self, batch: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.document_margins(batch) + self.shift, -30, 30)))


def spelled(chunks: list[bytes], single: np.ndarray) -> list[str]:
    """Runs of at least three single letters, as words with gaps."""
    if int(single.sum()) < ORDER:
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    return [" ".join(word(c) for c in chunks[a:b]) for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a >= ORDER]


def document_words(text: bytes) -> list[str]:
    chunks = text.split()
    words = [word(c) for c in chunks]
    more = spelled(chunks, np.array([len(w) == 1 for w in words], bool)) if chunks else []
    return [*dict.fromkeys(p for w in [*words, *more] if len(w) >= ORDER for p in windows(w))]


def nystrom(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the landmarks' subsequences, each one's column, W^(-1/2) times the landmarks' rows): a word's row times the last,
    transposed, is W^(-1/2) k(word, landmarks)."""
    ids = np.unique(np.concatenate([np.zeros(1, np.int64), *[i.ravel() for _, i, _ in spectra(landmarks)]]))
    column = np.full(LETTERS**ORDER, len(ids))
    column[ids] = np.arange(len(ids))
    phi = dense(landmarks, column, len(ids))
    values, vectors = np.linalg.eigh(phi @ phi.T)
    return ids, column, (vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T) @ phi


def machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss by full-gradient steps with momentum; rows of norm 1 at most."""
    w, b = np.zeros(x.shape[1]), 0.0
    vw, vb = np.zeros_like(w), 0.0
    cost = cost / cost.sum()
    step, keep = 0.5, 1e-4
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ w + b))
        g = -2 * cost * y * slack
        vw, vb = 0.9 * vw - step * (g @ x + keep * w), 0.9 * vb - step * g.sum()
        w, b = w + vw, b + vb
    return w, b


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the margin, with Platt's targets, by Newton steps."""
    centre, scale = margin.mean(), max(margin.std(), 1e-9)
    x = np.stack([(margin - centre) / scale, np.ones(len(margin))], axis=1)
    target = np.where(y == 1, ((y == 1).sum() + 1) / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2))
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        theta -= np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-6 * np.eye(2), x.T @ (p - target))
    return float(theta[0] / scale), float(theta[1] - theta[0] * centre / scale)


def fit(rows: list[tuple[bytes, int]]) -> Model:
    y = np.array([int(label > 0) for _, label in rows])
    if not len(y) or not 0 < y.sum() < len(y):
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-3), 1 - 1e-3)
        return Model(np.zeros(LETTERS**ORDER), 0.0, 0.0, float(np.log(share / (1 - share))))
    one: dict[str, str] = {}  # documents share their words' strings
    bags = [[one.setdefault(w, w) for w in document_words(t)] for t, _ in rows]
    one.clear()
    toxic, clean = Counter(w for b, k in zip(bags, y, strict=True) if k for w in b), Counter(w for b, k in zip(bags, y, strict=True) if not k for w in b)
    if not toxic or not clean:  # nothing to compare: every document gets the share of toxic ones
        return Model(np.zeros(LETTERS**ORDER), 0.0, 0.0, float(np.log(y.mean() / (1 - y.mean()))))

    def lean(n_toxic: int, n_clean: int) -> float:
        return float(np.log((n_toxic + 0.5) / (y.sum() + 1)) - np.log((n_clean + 0.5) / (len(y) - y.sum() + 1)))

    stems: dict[str, list[int]] = {}
    for count, side in ((toxic, 0), (clean, 1)):
        for w, n in count.items():
            stems.setdefault(w[:STEM], [0, 0])[side] += n
    # A word leans to toxic documents by itself or by its stem; toxic landmarks are spread over stems.
    leaning = {w: max(lean(n, clean[w]) if n > 2 else -9.0, lean(*stems[w[:STEM]]) if stems[w[:STEM]][0] > 2 else -9.0) for w, n in toxic.items()}
    rank = sorted(toxic, key=lambda w: (-leaning[w], -toxic[w], w))
    taken, chosen = Counter(), []
    for w in rank:
        if len(chosen) < LANDMARKS // 2 and taken[w[:STEM]] < A_STEM:
            taken[w[:STEM]] += 1
            chosen.append(w)
    clean_words = sorted(clean, key=lambda w: (-clean[w], w))
    landmarks = [*dict.fromkeys([*chosen, *clean_words[: LANDMARKS // 2]])]
    ids, column, fold = nystrom(landmarks)
    place = {w: k for k, w in enumerate(rank)}
    toxic_bags = [b for b, k in zip(bags, y, strict=True) if k and b]
    sure = {w for w in toxic if leaning[w] > leaning[rank[0]] - NEAR_BEST}
    witness = [min(b, key=place.__getitem__) for b in toxic_bags] + [u for b in toxic_bags for u in b if u in sure]
    hard = clean_words[:EASY]
    model = Model(np.zeros(LETTERS**ORDER), 0.0, 1.0, 0.0)
    every = list(dict.fromkeys([*toxic, *clean]))
    vector: dict[str, np.ndarray] = {}
    for _ in range(ROUNDS):
        # A word stands for all sentences that have it as their worst.
        shown = Counter(witness)
        words, label = [*shown, *hard], np.array([1.0] * len(shown) + [-1.0] * len(hard))
        if new := [w for w in words if w not in vector]:
            vector |= zip(new, nystrom_rows(new, column, fold), strict=True)
        cost = np.array([0.5 * n / len(witness) for n in shown.values()] + [0.5 / len(hard)] * len(hard))
        w, b = machine(np.array([vector[u] for u in words]), label, cost)
        weight = np.zeros(LETTERS**ORDER)
        weight[ids] = w @ fold
        model = Model(weight, b, 1.0, 0.0)
        margin = dict(zip(every, model.margins(every), strict=True))
        witness = [max(b, key=lambda u: (margin[u], u)) for b in toxic_bags] + [u for b in toxic_bags for u in b if u in sure]
        worst = sorted(clean, key=lambda u: (-margin[u], u))[:EASY]
        hard = [*dict.fromkeys([*hard, *worst])]
    best = np.array([max([margin[w] for w in b], default=model.bias) for b in bags])
    model.slope, model.shift = calibrate(best, y)
    return model


def classify(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    return scored(docs, fit(labelled(docs, labels, "toxic", most)).score, threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that `classify` would not call toxic."""
    return kept_rows(docs, fit(labelled(docs, labels, "toxic", most)).score, threshold, above=False)


def op6_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
