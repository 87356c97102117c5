"""Best-fit packing of token pieces into sequences of bounded length.

`tokenize` turns documents into pieces, `pack` places pieces into sequences. Packing is bounded-space online best-fit: each
task keeps a fixed number of open bins in a bitset whose bit f says that a bin with f free places is open. A piece goes to
the bin with the least sufficient free space; if there is none and all places for open bins are taken, the fullest closes first.

Defined results: null or empty text is the end id alone; repeated rows and equal ids each get places of their own;
an empty table gives an empty result; other columns are ignored, whatever their names; texts of any length are cut, never cropped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import Interner, arrow_rows, cached, materialise, slices, table, texts, with_bytes

VOCABULARY = "word_bpe_49k.json"
END = 1
ROOM = 4096
PIECES_A_TASK = 50_000
OPEN_BINS = PIECES_A_TASK  # long pieces come first and share no bin: fewer open bins would close before short pieces come
CACHE = 600_000
#: Lower-case Latin words that normalisation leaves as they are, and marks of which a run after such a word is a word of its own.
ENDINGS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def is_plain(word: str) -> bool:
    return word.isalpha() if word.isascii() else bool(PLAIN.fullmatch(word))


class ChunkTokenizer:
    """Token ids of whole texts, put together from cached ids of their chunks.

    The tokenizer drops white space before it looks for words, so no token spans two chunks and a text's ids are those of
    its chunks in order.
    """

    def __init__(self, path: str, most: int = CACHE) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most = most
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.final = np.zeros(max(names.values()) + 1, bool)
        self.final[[i for w, i in names.items() if w.endswith("</w>")]] = True
        self.at = Interner()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _keep(self, n: int) -> None:
        """Forget all but the first n chunks: common ones were met early."""
        first = list(self.at)[:n]
        self.at.clear()
        self.at.index(first)
        self.at.new = []
        self.used = int(self.begin[n - 1] + self.count[n - 1]) if n else 0

    def _grown(self, a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, list]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        each = [np.array(x.ids, np.uint32) for x in encoded]
        return np.concatenate([np.zeros(0, np.uint32), *each]), each

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, one after the other, and how many each has. Words of Latin letters are encoded many at a
        time: every such word ends with an end-of-word token and has no other."""
        plain = [i for i, w in enumerate(words) if is_plain(w)]
        known = set(plain) if len(plain) < len(words) else ()
        other = [i for i in range(len(words)) if i not in known] if known or not plain else []
        ids, _ = self._encoded([" ".join([words[i] for i in plain[k : k + 50]]) for k in range(0, len(plain), 50)])
        ends = np.flatnonzero(self.final[ids]) + 1
        if len(ends) != len(plain):
            raise ValueError("a plain word has not one end-of-word token: the vocabulary is of another kind")
        _, rest = self._encoded([words[i] for i in other])
        count = np.zeros(len(words), np.int64)
        count[plain] = np.diff(ends, prepend=0)
        count[other] = [len(x) for x in rest]
        flat, at = np.zeros(int(count.sum()), np.uint32), np.cumsum(count) - count
        flat[np.repeat(at[plain] - np.append(0, ends)[:-1], count[plain]) + np.arange(len(ids))] = ids
        for i, x in zip(other, rest, strict=True):
            flat[at[i] : at[i] + len(x)] = x
        return flat, count

    def _learn(self) -> None:
        new, n = self.at.new, len(self.at)
        self.at.new = []
        words, parts = Interner(), np.zeros((len(new), 2), np.int64)
        none = words[""]
        for k, text in enumerate(b"\n".join(new).decode("utf-8", "replace").split("\n")):
            word = text.rstrip(ENDINGS)
            if word is not text and is_plain(word):
                parts[k] = words[word], words[text[len(word) :]]
            else:
                parts[k] = words[text], none
        flat, count = self._words(list(words))
        begin = np.cumsum(count) - count
        of, at = count[parts].ravel(), begin[parts].ravel()
        ends = np.cumsum(of)
        total = int(ends[-1])
        out = flat[np.repeat(at - ends + of, of) + np.arange(total)]
        of, first = of.reshape(-1, 2).sum(axis=1), (ends - of)[::2]
        self.flat = self._grown(self.flat, self.used + total)
        self.flat[self.used : self.used + total] = out
        self.begin, self.count = self._grown(self.begin, n), self._grown(self.count, n)
        self.begin[n - len(new) : n] = self.used + first
        self.count[n - len(new) : n] = of
        self.used += total

    def ids(self, batch: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, without the end id."""
        if len(self.at) > self.most:
            self._keep(self.most // 3)
        # ASCII lower case is what the tokenizer does to these letters itself.
        chunks = [text.lower().split() for text in batch]
        at = self.at.index(list(chain.from_iterable(chunks)))
        if self.at.new:
            self._learn()
        count = self.count[at]
        ends = np.cumsum(count)
        flat = self.flat[np.repeat(self.begin[at] - ends + count, count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        last = np.append(0, ends)[np.cumsum([len(x) for x in chunks])]
        return [flat[i:k] for i, k in zip([0, *last[:-1]], last, strict=True)]


def tokenizer_at(path: str) -> ChunkTokenizer:
    """One per worker process; it is only a cache."""
    return cached("tokens", path, lambda: ChunkTokenizer(path))


def tokenize(docs: DataFrame, path: str | None = None, room: int = ROOM, end: int = END) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): a document's ids and the end id, cut only where they exceed `room`."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = tokenizer_at(path)
        for whole in batches:
            for batch in slices(whole):
                rows: list[tuple] = []
                for doc, own in zip(batch.column("doc_id").to_pylist(), by.ids(texts(batch)), strict=True):
                    ids = np.append(own, np.uint32(end)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), room)):
                        part = ids[start : start + room]
                        rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
                yield arrow_rows(_PIECES, **dict(zip(_PIECES.names, zip(*rows, strict=True), strict=True)))

    return with_bytes(docs).mapInArrow(run, PIECES)


class OpenBins:
    """At most `most` open bins in a bitset by free space; place() gives the bin and the offset there."""

    def __init__(self, room: int, most: int) -> None:
        self.room, self.most, self.open, self.next = room, most, 0, 0
        self.bits, self.bins = 0, [[] for _ in range(room + 1)]

    def _take(self, free: int) -> int:
        at = self.bins[free].pop()
        self.open -= 1
        if not self.bins[free]:
            self.bits ^= 1 << free
        return at

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            if self.open >= self.most:  # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
            at, free, self.next = self.next, self.room, self.next + 1
        if left := free - size:
            self.bins[left].append(at)
            self.bits |= 1 << left
            self.open += 1
        return at, self.room - free


def pack(pieces: DataFrame, room: int = ROOM, open_bins: int = OPEN_BINS, tasks: int = 1) -> DataFrame:
    """pieces plus (sequence_id, offset). Each task packs its own share, long pieces first, so that few bins stay unfilled."""
    schema = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(room, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield arrow_rows(schema, **{k: batch.column(k) for k in _PIECES.names}, sequence_id=[first + x for x, _ in placed], offset=[x for _, x in placed])

    dealt = pieces.select(*_PIECES.names).repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32"))
    return dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").mapInArrow(run, f"{PIECES}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None, room: int = ROOM, open_bins: int = OPEN_BINS) -> DataFrame:
    """Tokenize and pack documents; the number of tasks follows the number of pieces."""
    pieces = materialise(tokenize(docs, path, room), "pieces")
    return pack(pieces, room, open_bins, max(1, -(-pieces.count() // PIECES_A_TASK)))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
