"""Spelling variants by errata-trie merging: pairs of words at one inserted, deleted or replaced code point, and forms by count.

Words of lengths m and m + 1 are dealt to groups by an interval [lo, hi) of places at which the pair may first differ: such words
share their first lo and their last m - hi code points. Intervals begin as the two halves of a word; a group of more than
`most` code points is cut in two again, down to one place, where a group has at most two words for each letter of the alphabet. So every
near pair has exactly one group, however many words begin alike.

In a group the sorted words are a trie; a node is a run of words with a common beginning. At each node with several children the
largest child is the heavy one, and only words of light children move (each word does so a logarithmic number of times):
their tails are merged into the node with the character at hand skipped, replaced by the heavy child's, or preceded by it, and
among one another with the character left out. Strings are told by polynomial hashes, and where terminals coincide, the two
words are compared code point by code point. Words that differ from one another at one place only form a class, which is counted without
its pairs.

Defined results: null texts have no words; a null id is an empty string in the hash that decides deletions; repeated rows count
as often as they occur; an empty table gives no rows; other columns are ignored. Ties between forms go to the smallest word.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, materialise, table
from stayspark.session import bounded, ship

RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, FACTOR, DELETE = 7, 2, 10, 31
MOST = 4_000_000  # code points of a group that one task reads whole
BROADCAST_GROUPS = 100_000
_PAIRS = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word): every run of letters that is long enough, A-Z lower-cased, with the planted deletions."""
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    rows = rows.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    rows = rows.select("run", h.alias("h"), F.length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    return rows.select(F.when(F.col("h") % DELETE == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counts = occurrences(docs, id_col, text_col).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


def _key(rows: DataFrame) -> DataFrame:
    """g names the group: the length and interval, and what its words have in common."""
    head, tail = F.expr("left(word, lo)"), F.expr("right(word, greatest(m - hi, 0))")
    return rows.withColumn("g", F.xxhash64("m", "lo", "hi", head, tail))


def _dealt(words: DataFrame) -> DataFrame:
    """Each word in the classes of its own length and the length below, in both halves."""
    size = F.length("word")
    classes = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= LEAST_LENGTH)
    half = F.floor(F.col("m") / 2).cast("int")
    cut = F.explode(F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), (F.col("m") + 1).alias("hi"))))
    return _key(classes.withColumn("cut", cut).select("word", "n", "m", "cut.lo", "cut.hi"))


def _halved(rows: DataFrame) -> DataFrame:
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    cut = F.explode(F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi"))))
    return _key(rows.select("word", "n", "m", cut.alias("cut")).select("word", "n", "m", "cut.lo", "cut.hi"))


def dealt(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n, m, lo, hi, g), no group of several places above `most` code points."""
    rest, done = _dealt(words), []
    while True:
        sizes = rest.where(F.col("hi") - F.col("lo") > 1).groupBy("g").agg((F.count("*") * F.first("m")).alias("size"))
        hot = materialise(sizes.where(F.col("size") > most).select("g"), "groups")
        n = hot.count()
        if not n:
            break
        hot = F.broadcast(hot) if n <= BROADCAST_GROUPS else hot
        done.append(rest.join(hot, "g", "left_anti"))
        rest = _halved(rest.join(hot, "g", "left_semi"))
    for x in done:
        rest = rest.unionByName(x)
    return rest


def _mixed(x: np.ndarray) -> np.ndarray:
    """A number for every code point, 0 for none."""
    y = x.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(31)
    return y * np.uint64(0x94D049BB133111EB)


class Trie:
    """Near pairs among words of m and m + 1 code points that first differ at a place in [lo, hi)."""

    def __init__(self, words: list[str], n: np.ndarray, group: np.ndarray, m: int, lo: int, hi: int) -> None:
        texts = np.array(words, f"U{m + 1}")
        order = np.lexsort((texts, group))
        self.words, self.n, self.m, group = texts[order], n[order], m, group[order]
        k = len(order)
        self.codes = self.words.view(np.uint32).reshape(k, m + 1)
        self.short = self.codes[:, m] == 0
        self.power = np.cumprod(np.array([1, *[_BASE] * (m + 2)], np.uint64))
        self.prefix = np.zeros((k, m + 2), np.uint64)
        np.cumsum(_mixed(self.codes) * self.power[: m + 1], axis=1, out=self.prefix[:, 1:])
        self.whole = self.prefix[:, -1]
        self.tables = []
        for rows in (np.flatnonzero(self.short), np.flatnonzero(~self.short)):
            by = rows[np.argsort(self.whole[rows], kind="stable")]
            self.tables.append((self.whole[by], by))
        differ = self.codes[1:] != self.codes[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), m + 1)
        self.common = np.where(group[1:] == group[:-1], common, -1)  # of a word and the one before
        self.near = np.zeros(k, np.int64)
        rank = np.lexsort((np.arange(k), -self.n))
        self.place = np.empty(k, np.int64)  # by count, then word
        self.place[rank] = np.arange(k)
        self.rank, self.best = rank, np.full(k, k, np.int64)
        for d in np.unique(self.common[(self.common >= lo) & (self.common < hi)]):
            self._node_level(int(d))

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in ((a, b), (b, a)):
            np.add.at(self.near, x, 1)
            np.minimum.at(self.best, x, self.place[y])

    def _found(self, hashes: np.ndarray, long: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of the words with these hashes; two words of one hash are both tried."""
        keys, rows = self.tables[long]
        first, last = np.searchsorted(keys, hashes, "left"), np.searchsorted(keys, hashes, "right")
        count = last - first
        query = np.repeat(np.arange(len(hashes)), count)
        return query, rows[np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(query))]

    def _one_longer(self, short: np.ndarray, long: np.ndarray, d: int) -> np.ndarray:
        """Whether each long word is the short one with a code point put in at d."""
        s, x = self.codes[short], self.codes[long]
        return (s[:, :d] == x[:, :d]).all(axis=1) & (s[:, d : self.m] == x[:, d + 1 :]).all(axis=1)

    def _replaced(self, a: np.ndarray, b: np.ndarray, d: int) -> np.ndarray:
        same = self.codes[a] == self.codes[b]
        return ~same[:, d] & same[:, :d].all(axis=1) & same[:, d + 1 :].all(axis=1)

    def _node_level(self, d: int) -> None:
        """Merge light children at all nodes of depth d."""
        m, codes, prefix, power = self.m, self.codes, self.prefix, self.power
        begins = np.concatenate([[True], self.common < d + 1])
        children = np.flatnonzero(begins)
        sizes = np.diff(np.append(children, len(begins)))
        nodes = np.flatnonzero(np.concatenate([[True], self.common < d])[children])
        largest = np.maximum.reduceat(sizes, nodes)
        node_of = np.repeat(np.arange(len(nodes)), np.diff(np.append(nodes, len(children))))
        is_largest = np.flatnonzero(sizes == largest[node_of])
        heavy = is_largest[np.searchsorted(node_of[is_largest], np.arange(len(nodes)))]
        of_row = np.repeat(np.arange(len(children)), sizes)
        light = np.flatnonzero(heavy[node_of[of_row]] != of_row)
        if not len(light):
            return
        step = codes[children[heavy[node_of[of_row[light]]]], d]  # the heavy child's code point, 0 where a word ends there
        own, head = codes[light, d], prefix[light, d]
        up = power[d]
        change = (_mixed(step) - _mixed(own)) * up
        short = self.short[light]
        # Replaced by the heavy child's code point.
        at = np.flatnonzero(short & (step != 0) & (own != 0))
        q, row = self._found(self.whole[light[at]] + change[at], False)
        a = light[at[q]]
        ok = self._replaced(a, row, d) & (codes[row, d] == step[at[q]])
        self._pairs(a[ok], row[ok])
        # Preceded by it.
        at = np.flatnonzero(short & (step != 0))
        q, row = self._found(head[at] + _mixed(step[at]) * up + (self.whole[light[at]] - head[at]) * power[1], True)
        a = light[at[q]]
        ok = self._one_longer(a, row, d) & (codes[row, d] == step[at[q]])
        self._pairs(a[ok], row[ok])
        # Skipped; of a run of equal code points the last one, so that the words first differ here.
        at = np.flatnonzero(~short)
        at = at[codes[light[at], d + 1] != own[at]] if d < m else at
        q, row = self._found(head[at] + (self.whole[light[at]] - prefix[light[at], d + 1]) * np.uint64(_INVERSE), False)
        a = light[at[q]]
        ok = self._one_longer(row, a, d)
        self._pairs(a[ok], row[ok])
        # Light children among one another, the code point left out.
        at = light[np.flatnonzero(short & (own != 0))]
        if len(at) > 1:
            self._classes(at, self.whole[at] - _mixed(codes[at, d]) * up, d)

    def _classes(self, rows: np.ndarray, keys: np.ndarray, d: int) -> None:
        by = np.lexsort((self.place[rows], keys))
        rows, keys = rows[by], keys[by]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(starts, len(keys)))
        of = np.repeat(np.arange(len(starts)), size)
        first = rows[starts]
        others = np.concatenate([np.arange(s + 1, s + n) for s, n in zip(starts[size > 1], size[size > 1], strict=True)]) if (size > 1).any() else np.zeros(0, np.int64)
        if not len(others):
            return
        wrong = ~self._replaced(first[of[others]], rows[others], d)
        if wrong.any():  # keys that coincide by chance: their members are compared one by one
            for c in np.unique(of[others[wrong]]):
                own = rows[starts[c] : starts[c] + size[c]]
                for i in range(1, len(own)):
                    b = own[:i][self._replaced(np.full(i, own[i]), own[:i], d)]
                    self._pairs(np.full(len(b), own[i]), b)
            keep = ~np.isin(of[others], of[others[wrong]])
            others = others[keep]
        members = np.concatenate([np.unique(starts[of[others]]), others])
        np.add.at(self.near, rows[members], size[of[members]] - 1)
        leads = np.unique(starts[of[others]])
        np.minimum.at(self.best, rows[others], self.place[first[of[others]]])
        np.minimum.at(self.best, rows[leads], self.place[rows[leads + 1]])

    def result(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.near)
        best = self.rank[self.best[at]]
        return arrow_rows(_PAIRS, word=self.words[at].tolist(), near=self.near[at], best=self.words[best].tolist(), best_n=self.n[best])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups come whole, one after the other, sorted by m, lo and hi; those of one class are worked off together."""
    held: list[pa.RecordBatch] = []
    size = 0

    def tries(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        g, m, lo, hi = (rows.column(c).to_numpy() for c in ("g", "m", "lo", "hi"))
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (m[1:] != m[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
        group = np.cumsum(new)
        some = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(some):
            return
        rows, group, m, lo, hi = rows.take(pa.array(some)), group[some], m[some], lo[some], hi[some]
        cut = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
        for start, end in zip(cut, [*cut[1:], len(m)], strict=True):
            part = rows.slice(start, end - start)
            yield Trie(part.column("word").to_pylist(), part.column("n").to_numpy(), group[start:end], int(m[start]), int(lo[start]), int(hi[start])).result()

    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column("g").to_numpy()
        if size > MOST // 2:
            ends = np.flatnonzero(np.concatenate([[held[-1].column("g")[-1].as_py() != g[0]], g[1:] != g[:-1]]))
            if len(ends):
                yield from tries(pa.Table.from_batches([*held, batch.slice(0, ends[0])]))
                batch, held, size = batch.slice(ends[0]), [], 0
        held.append(batch)
        size += int(batch.column("m").to_numpy().sum())
    if held:
        yield from tries(pa.Table.from_batches(held))


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n_near, best, best_n) of the words that have near ones."""
    ship(words.sparkSession)
    bounded(words.sparkSession)
    rows = dealt(words, most).repartition("g").sortWithinPartitions("m", "lo", "hi", "g").select("g", "m", "lo", "hi", "word", "n")
    found = rows.mapInArrow(_merged, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round doubles the way; counts grow tenfold by step, so a few rounds do."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = materialise(now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n)."""
    words = materialise(vocabulary(docs, id_col, text_col), "words")
    near = words.join(near_words(words, most), "word", "left")
    chosen = F.col("best_n") >= FACTOR * F.col("n")
    near = materialise(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n")), "near")
    last = roots(near.where(F.col("form").isNotNull()))
    return near.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_errata_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
