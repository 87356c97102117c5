"""Suffix-array dedup: removes every byte that a 100-byte string covers which also starts earlier in the corpus.

A sparse suffix array: of the starts of all 32-byte strings in a window of 100 bytes the one with the least hash is an anchor, so
two equal windows have the same anchor at the same place, and only suffixes at anchors (about one in 31 bytes) are sorted.

1. Every task hashes its texts (prefix polynomials, so any substring's hash is two look-ups) and names each anchor by its 32 bytes
   and by its context, the 68 bytes before it and 100 after. Of the anchors of one context in a batch the earliest is sent.
2. Anchors meet by their 32 bytes, sorted by context and place, and stream past. All but the earliest of one context are whole
   repeats: what their context covers goes. If one 32-byte string has several contexts, the earliest of each is compared.
3. For these the contexts are fetched. In each group a mergesort orders the suffixes from the anchor on; two suffixes are compared
   by a binary search for their common extension over prefix hashes. Windows that begin o bytes before the anchor are
   equal within a run of the sorted suffixes that have 100 - o bytes in common, where the o bytes before are equal too; all but the first
   of them go. The order and every match are compared byte by byte; a collision sorts the group again with other hashes.
   Groups above `most` contexts are split by the hashes of their single windows and joined, exactly, in place of one task.

Contexts that are never fetched are told apart by 128 bits of hashes. A document is (id, hash of its text); copies of one row are
counted first, and all copies but one are removed whole.

Defined results: a null text is empty; rows that share an id are documents of their own in the order of a hash of their texts; rows with
a null id come last; of repeated rows one is the earliest; texts under 100 bytes stay as they are; an empty table gives no rows;
other columns are ignored. A long text is hashed in pieces; memory holds one batch and one chunk of groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, materialise, table, texts
from stayspark.session import bounded, ship

WINDOW, GRAM = 100, 32
REACH = WINDOW - GRAM
PIECE, MARGIN = 1 << 18, 2 * WINDOW
MOST = 50_000  # contexts of a group that one task sorts; groups above it are split
CHUNK = 8 << 20  # bytes of contexts that are sorted together
_LAST = (1 << 63) - 1
_ANCHORS = pa.schema([("key", pa.int64()), ("context", pa.int64()), ("o", pa.int64()), ("h", pa.int64()), ("place", pa.int32()), ("end", pa.int32())])
_PARTS = pa.schema([("key", pa.int64()), ("o", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_CONTEXTS = pa.schema([("key", pa.int64()), ("o", pa.int64()), ("h", pa.int64()), ("place", pa.int32()), ("before", pa.int32()), ("text", pa.binary())])
_WINDOWS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("o", pa.int64()), ("h", pa.int64()), ("start", pa.int32())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("copies", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, and a random number for every byte; tables grow as needed."""

    def __init__(self, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.byte = draw.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(draw.integers(1 << 40, 1 << 62)) * 8 + 5
        self.up = self.down = np.ones(1, np.uint64)

    def _grown(self, table: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(table) < n:
            table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
        return table

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        """Sums of byte * base^-i: substring(a, b) has the hash (sum[b] - sum[a]) * base^a."""
        n = len(data) + 1
        if len(self.up) < n:
            self.up, self.down = self._grown(self.up, self.base, n), self._grown(self.down, pow(self.base, -1, 1 << 64), n)
        out = np.zeros(n, np.uint64)
        np.cumsum(self.byte[data] * self.down[: n - 1], out=out[1:])
        return out

    def substring(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.up[start]


_powers: dict[int, Powers] = {}


def powers(seed: int = 1) -> Powers:
    if seed not in _powers:
        _powers[seed] = Powers(seed)
    return _powers[seed]


def sliding(x: np.ndarray, size: int, of) -> np.ndarray:
    """of (minimum or maximum) over every run of `size` values, in a logarithm of passes."""
    now = 1
    while 2 * now <= size:
        x = of(x[:-now], x[now:])
        now *= 2
    return of(x[: len(x) - (size - now)], x[size - now :]) if size > now else x


def _pieces(docs: list[bytes]) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
    """Blocks of (text, offset, first and last place to look at, bytes): short texts together, long ones cut with margins."""
    block, size = [], 0
    for i, t in enumerate(docs):
        if len(t) < WINDOW:
            continue
        for first in range(0, len(t), PIECE):
            lo, hi = max(0, first - MARGIN), min(len(t), first + PIECE + MARGIN)
            block.append((i, lo, first, min(first + PIECE, len(t)), t[lo:hi]))
            size += hi - lo
            if size >= PIECE:
                yield block
                block, size = [], 0
    if block:
        yield block


def anchors(docs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, key, context) of all anchors."""
    hashes = powers()
    for block in _pieces(docs):
        data = np.frombuffer(b"".join(x[4] for x in block), np.uint8)
        size = np.array([len(x[4]) for x in block])
        end = np.cumsum(size)
        piece = np.repeat(np.arange(len(block)), size)
        if len(data) < WINDOW:
            continue
        sums = hashes.prefixes(data)
        at = np.arange(len(data) - GRAM + 1)
        gram = mixed((sums[GRAM:] - sums[:-GRAM]) * hashes.up[: len(at)]) | np.uint64(1)
        least = sliding(gram, REACH + 1, np.minimum)
        least[end[piece[: len(least)]] - at[: len(least)] < WINDOW] = 0  # windows that would cross an end
        margin = np.zeros(REACH, np.uint64)
        found = np.flatnonzero(sliding(np.concatenate([margin, least, margin]), REACH + 1, np.maximum) == gram)
        own = piece[found]
        info = np.array([x[:4] for x in block], np.int64)
        begin = end - size
        place = found - begin[own] + info[own, 1]
        keep = (place >= info[own, 2]) & (place < info[own, 3])
        found, own, place = found[keep], own[keep], place[keep]
        lo, hi = np.maximum(found - REACH, begin[own]), np.minimum(found + WINDOW, end[own])
        shape = (found - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (hi - found).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        yield info[own, 0], place, gram[found], mixed(hashes.substring(sums, lo, hi) + shape)


def union_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite the touching spans of each document; rows are sorted by document and start."""
    if not len(doc):
        return doc, start, end
    far = np.maximum.accumulate(end + doc * (1 << 32))  # documents are numbered upwards
    new = np.flatnonzero(np.concatenate([[True], (start + doc * (1 << 32))[1:] > far[:-1]]))
    last = np.append(new[1:], len(doc)) - 1
    return doc[new], start[new], far[last] - doc[new] * (1 << 32)


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of a batch, the earliest of each context; what the others cover goes as spans (end is not null)."""
    for batch in batches:
        docs = texts(batch)
        o, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("o", "h"))
        parts = list(anchors(docs))
        if not parts:
            continue
        doc, place, key, context = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.lexsort((place, h[doc], o[doc], context))
        first = np.ones(len(by), bool)
        first[1:] = context[by][1:] != context[by][:-1]
        at = by[first]
        yield arrow_rows(_ANCHORS, key=key[at].view(np.int64), context=context[at].view(np.int64), o=o[doc[at]], h=h[doc[at]], place=place[at].astype(np.int32), end=pa.nulls(len(at), pa.int32()))
        rest = by[~first]
        if len(rest):
            rest = rest[np.lexsort((place[rest], doc[rest]))]
            size = np.array([len(t) for t in docs])
            d, start, end = union_of(doc[rest], np.maximum(place[rest] - REACH, 0), np.minimum(place[rest] + WINDOW, size[doc[rest]]))
            yield arrow_rows(_ANCHORS, key=h[d], context=np.zeros(len(d), np.int64), o=o[d], h=h[d], place=start.astype(np.int32), end=end.astype(np.int32))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted anchors: spans of those that repeat a whole context, and (with their key) the earliest ones of contexts that share
    their 32 bytes with another context."""
    last = None  # key and context of the row before
    held = None  # the earliest anchor of the last context, and whether its key had one before
    for batch in batches:
        is_span = batch.column("end").is_valid().to_numpy(zero_copy_only=False)
        if is_span.any():
            at = pa.array(np.flatnonzero(is_span))
            yield arrow_rows(_PARTS, key=pa.nulls(len(at), pa.int64()), o=batch.column("o").take(at), h=batch.column("h").take(at), start=batch.column("place").take(at), end=batch.column("end").take(at))
        at = np.flatnonzero(~is_span)
        if not len(at):
            continue
        key, context, o, h, place = (batch.column(c).to_numpy(zero_copy_only=False)[at] for c in ("key", "context", "o", "h", "place"))
        new_key, new = np.ones(len(at), bool), np.ones(len(at), bool)
        new_key[1:] = key[1:] != key[:-1]
        new[1:] = new_key[1:] | (context[1:] != context[:-1])
        if last is not None:
            new_key[0] = key[0] != last[0]
            new[0] = new_key[0] or context[0] != last[1]
        rep = np.flatnonzero(~new)
        yield arrow_rows(_PARTS, key=pa.nulls(len(rep), pa.int64()), o=o[rep], h=h[rep], start=np.maximum(place[rep] - REACH, 0), end=place[rep] + np.int32(WINDOW))
        at = np.flatnonzero(new)
        rows = [x[at] for x in (key, o, h, place)]
        follows = ~new_key[at]  # an earlier context has this key
        if held is not None:
            rows = [np.concatenate([[x], y]).astype(y.dtype) for x, y in zip(held[:4], rows, strict=True)]
            follows = np.concatenate([[held[4]], follows])
        last = (key[-1], context[-1])
        if len(rows[0]):
            held = (*(x[-1] for x in rows), follows[-1])
            some = np.flatnonzero(follows[:-1] | follows[1:])
            yield arrow_rows(_PARTS, key=rows[0][some], o=rows[1][some], h=rows[2][some], start=rows[3][some], end=pa.nulls(len(some), pa.int32()))
    if held is not None and held[4]:
        yield arrow_rows(_PARTS, **{c: np.array([x], t) for c, x, t in zip(("key", "o", "h", "start"), held, (np.int64, np.int64, np.int64, np.int32), strict=False)}, end=pa.nulls(1, pa.int32()))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The context of every wanted anchor, cut out of its text."""
    for batch in batches:
        o, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("o", "h"))
        for i, (t, wanted) in enumerate(zip(texts(batch), batch.column("wanted").to_pylist(), strict=True)):
            key = [w["key"] for w in wanted]
            place = [w["start"] for w in wanted]
            before = [min(p, REACH) for p in place]
            cut = [t[p - b : p + WINDOW] for p, b in zip(place, before, strict=True)]
            for s in range(0, len(key), 20_000):
                e = s + len(key[s : s + 20_000])
                yield arrow_rows(_CONTEXTS, key=key[s:e], o=np.full(e - s, o[i]), h=np.full(e - s, h[i]), place=place[s:e], before=before[s:e], text=cut[s:e])


class Collision(Exception):
    """Two different strings had one hash."""


class SuffixSort:
    """Sorted suffixes of contexts, each from its anchor on, within groups; contexts of a group come in the order of the corpus."""

    def __init__(self, contexts: list[bytes], before: np.ndarray, group: np.ndarray, seed: int = 2) -> None:
        self.hashes = powers(seed)
        self.data = np.frombuffer(b"".join(contexts) + bytes(WINDOW + 1), np.uint8)
        size = np.array([len(x) for x in contexts])
        self.start = np.cumsum(size) - size + before
        self.before, self.after = before, size - before
        self.sums = self.hashes.prefixes(self.data)
        self.group = group
        self.order = self._sorted()
        self.common = np.full(len(group), -1)
        a, b = self.order[:-1], self.order[1:]
        self.common[1:] = np.where(group[a] == group[b], self.extension(a, b), -1)
        self._verify()

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes: a binary search over prefix hashes."""
        lo, hi = np.zeros(len(a), np.int64), np.minimum(self.after[a], self.after[b])
        x, y = self.start[a], self.start[b]
        while True:
            going = lo < hi
            if not going.any():
                return lo
            mid = (lo + hi + 1) // 2
            same = self.hashes.substring(self.sums, x, x + mid) == self.hashes.substring(self.sums, y, y + mid)
            lo, hi = np.where(going & same, mid, lo), np.where(going & ~same, mid - 1, hi)

    def _after(self, a: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(n < self.after[a], self.data[self.start[a] + n].astype(np.int64), -1)

    def compared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.extension(a, b)
        return np.sign(self._after(a, n) - self._after(b, n))

    def _sorted(self) -> np.ndarray:
        """Mergesort of all groups at once: each suffix finds its place in the neighbouring run by binary search."""
        k = len(self.group)
        order = np.arange(k)
        new = np.concatenate([[True], self.group[1:] != self.group[:-1]]) if k else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        ends = np.append(starts[1:], k)
        begin, end = starts[of], ends[of]
        width, most = 1, int((ends - starts).max(initial=0))
        while width < most:
            at = np.flatnonzero(end - begin > width)
            run = (at - begin[at]) // width
            odd = run % 2 == 1
            left = begin[at] + (run - odd) * width
            right = np.minimum(left + width, end[at])
            own = np.where(odd, right, left)
            other = np.where(odd, left, right)
            lo, hi = other.copy(), np.where(odd, right, np.minimum(right + width, end[at]))
            me = order[at]
            while len(go := np.flatnonzero(lo < hi)):
                mid = (lo[go] + hi[go]) // 2
                sign = self.compared(order[mid], me[go])
                before = np.where(odd[go], sign <= 0, sign < 0)
                lo[go], hi[go] = np.where(before, mid + 1, lo[go]), np.where(before, hi[go], mid)
            after = order.copy()
            after[left + (at - own) + (lo - other)] = me
            order = after
            width *= 2
        return order

    def _bytes(self, at: np.ndarray, n: int = WINDOW) -> np.ndarray:
        return self.data[at[:, None] + np.arange(n)]

    def _verify(self) -> None:
        """Neighbours of the sorted order, byte by byte."""
        for s in range(1, len(self.order), 20_000):
            b = self.order[s : s + 20_000]
            a = self.order[s - 1 : s - 1 + len(b)]
            of = np.flatnonzero(self.group[a] == self.group[b])
            a, b, said = a[of], b[of], self.common[s : s + 20_000][of]
            most = np.minimum(self.after[a], self.after[b])
            differ = (self._bytes(self.start[a]) != self._bytes(self.start[b])) | (np.arange(WINDOW) >= most[:, None])
            real = np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOW)
            if (real != said).any() or (self._after(a, real) > self._after(b, real)).any():
                raise Collision

    def repeats(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, least and most bytes before its anchor at which a window begins that an earlier context has too)."""
        k = len(self.order)
        least, most = np.full(k, -1), np.full(k, -1)
        source = np.zeros((2, k), np.int64)
        before, after, start = self.before[self.order], self.after[self.order], self.start[self.order]
        shared = np.maximum(self.common, np.append(self.common[1:], -1))
        for o in range(REACH + 1):
            at = np.flatnonzero((shared >= WINDOW - o) & (before >= o) & (after >= WINDOW - o))
            if len(at) < 2:
                continue
            run = np.cumsum(self.common < WINDOW - o)[at]
            left = self.hashes.substring(self.sums, start[at] - o, start[at])
            by = np.lexsort((self.order[at], left, run))
            run, left, own = run[by], left[by], self.order[at[by]]
            new = np.concatenate([[True], (run[1:] != run[:-1]) | (left[1:] != left[:-1])])
            late = own[~new]
            first = own[np.flatnonzero(new)[np.cumsum(new) - 1]][~new]
            fresh = late[least[late] < 0]
            least[fresh] = o
            source[0, fresh] = first[least[late] == o] if len(fresh) == len(late) else first[np.isin(late, fresh)]
            most[late], source[1, late] = o, first
        found = np.flatnonzero(least >= 0)
        for o, of in ((least[found], source[0, found]), (most[found], source[1, found])):
            for s in range(0, len(found), 20_000):
                a, b, n = found[s : s + 20_000], of[s : s + 20_000], o[s : s + 20_000]
                if (self._bytes(self.start[a] - n) != self._bytes(self.start[b] - n)).any():
                    raise Collision
        return found, least[found], most[found]


def repeated(contexts: list[bytes], before: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    for seed in range(2, 100):
        try:
            return SuffixSort(contexts, before, group, seed).repeats()
        except Collision:
            continue
    raise RuntimeError("hashes collide under every base")


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the contexts of whole groups; groups come one after the other, in the order of the corpus."""
    held: list[pa.RecordBatch] = []
    size = 0

    def spans(rows: pa.Table) -> pa.RecordBatch:
        key, o, h, place, before = (rows.column(c).to_numpy() for c in ("key", "o", "h", "place", "before"))
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        at, least, most = repeated(rows.column("text").to_pylist(), before.astype(np.int64), group)
        return arrow_rows(_PARTS, key=pa.nulls(len(at), pa.int64()), o=o[at], h=h[at], start=place[at] - most.astype(np.int32), end=place[at] - least.astype(np.int32) + np.int32(WINDOW))

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        if size > CHUNK:
            ends = np.flatnonzero(np.concatenate([[held[-1].column("key")[-1].as_py() != key[0]], key[1:] != key[:-1]]))
            if len(ends):
                yield spans(pa.Table.from_batches([*held, batch.slice(0, ends[0])]))
                batch, held, size = batch.slice(ends[0]), [], 0
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
    if held:
        yield spans(pa.Table.from_batches(held))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a context that holds the anchor's 32 bytes, by two hashes."""
    for batch in batches:
        o, h, place = (batch.column(c).to_numpy() for c in ("o", "h", "place"))
        for i, (t, b) in enumerate(zip(batch.column("text").to_pylist(), batch.column("before").to_pylist(), strict=True)):
            data = np.frombuffer(t, np.uint8)
            at = np.arange(max(0, len(t) - WINDOW + 1))
            if len(at):
                hashes = [mixed(p.substring(p.prefixes(data), at, at + WINDOW)).view(np.int64) for p in (powers(3), powers(4))]
                yield arrow_rows(_WINDOWS, a=hashes[0], b=hashes[1], o=np.full(len(at), o[i]), h=np.full(len(at), h[i]), start=(place[i] - b + at).astype(np.int32))


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t, spans in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
            s = np.array(spans or [], np.int64)
            start, end = s >> 32, np.minimum(s & 0xFFFFFFFF, len(t))
            _, start, end = union_of(np.zeros(len(s), np.int64), start, end)
            digest, at = hashlib.sha256(), 0
            for x, y in zip(start.tolist(), end.tolist(), strict=True):
                digest.update(memoryview(t)[at:x])
                at = y
            digest.update(memoryview(t)[at:])
            rows.append((len(t), int((end - start).sum()), len(start), digest.hexdigest()))
        n, removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield arrow_rows(_RESULT, doc_id=batch.column("doc_id"), copies=batch.column("copies"), n_bytes=list(n), n_removed=list(removed), n_spans=list(spans), kept_sha256=list(kept))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(o, h, doc_id, text, copies): one row for equal rows, which are counted first by their key alone."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(_LAST)).alias("o"), F.xxhash64(text, doc_id.isNull()).alias("h"), doc_id.alias("doc_id"), text.alias("text"))
    several = materialise(rows.groupBy("o", "h").count().where("count > 1").select("o", "h"), "repeated")
    one = F.lit(1).cast("long").alias("copies")
    if several.isEmpty():
        return rows.select("*", one)
    copied = rows.join(several, ["o", "h"], "left_semi").groupBy("o", "h").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies"))
    return rows.join(several, ["o", "h"], "left_anti").select("*", one).unionByName(copied)


def _packed(start: Column, end: Column) -> Column:
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(end.cast("long"))


def spans_of(rows: DataFrame, most: int = MOST) -> DataFrame:
    """(o, h, start, end): what is to be removed, in any order and overlapping; ends may lie past the text."""
    sent = rows.select("o", "h", "text").mapInArrow(_sent, ddl(_ANCHORS))
    placed = sent.repartition("key").sortWithinPartitions("key", "context", "o", "h", "place")
    parts = materialise(placed.mapInArrow(_classes, ddl(_PARTS)), "classes")
    wanted = parts.where(F.col("key").isNotNull()).groupBy("o", "h").agg(F.collect_list(F.struct("key", "start")).alias("wanted"))
    contexts = rows.select("o", "h", "text").join(wanted, ["o", "h"]).mapInArrow(_contexts, ddl(_CONTEXTS))
    crowded = materialise(parts.where(F.col("key").isNotNull()).groupBy("key").count().where(F.col("count") > most).select("key"), "crowded")
    known = parts.where(F.col("key").isNull()).select("o", "h", "start", "end")
    some = not crowded.isEmpty()
    calm = contexts.join(crowded, "key", "left_anti") if some else contexts
    matched = calm.repartition("key").sortWithinPartitions("key", "o", "h", "place").mapInArrow(_matched, ddl(_PARTS))
    found = materialise(matched.select("o", "h", "start", "end"), "matches")
    if some:
        windows = materialise(contexts.join(crowded, "key", "left_semi").mapInArrow(_windows, ddl(_WINDOWS)), "windows")
        first = windows.groupBy("a", "b").agg(F.min(F.struct("o", "h", "start")).alias("first"))
        late = windows.join(first, ["a", "b"]).where(F.struct("o", "h", "start") > F.col("first"))
        found = found.unionByName(late.select("o", "h", "start", (F.col("start") + WINDOW).alias("end")))
    return known.unionByName(found)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    ship(docs.sparkSession)
    bounded(docs.sparkSession)
    rows = _documents(docs, id_col, text_col)
    spans = spans_of(rows, most).groupBy("o", "h").agg(F.sort_array(F.collect_list(_packed(F.col("start"), F.col("end")))).alias("spans"))
    done = rows.join(spans, ["o", "h"], "left").select("doc_id", "copies", "text", "spans").mapInArrow(_finished, ddl(_RESULT))
    again = F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth", "_")
    done = done.select("*", again)
    gone = (F.col("nth") > 0) & (F.col("n_bytes") >= WINDOW)
    return done.select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"), F.when(gone, F.lit(hashlib.sha256().hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))
