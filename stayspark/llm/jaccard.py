"""Jaccard join of 5-word shingle sets by universe-partition pigeonholes.

A set's shingles are hashed into the segments of its size band, and into those of the band below if a partner may lie there.
All shingles in a segment are one signature. Two sets with J >= 75/100 differ in at most H = (|r| + |s|) / 7 shingles, so in at
most H segments: of f segments with shingles at least f - H are the same in both. Hence, under any one order of all signatures,
the first H + 1 of each set have one in common.

The order is the cost-based allocation. A signature that up to HOT sets have is cheap: its pairs are made. A dearer one (a
passage of many documents, a segment that thousands of near copies share) comes last, dearer ones later, and is looked at only
by sets that lack H + 1 cheap ones: these skip f - H - 1 of their signatures, the dearest, and need the others. All sets
of a dear signature are compared with a few of them (pivots); what is connected through these needs no more comparing; sets that
need the same dear signature and are still apart are joined on it, with sizes and folded sketches in the join's condition.
One-deletion neighbourhoods serve small sets, of two to seven shingles: they also index the whole set, and it without each one
of its shingles. Should a set have H or fewer segments with shingles, all is indexed anew with other hashes and more segments.

Candidates pass a lower bound on their difference (parity sketches) and are then verified exactly on the shingles. Equal sets
are one set from the beginning; components need no pairs inside what is connected already. Sets are named by 64-bit keys; where
two different sets have one key (a second hash shows it) both get names of their own and are a candidate pair.

Members of one signature meet in one task, at 12 bytes each and at most `hot` + 1 from each FLUSH signatures that a task has
made: those beyond go their own way and are tied to the least of their kind there.

Defined results: null, empty and blank texts have no shingles and link with nothing, equal ones included; rows with equal
doc_id are each a row of the result, in the component of all their texts' links; null ids give rows with their own shingle
count and a null component; an empty table gives no row; other columns are ignored; a text of any length is one set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, discard, forgotten, materialise, returned, slices, table, texts, with_bytes
from stayspark.llm.components import components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
HOT = 48
SKETCH = 1024  # bits of the smallest sketch, and of those that joins test
FLUSH = 500_000  # signatures that a task holds before it hands them on
SLICE = 1 << 20  # bytes of text that are worked on at once
KEY_BITS = 64
CHARS_A_TASK = 24_000_000
BROADCAST_SETS = 500_000  # 16 bytes each
U = np.uint64
_MIX = [U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def mix(x: np.ndarray, k: int = 0) -> np.ndarray:
    x = x + U(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * _MIX[0]
    x = (x ^ (x >> U(27))) * _MIX[1]
    return x ^ (x >> U(31))


def shingle_sets(batch: list[bytes]) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    split = [t.lower().split() for t in batch]
    size = [len(x) for x in split]
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, sum(size))
    h = words[: max(0, len(words) - SHINGLE + 1)].copy()
    for k in range(1, SHINGLE):
        h = h * _MIX[3] + words[k : k + len(h)]
    h = mix(h)
    out, at = [], 0
    for n in size:
        if n >= SHINGLE:
            out.append(np.unique(h[at : at + n - SHINGLE + 1]))
        elif n:
            whole = U(n)
            with np.errstate(over="ignore"):
                for w in words[at : at + n]:
                    whole = whole * _MIX[4] + w
            out.append(mix(np.array([whole]), 7))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def set_keys(sets: list[np.ndarray], bits: int = KEY_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set; 0 for empty ones. The first keeps so many bits."""
    size = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(size)
    out = np.zeros((2, len(sets)), np.int64)
    if len(full):
        flat, at = np.concatenate(sets), (np.cumsum(size) - size)[full]
        for k in (0, 1):
            out[k, full] = np.add.reduceat(mix(flat, 11 + k), at).view(np.int64)
    return out[0] if bits == 64 else out[0] & ((1 << bits) - 1), out[1]


def sketch(s: np.ndarray) -> bytes:
    """Bit i says whether an odd number of shingles has hash i; sets differ in at least as many shingles as bits. There are as
    many bits as shingles, about, so that sets of any size tell apart; longer sketches fold into shorter ones."""
    bits = max(SKETCH, 1 << (len(s) - 1).bit_length()) if len(s) else SKETCH
    return np.packbits(np.bincount((s >> U(20)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    n = min(len(a), len(b))
    fold = lambda v: np.bitwise_xor.reduce(v.reshape(-1, n), axis=0)
    return int(np.bitwise_count(fold(a) ^ fold(b)).sum())


def linked(common: int, a: int, b: int) -> bool:
    return DENOMINATOR * common >= NUMERATOR * (a + b - common)


def most_different(a, b):
    """The largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def band_segments(band: int) -> int:
    """Segments of the band of sets of 2^band up to twice as many shingles: about two shingles each in the largest."""
    return 1 << 16 if band < 3 else max(256, 1 << band)


def schemes(n: int) -> list[tuple[int, int]]:
    """(band, most differences) under which a set of n shingles is indexed."""
    band = n.bit_length() - 1
    out = [(band, most_different(n, n * DENOMINATOR // NUMERATOR))]
    if band and -(-n * NUMERATOR // DENOMINATOR) < 1 << band:
        out.append((band - 1, most_different(n, (1 << band) - 1)))
    return out


def neighbourhoods(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """(index of set, signature) of small sets and of each of them without one shingle."""
    owner, sig = [], []
    for k, s in enumerate(sets):
        if 2 <= len(s) < 8:
            h = mix(s, 6)
            total = h.sum(dtype=np.uint64)
            each = mix(np.append(total - h, total), 8)
            owner += [k] * len(each)
            sig += each.tolist()
    return owner, sig


def signatures(sets: list[np.ndarray], seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of set, signature) of all segments with shingles; (even, odd) of each set: how many signatures of its even and of
    its odd band it may skip, -1 for none; and the sets that are short of segments. A signature's highest bit is its band's lowest."""
    owner, band, most = [], [], []
    for k, s in enumerate(sets):
        if len(s):
            for b, h in schemes(len(s)):
                owner.append(k)
                band.append(b)
                most.append(h)
    room = np.full((len(sets), 2), -1, np.int64)
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), room, np.zeros(0, np.int64)
    owner, band, most = np.array(owner), np.array(band), np.array(most)
    size = np.array([len(sets[k]) for k in owner])
    row = np.repeat(np.arange(len(owner)), size)
    h = np.concatenate([sets[k] for k in owner])
    segment = (mix(h, 30 + seed) % np.array([band_segments(b) << min(seed, 20) for b in band], np.uint64)[row]).astype(np.int64)
    key = row.astype(np.int64) << 40 | segment
    order = np.argsort(key)
    key, h = key[order], mix(h[order], 5)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    total = np.add.reduceat(h, first)
    key = key[first]
    row = key >> 40
    sig = mix(total + mix(((band[row] << 40) | (key & 0xFFFFFFFFFF)).astype(np.uint64), 9), 4)
    sig = sig & U(0x7FFFFFFFFFFFFFFF) | (band[row] & 1).astype(np.uint64) << U(63)
    filled = np.bincount(row, minlength=len(owner))
    room[owner, band & 1] = filled - most - 1
    more = neighbourhoods(sets)
    return np.append(owner[row], np.array(more[0], np.int64)), np.append(sig, np.array(more[1], np.uint64)), room, np.unique(owner[filled <= most])


def _blob(sig: np.ndarray, ids: np.ndarray, width: int = 4) -> bytes:
    return sig.astype(f"<u{width}").tobytes() + ids.astype("<i8").tobytes()


def _unblob(data: bytes, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // (width + 8)
    return np.frombuffer(data, f"<u{width}", n), np.frombuffer(data, "<i8", n, n * width)


_OWN = [("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("check", pa.int64()), ("even", pa.int64()), ("odd", pa.int64()), ("sketch", pa.binary())]
_BLOBS = pa.schema([("bucket", pa.int32()), ("data", pa.binary()), *_OWN])
_OWN_DDL = "doc_id long, n long, set_id long, check long, even long, odd long, sketch binary"
SHORT, CROWD = -1, -2  # buckets of sets short of segments, and of members beyond what a task hands on to a signature's bucket
MARK = -(1 << 63)  # stands among a signature's members where some went their own way
DEAREST = 1 << 40  # the size of such a group


def _lacking(rows: int, names: list[tuple[str, pa.DataType]]) -> dict[str, pa.Array]:
    return {k: pa.nulls(rows, t) for k, t in names}


def crowded(sig: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Whether an entry is beyond the `most` least ids of its signature."""
    out = np.zeros(len(sig), bool)
    place = ((sig >> U(12)) & U((1 << 20) - 1)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(place, minlength=1 << 20)[place] > most)
    if len(maybe):
        maybe = maybe[np.lexsort((ids[maybe], sig[maybe]))]
        own = sig[maybe]
        start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
        out[maybe[rank >= most]] = True
    return out


def indexed(docs: DataFrame, buckets: int, hot: int, seed: int = 0, bits: int = KEY_BITS) -> DataFrame:
    """Signatures of all sets as blobs (32 bits of the signature beside the bucket, and the set), one for each bucket and some
    MB of input, and a row without blob for every document. A task indexes equal sets that it meets again and again once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forgotten()
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[tuple[int, int]] = set()
        met = 0

        def rows(bucket, data) -> pa.RecordBatch:
            return arrow_rows(_BLOBS, bucket=bucket, data=data, **_lacking(len(bucket), _OWN))

        def out() -> Iterator[pa.RecordBatch]:
            sig, ids = (np.concatenate(x) for x in zip(*kept, strict=True))
            bucket = (sig % U(buckets)).astype(np.int64)
            beyond = crowded(sig, ids, hot + 1)
            if beyond.any():
                # Members beyond, each with the least one of its signature here.
                here = np.isin(sig, np.unique(sig[beyond]))
                own, member = sig[here], ids[here]
                order = np.lexsort((member, own))
                own, member = own[order], member[order]
                start = np.append(True, own[1:] != own[:-1])
                least = member[start][np.cumsum(start) - 1]
                rank = np.arange(len(own)) - np.flatnonzero(start)[np.cumsum(start) - 1]
                far = rank > hot
                name = (own[far] % U(buckets)) << U(32) | own[far] >> U(32)
                yield rows([CROWD - met % buckets], [_blob(name, member[far], 8) + least[far].astype("<i8").tobytes()])
                dear = np.unique(sig[beyond])
                sig, ids = np.append(sig[~beyond], dear), np.append(ids[~beyond], np.full(len(dear), MARK))
                bucket = (sig % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            filled = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            yield rows(filled, [_blob(sig[at] >> U(32), ids[at]) for at in (order[ends[b] : ends[b + 1]] for b in filled)])

        for whole in batches:
            for batch in slices(whole, most=SLICE):
                sets = shingle_sets(texts(batch))
                keys, checks = set_keys(sets, bits)
                size = np.array([len(s) for s in sets], np.int64)
                own = []
                for k, key in enumerate(zip(keys.tolist(), checks.tolist(), strict=True)):
                    if size[k] and key not in seen:
                        seen.add(key)
                        own.append(k)
                if len(seen) > 1_000_000:
                    seen.clear()
                of, sig, room, short = signatures([sets[k] for k in own], seed)
                rooms = np.full((len(sets), 2), -1, np.int64)
                rooms[own] = room
                # Rows without blob go to buckets in turn: copies of one text don't meet in one task.
                yield arrow_rows(_BLOBS, bucket=((met + np.arange(len(sets))) % buckets).astype(np.int32), data=pa.nulls(len(sets), pa.binary()), doc_id=batch.column("doc_id"), n=size, set_id=keys, check=checks, even=rooms[:, 0], odd=rooms[:, 1], sketch=[sketch(s) for s in sets])
                met += len(sets)
                if len(short):
                    yield rows([SHORT], [b""])
                if len(sig):
                    kept.append((sig, keys[own][of]))
                if sum(len(x) for x, _ in kept) > FLUSH:
                    yield from out()
                    kept.clear()
        if kept:
            yield from out()
            kept.clear()
        seen.clear()
        returned()

    return with_bytes(docs).mapInArrow(run, f"bucket int, data binary, {_OWN_DDL}")


_PAIRS = pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("k", pa.int64()), *_OWN])


def _rows(kind: str, a: np.ndarray, b: np.ndarray, count: np.ndarray, most: int = 100_000) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(a), most):
        n = len(a[k : k + most])
        yield arrow_rows(_PAIRS, kind=pa.repeat(pa.scalar(kind), n), a=a[k : k + most], b=b[k : k + most], k=count[k : k + most], **_lacking(n, _OWN))


def _pairs_within(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of groups of at most HOT ids, groups of one size at a time."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(sizes):
        block = ids[starts[sizes == n][:, None] + np.arange(n)]
        i, k = np.triu_indices(n, 1)
        a.append(block[:, i].ravel())
        b.append(block[:, k].ravel())
    return np.concatenate(a), np.concatenate(b)


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new], np.diff(np.append(np.flatnonzero(new), len(a)))


def pivots(members: np.ndarray) -> list[int]:
    """The least of some ids in three different orders."""
    return [int(members[np.argmin(members if k < 0 else mix(members.view(np.uint64), k))]) for k in (-1, 60, 61)]


def gathered(blobs: DataFrame, partitions: int, hot: int = HOT) -> DataFrame:
    """Rows of kind `even` and `odd` for pairs (a, b) that share k signatures of such a band, of groups of at most `hot` sets;
    `spoke` for pairs of a larger group's sets with its pivots, `hot` for the members of larger groups (a signature, b set, k
    members), `set` for every document, and `short`."""

    def groups(parts: list[bytes], bucket: int) -> Iterator[pa.RecordBatch]:
        sig, ids = (np.concatenate(x) for x in zip(*map(_unblob, parts), strict=True))
        order = np.lexsort((ids, sig))
        sig, ids = sig[order], ids[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
        sig, ids = sig[new], ids[new]
        starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        sizes = np.diff(np.append(starts, len(sig)))
        for kind, half in (("even", sig[starts] >> 31 == 0), ("odd", sig[starts] >> 31 == 1)):
            some = (sizes > 1) & (sizes <= hot) & half
            yield from _rows(kind, *_counted(*_pairs_within(ids, starts[some], sizes[some])))
        spokes = [], []
        for at in np.flatnonzero(sizes > hot):
            members = ids[starts[at] : starts[at] + sizes[at]]
            dear = members[0] == MARK  # the least of all ids
            members = members[1:] if dear else members
            name = (bucket << 32) | int(sig[starts[at]])
            yield from _rows("hot", np.full(len(members), name), members, np.full(len(members), DEAREST if dear else len(members)))
            for p in pivots(members):
                other = members[members != p]
                spokes[0].append(np.minimum(other, p))
                spokes[1].append(np.maximum(other, p))
        if spokes[0]:
            yield from _rows("spoke", *_counted(*map(np.concatenate, spokes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for whole in batches:
            own = whole.filter(pc.is_null(whole.column("data")))
            if own.num_rows:
                yield arrow_rows(_PAIRS, kind=pa.repeat(pa.scalar("set"), own.num_rows), **_lacking(own.num_rows, [("a", pa.int64()), ("b", pa.int64()), ("k", pa.int64())]), **{k: own.column(k) for k, _ in _OWN})
            batch = whole.filter(pc.is_valid(whole.column("data")))
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if bucket == SHORT:
                    yield from _rows("short", *np.zeros((3, 1), np.int64))
                elif bucket <= CROWD:
                    name, member, least = np.frombuffer(data, "<i8").reshape(3, -1)
                    yield from _rows("hot", name, member, np.full(len(name), DEAREST))
                    yield from _rows("spoke", *_counted(least, member))
                else:
                    if bucket != now and parts:
                        yield from groups(parts, now)
                        parts = []
                    now = bucket
                    parts.append(data)
        if parts:
            yield from groups(parts, now)

    return blobs.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(run, f"kind string, a long, b long, k long, {_OWN_DDL}")


def sharing(groups: DataFrame, sets: DataFrame, crowds: DataFrame) -> DataFrame:
    """Pairs of keys that share enough cheap signatures for a link: of f signatures in a band, linked sets share f - H, all but
    the dear ones of which were counted. One less is asked for, since 32 bits of two signatures of a set may be equal.
    crowds: (set_id, evens, odds), the dear signatures of each set."""
    dear = lambda x: F.coalesce(F.col(x), F.lit(0))
    asked = sets.join(crowds, "set_id", "left").select("set_id", *[F.when(F.col(room) >= 0, F.col(room) - dear(f"{room}s")).alias(room) for room in ("even", "odd")])
    asked = asked.groupBy("set_id").agg(F.min("even").alias("even"), F.min("odd").alias("odd"))
    k = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("k"))), F.lit(0)).alias(f"k_{kind}")
    # Dealt by one end: the sum and the first join need no other shuffle, and few pairs are left for the second.
    dealt = groups.where("kind IN ('even', 'odd')").select("kind", "a", "b", "k").repartition("a")
    found = dealt.groupBy("a", "b").agg(k("even"), k("odd"))
    enough = lambda x: (F.coalesce(F.col("k_even") >= F.col(f"even_{x}"), F.lit(False)), F.coalesce(F.col("k_odd") >= F.col(f"odd_{x}"), F.lit(False)))
    of = lambda x: asked.select(F.col("set_id").alias(x), F.col("even").alias(f"even_{x}"), F.col("odd").alias(f"odd_{x}"))
    (even_a, odd_a), (even_b, odd_b) = enough("a"), enough("b")
    first = found.join(of("a"), "a").where(even_a | odd_a)
    return first.join(of("b"), "b").where((even_a & even_b) | (odd_a & odd_b)).select("a", "b")


def plausible(pairs: DataFrame, sets: DataFrame, by: str = "node") -> DataFrame:
    """Pairs (a, b) of nodes whose sizes and sketches allow a link; the pairs given are of nodes, or `by` keys (set_id)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(k).to_numpy() for k in ("na", "nb"))
                fits = DENOMINATOR * np.minimum(na, nb) >= NUMERATOR * np.maximum(na, nb)
                most = most_different(na, nb)
                sa, sb = batch.column("sa"), batch.column("sb")
                near = pa.array([bool(f) and bits_apart(sa[k].as_py(), sb[k].as_py()) <= m for k, (f, m) in enumerate(zip(fits, most, strict=True))], pa.bool_())
                yield arrow_rows(schema, a=batch.column("a").filter(near), b=batch.column("b").filter(near))

    of = lambda x: sets.select(F.col(by).alias(x), F.col("node").alias(f"k{x}"), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"), "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs that are linked, by exact comparison of shingles; members: (node, shingles)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                if last[0] != a:
                    last = (a, np.frombuffer(x, np.uint64))
                own, other = last[1], np.frombuffer(y, np.uint64)
                at = np.searchsorted(own, other)
                common = int((own[np.minimum(at, len(own) - 1)] == other).sum())
                keep.append(linked(common, len(own), len(other)))
            keep = pa.array(keep, pa.bool_())
            yield arrow_rows(schema, a=batch.column("a").filter(keep), b=batch.column("b").filter(keep))

    x, y = members.select(F.col("node").alias("a"), F.col("shingles").alias("x")), members.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def shingles_of(docs: DataFrame, pairs: DataFrame, sets: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """(node, shingles) of all sets in pairs; once for every row of the document that stands for a set."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=SLICE):
                made = shingle_sets(texts(batch))
                keys, checks = set_keys(made, bits)
                # Rows with equal ids may have other texts; only that of the set counts.
                own = np.flatnonzero((keys == batch.column("set_id").to_numpy()) & (checks == batch.column("check").to_numpy()))
                if len(own):
                    yield arrow_rows(schema, node=batch.column("node").take(pa.array(own)), shingles=[made[k].tobytes() for k in own])

    ids = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = materialise(ids.join(sets, "node").select("node", "set_id", "check", "doc_id"), "wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_SETS else wanted
    return with_bytes(docs).join(side, "doc_id").select("node", "set_id", "check", "text").mapInArrow(run, "node long, shingles binary")


def scanned(docs: DataFrame, hot: int = HOT, bits: int = KEY_BITS) -> DataFrame:
    """The result of one pass over docs: rows of `gathered`. The number of partitions follows the amount of text."""
    spark = docs.sparkSession
    chars = docs.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_A_TASK))
    for seed in count():
        groups = materialise(gathered(indexed(docs, 4 * partitions, hot, seed, bits), partitions, hot), "groups")
        if groups.where("kind = 'short'").limit(1).count() == 0:
            return groups
        discard(groups)


def distinct_sets(full: DataFrame) -> DataFrame:
    """One row (set_id, check, node, doc_id, n, even, odd, sketch) for each set; sets with one key get nodes of their own."""
    facts = [F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("even").alias("even"), F.max("odd").alias("odd"), F.first("sketch").alias("sketch")]
    by_key = materialise(full.groupBy("set_id").agg(F.min("check").alias("check"), F.max("check").alias("high"), *facts), "distinct")
    sets = by_key.where(F.col("check") == F.col("high")).withColumn("node", F.col("set_id"))
    odd = by_key.where(F.col("check") != F.col("high")).select("set_id")
    if not odd.isEmpty():
        own = full.join(odd, "set_id", "left_semi").groupBy("set_id", "check").agg(*facts).withColumn("node", F.xxhash64("set_id", "check"))
        sets = materialise(sets.drop("high").unionByName(own), "distinct")
    return sets.select("set_id", "check", "node", "doc_id", "n", "even", "odd", "sketch")


def is_odd(signature: str) -> Column:
    return F.shiftrightunsigned(signature, 31) % 2 == 1


def links(docs: DataFrame, groups: DataFrame, sets: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """(a, b): links between different sets, enough to connect what is connected."""
    large = materialise(groups.where("kind = 'hot'").select(F.col("a").alias("signature"), F.col("b").alias("set_id"), F.col("k").alias("members")).distinct(), "hot")
    crowds = large.groupBy("set_id").agg(F.count_if(~is_odd("signature")).alias("evens"), F.count_if(is_odd("signature")).alias("odds"))
    pairs = sharing(groups, sets, crowds).unionByName(groups.where("kind = 'spoke'").select("a", "b").distinct()).distinct()
    near = plausible(pairs, sets, "set_id")
    own = sets.where("node != set_id").select("set_id", "node")
    if not own.isEmpty():
        same = own.select("set_id", F.col("node").alias("a")).join(own.select("set_id", F.col("node").alias("b")), "set_id").where("a < b").select("a", "b")
        near = near.unionByName(same).distinct()
    near = materialise(near, "near")
    # First one partner for each set; pairs that are connected by then need no look.
    first = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    found = checked(docs, first, sets, bits)
    at = components(found)
    found = materialise(found.unionByName(checked(docs, unconnected(near, at), sets, bits)), "links")
    discard(near)
    if large.isEmpty():
        return found
    rest = materialise(plausible(apart(large, components(found), sets), sets), "apart")
    first = rest.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    found = materialise(found.unionByName(checked(docs, first, sets, bits)), "links")
    return found.unionByName(checked(docs, unconnected(rest, components(found)), sets, bits))


def checked(docs: DataFrame, pairs: DataFrame, sets: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """The linked ones of pairs, in the shared folder."""
    pairs = materialise(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    members = materialise(shingles_of(docs, pairs, sets, bits), "shingles")
    out = materialise(verified(pairs, members), "links")
    discard(members)
    discard(pairs)
    return out


def unconnected(pairs: DataFrame, at: DataFrame) -> DataFrame:
    of = lambda x: at.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    ca, cb = F.coalesce("ca", "a"), F.coalesce("cb", "b")
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(ca != cb).select("a", "b")


def folded(sets: DataFrame) -> DataFrame:
    """sets with their sketches as longs f0, f1 and so on, of SKETCH bits in all."""
    names = [f"f{k}" for k in range(SKETCH // 64)]
    schema = pa.schema([(k, pa.int64()) for k in ("signature", "node", "n", "component", *names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = np.array([np.bitwise_xor.reduce(np.frombuffer(x, np.int64).reshape(-1, len(names)), axis=0) for x in batch.column("sketch").to_pylist()], np.int64).reshape(-1, len(names))
            yield arrow_rows(schema, **{k: batch.column(k) for k in ("signature", "node", "n", "component")}, **{k: f[:, i] for i, k in enumerate(names)})

    return sets.select("signature", "node", "n", "component", "sketch").mapInArrow(run, ", ".join(f"{k} long" for k in schema.names))


def apart(large: DataFrame, at: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of nodes that only signatures of large groups can show, and that are not connected yet.

    Of a band's signatures a set may skip as many as its room says, the dearest; it needs the other large ones, and so does any
    partner for which no cheaper signature is the same. So what needs a signature is joined with what needs it, nothing else.
    """
    # A set's own dear signatures are together in a list: it is no longer than the set.
    own = large.groupBy("set_id").agg(F.collect_list(F.struct("members", "signature")).alias("dear"))

    def needed(parity: int, room: str) -> Column:
        mine = F.array_sort(F.filter("dear", lambda x: F.shiftrightunsigned(x["signature"], 31) % 2 == parity))
        return F.slice(mine, 1, F.greatest(F.size(mine) - F.col(room), F.lit(0)).cast("int"))

    # Cheapest first; a set without a band (room -1) has no more than its neighbourhoods there.
    listed = own.join(sets, "set_id").select("node", "n", "sketch", F.concat(needed(0, "even"), needed(1, "odd")).alias("needs")).where(F.size("needs") > 0)
    needy = listed.join(at.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left").withColumn("component", F.coalesce("component", "node")).drop("own")
    need = needy.select("node", "n", "sketch", "component", F.explode("needs").alias("need")).withColumn("signature", F.col("need.signature"))
    need = materialise(folded(need), "need")
    x, y = (need.select("signature", *[F.col(k).alias(f"{k}_{s}") for k in need.columns if k != "signature"]) for s in ("x", "y"))
    bits = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"f{k}_x").bitwiseXOR(F.col(f"f{k}_y"))) for k in range(SKETCH // 64)])
    fits = (F.col("node_x") < F.col("node_y")) & (F.col("component_x") != F.col("component_y")) & (DENOMINATOR * F.least("n_x", "n_y") >= NUMERATOR * F.greatest("n_x", "n_y")) & (bits * (DENOMINATOR + NUMERATOR) <= (F.col("n_x") + F.col("n_y")) * (DENOMINATOR - NUMERATOR))
    # A pair is looked for in one band only: their own, or the lower of the two, under which the larger set is indexed as well.
    own_band = F.shiftrightunsigned("signature", 31) % 2 == (F.length(F.bin(F.least("n_x", "n_y"))) + 1) % 2
    both = x.join(y.withColumnRenamed("signature", "other"), (F.col("signature") == F.col("other")) & own_band & fits)
    return both.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, hot: int = HOT, bits: int = KEY_BITS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    groups = scanned(docs, hot, bits)
    full = groups.where("kind = 'set' and n > 0 and doc_id is not null")
    sets = distinct_sets(full.select("doc_id", "n", "set_id", "check", "even", "odd", "sketch"))
    rows = materialise(groups.where("kind = 'set'").select("doc_id", "n", "set_id", "check"), "rows")
    at = materialise(components(links(docs, groups, sets, bits)), "components")
    discard(groups)
    # Equal sets and repeated ids connect documents too: ids and sets are the two sides of one graph, its links are few.
    named = sets.select("set_id", "check", "node").join(at, "node", "left").select("set_id", "check", F.coalesce("component", "node").alias("group"))
    by = rows.where("n > 0 and doc_id is not null").select("doc_id", "set_id", "check").distinct().join(named, ["set_id", "check"]).select("doc_id", "group").distinct()
    by = materialise(by, "groups")
    several = by.groupBy("doc_id").agg(F.min("group").alias("a"), F.count("*").alias("k")).where("k > 1")
    if not several.isEmpty():  # ids with several texts connect these texts' groups
        pairs = by.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("group").alias("b"))
        joined = components(pairs)
        by = by.join(joined, by["group"] == joined["node"], "left").select("doc_id", F.coalesce("component", "group").alias("group")).distinct()
    least = by.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    of = by.join(least, "group").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return rows.join(of, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op8_universe_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
