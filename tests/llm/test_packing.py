import random
import zlib
from itertools import chain

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stayspark.llm import packing

TEXTS = [
    "", " ", "\n\t", "don't I'll we've A'S", "ǅ İstanbul ﬁ  ça va x\x1cy é… ÅÉ's", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "ΑΣ ΑΣ. á ́b 日本語 ½ 123 1.5", "xyz., xyz!! (a) x' 'x ''",
    "a b c​d", "Straße STRASSE ßß. naïve,", "\x00 \x85 ﻿", "word" * 500, "word " * 9000,
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return t


def test_ids_are_the_tokenizers_own(tokenizer):
    by = packing.ChunkTokenizer(public_tokenizers.path(packing.VOCABULARY), most=40)
    r = random.Random(3)
    more = ["".join(r.choices("abcÀéß.,!'’ \n1", k=r.randint(0, 30))) for _ in range(300)]
    for batch in ([t] for t in TEXTS + more):
        assert [list(x) for x in by.ids([t.encode() for t in batch])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in batch]
    got = by.ids([t.encode() for t in TEXTS + more])
    assert [list(x) for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS + more]


def naive(sizes, room, most):
    """Best fit with a plain list of open bins."""
    bins, out, new = [], [], 0
    for n in sizes:
        fit = [b for b in bins if b[0] >= n]
        if fit:
            best = min(fit, key=lambda b: b[0])
        else:
            if len(bins) >= most:
                bins.remove(min(bins, key=lambda b: b[0]))
            best = [room, new]
            new += 1
            bins.append(best)
        out.append((best[0], n))
        best[0] -= n
        if not best[0]:
            bins.remove(best)
    return new, out


def test_bins_against_a_plain_list():
    r = random.Random(1)
    for _ in range(60):
        room, most = r.choice([5, 16, 100]), r.choice([1, 2, 8])
        sizes = [r.randint(1, room) for _ in range(80)]
        bins = packing.OpenBins(room, most)
        got = [bins.place(n) for n in sizes]
        new, fits = naive(sizes, room, most)
        assert bins.next == new
        assert [room - at for _, at in got] == [free for free, _ in fits]
        assert bins.open <= most


def test_whole_documents_and_gapless_sequences(spark, tokenizer):
    rows = [(k, t, "x") for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, "a b", "y"), (99, None, "z")]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string, piece string"), room=64).collect()
    want = []
    for k, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(k, p, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for p, s in enumerate(range(0, len(ids), 64))]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert len(by) <= 1.1 * total / 64 + 2
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert len(list(chain.from_iterable(by.values()))) == len(got)


def test_bins_of_long_pieces_stay_open_for_short_ones(spark):
    sizes = [40] * 3000 + [24] * 3000
    rows = [(k, 0, 0, n, k) for k, n in enumerate(sizes)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES), room=64)
    assert got.select("sequence_id").distinct().count() == 3000
