"""Suffix-array dedup against a plain pass over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stayspark.llm import suffixes

SCHEMA = "doc_id long, text string, o string, h int, key int"


def plain(docs):
    """docs: (doc_id, text). Rows of one id come in the order of a hash that Spark makes, so tests give them no common windows,
    or equal texts."""
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                cover[p] += 1
                cover[p + 100] -= 1
            seen.add(w)
        gone = np.cumsum(cover)[: len(b)] > 0
        edges = np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        kept = bytes(x for x, g in zip(b, gone.tolist(), strict=True) if not g)
        out.append((d, len(b), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(seed, size):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([60, 140, 500]))) for _ in range(8)] + ["a" * 700, "ab" * 300]
    docs = []
    for i in range(size):
        t = ""
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(base)[rng.randint(0, 40) :]
            if rng.random() < 0.4:
                k = rng.randrange(len(x))
                x = x[:k] + rng.choice("XYZ") + x[k + 1 :]
            t += x
        docs.append((i, t))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("seed", "most"), [(1, suffixes.MOST), (2, 3)])
def test_against_every_window(spark, seed, most):
    docs = corpus(seed, 120)
    hot = "the hot line that everybody has, once and again: " * 3
    docs += [(1000 + i, f"{i} {i * 7} " * (i % 5) + hot + f" {i} end {i}" * 9) for i in range(60)]
    docs += [(2000, None), (2001, ""), (2002, "short"), (2003, hot), (2003, hot), (2003, hot), (-5, "short"), (2002, "short"), (None, hot), (None, "x" * 99)]
    frame = spark.createDataFrame([(d, t, "c", 1, None) for d, t in docs], SCHEMA)
    assert found(suffixes.deduplicated(frame, most=most)) == plain(docs)


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh") for _ in range(700_000))
    docs = [(1, long), (2, long[300_000:300_150] + "-" + long[:250] + "+" + long[650_000:])]
    got = found(suffixes.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == plain(docs)
    assert sum(n for (_, _, n, _, _) in got) == 150 + 250 + 50_000


def test_colliding_hashes_are_found_and_sorted_again(monkeypatch):
    class Weak(suffixes.Powers):
        def __init__(self, seed):
            super().__init__(seed)
            if seed < 4:
                self.byte = np.ones(256, np.uint64)  # all strings of one length are one

    monkeypatch.setattr(suffixes, "Powers", Weak)
    monkeypatch.setattr(suffixes, "_powers", {})
    rng = random.Random(2)
    core = bytes(rng.choice(b"abc") for _ in range(32))
    contexts = [bytes(rng.choice(b"ab") for _ in range(68)) + core + bytes(rng.choice(b"ab") for _ in range(68)) for _ in range(20)]
    contexts.append(contexts[3][:50] + b"Z" + contexts[3][51:])
    before, group = np.full(21, 68), np.zeros(21, int)
    with pytest.raises(suffixes.Collision):
        suffixes.SuffixSort(contexts, before, group, 2)
    at, least, most = suffixes.repeated(contexts, before, group)
    assert at.tolist() == [20] and (68 - most).tolist() == [51] and least.tolist() == [0]


def test_suffixes_are_sorted():
    rng = random.Random(9)
    contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 68))) for _ in range(300)]
    before = np.array([len(c) // 3 for c in contexts])
    group = np.sort(np.array([rng.randint(0, 9) for _ in contexts]))
    order = suffixes.SuffixSort(contexts, before, group).order.tolist()
    assert order == sorted(range(300), key=lambda i: (group[i], contexts[i][before[i] :], i))


def test_empty_table(spark):
    assert suffixes.deduplicated(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_over_the_given_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(suffixes.op12_suffix_dedup(spark, "/root/testdata/sf0.001")) == plain(docs)
