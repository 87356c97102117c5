"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stayspark.llm import errata

SCHEMA = "doc_id long, text string, n string, word int"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def partners(words):
    """Near words of each; by deletions, then compared."""
    by = {}
    for w in words:
        for i in range(len(w)):
            by.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by.setdefault(w, set()).add(w)
    out = {w: set() for w in words}
    for group in by.values():
        for a in group:
            out[a] |= {b for b in group if near(a, b)}
    return out


def plain(docs):
    count = Counter()
    for d, t, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1 :]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    out, form = {}, {}
    all_near = partners(words)
    for w, n in words.items():
        best = min(all_near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(all_near[w]), words.get(form[w]))
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_a_trie_finds_each_pair_once(seed):
    rng = random.Random(seed)
    m = rng.randint(2, 9)
    letters = "ab" if seed % 2 else "abcdé\U0001f600"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice([m, m + 1]))) for _ in range(rng.randint(2, 250))})
    n = np.array([rng.randint(2, 6) for _ in words])
    cuts = sorted({0, *(rng.randint(0, m + 1) for _ in range(seed % 3)), m + 1})
    total, best = Counter(), {}
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        for row in errata.Trie(words, n, np.zeros(len(words), np.int64), m, lo, hi).result().to_pylist():
            total[row["word"]] += row["near"]
            best[row["word"]] = min(best.get(row["word"], (0, "")), (-row["best_n"], row["best"]))
    count = dict(zip(words, n, strict=True))
    for w in words:
        want = [x for x in words if near(w, x) and min(len(w), len(x)) == m]
        assert total[w] == len(want)
        assert not want or best[w] == min((-count[x], x) for x in want)


def test_hashes_that_coincide_are_compared(monkeypatch):
    monkeypatch.setattr(errata, "_mixed", lambda x: x.astype(np.uint64) & np.uint64(1))
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([5, 6]))) for _ in range(150)})
    rows = errata.Trie(words, np.full(len(words), 2), np.zeros(len(words), np.int64), 5, 0, 6).result().to_pylist()
    got = {r["word"]: r["near"] for r in rows}
    assert got == {w: k for w in words if (k := sum(near(w, x) and min(len(w), len(x)) == 5 for x in words))}


@pytest.mark.parametrize("most", [errata.MOST, 60])
def test_against_all_pairs(spark, most):
    rng = random.Random(7)
    stems = ["container", "contained", "internationalisation", "ÀÉîøüßÿ", "aaaaaaaa", "straßenbahn", "Mississippi"] + ["".join(rng.choice("abcde") for _ in range(rng.randint(7, 9))) for _ in range(40)]
    docs = []
    for i in range(300):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems[: 1 + int(len(stems) * rng.random() ** 2)])
            if rng.random() < 0.25:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "x", "é", w[k] * 2]) + w[k + rng.randint(0, 1) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((rng.choice([None, i, i]), rng.choice([" ", ", ", "1"]).join(words) if i % 17 else None, "n", i))
    docs += docs[:40] + [(900, "x" * 3000 + " " + "x" * 2999, "", 0)] * 2 + [(901, "", None, None)]
    got = found(errata.variants(spark.createDataFrame(docs, SCHEMA), most=most))
    assert got == plain(docs)
    assert any(r[0] for r in got.values()) and any(r[1] != (r[0] or w) for w, r in got.items())


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(11)]
    got = {r.word: r.root for r in errata.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{i}": "w11" for i in range(11)}


def test_hot_beginnings_are_cut_down_to_one_place(spark):
    rng = random.Random(1)
    words = sorted({"commonstart" + "".join(rng.choice("ab") for _ in range(8)) for _ in range(400)})
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    rows = errata.dealt(frame, most=60).collect()
    sizes = Counter((r.g, r.m) for r in rows if r.hi - r.lo > 1)
    assert all(k * m <= 60 for (_, m), k in sizes.items()) and any(r.hi - r.lo == 1 for r in rows)
    got = {r.word: r.n_near for r in errata.near_words(frame, most=60).collect()}
    assert got == {w: k for w, x in partners(words).items() if (k := len(x))}


def test_empty_table(spark):
    assert errata.variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_over_the_given_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(errata.op11_errata_tries(spark, "/root/testdata/sf0.001")) == plain(docs)
