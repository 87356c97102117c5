import random
import re
from itertools import combinations

import numpy as np
import pytest

from stayspark.llm import jaccard
from stayspark.llm.components import components


def brute(rows):
    """Links and components by comparing all."""
    def own(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()

    sets = [(d, own(t)) for d, t in rows]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and a is not None and b is not None and 100 * len(x & y) >= 75 * len(x | y):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def got(spark, rows, **more):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, set_id int")
    return sorted(map(tuple, jaccard.near_duplicates(df, **more).collect()), key=str)


def corpus(seed, copies):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    passage = r.choices(words, k=60)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO"), (5, "x"), (6, "a b c d e"), (6, "other words are in this row of the id"), (None, "one two")]
    for k in range(60):
        base = r.choices(words, k=r.choice([3, 6, 9, 14, 30, 80, 300]))
        if k % 3 == 0:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(r.choice([1, 1, 2, 4])):
            own = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append((len(rows) * 7 % 1009, r.choice([" ", "\n"]).join(own)))
    base = r.choices(words, k=120)
    for _ in range(copies):
        own = list(base)
        for _ in range(r.choice([0, 1, 2, 4])):
            own[r.randrange(len(own))] = r.choice(words)
        rows.append((2000 + len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize(("seed", "copies", "hot"), [(1, 12, 48), (2, 40, 4), (3, 60, 2)])
def test_against_brute_force(spark, seed, copies, hot):
    rows = corpus(seed, copies)
    assert got(spark, rows, hot=hot) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == []


def test_keys_that_collide(spark):
    rows = [*corpus(6, 6), *[(5000 + k, f"one{k} two three four five six") for k in range(30)]]
    assert got(spark, rows, hot=3, bits=4) == brute(rows)


def test_members_beyond_what_a_task_hands_on():
    sig = np.array([7 << 12] * 5 + [9 << 12] * 2, np.uint64)
    assert jaccard.crowded(sig, np.array([5, 3, 4, 1, 2, 8, 9]), 3).tolist() == [True, False, True, False, False, False, False]


def test_every_linked_pair_shares_a_signature():
    r = random.Random(9)
    words = [f"w{k}".encode() for k in range(5000)]
    for n in [5, 6, 7, 9, 10, 12, 20, 35, 60, 127, 128, 250, 600, 1500]:
        for _ in range(6):
            base = r.choices(words, k=n)
            other = list(base)
            for _ in range(r.randint(0, max(1, n // 40))):
                at = r.randrange(len(other))
                other[at : at + r.choice([0, 1])] = r.choices(words, k=r.choice([0, 1, 1]))
            a, b = jaccard.shingle_sets([b" ".join(base), b" ".join(other)])
            if len(a) and len(b) and jaccard.linked(len(set(a.tolist()) & set(b.tolist())), len(a), len(b)):
                of, sig, room, short = jaccard.signatures([a, b])
                assert not len(short)
                for seed in range(4):
                    first = [set(), set()]
                    for k in (0, 1):
                        for parity in (0, 1):
                            own = [x for x in sig[of == k].tolist() if x >> 63 == parity]
                            own.sort(key=lambda x: random.Random(f"{x} {seed}").random())
                            first[k] |= set(own[: max(0, len(own) - int(room[k, parity]))] if room[k, parity] >= 0 else [])
                    assert first[0] & first[1]


def test_components(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(r.randrange(50), r.randrange(50)) for _ in range(30)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    df = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, df.collect())) == sorted((x, find(x)) for x in list(root))
