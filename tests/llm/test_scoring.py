import zlib
from collections import Counter

import numpy as np

from stayspark.llm import scoring


def test_probabilities_sum_to_one():
    net = scoring.Network(seed=1)
    around = np.array([[5, 70, scoring.EDGE, 3]])
    p = [np.exp(net.log_prob(around, np.array([t])))[0] for t in range(scoring.WORDS)]
    assert abs(sum(p) - 1) < 1e-4


def test_gradient_against_differences():
    net = scoring.Network(seed=2)
    for p in net.parts:
        p += np.random.default_rng(3).normal(0, 0.3, p.shape).astype(np.float32)
    r = np.random.default_rng(4)
    around, target = r.integers(0, scoring.WORDS, (6, 4)), r.integers(0, scoring.WORDS, 6)
    before = net.flat().astype(np.float64)
    moved = scoring.Network.of(before.copy())
    moved.learn(around, target, 1e-3)
    step = before - moved.flat()
    loss = lambda flat: -scoring.Network.of(flat).log_prob(around, target).astype(np.float64).mean()
    for k in np.argsort(-np.abs(step))[:8]:
        up, down = before.copy(), before.copy()
        up[k], down[k] = up[k] + 3e-2, down[k] - 3e-2
        assert abs((loss(up) - loss(down)) / 6e-2 - step[k] / 1e-3) < 0.05 * abs(step[k] / 1e-3) + 2e-3


def test_learns_and_scores_like_a_plain_loop(spark):
    r = np.random.default_rng(5)
    texts = [" ".join(["one", "two", "three", "four", "five"] * int(r.integers(3, 30))) for _ in range(60)]
    rows = [(k, t, 0.0) for k, t in enumerate(texts)] + [(1, texts[1], 0.0), (100, None, 0.0), (101, " \n", 0.0), (None, "one", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_prob double")
    words = scoring.vocabulary(docs)
    assert set(words) == {b"one", b"two", b"three", b"four", b"five"}
    flat = scoring.train(docs, words)
    got = scoring.score(docs, words, flat).collect()
    assert len(got) == len(rows)
    net = scoring.Network.of(flat)
    for d, t, _ in rows[:5] + rows[-3:]:
        own = [words[w] for w in (t or "").lower().encode().split()]
        padded = [scoring.EDGE] * 2 + own + [scoring.EDGE] * 2
        total = sum(float(net.log_prob(np.array([[padded[k], padded[k + 1], padded[k + 3], padded[k + 4]]]), np.array([own[k]]))[0]) for k in range(len(own)))
        found = next(x for x in got if x["doc_id"] == d)
        assert found["n_words"] == len(own)
        assert abs(found["log_prob"] - total) < 1e-3 * max(1, abs(total))
        assert (found["mean_log_prob"] is None) == (not own)
    start = scoring.score(docs, words, scoring.Network().flat()).agg({"log_prob": "sum"}).first()[0]
    assert sum(x["log_prob"] for x in got) > start
    assert scoring.score(docs.limit(0), words, flat).count() == 0
    assert len(scoring.train(docs.limit(0), {}, 1)) == len(flat)


def test_every_position_is_a_target(spark):
    # Documents of eight words each: a stride over positions would leave some of the words without a step.
    texts = [" ".join(f"w{k}" for k in range(8))] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = scoring.vocabulary(docs)
    own = [words[f"w{k}".encode()] for k in range(8)]
    padded = [scoring.EDGE] * 2 + own + [scoring.EDGE] * 2
    around, target = np.array([[padded[k + j] for j in (0, 1, 3, 4)] for k in range(8)]), np.array(own)
    gain = scoring.Network.of(scoring.train(docs, words)).log_prob(around, target) - scoring.Network().log_prob(around, target)
    assert (gain > 0).all(), gain


def test_words_outside_the_vocabulary_have_their_own_probability(spark, monkeypatch):
    monkeypatch.setattr(scoring, "NEAR", 40)  # shares of some are broadcast, of others joined
    words = {b"the": scoring.OTHER, b"of": scoring.OTHER + 1}
    rows = [(k, " ".join(f"w{j}" for j in range(k % 300 + 1)) + " the of the") for k in range(0, 300, 7)] + [(None, "W3 w250"), (4, None), (5, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flat = scoring.Network(seed=6).flat()
    counts = Counter(w for _, t in rows for w in (t or "").lower().encode().split())
    bucket = lambda w: zlib.crc32(w) % scoring.OTHER
    total = Counter()
    for w, n in counts.items():
        if w not in words:
            total[bucket(w)] += n
    net = scoring.Network.of(flat)
    got = {(r["doc_id"], r["n_words"]): r for r in scoring.score(docs, words, flat).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        own = (t or "").lower().encode().split()
        ids = [words.get(w, bucket(w)) for w in own]
        padded = [scoring.EDGE] * 2 + ids + [scoring.EDGE] * 2
        want = sum(float(net.log_prob(np.array([[padded[k + j] for j in (0, 1, 3, 4)]]), np.array([ids[k]]))[0]) for k in range(len(own)))
        want += sum(np.log(counts[w] / total[bucket(w)]) for w in own if w not in words)
        r = got[d, len(own)]
        assert abs(r["log_prob"] - want) < 1e-3 * max(1, abs(want))
        assert r["mean_log_prob"] is None if not own else abs(r["mean_log_prob"] - want / len(own)) < 1e-2


def test_a_step_is_that_of_a_plain_softmax():
    """One target at a time, both levels written out; padding of classes without or with few targets counts nowhere."""
    r = np.random.default_rng(8)
    around, target = r.integers(0, scoring.WORDS + 1, (40, 4)), np.append(r.integers(0, scoring.WORDS, 25), np.full(15, 7))
    net = scoring.Network(seed=4)
    for p in net.parts:
        p += r.normal(0, 0.2, p.shape).astype(np.float32)
    want = [p.astype(np.float64) for p in net.parts]
    embed, into, into_bias, classes, class_bias, inner, inner_bias = [p.copy() for p in want]
    softmax = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    logs = []
    for a, y in zip(around, target, strict=True):
        c, i = y % scoring.CLASSES, y // scoring.CLASSES
        x = embed[a].ravel()
        h = np.tanh(x @ into + into_bias)
        p, q = softmax(h @ classes + class_bias), softmax(h @ inner[c] + inner_bias[c])
        logs.append(np.log(p[c]) + np.log(q[i]))
        p[c] -= 1
        q[i] -= 1
        back = (classes @ p + inner[c] @ q) * (1 - h * h)
        step = 0.5 / len(target)
        want[3] -= step * np.outer(h, p)
        want[4] -= step * p
        want[5][c] -= step * np.outer(h, q)
        want[6][c] -= step * q
        want[1] -= step * np.outer(x, back)
        want[2] -= step * back
        np.subtract.at(want[0], a, step * (into @ back).reshape(4, -1))
    assert np.abs(net.log_prob(around, target) - logs).max() < 1e-4
    net.learn(around, target, 0.5)
    for p, w in zip(net.parts, want, strict=True):
        assert np.abs(p - w).max() < 1e-5


def test_softmax_goes_along_rows_of_many_positions():
    z = np.random.default_rng(9).normal(0, 30, (2, 32, 5)).astype(np.float32)
    assert np.abs(scoring.shares(z).sum(axis=1) - 1).max() < 1e-5
    assert (scoring.less_top(z).max(axis=1) == 0).all()
