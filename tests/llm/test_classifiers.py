import random
import tracemalloc
import zlib
from itertools import combinations

import numpy as np
import pytest

from stayspark.llm import quality, toxicity
from stayspark.llm.common import ChunkValues, labelled


def kernel(a, b):
    """The gap-weighted kernel by listing all subsequences."""
    def phi(w):
        out = {}
        for at in combinations(range(len(w)), 3):
            if all(toxicity.letter(w[i]) for i in at):
                k = tuple(toxicity.letter(w[i]) for i in at)
                out[k] = out.get(k, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    x, y = phi(a), phi(b)
    return sum(v * y.get(k, 0) for k, v in x.items())


def test_kernel_against_listing():
    words = ["idiot", "i-d-iot", "i d i o t", "idxiot", "thth", "aaaa", "abc", "ab", "éclair", "x9y8z"]
    column, n = np.arange(toxicity.LETTERS**3), toxicity.LETTERS**3
    rows = toxicity.dense(words, column, n)
    got = rows @ rows.T
    for i, a in enumerate(words):
        for k, b in enumerate(words):
            norm = (kernel(a, a) * kernel(b, b)) ** 0.5
            assert got[i, k] == pytest.approx(kernel(a, b) / norm if norm else 0, abs=1e-6)


def test_folded_margins_are_those_of_the_nystrom_map():
    landmarks = ["idiot", "moron", "there", "river", "blockhead", "another"]
    words = ["id-iot", "idxiot", "moronic", "rivers", "the", "blockheads", "zzz"]
    ids, column, fold = toxicity.nystrom(landmarks)
    norm = lambda a, b: kernel(a, b) / ((kernel(a, a) * kernel(b, b)) ** 0.5 or 1)
    w_matrix = np.array([[norm(a, b) for b in landmarks] for a in landmarks])
    values, vectors = np.linalg.eigh(w_matrix)
    root = vectors @ np.diag(values**-0.5) @ vectors.T
    plain = np.array([root @ [norm(w, b) for b in landmarks] for w in words])
    got = toxicity.dense(words, column, len(ids)) @ fold.T
    assert got == pytest.approx(plain, abs=1e-6)
    y = np.array([1, 1, 1, -1, -1, 1, -1.0])
    w, b = toxicity.machine(plain, y, np.ones(len(y)))
    weight = np.zeros(toxicity.LETTERS**3)
    weight[ids] = w @ fold
    assert toxicity.Model(weight, b, 1.0, 0.0).margins(words) == pytest.approx(plain @ w + b, abs=1e-6)


def test_machine_against_plain_descent():
    r = np.random.default_rng(3)
    x, cost = r.normal(size=(60, 4)), r.uniform(0.5, 2, 60)
    x /= np.linalg.norm(x, axis=1)[:, None]  # Nyström vectors have norm 1 at most
    y = np.where(x @ [1, -2, 0.5, 0] + 0.3 * r.normal(size=60) > 0.2, 1.0, -1.0)

    def loss(w, b):
        return float(cost / cost.sum() @ np.maximum(0, 1 - y * (x @ w + b)) ** 2 + 0.5e-4 * w @ w)

    w, b = np.zeros(4), 0.0
    for _ in range(20000):
        g = np.array([(loss(w + d, b) - loss(w - d, b)) / 2e-6 for d in np.eye(4) * 1e-6] + [(loss(w, b + 1e-6) - loss(w, b - 1e-6)) / 2e-6])
        w, b = w - 0.2 * g[:4], b - 0.2 * g[4]
        if np.abs(g).max() < 1e-5:
            break
    assert loss(*toxicity.machine(x, y, cost)) <= loss(w, b) * 1.02 + 1e-6


def test_descent_against_differences_of_the_loss():
    r = np.random.default_rng(4)
    vectors, layer, bias = r.normal(size=(6, 3)), r.normal(size=(3, 2)), r.normal(size=2)
    at, part = np.array([1, 3, 4]), np.array([0.5, 0.2, 0.3])

    def loss(v, m, c):
        z = part @ v[at] @ m + c
        return float(np.log(np.exp(z).sum()) - z[1])

    def slopes(k):
        whole = [vectors, layer, bias]
        out = np.zeros_like(whole[k])
        for i in np.ndindex(out.shape):
            up, down = [x.copy() for x in whole], [x.copy() for x in whole]
            up[k][i] += 1e-5
            down[k][i] -= 1e-5
            out[i] = (loss(*up) - loss(*down)) / 2e-5
        return out

    want = [vectors - 0.1 * 3**0.5 * slopes(0), layer - 0.1 * slopes(1), bias - 0.01 * slopes(2)]
    quality.descend(vectors, layer, bias, at, part, 1, 0.1)
    for x, y in zip((vectors, layer, bias), want, strict=True):
        assert x == pytest.approx(y, abs=1e-7)


def toy(seed=4, n=400):
    r = random.Random(seed)
    words = ["".join(r.choices(["th", "er", "on", "an", "re", "in", "ou"], k=r.randint(1, 4))) for _ in range(300)]
    rows = []
    for _ in range(n):
        text = r.choices(words, k=r.randint(5, 60))
        toxic = r.random() < 0.3
        if toxic:
            for _ in range(r.randint(1, 3)):
                text.insert(r.randrange(len(text)), r.choice(["dumbhead", "blockhead", "clodpate"]))
        rows.append((" ".join(text).encode(), int(toxic)))
    return rows


def test_toxic_words_and_their_variants():
    rows = toy()
    model = toxicity.fit(rows[:300])
    score = model.score([t for t, _ in rows[300:]])
    assert ((score >= 0.5) == np.array([y == 1 for _, y in rows[300:]])).mean() > 0.97
    base = b"there on the inner river another "
    for variant in (b"dumbhead", b"DUMBHEAD!", b"d-u-m-b-h-e-a-d", b"d u m b h e a d", b"dumbxhead", b"block_head", b"clodpates"):
        assert model.score([base + variant + b" river"])[0] >= 0.5, variant
    assert (model.score([base, b"", b"...", base * 500]) < 0.5).all()


def test_long_words_are_windowed():
    model = toxicity.fit(toy())
    assert model.score([b"x" * 100 + b"dumbhead" + b"y" * 100])[0] > model.score([b"x" * 100 + b"y" * 100])[0]


@pytest.mark.parametrize("rows", [[(b"idiot fool", 1), (b"", 0)], [(b"ab", 1), (b"cd", 0)], [(b"", 1), (b"good words", 0)]])
def test_a_label_without_words(rows):
    assert toxicity.fit(rows).score([b"idiot", b"", b"good words"]).tolist() == pytest.approx([0.5] * 3)


def test_one_label_only():
    for fit in (toxicity.fit, quality.fit):
        for rows in ([], [(b"a b", 1)], [(b"a b", 0)]):
            s = fit(rows).score([b"a", b""])
            assert len(set(s.tolist())) == 1
            assert 0 <= s[0] <= 1


def test_quality_learns_and_matches_the_plain_form():
    r = random.Random(5)
    rows = []
    for _ in range(300):
        words = r.choices(["river", "stone", "light", "from", "the", "and"], k=30)
        bad = r.random() < 0.4
        rows.append((" ".join(f"{w}{r.choice(['###', '%%%'])}" if bad and r.random() < 0.7 else w for w in words).encode(), int(not bad)))
    model = quality.fit(rows[:200])
    score = model.score([t for t, _ in rows[200:]])
    assert ((score >= 0.3) == np.array([y == 1 for _, y in rows[200:]])).mean() > 0.97
    for text in (rows[0][0], b"a a a b", b"", b"x" * 50000):
        at, part = quality.document_features(text)
        plain = model.bias + float((model.weight[at] * part).sum())
        assert model.score([text])[0] == pytest.approx(1 / (1 + np.exp(-np.clip(plain, -30, 30))), abs=1e-4)


@pytest.mark.parametrize("op", [toxicity, quality])
def test_rows_and_held_out(spark, op):
    texts = toy(6, 80)
    rows = [(k, t.decode(), "en") for k, (t, _) in enumerate(texts)] + [(1, texts[1][0].decode(), "de"), (900, None, None), (901, "", ""), (None, "x y", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, y, y) for k, (_, y) in enumerate(texts)] + [(None, 1, 1), (3, None, None)], "doc_id long, toxic int, quality int")
    got = op.classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= op.THRESHOLD) for r in got)
    other = docs.withColumn("lang", docs["text"])
    assert sorted(map(str, got)) == sorted(map(str, op.classify(other, labels).collect()))
    taught = labelled(docs, labels, "toxic", 1000)
    assert len(taught) == sum(1 for d, t, _ in rows if d is not None and d < 80 and t is not None and zlib.crc32(str(d).encode()) % 5)
    assert op.classify(docs.limit(0), labels).count() == 0


def test_cache_forgets_without_changing_results():
    c = ChunkValues(lambda x: np.array([len(k) for k in x], float)[:, None], 1, most=5)
    r = random.Random(7)
    for _ in range(50):
        keys = [b"x" * r.randint(0, 40) for _ in range(r.randint(0, 12))]
        assert c.lookup(keys)[:, 0].tolist() == [len(k) for k in keys]


def test_fitting_toxicity_holds_blocks_of_its_wide_rows():
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(6, 14))) for _ in range(30)) for _ in range(200)]
    rows = [(f"{t} idiot{'s' * (k % 3)}".encode() if k % 8 == 0 else t.encode(), int(k % 8 == 0)) for k, t in enumerate(texts)]
    toxicity.fit(rows[:20])
    tracemalloc.start()
    model = toxicity.fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 110e6
    assert (model.score([t for t, _ in rows]) > 0.5).tolist() == [y == 1 for _, y in rows]
    words = [w for t in texts[:30] for w in t.split()]
    _, column, fold = toxicity.nystrom(words[:40])
    assert toxicity.nystrom_rows(words, column, fold) == pytest.approx(toxicity.dense(words, column, fold.shape[1]) @ fold.T, abs=1e-9)
