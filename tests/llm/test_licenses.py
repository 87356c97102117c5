import random
from itertools import combinations

from stayspark.llm import licenses


def test_rising_is_longest():
    r = random.Random(1)
    for _ in range(200):
        seconds = r.sample(range(30), r.randint(0, 8))
        got = licenses.rising(list(enumerate(seconds)))
        best = max((n for n in range(len(seconds) + 1) for c in combinations(seconds, n) if list(c) == sorted(c)), default=0)
        assert len(got) == best
        assert [b for _, b in got] == sorted(b for _, b in got)


def test_align_is_a_common_subsequence():
    r = random.Random(2)
    for _ in range(300):
        a, b = r.choices(range(6), k=r.randint(0, 12)), r.choices(range(6), k=r.randint(0, 12))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[k] for i, k in pairs)
        assert all(p < q and r_ < s for (p, r_), (q, s) in zip(pairs, pairs[1:], strict=False))
        assert len(licenses.align(a, a)) == len(a)


def test_every_template_is_found_whole_changed_and_twice():
    r = random.Random(3)
    filler = [f"zq{k}" for k in range(50)]
    for name, text in licenses.TEMPLATES.items():
        own = f"{' '.join(r.choices(filler, k=40))} {text.upper()} {' '.join(r.choices(filler, k=40))}\n{text}"
        found = licenses.scan(own.encode(), tuple(licenses.TEMPLATES.items()), licenses.COVERAGE)
        assert [f[:2] for f in found] == [(name, 1.0)] * 2, (name, found)
        words = text.split()
        for k in range(5, len(words), 9):
            words[k] = "changed"
        if len(words) > 20:
            found = licenses.scan(" ".join(words).encode(), tuple(licenses.TEMPLATES.items()), licenses.COVERAGE)
            assert [f[0] for f in found] == [name]
            assert found[0][1] < 1


def test_spans_and_rows(spark):
    line = licenses.TEMPLATES["CC-BY-NC-4.0-line"]
    rows = [(1, f"é words\n{line}\nmore"), (2, None), (3, ""), (1, f"é words\n{line}\nmore"), (4, "plain text of the rights"), (5, "x " * 30000 + line), (None, "All rights reserved.")]
    df = licenses.findings(spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, license string"))
    got = sorted(((r["doc_id"], r["license"], r["coverage"]) for r in df.collect()), key=str)
    assert got == sorted([(1, "CC-BY-NC-4.0-line", 1.0)] * 2 + [(5, "CC-BY-NC-4.0-line", 1.0), (None, "all-rights-reserved", 1.0)], key=str)
    first = df.where("doc_id = 1").first()
    assert rows[0][1].encode()[first["start"] : first["end"]].decode() == line.rstrip(".")
    assert licenses.findings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefilter_changes_nothing(spark):
    r = random.Random(6)
    words = "the of and to rights reserved all licensed under mit license version 3 gnu public general work this is cc by nc 4 0 released".split()
    rows = [(k, " ".join(r.choices(words, k=r.randint(1, 60)))) for k in range(150)]
    got = sorted(map(tuple, licenses.findings(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted((d, *f) for d, t in rows for f in licenses.scan(t.encode(), tuple(licenses.TEMPLATES.items()), licenses.COVERAGE))


def test_copies_side_by_side_are_all_found():
    every = tuple(licenses.TEMPLATES.items())
    for name, text in every:
        for copies in (2, 3, 7):
            for before, between, after in (("", " ", ""), ("the ", " ", " the"), ("to the ", " and of ", " the license"), ("x ", " zq " * 9, " x")):
                found = licenses.scan((before + between.join([text] * copies) + after).encode(), every, licenses.COVERAGE)
                assert [f[:2] for f in found] == [(name, 1.0)] * copies, (name, copies, before, found)
    line = "Released under the MIT License."
    changed = "Released under the very same MIT License."
    found = licenses.scan(f"the {line} {changed} {line} the".encode(), every, licenses.COVERAGE)
    assert [f[:2] for f in found] == [("MIT-line", 1.0)] * 3


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_long_insertions_leave_a_copy_whole():
    every = tuple(licenses.TEMPLATES.items())
    r = random.Random(8)
    for name in ("MIT", "ISC", "BSD-2-Clause", "Apache-2.0", "GPL-3.0", "LGPL-3.0", "Unlicense"):
        words = licenses.TEMPLATES[name].split()
        for foreign in (12, 30, 60):
            own = [*words[: len(words) // 2], *[f"zq{r.randrange(99)}" for _ in range(foreign)], *words[len(words) // 2 :]]
            found = licenses.scan(" ".join(own).encode(), every, licenses.COVERAGE)
            assert [f[:2] for f in found] == [(name, 1.0)], (name, foreign, found)


def test_coverage_against_a_plain_alignment_of_the_whole_text():
    r = random.Random(9)
    for name, text in licenses.TEMPLATES.items():
        want = licenses.WORD.findall(text.lower().encode())
        if len(want) < 12:
            continue
        for _ in range(6):
            own = list(want)
            for _ in range(r.randint(1, len(own) // 8)):
                at = r.randrange(len(own))
                own[at : at + r.choice([0, 1])] = [b"zq"] * r.choice([0, 1, 8, 20])
            best = longest_common(own, want)
            found = [f for f in licenses.scan(b" ".join(own), ((name, text),), licenses.COVERAGE)]
            if best >= 0.8 * len(want):
                assert len(found) == 1
                assert best - 2 <= found[0][2] <= best
