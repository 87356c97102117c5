"""The filter audit against a plain count over all orders."""

import random
import re
from collections import Counter
from itertools import permutations

from stayspark.llm.audit import audit, op13_filter_interactions

SCHEMA = "doc_id long, text string, lang string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    least = {}
    for d, t, *_ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, t, p, *_ in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ["A"] * (len(words) < 100) + ["B"] * (100 * len(set(words)) < 80 * len(words)) + ["C"] * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
        fails += ["D"] * bool(re.search(r"[#$%&*|]", t)) + ["E"] * (d is not None and least[t] < d)
        rows.append((p or "", set(fails), d in good, d in toxic))
    out, shapley = {}, Counter()
    for p in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            for step in range(1, 6):
                f, before = order[step - 1], set(order[: step - 1])
                c = Counter()
                for part, fails, g, x in rows:
                    if part == p:
                        gone, hit = bool(fails & before), f in fails
                        c["kept"] += not gone and not hit
                        c["removed"] += hit and not gone
                        c["redundant"] += hit and gone
                        c["unique"] += fails == {f}
                        c["good"] += hit and not gone and g
                        c["toxic"] += hit and not gone and x
                shapley[p, f] += c["removed"]
                out[p, order, step] = tuple(c[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic"))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(spark, docs, labels, schema=SCHEMA):
    rows = audit(spark.createDataFrame(docs, schema), spark.createDataFrame(labels, LABELS)).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_against_plain_counts_with_copies_over_many_partitions(spark):
    rng = random.Random(5)
    long = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", "Copy of ALL", "a b c", long, long + " $", long.upper(), "x " * 150, long + " É", "tab\x0bsplit\x1dhere"]
    docs = [(i, "the hot text", "en", 7, "n") for i in range(400)]
    docs += [(rng.choice([None, *range(300, 500)]), rng.choice(texts), rng.choice(["en", "fr", None]), None, None) for _ in range(300)]
    docs += docs[350:420]  # repeated rows
    rng.shuffle(docs)
    labels = [(rng.choice([None, *range(500)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert found(spark, docs, labels) == plain(docs, labels)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_very_long_text_and_its_copy(spark):
    long = "word " * 400_000
    docs = [(1, long, "en", 1, ""), (2, long, "en", 1, ""), (2, long + "x", "en", 1, "")]
    got = found(spark, docs, [])
    assert got == plain(docs, []) and got["en", "EDCBA", 1][1] == 1


def test_empty_tables(spark):
    assert found(spark, [], []) == {}
    assert found(spark, [(None, None, None, None, None)], [])["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_query_over_the_given_tables(spark):
    rows = op13_filter_interactions(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 600 * len({r.part for r in rows})
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    expected = plain(docs, labels)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows} == expected
