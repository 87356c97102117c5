import random
import zlib
from collections import Counter

import pytest

from stayspark.llm import sharding


def check(rows, got, shards=8, tolerance=sharding.TOLERANCE):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} <= {"bytes"}
    sums, slots = Counter(), {}
    for r in got:
        sums[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, most = sum(sums.values()), max((r["size"] for r in got), default=0)
    assert all(abs(sums[k] - total / shards) <= max(tolerance * total / shards, most) + 1 for k in range(shards))
    return sums


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_are_near_equal_and_copies_stay_together(spark, seed):
    r = random.Random(seed)
    rows = [(k, "x" * r.choice([0, 3, 50, 400]) + str(k // 3)) for k in range(1500)] + [(5000, None), (5001, ""), (5001, ""), (None, "é" * 9)]
    got = sharding.shard(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, size int"), rows_a_range=40).collect()
    check(rows, got)
    by = {}
    for x in got:
        by.setdefault((x["size"], x["text_crc32"]), set()).add(x["shard"])
    assert all(len(s) == 1 for s in by.values())


def test_hot_groups_are_cut(spark):
    rows = [(k, "copy " * 20) for k in range(900)] + [(k, f"other {k} " * 3) for k in range(900, 1500)] + [(7, "same row")] * 400
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), rows_a_range=20).collect()
    check(rows, got)


def test_small_and_empty(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = sharding.shard(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()
    assert [(x["size"], x["slot"]) for x in got] == [(2, 0)]
