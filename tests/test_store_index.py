import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from stayspark.plans import index
from stayspark.plans.lakehouse import SUMMARIES
from stayspark.plans.store import TableStore
from tests.test_lakehouse import batch, house, line


def folders(store, name="t"):
    return json.loads(store.files.read(store._pointer(name)))["folders"]


def rows(store, name="t"):
    return sorted(map(tuple, store.read(name).collect()), key=str)


def test_an_upsert_opens_and_rewrites_only_folders_that_may_hold_its_key(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/s")
    store.create("t", "k long, v string")
    frame = lambda low, high, v: spark.range(low, high).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    # Keys of all folders lie in one another's ranges: only the filters tell them apart.
    for i in range(40):
        keys = spark.range(50).coalesce(1).select((F.col("id") * 40 + i).alias("k"), F.lit("old").alias("v"))
        folder, n = store._write("t", keys)
        store._add("t", store._state("t"), folders(store), {folder: {}}, ["k"], n)
    before = folders(store)
    one = frame(1003, 1004, "new")
    touched = store.touched("t", one, ["k"])
    assert before[1003 % 40] in touched
    assert len(touched) <= 6
    assert store.upsert("t", one, ["k"]) == 50 * len(touched)
    assert set(before) - set(folders(store)) == set(touched)
    assert store.read("t").count() == 2000
    assert [r["k"] for r in store.read("t").where("v = 'new'").collect()] == [1003]
    assert store.touched("t", frame(90_000, 99_000, "x"), ["k"]) == []
    assert store.touched("t", frame(5, 6, "x").where("k < 0"), ["k"]) == []
    # Another key than the index's: nothing can be ruled out.
    assert store.touched("t", one, ["v"]) == folders(store)


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_equal_a_whole_rewrite(spark, tmp_path, seed):
    rand, store, want = random.Random(seed), TableStore(spark, f"{tmp_path}/s"), {}
    store.create("t", "a string, d double, n int")
    for step in range(5):
        some = {(rand.choice(["", "x", "é" * 70, "é" * 70 + "b", "z"]), rand.choice([0.0, -0.0, 1.5, -3.0, float("inf")])): step for _ in range(6)}
        new = spark.createDataFrame([(a, d, n) for (a, d), n in some.items()], "a string, d double, n int").coalesce(1)
        if rand.random() < 0.6:
            store.upsert("t", new, ["a", "d"])
            want |= some
        else:
            store.insert_only("t", new, ["a", "d"])
            want = {**some, **want}
        if step == 2:
            assert store.rename_column("t", "n", "m")
            assert store.add_columns("t", [StructField("n", LongType())]) == ["n"]
            new = new.withColumnRenamed("n", "m")
            store.rename_column("t", "n", "unused")
            store.rename_column("t", "m", "n")
            assert not store.rename_column("t", "m", "q")
    got = {(r["a"], r["d"]): r["n"] for r in store.read("t").collect()}
    assert got == want


def test_null_keys_match_nothing_and_small_folders_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("stayspark.plans.store.MANY", 8)
    store = TableStore(spark, f"{tmp_path}/s")
    store.create("t", "k timestamp, v int")
    df = lambda *r: spark.createDataFrame(list(r), "k timestamp, v int").coalesce(1)
    at = lambda m: datetime(2026, 1, 1, 0, m)
    store.insert_only("t", df((None, 1)), ["k"])
    store.upsert("t", df((None, 2)), ["k"])
    assert store.read("t").where("k is null").count() == 2
    for m in range(10):
        store.upsert("t", df((at(m), m)), ["k"])
    assert len(folders(store)) < 10
    assert store.read("t").count() == 12
    assert store.vacuum("t") > 0
    assert store.read("t").count() == 12


def test_a_rename_keeps_scopes_indices_and_files(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/s")
    store.create("t", "k long, b string")
    df = spark.createDataFrame([(1, "x"), (2, "x")], "k long, b string")
    store.insert_only("t", df, ["k"], scope={"b": "x"})
    was = folders(store)
    assert store.rename_column("t", "k", "key")
    assert store.rename_column("t", "b", "batch")
    assert folders(store) == was
    assert store.scopes("t") == {was[0]: {"batch": "x"}}
    assert rows(store) == [(1, "x"), (2, "x")]
    new = spark.createDataFrame([(2, "y"), (3, "y")], "key long, batch string")
    assert store.touched("t", new, ["key"]) == was
    assert store.touched("t", new.where("key = 3"), ["key"]) == []
    assert store.insert_only("t", new, ["key"]) == 1
    # A new column of an old name doesn't bring old values back.
    store.add_columns("t", [StructField("k", LongType())])
    assert rows(store) == [(1, "x", None), (2, "x", None), (3, "y", None)]


def test_ranges_of_keys(spark):
    df = spark.createDataFrame([(1, "b" * 80, date(2026, 1, 1), 1.0), (5, "a", None, 2.0)], "i int, s string, d date, f double")
    assert index._ranges(df, ["i", "s", "d", "f"]) == {"i": [1, 5], "s": ["a", "b" * 64], "d": [20454, 20454]}
    assert not index._meet({"i": [1, 5]}, {"i": [6, 7]})
    assert not index._meet({"i": []}, {"i": [6, 7]})
    assert index._meet({"i": [1, 6]}, {"i": [6, 7], "x": []})


def test_gold_equals_a_rebuild_and_reads_changed_dates_only(spark, tmp_path):
    lake = house(spark, tmp_path)
    stay = lambda h, d, p: line(hotel_name=h, hotel_url=f"https://x.test/{h}", check_in=f"2026-07-{d:02}", check_out=f"2026-07-{d + 1:02}", price_value=str(p))

    def same():
        for name, summary in SUMMARIES.items():
            whole = summary(lake.store.read("history"))
            assert sorted(map(str, lake.store.read(name).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))

    lake.run(batch(tmp_path / "a", {"a.jsonl": [stay("A", 1, 100), stay("B", 2, 200), stay("C", 2, 300)]}, name="a"))
    same()
    old = {f for f in folders(lake.store, "gold_entity_daily") if "2026-07-01" in f}
    path = batch(tmp_path / "b", {"a.jsonl": [stay("A", 2, 150), stay("D", 3, 50)]}, name="b")
    lake.bronze(path)
    lake.silver(path)
    assert lake.changed_dates("gold_entity_daily") == {"2026-07-02", "2026-07-03"}
    read = lake.history_of({"2026-07-02", "2026-07-03"}).inputFiles()
    assert read
    assert not [f for f in read if "2026-07-01" in f]
    # Gold of this batch is left out; the next one takes its dates in.
    lake.run(batch(tmp_path / "c", {"a.jsonl": [stay("E", 4, 70)]}, name="c"))
    same()
    assert old <= set(folders(lake.store, "gold_entity_daily"))
    assert lake.changed_dates("gold_entity_daily") == set()
    # A folder of several dates: everything is made anew.
    row = lake.store.read("history").limit(1).withColumns({"record_id": F.lit("z"), "hotel_url": F.lit("https://x.test/z")})
    lake.store.insert_only("history", row, ["record_id"])
    assert lake.changed_dates("gold_entity_daily") is None
    lake.gold(path)
    same()


def test_all_rows_of_another_batch_stay(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/s")
    store.create("t", "k long, d date, b string")
    df = spark.createDataFrame([(1, date(2026, 1, 1), "x"), (2, date(2026, 1, 2), "x"), (3, None, "x")], "k long, d date, b string")
    assert store.insert_only("t", df, ["k"], scope={"b": "x"}, by="d") == 3
    assert store.insert_only("t", df, ["k"], scope={"b": "x"}, by="d") == 0
    assert sorted(s.get("d", "") for s in store.scopes("t").values()) == ["", "2026-01-01", "2026-01-02"]
    assert store.read("t", {"b": "y"}).count() == 0
    assert sorted(r["k"] for r in store.read("t", {"d": "2026-01-02"}).collect()) == [2, 3]


def test_rows_are_shuffled_whole_only_if_a_key_comes_twice(spark, tmp_path, monkeypatch):
    plans, write = [], TableStore._write
    monkeypatch.setattr(TableStore, "_write", lambda self, name, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(self, name, df))
    s = TableStore(spark, str(tmp_path))
    s.create("t", "k double, b string, v long")
    assert s.insert_only("t", spark.range(100).selectExpr("CAST(id AS DOUBLE) AS k", "'x' AS b", "id AS v"), ["k", "b"]) == 100
    assert "Exchange" not in plans[0]
    again = spark.createDataFrame([(0.0, "y", 1), (-0.0, "y", 2), (5.0, "x", 3), (None, "y", 4), (None, "y", 5), (7.5, "y", 6)], "k double, b string, v long")
    assert s.insert_only("t", again, ["k", "b"]) == 3 and s.read("t").count() == 103
