"""Records merged over rounds as a stream, against the batch merge."""

import random

import pytest
from pyspark.sql import functions as F

from stayspark.operators import identity
from stayspark.plans.store import TableStore
from stayspark.streaming import rounds

SCHEMA = "k string, property_id string, name string, price string, rating string, at long, ts timestamp"
FIELDS = ["property_id", "name", "price", "rating"]


def records(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        p, name, url = rng.choice([None, "", "p1", "p2", "p3"]), rng.choice([None, "Sea", "sea ", "Hill", "Bay"]), rng.choice([None, None, "a", "b", "c", "d"])
        k = f"url:{url}" if url else f"property:{p}" if p else f"partial:{name.strip().lower()}" if name else f"partial:0:{i % 3}:"
        out.append((k, p, name, rng.choice([None, "", "10", "20"]), rng.choice([None, "8.5"]), i, None))
    return out


def state(df):
    return {r.identity: tuple(r[f] for f in FIELDS) + (r.merged_records, r.changed) for r in df.collect()}


@pytest.mark.parametrize("cuts", [[], [1, 2, 7], [15, 16, 30]])
def test_any_split_gives_the_rows_of_the_batch_merge(spark, tmp_path, cuts):
    rows = records(len(cuts) + 3, 40)
    random.Random(1).shuffle(rows)  # the order of arrival is not the order of rows
    folder, store, schema = str(tmp_path / "rounds"), TableStore(spark, str(tmp_path / "store")), spark.createDataFrame([], SCHEMA).schema
    edges = [0, *cuts, len(rows)]
    parts = [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    half = max(1, len(parts) // 2)
    for some in (parts[:half], parts[half:]):  # the query ends after the first half and goes on from its checkpoint
        for part in some:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        log = rounds.merged_rounds(rounds.read_rounds(spark, folder, schema), "k", "property_id", "name", FIELDS, "at")
        rounds.into_table(log, store, "merged", str(tmp_path / "checkpoint")).awaitTermination()
    expected = identity.merged_identities(spark.createDataFrame(rows, SCHEMA), "k", "property_id", "name", FIELDS, "at")
    assert state(store.read("merged").where("live")) == state(expected)


def test_idle_state_is_dropped_by_the_watermark(spark, tmp_path):
    folder, store, schema = str(tmp_path / "rounds"), TableStore(spark, str(tmp_path / "store")), spark.createDataFrame([], SCHEMA).schema
    hour = [("property:p1", "p1", "Sea", "10", None, 1, 0), ("url:z", None, "Far", None, "9", 2, 40), ("url:z", None, "Far", None, "9", 3, 80), ("property:p1", "p1", "Sea", None, "7", 4, 81)]
    for *r, h in hour:
        spark.createDataFrame([(*r, None)], SCHEMA).withColumn("ts", F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.lit(h))).coalesce(1).write.mode("append").parquet(folder)
        log = rounds.merged_rounds(rounds.read_rounds(spark, folder, schema), "k", "property_id", "name", FIELDS, "at", at="ts", keep="10 hours")
        rounds.into_table(log, store, "merged", str(tmp_path / "checkpoint")).awaitTermination()
    got = state(store.read("merged"))
    assert got["property:p1"][2:5] == (None, "7", 1)  # the price of 81 hours before is gone
    assert got["url:z"][4] == 2  # the watermark stood at 39 hours when its second row came
    with pytest.raises(ValueError, match="event time"):
        rounds.merged_rounds(rounds.read_rounds(spark, folder, schema), "k", "property_id", "name", FIELDS, "at", keep="1 hour")


def test_rows_of_a_record_are_summed_up_before_the_state():
    """Many rows of few records leave the reading task as one each, with what their merge gives."""
    import pyarrow as pa

    rng, fields = random.Random(5), [f"f{i}" for i in range(2)]
    rows = [{"k": rng.choice(["a", "b"]), "p": rng.choice([None, "1"]), "n": None, "at": i, "fields": {f: rng.choice([None, None, str(i)]) for f in fields}, "seen": None} for i in range(50)]
    rng.shuffle(rows)
    schema = pa.schema([("k", pa.string()), ("p", pa.string()), ("n", pa.string()), ("at", pa.int64()), ("fields", pa.struct([(f, pa.string()) for f in fields])), ("seen", pa.timestamp("us", "UTC"))])
    batches = pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=7)
    out = [x for b in rounds.summed(iter(batches)) for x in b.to_pylist()]
    assert len(out) == 4
    for x in out:
        own = sorted((r for r in rows if (r["k"], r["p"]) == (x["k"], x["p"])), key=lambda r: r["at"])
        first = [next((r for r in own if r["fields"][f] is not None), None) for f in fields]
        assert (x["rows"], x["at"]) == (len(own), own[0]["at"]) and x["present"] == [own[0]["fields"][f] is not None for f in fields]
        assert x["ats"] == [r and r["at"] for r in first] and x["fields"] == [r and r["fields"][f] for r, f in zip(first, fields, strict=True)]
