"""Records merged over rounds as a stream: the rows of `identity.merged_identities`, whatever micro-batches they come in.

The rows of a micro-batch are first summed up in the tasks that read them: one row for each record (its key, property and name) and event
time, so that the state sees no more than that, however often a record comes. Three stateful operators follow, each keyed by
what it decides about:

1. a lookup value (a property or a name): the least URL key that has it, and the records without URL that wait for it. A new least
   URL is told to all of them, a new record is told the URL that is there.
2. a record (its key, property and name): its rows so far as first values by field, and the identity that follows from what it
   was told. A record that gets another identity leaves the old one.
3. an identity: what its records have brought. Adding is a merge into the sum; where one leaves, the sum is made anew.

The result is a change log, one row for each identity and micro-batch that touches it; `live` is false where all records have
left. `into_table` keeps the last row of each identity. State is in the session's state store, so a query that is stopped goes on from
its checkpoint. With `keep`, state that has seen no row for so long, by the watermark, is dropped, and rows that come behind the
watermark are dropped by Spark; what comes later for such a key begins anew.

Rows of one key are ordered by `order`, a number or a time without ties.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType, TimestampType

from stayspark.functions.text import none_if_empty
from stayspark.plans.store import TableStore
from stayspark.session import ship

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SUMMED = "k string, p string, n string, seen timestamp, rows long, at long, present array<boolean>, ats array<long>, fields array<string>"
_TOLD = "k string, p string, n string, side string, url string, seen timestamp"
_MOVED = StructType([StructField("identity", StringType()), StructField("part", StringType()), StructField("body", StringType()), StructField("seen", TimestampType())])


def merged(a: dict[str, Any] | None, b: dict[str, Any]) -> dict[str, Any]:
    """Sum of two records: counts, the first row's values and the first present value of each field, by order."""
    if a is None:
        return b
    first = min(a, b, key=lambda x: x["at"])
    pick = [min((v for v in (x, y) if v), default=None, key=lambda v: v[0]) for x, y in zip(a["values"], b["values"], strict=True)]
    return {"rows": a["rows"] + b["rows"], "at": first["at"], "first": first["first"], "values": pick}


def body_of(kind: int, r: Row) -> dict[str, Any]:
    """The body of a row that stands for several (see `summed`)."""
    return {"rows": r.rows, "at": [kind, r.at], "first": list(r.present), "values": [None if v is None else [[kind, a], v] for a, v in zip(r.ats, r.fields, strict=True)]}


AT_ONCE, AT_ONCE_BYTES = 200_000, 32 << 20  # rows, and their bytes, that a task sums up at once
_SAME = ["k", "p", "n", "seen"]


def _sum(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row for each record and event time: count, first row by `at` and first present value of each field with its place."""
    rows = pa.Table.from_batches(batches).sort_by("at")
    columns, how = {c: rows[c] for c in (*_SAME, "at")}, [("at", "count", pc.CountOptions(mode="all")), ("at", "first", pc.ScalarAggregateOptions(skip_nulls=False))]
    size = batches[0]["fields"].type.num_fields
    fields = [f"f{i}" for i in range(size)]
    for i, f in enumerate(fields):
        columns[f] = pc.struct_field(rows["fields"], [i])
        columns[f"has_{f}"] = pc.is_valid(columns[f])
        columns[f"at_{f}"] = pc.if_else(columns[f"has_{f}"], rows["at"], pa.scalar(None, pa.int64()))
        how += [(f"has_{f}", "first", pc.ScalarAggregateOptions(skip_nulls=False)), *[(c, "first", pc.ScalarAggregateOptions(skip_nulls=True)) for c in (f, f"at_{f}")]]
    out = pa.table(columns).group_by(_SAME, use_threads=False).aggregate(how).combine_chunks()
    listed = lambda names, kind: pa.FixedSizeListArray.from_arrays(_interleaved([out[n] for n in names], kind), size).cast(pa.list_(kind))
    made = [out["k"], out["p"], out["n"], out["seen"], out["at_count"], out["at_first"], listed([f"has_{f}_first" for f in fields], pa.bool_()), listed([f"at_{f}_first" for f in fields], pa.int64()), listed([f"{f}_first" for f in fields], pa.string())]
    plain = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in made]
    return pa.RecordBatch.from_arrays(plain, names=[*_SAME, "rows", "at", "present", "ats", "fields"])


def _interleaved(columns: list[pa.ChunkedArray], kind: pa.DataType) -> pa.Array:
    """The columns' values row by row."""
    n, m = len(columns[0]), len(columns)
    chained = pa.concat_arrays([c.combine_chunks().cast(kind) for c in columns])
    return chained.take(pa.array((np.arange(n)[:, None] + np.arange(m)[None, :] * n).ravel()))


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= AT_ONCE or sum(x.nbytes for x in held) >= AT_ONCE_BYTES:
            yield _sum(held)
            held = []
    if held:
        yield _sum(held)


class _Kept(StatefulProcessor):
    """A JSON value for each key; with `keep` milliseconds it is dropped when the watermark has passed its last row by so much."""

    def __init__(self, keep: int | None) -> None:
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", "body string")

    def _read(self) -> dict[str, Any]:
        return json.loads(self.value.get()[0]) if self.value.exists() else {}

    def _write(self, x: dict[str, Any]) -> None:
        self.value.update((json.dumps(x),))

    def _touch(self, seen: Any) -> None:
        if self.keep is not None and seen is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(int(seen.timestamp() * 1000) + self.keep)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.value.clear()
        return iter(())

    def close(self) -> None:
        pass


class Lookup(_Kept):
    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "k string, p string, n string", "yes boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        old = self._read().get("url")
        least, new, seen = old, {}, None
        for r in rows:
            seen = r.seen if seen is None or (r.seen is not None and r.seen > seen) else seen
            if r.is_url:
                least = r.k if least is None else min(least, r.k)
            else:
                new[(r.k, r.p, r.n)] = True
        tell = []
        if least != old:
            self._write({"url": least})
            tell = [(x["k"], x["p"], x["n"]) if isinstance(x, dict) else tuple(x) for x in self.waiting.keys()]  # noqa: SIM118
        known = set(tell)
        for x in new:
            if x not in known and not self.waiting.containsKey(x):
                self.waiting.updateValue(x, (True,))
                if least is not None:
                    tell.append(x)
        self._touch(seen)
        for k, p, n in tell:
            yield Row(k=k, p=p, n=n, side=key[0][:1], url=least, seen=seen)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.waiting.clear()
        return super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


class Record(_Kept):
    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        x = self._read()
        is_url, seen = key[0].startswith("url:"), None
        body, was = x.get("body"), x.get("identity")
        grown = False
        for r in rows:
            seen = r.seen if seen is None or (r.seen is not None and r.seen > seen) else seen
            if r.side is not None:
                x[r.side] = r.url if x.get(r.side) is None else min(x[r.side], r.url)
            else:
                body, grown = merged(body, body_of(0 if is_url else 1, r)), True
        x["body"] = body
        if body is not None:
            x["identity"] = key[0] if is_url else x.get("p") or x.get("n") or key[0]
        self._write(x)
        self._touch(seen)
        part = json.dumps(list(key))
        if was is not None and was != x["identity"]:
            yield Row(identity=was, part=part, body=None, seen=seen)
        if body is not None and (grown or was != x["identity"]):
            yield Row(identity=x["identity"], part=part, body=json.dumps(body), seen=seen)


class Identity(_Kept):
    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.parts = handle.getMapState("parts", "part string", "body string")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        x, seen = self._read(), None
        total, again = x.get("total"), False
        for r in rows:
            seen = r.seen if seen is None or (r.seen is not None and r.seen > seen) else seen
            had = self.parts.containsKey((r.part,))
            if r.body is None:
                again = True
                if had:
                    self.parts.removeKey((r.part,))
                continue
            body = json.loads(r.body)
            if had:  # its rows are in the sum already: only the count has to be put right
                total = merged(total, body) | {"rows": total["rows"] + body["rows"] - json.loads(self.parts.getValue((r.part,))[0])["rows"]}
            else:
                total = merged(total, body)
            self.parts.updateValue((r.part,), (r.body,))
        if again:
            total = None
            for v in self.parts.values():
                total = merged(total, json.loads(v[0]))
        version = x.get("version", 0) + 1
        self._write({"total": total, "version": version})
        self._touch(seen)
        values = [v and v[1] for v in total["values"]] if total else []
        changed = bool(total) and any(v is not None and not f for v, f in zip(values, total["first"], strict=True))
        yield Row(identity=key[0], fields=values, merged_records=total["rows"] if total else 0, changed=changed, live=bool(total), version=version)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.parts.clear()
        return super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


def _ordered(df: DataFrame, order: str) -> Column:
    kind = df.schema[order].dataType.simpleString()
    return F.unix_micros(F.col(order).cast("timestamp")) if kind.startswith("timestamp") else F.col(order).cast("long")


def merged_rounds(stream: DataFrame, key: str, property_id: str, name: str, fields: list[str], order: str, at: str | None = None, keep: str | None = None, late: str = "1 hour") -> DataFrame:
    """The change log (identity, fields..., merged_records, changed, live, version) of a stream of records. With `keep` (a
    duration such as "2 days"), `at` names the event time."""
    spark = stream.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    if keep and at is None:
        raise ValueError("eviction needs an event time")
    mode = "EventTime" if keep else "None"
    idle = spark.range(1).select(F.expr(f"unix_millis(timestamp'2000-01-01 00:00:00' + interval {keep}) - unix_millis(timestamp'2000-01-01 00:00:00')")).first()[0] if keep else None
    rows = stream.select(
        F.col(key).alias("k"), none_if_empty(F.trim(property_id)).alias("p"), none_if_empty(F.lower(F.trim(name))).alias("n"), _ordered(stream, order).alias("at"),
        F.struct(*[none_if_empty(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)]).alias("fields"), (F.col(at).cast("timestamp") if at else F.lit(None).cast("timestamp")).alias("seen"),
    ).mapInArrow(summed, _SUMMED)
    if keep:
        rows = rows.withWatermark("seen", late)
    event_time = "seen" if keep else ""
    lookup = F.explode(F.array_compact(F.array(F.concat(F.lit("p:"), "p"), F.concat(F.lit("n:"), "n"))))
    links = rows.select(lookup.alias("lookup"), F.col("k").startswith("url:").alias("is_url"), "k", "p", "n", "seen")
    told = links.groupBy("lookup").transformWithState(Lookup(idle), outputStructType=_TOLD, outputMode="Append", timeMode=mode, eventTimeColumnName=event_time)
    empty = {c: F.lit(None).cast(kind) for c, kind in (("rows", "long"), ("at", "long"), ("present", "array<boolean>"), ("ats", "array<long>"), ("fields", "array<string>"))}
    own = rows.withColumns({"side": F.lit(None).cast("string"), "url": F.lit(None).cast("string")})
    both = own.unionByName(told.withColumns(empty).select(*own.columns))
    moved = both.groupBy("k", "p", "n").transformWithState(Record(idle), outputStructType=_MOVED, outputMode="Append", timeMode=mode, eventTimeColumnName=event_time)
    out = StructType([StructField("identity", StringType()), StructField("fields", ArrayType(StringType())), StructField("merged_records", LongType()), StructField("changed", BooleanType()), StructField("live", BooleanType()), StructField("version", LongType())])
    log = moved.groupBy("identity").transformWithState(Identity(idle), outputStructType=out, outputMode="Append", timeMode=mode)
    return log.select("identity", *[F.get("fields", F.lit(i)).alias(f) for i, f in enumerate(fields)], "merged_records", "changed", "live", "version")


def into_table(log: DataFrame, store: TableStore, name: str, checkpoint: str) -> StreamingQuery:
    """Keep the last row of each identity in a table of the store; a micro-batch that is tried again changes nothing."""
    store.create(name, log.schema)

    def each(df: DataFrame, _: int) -> None:
        last = df.groupBy("identity").agg(F.max_by(F.struct(*df.columns), "version").alias("r")).select("r.*")
        store.upsert(name, last, ["identity"])

    return log.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def read_rounds(spark: SparkSession, folder: str, schema: StructType, files_a_batch: int = 1) -> DataFrame:
    """Rounds that lie as Parquet files in a folder, in the order in which they came."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)
