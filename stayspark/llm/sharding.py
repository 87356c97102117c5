"""Sharding by sampled splitters: nearly equal bytes in each shard, copies of a text side by side.

Records are ordered by (hash of the text, id, row mark). A size-weighted sample of these keys gives quantile boundaries, and
the boundaries give ranges. Ranges that turn out overfull are sampled again and subdivided, between texts where that is
possible and inside one text's copies where it is not. Exact sums over the ranges then cut the order into shards.

Law `bytes`: shards differ by the bytes of one group of equal texts or one record at most, and a group stays in one shard
unless it has more than `tolerance` of a shard's bytes. Slots number a shard's records from 0 in order.

Defined results: a null text has no bytes, size 1 and crc32 0; repeated rows are records of their own; an empty table gives
an empty result; other columns are ignored; only (id, size, crc, hash, mark) are ever moved, so long texts don't matter.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, materialise, table, unit_hash

SHARDS = 8
TOLERANCE = 0.05
ROWS_A_RANGE = 20_000
RANGES = (16, 4096)  # bounds what is collected and broadcast: a few numbers for each range
DRAWS = 8  # expected draws for each range
ROUNDS = 4
LEAST = -(1 << 63)


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.monotonically_increasing_id().alias("mark"),
    )


def draws(rows: DataFrame, total: int, expected: int, seed: int) -> list[tuple]:
    """Keys drawn with a probability in proportion to size; about `expected` of them, whatever the number of rows."""
    drawn = rows.where(unit_hash("doc_id", "mark", seed=seed) < F.col("size") * (expected / max(total, 1)))
    return sorted((h, -(1 << 63) if d is None else d, m) for h, d, m in drawn.select("h", "doc_id", "mark").collect())


def boundaries(drawn: list[tuple], ranges: int) -> set[tuple]:
    """Quantiles of the draws, moved to the beginning of a text's copies; inside them only where a text was drawn often."""
    step = max(1, len(drawn) // max(ranges, 1))
    often = Counter(h for h, _, _ in drawn)
    out = set()
    for h, d, m in drawn[step::step]:
        out.add((h, LEAST, LEAST))
        if often[h] > 2 * step:
            out.add((h, d, m))
    return out


def in_ranges(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """rows plus `range`, the number of splitters at or before the key."""
    names = ["doc_id", "size", "text_crc32", "h", "mark"]
    schema = pa.schema([(x, pa.int64()) for x in names] + [("range", pa.int32())])
    heads = np.array([s[0] for s in splitters], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            at = np.searchsorted(heads, h, "right")
            tied = np.flatnonzero(np.searchsorted(heads, h, "left") < at)
            if len(tied):
                ids, marks = batch.column("doc_id").take(pa.array(tied)).to_pylist(), batch.column("mark").take(pa.array(tied)).to_pylist()
                at[tied] = [bisect_right(splitters, (int(h[i]), LEAST if d is None else d, m)) for i, d, m in zip(tied, ids, marks, strict=True)]
            yield arrow_rows(schema, **{x: batch.column(x) for x in names}, range=at.astype(np.int32))

    return rows.select(*[F.col(x).cast("long") for x in names]).mapInArrow(run, ", ".join(f"{x} long" for x in names) + ", range int")


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard)."""
    spark = docs.sparkSession
    rows = materialise(records(docs), "records")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(max(n // rows_a_range, RANGES[0]), RANGES[1])
    splitters = sorted(boundaries(draws(rows, total, ranges * DRAWS, 0), ranges))
    for again in range(ROUNDS):
        ranged = in_ranges(rows, splitters)
        sums = {r: (size, count) for r, size, count in ranged.groupBy("range").agg(F.sum("size"), F.count("*")).collect()}
        full = {r: size for r, (size, count) in sums.items() if count > 1 and size > 2 * total / ranges}
        if not full or again == ROUNDS - 1:
            break
        of = ranged.where(F.col("range").isin(list(full)))
        more = boundaries(draws(of, sum(full.values()), DRAWS * max(2, round(sum(full.values()) * ranges / total)), again + 1), max(2, round(sum(full.values()) * ranges / total)))
        if more <= set(splitters):
            break
        splitters = sorted({*splitters, *more})
    before, starts = 0, []
    for r in sorted(sums):
        starts.append((r, before))
        before += sums[r][0]
    starts = spark.createDataFrame(starts, "range int, before long")
    order = Window.partitionBy("range").orderBy("h", "doc_id", "mark")
    peers = Window.partitionBy("range").orderBy("h")
    placed = (
        ranged.join(F.broadcast(starts), "range")
        .withColumn("run", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("n", F.row_number().over(order))
        .withColumn("group_end", F.sum("size").over(peers.rangeBetween(Window.unboundedPreceding, 0)))
        .withColumn("group_size", F.sum("size").over(peers.rangeBetween(0, 0)))
    )
    whole = F.col("group_size") <= tolerance * total / shards
    middle = F.col("before") + F.when(whole, F.col("group_end") - F.col("group_size") / 2).otherwise(F.col("run") - F.col("size") / 2)
    placed = materialise(placed.select("doc_id", "size", "text_crc32", "range", "n", F.least(F.lit(shards - 1), F.floor(middle * shards / max(total, 1))).cast("int").alias("shard")), "placed")
    # Where a shard begins in a range, and how many of its rows earlier ranges hold.
    held, offsets = Counter(), []
    for r, s, count, first in sorted(placed.groupBy("range", "shard").agg(F.count("*"), F.min("n")).collect()):
        offsets.append((r, s, held[s] - first))
        held[s] += count
    offsets = spark.createDataFrame(offsets, "range int, shard int, shift long")
    return placed.join(F.broadcast(offsets), ["range", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("n") + F.col("shift")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op4_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
