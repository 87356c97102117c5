"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

Filters: A under 100 words, B few distinct words, C many capitals, D odd characters, E identical to the text of a smaller id.
Duplicates by sorting: rows are range-partitioned by (fingerprint of the text, id), so the copies of one text may fill many
partitions, and sorted by (fingerprint, text, id). A row is a copy if its predecessor has its text and a smaller id or is a copy
itself. What a partition can't know about its first fingerprint is settled between partitions: each announces the texts and
least ids of its first and last fingerprint, a few rows a partition, and these meet in an aggregate. Every row becomes a mask
of five failures; masks are counted by part, and counts are added up over the 120 orders.

Defined results: a null text is empty (and a copy of other empty ones), a null part is the empty string. A row with a null id is
neither a copy nor an original and has no label. Rows that share an id and a text are no copies of one another; each counts.
Labels of an id that is labelled more than once count if any says 1. An empty table has no parts and gives no rows. Other
columns are ignored. Memory holds one batch of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, materialise, table
from stayspark.session import bounded, ship

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
ODD = r"[#$%&*|]"
COPY = 1 << FILTERS.index("E")
_ROWS = pa.schema([("kind", pa.int32()), ("fp", pa.int64()), ("text", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])
_COLUMNS = "kind int, fp long, text binary, doc_id long, part string, mask int, n long"
KNOWN, OPEN, TOLD = 0, 1, 2  # a judged row, rows that wait for earlier partitions, a text that later partitions may ask for
_LAST = (1 << 63) - 1


def own_failures(text: Column) -> Column:
    """The bits of the filters that look at one text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, size = F.size(words), F.length(text)
    capitals = size - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (n < 100, 100 * F.size(F.array_distinct(words)) < 80 * n, 100 * capitals > 10 * size, text.rlike(ODD))
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))


def ordered(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Rows in the order of (fp, text, doc_id), each range in a partition; masks are made after the exchange, once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("fp"))
    by_id = F.col("doc_id").asc_nulls_last()
    return rows.repartitionByRange("fp", by_id).sortWithinPartitions("fp", "text", by_id).select("fp", F.col("text").cast("binary").alias("text"), "doc_id", "part", own_failures(F.col("text")).alias("mask"))


def same_as_before(fp: np.ndarray, texts: pa.Array, last: tuple[int, bytes] | None) -> np.ndarray:
    """Whether a row's text is its predecessor's; texts are compared where fingerprints are equal."""
    same = np.zeros(len(fp), bool)
    same[1:] = fp[1:] == fp[:-1]
    at = np.flatnonzero(same)
    if len(at):
        mine, before = texts.take(pa.array(at)).to_pylist(), texts.take(pa.array(at - 1)).to_pylist()
        same[at] = [x == y for x, y in zip(mine, before, strict=True)]
    if last is not None and fp[0] == last[0]:
        same[0] = texts[0].as_py() == last[1]
    return same


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted range: its rows with the copy bit, and what has to be settled with other ranges."""
    head = last = None
    least = _LAST  # least id of the text of `last`
    running: list[tuple[bytes, int]] = []  # texts of the fingerprint at hand, with their least ids; more than one only if it collides
    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        texts, ids = batch.column("text"), batch.column("doc_id")
        named = ids.is_valid().to_numpy(zero_copy_only=False)
        at = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        head = fp[0] if head is None else head
        starts = np.flatnonzero(~same_as_before(fp, texts, last))
        group = np.zeros(len(fp), np.int64)
        group[starts] = 1
        group = np.cumsum(group)  # 0: the text of `last`
        leasts = np.concatenate([[least], at[starts]])
        copy = named & (at > leasts[group])
        mask = batch.column("mask").to_numpy(zero_copy_only=False) | np.where(copy, COPY, 0).astype(np.int32)
        waits = (fp == head) & named & ~copy
        known = pa.array(np.flatnonzero(~waits))
        yield arrow_rows(_ROWS, kind=pa.array(np.full(len(known), KNOWN, np.int32)), fp=pa.nulls(len(known), pa.int64()), text=pa.nulls(len(known), pa.binary()), doc_id=ids.take(known), part=batch.column("part").take(known), mask=pa.array(mask).take(known), n=pa.array(np.ones(len(known), np.int64)))
        if waits.any():
            parts = batch.column("part")
            count = Counter((int(group[i]), int(at[i]), parts[int(i)].as_py(), int(mask[i])) for i in np.flatnonzero(waits))
            text_of = {g: texts[int(np.searchsorted(group, g))].as_py() for g in {k[0] for k in count}}
            yield pa.RecordBatch.from_pylist([{"kind": OPEN, "fp": int(head), "text": text_of[g], "doc_id": d, "part": p, "mask": m, "n": n} for (g, d, p, m), n in count.items()], schema=_ROWS)
        end = fp[-1]
        running = [x for x in running if last is not None and last[0] == end]
        running += [(texts[int(i)].as_py(), int(at[i])) for i in starts[fp[starts] == end]]
        last, least = (int(end), texts[batch.num_rows - 1].as_py()), int(leasts[-1])
    if last is not None:
        told = [{"kind": TOLD, "fp": last[0], "text": t, "doc_id": d, "part": None, "mask": None, "n": None} for t, d in running if d != _LAST]
        yield pa.RecordBatch.from_pylist(told, schema=_ROWS)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): n rows of a document fail the filters whose bits `mask` holds."""
    ship(docs.sparkSession)
    bounded(docs.sparkSession)
    rows = materialise(ordered(docs, id_col, text_col, part_col).mapInArrow(marked, _COLUMNS), "masks")
    least = rows.where(F.col("kind") != KNOWN).groupBy("fp", "text").agg(F.min("doc_id").alias("least"))
    late = rows.where(F.col("kind") == OPEN).join(least, ["fp", "text"])
    settled = late.select("doc_id", "part", F.when(F.col("doc_id") > F.col("least"), F.col("mask").bitwiseOR(F.lit(COPY))).otherwise(F.col("mask")).alias("mask"), "n")
    return rows.where(F.col("kind") == KNOWN).select("doc_id", "part", "mask", "n").unionByName(settled)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by failures and labels."""
    of = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = of.agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = masks.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left")
    nameless = masks.where(F.col("doc_id").isNull()).withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    both = named.select("part", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]).unionByName(nameless.select("part", "mask", "n", "good", "toxic"))
    return both.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _bit(letter: Column) -> Column:
    return F.pow(F.lit(2), F.ascii(letter) - ord("A")).cast("int")


def interactions(counts: DataFrame) -> DataFrame:
    """A row for every part, order and step: sums over the counts of masks, which are few."""
    orders = ",".join("".join(p) for p in permutations(FILTERS))
    placed = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    own = _bit(F.substring("filter_order", F.col("step"), F.lit(1)))
    earlier = sum((F.when(F.col("step") > j, _bit(F.substring("filter_order", j, 1))).otherwise(0) for j in range(1, len(FILTERS))), F.lit(0))
    placed = placed.withColumn("own", own).withColumn("gone", F.col("mask").bitwiseAND(earlier) != 0).withColumn("fails", F.col("mask").bitwiseAND(F.col("own")) != 0)
    gone, fails, n = F.col("gone"), F.col("fails"), F.col("n")
    # Of the orders of the k filters that a document fails, each comes first in one out of k.
    share = n * F.lit(120) / F.bit_count("mask")
    sums = {
        "kept": ~gone & ~fails, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": F.col("mask") == F.col("own"),
        "good_lost": fails & ~gone & F.col("good"), "toxic_lost": fails & ~gone & F.col("toxic"),
    }
    out = [F.sum(F.when(x, n).otherwise(0)).cast("long").alias(k) for k, x in sums.items()]
    return placed.groupBy("part", "filter_order", "step").agg(*out, F.sum(F.when(fails, share).otherwise(0.0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    return interactions(mask_counts(failures(docs, id_col, text_col, part_col), labels))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_ORDERS = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
m AS (SELECT doc_id, part,
  CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
o AS (SELECT f AS filter_order, s AS step, 1 << (ascii(f[s]) - 65) AS own, list_sum([0] || list_transform(range(1, s), lambda j: 1 << (ascii(f[j]) - 65))) AS earlier FROM (VALUES {_ORDERS}) t(f), range(1, 6) r(s)),
x AS (SELECT *, (mask & own) <> 0 AS fails, (mask & earlier::BIGINT) <> 0 AS gone FROM c, o)
SELECT part, filter_order, cast(step AS INTEGER) AS step,
 cast(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
 cast(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
 cast(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
 cast(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
 cast(sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
 cast(sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
 cast(sum(CASE WHEN fails THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley
FROM x GROUP BY part, filter_order, step
"""
