"""Key indices of a table's folders: which folders may hold one of given keys.

For each key column the least and greatest value, and over all of them a Bloom filter of 64-bit words: a key sets four bits of one
word, about four keys share a word, so some two of a hundred foreign keys pass. The number of words is a power of two, so that
folders of one size are probed by one join on the word. Null keys equal nothing in a merge and are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, FractionalType, IntegerType, LongType, ShortType, StringType, TimestampType

KEYS_A_WORD = 4
BITS = 4
PREFIX = 64  # of a text, enough of it to compare: cutting keeps the order


def _ordered(c: str, t: DataType) -> Column | None:
    """The column as a number or a short text that Python orders as Spark does; None where ranges are not kept."""
    if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(c).cast("long")
    if isinstance(t, DateType):
        return F.unix_date(c).cast("long")
    if isinstance(t, TimestampType):
        return F.unix_micros(c)
    return F.left(c, F.lit(PREFIX)) if isinstance(t, StringType) else None


def _ranges(df: DataFrame, keys: list[str]) -> dict[str, list]:
    """Least and greatest of each key column that has an order; [] where it has no values."""
    ordered = {k: o for k in keys if (o := _ordered(k, df.schema[k].dataType)) is not None}
    if not ordered:
        return {}
    row = df.agg(*[f(o) for o in ordered.values() for f in (F.min, F.max)]).first()
    return {k: [] if row[2 * i] is None else [row[2 * i], row[2 * i + 1]] for i, k in enumerate(ordered)}


def hashes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each row's key as a hash. Kinds of zero are one key, as they are in a join."""
    types = {k: df.schema[k].dataType for k in keys}
    same = [F.col(k) + F.lit(0).cast(t) if isinstance(t, FractionalType) else F.col(k) for k, t in types.items()]
    return df.select(F.xxhash64(*same).alias("_hash"))


def _hashed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each row's key as a hash and the bits that it sets."""
    some = hashes(df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])), keys)
    # The word is taken from the low bits of the hash, the bits in it from a second hash.
    second = F.xxhash64(F.col("_hash"), F.lit(1))
    bit = lambda i: F.expr(f"shiftleft(1L, cast(shiftright(_second, {6 * i}) & 63 AS int))")
    return some.withColumn("_second", second).select("_hash", reduce(lambda a, b: a.bitwiseOR(b), [bit(i) for i in range(BITS)]).alias("_bits"))


def _word(power: int) -> Column:
    return F.col("_hash").bitwiseAND(F.lit((1 << power) - 1).cast("long"))


def write(df: DataFrame, keys: list[str], rows: int, root: str) -> dict:
    """Write the Bloom filter of a new folder's rows below root; the entry for the table's state."""
    power, path = max((rows // KEYS_A_WORD).bit_length(), 1), f"index-{uuid.uuid4().hex}"
    words = _hashed(df, keys).groupBy(_word(power).alias("word")).agg(F.bit_or("_bits").alias("bits"))
    words.write.parquet(f"{root}/{path}")
    return {"keys": keys, "rows": rows, "power": power, "path": path, "ranges": _ranges(df, keys)}


def renamed(entry: dict, changed: Callable[[str], str]) -> dict:
    return {**entry, "keys": [changed(k) for k in entry["keys"]], "ranges": {changed(k): v for k, v in entry["ranges"].items()}}


def _meet(a: dict[str, list], b: dict[str, list]) -> bool:
    return all(a[k] and b[k] and a[k][0] <= b[k][1] and b[k][0] <= a[k][1] for k in a.keys() & b.keys())


def may_hold(spark: SparkSession, root: str, folders: dict[str, dict | None], df: DataFrame, keys: list[str]) -> list[str]:
    """Of the folders, with their entries, those that may hold a key of df. Without an index of these keys a folder always may.
    Never leaves one out that does. What comes back to the driver are names of indices only."""
    near = {f: e for f, e in folders.items() if e and e["keys"] == keys}
    always = {f for f in folders if f not in near}
    if near:
        own = _ranges(df, keys)
        near = {f: e for f, e in near.items() if _meet(own, e["ranges"])}
    if not near:
        return [f for f in folders if f in always]
    hashed, found = _hashed(df, keys), []
    for power in {e["power"] for e in near.values()}:
        paths = {e["path"] for e in near.values() if e["power"] == power}
        words = spark.read.schema("word long, bits long").parquet(*[f"{root}/{p}" for p in sorted(paths)])
        named = words.select("word", "bits", F.element_at(F.split("_metadata.file_path", "/"), -2).alias("path"))
        probe = hashed.select(_word(power).alias("word"), "_bits").distinct()
        found.append(named.join(probe, (named["word"] == probe["word"]) & (named["bits"].bitwiseAND(F.col("_bits")) == F.col("_bits"))).select("path"))
    hit = {r[0] for r in reduce(DataFrame.union, found).distinct().collect()}
    return [f for f in folders if f in always or (f in near and near[f]["path"] in hit)]
