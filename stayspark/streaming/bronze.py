"""Streaming: JSON lines as they land, and records merged as they arrive.

The batch pipeline's bronze step, and its merge across scroll rounds, as streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, StructField, StructType

from stayspark.functions.text import digest
from stayspark.operators import rules
from stayspark.plans.store import TableStore
from stayspark.sources.contract import Contract, load_contract


def read_lines(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(folder).select(F.col("value").alias("raw_record_json"), F.col("_metadata.file_path").alias("source_file_path"), F.col("_metadata.file_modification_time").alias("landed_at"))


def parsed(lines: DataFrame, contract: Contract | None = None) -> DataFrame:
    return rules.parsed_lines(lines, contract or load_contract()).withColumn("record_id", digest("source_file_path", "raw_record_json"))


def deduplicated(stream: DataFrame, keys: list[str], at: str, late: str = "1 day") -> DataFrame:
    """First row of every key; state older than the watermark is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def into_store(stream: DataFrame, store: TableStore, name: str, keys: list[str], checkpoint: str, then: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Insert-only merge of every micro-batch: a batch that is tried again adds nothing."""

    def each(df: DataFrame, _: int) -> None:
        store.insert_only(name, df, keys)
        if then:
            then(df)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


BATCHES = "batch long, watermark timestamp, greatest timestamp, on_time long, late long"


def on_time_into_store(stream: DataFrame, store: TableStore, name: str, keys: list[str], at: str, checkpoint: str, late: str = "2 hours") -> StreamingQuery:
    """Insert-only merge of rows that come in time, and a side output of late ones: a row whose `at` lies more than `late` behind
    the greatest of all earlier micro-batches goes to table `<name>_late` with its lateness in seconds. Table `<name>_batches`
    has a row for each micro-batch with its watermark and counts. Rows without a time are in time. A micro-batch that is tried
    again sees the same earlier ones, so it decides alike and adds nothing."""
    store.create(name, stream.schema)
    store.create(f"{name}_late", StructType([*stream.schema.fields, StructField("lateness", DoubleType())]))
    store.create(f"{name}_batches", BATCHES)

    def each(df: DataFrame, batch: int) -> None:
        past = store.read(f"{name}_batches").where(F.col("batch") < batch).agg(F.max("greatest").alias("g"))
        mark = past.select((F.col("g") - F.expr(f"INTERVAL {late}")).alias("_mark"))
        rows = df.crossJoin(F.broadcast(mark)).withColumn("_late", F.coalesce(F.col(at) < F.col("_mark"), F.lit(False))).persist()  # one row
        try:
            store.insert_only(name, rows.where("NOT _late"), keys)
            behind = F.unix_micros("_mark") - F.unix_micros(F.col(at).cast("timestamp"))
            store.insert_only(f"{name}_late", rows.where("_late").withColumn("lateness", behind / 1e6), keys)
            seen = rows.agg(F.max("_mark").alias("watermark"), F.max(at).alias("greatest"), F.count_if(~F.col("_late")).alias("on_time"), F.count_if("_late").alias("late"))
            store.upsert(f"{name}_batches", seen.withColumn("batch", F.lit(batch)), ["batch"])
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, keys: list[str], window: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """Rows by window and keys, final once the watermark has passed: tumbling windows, or with `slide` overlapping ones that
    begin so far apart."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window, slide).alias("window"), *keys).agg(F.count("*").alias("records"))


def session_counts(stream: DataFrame, at: str, keys: list[str], gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Rows by session and keys: a session ends where nothing comes for `gap`. A stream needs at least one key."""
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("session"), *keys).agg(F.count("*").alias("records"))
