"""Publishing of crawled records: which are publishable, their public form, and diagnostic splits."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.functions.text import present
from stayspark.operators.ranking import in_plan_order
from stayspark.sources.contract import Contract, load_contract

REQUIRED = ("hotel_name", "hotel_url", "price_value")


def is_publishable(required: tuple[str, ...] = REQUIRED) -> Column:
    return reduce(lambda a, b: a & b, [present(c) for c in required])


def missing_required(required: tuple[str, ...] = REQUIRED) -> Column:
    return F.array_compact(F.array(*[F.when(~present(c), F.lit(c)) for c in required]))


def public_records(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    """The contract's columns in order, as text; absent ones null."""
    return df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in (contract or load_contract()).columns])


def published(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    return public_records(df.where(is_publishable()), contract)


def json_lines(df: DataFrame) -> DataFrame:
    """(value): a JSON object a row, null fields written out."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    json_lines(df).write.mode("errorifexists").text(path)


def append_json_lines(df: DataFrame, folder: str) -> str:
    """Add records to a folder of JSON lines; any number of writers may do so at once, since each call writes a new folder
    of its own inside it. Returns that folder."""
    own = f"{folder.rstrip('/')}/append-{uuid.uuid4().hex}"
    write_json_lines(df, own)
    return own


def read_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(value): all lines that have been appended to a folder."""
    return spark.read.option("recursiveFileLookup", True).text(folder)


def collected(results: list[DataFrame], plan: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The records of all workers in the order of their jobs in the plan; columns that a worker lacks are null."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    return in_plan_order(both, plan, keys, ordinal)


def _some(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


IDENTITY = ["hotel_name", "hotel_url", "destination", "check_in", "check_out", "collect_status", "record_kind"]


def without_url(df: DataFrame) -> DataFrame:
    """Records that lack a URL, with where their card came from."""
    kept = df.where(~present("hotel_url"))
    source = F.struct(*[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in ("card_source", "card_tag", "card_data_selenium", "card_data_testid")])
    return _some(kept.withColumn("card_origin", source), [*IDENTITY, "listing_property_id", "listing_text_snippet", "candidate_urls", "outer_html_preview", "card_origin"])


def without_price(df: DataFrame) -> DataFrame:
    return _some(df.where(present("hotel_url") & ~present("price_value")), [*IDENTITY, "price_status", "enrich_status", "enrich_error", "rating_text", "review_count_text", "star_rating_text", "listing_text_snippet", "canonical_url"])


def discarded(df: DataFrame) -> DataFrame:
    """Records that are not published, and what they lack."""
    kept = df.where(~is_publishable()).withColumn("missing_fields", missing_required())
    return _some(kept, [*IDENTITY, "price_value", "missing_fields"])


def write_diagnostics(df: DataFrame, folder: str) -> dict[str, int]:
    """The three splits as JSON lines, an empty one as no folder; row counts."""
    out = {}
    for name, part in (("missing_url", without_url(df)), ("missing_price", without_price(df)), ("discarded", discarded(df))):
        if not part.isEmpty():
            part.write.mode("overwrite").json(f"{folder}/{name}")
            out[name] = df.sparkSession.read.text(f"{folder}/{name}").count()
        else:
            out[name] = 0
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return out
