"""Plans of crawl jobs: stays, destinations, and their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.functions.text import parse_date
from stayspark.operators.ranking import job_matrix, workers


def stays(dates: DataFrame, column: str) -> DataFrame:
    """One-night stays of dates that are given as text."""
    day = parse_date(column)
    return dates.where(day.isNotNull()).select(day.alias("check_in"), F.date_add(day, 1).alias("check_out"))


def jobs(spark: SparkSession, dates: list[str], destinations: list[str], n_workers: int = 3) -> DataFrame:
    """(check_in, check_out, destination, ordinal, worker) in plan order: all destinations of the first stay, and so on."""
    days = spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "d string, s int").select(parse_date("d").alias("check_in"), "s").withColumn("check_out", F.date_add("check_in", 1))
    names = spark.createDataFrame([(d, i) for i, d in enumerate(destinations)], "destination string, t int")
    both = job_matrix(days, names).withColumn("ordinal", (F.col("s") * len(destinations) + F.col("t")).cast("long"))
    return workers(both, "ordinal", n_workers).select("check_in", "check_out", "destination", "ordinal", "worker")
