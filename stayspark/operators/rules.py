"""Contract rules as Column expressions, defaulting of optional metrics, typing, and the two splits.

A rule gives its name where it fails and null elsewhere. All parsing is by try_ functions, so bad text never ends a job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.sources.contract import Contract, Field

MAX_INVALID_ROWS = 200
MAX_INVALID_RATIO = 0.10
STAR = r"(\d+(?:[.,]\d+)?)"


def filled(c: Column) -> Column:
    """Not null, and not only blanks."""
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))


def digits(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def price_of(c: Column) -> Column:
    return digits(c).try_cast("decimal(18,0)")


def rating_of(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, ",", "."), F.lit("")).try_cast("decimal(3,1)")


def count_of(c: Column) -> Column:
    return digits(c).try_cast("bigint")


def star_of(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(c, STAR, 1), ",", "."), F.lit("")).try_cast("decimal(2,1)")


def outside(value: Column, low: int, high: int) -> Column:
    return value.isNull() | (value < low) | (value > high)


#: format -> (how a value is parsed, when a filled one is invalid, by its parsed form)
FORMATS: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "uri": (lambda c: c.rlike("^https?://"), lambda v: ~v),
    "positive_price": (price_of, lambda v: v.isNull() | (v <= 0)),
    "timestamp": (F.try_to_timestamp, lambda v: v.isNull()),
    "date": (F.try_to_date, lambda v: v.isNull()),
    "rating_0_10": (rating_of, lambda v: outside(v, 0, 10)),
    "non_negative_integer": (count_of, lambda v: v.isNull() | (v < 0)),
    "star_rating_0_5": (star_of, lambda v: outside(v, 0, 5)),
}
#: cross-field rule -> (the name of its failure, its check over two parsed dates)
CROSS = {"check_out_after_check_in": ("check_out_not_after_check_in", "check_out", "check_in")}
PARSED = "_parsed_"


def parsed_name(field: str) -> str:
    return f"{PARSED}{field}"


def with_parsed(df: DataFrame, contract: Contract) -> DataFrame:
    """df plus the parsed form of every field with a format, each in a column of its own: what follows tests these columns,
    and no text is parsed twice in one projection."""
    if unknown := [f.format for f in contract.fields if f.format and f.format not in FORMATS]:
        raise ValueError(f"unknown format {unknown[0]}")
    return df.withColumns({parsed_name(f.name): FORMATS[f.format][0](F.col(f.name)) for f in contract.fields if f.format})


def without_parsed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(PARSED)])


def malformed(field: Field) -> Column:
    """A filled value that is invalid, on top of with_parsed."""
    return filled(F.col(field.name)) & FORMATS[field.format][1](F.col(parsed_name(field.name)))


def is_defaulted(field: Field) -> bool:
    return not field.required and field.format in NEUTRAL


def field_rules(field: Field) -> list[Column]:
    out = []
    if field.required:
        out.append(F.when(~filled(F.col(field.name)), F.lit(f"required_{field.name}")))
    if field.format:
        out.append(F.when(malformed(field), F.lit(f"invalid_{field.name}")))
    return out


def cross_rules(names: tuple[str, ...]) -> list[Column]:
    if unknown := [n for n in names if n not in CROSS]:
        raise ValueError(f"unknown cross-field rules {unknown}")
    return [F.when(F.col(parsed_name(later)) <= F.col(parsed_name(earlier)), F.lit(name)) for name, later, earlier in map(CROSS.get, names)]


def failed_rules(contract: Contract, defaults: bool = False) -> Column:
    """Names of failed rules: fields in the contract's order, required before format, cross-field rules last; on top of
    with_parsed. With `defaults`, malformed metrics count as replaced by neutral ones, which fail nothing."""
    fields = [f for f in contract.fields if not (defaults and is_defaulted(f))]
    return F.array_compact(F.array(*[r for f in fields for r in field_rules(f)], *cross_rules(contract.cross_rules)))


#: format -> what a malformed optional value becomes
NEUTRAL = {"rating_0_10": "0", "non_negative_integer": "0", "star_rating_0_5": "0 stars"}
METRICS = {"rating_0_10": "decimal(3,1)", "non_negative_integer": "bigint", "star_rating_0_5": "decimal(2,1)"}


def _defaulted(df: DataFrame, contract: Contract) -> DataFrame:
    """Metrics and their parsed forms, malformed ones neutral; on top of with_parsed."""
    out = {}
    for f in filter(is_defaulted, contract.fields):
        value = F.col(parsed_name(f.name))
        out[f.name] = F.when(malformed(f), F.lit(NEUTRAL[f.format])).otherwise(F.col(f.name))
        out[parsed_name(f.name)] = F.when(malformed(f), F.lit(0).cast(METRICS[f.format])).otherwise(value)
    return df.withColumns(out) if out else df


def defaulted(df: DataFrame, contract: Contract) -> DataFrame:
    """Malformed optional metrics become neutral; blank and missing ones stay."""
    return without_parsed(_defaulted(with_parsed(df, contract), contract))


def validated(df: DataFrame, contract: Contract) -> DataFrame:
    """df, metrics defaulted, plus failed_rules and the parsed form of every field with a format."""
    return _defaulted(with_parsed(df, contract).withColumn("failed_rules", failed_rules(contract, defaults=True)), contract)


def quarantine_reason(df: DataFrame) -> DataFrame:
    return without_parsed(df).where(F.size("failed_rules") > 0).withColumn("failure_reason", F.concat_ws(";", "failed_rules"))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(F.size("failed_rules") == 0).drop("failed_rules")


def typed(df: DataFrame) -> DataFrame:
    """Business columns with their types, from what `validated` has parsed; check_out is checked, not kept."""
    of = {"check_in_date": "check_in", "price_amount": "price_value", "rating": "rating_text", "review_count": "review_count_text", "star_rating": "star_rating_text", "crawled_at": "crawled_at"}
    return without_parsed(df.withColumns({k: F.col(parsed_name(v)) for k, v in of.items()}))


def parsed_lines(df: DataFrame, contract: Contract, line: str = "raw_record_json") -> DataFrame:
    """df plus the contract's columns and `is_object`: lines that are no JSON object, blank ones too, are malformed."""
    record = F.from_json(F.col(line), contract.schema)
    return df.withColumn("_record", record).withColumn("is_object", F.json_object_keys(F.col(line)).isNotNull()).select("*", "_record.*").drop("_record")


def too_many_invalid(rows: int, invalid: int) -> bool:
    return rows > 0 and (invalid > MAX_INVALID_ROWS or invalid / rows > MAX_INVALID_RATIO)


def invalid_groups(df: DataFrame, keys: list[str], invalid: Column, most: int = MAX_INVALID_ROWS, ratio: float = MAX_INVALID_RATIO) -> DataFrame:
    """Groups whose invalid rows are more than `most` or more than the ratio."""
    sums = df.groupBy(*keys).agg(F.count("*").alias("input_records"), F.count_if(invalid).alias("invalid_records"))
    return sums.where((F.col("invalid_records") > most) | (F.col("invalid_records") > F.col("input_records") * ratio))


def count_mismatches(found: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """(key, declared, found) where the counts differ or one side is missing. found: rows; declared: (key, declared)."""
    counts = found.groupBy(key).agg(F.count("*").alias("found"))
    both = declared.join(counts, key, "full_outer").select(key, F.coalesce("declared", F.lit(0)).cast("long").alias("declared"), F.coalesce("found", F.lit(0)).cast("long").alias("found"))
    return both.where("declared <> found")
