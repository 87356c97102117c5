"""Identity, de-duplication and merging of records. "First" always follows a given order, so results don't depend on tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.text import _c, compact_text, none_if_empty, present
from stayspark.functions.urls import url_key


def first_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key: an aggregate that combines in every task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def latest_state(df: DataFrame, keys: list[str], at: str, tiebreak: list[str]) -> DataFrame:
    """The row of every key that was seen last; ties go to the least tiebreak. at: a time, a date or a number; nulls are oldest."""
    kind = df.schema[at].dataType.simpleString()
    value = F.unix_micros(F.col(at).cast("timestamp")) if kind.startswith("timestamp") else F.unix_date(at) if kind == "date" else F.col(at)
    return first_wins(df, keys, [F.col(at).isNull(), -value, *tiebreak])


def first_value(value: Column | str, order: Column | str) -> Column:
    """An aggregate: the first value in order that is neither null nor empty; it combines before the shuffle."""
    v = none_if_empty(value)
    return F.min_by(v, F.when(v.isNotNull(), _c(order)))


def fill_missing(df: DataFrame, keys: list[str], fields: list[str], order: Column | str) -> DataFrame:
    """One row a key: each field's first present value, in arrival order, and whether a later row filled one."""
    first = F.min_by(F.struct(*[none_if_empty(f).alias(f) for f in fields]), _c(order))
    merged = df.groupBy(*keys).agg(*[first_value(f, order).alias(f) for f in fields], first.alias("_first"), F.count("*").alias("merged_records"))
    changed = F.exists(F.array(*[F.col(f).isNotNull() & F.col(f"_first.{f}").isNull() for f in fields]), lambda c: c)
    return merged.withColumn("changed", changed).drop("_first")


def record_key(canonical_url: Column | str, url: Column | str, property_id: Column | str, name: Column | str, page: Column | str, index: Column | str, text: Column | str) -> Column:
    """What identifies a record: its URL, else its property, else its name, else its place and text."""
    trimmed = lambda c: F.trim(F.coalesce(_c(c), F.lit("")))
    last = F.concat_ws(":", F.lit("partial"), F.coalesce(_c(page).cast("string"), F.lit("0")), F.coalesce(_c(index).cast("string"), F.lit("None")), F.substring(F.lower(trimmed(text)), 1, 120))
    return (
        F.when(present(canonical_url), F.concat(F.lit("url:"), _c(canonical_url)))
        .when(present(url), F.concat(F.lit("url:"), url_key(url)))
        .when(trimmed(property_id) != "", F.concat(F.lit("property:"), trimmed(property_id)))
        .when(trimmed(name) != "", F.concat(F.lit("partial:"), F.lower(trimmed(name))))
        .otherwise(last)
    )


def partial_key(name: Column | str, text: Column | str, page: Column | str, index: Column | str) -> Column:
    """The key of a card without URL inside one snapshot."""
    source = F.coalesce(compact_text(text), _c(index).cast("string"))
    hashed = F.concat_ws(":", F.lit("partial"), _c(page).cast("string"), F.substring(F.sha1(source), 1, 16), _c(index).cast("string"))
    return F.when(present(name), F.concat(F.lit("partial:"), F.lower(F.coalesce(compact_text(name), F.lit(""))), F.lit("|page:"), _c(page).cast("string"))).otherwise(hashed)


def promoted(df: DataFrame, key: str, property_id: str, name: str) -> DataFrame:
    """df plus `identity`: records without URL take the key of the URL record with their property, else with their name.

    Where several URL records share a property or name, the least key takes them. Both lookups are sums by key, joined back."""
    prop, named = none_if_empty(F.trim(property_id)), none_if_empty(F.lower(F.trim(name)))
    urls = df.where(F.col(key).startswith("url:"))
    by_property = urls.where(prop.isNotNull()).groupBy(prop.alias("_p")).agg(F.min(key).alias("_by_property"))
    by_name = urls.where(named.isNotNull()).groupBy(named.alias("_n")).agg(F.min(key).alias("_by_name"))
    joined = df.withColumn("_p", prop).withColumn("_n", named).join(by_property, "_p", "left").join(by_name, "_n", "left")
    identity = F.when(F.col(key).startswith("url:"), F.col(key)).otherwise(F.coalesce("_by_property", "_by_name", key))
    return joined.withColumn("identity", identity).drop("_p", "_n", "_by_property", "_by_name")


def merged_identities(df: DataFrame, key: str, property_id: str, name: str, fields: list[str], order: str) -> DataFrame:
    """One row an identity; a URL record's own values go first."""
    ranked = F.struct(F.when(F.col(key).startswith("url:"), 0).otherwise(1).alias("kind"), F.col(order).alias("at"))
    return fill_missing(promoted(df, key, property_id, name).withColumn("_order", ranked), ["identity"], fields, "_order")


def live_keys(df: DataFrame, key: str, property_id: str, name: str, order: str) -> DataFrame:
    """(key): record keys that are there after all arrivals. A URL record that is new takes the records of its name and of
    its property away; one that comes after it is a record again. Two aggregates and a join."""
    named, prop = none_if_empty(F.lower(F.trim(name))), none_if_empty(F.trim(property_id))
    urls = df.where(F.col(key).startswith("url:")).groupBy(key).agg(F.min(order).alias("_at"), F.min_by(F.struct(named.alias("n"), prop.alias("p")), order).alias("_own"))
    taken = urls.select("_at", F.explode(F.array(F.concat(F.lit("partial:"), "_own.n"), F.concat(F.lit("property:"), "_own.p"))).alias(key)).where(F.col(key).isNotNull())
    taken = taken.groupBy(key).agg(F.max("_at").alias("_at"))
    others = df.where(~F.col(key).startswith("url:")).groupBy(key).agg(F.max(order).alias("_last"))
    left = others.join(taken, key, "left").where(F.col("_at").isNull() | (F.col("_last") > F.col("_at")))
    return urls.select(key).unionByName(left.select(key))


def new_records(before: DataFrame, page: DataFrame, key: str, property_id: str, name: str, order: str) -> DataFrame:
    """(new_records): by how many a page changes the number of records; negative where its URL records absorb more than come."""
    early = before.select(key, property_id, name, F.struct(F.lit(0).alias("page"), F.col(order).alias("at")).alias("_order"))
    late = page.select(key, property_id, name, F.struct(F.lit(1).alias("page"), F.col(order).alias("at")).alias("_order"))
    count = lambda d: live_keys(d, key, property_id, name, "_order").agg(F.count("*").alias("k"))
    both = count(early.unionByName(late)).select(F.lit(1).alias("sign"), "k").unionByName(count(early).select(F.lit(-1).alias("sign"), "k"))
    return both.agg(F.sum(F.col("sign") * F.col("k")).alias("new_records"))


def page_records(df: DataFrame, page_keys: DataFrame, key: str, order: str) -> DataFrame:
    """Records whose key a page has, each once."""
    return first_wins(df.join(page_keys.select(key), key, "left_semi"), [key], [order])


def url_union(df: DataFrame, keys: list[str], urls: str, order: str) -> DataFrame:
    """All candidate URLs of a key in order of arrival, each once."""
    each = df.select(*keys, order, F.posexplode(urls).alias("_i", "_url"))
    first = each.groupBy(*keys, "_url").agg(F.min(F.struct(F.col(order).alias("o"), F.col("_i").alias("i"))).alias("_at"))
    ordered = F.array_sort(F.collect_list(F.struct("_at", "_url")))
    return first.groupBy(*keys).agg(F.transform(ordered, lambda x: x["_url"]).alias(urls))
