"""Enrichment candidates, budgets, job plans, page-change evidence and stop rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayspark.functions.text import _c, present

DETAIL_FIELDS = ("price_value", "rating_text", "review_count_text", "star_rating_text")
LOW_YIELD, LOW_PAGES = 10, 2


def missing(fields: tuple[str, ...] | list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(present(f), 0).otherwise(1) for f in fields])


def needs_enrichment(url: str, fields: tuple[str, ...] = DETAIL_FIELDS, missing_only: bool = True) -> Column:
    return present(url) & ((missing(fields) > 0) if missing_only else F.lit(True))


def enrichment_candidates(df: DataFrame, limit: int, name: str, url: str, fields: tuple[str, ...] = DETAIL_FIELDS, critical: tuple[str, ...] | None = None, missing_only: bool = True, arrival: str | None = None) -> DataFrame:
    """Records that need detail pages, those that lack most first; 0 takes all. A limit runs as a top-k in every task. Of records
    that are equal in all that the ranking looks at, those that came first by `arrival` are taken."""
    critical = critical or fields
    text = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    ranked = df.where(needs_enrichment(url, critical, missing_only)).withColumns({"critical_missing": missing(critical), "fields_missing": missing(fields)})
    ordered = ranked.orderBy(F.desc("critical_missing"), F.desc("fields_missing"), text(name), text(url), *([F.col(arrival)] if arrival else []))
    return ordered.limit(limit) if limit > 0 else ordered


def budgeted(df: DataFrame, order: list[str], budget: int, used: int, needs: Column, status: str = "enrich_status") -> DataFrame:
    """Records within a budget of detail pages. Pending are those without a status that need one. A budget of 0 takes them all;
    else the first `budget - used` in order are taken, and with none left they are all skipped, with the reason. Others stay as
    they are. The last one taken is found by a top-k; rows that tie with it are numbered, so that no more are taken."""
    pending = ~present(status) & needs
    error = F.col("enrich_error") if "enrich_error" in df.columns else F.lit(None).cast("string")
    out = lambda taken, skipped: {"taken": taken, status: F.when(skipped, F.lit("skipped")).otherwise(F.col(status)), "enrich_error": F.when(skipped, F.lit("max_detail_pages_reached")).otherwise(error)}
    if budget <= 0:
        return df.withColumns(out(F.coalesce(pending, F.lit(False)), F.lit(False)))
    left = budget - used
    if left <= 0:
        return df.withColumns(out(F.lit(False), F.coalesce(pending, F.lit(False))))
    key = F.struct(*order)
    top = df.where(pending).select(key.alias("_key")).orderBy("_key").limit(left)
    last = top.groupBy("_key").count().agg(F.max("_key").alias("_last"), F.max_by("count", "_key").alias("_ties"))
    both = df.withColumn("_pending", F.coalesce(pending, F.lit(False))).join(F.broadcast(last))  # one row
    at = F.col("_pending") & (key == F.col("_last"))
    tied = both.where(at).withColumn("_n", F.row_number().over(Window.partitionBy("_last").orderBy(*order)))
    rest = both.where(~F.coalesce(at, F.lit(False))).withColumn("_n", F.lit(0))
    taken = F.col("_pending") & F.coalesce(F.when(F.col("_n") > 0, F.col("_n") <= F.col("_ties")).otherwise(key < F.col("_last")), F.lit(False))
    return rest.unionByName(tied).withColumns(out(taken, F.lit(False))).drop("_pending", "_last", "_ties", "_n")


def job_matrix(stays: DataFrame, destinations: DataFrame) -> DataFrame:
    """One job for each stay and destination: a product of two small plans."""
    return stays.crossJoin(F.broadcast(destinations))


def workers(df: DataFrame, ordinal: str, n: int) -> DataFrame:
    return df.withColumn("worker", F.pmod(F.col(ordinal), F.lit(n)).cast("int"))


def in_plan_order(results: DataFrame, plan: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return results.join(plan.select(*keys, ordinal), keys).orderBy(ordinal)


SEGMENTS, DRAWN = 64, 4096


def segmented(df: DataFrame, order: str) -> DataFrame:
    """df plus `_segment`: 0 to SEGMENTS, rising with `order` (nulls in 0) and of near equal sizes, so that a pass over all rows
    in order is one over each segment and a small one over segments. Its limits are quantiles of the DRAWN values of `order`
    with the least hashes; equal values share a segment. Only these come to the driver."""
    drawn = df.select(order).where(F.col(order).isNotNull()).distinct().orderBy(F.xxhash64(order), order).limit(DRAWN)
    values = sorted(r[0] for r in drawn.collect())
    limits = sorted({values[i * len(values) // SEGMENTS] for i in range(1, SEGMENTS)}) if values else []
    if not limits:
        return df.withColumn("_segment", F.lit(0))
    at = F.array(*[F.lit(v).cast(df.schema[order].dataType) for v in limits])
    return df.withColumn("_segment", F.size(F.filter(at, lambda v: v <= F.col(order))))


def _with_row_before(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """df plus `_before`, a struct of the columns in the row before, null in the first. The last row of each segment that has
    rows, at most SEGMENTS + 1 in all, is carried to the next one."""
    parts, w = segmented(df, order), Window.partitionBy("_segment").orderBy(order)
    row = F.struct(*columns)
    filled = sorted(r[0] for r in parts.select("_segment").distinct().collect())
    following = F.create_map(*[F.lit(x) for pair in zip(filled, filled[1:]) for x in pair]) if len(filled) > 1 else None
    inside = parts.withColumn("_before", F.lag(row).over(w))
    if following is None:
        return inside.drop("_segment")
    last = parts.groupBy("_segment").agg(F.max_by(row, order).alias("_carried")).select(following[F.col("_segment")].alias("_segment"), "_carried")
    return inside.join(last.where("_segment IS NOT NULL"), "_segment", "left").withColumn("_before", F.coalesce("_before", "_carried")).drop("_segment", "_carried")


def page_change(df: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """Evidence that a page differs from the one before it. Columns: url, active_page_text, first_identity, urls (array),
    scroll_after, scroll_before (of navigation). A page has changed if two signs show it, one of them in its content. Without
    `by` all rows are one crawl, passed over in segments; `order` then has no nulls and no ties to tell apart."""
    needed = ["url", "active_page_text", "first_identity", "urls", "scroll_after"]
    if by:
        paired = df.withColumn("_before", F.lag(F.struct(*needed)).over(Window.partitionBy(*by).orderBy(order)))
    else:
        paired = _with_row_before(df, order, needed)
    before = lambda c: F.col(f"_before.{c}")
    both = lambda c: (F.coalesce(before(c), F.lit("")) != "") & present(c)
    urls, last = F.array_sort(F.array_distinct("urls")), F.array_sort(F.array_distinct(before("urls")))
    signs = {
        "url_changed": ~before("url").eqNullSafe(F.col("url")),
        "active_page_changed": both("active_page_text") & (before("active_page_text") != F.col("active_page_text")),
        "first_changed": both("first_identity") & (before("first_identity") != F.col("first_identity")),
        "url_set_changed": F.coalesce((F.size(urls) > 0) & (F.size(last) > 0) & (urls != last), F.lit(False)),
        "scroll_reset": F.coalesce(F.col("scroll_before") < F.greatest(F.lit(100), F.floor(before("scroll_after") / 3)), F.lit(False)),
    }
    out = paired.where("_before IS NOT NULL").select(*df.columns, *[F.coalesce(v, F.lit(False)).alias(k) for k, v in signs.items()])
    count = reduce(lambda a, b: a + b, [F.col(k).cast("int") for k in signs])
    content = F.col("url_set_changed") | F.col("first_changed")
    return out.withColumns({"sign_count": count, "content_changed": content, "verified": (count >= 2) & content})


def _carried_runs(runs: DataFrame) -> dict[int, int]:
    """Low pages in a row at the end of all before each segment, from one row for each of at most SEGMENTS + 1 segments."""
    ends = runs.groupBy("_segment", "_run").agg(F.sum("_low").alias("_lows")).groupBy("_segment").agg(F.max("_run").alias("highs"), F.max_by("_lows", "_run").alias("lows"))
    carried, out = 0, {}
    for r in sorted(ends.collect()):
        out[r["_segment"]] = carried
        carried = r["lows"] + (0 if r["highs"] else carried)
    return out


def low_yield_stop(df: DataFrame, order: str, new: str, by: list[str] | None = None, least: int = LOW_YIELD, pages: int = LOW_PAGES) -> DataFrame:
    """df plus how many pages in a row had few new records, and whether the crawl stops there. Without `by` all rows are one
    crawl, passed over in segments: a run that began in earlier ones is carried into the next."""
    keys = by or ["_segment"]
    upto = lambda keys: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    flag = lambda c: F.when(c, 1).otherwise(0)
    runs = (df if by else segmented(df, order)).withColumn("_low", flag(F.col(new) < least)).withColumn("_run", F.sum(flag(F.col(new) >= least)).over(upto(keys)))
    low = F.sum("_low").over(upto([*keys, "_run"]))
    if not by and (carried := {k: v for k, v in _carried_runs(runs).items() if v}):
        begun = F.create_map(*[F.lit(x) for pair in carried.items() for x in pair])
        low = low + F.when(F.col("_run") == 0, F.coalesce(begun[F.col("_segment")], F.lit(0))).otherwise(0)
    counted = runs.withColumn("low_pages", low.cast("int")).select(*df.columns, "low_pages")
    return counted.withColumn("stop", F.col("low_pages") >= pages)


def scroll_stops(records: Column | str, unchanged: Column | str, no_scroll: Column | str, elapsed: Column | str, stable: int = 3, least: int = 100, cap: float = 240, cap_records: int = 60) -> Column:
    """Time is up with enough records, or nothing changed for `stable` rounds and there is enough or nowhere to scroll."""
    timed = (F.lit(cap) > 0) & (_c(elapsed) >= cap) & (_c(records) >= cap_records)
    return timed | ((_c(unchanged) >= stable) & ((_c(records) >= least) | (_c(no_scroll) >= stable)))
