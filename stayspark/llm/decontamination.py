"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, their units and names (capitalised words inside a sentence) become typed placeholders, the rest lower-case words.
Every run of WINDOW places is hashed; windows of documents are hash-joined with those of benchmark items. Matches of a document
and an item that lie on one diagonal (equal distance of places) are one reading of the item. Its slots must be consistent: an
item's value must always stand for the same value in the document, and different values for different ones. A document is
contaminated by an item if consistent readings cover at least SHARE of the item's windows; it is a re-parameterised copy if a
slot's value differs. So a question with other numbers or names is caught, and one with another pattern of values is not.

Marks inside texts: U+0001 name, U+0002 number, U+0003 unit (empty where a number has none).

Defined results: null and empty texts match nothing; items of fewer than WINDOW places are matched as a whole, those of fewer
than LEAST places never; rows with equal doc_id are one document, and items with equal item_id one item (their windows are joined);
repeated rows change nothing; an empty table on either side gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import table

WINDOW = 8
LEAST = 4
SHARE = 0.25
BROADCAST_ROWS = 200_000  # about 20 MB; beyond it the windows are joined in a shuffle
# Units that may follow a number.
UNITS = (
    "%", "€", "$", "£", "km", "m", "cm", "mm", "mi", "miles", "feet", "ft", "inches", "kg", "g", "mg", "lb", "lbs", "pounds", "tons", "l", "ml", "litres", "liters",
    "hours", "hour", "h", "minutes", "minute", "min", "seconds", "second", "s", "days", "day", "weeks", "week", "months", "month", "years", "year",
    "dollars", "dollar", "cents", "euros", "euro", "percent", "degrees", "mph", "kmh", "kg/m", "m/s", "km/h",
)
_UNIT = "|".join(u.replace("$", r"\$") for u in sorted(UNITS, key=lambda u: (-len(u), u)))
NAME = r"\p{Lu}(?<=[\p{Ll},;] .)\p{L}+"
NUMBER = rf"([0-9]+(?:[.,:][0-9]+)*)(?:[ ]?({_UNIT})(?![\p{{L}}\p{{N}}]))?"
GAP = r"(?:[^\p{L}\p{N}\x01\x02\x03.,:]|[.,:](?![0-9]))+"


def marked(text: Column) -> Column:
    """Text with marks before names, numbers and units, lower-case."""
    names = F.regexp_replace(F.coalesce(text, F.lit("")), NAME, "\x01$0")
    return F.lower(F.regexp_replace(names, NUMBER, " \x02$1 \x03$2 "))


def places(text: Column) -> Column:
    """Words and marked values in order; the first and last may be empty."""
    return F.split(marked(text), GAP)


def is_slot(place: Column) -> Column:
    return (place < "\x04") & (place != "")


def slots(of: str) -> Column:
    """(place, value) of every slot; the value begins with its mark."""
    found = F.transform(F.col(of), lambda x, i: F.when(is_slot(x), F.struct(i.alias("at"), x.alias("value"))))
    return F.when(F.exists(F.col(of), is_slot), F.filter(found, lambda x: x.isNotNull()))


def hashes(df: DataFrame, of: str, n: int, to: str) -> DataFrame:
    """df plus the hashes of every n places that follow each other; the last n - 1 have null parts and match nothing.

    Windows are put together from shorter ones: n = 8 takes three steps, each in a column of its own, so that it is made once.
    """
    df = df.withColumn(f"{to}_1", F.transform(F.col(of), lambda x: F.xxhash64(F.when(is_slot(x), F.substring(x, 1, 1)).otherwise(x))))
    size, at, parts = 1, f"{to}_1", [f"{to}_1"]
    while size < n:
        step = min(size, n - size)
        new = f"{to}_{size + step}"
        df = df.withColumn(new, F.zip_with(F.col(at), F.slice(F.col(at), step + 1, 1 << 30), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))))
        size, at = size + step, new
        parts.append(new)
    return df.withColumnRenamed(at, to).drop(*[p for p in parts if p != at])


def items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, places, slots) of items that have enough places."""
    made = benchmark.select(F.col(id_col).alias("item_id"), F.filter(places(F.col(text_col)), lambda x: x != "").alias("places"))
    return made.where(F.size("places") >= LEAST).withColumn("item_slots", slots("places"))


def windows(df: DataFrame, keys: list[str], of: str, n: int) -> DataFrame:
    """One row for each whole window of n places: keys, hash and place."""
    # The outer form, since Spark infers a filter for the other one, and pushing it down would compute the hashes many times.
    made = hashes(df, of, n, "hash").select(*keys, F.posexplode_outer("hash").alias("at", "hash"))
    return made.where(F.col("hash").isNotNull())


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id, doc_at, item_at, doc_slots, item_slots, length) of every window that a document and an item share."""
    item = items(benchmark)
    lengths = sorted({window} | {r[0] for r in item.where(F.size("places") < window).select(F.size("places")).distinct().collect()})
    own = docs.select(F.col(id_col).alias("doc_id"), places(F.col(text_col)).alias("places")).where(F.col("doc_id").isNotNull()).withColumn("doc_slots", slots("places"))
    out = None
    for n in lengths:
        side = windows(item.where(F.size("places") >= window if n == window else F.size("places") == n), ["item_id", "item_slots"], "places", n).withColumnRenamed("at", "item_at")
        own_side = windows(own, ["doc_id", "doc_slots"], "places", n).withColumnRenamed("at", "doc_at")
        if side.count() <= broadcast_rows:
            side = F.broadcast(side)
        else:  # rows are shuffled: each takes along the slots of its own window only
            own_side = own_side.withColumn("doc_slots", F.filter("doc_slots", lambda s, n=n: (s["at"] >= F.col("doc_at")) & (s["at"] < F.col("doc_at") + n)))
        found = own_side.join(side, "hash").drop("hash").withColumn("length", F.lit(n))
        out = found if out is None else out.unionByName(found)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE, **columns) -> DataFrame:
    """(doc_id, item_id, item_windows, matched_windows, coverage, slots, changed_slots) of contaminated documents."""
    shared = matches(docs, benchmark, window, **columns)
    inside = lambda s, at: (s["at"] >= F.col(at)) & (s["at"] < F.col(at) + F.col("length"))
    pairs = F.flatten(
        F.transform(
            F.filter("item_slots", lambda s: inside(s, "item_at")),
            lambda s: F.transform(
                F.filter("doc_slots", lambda d: inside(d, "doc_at") & (d["at"] - F.col("doc_at") == s["at"] - F.col("item_at"))),
                lambda d: F.struct(s["value"].alias("item"), d["value"].alias("doc")),
            ),
        )
    )
    reading = (
        shared.withColumn("pairs", F.coalesce(pairs, F.array().cast("array<struct<item:string,doc:string>>")))
        .groupBy("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal"))
        .agg(F.collect_set("item_at").alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    )
    distinct = lambda field: F.size(F.array_distinct(F.transform("pairs", lambda p: p[field])))
    consistent = reading.where((F.size("pairs") == distinct("item")) & (F.size("pairs") == distinct("doc")))
    found = consistent.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("matched_windows"),
        F.max(F.size("pairs")).cast("long").alias("slots"),
        F.max(F.size(F.filter("pairs", lambda p: p["item"] != p["doc"]))).cast("long").alias("changed_slots"),
    )
    size = items(benchmark).groupBy("item_id").agg(F.max(F.greatest(F.size("places") - window + 1, F.lit(1))).cast("long").alias("item_windows"))
    return (
        found.join(size, "item_id")
        .where(F.col("matched_windows") >= share * F.col("item_windows"))
        .select("doc_id", "item_id", "item_windows", "matched_windows", F.round(F.col("matched_windows") / F.col("item_windows"), 4).alias("coverage"), "slots", "changed_slots")
    )


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_NAMED = rf"regexp_replace(regexp_replace(coalesce(text, ''), '([\p{{Ll}},;] )(\p{{Lu}}\p{{L}}+)', '\1' || chr(1) || '\2', 'g'), '([\p{{Ll}},;] )(\p{{Lu}}\p{{L}}+)', '\1' || chr(1) || '\2', 'g')"
_SQL_UNIT = _UNIT.replace("'", "''")
_SQL_MARKED = rf"lower(regexp_replace(regexp_replace({_SQL_NAMED}, '([0-9]+(?:[.,:][0-9]+)*)(?:[ ]?({_SQL_UNIT})([^\p{{L}}\p{{N}}]|$))', ' ' || chr(2) || '\1 ' || chr(3) || '\2 \3', 'g'), '(^|[^0-9.,:{{M}}])([0-9]+(?:[.,:][0-9]+)*)', '\1 ' || chr(2) || '\2 ' || chr(3) || ' ', 'g'))".replace("{M}", "\x02")
_SQL_PLACES = rf"list_filter(string_split_regex(regexp_replace({_SQL_MARKED}, '[.,:]+([^0-9.,:]|$)', ' \1', 'g'), '[^\p{{L}}\p{{N}}\x01\x02\x03.,:]+'), lambda x: x <> '')"
#: For items of at least WINDOW places; windows are compared as texts instead of hashes.
SQL = rf"""
WITH d AS (SELECT doc_id, {_SQL_PLACES} AS p FROM documents),
b AS (SELECT item_id, p FROM (SELECT item_id, {_SQL_PLACES} AS p FROM benchmark) WHERE len(p) >= {WINDOW}),
dw AS (SELECT doc_id, p, unnest(range(1, len(p) - {WINDOW} + 2)) AS k FROM d WHERE len(p) >= {WINDOW}),
bw AS (SELECT item_id, p, unnest(range(1, len(p) - {WINDOW} + 2)) AS k FROM b),
ds AS (SELECT doc_id, k, p[k : k + {WINDOW - 1}] AS v, array_to_string(list_transform(p[k : k + {WINDOW - 1}], lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE x END), ' ') AS w FROM dw),
bs AS (SELECT item_id, k, p[k : k + {WINDOW - 1}] AS v, array_to_string(list_transform(p[k : k + {WINDOW - 1}], lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE x END), ' ') AS w FROM bw),
m AS (SELECT DISTINCT doc_id, item_id, ds.k - bs.k AS diagonal, bs.k AS item_at, ds.v AS dv, bs.v AS bv FROM ds JOIN bs USING (w)),
s AS (SELECT DISTINCT doc_id, item_id, diagonal, bv[i] AS a, dv[i] AS c FROM (SELECT *, unnest(range(1, {WINDOW + 1})) AS i FROM m) WHERE bv[i] < chr(4)),
q AS (SELECT doc_id, item_id, diagonal, count(*) AS n, count(DISTINCT a) AS na, count(DISTINCT c) AS nc, count(*) FILTER (WHERE a <> c) AS changed FROM s GROUP BY ALL),
r AS (SELECT m.doc_id, m.item_id, m.item_at, coalesce(q.n, 0) AS n, coalesce(q.changed, 0) AS changed FROM m LEFT JOIN q USING (doc_id, item_id, diagonal) WHERE q.n IS NULL OR (q.n = q.na AND q.n = q.nc)),
z AS (SELECT item_id, max(len(p)) - {WINDOW} + 1 AS item_windows FROM b GROUP BY item_id)
SELECT doc_id, item_id, CAST(item_windows AS BIGINT) AS item_windows, count(DISTINCT item_at) AS matched_windows,
       round(count(DISTINCT item_at) / item_windows, 4) AS coverage, CAST(max(n) AS BIGINT) AS slots, CAST(max(changed) AS BIGINT) AS changed_slots
FROM r JOIN z USING (item_id) GROUP BY doc_id, item_id, item_windows HAVING count(DISTINCT item_at) >= {SHARE} * item_windows
"""
