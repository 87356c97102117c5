import pytest
from pyspark.sql import functions as F

from stayspark.functions import text
from stayspark.operators import aggregates, cards, identity, ranking, records, rules
from stayspark.streaming import bronze as streams


def test_embedded_urls_and_shells(spark):
    html = '<a href="/x/hotel/a.html">A</a> {"url": "\\/y\\/hotel\\/b.html?a=1&amp;b=2"} see https://z.com/vn/hotel/c.html <a href="/x/hotel/a.html">again</a> <a href="/x/hotel/d">no</a> /en-us/q\\u002Fhotel/e.HTML'
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(cards.embedded_urls("html").alias("u")).first()["u"] == ["https://z.com/vn/hotel/c.html", "/en-us/q/hotel/e.HTML", "/x/hotel/a.html", "/y/hotel/b.html?a=1&b=2", "//z.com/vn/hotel/c.html"]
    assert df.select(cards.embedded_urls("html", "other.com").alias("u")).first()["u"][0] == "/en-us/q/hotel/e.HTML"
    shells = spark.createDataFrame([(2, 21), (3, 21), (2, 20)], "c int, l int")
    assert [r[0] for r in shells.select(cards.is_landing_shell(F.col("c"), F.col("l"))).collect()] == [True, False, False]


def test_keys_and_joins(spark):
    df = spark.createDataFrame([(" A  b ", "t", 1, 2), (None, "t", 1, 2), ("", None, 1, 2)], "n string, t string, p int, i int")
    keys = [r[0] for r in df.select(identity.partial_key("n", "t", "p", "i")).collect()]
    assert keys[0] == "partial:a b|page:1"
    assert keys[1].startswith("partial:1:")
    assert keys[1].endswith(":2")
    assert keys[1] != keys[2]
    rows = spark.createDataFrame([("k1", 2), ("k1", 1), ("k2", 1)], "key string, at int")
    got = identity.page_records(rows, spark.createDataFrame([("k1",)], "key string"), "key", "at").collect()
    assert [tuple(r) for r in got] == [("k1", 1)]


def test_record_counts_follow_absorption(spark):
    schema = "key string, name string, prop string, at int"
    before = spark.createDataFrame([("partial:a", "A", None, 1), ("property:7", "B", "7", 2), ("url:x", "X", None, 3)], schema)
    count = lambda rows: identity.new_records(before, spark.createDataFrame(rows, schema), "key", "prop", "name", "at").first()[0]
    assert count([("url:y", "a ", "7", 1)]) == -1
    assert count([("url:y", "a", "7", 1), ("partial:a", "A", None, 2)]) == 0
    assert count([("url:x", "a", "7", 1)]) == 0
    assert count([("partial:c", "C", None, 1), ("partial:c", "C", None, 2)]) == 1


def test_links_of_all_kinds(spark):
    html = """<!-- <a href="/no/hotel/x">n</a> --><A class='c > d' HREF='/a/hotel/the-song.html?x=1&amp;y=2'><b>The</b> <i>Song</i></A><a href=/a/hotel/b title="From title"><img></a>
    <a aria-label="Label" title="T" href="/a/hotel/c"> </a><a href="/a/hotel/o'neil-house/"></a><a data-x="1" href="/city">City</a><a href="/A/hotel/the-song.html">again</a>"""
    df = spark.createDataFrame([(1, "https://h.com/p/q", html)], "page int, url string, html string")
    got = [tuple(r) for r in cards.property_links(df, "html", "url", ["page"]).orderBy("position").select("hotel_url", "hotel_name").collect()]
    assert got == [("https://h.com/a/hotel/the-song.html?x=1&y=2", "The Song"), ("https://h.com/a/hotel/b", "From title"), ("https://h.com/a/hotel/c", "Label"), ("https://h.com/a/hotel/o'neil-house/", "A")]


def test_detail_pages(spark):
    html = '<html><body><h1>Sea <i>Inn</i></h1><div data-testid="x-review-score">9,1/10 of 12 reviews</div><span aria-label="4 stars out of 5"></span><b data-selenium="display-price">ask</b><p>VND 1.200.000 per night 8/10</p></body></html>'
    bare = "<p>7,5/10 | 3 reviews | 2 sao tren 5 | 900.000 VND</p>"
    df = spark.createDataFrame([(html,), (bare,)], "html string").select(cards.detail_page("html").alias("d")).select("d.*")
    assert [tuple(r) for r in df.collect()] == [("Sea Inn", "1200000", "9.1", "12", "4 stars"), (None, "900000", "7.5", "3", "2 stars")]


def test_appends_by_several_writers(spark, tmp_path):
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    folders = {records.append_json_lines(x, f"{tmp_path}/log") for x in (a, b)}
    assert len(folders) == 2
    assert sorted(r[0] for r in records.read_json_lines(spark, f"{tmp_path}/log").collect()) == ['{"k":1}', '{"k":2}', '{"k":3}']


def test_folds_of_other_scripts(spark):
    got = spark.createDataFrame([("Й é e\u0301 ｱ がｶﾞ Ǆ Đà",)], "t string").select(text.ascii_fold("t")).first()[0]
    assert got.startswith("И e e ")
    assert got.endswith(" Da")




def test_card_field_precedence(spark):
    df = spark.createDataFrame([("7", "1.000.000 ₫ 8,9/10"), ("", "1.000.000 ₫ 8,9/10")], "p string, t string")
    got = [r[0]["price_value"] for r in df.select(text.card_fields({"price_value": F.col("p")}, "t")).collect()]
    assert got == ["7", "1000000"]


def test_sums_and_splits(spark):
    manifests = spark.createDataFrame([([(3,), (4,)],), ([(1,)],)], "stays array<struct<publishable_records:int>>")
    assert aggregates.declared_total(manifests).first()[0] == 8
    found = spark.createDataFrame([("a",), ("a",), ("c",)], "file string")
    declared = spark.createDataFrame([("a", 2), ("b", 1)], "file string, declared long")
    assert sorted(map(tuple, rules.count_mismatches(found, declared, "file").collect())) == [("b", 1, 0), ("c", 0, 1)]
    record = text.annotated(["x"], F.lit("Vũng Tàu"), F.lit("2026-06-10"), F.lit("2026-06-11"))
    assert spark.createDataFrame([(1,)], "x int").select(*record).first().asDict() == {"x": 1, "destination": "Vũng Tàu", "normalized_destination": "Vung Tau", "check_in": "2026-06-10", "check_out": "2026-06-11"}
    plan = spark.createDataFrame([("b", 1), ("a", 0)], "job string, ordinal int")
    assert [r["job"] for r in ranking.in_plan_order(plan.select("job"), plan, ["job"], "ordinal").collect()] == ["a", "b"]


def test_streams_with_watermarks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-06-01 00:10:00"), ("a", "2026-06-01 00:10:00"), ("b", "2026-06-01 00:50:00"), ("c", "2026-06-01 09:00:00")], "k string, at string").select("k", F.to_timestamp("at").alias("at"))
    rows.write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = streams.deduplicated(source, ["k"], "at").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.table("once").collect()) == ["a", "b", "c"]
    q = streams.windowed_counts(source, "at", []).writeStream.format("memory").queryName("hours").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["records"] for r in spark.table("hours").collect()] == [3]
    slid = streams.windowed_counts(rows, "at", [], "1 hour", slide="30 minutes").orderBy("window.start").collect()
    assert [(r["window"]["start"].minute, r["records"]) for r in slid][:3] == [(30, 2), (0, 3), (30, 1)]
    q = streams.session_counts(source, "at", ["k"], "1 hour").writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["k"], r["records"]) for r in spark.table("sessions").collect()) == [("a", 2), ("b", 1)]


def test_rows_without_timing_are_no_jobs(spark):
    rows = [("a", 1, 10.0, 1.0, 2.0, 3.0, 2), ("a", 1, 10.0, 5.0, 1.0, 1.0, 1), ("b", 1, None, None, None, None, 3)]
    df = spark.createDataFrame(rows, "destination string, check_in int, total_seconds double, search_seconds double, listing_seconds double, detail_seconds double, at int")
    first = aggregates.timing_rollup(df, order="at").first()
    assert (first["jobs"], first["search_seconds"], first["listing_seconds"], first["job_total_seconds"]) == (1, 5.0, 1.0, 10.0)
    assert aggregates.timing_rollup(df).first()["jobs"] == 1


def test_ties_of_candidates_go_to_the_first_arrival(spark):
    df = spark.createDataFrame([("x", "u", None, 3), ("x", "u", None, 1), ("x", "u", None, 2)], "name string, url string, price string, at int")
    got = ranking.enrichment_candidates(df, 2, "name", "url", fields=("price",), arrival="at").collect()
    assert [r["at"] for r in got] == [1, 2]


@pytest.mark.parametrize("n", [0, 1, 3, 500])
def test_one_long_crawl_in_segments_equals_a_plain_pass(spark, n):
    import random

    rand = random.Random(n)
    new = [rand.choice([0, 3, 9, 10, 40, None]) if i % 200 < 100 else rand.choice([1, 2]) for i in range(n)]
    rows = [(i * 3, new[i], rand.choice("ab"), rand.choice(["", "x", "y"]), [rand.choice("pq")]) for i in range(n)]
    rand.shuffle(rows)
    df = spark.createDataFrame(rows, "at int, new int, url string, first_identity string, urls array<string>").withColumns({"active_page_text": F.lit(None).cast("string"), "scroll_after": F.lit(900), "scroll_before": F.lit(200), "one": F.lit(1)})
    low, want = 0, {}
    for i, k in enumerate(new):
        low = low if k is None else 0 if k >= 10 else low + 1
        want[i * 3] = (low, low >= 2)
    stops = ranking.low_yield_stop(df, "at", "new")
    assert {r["at"]: (r["low_pages"], r["stop"]) for r in stops.collect()} == want
    assert stops.columns == [*df.columns, "low_pages", "stop"]
    changes, plain = ranking.page_change(df, "at"), ranking.page_change(df, "at", ["one"])
    assert changes.columns == plain.columns
    assert sorted(map(tuple, changes.collect())) == sorted(map(tuple, plain.collect()))
    for out in (stops, changes) if n > 3 else ():
        assert "SinglePartition" not in out._jdf.queryExecution().toString()


def test_median_of_many_prices_is_exact(spark):
    """More rows than the sketch is exact for; groups without date or price stay."""
    from stayspark.operators import aggregates

    n = 60_001
    rows = spark.range(n).selectExpr("CASE WHEN id % 2 = 0 THEN DATE'2026-06-01' END AS check_in_date", "'A' AS destination", "CAST(4 AS DECIMAL(2,1)) AS star_rating", "CAST(id * 7919 % 60001 AS DECIMAL(18,0)) AS price_amount", "CAST(8 AS DECIMAL(3,1)) AS rating")
    none = spark.sql("SELECT DATE'2026-06-02' AS check_in_date, 'A' AS destination, CAST(4 AS DECIMAL(2,1)) AS star_rating, CAST(NULL AS DECIMAL(18,0)) AS price_amount, CAST(8 AS DECIMAL(3,1)) AS rating")
    got = {str(r.check_in_date): (r.observations, r.median_price_amount) for r in aggregates.price_by_star(rows.unionByName(none)).collect()}
    middle = lambda k: sorted(i * 7919 % n for i in range(n) if i % 2 == k)
    assert got == {"2026-06-01": (30001, middle(0)[15000]), "None": (30000, middle(1)[14999]), "2026-06-02": (1, None)}
