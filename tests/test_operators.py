import pytest
from pyspark.sql import functions as F

from stayspark.operators import aggregates, cards, identity, ranking, records, rules
from stayspark.plans.jobs import jobs
from stayspark.sources.contract import load_contract, parse_contract

GOOD = {"hotel_name": "Demo", "hotel_url": "https://x/hotel/y", "price_value": "1000000", "rating_text": "8.5", "review_count_text": "1.357", "star_rating_text": "4 stars", "crawled_at": "2026-06-03T00:00:00+00:00", "destination": "A", "normalized_destination": "A", "check_in": "2026-06-10", "check_out": "2026-06-11"}


def offers(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], load_contract().schema)


@pytest.mark.parametrize(
    ("change", "failed"),
    [
        ({}, []),
        ({"hotel_name": " "}, ["required_hotel_name"]),
        ({"hotel_name": "\t"}, []),
        ({"hotel_url": "ftp://x"}, ["invalid_hotel_url"]),
        ({"price_value": "free"}, ["invalid_price_value"]),
        ({"price_value": "0"}, ["invalid_price_value"]),
        ({"price_value": "9" * 19}, ["invalid_price_value"]),
        ({"crawled_at": "yesterday"}, ["invalid_crawled_at"]),
        ({"check_in": "soon"}, ["invalid_check_in"]),
        ({"check_out": "2026-06-10"}, ["check_out_not_after_check_in"]),
        ({"check_out": None}, ["required_check_out"]),
        ({"hotel_url": None, "check_in": "", "rating_text": "bad"}, ["required_hotel_url", "required_check_in"]),
    ],
)
def test_rules(spark, change, failed):
    assert rules.validated(offers(spark, change), load_contract()).first()["failed_rules"] == failed


def test_defaults_and_types(spark):
    df = rules.typed(rules.valid_rows(rules.validated(offers(spark, {"rating_text": "good", "review_count_text": "none", "star_rating_text": "9 stars"}, {"rating_text": "", "review_count_text": None, "star_rating_text": None}, {"rating_text": "8,55"}), load_contract())))
    got = [(None if r["rating"] is None else float(r["rating"]), r["review_count"], None if r["star_rating"] is None else float(r["star_rating"]), int(r["price_amount"])) for r in df.collect()]
    assert got == [(0.0, 0, 0.0, 1000000), (None, None, None, 1000000), (8.6, 1357, 4.0, 1000000)]


@pytest.mark.parametrize("bad", ["[]", "version: 1", "version: '1'\nvalidation_layer: gold", "version: '1'\nvalidation_layer: silver\nfields: {A: {type: string, required: true}}", "version: '1'\nvalidation_layer: silver\nfields: {a: {type: int, required: true}}", "version: '1'\nvalidation_layer: silver\nfields: {a: {type: string, required: 1}}", "version: '1'\nvalidation_layer: silver\nfields: {a: {type: string, required: true, format: zip}}", "version: '1'\nvalidation_layer: silver\nfields: {a: {type: string, required: true}}\ncross_field_rules: [x]"])
def test_bad_contracts(bad):
    with pytest.raises(ValueError, match="contract"):
        parse_contract(bad)


def test_gates():
    assert not rules.too_many_invalid(10, 1)
    assert rules.too_many_invalid(10, 2)
    assert rules.too_many_invalid(10**6, 201)
    assert not rules.too_many_invalid(0, 0)


def test_coverage_is_strict(spark):
    df = spark.createDataFrame([("x" if k else "",) for k in range(10)], "a string")
    assert aggregates.coverage(df, ["a"]).first()["coverage_pct"] == 90.0
    assert aggregates.coverage_gate(df, ["a"]).first()[0] == "warning"
    assert aggregates.coverage_gate(df.where("a <> ''"), ["a"]).first()[0] == "ok"
    assert aggregates.coverage(df.limit(0), ["a"]).first()["coverage_pct"] == 0.0


def test_nearest_rank(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0, 4.0],), ([],)], "v array<double>")
    assert [tuple(r) for r in df.select(aggregates.nearest_rank(F.col("v"), 50), aggregates.nearest_rank(F.col("v"), 95)).collect()] == [(3.0, 4.0), (0.0, 0.0)]
    rows = spark.createDataFrame([("a", float(k)) for k in (3, 1, 2, 4)] + [("b", 7.0), ("b", None)], "k string, v double")
    got = {r["k"]: (r["n"], r["p50"], r["p95"]) for r in aggregates.percentiles(rows, ["k"], "v").collect()}
    assert got == {"a": (4, 3.0, 4.0), "b": (1, 7.0, 7.0)}


def test_fill_missing_and_promotion(spark):
    df = spark.createDataFrame([("url:1", "7", "Song", "", "1000", 3), ("property:7", "7", None, "8.7", "5", 1), ("partial:song", None, " SONG ", "9", None, 2), ("partial:other", None, "Other", None, None, 4)], "k string, p string, name string, rating string, price string, at int")
    got = {r["identity"]: r for r in identity.merged_identities(df, "k", "p", "name", ["rating", "price"], "at").collect()}
    assert set(got) == {"url:1", "partial:other"}
    assert (got["url:1"]["rating"], got["url:1"]["price"], got["url:1"]["changed"], got["url:1"]["merged_records"]) == ("8.7", "1000", True, 3)
    assert got["partial:other"]["changed"] is False


def test_url_union_keeps_order(spark):
    df = spark.createDataFrame([("a", 2, ["x", "z"]), ("a", 1, ["y", "x"])], "k string, at int, urls array<string>")
    assert identity.url_union(df, ["k"], "urls", "at").first()["urls"] == ["y", "x", "z"]


def test_jobs_and_stops(spark):
    got = [tuple(map(str, r)) for r in jobs(spark, ["2026-06-01", "02/06/2026"], ["A", "B", "C"], 2).orderBy("ordinal").collect()]
    assert [(r[0], r[1], r[2], r[4]) for r in got][:4] == [("2026-06-01", "2026-06-02", "A", "0"), ("2026-06-01", "2026-06-02", "B", "1"), ("2026-06-01", "2026-06-02", "C", "0"), ("2026-06-02", "2026-06-03", "A", "1")]
    pages = spark.createDataFrame([(1, 10), (2, 9), (3, 12), (4, 0), (5, 9), (6, 3)], "page int, new int")
    assert [r["stop"] for r in ranking.low_yield_stop(pages, "page", "new").orderBy("page").collect()] == [False, False, False, False, True, True]
    cases = spark.createDataFrame([(60, 0, 0, 240.0), (59, 0, 0, 240.0), (100, 3, 0, 1.0), (10, 3, 3, 1.0), (10, 3, 2, 1.0), (100, 2, 9, 1.0)], "n int, u int, s int, t double")
    assert [r[0] for r in cases.select(ranking.scroll_stops("n", "u", "s", "t")).collect()] == [True, False, True, True, False, False]
    rows = spark.createDataFrame([(1, None, True), (1, None, True), (1, None, True), (2, None, True), (0, "success", True), (0, None, False)], "k int, enrich_status string, needs boolean")
    taken = lambda budget, used: sorted((r["k"], r["enrich_status"], r["taken"]) for r in ranking.budgeted(rows, ["k"], budget, used, F.col("needs")).where("needs and coalesce(enrich_status, '') != 'success'").collect())
    assert [t for _, _, t in taken(1, 0)].count(True) == 1
    assert [t for _, _, t in taken(5, 2)] == [True, True, True, False] or [t for _, _, t in taken(5, 2)].count(True) == 3
    assert [t for _, _, t in taken(0, 9)] == [True] * 4
    assert {(s, t) for _, s, t in taken(3, 3)} == {("skipped", False)}
    assert [t for _, _, t in taken(9, 0)] == [True] * 4


def test_cards_are_assembled(spark):
    columns = "name string, text string, data_selenium string, data_test_id string, class_name string, tag_name string, source_selector string, property_id string, outer_html_preview string, urls array<string>, page int, card_index int"
    rows = [
        ("Song", "1.155.203 ₫ 8,9/10", None, None, None, "div", "div", "5", None, ["/a/hotel/b.html?cid=2", "/nothing"], 1, 0),
        ("Song", "12 reviews", None, None, None, "div", "div", "5", None, ["/a/hotel/b.html"], 1, 1),
        ("Hotel (12)", "x", None, None, None, "div", "div", None, None, [], 1, 2),
        (None, "Open Sea Inn in new tab", None, None, None, "article", "article", None, None, [], 1, 3),
        ("Slide", "x", None, None, "swiper-slide", "li", "li", None, None, [], 1, 4),
    ]
    got = {r["record_kind"]: r for r in cards.assembled(spark.createDataFrame(rows, columns), "https://h.com/").collect()}
    assert set(got) == {"full_record", "partial_record"}
    full = got["full_record"]
    assert (full["hotel_url"], full["price_value"], full["rating_text"], full["review_count_text"], full["cards"], full["collect_status"]) == ("https://h.com/a/hotel/b.html", "1155203", "8.9", "12", 2, "ok")
    assert (got["partial_record"]["hotel_name"], got["partial_record"]["collect_status"]) == ("Sea Inn", "missing_url")


def test_published_records(spark, tmp_path):
    df = spark.createDataFrame([("A", "u", "1", "debug"), ("B", "", "2", "x"), (None, "u", None, "y")], "hotel_name string, hotel_url string, price_value string, _debug string")
    assert records.published(df).columns == load_contract().columns
    records.write_json_lines(records.published(df), f"{tmp_path}/out")
    line = spark.read.text(f"{tmp_path}/out").collect()
    assert len(line) == 1
    assert '"check_out":null' in line[0][0]
    assert "_debug" not in line[0][0]
    assert records.write_diagnostics(df, f"{tmp_path}/debug") == {"missing_url": 1, "missing_price": 1, "discarded": 2}


@pytest.mark.parametrize("shape", ["outlier", "one value", "powers", "nan"])
def test_percentiles_of_any_distribution(spark, shape):
    n = 20_000
    made = {"outlier": lambda i: 1e15 if i == 7 else float(i * 7919 % n), "one value": lambda i: 3.0, "powers": lambda i: 2.0 ** (i % 900), "nan": lambda i: float("nan") if i % 3 == 0 else float(i)}[shape]
    values = [made(i) for i in range(n)]
    df = spark.createDataFrame([(0, v) for v in values] + [(1, 5.0), (1, 6.0), (2, None)], "k int, v double")
    got = {r["k"]: (r["n"], r["p1"], r["p50"], r["p99"]) for r in aggregates.percentiles(df, ["k"], "v", (1, 50, 99)).collect()}
    values.sort(key=lambda v: (v != v, v))
    want = (n, *[values[round((n - 1) * p / 100)] for p in (1, 50, 99)])
    assert [str(x) for x in got.pop(0)] == [str(x) for x in want]
    assert got == {1: (2, 5.0, 5.0, 6.0)}
