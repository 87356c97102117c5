import html
import random
import sys
import unicodedata
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from stayspark.functions import text, urls


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (text.compact_text, "  a \n\t b  ", "a b"),
        (text.compact_text, " \n ", None),
        (text.compact_text, None, None),
        (text.ascii_fold, "Đà Nẵng tuyệt vời đêm", "Da Nang tuyet voi dem"),
        (lambda c: text.ascii_fold(c), "ﬁne ½ Ａ", "fine 1⁄2 A"),
        (text.normalized_destination, " Vũng  Tàu ", "Vung Tau"),
        (text.review_score, "8,7", "8.7"),
        (text.review_score, "4.9", None),
        (text.review_score, "10", "10.0"),
        (text.review_score, "x", None),
        (text.parse_review_score, "1/10 pictures, then 8,9/10", "8.9"),
        (text.parse_review_score, "Tuyet voi 8,7 voi 900 bai danh gia", "8.7"),
        (text.parse_review_score, "8.2 Very good", "8.2"),
        (text.parse_review_score, "1/10 ... 416 m ... 1,1 km", None),
        (text.parse_review_count, "1.357 bai danh gia", "1.357"),
        (text.parse_review_count, "12 Reviews", "12"),
        (text.parse_review_count, "none", None),
        (text.parse_star_rating, "4 sao tren 5", "4 stars"),
        (text.parse_star_rating, "3,5 stars out of 5", "3.5 stars"),
        (text.price_candidate, "1.000.000 ₫ cu 900.000 ₫ gia 702.050 ₫ Moi dem", "702.050 ₫"),
        (text.price_value, "Đặt gói 10 tháng 6 2026 từ 673.391 ₫", "673391"),
        (text.price_value, "2 VND", None),
        (text.price_value, None, None),
        (text.price_value, "USD 1,250 per night", "1250"),
        (text.canonical_price, "250.484 ₫", "250484"),
        (text.canonical_price, "VND 1,155,203", "1155203"),
        (text.canonical_price, "12 apples", None),
        (text.property_id, "id-77-8", "77"),
        (text.property_id, " abc ", "abc"),
        (urls.url_key, "HTTPS://X.com/A/Hotel/b.html/?q=1#f", "https://x.com/a/hotel/b.html"),
        (urls.url_key, "https://x.com/", "https://x.com"),
        (lambda c: urls.property_url(c, F.lit("https://h.com/vi/")), "/a/hotel/b.html?cid=1&rooms=1&utm_x=2&searchrequestid=9#t", "https://h.com/a/hotel/b.html?rooms=1"),
        (lambda c: urls.property_url(c, F.lit("https://h.com/vi/")), "x/hotel/y?q=a+b&e", "https://h.com/vi/x/hotel/y?q=a+b&e="),
        (lambda c: urls.property_url(c, F.lit("https://h.com")), "//O.com/hotel/y/", "https://o.com/hotel/y"),
        (lambda c: urls.property_url(c, F.lit("https://h.com/")), "https://h.com/city/x.html", None),
        (urls.name_from_url, "https://x/the-song_vung-tau/hotel/city.html", "The Song Vung Tau"),
        (urls.name_from_url, "https://x/", "Unknown hotel"),
        (lambda c: urls.with_stay(c, F.lit("2026-06-10").cast("date"), F.lit("2026-06-12").cast("date")), "https://x/h?b=1&rooms=9&b=2#z", "https://x/h?b=2&rooms=1&checkIn=2026-06-10&checkOut=2026-06-12&los=2&adults=2&children=0"),
        (urls.decoded_js_url, r"https:\/\/x\/h?a=1&b=2&amp;c=3", "https://x/h?a=1&b=2&c=3"),
        (urls.safe_name, "a b/c*~.é", "a%20b%2Fc%2A%7E.%C3%A9"),
    ],
)
def test_functions(spark, f, value, want):
    assert one(spark, value, f) == want


def test_fallback_and_dates(spark):
    got = one(spark, "1/10 | 8,9/10 | 1.155.203 ₫ | 12 nhận xét | 4 stars out of 5", text.textual_fallback)
    assert got.asDict() == {"price_value": "1155203", "rating_text": "8.9", "review_count_text": "12", "star_rating_text": "4 stars"}
    days = [str(one(spark, v, text.parse_date)) for v in ("2026-06-01", "01/06/2026", "soon")]
    assert days == ["2026-06-01", "2026-06-01", "None"]
    assert one(spark, " a, ,b ", lambda c: text.destinations(c, ["z"])) == ["a", "b"]
    assert one(spark, " , ", lambda c: text.destinations(c, ["z"])) == ["z"]
    flags = spark.createDataFrame([("1", None, None), (None, None, None), (None, "u", "failed"), (None, "u", "skipped"), (None, "u", None)], "p string, u string, s string")
    assert [r[0] for r in flags.select(text.price_status("p", "u", "s")).collect()] == ["present", "missing_no_url", "missing_after_detail_retry", "missing_enrich_skipped", "missing_after_listing"]


def test_folding_is_compatibility_decomposition_for_every_code_point(spark):
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    plain = lambda t: "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)).replace("đ", "d").replace("Đ", "D")
    groups = ["|".join(map(chr, codes[i : i + 64])) for i in range(0, len(codes), 64)]
    df = spark.createDataFrame(list(enumerate(groups)), "i int, t string").repartition(4)
    got = dict(df.select("i", text.ascii_fold("t").alias("x")).collect())
    assert [i for i, g in enumerate(groups) if got[i] != plain(g)] == []


def test_every_named_reference_and_numbers(spark):
    rng = random.Random(1)
    names = [n for n in html5]
    texts = [f"&{n}" for n in names] + [f"a&{n}b &{n[:-1]}= &{n}{n};" for n in names]
    texts += [f"&#{n};&#x{n:X};&#{n}" for n in [0, 9, 13, 38, 65, 127, 128, 129, 159, 160, 0xD800, 0xFDD0, 0xFFFE, 0x10FFFF, 0x110000, 128512, 99999999, 10**20]]
    texts += ["&", "&&amp;", "&#;", "&#x;", "&#00065;", "&ampamp;", "&notit; &noti;", "&unknown;", "&#xzz", "a&b=c&lt=d", "&eacute;t&eacute"]
    texts += ["".join(rng.choice(["&", "amp", ";", "#", "x", "4", "lt", "not", "in", " ", "é", "frac12"]) for _ in range(12)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = dict(df.select("i", urls.unescaped("t").alias("x")).collect())
    assert [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if got[i] != html.unescape(t)] == []
