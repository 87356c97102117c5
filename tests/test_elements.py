"""The balanced scan of tags."""

import pytest

from stayspark.functions.text import let
from stayspark.operators import cards, elements


def one(spark, html, f):
    return spark.createDataFrame([(html,)], "v string").select(let(elements.scanned("v"), f).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<div class="price"><div>sale</div><b>VND 900.000</b></div> after', "sale VND 900.000"),
        ('<div class="price">a<div>b<div>c</div>d</div>e</div>f', "a b c d e"),
        ('<div class="price">open to the end<p>of the page', "open to the end of the page"),
        ('<!-- <i class="price">no</i> --><script>"<i class=price>"</script><i class=price>yes</i>', "yes"),
        ('<br class="price"><i>x</i>', None),
        ('<div class="price"/><div>x</div>', None),
        ("<i title='class=\"price\" > x'>no</i><i data-x='>' class='my price'>y&amp;z</i>", "y&z"),
        ('<DIV CLASS="x"></DIV><div class="price">1<br>2<img src="a>b">3</div>', "1 23"),
        ("no markup", None),
        ("", None),
        (None, None),
    ],
)
def test_first_text(spark, html, want):
    assert one(spark, html, lambda t: elements.first_text(t, elements.holding("class", "price"))) == want


def test_selected_price_of_nested_elements(spark):
    html = '<p>VND 100.000</p><div class="price"><div>sale</div><b>VND 900.000</b></div>'
    assert spark.createDataFrame([(html,)], "v string").select(cards.detail_page("v").alias("f")).first()["f"]["price_value"] == "900000"


def test_cards_of_pages(spark):
    html = '<li><a href="/hotel/no.html">x</a></li><div data-testid="property-card" data-hotelid="7"><div><h2>Sea <b>Inn</b></h2></div><a href="/hotel/a.html?utm_x=1">go</a><div>9,1 / 10</div>VND 500.000</div><article><a href="/hotel/b.html">Bay Inn</a></article>'
    rows = {r.page: r for r in cards.page_cards(spark.createDataFrame([(1, html), (2, None), (3, "")], "k int, h string"), "h", "k").orderBy("card_index").collect()[:1]}
    assert rows[1].name == "Sea Inn" and rows[1].urls == ["/hotel/a.html?utm_x=1"] and rows[1].property_id == "7" and rows[1].text == "Sea Inn go 9,1 / 10 VND 500.000"
