"""Cards of a listing page: which are properties, what they are called, and their assembly into records.

A card is a row with name, text, data_selenium, data_test_id, class_name, tag_name, source_selector, property_id,
outer_html_preview, urls (array) and page, card_index.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.text import FLAGS, collect_status, compact_text, latin_fold, let, none_if_empty, parse_review_count, parse_review_score, parse_star_rating, present, price_value, property_id, snippet, textual_fallback
from stayspark.functions.urls import PATH_MARK, name_from_url, property_url, resolved, unescaped, url_key
from stayspark.operators import elements
from stayspark.operators.elements import APART, ATTRIBUTES, UNSEEN, attribute, raw_attribute
from stayspark.operators.identity import first_value, partial_key

# Marks of cards and of what isn't one, in folded lower case.
CARD_MARKS = ("hotel-item", "property-card", "search-result-card")
SLIDE_MARKS = ('aria-roledescription="slide"', "ssrweb-mosaicphotos", "aaa63-snap", "splide__slide", "swiper-slide", "carousel")
FILTER_MARKS = ("search-filter-", "filteritem", "filter item", "accommodationtype", "hotelareaid", "starratingwithluxury")
GENERIC_LABELS = ("khach san + nha", "hotels + homes", "hotel + homes", "hotel + home", "khach san", "hotels", "hotel")
KINDS = "khach san|hotel|resort|villa|apartment|homestay"
NEW_TAB = r"\b(?:mo|open)\b.{1,160}\b(?:trong the moi|new tab)\b"
NON_NAME = ("vnd", "reviews", "nhan xet", "danh gia", "per night", "moi dem", "gia", "stars out of", "sao")
CLEANUP = (r"^Anh truoc cua co so luu tru\s+", r"^Photo of\s+", r"^Mo\s+", r"\s+trong the moi$", r"^Open\s+", r"\s+in new tab$")
NAME_LENGTH = 120
PREVIEW = 1000


def low(c: str) -> Column:
    return F.lower(F.coalesce(compact_text(c), F.lit("")))


def folded(c: str) -> Column:
    return F.lower(latin_fold(F.coalesce(F.col(c), F.lit(""))))


def has_any(text: Column, marks: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(m) for m in marks])


def is_container() -> Column:
    attributes = F.concat_ws(" ", low("data_selenium"), low("data_test_id"), low("class_name"))
    return has_any(attributes, (*CARD_MARKS, "propertycard")) | has_any(low("source_selector"), CARD_MARKS[:2]) | (low("tag_name") == "article")


def is_not_property() -> Column:
    """Slides, bare list items, generic labels, filters, and labels with a count."""
    item = (low("source_selector") == "li") & (low("tag_name") == "li")
    markup = lambda marks: has_any(low("outer_html_preview"), marks) | has_any(low("class_name"), marks)
    counted = rf"{FLAGS}^(?:{KINDS})\s*\(\d+\)$"
    bare = item & property_id("property_id").isNull() & ~is_container() & ~folded("text").rlike(f"{FLAGS}{NEW_TAB}")
    return (item & markup(SLIDE_MARKS)) | bare | folded("name").isin(*GENERIC_LABELS) | folded("text").isin(*GENERIC_LABELS) | markup(FILTER_MARKS) | folded("name").rlike(counted) | folded("text").rlike(counted)


def has_signal() -> Column:
    """Whether a card without URL is a property; the first check that applies decides."""
    text, name = folded("text"), folded("name")
    attributes = F.concat_ws(" ", low("data_selenium"), low("data_test_id"))
    priced = text.rlike(rf"{FLAGS}\b(?:vnd|per night|moi dem|gia moi dem)\b")
    reviewed = text.rlike(rf"{FLAGS}\b(?:reviews?|nhan xet|danh gia|\d(?:[.,]\d)?\s*/\s*10)\b")
    return (
        F.when(is_not_property(), False)
        .when(has_any(attributes, CARD_MARKS), True)
        .when(text.rlike(f"{FLAGS}{NEW_TAB}"), property_id("property_id").isNotNull() | is_container())
        .when(priced & reviewed, True)
        .when(name.rlike(rf"{FLAGS}^(?:{KINDS})\s*\(\d+\)$"), False)
        .otherwise((name != "") & name.rlike(rf"{FLAGS}\b(?:hotel|khach san|resort|villa|apartment|homestay)\b"))
    )


def is_landing_shell(cards: Column, links: Column) -> Column:
    return (cards <= 2) & (links > 20)


def is_not_name(c: Column) -> Column:
    return has_any(F.lower(c), NON_NAME) | ((F.length(c) <= 4) & c.rlike(rf"{FLAGS}\d"))


def cleaned_name(c: Column) -> Column:
    """A name without what screen readers say around it; found in folded text, cut from the text itself."""
    text = compact_text(c)
    for pattern in CLEANUP:
        text = let(text, _cutter(pattern))
    return compact_text(text)


def _cutter(pattern: str) -> Callable[[Column], Column]:
    return lambda text: _cut(text, pattern)


def _cut(text: Column, pattern: str) -> Column:
    n = F.length(F.regexp_extract(latin_fold(text), f"(?i){FLAGS}{pattern}", 0))
    return F.substring(text, n + 1, F.length(text)) if pattern[0] == "^" else F.substring(text, F.lit(1), F.length(text) - n)


def opened_name(c: Column) -> Column:
    """The name inside `Open ... in new tab`, in the card's own letters."""
    return let(latin_fold(c), lambda plain: _opened(c, plain))


def _opened(c: Column, plain: Column) -> Column:
    out = []
    for head, tail in ((r"Mo\s+", r"\s+trong\s+the\s+moi"), (r"Open\s+", r"\s+in\s+new\s+tab")):
        whole = F.regexp_extract(plain, rf"(?i){FLAGS}\b{head}.+?{tail}\b", 0)
        name = F.regexp_extract(plain, rf"(?i){FLAGS}\b{head}(.+?){tail}\b", 1)
        start = F.instr(plain, whole) + F.length(F.regexp_extract(whole, rf"(?i){FLAGS}^{head}", 0))
        out.append(F.when(whole != "", cleaned_name(F.substring(c, start, F.length(name)))))
    return F.coalesce(*out)


def name_from_text(c: Column) -> Column:
    return let(compact_text(c), _named)


def _named(text: Column) -> Column:
    parts = F.filter(F.transform(F.split(text, r"\|"), compact_text), lambda p: p.isNotNull())
    first = F.try_element_at(F.filter(parts, lambda p: ~is_not_name(p)), F.lit(1))
    return F.coalesce(opened_name(text), cleaned_name(F.substring(first, 1, NAME_LENGTH)), cleaned_name(F.substring(text, 1, NAME_LENGTH)))


def assembled(cards: DataFrame, base_url: str) -> DataFrame:
    """One record a property out of a snapshot's cards: identity, parsed fields, status; first values win."""
    urls = F.array_distinct(F.filter(F.transform("urls", lambda u: property_url(u, F.lit(base_url))), lambda u: u.isNotNull()))
    named = cards.withColumn("_urls", urls).withColumn("_url", F.try_element_at("_urls", F.lit(1))).withColumn("name", F.coalesce(none_if_empty(compact_text("name")), name_from_text(F.col("text"))))
    taken = named.where((F.col("_url").isNotNull() & ~is_not_property()) | (F.col("_url").isNull() & has_signal()))
    parsed = taken.withColumn("_parsed", textual_fallback("text")).withColumn("_order", F.struct("page", "card_index"))
    key = F.coalesce(F.concat(F.lit("url:"), "_url"), F.concat(F.lit("property:"), property_id("property_id")), partial_key("name", "text", "page", "card_index"))
    fields = {"hotel_name": F.col("name"), "hotel_url": F.col("_url"), "listing_property_id": property_id("property_id"), "listing_text_snippet": snippet("text"), **{k: F.col(f"_parsed.{k}") for k in ("price_value", "rating_text", "review_count_text", "star_rating_text")}}
    merged = parsed.withColumn("record_key", key).groupBy("record_key").agg(*[first_value(v, "_order").alias(k) for k, v in fields.items()], F.count("*").alias("cards"))
    return merged.withColumn("collect_status", collect_status("hotel_url", "hotel_name")).withColumn("record_kind", F.when(present("hotel_url"), "full_record").otherwise("partial_record"))


# -- markup

_ANCHOR = rf"(?is)<a(?=[\s/])({ATTRIBUTES})>(.*?)</a\s*>"
_BREAK = rf"(?i)</?(?:{'|'.join(APART)})\b[^>]*>"


def visible_text(html: Column) -> Column:
    """Text of markup as it is read: no comments and scripts, blocks apart, entities decoded, white space compact."""
    return compact_text(unescaped(F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), _BREAK, " "), "<[^>]*>", "")))


def anchors(html: Column | str, mark: str = "") -> Column:
    """(href, text) of every link whose href holds `mark`, in order; the text is what is seen, else aria-label, else title."""
    page = F.regexp_replace(F.col(html) if isinstance(html, str) else html, r"(?s)<!--.*?-->", "")
    heads, bodies = (F.regexp_extract_all(page, F.lit(_ANCHOR), F.lit(k)) for k in (1, 2))
    rows = F.zip_with(heads, bodies, lambda h, b: F.struct(attribute(h, "href").alias("href"), F.coalesce(visible_text(b), compact_text(attribute(h, "aria-label")), compact_text(attribute(h, "title"))).alias("text")))
    return F.filter(rows, lambda r: r["href"].isNotNull() & F.contains(r["href"], F.lit(mark)))


def link_scan(pages: DataFrame, html: str, mark: str = "") -> DataFrame:
    """(page's columns, position, url, text): every link of a page, in order."""
    found = pages.select("*", F.posexplode(anchors(html, mark)).alias("position", "_link")).drop(html)
    return found.select("*", F.col("_link.href").alias("url"), F.col("_link.text").alias("text")).drop("_link")


def property_links(pages: DataFrame, html: str, base: str, keys: list[str]) -> DataFrame:
    """(keys, position, hotel_url, hotel_name): a page's links to properties, each URL key once, the first link's. A link without text
    is named after its URL. base: the column with the page's own URL."""
    links = link_scan(pages.select(*keys, F.col(base).alias("_base"), F.col(html).alias("_html")), "_html", PATH_MARK)
    named = links.withColumn("hotel_url", resolved("url", "_base")).withColumn("_key", url_key("hotel_url"))
    first = F.min_by(F.struct("position", "hotel_url", F.coalesce("text", name_from_url("hotel_url")).alias("hotel_name")), "position")
    return named.groupBy(*keys, "_key").agg(first.alias("_first")).select(*keys, "_first.*")


_EMBEDDED_TAIL = r"""[^"'<>\s]+?/hotel/[^"'<>\s]+?\.html(?:\?[^"'<>\s]*)?"""


def embedded_urls(html: Column | str, host: str = r"""[^/"'<>\s]+""") -> Column:
    """Property pages named anywhere in a document, each once: whole URLs of the host (a pattern), then paths with a locale, then
    any paths; escaped slashes and ampersands are decoded before. Only pages that end in .html count."""
    text = F.col(html) if isinstance(html, str) else html
    text = F.replace(F.replace(F.replace(text, F.lit("\\u002F"), F.lit("/")), F.lit("\\/"), F.lit("/")), F.lit("&amp;"), F.lit("&"))
    patterns = (rf"https?://(?:www\.)?{host}/{_EMBEDDED_TAIL}", rf"/[a-z]{{2}}-[a-z]{{2}}/{_EMBEDDED_TAIL}", rf"/{_EMBEDDED_TAIL}")
    return let(text, lambda t: F.array_distinct(F.concat(*[F.regexp_extract_all(t, F.lit(f"(?i){p}"), F.lit(0)) for p in patterns])))


EMBEDDED = "embedded-state"


def embedded_cards(pages: DataFrame, html: str, page: str = "page", host: str | None = None) -> DataFrame:
    """One card for each URL of embedded_urls, with no name or text of its own."""
    found = embedded_urls(html, host) if host else embedded_urls(html)
    return pages.select(F.col(page).alias("page"), F.posexplode(found).alias("card_index", "_url")).select("page", "card_index", F.array("_url").alias("urls"), F.lit("").alias("name"), F.lit("").alias("text"), F.lit(EMBEDDED).alias("data_selenium"), F.lit(EMBEDDED).alias("data_test_id"))


def with_embedded(cards: DataFrame, pages: DataFrame, html: str, page: str = "page", host: str | None = None) -> DataFrame:
    """A snapshot's cards and after them those of embedded URLs: indices go on, columns that these lack are null."""
    last = cards.groupBy("page").agg((F.max("card_index") + 1).alias("_next"))
    more = embedded_cards(pages, html, page, host).join(last, "page", "left").withColumn("card_index", (F.col("card_index") + F.coalesce("_next", F.lit(0))).cast("int")).drop("_next")
    return cards.unionByName(more, allowMissingColumns=True)


def detail_fields(name: Column | str, review: Column | str, stars: Column | str, price: Column | str, body: Column | str) -> Column:
    """Fields of a property's own page: what was selected goes before the whole text. A selected review text replaces the
    whole text even where nothing is found in it; a selected price that does not parse does not."""
    pick = lambda x: none_if_empty(F.col(x) if isinstance(x, str) else x)
    whole = F.col(body) if isinstance(body, str) else body
    reviews = F.coalesce(pick(review), whole)
    return F.struct(
        pick(name).alias("hotel_name"),
        F.coalesce(price_value(pick(price)), price_value(whole)).alias("price_value"),
        parse_review_score(reviews).alias("rating_text"),
        parse_review_count(reviews).alias("review_count_text"),
        parse_star_rating(F.coalesce(pick(stars), whole)).alias("star_rating_text"),
    )


# Where a property's own page has its fields; the first selector that gives text decides.
NAME_AT = (elements.named("h1"), elements.equal("data-selenium", "hotel-name"))
REVIEW_AT = (elements.holding("data-testid", "review-score"), elements.equal("data-selenium", "review-score"), elements.holding("class", "ReviewScore"))
STARS_AT = (elements.holding("aria-label", "sao", True), elements.holding("aria-label", "star", True))
PRICE_AT = (elements.equal("data-selenium", "display-price"), elements.equal("data-element-name", "final-price"), elements.holding("data-testid", "price"), elements.holding("class", "price", True))


def detail_page(html: Column | str) -> Column:
    """detail_fields of a page's markup. A selected element is whole, elements of its own name inside it too."""

    def fields(tags: Column) -> Column:
        at = [elements.first_place(tags, x) for x in (*NAME_AT, *REVIEW_AT, *PRICE_AT, elements.named("body"))]
        found = F.struct(elements.texts_at(tags, [*at, F.lit(0)]).alias("texts"), elements.first_attribute(tags, "aria-label", *STARS_AT).alias("stars"))

        def chosen(x: Column) -> Column:
            first = lambda start, n: F.get(F.filter(F.slice(x["texts"], start, n), lambda t: t.isNotNull()), F.lit(0))
            name, review = len(NAME_AT), len(REVIEW_AT)
            picked = {"name": first(1, name), "review": first(name + 1, review), "stars": x["stars"], "price": first(name + review + 1, len(PRICE_AT)), "body": first(len(at), 2)}
            return let(F.struct(*[v.alias(k) for k, v in picked.items()]), lambda p: detail_fields(*[p[k] for k in picked]))

        return let(found, chosen)

    return let(elements.scanned(html), fields)


def page_cards(pages: DataFrame, html: str, page: str) -> DataFrame:
    """The cards of listing pages: elements that are marked as cards, and articles; of nested ones each. A card's name is its first
    heading, else its first link with text."""
    marked = lambda t: F.exists(F.array(*[F.lit(m) for m in (*CARD_MARKS, "propertycard")]), lambda m: F.contains(F.lower(F.concat_ws(" ", *[raw_attribute(t["head"], a) for a in ("data-selenium", "data-testid", "class")])), m))
    wanted = lambda t: (t["name"] == "article") | (F.contains(t["head"], F.lit("=")) & ~t["name"].isin("a", "img") & marked(t))
    tags = pages.select(F.col(page).alias("page"), elements.scanned(html).alias("_tags"))
    found = tags.select("page", "_tags", F.posexplode(elements.places("_tags", wanted)).alias("card_index", "_at"))
    inside = found.select("page", "card_index", F.get("_tags", F.col("_at") - 1).alias("_tag"), elements.content(F.col("_tags"), F.col("_at")).alias("_in"))
    inner = F.col("_in")
    links = F.filter(inner, lambda t: (t["name"] == "a") & ~t["closes"])
    head = F.col("_tag.head")
    heading, link = (elements.first_place(inner, elements.named(*names)) for names in (("h1", "h2", "h3", "h4", "h5", "h6"), ("a",)))
    inside = inside.withColumn("_texts", elements.texts_at(inner, [heading, link, F.lit(0)]))
    whole = F.array_join(F.transform(inner, lambda t: F.concat(t["head"], t["after"])), "")
    card = F.struct(
        F.filter(F.transform(links, lambda t: attribute(t["head"], "href")), lambda u: u.isNotNull()).alias("urls"),
        F.coalesce(F.get("_texts", F.lit(0)), F.get("_texts", F.lit(1))).alias("name"), F.get("_texts", F.lit(2)).alias("text"),
        raw_attribute(head, "data-selenium").alias("data_selenium"), raw_attribute(head, "data-testid").alias("data_test_id"), raw_attribute(head, "class").alias("class_name"),
        F.col("_tag.name").alias("tag_name"), F.lit(None).cast("string").alias("source_selector"), F.coalesce(raw_attribute(head, "data-hotelid"), raw_attribute(head, "data-property-id")).alias("property_id"),
        F.substring(whole, 1, PREVIEW).alias("outer_html_preview"),
    )
    # A generator: what follows reads these columns and does not compute them again.
    return inside.select("page", "card_index", F.inline(F.array(card)))
