"""Elements of a page as Column expressions: a balanced scan of tags, no parser outside the JVM.

`scanned` cuts markup into tags and the text after each. An element ends where the depth of its own name returns to zero, found by a
fold over the tags that follow; an element that is never closed ends with the page. Comments, scripts, styles and templates are no part of
the text; void elements (`br`, `img`) and self-closing tags have no content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayspark.functions.text import _c, compact_text, let, none_if_empty
from stayspark.functions.urls import unescaped

# Elements without content, and those that stand apart from the text around them.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
APART = ("br", "p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "table", "section", "article", "header", "footer", "nav")
UNSEEN = r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>"
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG = rf"</?[a-zA-Z]{ATTRIBUTES}>"


def raw_attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, quoted in either way or not at all; null if it is absent."""
    before = r"""^(?:[^"']*+(?:"[^"]*+"|'[^']*+'))*?[^"']*?(?:^|(?<=[\s"'/]))"""  # whole values are passed over
    value = F.regexp_extract(tag, rf"""(?is){before}{name}\s*=\s*("[^"]*+"|'[^']*+'|[^\s"'>]+)""", 1)
    return none_if_empty(F.regexp_replace(value, r"""^["']|["']$""", ""))


def attribute(tag: Column, name: str) -> Column:
    """raw_attribute with its character references decoded."""
    return unescaped(raw_attribute(tag, name))


def scanned(html: Column | str) -> Column:
    """An array of (name, closes, empty, head, after): every tag, and the text up to the next one, set apart where it has to be."""

    def tags(page: Column) -> Column:
        def tag(head: Column, after: Column) -> Column:
            name = F.lower(F.regexp_extract(head, r"^</?([a-zA-Z][^\s/>]*)", 1))
            return let(name, lambda n: F.struct(n.alias("name"), head.startswith("</").alias("closes"), (n.isin(*VOID) | head.endswith("/>")).alias("empty"), head.alias("head"), F.concat(F.when(n.isin(*APART), " ").otherwise(""), after).alias("after")))

        pieces = F.split(page, _TAG, -1)
        return F.zip_with(F.regexp_extract_all(page, F.lit(_TAG), F.lit(0)), F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), tag)

    return let(F.regexp_replace(_c(html), UNSEEN, ""), tags)


def _length(tags: Column, at: Column) -> Column:
    """How many tags stand between the opening tag at place `at` (from 1) and the one that closes it."""

    def step(x: Column, t: Column) -> Column:
        same = t["name"] == x["name"]
        depth = x["depth"] + F.when(same & t["closes"], -1).when(same & ~t["empty"], 1).otherwise(0)
        return F.when(x["depth"] == 0, x).otherwise(F.struct(x["name"].alias("name"), depth.alias("depth"), (x["n"] + F.when(depth == 0, 0).otherwise(1)).alias("n")))

    first = F.get(tags, at - 1)
    start = F.struct(first["name"].alias("name"), F.when(first["empty"], 0).otherwise(1).alias("depth"), F.lit(0).alias("n"))
    return F.aggregate(F.slice(tags, at + 1, F.size(tags)), start, step)["n"]


def content(tags: Column, at: Column) -> Column:
    """The tags from the opening one at place `at` to the last inside the element."""
    return F.slice(tags, at, F.when(F.get(tags, at - 1)["empty"], 0).otherwise(_length(tags, at) + 1))


def text_of(tags: Column) -> Column:
    """What is read in a run of tags: references decoded, white space compact; null if nothing."""
    return compact_text(unescaped(F.array_join(F.transform(tags, lambda t: t["after"]), "")))


def places(tags: Column, wanted: Callable[[Column], Column]) -> Column:
    """The places, from 1, of the opening tags that are wanted."""
    each = F.transform(tags, lambda t, i: F.when(~t["closes"] & wanted(t), i + 1))
    return F.filter(each, lambda i: i.isNotNull())


def first_place(tags: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.get(places(tags, wanted), F.lit(0))


def texts_at(tags: Column, at: list[Column]) -> Column:
    """The texts of the elements at some places, null for a null place; place 0 is the whole page. One expression for all."""
    inside = lambda i: F.when(i == 0, tags).otherwise(content(tags, F.greatest(i, F.lit(1))))
    return F.transform(F.array(*[x.cast("int") for x in at]), lambda i: F.when(i.isNotNull(), text_of(inside(i))))


def first_text(tags: Column, wanted: Callable[[Column], Column]) -> Column:
    """The text of the first wanted element; null if there is none, or it has no text."""
    return F.get(texts_at(tags, [first_place(tags, wanted)]), F.lit(0))


def named(*names: str) -> Callable[[Column], Column]:
    return lambda t: t["name"].isin(*names)


def holding(attribute_name: str, part: str, ignore_case: bool = False) -> Callable[[Column], Column]:
    """Elements whose attribute holds a part."""

    def test(t: Column) -> Column:
        value = raw_attribute(t["head"], attribute_name)
        return F.coalesce(F.contains(F.lower(value) if ignore_case else value, F.lit(part)), F.lit(False))

    return lambda t: F.contains(t["head"], F.lit(attribute_name)) & test(t)


def equal(attribute_name: str, value: str) -> Callable[[Column], Column]:
    return lambda t: F.contains(t["head"], F.lit(attribute_name)) & F.coalesce(raw_attribute(t["head"], attribute_name) == value, F.lit(False))


def first_head(tags: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(tags, lambda t: ~t["closes"] & wanted(t)), F.lit(0))["head"]


def first_attribute(tags: Column, attribute_name: str, *wanted: Callable[[Column], Column]) -> Column:
    """The attribute of the first element that is wanted, by the first test that finds one."""
    return attribute(F.coalesce(*[first_head(tags, w) for w in wanted]), attribute_name)
