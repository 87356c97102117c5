"""URL functions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayspark.functions.text import _c, let, looked_up, nights, none_if_empty

# Query keys that don't identify a property.
TRACKING_KEYS = (
    "cid", "ds", "searchrequestid", "tag", "tspTypes", "countryId", "finalPriceView", "isShowMobileAppPrice", "numberOfBedrooms", "familyMode", "maxRooms", "isCalendarCallout",
    "childAges", "numberOfGuest", "missingChildAges", "travellerType", "showReviewSubmissionEntry", "currencyCode", "isFreeOccSearch",
)
TRACKING_PREFIX = "utm_"
PATH_MARK = "/hotel/"


def url_part(url: Column | str, part: str) -> Column:
    """scheme, host (with user and port), path or query of a URL; empty if absent."""
    group = {"scheme": 1, "host": 2, "path": 3, "query": 4}[part]
    return F.regexp_extract(_c(url), r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?", group)


def url_key(url: Column | str) -> Column:
    """Scheme, host and path, lower-case, without slashes at the end: equal for URLs that differ in query or fragment."""
    head = F.concat(F.when(url_part(url, "scheme") != "", F.concat(url_part(url, "scheme"), F.lit(":"))).otherwise(""), F.when(url_part(url, "host") != "", F.concat(F.lit("//"), url_part(url, "host"))).otherwise(""))
    return F.lower(F.concat(head, F.regexp_replace(url_part(url, "path"), "/+$", "")))


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encoded(x: Column) -> Column:
    """Form encoding; a tilde stays and a star does not."""
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_pairs(query: Column) -> Column:
    """Decoded (key, value) of a query string, empty parts left out."""
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("key"), _decoded(F.when(F.instr(p, "=") > 0, F.substr(p, F.instr(p, "=") + 1)).otherwise("")).alias("value")))


def query_text(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(_encoded(p["key"]), F.lit("="), _encoded(p["value"]))), "&")


def resolved(raw: Column | str, base: Column | str) -> Column:
    """raw as an absolute URL: with a scheme of its own, or relative to base's scheme, host or folder."""
    url, root = _c(raw), F.concat(url_part(base, "scheme"), F.lit("://"), url_part(base, "host"))
    folder = F.regexp_replace(url_part(base, "path"), "[^/]*$", "")
    return (
        F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.\\-]*:"), url)
        .when(url.startswith("//"), F.concat(url_part(base, "scheme"), F.lit(":"), url))
        .when(url.startswith("/"), F.concat(root, url))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), F.regexp_replace(url, r"^(?:\./)+", "")))
    )


def property_url(raw: Column | str, base: Column | str) -> Column:
    """A property's URL without tracking keys, fragment or slashes at the end; null for other pages."""
    url = resolved(raw, base)
    path = url_part(url, "path")
    kept = F.filter(query_pairs(url_part(url, "query")), lambda p: ~p["key"].isin(*TRACKING_KEYS) & ~p["key"].startswith(TRACKING_PREFIX))
    query = query_text(kept)
    whole = F.concat(F.lower(url_part(url, "scheme")), F.lit("://"), F.lower(url_part(url, "host")), F.regexp_replace(path, "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(none_if_empty(raw).isNotNull() & F.lower(path).contains(PATH_MARK), whole)


def title_case(x: Column | str) -> Column:
    """The first letter after anything that is no cased letter as a capital, other letters small."""
    parts = F.split(_c(x), r"(?<![\p{Lu}\p{Ll}\p{Lt}])(?=[\p{Lu}\p{Ll}\p{Lt}])")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def name_from_url(url: Column | str) -> Column:
    """The path's part before `hotel`, else its last, as a title."""
    parts = F.filter(F.split(url_part(url, "path"), "/"), lambda p: p != "")
    at = F.array_position(parts, "hotel")
    slug = F.when(at > 1, F.try_element_at(parts, (at - 1).cast("int"))).otherwise(F.try_element_at(parts, F.lit(-1)))
    name = F.trim(F.regexp_replace(slug, "[-_]+", " "))
    return F.coalesce(none_if_empty(title_case(name)), F.lit("Unknown hotel"))


def with_stay(url: Column | str, check_in: Column | str, check_out: Column | str, adults: int = 2, rooms: int = 1, children: int = 0) -> Column:
    """The URL with the stay's six query parameters set; others stay in place, the last value of a repeated key counts."""
    text = lambda day: F.date_format(_c(day), "yyyy-MM-dd")
    new = [("checkIn", text(check_in)), ("checkOut", text(check_out)), ("los", nights(check_in, check_out)), ("rooms", F.lit(str(rooms))), ("adults", F.lit(str(adults))), ("children", F.lit(str(children)))]
    pairs = F.concat(query_pairs(url_part(url, "query")), F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in new]))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    last = F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1))
    return F.concat(F.regexp_extract(_c(url), "^[^?#]*", 0), F.lit("?"), query_text(last))


_ESCAPE = r"\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LOST = "\ufffd"


def _replaced(text: Column, pattern: str, made: Callable[[Column], Column]) -> Column:
    """text with every match of pattern as what `made` makes of it. Pieces between matches and matches alternate."""

    def joined(t: Column) -> Column:
        pieces = lambda found: F.transform(F.split(t, pattern, -1), lambda p, i: F.concat(p, F.coalesce(let(F.get(found, i), made), F.lit(""))))
        return F.when(t.rlike(pattern), F.array_join(let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), pieces), "")).otherwise(t)

    return let(text, joined)


def _utf16(number: Column) -> Column:
    """UTF-16 bytes of a code point."""
    over = number - 0x10000
    pair = F.concat(F.lpad(F.hex(F.lit(0xD800) + F.floor(over / 1024)), 4, "0"), F.lpad(F.hex(F.lit(0xDC00) + over % 1024), 4, "0"))
    return F.unhex(F.when(number < 0x10000, F.lpad(F.hex(number), 4, "0")).otherwise(pair))


def _character(number: Column) -> Column:
    """What a numeric reference stands for: the old Windows characters for 0x80 to 0x9F, nothing for controls and noncharacters,
    a replacement character for what no code point is."""
    windows = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0))
    bad = number.isNull() | (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    nothing = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | (number % 0x10000 >= 0xFFFE)
    return F.when(bad, _LOST).when(number.between(0x80, 0x9F), F.substring(F.lit(windows), (number - 0x7F).cast("int"), F.lit(1))).when(nothing, "").otherwise(F.decode(_utf16(number), "UTF-16BE"))


@lru_cache(1)
def _names() -> tuple[dict[str, str], dict[str, str]]:
    """The public table of named references, as Python has it; those that also count without a semicolon, by themselves."""
    return dict(html5), {k: v for k, v in html5.items() if not k.endswith(";")}


def _reference(match: Column) -> Column:
    """One reference: a number, a name, or the longest name that it begins with and what follows; else it stays."""
    whole, short = _names()
    digits = F.regexp_extract(match, "[0-9a-fA-F]+", 0)
    significant = F.regexp_replace(digits, "^0+(?=.)", "")
    number = F.when(F.length(significant) <= 8, F.when(match.rlike("^&#[xX]"), F.conv(significant, 16, 10)).otherwise(significant).cast("bigint"))
    name = F.substring(match, F.lit(2), F.length(match))
    begun = lambda k: F.concat(looked_up(short, F.substring(name, F.lit(1), k)), F.substring(name, k + 1, F.length(name)))
    longest = F.get(F.filter(F.transform(F.sequence(F.lit(max(map(len, short))), F.lit(2)), begun), lambda x: x.isNotNull()), F.lit(0))
    return F.when(F.startswith(match, F.lit("&#")), _character(number)).otherwise(F.coalesce(looked_up(whole, name), longest, match))


def unescaped(x: Column | str) -> Column:
    """Character references as characters: decimal, hexadecimal and all named ones, as a browser reads them."""
    return let(_c(x), lambda t: F.when(F.contains(t, F.lit("&")), _replaced(t, _REFERENCE, _reference)).otherwise(t))


def decoded_js_url(x: Column | str) -> Column:
    """A URL out of a script: escaped ampersands and slashes, character entities, then all remaining \\u and \\x escapes."""
    plain = unescaped(F.replace(F.replace(_c(x), F.lit("\\u0026"), F.lit("&")), F.lit("\\/"), F.lit("/")))
    return _replaced(plain, _ESCAPE, lambda m: F.decode(F.unhex(F.lpad(F.substring(m, 3, 4), 4, "0")), "UTF-16BE"))


def safe_name(x: Column | str) -> Column:
    """Percent-encoding of all but letters, digits, `_`, `-` and `.`, for names of folders."""
    return F.replace(F.replace(F.replace(F.url_encode(_c(x)), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("~"), F.lit("%7E"))
