"""Text, price, rating and date parsers as Column expressions; no Python runs on executors.

All take a string Column (or a column's name) and give a Column; text that does not parse gives null. Regular expressions use
(?U), so that digits, words and blanks are those of Unicode, and (?d), so that only a line feed ends a line.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Currencies in the order in which they are tried, and words that price, rating and review texts use.
CURRENCIES = ("VND", "USD", "EUR", "GBP", "JPY", "KRW", "THB", "SGD", "AUD", "CAD", "CNY", "HKD")
VND_SIGNS = ("₫", "đ")
PER_NIGHT = r"per\s+night|moi\s+dem|mỗi\s+đêm|/dem|/đêm|\bdem\b|\bđêm\b"
RATING_WORDS = "tuyet voi|tren ca tuyet voi|rat tot|rat tuyet|hai long|excellent|exceptional|very good|wonderful|good"
PRICE_WORDS = "price|gia|per night|moi dem|tong cong|total"
REVIEW_WORDS = "danh gia|nhan xet|reviews?"
SCORE_RANGE = (5.0, 10.0)
TAIL = 120
MIN_DIGITS = {"VND": 4}

FLAGS = "(?Ud)"
_CODE = rf"\b(?:{'|'.join(CURRENCIES)})\b"
_RUN = r"\d[\d.,\s]*\d"
_AMOUNT = rf"(?:(?:{_CODE}|₫)\s*{_RUN}|{_RUN}\s*(?:{_CODE}|₫|đ\b))"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def none_if_empty(x: Column | str) -> Column:
    return F.nullif(_c(x), F.lit(""))


def present(x: Column | str) -> Column:
    """Neither null nor empty: what counts as a value in crawled records."""
    return F.coalesce(_c(x) != "", F.lit(False))


def compact_text(x: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends; nothing left gives null."""
    return none_if_empty(F.trim(F.regexp_replace(_c(x), rf"{FLAGS}\s+", " ")))


def snippet(x: Column | str, length: int = 800) -> Column:
    return F.substring(compact_text(x), 1, length)


HANGUL = (0xAC00, 0xD7A3)
JAMO = tuple("".join(map(chr, range(first, first + n))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))
_MARK = "\uffff"  # no character: stands for those that decompose into several


@lru_cache(1)
def folds() -> tuple[str, str, dict[str, str], str]:
    """Compatibility decomposition without combining marks, from Python's Unicode tables: characters that become one, what they
    become, those that become several or none, and a character class of combining marks. Hangul syllables follow from a rule."""
    one: dict[str, str] = {"đ": "d", "Đ": "D"}
    several: dict[str, str] = {}
    marks: list[list[int]] = []
    for code in (c for c in range(0xA0, sys.maxunicode + 1) if not HANGUL[0] <= c <= 0xDFFF):
        char = chr(code)
        if unicodedata.combining(char):
            if marks and marks[-1][1] == code - 1:
                marks[-1][1] = code
            else:
                marks.append([code, code])
        elif unicodedata.decomposition(char):
            plain = "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))
            if plain != char:
                (one if len(plain) == 1 else several)[char] = plain
    return "".join(one), "".join(one.values()), several, "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in marks) + "]+"


@lru_cache(64)
def _constant(gateway: object, text: str) -> Column:
    return F.lit(text)


def constant(text: str) -> Column:
    """A long text as a literal that is made once for each JVM, not for each expression."""
    return _constant(SparkContext._gateway, text)


def translated(x: Column, of: str, to: str) -> Column:
    return F.call_function("translate", x, constant(of), constant(to))


@lru_cache(8)
def _table(pairs: tuple[tuple[str, str], ...]) -> tuple[str, int]:
    return "\ue001" + "".join(f"{k}\ue000{v}\ue001" for k, v in pairs), max(len(v) for _, v in pairs)


def looked_up(pairs: dict[str, str], key: Column) -> Column:
    """The value of a key in a fixed table, null if it has none. The table is one text literal, which a plan carries at little cost."""
    text, most = _table(tuple(pairs.items()))
    table = constant(text)
    probe = F.concat(F.lit("\ue001"), key, F.lit("\ue000"))
    value = lambda at: F.when(at > 0, F.substring_index(F.substring(table, at + F.length(key) + 2, F.lit(most + 1)), "\ue001", 1))
    return let(F.call_function("instr", table, probe), value)


@lru_cache(2)
def _unfolded(gateway: object) -> Column:
    """What is left to do once single characters are translated, as one parsed function (such a plan is built quickly): marks go,
    and characters that stand for several are looked up one by one, in texts that have any. Hangul goes by arithmetic."""
    _, _, several, marks = folds()
    table, most = _table(tuple(several.items()))
    keys, (first, last) = "".join(several), map(chr, HANGUL)
    marked = lambda c: f"translate({c}, r'{keys}', r'{_MARK * len(keys)}')"
    found = f"element_at(transform(array(instr(r'{table}', concat('\ue001', c, '\ue000'))), i -> substring_index(substring(r'{table}', i + 3, {most + 1}), '\ue001', 1)), 1)"
    place = f"(ascii(c) - {HANGUL[0]})"
    syllable = f"concat(substring('{JAMO[0]}', cast({place} div 588 + 1 as int), 1), substring('{JAMO[1]}', cast({place} % 588 div 28 + 1 as int), 1), CASE WHEN {place} % 28 > 0 THEN substring('{JAMO[2]}', {place} % 28, 1) ELSE '' END)"
    each = f"transform(split(s, ''), c -> CASE WHEN c < '\u00a0' THEN c WHEN {marked('c')} = '{_MARK}' THEN {found} WHEN c BETWEEN '{first}' AND '{last}' THEN {syllable} ELSE c END)"
    expanded = f"s -> CASE WHEN instr({marked('s')}, '{_MARK}') > 0 OR s RLIKE '[{first}-{last}]' THEN array_join({each}, '') ELSE s END"
    bare = f"CASE WHEN t RLIKE r'[\\p{{M}}\\p{{Cn}}]' THEN regexp_replace(t, r'{marks}', '') ELSE t END"
    return F.expr(f"t -> CASE WHEN t RLIKE r'[^\\x00-\\x7F]' THEN element_at(transform(array({bare}), {expanded}), 1) ELSE t END")


def ascii_fold(x: Column | str) -> Column:
    """Letters without their accents, and every character that is a form of others as these: compatibility decomposition less
    the combining marks. Common letters take one pass, the others a look-up where a text has any."""
    of, to, _, _ = folds()
    return F.element_at(F.call_function("transform", F.array(translated(_c(x), of, to)), _unfolded(SparkContext._gateway)), 1)


def latin_fold(x: Column | str) -> Column:
    """ascii_fold but for characters that stand for several: enough to look for marks of plain letters, and a small expression."""
    of, to, _, marks = folds()
    plain = translated(_c(x), of, to)
    return F.when(plain.rlike(r"\p{M}"), F.regexp_replace(plain, marks, "")).otherwise(plain)


def normalized_destination(x: Column | str) -> Column:
    return compact_text(ascii_fold(x))


def review_score(x: Column | str) -> Column:
    """A rating with one decimal, if it lies in SCORE_RANGE."""
    score = F.replace(_c(x), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(score.between(*SCORE_RANGE), F.format_string("%.1f", score))


def parse_review_score(x: Column | str) -> Column:
    """The first rating out of ten that is in range, else one that stands near a rating word."""
    text = _c(x)
    return _review_score(text, lambda: ascii_fold(text))


def _review_score(text: Column, folded: Callable[[], Column]) -> Column:
    out_of_ten = F.regexp_extract_all(text, F.lit(rf"{FLAGS}\b(\d{{1,2}}(?:[.,]\d)?)\s*/\s*10\b"), F.lit(1))
    first = F.try_element_at(F.filter(F.transform(out_of_ten, review_score), lambda s: s.isNotNull()), F.lit(1))
    after = lambda f: review_score(F.regexp_extract(f, rf"(?i){FLAGS}(?:{RATING_WORDS}).{{0,80}}?\b(\d{{1,2}}[.,]\d)\b", 1))
    before = lambda f: review_score(F.regexp_extract(f, rf"(?i){FLAGS}\b(\d{{1,2}}[.,]\d)\b.{{0,80}}?(?:{RATING_WORDS})", 1))
    return F.coalesce(first, let(folded(), lambda f: F.coalesce(after(f), before(f))))


def parse_review_count(x: Column | str) -> Column:
    """The number, as it is written, before a word for reviews."""
    return _review_count(ascii_fold(x))


def _review_count(folded: Column) -> Column:
    return none_if_empty(F.trim(F.regexp_extract(folded, rf"(?i){FLAGS}\b([\d.,]+)\s*(?:bai\s+)?(?:{REVIEW_WORDS})\b", 1)))


def parse_star_rating(x: Column | str) -> Column:
    return _star_rating(ascii_fold(x))


def _star_rating(folded: Column) -> Column:
    found = F.regexp_extract(folded, rf"(?i){FLAGS}\b(\d(?:[.,]\d)?)\s*(?:sao|stars?)\s*(?:tren|out\s+of)\s*5\b", 1)
    return F.when(found != "", F.concat(F.replace(found, F.lit(","), F.lit(".")), F.lit(" stars")))


def price_candidate(x: Column | str) -> Column:
    """The amount whose per-night mark follows soonest, else the first that one of five patterns finds."""
    return let(compact_text(x), lambda plain: let(ascii_fold(plain), lambda folded: _candidate((plain, folded))))


def _candidate(sources: tuple[Column, Column]) -> Column:
    pattern = rf"(?iu){FLAGS}({_AMOUNT})(?=((?s:.{{0,{TAIL}}})))"
    nearest = []
    for text in sources:
        amounts, tails = (F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in (1, 2))
        marked = F.zip_with(amounts, tails, lambda a, t: F.struct(F.regexp_instr(t, F.lit(rf"(?iu){FLAGS}(?:{PER_NIGHT})")).alias("gap"), a.alias("amount")))
        placed = F.transform(marked, lambda m, i: F.struct(m["gap"].alias("gap"), i.alias("at"), m["amount"].alias("amount")))
        best = F.try_element_at(F.array_sort(F.filter(placed, lambda m: m["gap"] > 0)), F.lit(1))
        nearest.append(compact_text(best["amount"]))
    codes = "|".join(CURRENCIES)
    signed = rf"(?:{_RUN})\s*(?:{codes}|₫|đ\b)|(?:{codes}|₫)\s*{_RUN}"
    patterns = (rf"{_CODE}\s*{_RUN}", rf"{_RUN}\s*{_CODE}", rf"{_RUN}\s*(?:₫|đ\b)", rf"₫\s*{_RUN}", rf"(?:{PRICE_WORDS}).{{0,80}}?(?:{signed})")
    plainly = [compact_text(F.regexp_extract(text, rf"(?iu){FLAGS}{p}", 0)) for text in sources for p in patterns]
    # Every pattern asks for a currency: without one none is tried.
    named = reduce(lambda a, b: a | b, [t.rlike(rf"(?iu){FLAGS}(?:{codes}|₫|đ\b)") for t in sources])
    return F.when(named, F.coalesce(*nearest, *plainly))


def canonical_price(x: Column | str) -> Column:
    """Digits of the first amount, if a currency is named and there are enough of them; the currency itself is not kept."""
    return let(compact_text(x), _canonical)


def _canonical(text: Column) -> Column:
    dong = text.rlike(rf"(?i){FLAGS}\bVND\b") | reduce(lambda a, b: a | b, (text.contains(s) for s in VND_SIGNS))
    other = text.rlike(rf"(?i){FLAGS}{_CODE}")
    digits = F.regexp_replace(F.regexp_extract(text, rf"{FLAGS}({_RUN})", 1), "[^0-9]", "")
    least = F.when(dong, MIN_DIGITS["VND"]).when(other, 2)
    return F.when(F.length(digits) >= least, digits)


def price_value(x: Column | str) -> Column:
    return canonical_price(price_candidate(x))


def textual_fallback(x: Column | str) -> Column:
    """(price_value, rating_text, review_count_text, star_rating_text) of a card's text."""
    return let(compact_text(x), _fallback)


def _fallback(text: Column) -> Column:
    return let(ascii_fold(text), lambda folded: _parsed(text, folded))


def _parsed(text: Column, folded: Column) -> Column:
    english = F.regexp_extract(text, rf"(?i){FLAGS}\b(\d(?:\.\d)?)\s+stars?\s+out\s+of\s+5\b", 1)
    return F.struct(
        canonical_price(_candidate((text, folded))).alias("price_value"),
        _review_score(text, lambda: folded).alias("rating_text"),
        _review_count(folded).alias("review_count_text"),
        F.coalesce(F.when(english != "", F.concat(english, F.lit(" stars"))), _star_rating(folded)).alias("star_rating_text"),
    )


def first_present(*values: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[none_if_empty(v) for v in values])


def card_fields(selected: dict[str, Column], text: Column | str) -> Column:
    """Fields of a card: what a selector gave goes before what its text says."""
    parsed = textual_fallback(text)
    return F.struct(*[first_present(selected.get(k, F.lit(None).cast("string")), parsed[k]).alias(k) for k in ("price_value", "rating_text", "review_count_text", "star_rating_text")])


def collect_status(url: Column | str, name: Column | str) -> Column:
    missing = F.concat_ws(",", F.when(~present(url), "missing_url"), F.when(~present(name), "missing_name"))
    return F.coalesce(none_if_empty(missing), F.lit("ok"))


def price_status(price: Column | str, url: Column | str, enrich_status: Column | str) -> Column:
    status = F.coalesce(_c(enrich_status), F.lit(""))
    return (
        F.when(present(price), "present").when(~present(url), "missing_no_url").when(status == "failed", "missing_after_detail_retry").when(status == "skipped", "missing_enrich_skipped").otherwise("missing_after_listing")
    )


def property_id(x: Column | str) -> Column:
    text = compact_text(x)
    return F.coalesce(none_if_empty(F.regexp_extract(text, rf"{FLAGS}\d+", 0)), text)


def parse_date(x: Column | str) -> Column:
    """Dates as year-month-day or day/month/year."""
    text = _c(x)
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "dd/MM/yyyy"))


def stay(check_in: Column | str, nights: int = 1) -> Column:
    day = _c(check_in)
    return F.struct(day.alias("check_in"), F.date_add(day, nights).alias("check_out"))


def check_in_of(interval_end: Column | str, offset_days: int = 21) -> Column:
    return F.date_add(F.to_date(_c(interval_end)), offset_days)


def nights(check_in: Column | str, check_out: Column | str) -> Column:
    return F.datediff(_c(check_out), _c(check_in)).cast("string")


def destinations(x: Column | str, fallback: list[str]) -> Column:
    """A list with commas, blanks trimmed and empty parts left out; the fallback if nothing is left."""
    parts = F.filter(F.transform(F.split(F.coalesce(_c(x), F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(*[F.lit(f) for f in fallback]))


def annotated(record_columns: list[str], destination: Column | str, check_in: Column | str, check_out: Column | str) -> list[Column]:
    """The record's columns plus destination, its folded form and the stay."""
    return [*[F.col(c) for c in record_columns], _c(destination).alias("destination"), normalized_destination(destination).alias("normalized_destination"), _c(check_in).alias("check_in"), _c(check_out).alias("check_out")]


def digest(*parts: Column | str) -> Column:
    """Hex sha-256 of parts with a unit separator between them."""
    return F.sha2(F.concat_ws("\x1f", *[_c(p) for p in parts]), 256)
