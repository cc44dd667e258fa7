"""Addresses as Spark columns: numbers, postal codes, places, states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.functions import text as T
from kindred.functions import vocab

#: Fixed value, as are the forms of numbers and postal codes below.
US_STATE = r"(?U)\b([A-Z]{2})\b"


def _words(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def all_matches(c: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(T.present(c), F.lit(pattern), F.lit(0))


def address_numbers(a: Column | str) -> Column:
    """Digit tokens in order, joined by `_`. [AD1]"""
    return F.array_join(F.filter(T.tokens(T.clean_punctuation(T.present(a))), T.is_digits), "_")


def number_set_key(a: Column | str) -> Column:
    """Distinct runs of digits, sorted. [AD2]"""
    return F.array_join(F.array_sort(F.array_distinct(all_matches(a, r"\d+"))), "_")


def first_number(a: Column | str) -> Column:
    """[AD3]"""
    return F.regexp_extract(T.present(a), r"(?U)\b\d+\b", 0)


def short_numbers(a: Column | str) -> Column:
    """Numbers of at most five digits. [AD4]"""
    return F.filter(all_matches(a, r"(?U)\b\d+\b"), lambda n: F.length(n) <= 5)


def number_set(a: Column | str) -> Column:
    """[AD5]"""
    return F.array_distinct(all_matches(a, r"(?U)\b\d+\b"))


def address_anchor(a: Column | str) -> Column:
    """First number and first alphabetic word of more than two letters; empty unless both are there. [AD6]"""
    words = T.tokens(T.clean_punctuation(F.lower(T.present(a))))
    number = T.first_token(F.filter(words, T.is_digits))
    word = T.first_token(F.filter(words, lambda t: T.is_alpha(t) & (F.length(t) > 2)))
    return _or_empty(F.concat(number, F.lit("_"), word))


def loose_anchor(a: Column | str) -> Column:
    """As address_anchor from words as they stand, either half possibly empty. [AD7]"""
    words = T.tokens(F.lower(T.present(a)))
    number = T.first_token(F.filter(words, T.is_digits))
    word = T.first_token(F.filter(words, lambda t: T.is_alpha(t) & (F.length(t) > 2)))
    return F.concat(_or_empty(number), F.lit("_"), _or_empty(word))


def _content_words(a: Column | str, stops: list[str]) -> Column:
    words = T.without(T.tokens(T.clean_punctuation(F.lower(T.present(a)))), stops)
    return F.filter(words, lambda t: (F.length(t) >= 4) & T.is_alpha(t))


def street_tokens(a: Column | str) -> Column:
    """The first two content words, in order. [AD8]"""
    return F.slice(_content_words(a, vocab.STREET_STOP_WORDS), 1, 2)


def address_pair(a: Column | str) -> Column:
    """The two longest content words, sorted. [AD9]"""
    return F.array_sort(F.slice(T.by_length(_content_words(a, vocab.ADDRESS_STOP_WORDS)), 1, 2))


def first_pin(a: Column | str, least: int = 4) -> Column:
    """First number of `least` to six digits. [AD10]"""
    return F.regexp_extract(T.present(a), rf"(?U)\b\d{{{least},6}}\b", 0)


def last_postal(a: Column | str) -> Column:
    """[AD11]"""
    return F.try_element_at(all_matches(a, r"(?U)\b\d{4,6}\b"), F.lit(-1))


def in_country(country: Column | str, names: str) -> Column:
    return F.upper(F.trim(T.present(country))).isin(names.split("|"))


def is_india(country: Column | str) -> Column:
    """[PF5]"""
    return F.lower(F.trim(T.present(country))) == "india"


INDIA, FRANCE, US = "INDIA|IN", "FRANCE|FR", "UNITED STATES|USA|US"


def postal_code(a: Column | str, country: Column | str) -> Column:
    """The last code of the country's form; null if there is none. [AD12]"""
    last = lambda p: F.try_element_at(all_matches(a, p), F.lit(-1))
    return (
        F.when(in_country(country, INDIA), last(r"(?U)\b[1-9][0-9]{5}\b"))
        .when(in_country(country, FRANCE), last(r"(?U)\b(?:0[1-9]|[1-8][0-9]|9[0-8])[0-9]{3}\b"))
        .when(in_country(country, US), F.substring(last(r"(?U)\b[0-9]{5}(?:-[0-9]{4})?\b"), 1, 5))
    )


def pincode(a: Column | str) -> Column:
    """First six-digit number. [AD13]"""
    return F.nullif(F.regexp_extract(T.present(a), r"(?U)\b\d{6}\b", 0), F.lit(""))


def postal_token(a: Column | str) -> Column:
    """First token of five or six digits. [AD14]"""
    words = T.tokens(T.clean_punctuation(T.present(a)))
    return T.first_token(F.filter(words, lambda t: T.is_digits(t) & F.length(t).isin(5, 6)))


def us_state(a: Column | str) -> Column:
    """First state code in capitals. [AD15]"""
    found = F.regexp_extract_all(T.present(a), F.lit(US_STATE), F.lit(1))
    return _or_empty(T.first_token(F.filter(found, lambda s: s.isin(vocab.US_STATES))))


def geo(a: Column | str, country: Column | str, india: list[str] | None = None, france: list[str] | None = None) -> Column:
    """State of a US address, place of an Indian or French one. [AD16]

    Of several places named the first in alphabetical order: the same in each run.
    """
    words = F.regexp_extract_all(F.lower(T.present(a)), F.lit("[a-z]+"), F.lit(0))
    place = lambda known: _or_empty(F.array_min(F.array_intersect(words, _words(known))))
    named = F.lower(T.present(country))
    return (
        F.when(named == "us", us_state(a))
        .when(named == "india", place(india or vocab.INDIA_PLACES))
        .when(named == "france", place(france or vocab.FRANCE_PLACES))
        .otherwise("")
    )


def geo_token(a: Column | str, places: list[str]) -> Column:
    """First token, without punctuation, that is one of the places. [AD17]"""
    words = F.transform(T.tokens(F.lower(T.present(a))), lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}_]", ""))
    return _or_empty(T.first_token(F.filter(words, lambda t: t.isin(places))))


def _first_of(table: dict[str, str], test) -> Column:
    """Value of the first entry, in the table's order, whose key passes the test; null if none does."""
    return F.coalesce(*[F.when(test(k), F.lit(v)) for k, v in table.items()])


def canonical_geo(a: Column | str, country: Column | str) -> Column:
    """India: state by alias, else city by synonym, else as geo; other countries as geo. [AD18]"""
    low = F.lower(T.present(a))
    edge = "(?U)\\b"
    alias = _first_of(vocab.INDIA_STATE_ALIASES, lambda k: low.rlike(f"{edge}\\Q{k}\\E\\b"))
    city = _first_of(vocab.CITY_SYNONYMS, lambda k: F.contains(low, F.lit(k)))
    named = F.lower(T.present(country))
    known = F.when((named == "india") & (low != ""), F.coalesce(alias, city))
    return F.coalesce(known, geo(a, country))


def audit_state(a: Column | str, country: Column | str) -> Column:
    """US: last state code; India: code by keyword; France: department of the postal code. [AD19]"""
    words = F.split(F.replace(T.present(a), F.lit(","), F.lit(" ")), r"\s+")
    last = F.try_element_at(F.filter(words, lambda t: t.isin(vocab.US_STATES)), F.lit(-1))
    low = F.lower(T.present(a))
    pairs = {k: code for code, ks in vocab.STATE_KEYWORDS.items() for k in ks}
    code = _first_of(pairs, lambda k: F.contains(low, F.lit(k)))
    department = F.regexp_extract(T.present(a), r"(?U)\b(0[1-9]|[1-8]\d|9[0-5]|97|98)\d{3}\b", 1)
    named = F.lower(T.present(country))
    found = F.when(named == "us", last).when(named == "india", code).when(named == "france", department)
    return _or_empty(found)


def state_code(a: Column | str) -> Column:
    """Code of a state of two words, else of the first word that names a state or city; null if none. [AD20]"""
    low = F.lower(T.present(a))
    two = _first_of({k: vocab.STATE_CODES[k] for k in vocab.MULTI_WORD_STATES}, lambda k: F.contains(low, F.lit(k)))
    codes = F.create_map(*[F.lit(x) for kv in vocab.STATE_CODES.items() for x in kv])
    words = F.regexp_extract_all(low, F.lit("[a-z]+"), F.lit(0))
    one = T.first_token(F.filter(F.transform(words, lambda w: codes[w]), lambda c: c.isNotNull()))
    return F.coalesce(two, one)


def address_tokens(a: Column | str, least: int = 2, stops: list[str] | None = None) -> Column:
    """Distinct words of at least `least` characters that are no stop words. [AD21, AD22 without stops]"""
    words = F.array_distinct(F.regexp_extract_all(F.lower(T.present(a)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    words = F.filter(words, lambda t: F.length(t) >= least)
    return T.without(words, vocab.ADDRESS_TOKEN_STOPS if stops is None else stops or [""])


def feature_tokens(a: Column | str) -> Column:
    """Distinct ASCII words and numbers that say where. [SM8]"""
    words = F.array_distinct(F.regexp_extract_all(F.lower(T.present(a)), F.lit("[a-z0-9]+"), F.lit(0)))
    return T.without(words, vocab.FEATURE_STOP_WORDS)
