"""Names as Spark columns: punctuation, legal suffixes, tokens.

Text classes are those of Unicode: a word character is a letter, a number or `_`; combining marks are kept only where
clean_punctuation says so.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kindred.functions import vocab


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """Null and missing are the same: the empty string."""
    return F.coalesce(col(c), F.lit(""))


def clean_punctuation(c: Column | str) -> Column:
    """Punctuation and symbols become spaces; letters, digits and combining marks stay. [ST1]"""
    return F.regexp_replace(col(c), r"[\p{P}\p{S}]", " ")


def drop_non_words(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[^\p{L}\p{N}_\s]", " ")


def squeeze(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def tokens(c: Column | str) -> Column:
    """Words between white space, in order."""
    return F.filter(F.split(squeeze(c), " "), lambda t: t != "")


def without(words: Column, unwanted: list[str]) -> Column:
    return F.filter(words, lambda t: ~t.isin(unwanted)) if unwanted else words


def normalize_name(c: Column | str, suffixes: list[str] | None = None) -> Column:
    """Lower case, no punctuation, no legal suffixes. [ST2]"""
    text = F.concat(F.lit(" "), squeeze(clean_punctuation(F.lower(F.trim(present(c))))), F.lit(" "))
    pair = F.replace(text, F.lit(f" {vocab.LEGAL_PAIR} "), F.lit(" "))
    return F.array_join(without(tokens(pair), suffixes or vocab.LEGAL_SUFFIXES), " ")


def clean_name(c: Column | str, suffixes: list[str] = vocab.SUFFIXES_TIGHT) -> Column:
    """Lower case, word characters only, no suffix of the list: ST3, ST4, ST6, ST7, ST8 by their lists."""
    return F.array_join(without(tokens(drop_non_words(F.lower(present(c)))), suffixes), " ")


def normalize_address(c: Column | str) -> Column:
    """[ST5]"""
    return squeeze(drop_non_words(F.lower(present(c))))


@F.pandas_udf(StringType())
def ascii_fold(texts: pd.Series) -> pd.Series:
    """Letters without their diacritics; what has no ASCII form goes. Spark has no Unicode normalization."""
    fold = lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode()
    return texts.map(lambda t: None if t is None else t if t.isascii() else fold(t))


# What a business name is freed of.
TRADE_NAME = r"(?i)(?:\b(?:dba|trading as|t/a|c/o)\b|\bd\.b\.a\.)\s*"
METADATA = r"(?i)[(\[{](?:id|branch|division|code|store|ref)[\s:]*[\w\s]+[)\]}]"
DOMAIN_ENDING = r"(?i)\.(?:com|org|net|in|us|fr|co|biz|info)\b"
HONORIFIC = r"(?i)^(?:mr|mrs|ms|shri|smt|m/s|messrs|dr|prof|the)\b\s*"
INNER_DOT = r"(?<=\w)\.(?=\w)"


def clean_name_enhanced(c: Column | str) -> Column:
    """Diacritics folded, dots between word characters dropped, then as clean_name. [ST9]"""
    return clean_name(F.regexp_replace(ascii_fold(present(c)), INNER_DOT, ""))


def super_clean_name(c: Column | str) -> Column:
    """Trade name after `dba`, no metadata in brackets, no domain ending, no honorific, acronyms closed. [ST10]

    `d.b.a. ` is understood as well, where a word boundary after its last dot could never be.
    """
    text = F.element_at(F.split(ascii_fold(present(c)), TRADE_NAME), -1)
    for pattern in (METADATA, DOMAIN_ENDING):
        text = F.regexp_replace(text, pattern, " ")
    text = F.regexp_replace(F.trim(text), HONORIFIC, "")
    return clean_name(F.regexp_replace(text, INNER_DOT, ""), vocab.SUFFIXES_SUPER)


def condensed(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit(""))


def first_word(c: Column | str) -> Column:
    return F.split_part(col(c), F.lit(" "), F.lit(1))


def prefix(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def at_least(c: Column | str, n: int) -> Column:
    """The text if it is so long, else null: shorter ones say too little to be a key. [PF16]"""
    return F.when(F.length(col(c)) >= n, col(c))


def trigram(c: Column | str) -> Column:
    """The first three characters of the first word, empty if it is shorter. [ST14]"""
    w = first_word(c)
    return F.when(F.length(w) >= 3, F.substring(w, 1, 3)).otherwise("")


def is_alpha(t: Column) -> Column:
    return t.rlike(r"^\p{L}+$")


def is_digits(t: Column) -> Column:
    """Decimal digits of any script and superscripts."""
    return t.rlike(r"^[\p{Nd}²³¹⁰⁴-⁹]+$")


def significant_tokens(name: Column | str) -> Column:
    """Alphabetic words of at least four letters of a normalized name that are no generic business words. [ST15]"""
    return significant_of(normalize_name(name))


def significant_of(normalized: Column | str) -> Column:
    """The same of a name that is normalized already."""
    words = without(tokens(normalized), vocab.NAME_STOP_WORDS)
    return F.filter(words, lambda t: (F.length(t) >= 4) & is_alpha(t))


def by_length(words: Column) -> Column:
    """Longest first, ties in alphabetical order."""
    keyed = F.transform(words, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    return F.transform(F.array_sort(keyed), lambda s: s["t"])


def first_token(words: Column) -> Column:
    return F.try_element_at(words, F.lit(1))


def longest_token(words: Column) -> Column:
    """[ST16]"""
    return F.try_element_at(by_length(words), F.lit(1))


def long_tokens(name: Column | str, least: int = 4) -> Column:
    """[ST17]"""
    return F.filter(tokens(name), lambda t: F.length(t) >= least)


def ascii_token_set(c: Column | str) -> Column:
    """[ST18]"""
    return F.array_distinct(F.regexp_extract_all(F.lower(present(c)), F.lit(r"(?U)\b([a-zA-Z0-9]{3,})\b")))


def encoder_text(name: Column | str, address: Column | str, between: str = " | ") -> Column:
    """[ST19]"""
    return F.when(present(address) == "", present(name)).otherwise(F.concat_ws(between, present(name), present(address)))


#: The first and the last character of each script's block.
SCRIPTS = {
    "devanagari": "[\u0900-\u097f]",
    "bengali": "[\u0980-\u09ff]",
    "gurmukhi": "[\u0a00-\u0a7f]",
    "gujarati": "[\u0a80-\u0aff]",
    "tamil": "[\u0b80-\u0bff]",
    "telugu": "[\u0c00-\u0c7f]",
    "kannada": "[\u0c80-\u0cff]",
    "malayalam": "[\u0d00-\u0d7f]",
}


def has_script(c: Column | str, script: str) -> Column:
    """Whether a character of the script's block occurs. [PF6]"""
    return present(c).rlike(SCRIPTS[script])


def has_indic(c: Column | str) -> Column:
    """Whether a character of any of the blocks occurs. [PF6]"""
    return present(c).rlike("[\u0900-\u0d7f]")


def is_latin(c: Column | str) -> Column:
    """Every letter is of the Latin script. [PF7]"""
    return ~present(c).rlike(r"[\p{L}&&[^\p{IsLatin}]]")


def is_latin1(c: Column | str) -> Column:
    return ~present(c).rlike("[^\\x00-\\xFF]")
