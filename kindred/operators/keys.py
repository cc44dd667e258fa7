"""Blocking keys: named expressions over records, each null where a part is missing. [KA-KI, KT, KU, KV, KP, KQ, KM]

A key is the text of its parts, parted by SEPARATOR; country comes first in all but the domain key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import anchors as N
from kindred.functions import text as T

SEPARATOR = "\x1f"


def key_of(*parts: Column) -> Column:
    """The parts as one text; null if any part is null or empty."""
    ok = F.lit(True)
    for p in parts:
        ok = ok & p.isNotNull() & (p != "")
    return F.when(ok, F.concat_ws(SEPARATOR, *parts))


def country_of(c: str = "country") -> Column:
    return F.trim(T.present(c))


def pair_at(words: Column, i: int) -> Column:
    return F.try_element_at(words, F.lit(i))


@dataclass(frozen=True)
class KeySpec:
    """A key over staged records, the evidence flag it sets (null: it finds candidates only), and its cap on postings."""

    name: str
    build: Callable[[], Column]
    flag: str | None
    cap: int | None = None


def _two(words: Column) -> tuple[Column, Column]:
    return pair_at(words, 1), pair_at(words, 2)


def staged(records: DataFrame) -> DataFrame:
    """records with what keys are made of, each computed once: country, normalized name, its significant words, address
    numbers, anchor, street words and longest words."""
    rows = records.withColumns(
        {
            "_land": country_of(),
            "_norm": T.normalize_name("name"),
            "_numbers": A.address_numbers("address"),
            "_anchor": A.address_anchor("address"),
            "_street": A.street_tokens("address"),
            "_pair": A.address_pair("address"),
        }
    )
    return rows.withColumn("_sig", T.significant_of("_norm"))


def _key(*parts: Column | str) -> Column:
    return key_of(*[T.col(p) for p in ("_land", *parts)])


def key_a() -> Column:
    return _key("_norm")


def key_b(n: int = 4) -> Column:
    return _key(T.prefix("_norm", n), "_numbers")


def key_c() -> Column:
    return _key("_anchor")


def key_d(longest: bool = False) -> Column:
    return _key((T.longest_token if longest else T.first_token)(F.col("_sig")))


def key_f() -> Column:
    return _key(*_two(F.col("_street")))


def key_g() -> Column:
    first = F.slice("_sig", 1, 2)
    return _key(*_two(F.when(F.size(first) == 2, F.array_sort(first))))


def key_h() -> Column:
    return _key(pair_at(F.col("_sig"), 2))


def key_i() -> Column:
    return _key(*_two(F.col("_pair")))


KEYS = {
    k.name: k
    for k in (
        KeySpec("a", key_a, "a"),
        KeySpec("b", key_b, "b"),
        KeySpec("c", key_c, "c"),
        KeySpec("d", key_d, "d", 250),
        KeySpec("e", lambda: key_b(5), "b"),
        KeySpec("f", key_f, "f", 500),
        KeySpec("g", key_g, "g", 500),
        KeySpec("h", key_h, None, 250),
        KeySpec("i", key_i, "i", 500),
    )
}
#: As candidate generation uses them: E and H off.
PRODUCTION = ("a", "b", "c", "d", "f", "g", "i")


def key_table(records: DataFrame, names: tuple[str, ...] = PRODUCTION) -> DataFrame:
    """Long form: key_type, key, entity_id, ord; one row for each key that a record has."""
    made = F.array(*[F.struct(F.lit(n).alias("key_type"), KEYS[n].build().alias("key")) for n in names])
    rows = staged(records).select("entity_id", "ord", F.explode(made).alias("k"))
    return rows.select("k.key_type", "k.key", "entity_id", "ord").filter(F.col("key").isNotNull())


def tier_columns(records: DataFrame, cleaned: Column, india: list[str] | None = None, france: list[str] | None = None) -> DataFrame:
    """Columns that tiers are made of: cn, cond, w1, tri, words, num, geo, postal and land (country in lower case)."""
    rows = records.withColumn("land", F.lower(country_of())).withColumn("cn", cleaned)
    return rows.withColumns(
        {
            "cond": T.condensed("cn"),
            "w1": T.first_word("cn"),
            "tri": T.trigram("cn"),
            "words": T.long_tokens("cn"),
            "num": A.first_number("address"),
            "geo": A.geo("address", "land", india, france),
            "postal": A.postal_code("address", "land"),
        }
    )


def tier_key(*names: str) -> Column:
    return key_of(F.col("land"), *[F.col(n) for n in names])


def identity_keys(records: DataFrame) -> DataFrame:
    """kind (tax, phone, domain), key and entity_id for each anchor of a record; domains without country. [KV1-3]"""
    rows = records.withColumn("_a", N.anchors("name", "address", "country")).withColumn("land", F.lower(country_of()))
    tax = [F.struct(F.lit("tax").alias("kind"), key_of(F.col("land"), F.lit(t), F.col("_a")[t]).alias("key")) for t in N.TAX_TYPES]
    phone = F.struct(F.lit("phone").alias("kind"), key_of(F.col("land"), F.col("_a.PHONE")).alias("key"))
    domain = F.struct(F.lit("domain").alias("kind"), F.col("_a.DOMAIN").alias("key"))
    rows = rows.select("entity_id", "ord", F.explode(F.array(*tax, phone, domain)).alias("k"))
    return rows.select("entity_id", "ord", "k.kind", "k.key").filter(F.col("key").isNotNull())
