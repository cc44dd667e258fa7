"""Feature vectors of pairs: columns name1, address1, name2, address2 (names cleaned), and geo and state where asked.

[FV6, FV10, FV16, FV18, FVD]
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import similarity as S
from kindred.functions import text as T


def _flag(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)


def _match(a: Column, b: Column) -> tuple[Column, Column]:
    """Both present and equal; both present and different."""
    known = (T.present(a) != "") & (T.present(b) != "")
    return _flag(known & (a == b)), _flag(known & (a != b))


def _words(c: str) -> Column:
    return F.array_distinct(T.tokens(F.lower(T.present(c))))


SIX = ["ratio", "token_set_ratio", "token_sort_ratio", "jaro_winkler", "address_overlap", "length_diff"]
TEN = ["ratio", "token_set_ratio", "token_sort_ratio", "partial_ratio", "jaro_winkler", "address_overlap", "length_diff"]
TEN += ["state_match", "state_conflict", "address_jaccard"]
SIXTEEN = ["ratio", "token_set_ratio", "token_sort_ratio", "partial_ratio", "jaro_winkler", "substring_ratio"]
SIXTEEN += ["length_diff", "word_diff", "address_overlap", "address_jaccard", "state_match", "state_conflict"]
SIXTEEN += ["city_match", "city_conflict", "number_match", "number_conflict"]
EIGHTEEN = [*SIXTEEN[:6], "condensed_match", *SIXTEEN[6:], "first_word_match"]


def pair_features(pairs: DataFrame, which: list[str] = EIGHTEEN) -> DataFrame:
    """pairs with the columns of `which`, in order.

    geo1, geo2, state1 and state2 are read where pairs has them; states else come from the addresses.
    """
    n1, n2 = T.present("name1"), T.present("name2")
    rows = pairs.withColumn("_m", S.edit_measures(n1, n2))
    wide = list(which) == EIGHTEEN
    words = A.feature_tokens if wide else _words
    t1, t2 = words("address1"), words("address2")
    state = [F.col(f"state{i}") if f"state{i}" in pairs.columns else A.us_state(f"address{i}") for i in (1, 2)]
    geo = [F.col(f"geo{i}") if f"geo{i}" in pairs.columns else F.lit("") for i in (1, 2)]
    numbers = [T.first_token(A.short_numbers(f"address{i}")) for i in (1, 2)]
    columns = {m: F.col("_m")[m] for m in S.MEASURES}
    columns |= {
        "length_diff": F.abs(F.length(n1) - F.length(n2)).cast("double"),
        "word_diff": F.abs(F.size(T.tokens(n1)) - F.size(T.tokens(n2))).cast("double"),
        "address_overlap": S.overlap(t1, t2).cast("double"),
        "address_jaccard": S.jaccard_percent(t1, t2),
        "condensed_match": _flag((T.condensed(n1) != "") & (T.condensed(n1) == T.condensed(n2))),
        "first_word_match": _flag((T.first_word(n1) != "") & (T.first_word(n1) == T.first_word(n2))),
    }
    for name, (a, b) in {"state": state, "city": geo, "number": numbers}.items():
        columns[f"{name}_match"], columns[f"{name}_conflict"] = _match(a, b)
    return rows.select(*pairs.columns, *[columns[w].alias(w) for w in which])


def diagnostics(pairs: DataFrame) -> DataFrame:
    """What two records (name, address and country 1 and 2) have in common, signal by signal. [FVD]"""
    n = [T.normalize_name(f"name{i}") for i in (1, 2)]
    w = [T.tokens(c) for c in n]
    clean = [T.clean_punctuation(F.lower(T.present(f"address{i}"))) for i in (1, 2)]
    a = [F.filter(T.tokens(c), lambda t: F.length(t) >= 2) for c in clean]
    sig = [T.significant_tokens(f"name{i}") for i in (1, 2)]
    nums = [F.filter(F.split(A.address_numbers(f"address{i}"), "_"), lambda t: t != "") for i in (1, 2)]
    street = [A.street_tokens(f"address{i}") for i in (1, 2)]
    both_streets = (F.size(street[0]) == 2) & (F.size(street[1]) == 2)
    has = [F.size(x) > 0 for x in nums]
    at = lambda x, i: F.try_element_at(x, F.lit(i))
    c1, c2 = T.present("country1"), T.present("country2")
    return pairs.select(
        "*",
        ((c1 != "") & (c2 != "") & (F.trim(c1) == F.trim(c2))).alias("country_match"),
        (n[0] == n[1]).alias("exact_name_match"),
        F.round(S.token_jaccard(*w), 4).alias("name_jaccard"),
        S.sequence_ratio(*n).alias("name_char_ratio"),
        S.overlap(*w).alias("shared_name_tokens"),
        S.overlap(*sig).alias("shared_significant_tokens"),
        S.contained(*n).alias("name_contained"),
        F.abs(F.length(n[0]) - F.length(n[1])).alias("name_length_diff"),
        S.reordered(*n).alias("name_reordered"),
        (~T.is_latin("name1") | ~T.is_latin("name2")).alias("not_latin"),
        (clean[0] == clean[1]).alias("exact_address_match"),
        F.round(S.token_jaccard(*a), 4).alias("address_jaccard"),
        S.overlap(*a).alias("shared_address_tokens"),
        S.overlap(*nums).alias("shared_numbers"),
        has[0].alias("has_digits1"),
        has[1].alias("has_digits2"),
        (~has[0] & ~has[1]).alias("both_no_digits"),
        (~has[0] | ~has[1]).alias("either_no_digits"),
        F.coalesce(both_streets & (at(street[0], 1) == at(street[1], 1)), F.lit(False)).alias("first_street_match"),
        F.coalesce(both_streets & (at(street[0], 2) == at(street[1], 2)), F.lit(False)).alias("second_street_match"),
    )
