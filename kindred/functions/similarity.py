"""Similarities of strings, token sets and vectors.

What Spark can express is a Column. Edit-based measures are one Arrow function over pairs of names, so that a pair
crosses to Python once for all of them.
"""

from __future__ import annotations

import difflib
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kindred.functions import text as T

# -- on one pair, in Python ------------------------------------------------------------------------------------------


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel addition (Hyyrö 2004)."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = full
    for c in b:
        both = rows & at.get(c, 0)
        rows = ((rows + both) | (rows - both)) & full
    return len(a) - rows.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """Percentage of characters that insertions and deletions leave in place; 100 for two empty strings. [SM1]"""
    return 200 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio between the shared words, and these with what either adds; 0 if either is empty. [SM2]"""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if shared and (not left or not right):
        return 100.0
    gap = 1 if shared else 0
    with_left, with_right = len(shared) + gap + len(left), len(shared) + gap + len(right)
    apart = len(left) + len(right) - 2 * common_subsequence(left, right)
    found = [100 * (1 - apart / (with_left + with_right))]
    if shared:
        found += [100 * (1 - (gap + len(s)) / (2 * len(shared) + gap + len(s))) for s in (left, right)]
    return max(found)


def token_sort_ratio(a: str, b: str) -> float:
    """[SM3]"""
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer one, windows over its ends included. [SM4]"""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = sorted((a, b), key=len)
    m, n = len(short), len(long)
    best = max(indel_ratio(short, long[max(0, i) : i + m]) for i in range(1 - m, n))
    return max(best, partial_ratio_equal(a, b)) if m == n else best


def partial_ratio_equal(a: str, b: str) -> float:
    m = len(a)
    return max(indel_ratio(b, a[max(0, i) : i + m]) for i in range(1 - m, m))


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by a shared prefix of up to four characters where it exceeds 0.7; as a percentage. [SM5]"""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, t in zip(b, taken, strict=True) if t]
    m, moved = len(left), sum(x != y for x, y in zip(left, right, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return 100 * (jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro)


def common_substring(a: str, b: str) -> int:
    """Length of the longest common substring: if one of some length is shared, so are shorter ones, so the length is
    halved in on."""
    least, most = 0, min(len(a), len(b))
    while least < most:
        n = (least + most + 1) // 2
        parts = {a[i : i + n] for i in range(len(a) - n + 1)}
        if any(b[i : i + n] in parts for i in range(len(b) - n + 1)):
            least = n
        else:
            most = n - 1
    return least


def substring_ratio(a: str, b: str) -> float:
    """[SM6]"""
    return 100 * common_substring(a, b) / max(len(a), len(b), 1)


def matcher_ratio(a: str, b: str) -> float:
    """[SM9]"""
    return round(difflib.SequenceMatcher(None, a, b).ratio(), 4)


MEASURES = {
    "ratio": indel_ratio,
    "token_set_ratio": token_set_ratio,
    "token_sort_ratio": token_sort_ratio,
    "partial_ratio": partial_ratio,
    "jaro_winkler": jaro_winkler,
    "substring_ratio": substring_ratio,
}


@F.pandas_udf(StructType([StructField(m, DoubleType()) for m in MEASURES]))
def edit_measures(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """All edit-based measures of each pair of names, as a struct; equal pairs in a batch are measured once."""
    pairs = list(zip(a.fillna(""), b.fillna(""), strict=True))
    known = {p: [f(*p) for f in MEASURES.values()] for p in Counter(pairs)}
    return pd.DataFrame([known[p] for p in pairs], columns=list(MEASURES), dtype=float)


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([matcher_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def jaro_winkler_column(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)


# -- as columns ------------------------------------------------------------------------------------------------------


def token_jaccard(a: Column, b: Column) -> Column:
    """Of arrays as sets; 1 if both are empty. [SM7]"""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(both / either)


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard_percent(a: Column, b: Column) -> Column:
    """0 if both are empty. [SM8]"""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 0.0).otherwise(100 * overlap(a, b) / either)


def contained(a: Column, b: Column) -> Column:
    """[SM10]"""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def reordered(a: Column, b: Column) -> Column:
    """Same words in another order. [SM11]"""
    x, y = T.tokens(a), T.tokens(b)
    return (F.array_sort(x) == F.array_sort(y)) & (x != y) & (F.size(x) > 1)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """[SM16]"""
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def sigmoid(x: Column) -> Column:
    """[SM17]"""
    return 1 / (1 + F.exp(-x))


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    """0 where both are 0. [SM18]"""
    b = beta * beta
    return F.when(b * p + r == 0, 0.0).otherwise((1 + b) * p * r / (b * p + r))


def fuzzy_score(a: Column, b: Column) -> Column:
    """[SM13]"""
    m = edit_measures(a, b)
    return 0.6 * m["ratio"] + 0.4 * m["token_set_ratio"]


def disambiguation(tokens: Column, numbers: Column) -> Column:
    """[SM14]"""
    return 2 * tokens + 3 * numbers


def combined(similarity: Column, tokens: Column, numbers: Column) -> Column:
    """[SM15]"""
    return similarity + 0.05 * tokens + 0.1 * numbers
