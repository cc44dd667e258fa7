"""Operator 1, language ID: rank-order n-gram profiles (Cavnar and Trenkle 1994).

A profile lists the most frequent n-grams (1 to 3 letters, words padded) of a language's documents by rank. A text is
given the language whose profile is nearest: the sum, over the text's own most frequent n-grams, of how far each is
out of place, an n-gram missing from a profile counting as PROFILE places. Profiles are fitted on at most
`sample` documents a language, those with the least hashes of their ids; predictions read whole texts.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common

PROFILE = 300
SAMPLE = 1500
#: More languages than this are an error: a column of free text in place of language codes would flood the driver.
MOST_LANGS = 10_000
UNKNOWN = "und"
SHIFT = 21
#: Stands for the border of a word; no letter has this code point, and not being 0 it tells n-grams of all lengths apart.
BORDER = 1


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point whether it is a letter or a mark on one."""
    return np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(sys.maxunicode + 1)), bool)


def symbols_of(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, each run of others as one 0, with a 0 at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = np.zeros(len(points) + 2, np.uint64)
    s[1:-1] = np.where(letter_table()[points], points, 0)
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    return np.concatenate([s[:1], s[keep]])


def grams_of(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, one an occurrence: up to three code points of SHIFT bits."""
    if not text:
        return np.empty(0, np.uint64)
    s = symbols_of(text)
    if len(s) < 2:
        return np.empty(0, np.uint64)
    letter = s[1:-1] != 0
    s[s == 0] = BORDER
    k = np.uint64(SHIFT)
    pairs = s[:-1] << k | s[1:]
    return np.concatenate([s[1:-1][letter], pairs, (pairs[:-1] << k | s[2:])[letter]])


def top_grams(grams: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent codes, ties to the smaller code."""
    codes, counts = np.unique(grams, return_counts=True)
    return codes[np.argsort(-counts, kind="stable")[:n]]


@dataclass
class Profiles:
    """ranks[i, j]: the place of n-gram vocab[i] in language langs[j], PROFILE where it is missing."""

    langs: list[str]
    vocab: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, ranked: dict[str, list[int]], size: int) -> Profiles:
        langs = sorted(ranked)
        vocab = np.array(sorted({g for codes in ranked.values() for g in codes}), np.uint64)
        ranks = np.full((len(vocab) + 1, len(langs)), size, np.int32)
        for j, lang in enumerate(langs):
            ranks[np.searchsorted(vocab, np.array(ranked[lang], np.uint64)), j] = np.arange(len(ranked[lang]))
        return cls(langs, vocab, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 - mean distance of an n-gram to the nearest profile / PROFILE."""
        grams = grams_of(text)
        if not len(grams) or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        top = top_grams(grams, self.size)
        at = np.searchsorted(self.vocab, top)
        at[at == len(self.vocab)] = 0
        at = np.where(self.vocab[at] == top, at, len(self.vocab))
        apart = np.minimum(np.abs(self.ranks[at] - np.arange(len(top), dtype=np.int32)[:, None]), self.size)
        apart[at == len(self.vocab)] = self.size
        total = apart.sum(0)
        best = int(total.argmin())
        return self.langs[best], float(1 - total[best] / (len(top) * self.size))


def fit(docs: DataFrame, size: int = PROFILE, sample: int = SAMPLE, seed: int = 1) -> Profiles:
    """Profiles of the languages named in docs (doc_id, text, lang); rows whose lang is null are left out.

    Every value of lang has a profile; more than MOST_LANGS of them are an error. No rows: no languages, and every
    prediction is `und`. Documents that repeat an id count each.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull())
    if (n := known.select("lang").distinct().count()) > MOST_LANGS:
        raise ValueError(f"{n} values of lang; at most {MOST_LANGS} are learned")
    bars = common.hash_sample(known, "doc_id", "lang", sample, seed)
    chosen = known.join(F.broadcast(bars), "lang").filter(common.sample_hash("doc_id", seed) <= F.col("_bar"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            return codes, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = held.setdefault(lang, [])
                grams.append(np.unique(grams_of(text), return_counts=True))
                if len(grams) >= 64:
                    held[lang] = [merged(grams)]
        for lang, grams in held.items():
            codes, n = merged(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n)], names=["lang", "g", "n"]
            )

    counts = chosen.select("lang", "text").mapInArrow(count, "lang string, g long, n long")
    counts = counts.groupBy("lang", "g").agg(F.sum("n").alias("n"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "g")))
    ranked: dict[str, list[int]] = {}
    for row in top.filter(F.col("r") <= size).orderBy("lang", "r").collect():
        ranked.setdefault(row["lang"], []).append(row["g"] & (1 << 64) - 1)
    return Profiles.of(ranked, size)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Adds lang_pred and lang_score to every row; `und` and 0 where the text is null or has no letter."""

    def make():
        def run(texts: list[str | None]) -> list[pa.Array]:
            found = [profiles.predict(t) for t in texts]
            return [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]

        return run

    return common.append_columns(docs, "text", make, [("lang_pred", "string"), ("lang_score", "double")])
