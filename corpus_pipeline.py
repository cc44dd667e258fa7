"""From documents to packed sequences: the stages, each on all that the one before kept.

Toxicity, language ID, n-gram Jaccard join and mixing return the columns of documents; packing returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import common, langid, mixing, ngram_join, packing, queries, tokens, toxicity

#: No DuckDB SQL: the first two stages are trained models and the last needs token ids. Tests hold the models against plain
#: computations, the other stages against brute force, and the stages against what the models say of each document.
ORACLE_SQL = None
#: Texts that share less with every language's profile are not prose of any of them.
LEAST_LANGUAGE_SCORE = 0.25


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = queries.toxicity_model(spark, sf_dir)
    scored = toxicity.score(docs, model)
    return scored.filter(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some known language: with a letter, and near enough to a profile."""
    profiles = queries.language_profiles(common.read_table(spark, sf_dir, "documents"))
    found = langid.predict(docs, profiles)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(known).select(*docs.columns)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect: that with the least id, and of rows that repeat it one.

    Five-word shingles, similarity 0.8 or more. Documents without words are nobody's copies and stay.
    """
    return ngram_join.keep_one(docs, t=ngram_join.STAGE_THRESHOLD, words=ngram_join.STAGE_WORDS)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one at which a source's budget ends is cut there."""
    return mixing.apply_mix(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids, as in op5: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset."""
    return queries.packed_digest(docs, tokens.CACHE_PIECES_SHARED)


STAGES = [
    ("toxicity", stage_toxicity),
    ("language ID", stage_language),
    ("n-gram Jaccard join", stage_near_duplicates),
    ("mixing", stage_mixing),
    ("packing", stage_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each written before the next reads it."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
