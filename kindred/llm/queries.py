"""The queries of this package: thin digests of each operator's result over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import ann, common, embed_dedup, langid, mixing, ngram_join, oracle, packing, tokens, toxicity, urls, warc, wavelet

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [
    urls.parse_rule("allow", "org/"),
    urls.parse_rule("block", "example.org/es/"),
    urls.parse_rule("block", "example.org/en/1"),
    urls.parse_rule("allow", "com/fr/"),
    urls.parse_rule("block", "com/de/"),
]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def language_profiles(docs: DataFrame) -> langid.Profiles:
    """Fitted on documents that are not held out."""
    return langid.fit(docs.filter(~common.held_out()))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), language_profiles(docs))
    return found.select("doc_id", common.held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op2_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.dedup(common.read_table(spark, sf_dir, "embeddings"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(common.read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(common.read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def packed_digest(docs: DataFrame, cache: int = tokens.CACHE_PIECES) -> DataFrame:
    """The packing of docs, with a checksum of each piece's ids in their place."""
    pieces = packing.cut(docs, tokenizer_path(), cache=cache).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.assign(common.materialize(pieces, "pieces"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(common.read_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(common.read_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.read_table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(common.read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    docs, labels = (common.read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.fit(docs, labels.filter(~common.held_out()))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    predicted = (F.col("toxicity") >= toxicity.THRESHOLD).cast("int")
    held = common.held_out().alias("held_out")
    return scored.select("doc_id", held, F.col("toxicity").alias("score"), predicted.alias("predicted"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    manifest = wavelet.write_shards(docs, common.scratch_path(spark, "wavelet"), tokenizer_path())
    return wavelet.read_shards(manifest, ids=False)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_embedding_near_dups": op2_embedding_near_dups,
    "op3_warc": op3_warc,
    "op4_mix_sources": op4_mix_sources,
    "op5_packing": op5_packing,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_token_ids": op10_token_ids,
}
#: The others are trained models, token ids, or (op7) an approximate search; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_embedding_near_dups": oracle.OP2,
    "op3_warc": oracle.OP3,
    "op4_mix_sources": oracle.OP4,
    "op6_ngram_jaccard": oracle.OP6,
    "op8_url_filter": oracle.op8(URL_RULES),
}
