import corpus_pipeline
from kindred.llm import langid, mixing, ngram_join, queries, toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r["doc_id"], r["text"] or "", r["source"] or "") for r in df.collect())


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language ID", "n-gram Jaccard join", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["toxicity"](spark, docs, SF).cache()
    model = queries.toxicity_model(spark, SF).scorer()
    assert rows(kept) == sorted((r["doc_id"], r["text"], r["source"]) for r in docs.collect() if model.score(r["text"]) < toxicity.THRESHOLD)
    known = stage["language ID"](spark, kept, SF).cache()
    profiles = queries.language_profiles(docs)
    ok = lambda t: profiles.predict(t)[0] != langid.UNKNOWN and profiles.predict(t)[1] >= corpus_pipeline.LEAST_LANGUAGE_SCORE
    assert rows(known) == sorted((r["doc_id"], r["text"], r["source"]) for r in kept.collect() if ok(r["text"]))
    single = stage["n-gram Jaccard join"](spark, known, SF).cache()
    groups = ngram_join.join_documents(known, ngram_join.STAGE_THRESHOLD, ngram_join.STAGE_WORDS)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(r["doc_id"] for r in groups.filter("doc_id = component_id").collect())
    mixed = stage["mixing"](spark, single, SF).cache()
    taken = {r["source"]: r["t"] for r in mixing.mix(single).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    size = mixing.n_words(F.col("text"))
    assert {r["source"]: r["t"] for r in mixed.groupBy("source").agg(F.sum(size).alias("t")).collect()} == {k: v for k, v in taken.items() if v}
    for df in (kept, known, single, mixed):
        assert df.columns == docs.columns
    packed = stage["packing"](spark, mixed, SF)
    assert packed.filter("start = 0").count() == mixed.count()
    whole = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, packed.select(*key).collect()))
    whole.sparkSession.catalog.clearCache()


def test_awkward_documents_pass_every_stage(spark, awkward, empty):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = docs.cache()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
