"""Queries against DuckDB on the smallest tables, and what SQL can't say against plain Python."""

import difflib
import math
import re

import duckdb
import pytest

import __spark_entry__
from kindred.functions import anchors as N
from kindred.functions import features as FV
from kindred.functions import similarity as S
from kindred.functions import text as T
from kindred.operators import failures, learning, metrics, ranking, sampling, validate
from kindred.plans import catalogue as C
from kindred.plans import entities as E
from kindred.sources import scratch, tsv
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
CHECKED = [
    "folded_names", "address_texts", "address_numbers_and_codes", "places", "identity_anchors", "anchor_edges", "edit_ratios", "partial_ratios",
    "pair_signals", "features_18_checked", "suspect_pairs", "record_files", "list_files", "cached_keys", "three_key_union", "many_keys_union",
    "canonical_recovery", "ranking_bake_off", "key_ablation", "rule_grid", "semantic_matches", "run_report", "broken_invariants", "output_digest",
    "same_under_other_partitions", "end_to_end_scores", "greedy_assignment", "override_slots", "override_entities", "result_violations",
    "missed_patterns", "random_negatives", "encoder_pairs", "micro_scores", "recall_at_k", "evidence_ranked_top25",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", CHECKED)
def test_query_against_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(__spark_entry__.oracle_sql()[name])
    at = [d[0] for d in found.description]
    assert sorted(at) == columns
    expected = sorted((str([plain(row[at.index(c)]) for c in columns]) for row in found.fetchall()))
    assert sorted(str([plain(row[c]) for c in columns]) for row in df.collect()) == expected


def test_a_query_writes_its_tables_once(spark, monkeypatch):
    written = []
    real = scratch.materialize
    monkeypatch.setattr(scratch, "materialize", lambda df, name: written.append(name) or real(df, name))
    plan = C.QUERIES["recall_at_k"](spark, SF)._jdf.queryExecution().toString()
    assert sorted(written) == ["evidence", "records"] and "documents.parquet" not in plan


def test_categories_against_plain_signals(spark):
    rows = FV.diagnostics(C._pairs(spark, SF)).withColumn("found", failures.categories()).collect()
    assert len(rows) > 20
    norm = {r["s1_id"] + r["target_id"]: r for r in C._pairs(spark, SF).select("s1_id", "target_id", T.normalize_name("name1").alias("a"), T.normalize_name("name2").alias("b")).collect()}
    for r in rows:
        pair = norm[r["s1_id"] + r["target_id"]]
        assert r["name_char_ratio"] == round(difflib.SequenceMatcher(None, pair["a"], pair["b"]).ratio(), 4)
        expected = set()
        if r["name_jaccard"] >= 0.5 or r["name_char_ratio"] >= 0.75 or r["name_contained"]:
            expected.add("name alike")
        if r["both_no_digits"]:
            expected.add("no digits")
        elif r["either_no_digits"]:
            expected.add("digits on one side")
        assert expected <= set(r["found"]) and r["found"]
    counts = {r["category"]: r["pairs"] for r in failures.histogram(C._pairs(spark, SF)).collect()}
    assert sum(counts.values()) == sum(len(r["found"]) for r in rows)


@pytest.mark.parametrize(("a", "b"), [("", ""), ("abc", ""), ("abcd", "bcda"), ("kitten", "sitting"), ("aaaa", "aa"), ("xyz", "abc"), ("ünï", "nïx")])
def test_common_substring(a, b):
    plain = max((n for n in range(len(a) + 1) for i in range(len(a) - n + 1) if a[i : i + n] in b), default=0)
    assert S.common_substring(a, b) == S.common_substring(b, a) == plain


def test_phones_in_digits_of_any_script(spark):
    rows = [("call +९१ ९८७६५४३२१० now", "India"), ("call 9876543210", "India")]
    df = spark.createDataFrame(rows, "name string, country string")
    found = [r[0] for r in df.select(N.anchors("name", F.lit(""), "country")["PHONE"]).collect()]
    assert found == ["९८७६५४३२१०", "9876543210"]


def test_scripts(spark):
    rows = [("राम", "devanagari"), ("বাংলা", "bengali"), ("தமிழ்", "tamil"), ("മലയാളം", "malayalam"), ("plain", None)]
    df = spark.createDataFrame(rows, "name string, script string")
    for r in df.select("script", *[T.has_script("name", s).alias(s) for s in T.SCRIPTS], T.has_indic("name").alias("indic")).collect():
        assert {s for s in T.SCRIPTS if r[s]} == ({r["script"]} if r["script"] else set())
        assert r["indic"] == (r["script"] is not None)


def test_lists_are_replaced_and_never_lost(spark, tmp_path):
    path = f"file://{tmp_path}/lists"
    one = spark.createDataFrame([("S1-1", 1, "a,b")], "source1_entity_id string, ord long, ids string")
    tsv.write_lists(one, path)
    tsv.write_lists(one.withColumn("ids", F.lit("c")), path)
    assert [tuple(r) for r in tsv.read_lists(spark, path).collect()] == [("S1-1", ["c"])]
    assert [p.name for p in tmp_path.iterdir()] == ["lists"]


def test_a_cache_is_made_once(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(3):
        assert scratch.cached(spark, f"file://{tmp_path}/c", make).count() == 3
    assert len(made) == 1


def test_first_rows_and_short_results(spark):
    rows = E.records(spark, SF)
    assert [r["ord"] for r in tsv.first_rows(rows, 5).collect()] == [0, 1, 2, 3, 4] or tsv.first_rows(rows, 5).count() == 5
    assert tsv.first_rows(rows, None).count() == rows.count()


def test_drift_and_zeros(spark):
    rows = [("true_pairs", 200.0), ("true_pairs_found", 190.0), ("pairs_twice", 1.0), ("bad_targets", 0.0)]
    report = spark.createDataFrame(rows, "metric string, value double")
    broken = lambda **e: sorted((r["metric"], r["why"]) for r in validate.broken_invariants(report, e).collect())
    assert broken(found=95.0) == [("pairs_twice", "not zero")]
    assert broken(found=95.2) == [("pairs_twice", "not zero"), ("true_pairs_found", "drift")]


def test_bake_off_of_nothing(spark):
    flags = ", ".join(f"has_{f} boolean" for f in "abcdfgi")
    none = spark.createDataFrame([], f"s1_id string, target_id string, {flags}, evidence_count int")
    truth = spark.createDataFrame([], "s1_id string, target_id string")
    assert metrics.bake_off(truth, none, {"x": ranking.PRODUCTION}).count() == 0


def test_no_query_names_a_folder_of_this_machine():
    assert not [n for n, sql in __spark_entry__.oracle_sql().items() if re.search(r"/(tmp|root)/", sql)]


def test_boosting_that_stops(spark):
    rows = [(f"S1-{i % 50}", float(i * 7919 % 101), float(i * 31 % 17), int(i * 104729 % 1009 % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "s1_id string, a double, b double, label int")
    df = sampling.holdout(learning.weighted(df)).withColumnRenamed("held_out", "validation")
    model = learning.train(df, ["a", "b"], {"x": learning.stopping(rounds=15)})
    assert model["x"].stages[-1].getNumTrees < 15  # nothing follows from a and b
    assert all(0 <= r["p"] <= 1 for r in learning.score(df, model).collect())
