"""Evidence between classes of records with the same keys, against evidence of all pairs."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from kindred.operators import blocking, graph, keys, metrics, multilingual, ranking, validate

SF = "/root/testdata/sf0.001"
CAPS = {"d": 4, "f": 3, "g": 3, "i": 3}


@pytest.fixture(scope="module")
def sides(spark):
    """Many copies of one record, more than a key's cap and than a ranking keeps, beside others that share some keys."""
    rows = [(f"S{1 + i % 3}-{i}", "maurice gardens hotel", f"{i % 2} harbour street north", "us", i) for i in range(120)]
    rows += [(f"S{1 + i % 3}-{i}", f"maurice place{chr(97 + i % 5)}", f"{i % 7} harbour street", "us", i) for i in range(200, 230)]
    rows += [("S1-999", "nobody", "", "us", 999), ("S2-998", "", "", None, 998)]
    df = spark.createDataFrame(rows, "entity_id string, name string, address string, country string, ord long").cache()
    return df.filter("entity_id like 'S1%'"), df.filter("entity_id not like 'S1%'")


@pytest.fixture(scope="module")
def plain(sides):
    """Evidence by joining all pairs."""
    left = keys.key_table(sides[0]).select("key_type", "key", F.col("entity_id").alias("s1_id"))
    right = blocking.capped(keys.key_table(sides[1]), CAPS).select("key_type", "key", F.col("entity_id").alias("target_id"))
    flags = [F.bool_or(F.col("key_type") == f).alias(f"has_{f}") for f in blocking.FLAGS]
    rows = left.join(right, ["key_type", "key"]).groupBy("s1_id", "target_id").agg(*flags)
    return rows.withColumn("evidence_count", sum((F.col(f"has_{f}").cast("int") for f in blocking.FLAGS), F.lit(0))).cache()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_classes_have_the_evidence_of_their_members(sides, plain):
    found = blocking.classes(*sides, caps=CAPS)
    assert plain.count() > 3000 and found.pairs.count() < 600  # copies meet once, not once for each pair of them
    assert rows(found.members(), *plain.columns) == rows(plain, *plain.columns)
    some = plain.filter(F.xxhash64("s1_id", "target_id") % 3 == 0).select("s1_id", "target_id")
    assert rows(found.of(some.union(some)), *plain.columns) == rows(plain.join(some, ["s1_id", "target_id"]), *plain.columns)
    assert rows(found.counts(), "s1_id", "n") == rows(plain.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "n")
    scope = sides[0].select(F.col("entity_id").alias("s1_id"))
    assert metrics.volume(scope, found.counts()).collect() == metrics.candidate_volume(scope, plain).collect()
    moved = sides[1].withColumn("country", F.when(F.col("ord") % 5 == 0, "fr").otherwise(F.col("country")))
    across = validate.classes_across(found, sides[0], moved).first()[0]
    assert across == validate.cross_country(plain, sides[0], moved).count() > 0


@pytest.mark.parametrize("most", [0, 1, 3, 25])
def test_classes_rank_as_their_members(sides, plain, most):
    config = ranking.RankingConfig(ranking.PRODUCTION.weights, 0.5, most)
    expected = ranking.rank(plain, config)
    assert rows(ranking.rank_classes(blocking.classes(*sides, caps=CAPS), config), *expected.columns) == rows(expected, *expected.columns)


def test_stars_connect_what_pairs_connect(sides, plain):
    pairs = plain.filter("has_a").select(F.col("s1_id").alias("u"), F.col("target_id").alias("v"))
    stars = blocking.key_stars(*sides, "a")
    assert stars.count() < 200 < pairs.count()
    assert rows(graph.components(stars), "node", "component") == rows(graph.components(pairs), "node", "component")
    assert rows(blocking.reached(*sides, "a").distinct(), "target_id") == rows(pairs.select(F.col("v").alias("target_id")).distinct(), "target_id")


@pytest.mark.parametrize("name", ["match_components", "needed_records", "broken_invariants"])
def test_query_of_classes_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    found = con.execute(__spark_entry__.oracle_sql()[name])
    at = [c[0] for c in found.description]
    assert sorted(at) == sorted(df.columns)
    assert sorted(map(str, df.select(*at).collect())) == sorted(map(str, df.sparkSession.createDataFrame(found.fetchall(), df.select(*at).schema).collect()))


def test_pairs_of_a_common_name_are_written_by_several_tasks(spark, sides, plain, monkeypatch):
    monkeypatch.setattr(blocking, "PART", 5)
    found = multilingual.classes_with_fallback(blocking.classes(*sides, ("a", "d"), {"d": 4}))
    every = plain.filter("has_a").select("s1_id", "target_id"), plain.filter("has_d").select("s1_id", "target_id")
    expected = multilingual.with_fallback(*every)
    assert rows(found, "s1_id", "target_id") == rows(expected, "s1_id", "target_id")
    written = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(written) < sum(written) * 0.6
