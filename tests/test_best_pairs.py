"""The best targets found in cells of classes, against a ranking of the evidence of all pairs."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from kindred.operators import best_pairs, blocking, keys, ranking

SF = "/root/testdata/sf0.001"
CAPS = {"d": 4, "f": 30, "g": 3, "i": 3}


@pytest.fixture(scope="module")
def records(spark):
    """Names and addresses that are shared by many, some records twice alike, some without a name or country."""
    rows = [(f"S{1 + i % 3}-{i}", "maurice gardens hotel", f"{i % 11} harbour street north", "us", i) for i in range(150)]
    rows += [(f"S{1 + i % 3}-{i}", f"maurice place{chr(97 + i % 5)}", f"{i % 7} harbour street{i % 2}", "us", i) for i in range(200, 300)]
    rows += [(f"S{1 + i % 3}-{i}", f"word{i % 13} place", f"{i % 5} {'grand' * (i % 2)} road east", "fr", 400 - i) for i in range(300, 400)]
    rows += [("S1-999", "nobody", "", "us", 999), ("S2-998", "", "", None, 998), ("S3-997", None, None, "us", 997)]
    return spark.createDataFrame(rows, "entity_id string, name string, address string, country string, ord long").cache()


def sides(df):
    return df.filter("entity_id like 'S1%'"), df.filter("entity_id not like 'S1%'")


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()))


PLAIN, SMALL = (512, 4096, 1 << 19), (3, 5, 7)


@pytest.mark.parametrize(
    "most, names, parts", [(25, keys.PRODUCTION, PLAIN), (4, keys.PRODUCTION, SMALL), (1, keys.PRODUCTION, SMALL), (4, ("d", "b", "e", "h", "a"), SMALL)]
)
def test_ranks_as_all_pairs_do(records, monkeypatch, most, names, parts):
    for name, size in zip(("SHARE", "BLOCK", "PAIRS"), parts, strict=True):
        monkeypatch.setattr(best_pairs, name, size)
    config = ranking.RankingConfig(ranking.PRODUCTION.weights, 0.5, most)
    expected = ranking.rank(blocking.evidence(*sides(records), names, CAPS), config)
    found = ranking.rank_classes(best_pairs.classes(*sides(records), config, names, CAPS), config)
    assert rows(found, expected.columns) == rows(expected, expected.columns)
    assert expected.count() > 100


def test_repeated_ids_are_ranked_as_well(spark, records):
    twice = records.unionByName(records.filter("ord % 7 = 0").withColumn("name", F.lit("maurice placeb"))).unionByName(records.filter("ord % 5 = 0"))
    config = ranking.RankingConfig(ranking.PRODUCTION.weights, 0.5, 4)
    names = ("a", "b", "c")
    expected = ranking.rank(blocking.evidence(*sides(twice), names, {}), config)
    found = ranking.rank_classes(best_pairs.classes(*sides(twice), config, names, {}), config)
    assert rows(found, expected.columns) == rows(expected, expected.columns)


def test_only_the_best_of_a_common_key_leave_a_task():
    """A key of 400 by 1000 classes gives 25 rows an S1 class, not all 400,000 pairs."""
    one, n = pa.array(np.full(1400, 7)), pa.array(np.arange(10, 1410))
    table = pa.table({"cell": one, "kind": pa.array(np.zeros(1400, np.int32)), "a": one, "b": n})
    left = table.slice(0, 400).append_column("s1_class", pa.array([f"S1-{i}" for i in range(400)]))
    right = table.slice(400).append_column("target_class", pa.array([f"S2-{i}" for i in range(1000)]))
    bits, place = best_pairs.places(("a", "b"), ranking.PRODUCTION)
    found = best_pairs.best_of_bin(left, right, ("a", "b"), bits, place, 25)
    assert found.num_rows == 400 * 25
    assert set(found["target_class"].to_pylist()) == set(sorted(f"S2-{i}" for i in range(1000))[:25])


@pytest.mark.parametrize("name", ["gated_scores", "macro_f05", "macro_f05_by_country", "micro_scores", "multi_match"])
def test_query_lists_no_pairs(spark, monkeypatch, name):
    """The query has the result of its SQL without evidence between all classes."""

    def listed(*args, **kwargs):
        raise AssertionError("all pairs are listed")

    monkeypatch.setattr(blocking, "classes", listed)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    found = con.execute(__spark_entry__.oracle_sql()[name])
    at = [c[0] for c in found.description]
    expected = spark.createDataFrame(found.fetchall(), df.select(*at).schema)
    assert sorted(map(str, df.select(*at).collect())) == sorted(map(str, expected.collect()))
