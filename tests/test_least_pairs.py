"""Negatives drawn in cells of keys, against those drawn from a list of all pairs."""

import functools
import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from kindred.operators import best_pairs, blocking, keys, learning, least_pairs, sampling

SF = "/root/testdata/sf0.001"
CAPS = {"d": 4, "f": 30, "g": 3, "i": 3}


@pytest.fixture(scope="module")
def sides(spark):
    """Names and addresses that are shared by many, some records without a name or country."""
    rows = [(f"S{1 + i % 3}-{i}", "maurice gardens hotel", f"{i % 11} harbour street north", "us", i) for i in range(150)]
    rows += [(f"S{1 + i % 3}-{i}", f"maurice place{chr(97 + i % 5)}", f"{i % 7} harbour street{i % 2}", "us", i) for i in range(900, 1100)]
    rows += [("S1-9999", "nobody", "", "us", 9999), ("S2-998", "", "", None, 998), ("S3-997", None, None, "us", 997)]
    df = spark.createDataFrame(rows, "entity_id string, name string, address string, country string, ord long").cache()
    return df.filter("entity_id like 'S1%'"), df.filter("entity_id not like 'S1%'")


@pytest.fixture(scope="module")
def positives(spark, sides):
    """Some pairs of the evidence, of some S1 nearly all, and one without evidence."""
    some = blocking.evidence(*sides, caps=CAPS).select("s1_id", "target_id").filter(F.xxhash64("s1_id", "target_id") % 40 == 0)
    most = blocking.evidence(*sides, caps=CAPS).select("s1_id", "target_id").filter("s1_id = 'S1-3' and target_id <> 'S2-1'")
    return some.union(most).union(spark.createDataFrame([("S1-9999", "S2-998")], some.schema)).distinct().cache()


def rows(df):
    return sorted(map(tuple, df.select("s1_id", "target_id").collect()))


@pytest.mark.parametrize("parts, names", [((512, 4096, 1 << 19), keys.PRODUCTION), ((3, 5, 7), keys.PRODUCTION), ((3, 5, 7), ("d", "b", "a"))])
def test_draws_what_a_list_of_all_pairs_gives(sides, positives, monkeypatch, parts, names):
    for name, size in zip(("SHARE", "BLOCK", "PAIRS"), parts, strict=True):
        monkeypatch.setattr(best_pairs, name, size)
    expected = sampling.negatives(positives, blocking.evidence(*sides, names, CAPS).select("s1_id", "target_id"), 2, 3)
    found = rows(least_pairs.negatives(positives, *sides, names, CAPS, ratio=2, least=3))
    assert found == rows(expected) and len(found) > 300


def test_repeated_ids_draw_as_well(sides, positives):
    twice = [x.unionByName(x.filter("ord % 7 = 0").withColumn("name", F.lit("maurice placeb"))) for x in sides]
    expected = sampling.negatives(positives, blocking.evidence(*twice, caps=CAPS).select("s1_id", "target_id"))
    assert rows(least_pairs.negatives(positives, *twice, caps=CAPS)) == rows(expected)


@pytest.mark.parametrize("long", [3, 60])
def test_digests_are_those_of_md5(long):
    left, right = [f"S1-{'7' * n}" for n in (1, 4, long)], [f"é{'x' * n}" for n in range(20)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(3), np.arange(20)))
    expected = [int(hashlib.md5(f"42:{left[a]}|{right[b]}".encode()).hexdigest()[:8], 16) for a, b in zip(i, j, strict=True)]
    assert least_pairs.Digests(left, right, 42).of(i, j).tolist() == expected


@pytest.mark.parametrize("name", ["training_negatives", "classifier_scores"])
def test_query_lists_no_pairs(spark, monkeypatch, name):
    def never(*_):
        raise AssertionError("all pairs were listed")

    monkeypatch.setattr(blocking.Classes, "members", never)
    monkeypatch.setattr(learning, "boosted", functools.partial(learning.boosted, rounds=2))
    df = __spark_entry__.queries()[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    drawn = df.filter("label = 0") if "label" in df.columns else df
    assert rows(drawn) == sorted(con.execute(f"SELECT s1_id, target_id FROM ({__spark_entry__.oracle_sql()['training_negatives']})").fetchall())


def test_classifier_scores_boosts_as_ml1_says(spark, monkeypatch):
    class Asked(Exception):
        pass

    def ask(rows, models):
        raise Asked(models["boosted"])

    monkeypatch.setattr(learning, "train", ask)
    with pytest.raises(Asked) as asked:
        __spark_entry__.queries()["classifier_scores"](spark, SF)
    model = asked.value.args[0]
    assert (model.getMaxIter(), model.getMaxDepth(), model.getStepSize()) == (100, 6, 0.1)
