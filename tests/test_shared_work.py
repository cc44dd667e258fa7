"""What queries share is computed once, and whole texts only where a result needs them."""

from pyspark.sql import functions as F

from kindred.operators import blocking, keys, multilingual
from kindred.plans import entities as E


def documents(spark, tmp_path):
    texts = ["A b  c\td e", " a B c d\ne ", "a b c d e f", "", "x " * 40, "x " * 41, "ΑΣ İ", None, "alone", "A b c d e"]
    rows = [(i, t, "en", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return texts


def test_records_part_only_first_words(spark, tmp_path):
    texts = documents(spark, tmp_path)
    df = E.records(spark, str(tmp_path))
    assert "md5" not in df._jdf.queryExecution().optimizedPlan().toString()
    for r in df.collect():
        words = None if texts[r["ord"]] is None else texts[r["ord"]].lower().split()
        assert r["name"] == (None if words is None else " ".join(words[:4]))
        own = [] if words is None else [" ".join(words[4:16])]
        assert r["address"] == " ".join([str(len(texts[r["ord"]] or "") // 100), *own])


def test_truth_is_of_whole_texts(spark, tmp_path):
    texts = documents(spark, tmp_path)
    words = [None if t is None else t.lower().split() for t in texts]
    expected = {(f"S1-{i}", f"S{1 + j % 3}-{j}") for i in range(0, 10, 3) for j in range(10) if j % 3 and words[i] is not None and words[i] == words[j]}
    assert {tuple(r) for r in E.truth(spark, str(tmp_path)).collect()} == expected and expected


def test_key_parts_are_computed_once(spark):
    df = spark.createDataFrame([("S1-1", "maurice gardens", "5 harbour street north", "us", 1)], "entity_id string, name string, address string, country string, ord long")
    plan = keys.key_table(df)._jdf.queryExecution().optimizedPlan().toString()
    # The address is cut into words once each for numbers, anchor (number and word), street words and longest words.
    assert plan.count("coalesce(address") == 5


def test_fallback_from_classes(spark):
    rows = [(f"S{1 + i % 3}-{i}", "maurice gardens" if i % 2 else f"maurice b{i % 4}", "5 harbour street", "us", i) for i in range(40)]
    rows += [(f"S{1 + i % 3}-{i}", f"maurice word{i}", "", "us", i) for i in range(50, 60)]
    df = spark.createDataFrame(rows, "entity_id string, name string, address string, country string, ord long").cache()
    sides = df.filter("entity_id like 'S1%'"), df.filter("entity_id not like 'S1%'")
    expected = multilingual.with_fallback(blocking.key_join(*sides, "a"), blocking.key_join(*sides, "d", 7))
    found = multilingual.classes_with_fallback(blocking.classes(*sides, ("a", "d"), {"d": 7}))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.select("s1_id", "target_id").collect()))
    assert found.count() > sides[0].count()
