"""Blocking, ranking, assignment, evaluation, sources and the stream on small records."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.functions import text as T
from kindred.operators import blocking, fusion, graph, keys, knn, learning, metrics, ranking, sampling, validate
from kindred.plans import presets
from kindred.sources import tsv
from kindred.streaming import probe

RECORD = "entity_id string, name string, address string, country string, ord long"
ROWS = [
    ("S1-1", "Acme Corporation", "100 Main Street", "US"),
    ("S1-2", "Boulangerie Paris", "5 Rue de Rivoli", "FR"),
    ("S1-3", "Unknown Entity XYZ", "999 Nowhere Road", "US"),
    ("S2-10", "Acme Corp", "100 Main St", "US"),
    ("S2-20", "Acme International", "100 Main Street", "US"),
    ("S2-30", "Boulangerie Paris SARL", "5 Rue de Rivoli", "FR"),
    ("S2-40", "Acme Corp Cross Country", "100 Main St", "FR"),
    ("S3-100", "Acme Corporation Inc", "100 Main Street Ave", "US"),
    ("S3-200", "Boulangerie de Paris", "5 Rue Rivoli", "FR"),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], RECORD).cache()


def sides(records):
    return records.filter("entity_id like 'S1%'"), records.filter("entity_id not like 'S1%'")


def pairs(df):
    return {(r[0], r[1]) for r in df.select("s1_id", "target_id").collect()}


def test_candidates_end_to_end(records):
    found = ranking.rank(blocking.evidence(*sides(records)))
    got = pairs(found)
    assert {("S1-2", "S2-30"), ("S1-2", "S3-200")} <= got and len([p for p in got if p[0] == "S1-1"]) >= 2
    assert ("S1-1", "S2-40") not in got and not [p for p in got if p[0] == "S1-3"]
    assert validate.cross_country(found, *sides(records)).count() == 0
    listed = {r[1]: r[2] for r in tsv.lists_of(sides(records)[0], found, "candidate_entity_ids").collect()}
    assert set(listed) == {"S1-1", "S1-2", "S1-3"} and listed["S1-3"] == ""


def test_result_does_not_depend_on_partitions(records):
    base = ranking.rank(blocking.evidence(*sides(records))).select("s1_id", "target_id", "score", "rank")
    for n in (1, 7):
        again = ranking.rank(blocking.evidence(*sides(records.repartition(n)))).select("s1_id", "target_id", "score", "rank")
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, base.collect()))


def test_keys_need_all_parts(spark):
    rows = [("x", "Maure Williams", "85 Wayne Ave", "US", 0), ("y", "Maure", None, "US", 1), ("z", None, "no digits here", None, 2), ("w", "Apex Logistics International", "", "US", 3)]
    found = {(r["entity_id"], r["key_type"]): r["key"].split(keys.SEPARATOR) for r in keys.key_table(spark.createDataFrame(rows, RECORD), tuple(keys.KEYS)).collect()}
    assert found["x", "a"] == ["US", "maure williams"] and found["x", "b"] == ["US", "maur", "85"] and found["x", "e"] == ["US", "maure", "85"]
    assert found["x", "c"] == ["US", "85_wayne"] and found["w", "g"] == ["US", "apex", "logistics"] and found["w", "h"] == ["US", "logistics"]
    assert {k for e, k in found if e == "y"} == {"a", "d"} and not [k for e, k in found if e == "z"]


def test_caps_take_the_first_read(spark):
    rows = [(f"S2-{i}", "Orelee's Shop", "", "US", i) for i in (3, 1, 2)] + [("S2-1", "Orelee's Shop", "", "US", 1)]
    table = keys.key_table(spark.createDataFrame(rows, RECORD), ("d",))
    assert sorted(r["entity_id"] for r in blocking.capped(table, {"d": 2}).collect()) == ["S2-1", "S2-2"]
    stats = blocking.posting_stats(spark.createDataFrame([(f"S2-{i}", "Same Name", "", "US", i) for i in range(30)], RECORD), ("a",)).first()
    assert (stats["unique_keys"], stats["p50"], stats["gt_25"], stats["gt_50"]) == (1, 30, 1, 0)


def flagged(spark, rows):
    cols = [f"has_{f}" for f in blocking.FLAGS]
    data = [(s, t, *[f in fl for f in blocking.FLAGS], len(fl)) for s, t, fl in rows]
    return spark.createDataFrame(data, "s1_id string, target_id string, " + ", ".join(f"{c} boolean" for c in cols) + ", evidence_count int")


def test_scores_and_ties(spark):
    rows = [("s", "A", "a"), ("s", "B", "b"), ("s", "C", "c"), ("s", "AB", "ab"), ("s", "ABC", "abc"), ("t", "S2-200", "a"), ("t", "S2-100", "a")]
    got = {r["target_id"]: (r["score"], r["rank"]) for r in ranking.rank(flagged(spark, rows), ranking.RankingConfig()).collect()}
    assert [got[k][0] for k in ("A", "B", "C", "AB", "ABC")] == [3.0, 2.0, 1.5, 5.0, 6.5]
    assert got["S2-100"][1] == 1 and got["S2-200"][1] == 2
    assert ranking.rank(flagged(spark, [("s", "DG", "dg")]), ranking.PRODUCTION).first()["score"] == 3.5
    many = flagged(spark, [("s", f"S2-{i}", "a") for i in range(40)])
    for k in (10, 25):
        assert ranking.rank(many, ranking.RankingConfig(most=k)).count() == k


def test_cascade_fills_what_is_left(spark):
    def prepared(rows):
        df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RECORD)
        return keys.tier_columns(df, T.clean_name("name"))

    s1 = prepared([("S1-1", "Acme Foods", "1 Elm, TX", "us"), ("S1-2", "Acmeville Bar", "9 X, TX", "us"), ("S1-3", "Lonely", "", "us")])
    exact = [(f"S2-{i}", "Acme Foods", "5 Oak, TX", "us") for i in range(4)]
    others = [("S2-8", "Acme Foods", "2 Elm, NY", "us"), ("S2-9", "Acme Bakery", "1 Elm, TX", "us")]
    out = blocking.cascade(s1, prepared(exact + others), blocking.TIGHT, 3).collect()
    assert {r["target_id"] for r in out if r["s1_id"] == "S1-1" and r["tier"] == 1} == {e[0] for e in exact}
    assert not [r for r in out if r["s1_id"] == "S1-1" and r["tier"] > 1]
    assert {r["tier"] for r in out if r["s1_id"] == "S1-2"} == {6} and not [r for r in out if r["s1_id"] == "S1-3"]
    more = blocking.cascade(s1, prepared(exact + others), blocking.TIGHT, 6).collect()
    assert {r["target_id"]: r["tier"] for r in more if r["s1_id"] == "S1-1"} == dict.fromkeys([e[0] for e in exact], 1) | {"S2-8": 2, "S2-9": 3}


def test_greedy_by_component_is_greedy_over_all(spark):
    rng = random.Random(3)
    nodes = [f"S{s}-{i}" for s in (1, 2, 3) for i in range(25)]
    edges = {}
    while len(edges) < 60:
        u, v = sorted(rng.sample(nodes, 2))
        if u[:2] != v[:2]:
            edges[u, v] = round(rng.uniform(0.5, 1), 1)
    rows = [(u, v, w) for (u, v), w in edges.items()]
    df = spark.createDataFrame(rows, "u string, v string, w double")
    ordered = sorted([r for r in rows if r[2] >= 0.7], key=lambda r: (-r[2], r[0], r[1]))
    expected = {s: (m.get("S2"), m.get("S3")) for s, m in graph.greedy(ordered).items()}
    out = graph.assign(df)
    got = {r["s1_id"]: (r["s2_id"], r["s3_id"]) for r in out.collect()}
    assert got == expected
    used = [t for m in got.values() for t in m if t]
    assert len(used) == len(set(used))
    assert graph.assembled(out).filter("size(matched) = 0").count() == 0


def test_components_in_one_task_and_in_many(spark):
    rng = random.Random(6)
    edges = [(f"n{rng.randrange(80):02}", f"n{rng.randrange(80):02}") for _ in range(60)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    df = spark.createDataFrame(edges, "u string, v string").repartition(7)
    for most in (1_000_000, 15):
        found = {r["node"]: r["component"] for r in graph.components(df, task_edges=most).collect()}
        assert found == {n: find(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}


def test_bridges_in_either_order():
    for edges in ([("S1-1", "S2-1", 0.9), ("S2-1", "S3-1", 0.8)], [("S2-1", "S3-1", 0.95), ("S1-1", "S2-1", 0.9)]):
        assert graph.greedy(edges) == {"S1-1": {"S2": "S2-1", "S3": "S3-1"}}
    contested = [("S1-1", "S2-1", 0.9), ("S1-2", "S2-1", 0.8), ("S1-2", "S2-2", 0.7)]
    assert graph.greedy(contested) == {"S1-1": {"S2": "S2-1"}, "S1-2": {"S2": "S2-2"}}


def test_transitive_checks_addresses(spark):
    rows = [("S2-1", "Acme", "12 oak street", "us"), ("S3-1", "Acme", "99 elm road", "us"), ("S3-2", "Acme", "12 oak lane", "us"), ("S2-2", "Beta", "x", "us"), ("S3-3", "Beta", "y", "us")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RECORD)
    m = spark.createDataFrame([("S1-1", "S2-1", None), ("S1-2", None, "S3-3"), ("S1-3", None, None)], "s1_id string, s2_id string, s3_id string")
    got = {r["s1_id"]: (r["s2_id"], r["s3_id"]) for r in graph.transitive(m, df).collect()}
    assert got == {"S1-1": ("S2-1", "S3-2"), "S1-2": ("S2-2", "S3-3"), "S1-3": (None, None)}
    assert {r["s3_id"] for r in graph.transitive(m, df, check_address=False).filter("s1_id = 'S1-1'").collect()} == {"S3-1"}


def test_scores_of_empty_sides(spark):
    scope = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "s1_id string, country string")
    truth = spark.createDataFrame([("b", "1"), ("c", "1"), ("c", "2")], "s1_id string, target_id string")
    found = spark.createDataFrame([("c", "1"), ("d", "9")], "s1_id string, target_id string")
    rows = {r["s1_id"]: r["f05"] for r in metrics.entity_scores(metrics.confusion(scope, truth, found)).collect()}
    assert rows["a"] == 1 and rows["b"] == 0 and rows["d"] == 0 and rows["c"] == pytest.approx(1.25 * 0.5 / 0.75)
    m = metrics.micro(metrics.confusion(scope, truth, found)).first()
    assert (m["tp"], m["fp"], m["fn"], m["singleton_accuracy"], m["exact_accuracy"]) == (1, 1, 2, 0.5, 0.25)


def test_violations(spark, records):
    s1 = sides(records)[0]
    rows = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-1", ["S1-1"]), ("X", ["S2-1", "S2-1"])], "s1_id string, matched array<string>")
    kinds = {(r[0], r[1]) for r in validate.match_violations(rows, s1).collect()}
    assert {("S1-1", "more than one row"), ("S1-1", "matches itself"), ("X", "not an S1 id"), ("S1-2", "no row"), ("X", "unknown id")} <= kinds
    cands = rows.withColumnRenamed("matched", "candidates")
    assert ("X", "candidate twice") in {(r[0], r[1]) for r in validate.candidate_violations(cands, s1).collect()}
    with pytest.raises(ValueError):
        validate.validate_all(rows, cands, s1)
    good = s1.select(F.col("entity_id").alias("s1_id"), F.array().cast("array<string>").alias("matched"))
    validate.validate_all(good, good.withColumnRenamed("matched", "candidates"), s1)


def test_audit(spark):
    cols = "name1 string, address1 string, country1 string, name2 string, address2 string, country2 string"
    rows = [("a", "x TX", "us", "a", "x NY", "us"), ("alpha", "one", "us", "beta", "two", "us"), ("alpha", "one", "us", "alpha", "two", "us"), ("a", "x", "us", "a", "x", "france"), ("a", None, "us", None, "b", "us")]
    found = fusion.suspects(spark.createDataFrame(rows, cols))
    assert [r["reason"] for r in found.collect()] == ["state_conflict", "low_overlap", None, None]
    scored = found.withColumn("rerank_score", F.lit(-0.5))
    assert [r["reason"] for r in fusion.audited(scored).collect()] == ["low_overlap", None, None]


def test_neighbours_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(knn, "TILE", 7)
    rng = random.Random(1)
    rows = [(i, i % 3, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)] + [(99, 0, None), (98, 0, [0.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {}
    for r in knn.similar_pairs(df, df, "label", k=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"]))
    norm = lambda v: sum(x * x for x in v) ** 0.5
    for i, block, v in rows[:60]:
        sims = [(-sum(a * b for a, b in zip(v, w, strict=True)) / norm(v) / norm(w), j) for j, b2, w in rows[:60] if b2 == block and j != i]
        assert [j for _, j in sorted(got[i])] == [j for _, j in sorted(sims)[:3]]
    assert not {98, 99} & set(got)


def test_splits_keep_entities_together(spark):
    df = spark.createDataFrame([(f"e{i % 50}", i) for i in range(500)], "s1_id string, n int")
    out = sampling.holdout(df).groupBy("s1_id").agg(F.countDistinct("held_out").alias("k"), F.first("held_out").alias("h")).collect()
    assert {r["k"] for r in out} == {1} and 0 < sum(r["h"] for r in out) < 25
    pos = spark.createDataFrame([("a", "1"), ("b", "2")], "s1_id string, target_id string")
    pool = spark.createDataFrame([(str(i),) for i in range(200)], "entity_id string")
    drawn = sampling.random_negative(pos, pool)
    assert {r["s1_id"] for r in drawn.collect()} <= {"a", "b"} and drawn.join(pos, ["s1_id", "target_id"]).count() == 0
    labels = df.withColumn("y", (F.col("n") % 5 == 0).cast("int"))
    assert sampling.balanced(labels, "y", 20, "n").groupBy("y").count().filter("count = 20").count() == 2


def test_models_learn_save_and_load(spark, tmp_path):
    rng = random.Random(2)
    rows = [(float(x), rng.random(), int(x > 5)) for x in range(10) for _ in range(12)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    models = learning.train(learning.weighted(df), ["a", "b"], {"boosted": learning.boosted(depth=2, rounds=3), "logistic": learning.ensemble()["logistic"]})
    learning.save(models, str(tmp_path))
    again = learning.load(str(tmp_path), list(models))
    p = [r for r in learning.score(df, again, {"boosted": 2, "logistic": 1}).collect()]
    assert sum((r["p"] > 0.5) == bool(r["label"]) for r in p) >= 115 and all(0 <= r["p"] <= 1 for r in p)
    texts = spark.createDataFrame([("acme corp", "acme corp"), ("acme corp", "zzz"), (None, "")], "x string, y string")
    scores = [r["rerank_score"] for r in learning.rerank(texts, "x", "y").collect()]
    assert scores[0] == pytest.approx(1, abs=1e-5) and scores[1] < scores[0]


def test_tsv_round_trip(spark, tmp_path, records):
    path = tmp_path / "s2.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tA\t\tUS\nS2-2\tB\nS2-3\tनाम\t007 x\tIndia\n", encoding="utf-8")
    rows = tsv.read_records(spark, [str(path)]).orderBy("ord").collect()
    assert [(r["entity_id"], r["address"]) for r in rows] == [("S2-1", ""), ("S2-3", "007 x")] and tsv.short_rows(spark, str(path)) == 1
    assert tsv.read_records(spark, [str(path)], short_rows="pad").count() == 3
    assert tsv.read_records(spark, [str(path), str(tmp_path / "none.tsv")], strict=False).count() == 2
    lists = tsv.lists_of(sides(records)[0], ranking.rank(blocking.evidence(*sides(records))), "candidate_entity_ids")
    out = str(tmp_path / "out")
    for _ in range(2):
        tsv.write_lists(lists, out)
    back = {r["s1_id"]: r["matched"] for r in tsv.read_lists(spark, out).collect()}
    assert set(back) == {"S1-1", "S1-2", "S1-3"} and back["S1-3"] == [] and "S2-30" in back["S1-2"]
    assert tsv.read_lists(spark, str(tmp_path / "absent"), optional=True).count() == 0


def test_presets_match(spark, records):
    s1, targets = sides(records.withColumn("country", F.when(F.col("country") == "FR", "france").otherwise("us")))
    for name in ("tight_bridged", "anchored", "many_keys"):
        p = presets.PRESETS[name]
        a, b = presets.prepared(s1, p), presets.prepared(targets, p)
        rows = presets.featured(presets.candidates(a, b, p), a, b, p).withColumn("label", (F.col("ratio") > 90).cast("int"))
        rows = rows.unionByName(rows.withColumn("ratio", F.lit(10.0)).withColumn("label", F.lit(0)))
        model = learning.train(rows, list(p.features), {"m": learning.ensemble()["logistic"]})
        out = presets.match(a, b, p, model).collect()
        assert all(r["s1_id"].startswith("S1") and (r["s2_id"] or r["s3_id"]) for r in out)


def test_stream_answers_like_the_batch(spark, tmp_path, records):
    s1, targets = sides(records)
    s1.write.parquet(str(tmp_path / "in"))
    static = probe.postings(targets).cache()
    got = []

    def batch(df, _):
        got.extend(pairs(probe.rank_batch(df)))

    stream = spark.readStream.schema(s1.schema).parquet(str(tmp_path / "in"))
    query = probe.candidates(stream, static).writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert set(got) == pairs(ranking.rank(blocking.evidence(s1, targets)))
