import math
import os
import random
from collections import Counter

import numpy as np
import pytest

from kindred.llm import langid, queries, toxicity

LANGS = {"xx": "bakedo fumi galo pi", "yy": "schtrü grönk plätz ung", "zz": "ελα μου τωρα και"}


def made(rng, lang, n=60):
    parts = LANGS[lang].split()
    return " ".join("".join(rng.choice(parts)[:3] for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = [(i, made(rng, lang), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 40)]
    return spark.createDataFrame([*rows, (None, None, "xx"), (900, "", None)], "doc_id long, text string, lang string")


def test_profiles_tell_languages(spark, docs, awkward, empty):
    profiles = langid.fit(docs, sample=20)
    assert profiles.langs == ["xx", "yy", "zz"]
    rng = random.Random(8)
    for lang in LANGS:
        for n in (3, 60, 3000):
            found, score = profiles.predict(made(rng, lang, n).upper())
            assert found == lang and 0 < score <= 1
    for blank in (None, "", " 12 -- 3 !", "\u0301 1"):
        assert profiles.predict(blank) == ("und", 0.0)
    out = langid.predict(awkward, profiles)
    assert out.columns == [*awkward.columns, "lang_pred", "lang_score"] and out.count() == awkward.count()
    assert all(0 <= r["lang_score"] <= 1 for r in out.collect())
    none = langid.fit(empty)
    assert none.predict("some text") == ("und", 0.0)


def test_grams_and_distance_by_hand():
    point = lambda *cs: sum((ord(c) if c else langid.BORDER) << 21 * i for i, c in enumerate(reversed(cs)))
    grams = langid.grams_of("Ab, a").tolist()
    assert sorted(grams) == sorted(
        [point("a"), point("b"), point("a"), point(None, "a"), point("a", "b"), point("b", None), point(None, "a"), point("a", None)]
        + [point(None, "a", "b"), point("a", "b", None), point(None, "a", None)]
    )
    p = langid.Profiles.of({"l": [point("a"), point("b")], "m": [point("b")]}, 3)
    # a: 0 apart in l, 3 in m; b: 0 and 1; and what neither has counts 3 each.
    top = langid.top_grams(langid.grams_of("a"), 3).tolist()
    assert top[0] == point("a") and p.predict("a") == ("l", 1 - (0 + 3 + 3) / 9)


def toxic_docs(rng, n, bad):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(20, 80))]
        label = int(i % 3 == 0)
        if label:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), label))
    return rows


def test_toxicity_learns_words_and_their_misspellings(spark, awkward, empty):
    rng = random.Random(4)
    rows = toxic_docs(rng, 1200, ["vormulik", "zuxtrapo", "kwynzzle"])
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scorer = model.scorer()
    known = toxic_docs(rng, 300, ["vormulik", "zuxtrapo", "kwynzzle"])
    assert sum((scorer.score(t) >= toxicity.THRESHOLD) == bool(y) for _, t, y in known) >= 0.9 * len(known)
    misspelt = toxic_docs(rng, 300, ["vormullik", "zuxtrap0", "kwynzle"])
    mean = lambda label: sum(scorer.score(t) for _, t, y in misspelt if y == label) / sum(y == label for *_, y in misspelt)
    assert mean(1) > 3 * mean(0)
    out = toxicity.score(awkward, model)
    assert out.count() == awkward.count() and all(0 <= r["toxicity"] <= 1 for r in out.collect())
    assert 0 <= scorer.score(None) == scorer.score(" ") <= 1
    blank = toxicity.fit(empty, labels.limit(0))
    assert blank.scorer().score("anything") == pytest.approx(0.5)
    again = toxicity.fit(docs.repartition(3), labels.repartition(2))
    assert (again.numbers == model.numbers).all() and again.bias == model.bias


def trained(texts, labels):
    """A model of bags without rare buckets, as fit makes it."""
    bags = [toxicity.features(t, toxicity.Subwords()) for t in texts]
    docs = Counter(i for ids, _ in bags for i in ids.tolist())
    kept = [[docs[i] >= toxicity.LEAST_DOCS for i in ids.tolist()] for ids, _ in bags]
    return toxicity.train([(ids[k], w[k]) for (ids, w), k in zip(bags, kept, strict=True)], labels)


def test_scores_are_a_softmax_of_the_mean_of_words():
    model = trained(["good text here and there", "bad vile words, badly put"] * 8, [0, 1] * 8)
    scorer = model.scorer()
    for text in ("bad", "Good vile text!", "unseen wörds _x_ here " + "z" * 3000, "漢字 " * 5 + "bad", None, "", "  \n"):
        words = (text or "").split()
        bags = [toxicity.subwords(w) for w in words]
        means = [sum(float(model.numbers[i]) for i in b) / len(b) for b in bags]
        logit = model.bias + (sum(means) / len(means) if means else 0)
        exp = [math.exp(0), math.exp(logit)]
        assert scorer.score(text) == pytest.approx(exp[1] / sum(exp), rel=1e-6)


def test_a_fit_reads_one_row_of_a_repeated_id(spark):
    rng = random.Random(6)
    rows = toxic_docs(rng, 300, ["vormulik", "zuxtrapo", "kwynzzle"])
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    plain = toxicity.fit(docs, labels)
    more = toxicity.fit(docs.union(docs.filter("doc_id = 3")).union(docs.filter("doc_id < 3")), labels.union(labels))
    assert (plain.numbers == more.numbers).all()


def test_profiles_against_plain_counts(spark, docs):
    profiles = langid.fit(docs, sample=10_000)
    counts = {}
    for r in docs.collect():
        if r["lang"]:
            counts.setdefault(r["lang"], Counter()).update(langid.grams_of(r["text"]).tolist())
    for j, lang in enumerate(profiles.langs):
        ranked = sorted(counts[lang], key=lambda g: (-counts[lang][g], g))[: langid.PROFILE]
        places = {int(g): int(r) for g, r in zip(profiles.vocab, profiles.ranks[:-1, j], strict=True) if r < profiles.size}
        assert places == {g: i for i, g in enumerate(ranked)}


def test_as_many_languages_as_there_are(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"text {chr(97 + i % 26)}{chr(97 + i // 26)}", f"l{i:03}") for i in range(300)], "doc_id long, text string, lang string")
    assert len(langid.fit(rows).langs) == 300
    monkeypatch.setattr(langid, "MOST_LANGS", 299)
    with pytest.raises(ValueError, match="300 values"):
        langid.fit(rows)


def test_a_small_cache_changes_no_score(monkeypatch):
    model = trained(["good text here", "bad vile words"] * 6, [0, 1] * 6)
    text = "bad words here and vile text"
    whole = model.scorer().score(text)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 2)
    assert model.scorer().score(text) == pytest.approx(whole)


def test_long_runs_are_read_to_their_end(monkeypatch):
    rng = random.Random(5)
    rows = toxic_docs(rng, 900, ["vormulik", "zuxtrapo", "kwynzzle"])
    model = trained([t for _, t, _ in rows], [y for *_, y in rows])
    for sep in ("_", "", "-"):
        clean = sep.join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(30))
        hidden = clean[:100] + sep + "vormulik" + sep + clean[100:]
        assert model.scorer().score(hidden) > model.scorer().score(clean) + 0.01
        learned = lambda text: dict(zip(*(a.tolist() for a in toxicity.features(text, toxicity.Subwords())), strict=True))
        assert set(learned(hidden)) >= set(toxicity.grams_of("vormulik", 0, 8))
        # Counting by chunks gives what listing gives.
        for text in (hidden, "漢字仮名" * 40 + hidden, hidden * 3 + " ab " + clean):
            score, bag = model.scorer().score(text), learned(text)
            with monkeypatch.context() as m:
                m.setattr(toxicity, "LONG_WORD", 1)
                m.setattr(toxicity, "RUN_CHUNK", 7)
                assert model.scorer().score(text) == pytest.approx(score, rel=1e-6)
                assert learned(text) == pytest.approx(bag, rel=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in queries.op1_language_id(spark, sf).collect() if r["held_out"]]
    assert len(rows) > 200 and sum(r["lang_pred"] == docs[r["doc_id"]] for r in rows) >= 0.97 * len(rows)
    assert {r["predicted"] for r in queries.op9_toxicity(spark, sf).collect()} <= {0, 1}


def test_a_task_learns_and_the_driver_does_not(spark, monkeypatch):
    rows = toxic_docs(random.Random(8), 300, ["vormulik", "zuxtrapo", "kwynzzle"])
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    here = os.getpid()
    monkeypatch.setattr(toxicity, "train", lambda *_, **__: toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), float(os.getpid())))
    model = toxicity.fit(docs, labels)
    assert model.bias != here and len(model.numbers) == toxicity.BUCKETS
