import random
import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.llm import ngram_join, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def plain_components(docs, t, n):
    sets = [(i, plain_set(text, n)) for i, text in docs]
    ids = [i for i, _ in sets if i is not None]
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and Fraction(len(a & b), len(a | b)) >= t:
                lo, hi = sorted((find(i), find(j)))
                up[hi] = lo
    return {i: find(i) for i in ids}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbB éÉ\t\n\x0b\u00a0\u2003"), max_size=40)), max_size=12))
def test_sets_have_the_sizes_and_equalities_of_plain_ones(texts):
    found = list(shingles.shingle_sets(texts))
    plain = [plain_set(t) for t in texts]
    assert [len(h) for h in found] == [len(p) for p in plain]
    for i in range(len(texts)):
        for j in range(i):
            assert (found[i].tolist() == found[j].tolist()) == (plain[i] == plain[j])
            assert len(np.intersect1d(found[i], found[j])) == len(plain[i] & plain[j])


def edited(rng, words, share):
    return [rng.choice("pqrstuv") + str(rng.randrange(99)) if rng.random() < share else w for w in words]


def corpus(seed=1):
    rng = random.Random(seed)
    docs, i = [], 0
    for size in (1, 2, 3, 8, 12, 30, 60, 140, 400, 1500):
        base = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(size)]
        for share in (0, 0, 0.005, 0.01, 0.02, 0.04, 0.1, 1):
            docs.append((i, " ".join(edited(rng, base, share))))
            i += 1
    for k in range(60):  # one large group of near copies
        docs.append((i + k, " ".join(edited(rng, base[:200], 0.01 * (k % 4)))))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(
    ("t", "words", "share"),
    [(Fraction(90, 100), 3, 128), (Fraction(90, 100), 3, 7), (Fraction(80, 100), 5, 5), (Fraction(60, 100), 2, 128)],
)
def test_components_against_all_pairs(spark, monkeypatch, t, words, share):
    for name, value in {"BUCKET_SHARE": share, "SET_SHARE": share, "BUCKET_TASK": 64, "HAD_SETS": 20}.items():
        monkeypatch.setattr(ngram_join, name, value)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in ngram_join.join_documents(df, t, words).collect()}
    plain = plain_components(docs, t, words)
    assert {i: r["component_id"] for i, r in rows.items()} == plain
    assert all(rows[i]["n_shingles"] == len(plain_set(text, words)) for i, text in docs)


def test_a_chain_that_shares_do_not_connect(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SET_SHARE", 4)
    monkeypatch.setattr(ngram_join, "BUCKET_SHARE", 4)
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[i : i + 100])) for i in range(0, 60, 2)]  # each is similar to its neighbours only
    rows = ngram_join.join_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in rows} == {0}


def test_links_between_classes(spark):
    docs = corpus(3)
    docs += [(1000 + i, text) for i, text in docs[:20]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    classes = {}
    for i, text in docs:
        classes.setdefault(plain_set(text), []).append(i)
    classes.pop(frozenset(), None)
    expected = {
        frozenset([min(classes[a]), min(classes[b])])
        for a in classes for b in classes if a != b and Fraction(len(a & b), len(a | b)) >= Fraction(9, 10)
    }
    size = {min(ids): len(ids) for ids in classes.values()}
    found = ngram_join.links(df).collect()
    assert len(found) == len(expected) and {frozenset([r["id_a"], r["id_b"]]) for r in found} == expected
    assert all((r["rows_a"], r["rows_b"]) == (size[r["id_a"]], size[r["id_b"]]) for r in found)


def test_rows_that_repeat_an_id_with_another_text(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = spark.createDataFrame([(1, a), (1, b), (2, a + " z"), (3, b + " z"), (None, a), (None, a), (None, "null only here")], "doc_id long, text string")
    found = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["n_shingles"]) for r in ngram_join.join_documents(rows).collect())
    assert found == [(0, 0, 1), (0, 1, 98), (0, 1, 98), (1, 1, 98), (1, 1, 98), (2, 1, 99), (3, 1, 99)]
    kept = {(r["doc_id"], r["text"]) for r in ngram_join.keep_one(rows).collect()}
    assert kept == {(1, a), (1, b), (None, "null only here")}


@pytest.mark.parametrize("t", [Fraction(90, 100), Fraction(80, 100), Fraction(50, 100)])
def test_bounds_hold_for_every_pair(t):
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 600))
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        a = base[rng.random(len(base)) > 0.03]
        b = base[rng.random(len(base)) > 0.03]
        if not len(a) or not len(b) or not ngram_join.similar(a, b, t):
            continue
        s = ngram_join.Sketches([ngram_join.sketch(a), ngram_join.sketch(b)], np.array([len(a), len(b)]))
        ok, apart = s.near(np.array([0]), np.array([1]), t)
        assert ok[0] and apart[0] <= len(np.setxor1d(a, b))
        keys = [{int(k) for band in ngram_join.bands_for(len(h), t) for k in ngram_join.block_keys(h, band, t)} for h in (a, b)]
        assert keys[0] & keys[1]


def test_awkward_rows(spark, awkward, empty):
    rows = ngram_join.join_documents(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (0, 4) and by[1] == (3, 1) and by[5] == (1, 5)
    assert [(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is None] == [(3, 1)]
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, i) for i in range(1, 8)]
    assert ngram_join.join_documents(empty).count() == ngram_join.keep_one(empty).count() == 0


def test_repeated_ids_keep_a_row_of_their_own_component(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    for shared, own in ((a, b), (b, a)):
        rows = spark.createDataFrame([(3, shared), (5, shared), (5, own), (5, None), (7, None), (7, own + " x y")], "doc_id long, text string")
        kept = sorted(((r["doc_id"], r["text"] or "") for r in ngram_join.keep_one(rows).collect()))
        assert kept == sorted([(3, shared), (5, own), (5, ""), (7, ""), (7, own + " x y")])
