import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import ann, components, embed_dedup, vectors

VECS = "vec_id long, embedding array<float>, label int"
AWKWARD = [
    (900, None, 1),
    (901, [0.0] * 8, 1),
    (902, [float("nan")] + [1.0] * 7, 1),
    (903, [float("inf")] + [1.0] * 7, 1),
    (904, [None] + [1.0] * 7, None),
    (905, [1.0] * 3, 1),
    (906, [], 1),
    (None, [1.0] * 8, 1),
]


def clusters(seed=1, n=150, d=8):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[20:60] = x[20] + 0.03 * rng.standard_normal((40, d))
    x[60:75] = x[60]
    x[75:95] = x[75] + 0.12 * rng.standard_normal((20, d))
    return x.astype(np.float32)


def frame(spark, x, extra=()):
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    return spark.createDataFrame([*rows, *extra], VECS).withColumns({c: F.lit("clash") for c in ("rep", "rank", "component", "n")})


def brute_links(x, t):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    g = u @ u.T >= t
    np.fill_diagonal(g, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min(label[i], label[g[i]].min(initial=len(x))) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    return g.sum(1), label


@pytest.mark.parametrize("block", [8, 256])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "COUNT_BLOCK", block)
    monkeypatch.setattr(embed_dedup, "SORT_BLOCK", 64)
    x = clusters()
    rows = {r["vec_id"]: r for r in embed_dedup.dedup(frame(spark, x, AWKWARD)).collect()}
    links, label = brute_links(x, 0.95)
    assert len(rows) == len(x) + len(AWKWARD)
    for i in range(len(x)):
        assert (rows[i]["n_links"], rows[i]["component_id"], rows[i]["kept"]) == (links[i], label[i], label[i] == i)
    for i, *_ in AWKWARD:
        assert (rows[i]["n_links"], rows[i]["component_id"], rows[i]["kept"]) == (0, i, True)


def test_near_duplicates_in_a_dense_cone(spark):
    rng = np.random.default_rng(9)
    x = vectors.unit(np.sqrt(0.88) * np.eye(64)[:1] + np.sqrt(0.12) * vectors.unit(rng.standard_normal((3000, 64))))
    aside = rng.standard_normal((150, 64))
    aside = vectors.unit(aside - (aside * x[:150]).sum(1, keepdims=True) * x[:150])
    x = np.vstack([x, 0.952 * x[:150] + np.sqrt(1 - 0.952**2) * aside]).astype(np.float32)
    links, label = brute_links(x, 0.95)
    rows = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.dedup(frame(spark, x)).collect()}
    assert sum(rows[i] != (links[i], label[i]) for i in range(len(x))) <= 2


@pytest.mark.parametrize("median", [0.5, 0.9])
def test_planted_pairs_among_vectors_with_a_common_direction(spark, median):
    rng = np.random.default_rng(12)
    x = vectors.unit(np.sqrt(median) * np.eye(64)[:1] + np.sqrt(1 - median) * vectors.unit(rng.standard_normal((4000, 64))))
    aside = rng.standard_normal((300, 64))
    aside = vectors.unit(aside - (aside * x[:300]).sum(1, keepdims=True) * x[:300])
    x = np.vstack([x, 0.952 * x[:300] + np.sqrt(1 - 0.952**2) * aside]).astype(np.float32)
    links, label = brute_links(x, 0.95)
    rows = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.dedup(frame(spark, x)).collect()}
    planted = range(4000, 4300)
    assert sum(label[i] == label[i - 4000] for i in planted) == 300
    assert sum(rows[i][1] == label[i] for i in planted) >= 0.99 * 300
    assert sum(rows[i] == (links[i], label[i]) for i in range(len(x))) >= 0.99 * len(x)


def test_near_duplicates_of_repeated_ids_and_other_lengths(spark):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    near = lambda v: [x + 0.01 for x in v]
    rows = [(1, a, 0), (1, b, 0), (2, near(a), 0), (3, near(b), 0), (3, near(b), 0), (4, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (6, [3.0], 0)]
    found = embed_dedup.dedup(spark.createDataFrame(rows, VECS)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == sorted(
        [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)]
        + [(4, 1, 4, True), (5, 1, 4, False), (6, 0, 6, True)]
    )


@pytest.mark.parametrize("window", [1, 3, 40])
def test_hashes_that_separate(window):
    rng = np.random.default_rng(4)
    keys, group = rng.integers(0, 1 << embed_dedup.BITS, 60) >> 40 << 40, np.repeat([0, 1], 30)
    keys = np.concatenate([np.sort(keys[:30]), np.sort(keys[30:])])
    found = embed_dedup.separating(keys, group, window)
    for i in range(60):
        size = lambda bits: ((keys >> (embed_dedup.BITS - bits) == keys[i] >> (embed_dedup.BITS - bits)) & (group == group[i])).sum()
        assert found[i] == next((b for b in range(embed_dedup.BITS + 1) if size(b) <= window + 1), embed_dedup.BITS + 1)


def test_no_vectors(spark):
    none = spark.createDataFrame([], VECS)
    assert embed_dedup.dedup(none).count() == 0
    assert ann.nearest(none, none).count() == 0
    bad = spark.createDataFrame(AWKWARD[:4], VECS)
    assert embed_dedup.dedup(bad).count() == 4 and ann.nearest(bad, bad).count() == 0


def test_more_passes_for_more_vectors():
    assert embed_dedup.passes_for(100) <= embed_dedup.passes_for(10**6) <= embed_dedup.passes_for(10**9)


def test_hadamard_transform():
    x = np.random.default_rng(0).standard_normal((5, 16))
    y = ann.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(ann.hadamard(y), x, atol=1e-6)
    two = np.array([[1, 1], [1, -1]]) / np.sqrt(2)
    for n in (2, 4, 8, 32):
        plain = two
        while len(plain) < n:
            plain = np.kron(two, plain)
        assert np.allclose(ann.hadamard(np.eye(n)), plain, atol=1e-6)


@pytest.mark.parametrize("scale", [False, True])
def test_neighbours_against_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(ann, "BLOCK", 60)
    monkeypatch.setattr(ann, "QUERIES", 16)
    x = clusters(3)
    if scale:
        x = x * np.linspace(0.2, 3, len(x), dtype=np.float32)[:, None]
    df = frame(spark, x, AWKWARD)
    rows = ann.nearest(df, df.filter("vec_id % 5 = 0"), k=10).collect()
    g = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(g, -np.inf)
    found, hit, total = {}, 0, 0
    for r in rows:
        assert r["score"] == pytest.approx(g[r["query_id"], r["vec_id"]], rel=1e-12)
        found.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    for q in range(0, len(x), 5):
        mine = sorted(found[q])
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and mine == sorted(mine, key=lambda m: (m[1], m[2]))
        hit += len({m[2] for m in mine} & set(np.argsort(-g[q], kind="stable")[:10].tolist()))
        total += 10
    assert hit >= 0.9 * total


def neighbour_recall(spark, x, every, k=20):
    """Share of the true k nearest that are found, and the fewest rows of a query."""
    df = frame(spark, x)
    found = {q: set() for q in range(0, len(x), every)}
    for r in ann.nearest(df, df.filter(f"vec_id % {every} = 0"), k=k).collect():
        found[r["query_id"]].add(r["vec_id"])
    g = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(g, -np.inf)
    m = min(k, len(x) - 1)
    hit = sum(len(found[q] & set(np.argsort(-g[q], kind="stable")[:m].tolist())) for q in found)
    return hit / (m * len(found)), min(map(len, found.values()))


@pytest.mark.parametrize("norms", ["equal", "lognormal", "one long"])
def test_neighbours_among_vectors_of_any_length(spark, norms):
    rng = np.random.default_rng(6)
    x = vectors.unit(rng.standard_normal((2000, 64)))
    if norms == "lognormal":
        x *= np.exp(0.5 * rng.standard_normal((len(x), 1)))
    elif norms == "one long":
        x[17] *= 1000
    recall, fewest = neighbour_recall(spark, x.astype(np.float32), 20)
    assert recall >= 0.93 and fewest == 20


@pytest.mark.parametrize(("d", "norms"), [(256, False), (768, True)])
def test_neighbours_in_many_dimensions(spark, d, norms):
    rng = np.random.default_rng(8)
    x = vectors.unit(rng.standard_normal((1500, d)))
    if norms:
        x *= rng.uniform(0.2, 3, (len(x), 1))
    recall, fewest = neighbour_recall(spark, x.astype(np.float32), 25)
    assert recall >= 0.9 and fewest == 20


def test_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(10)
    x = rng.standard_normal((400, 32)).astype(np.float32)
    x[100:300] = x[100]
    df = frame(spark, x)
    found = {}
    for r in ann.nearest(df, df, k=20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(100, 300):
        mine = sorted(found[q])
        assert [v for _, v, _ in mine] == [i for i in range(100, 300) if i != q][:20] and len({s for *_, s in mine}) == 1
    assert all(len(mine) == 20 for mine in found.values()) and len(found) == 400


def test_scores_do_not_depend_on_a_row_s_place():
    rng = np.random.default_rng(11)
    q, x = rng.standard_normal(64), rng.standard_normal(64)
    for n in (5, 7, 13, 101, 1003):
        assert len(set(ann.exact_products(np.tile(x, (n, 1)), np.tile(q, (n, 1))).tolist())) == 1


def test_norms_bound_what_is_probed():
    needed = ann.CrossPolytope(64).needed()
    score = np.array([0.9, 0.9, -np.inf, 1.0])
    probes = ann.probes_for(score, np.ones(4), 1.0, needed, 8, 128)
    assert probes[2] == 128 and probes[3] <= probes[0] < 128
    assert (ann.probes_for(score, np.ones(4), 0.5, needed, 8, 128) == [0, 0, 128, 0]).all()


@pytest.mark.parametrize("n", [15, 21, 45])
def test_tables_of_about_as_many_vectors_as_asked(spark, n):
    x = np.random.default_rng(7).standard_normal((n, 64)).astype(np.float32)
    assert neighbour_recall(spark, x, 1) == (1.0, min(20, n - 1))


def test_probes_needed_fall_with_the_cosine():
    for hashes in (ann.CrossPolytope(64), ann.CrossPolytope(64, 10**6)):
        needed = hashes.needed()
        assert (np.diff(needed) <= 0).all() and needed[0] > hashes.size and needed[-1] == 1
    assert hashes.size == ann.MOST_AXES


def test_fewer_candidates_than_asked(spark):
    df = frame(spark, clusters()[:4])
    assert {(r["query_id"], r["rank"]) for r in ann.nearest(df, df, k=20).collect()} == {(q, k) for q in range(4) for k in (1, 2, 3)}


def test_components_against_union_find(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    df = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    for task_edges in (1_000_000, 40):
        rows = components.connected_components(df.repartition(9), task_edges=task_edges).collect()
        found = {r["node"]: r["component"] for r in rows}
        assert len(rows) == len(found) and found == {n: find(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}
    assert components.connected_components(df.limit(0)).count() == 0


def test_double_vectors_keep_their_precision(spark):
    rows = [(1, [1.0 + 2**-40, 2.0]), (2, [1e300, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert vectors.lengths(df) == {2: 2}
    df = vectors.packed(df, "vec_id", "embedding", 2)
    assert {r["vec_id"]: vectors.matrix([r["vec"]], d)[0].tolist() for r in df.collect()} == dict(rows)
    assert np.allclose(np.linalg.norm(vectors.unit(np.array([[1e300, 1e300], [1e-300, 0]])), axis=1), 1)
