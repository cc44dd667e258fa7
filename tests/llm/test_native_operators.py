import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kindred.llm import mixing, urls

UPPER = str.maketrans(urls.UPPER, urls.LOWER)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


def judged(url, rules, default):
    """Plain reading of the rules."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
        host = host.translate(UPPER)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else default


def test_urls_against_a_plain_reading(spark):
    rng = random.Random(3)
    hosts = ["org", "a.org", "b.a.org", "aorg", "x.com", "y.x.com", "com", "EXAMPLE.org", "", "a..org", "org.", "ü.org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/EN/1", "/a//b", "/é", "?q=/es/", "#/es/", "/es/?x#y", "/a\nb"]
    made = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "org/es/", "://", "a://b://c/d", "://org/"]
    rules = [urls.parse_rule(rng.choice(["allow", "block"]), t) for t in ("org/", "a.org/es", "a.org/", "b.a.org/en/1", "org/es/", "com/", "x.com/es/", "y.x.com/en", "org/en/1", "org/é")]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(made)], "page_id long, url string, host string, rule string")
    out = urls.judge(df, rules)
    assert no_python(out.select("page_id", "host", "path", "rule", "verdict"))
    for r in out.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(r["url"], rules, "allow"), r["url"]
    assert out.count() == len(made)


def test_urls_without_rules_or_rows(spark):
    df = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, None)], "page_id long, url string")
    rows = urls.judge(df, [], default="block").collect()
    assert len(rows) == 3 and {(r["rule"], r["verdict"]) for r in rows} == {(None, "block")}
    assert urls.judge(df.limit(0), [urls.parse_rule("allow", "org/")]).count() == 0


def test_many_and_deeply_nested_rules(spark):
    deep = [".".join(f"l{j}" for j in range(i, 60)) for i in range(60)]
    rules = [urls.Rule("block" if i % 2 else "allow", h, "") for i, h in enumerate(deep)]
    rules += [urls.Rule("block", deep[-1], "/" + "a" * i) for i in range(1, 300)]
    rules += [urls.Rule("allow", "l58.l59", "/" + "b" * i) for i in range(1, 50)]
    entries = sum(len(s) for _, s in urls.host_stacks(rules))
    assert entries == 60 * 61 // 2  # labels of the hosts themselves, however many rules there are
    made = [f"http://x.{h}{p}" for h in (deep[0], deep[30], deep[58], deep[59]) for p in ("", "/c", "/aaa", "/" + "a" * 5000, "/bbbb")]
    made.append("http://y.l59/" + "z" * 200_000)
    out = urls.judge(spark.createDataFrame(list(enumerate(made)), "page_id long, url string"), rules)
    for r in out.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(r["url"], rules, "allow"), r["url"][:99]


def test_rules_of_one_length_and_one_text(spark):
    rules = [urls.Rule("block", "b.org", "/x"), urls.Rule("allow", "org", "/xyz"), urls.Rule("allow", "b.org", "/x")]
    (r,) = urls.judge(spark.createDataFrame([(1, "http://b.org/xyzw")], "page_id long, url string"), rules).collect()
    assert (r["rule"], r["verdict"]) == ("b.org/x", "block")


def shared_out(sizes, weights, total, epochs):
    """Targets by sharing out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, rest = {}, dict.fromkeys(order), total
    while left:
        unit = sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / unit > epochs * sizes[s]]
        if not over:
            return target | {s: rest * w[s] / unit for s in left}
        for s in over:
            target[s] = epochs * sizes[s]
        rest = total - sum(target.values())
        left = {s: None for s in left if s not in over}
    return target


def check_mix(docs, rows, epochs=2.0):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(re.findall(mixing.WORD, text or ""))
    want = shared_out(sizes, (3.0, 1.0, 2.0), 1.5 * sum(sizes.values()), epochs)
    assert len(rows) == len(docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= epochs * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in taken.items():
        assert t == round(want[s]) or abs(t - want[s]) <= 1


def test_mix_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 7)
    rng = random.Random(5)
    docs = [(i, " ".join(["w"] * rng.randrange(0, 40)) or None, rng.choice(["a", "b", "c", "d", "é", None, "a", "a"])) for i in range(300)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, source string, target string")
    out = mixing.mix(df)
    assert no_python(out)
    rows = out.collect()
    check_mix(docs, rows)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mix_prefers_heavier_documents(spark):
    docs = [(i, "w " * 10, "a") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") < 200, 8.0).otherwise(1.0)
    rows = mixing.mix(df, share=0.25, weight=weight).collect()
    heavy = sum(r["taken"] for r in rows if r["doc_id"] < 200)
    assert heavy > 0.75 * sum(r["taken"] for r in rows)


def test_small_weights_fill_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 10)
    docs = [(i, "w " * (1 + i % 9), "a") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df, share=0.5, weight=F.lit(1e-4)).collect()
    assert sum(r["taken"] for r in rows) == round(0.5 * sum(1 + i % 9 for i in range(300)))


def test_mix_of_awkward_rows(spark, awkward, empty):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r["taken"], r["target"]) for r in mixing.mix(blank).collect()} == {(0, 0.0)}


def test_apply_mix_writes_what_is_taken(spark, awkward):
    words = lambda t: len(re.findall(mixing.WORD, t or ""))
    taken, written = defaultdict(int), defaultdict(int)
    for r in mixing.mix(awkward).collect():
        taken[r["source"]] += r["taken"]
    out = mixing.apply_mix(awkward)
    assert out.columns == awkward.columns
    for r in out.collect():
        written[r["source"]] += words(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(written)
