"""Scalars against expected values."""

import pytest
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import anchors as N
from kindred.functions import similarity as S
from kindred.functions import text as T
from kindred.functions import vocab


def values(spark, rows, column, names="a string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {names}")
    return [r["x"] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_normalize_name(spark):
    cases = {
        None: "",
        "": "",
        "   ": "",
        "O'Reilly Barbershop Inc.": "o reilly barbershop",
        "B+ Retail & Services": "b retail",
        "XYZ Pvt Ltd": "xyz",
        "Global Tech Private Limited": "global tech",
        "Corporation Bank": "bank",
        "Center Point Retail Inc": "point retail",
        "राम मार्केटिंग प्राइवेट लिमिटेड": "राम मार्केटिंग",
        "SCI Ptit Àmicale Sarl": "sci ptit àmicale",
        "  Super-Tech Solutions, Pvt. Ltd.  ": "super tech",
    }
    assert values(spark, list(cases), T.normalize_name("a")) == list(cases.values())


def test_clean_names(spark):
    assert values(spark, ["Acme_1 Trading, Inc."], T.clean_name("a")) == ["acme_1"]
    assert values(spark, ["Acme Trading Inc"], T.clean_name("a", vocab.SUFFIXES_BASELINE)) == ["acme trading"]
    assert values(spark, ["Dréxkor L.L.C."], T.clean_name_enhanced("a")) == ["drexkor"]
    cases = {
        "Foo Ltd DBA Bar Baz": "bar baz",
        "Foo d.b.a. Bar Baz": "bar baz",
        "Shri Ram [id: 55] Mills": "ram mills",
        "maurewilliams.com": "maurewilliams",
        "A.B.C. L.L.C.": "abc",
        None: "",
    }
    assert values(spark, list(cases), T.super_clean_name("a")) == list(cases.values())


def test_addresses(spark):
    one = lambda a, c: values(spark, [a], c)[0]
    assert one("85 Wayne Avenue, Floor 2, Apt 104", A.address_numbers("a")) == "85_2_104"
    assert one("85, Wayne Ave.#42", A.address_numbers("a")) == "85_42"
    assert [one(a, A.address_anchor("a")) for a in ("85 Wayne Avenue, Floor 2", "10 A St, Boston", "Wayne Avenue", "12345", None)] == ["85_wayne", "10_boston", "", "", ""]
    assert one("b 7 a12 7", A.number_set_key("a")) == "12_7"
    assert one("12345678 99 x", A.short_numbers("a")) == ["99"]
    assert one("Near Cyber Tower Electronics City", A.address_pair("a")) == ["cyber", "electronics"]
    assert one("1 Main Road Elm Grove Park", A.street_tokens("a")) == ["main", "grove"]
    assert one("a 1234 b 560001", A.last_postal("a")) == "560001" and one("a 1234 b 560001", A.first_pin("a")) == "1234"
    assert one("x NY, in CA", A.us_state("a")) == "NY" and one("new delhi 110001", A.state_code("a")) == "DL"


def test_places_by_country(spark):
    rows = [("Austin, TX 73301", "us"), ("Pune, Mumbai 400001", "india"), ("Lyon 69001", "france"), ("x", "es"), (None, "us")]
    v = lambda c: values(spark, rows, c, "a string, c string")
    assert v(A.geo("a", "c")) == ["TX", "mumbai", "lyon", "", ""]
    assert v(A.postal_code("a", "c")) == ["73301", "400001", "69001", None, None]
    assert v(A.audit_state("a", "c")) == ["TX", "MH", "69", "", ""]
    assert values(spark, [("1 Brigade Rd, Bengaluru, KA", "india"), ("gurugram", "india")], A.canonical_geo("a", "c"), "a string, c string") == ["karnataka", "gurgaon"]


def test_anchors(spark):
    rows = [
        ("Acme 29ABCDE1234F1Z5", "call 9876 543 210, acme.co.in, 560001", "India"),
        ("Foo", "732 829 320 Paris 75001 x@gmail.com", "France"),
        ("Bar 12-3456789", "1 Elm 10001-1234", "US"),
        (None, None, "US"),
    ]
    df = spark.createDataFrame(rows, "n string, a string, c string")
    found = [{k: v for k, v in r["x"].asDict().items() if v} for r in df.select(N.anchors("n", "a", "c").alias("x")).collect()]
    assert found[0]["GSTIN"] == "29ABCDE1234F1Z5" and found[0]["DOMAIN"] == "acme.co.in" and found[0]["POSTAL"] == "560001"
    assert found[0]["PHONE"][-10:] == "9876543210" and found[1]["SIREN"] == "732829320" and "DOMAIN" not in found[1]
    assert found[2]["EIN"] == "12-3456789" and found[2]["POSTAL"] == "10001" and found[3] == {}


def test_scripts(spark):
    rows = ["Café", "राम", "тест", "", None]
    assert values(spark, rows, T.is_latin("a")) == [True, False, False, True, True]
    assert values(spark, rows, T.has_indic("a")) == [False, True, False, False, False]
    assert values(spark, ["Orelee's Barbershop"], T.longest_token(T.significant_tokens("a"))) == ["barbershop"]


@pytest.mark.parametrize(("a", "b"), [("", ""), ("abc", ""), ("kitten", "sitting"), ("a b c", "c b a"), ("fuzzy wuzzy", "wuzzy"), ("aé漢", "é漢b")])
def test_subsequences_by_dynamic_programming(a, b):
    rows = [[0] * (len(b) + 1)]
    for c in a:
        row = [0]
        for j, d in enumerate(b, 1):
            row.append(rows[-1][j - 1] + 1 if c == d else max(row[-1], rows[-1][j]))
        rows.append(row)
    assert S.common_subsequence(a, b) == rows[-1][-1]


def test_ratios():
    assert S.indel_ratio("", "") == 100 and S.indel_ratio("ab", "") == 0
    assert S.indel_ratio("kitten", "sitting") == pytest.approx(200 * 4 / 13)
    assert S.token_set_ratio("new york mets", "new york mets vs atlanta") == 100 and S.token_set_ratio("", "a") == 0
    assert S.token_sort_ratio("b a", "a b") == 100
    assert S.partial_ratio("york", "new york mets") == 100 and S.partial_ratio("", "a") == 0
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(96.1111, abs=1e-3)
    assert S.substring_ratio("abcdef", "zcdez") == 50
    assert S.matcher_ratio("abcd", "bcde") == 0.75


def test_columns(spark):
    df = spark.createDataFrame([("a b", "b a", [3.0, 4.0], [4.0, 3.0])], "a string, b string, x array<double>, y array<double>")
    r = df.select(
        S.reordered(F.col("a"), F.col("b")).alias("r"), S.cosine(F.col("x"), F.col("y")).alias("c"),
        S.token_jaccard(F.array(), F.array()).alias("j"), S.jaccard_percent(F.array(), F.array()).alias("p"),
        S.f_beta(F.lit(0.0), F.lit(0.0)).alias("f"), S.f_beta(F.lit(1.0), F.lit(0.5)).alias("g"),
    ).first()
    assert r["r"] and r["c"] == pytest.approx(0.96) and (r["j"], r["p"], r["f"]) == (1.0, 0.0, 0.0)
    assert r["g"] == pytest.approx(1.25 * 0.5 / 0.75)
