import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CHECKED = ["evidence_ranked_top25", "tiered_cascade_v1", "tiered_cascade_v2", "recall_at_k", "match_components", "threshold_sweep", "jaro_winkler_pairs", "posting_stats"]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    expected = sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in want.fetchall())
    rows = entry.queries()[name](spark, SF).select(*names).collect()
    assert sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows) == expected
