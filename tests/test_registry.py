"""Driver contract + every registered query against its oracle SQL at sf0.001."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, TYPE_MAP, canon  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["week_start", "categoria", "keyword_canonica"]
    assert df.count() >= 0


def test_contract_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    from retailpulse.plans.oracle import ORACLE
    from retailpulse.plans.queries import REGISTRY
    assert set(REGISTRY) == set(ORACLE)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    stypes = {f.name: TYPE_MAP.get(f.dataType.simpleString()) for f in df.schema.fields}
    dtypes = {c[0]: c[1] for c in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert Counter(canon(scols, srows)) == Counter(canon(dcols, drows))


def test_radar_properties(spark):
    rad = E.queries()["radar_keyword"](spark, SF).collect()
    by_week = {}
    for r in rad:
        by_week.setdefault(r["week_start"], []).append(r)
        assert 0.0 <= r["score_total"] <= 100.0
    for rows in by_week.values():
        assert sorted(r["rank_week"] for r in rows) == list(range(1, len(rows) + 1))
    cov = E.queries()["coverage_before"](spark, SF).collect()
    mapped = E.queries()["terms_mapped_weekly"](spark, SF).collect()
    for c in cov:
        m = sum(r["searches"] for r in mapped if r["week_start"] == c["week_start"])
        assert m + c["searches_unmapped"] == c["searches_total"]
