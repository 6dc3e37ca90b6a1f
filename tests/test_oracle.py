"""Every registered query against its independent DuckDB SQL at sf0.01."""

import pytest

from conftest import SF001, SF01
import oracle_check
from oracle_check import digest, duck, type_mismatches

import __spark_entry__ as entry
from shoppulse.plans import catalog

oracle_check.EXACT = True  # doubles must match bit for bit, not just when rounded
# the library's own queries; those of the text operators are compared in tests/llm
QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    rel = con.sql(SQL[name])
    assert type_mismatches(df, rel.columns, rel.types) == {}
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "category", "gmv", "order_cnt"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_fixture_numbers(spark):
    """Numbers stated for the sf0.01 tables: duplicates, dedup, windows, GMV, categories."""
    from pyspark.sql import functions as F

    from shoppulse.sources.tables import orders

    assert orders(spark, SF01).count() == 10_200
    assert catalog.q_dedup_orders(spark, SF01).count() == 10_000
    assert catalog.q_window_gmv(spark, SF01).count() == 45_395
    total = catalog.q_totals_all(spark, SF01).first()
    assert round(total["gmv"], 2) == 496_306.57
    by_cat = {
        r["category"]: r["n"]
        for r in catalog.q_enrich_orders(spark, SF01).groupBy("category").agg(F.count("*").alias("n")).collect()
    }
    # counted by the oracle SQL; orders join the whole catalogue, so none is unknown
    assert by_cat == {"ECONOMY": 1674, "LARGE": 1681, "MEDIUM": 1970, "PROMO": 1757, "SMALL": 1300, "STANDARD": 1618}
    assert catalog.q_dau_daily(spark, SF01).count() == 30
    assert catalog.q_window_gmv(spark, SF001).count() > 0
    # lineitem's natural conflicting duplicates: 14,168 repeats beyond the first row
    viol = catalog.q_dim_key_violations(spark, SF01)
    assert viol.agg(F.sum(F.col("cnt") - 1)).first()[0] == 14_168
    assert catalog.first_arrival_multi(
        catalog.read_table(spark, SF01, "lineitem")
    ).count() == catalog.read_table(spark, SF01, "lineitem").count() - 14_168
