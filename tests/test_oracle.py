"""Every registered query against its DuckDB twin on the small tables: row
count, column names and the multiset of values must agree."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tools.oracle_check import digest, type_mismatches

QUERIES = {n: q for n, q in contract.queries().items() if n.startswith("q_")}
ORACLE = contract.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == {n for n in ORACLE if n.startswith("q_")}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, sf_dir, duck, name):
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(ORACLE[name])
    dcols, drows = rel.columns, rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert not type_mismatches(sdf, rel)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "category", "sub_category", "customer_name", "total_profit",
                          "order_count", "total_revenue"]
