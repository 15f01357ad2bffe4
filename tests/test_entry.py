"""Driver contract: entry runs, every query has a callable, oracles match on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, norm, rows_of

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"ANIO", "CONTRATOS", "MONTO_TOTAL"}


def test_every_query_has_an_oracle():
    from licita.plans import registry
    q, o = E.queries(), E.oracle_sql()
    assert set(registry()) <= set(o)
    assert set(o) <= set(q)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


FAST = ["latest_contract_version", "org_master", "fact_with_fallback", "contract_supplier_bridge",
        "annual_summary", "supplier_list_per_contract", "clean_text", "standard_name",
        "ruc_extract_validate", "parse_number", "upsert", "prorated_amount", "staging_contratos",
        "landing_months", "one_year_quality", "catalog_formats", "random_sample", "parse_date", "bridge_rebuild",
        "soft_delete", "scd2_history", "batch_compare", "stream_upsert"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_small(spark, con, name):
    df = E.queries()[name](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert ac == bc
    assert a == b
    assert norm(1.0) == 1.0
