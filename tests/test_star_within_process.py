"""Keys of the written star are compared within the process, where its rows are."""

import re

from conftest import SF_SMALL
from licita import session as SE
from licita.operators import quality as Q
from licita.plans import adapters as A
from licita.plans import curated as C
from licita.plans import reports as RP
from licita.plans import warehouse as WP
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanged(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?)\)", _plan(df))


def _cut(spark, monkeypatch):
    monkeypatch.setattr(SE, "ROWS_PER_TASK", 500)  # the small tables count as large


def test_indicators_and_orphans_do_not_exchange_contract_keys(spark, monkeypatch):
    plain = {q: sorted(map(str, q(spark, SF_SMALL).collect())) for q in (RP.indicators, RP.orphans_and_anti)}
    _cut(spark, monkeypatch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query, rows in plain.items():
            df = query(spark, SF_SMALL)
            assert not [k for k in _exchanged(df) if "CLAVE_CONTRATO" in k], query
            assert sorted(map(str, df.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        SE.cut_exchanges(spark, 0)


def test_the_written_bridge_holds_what_is_read(spark):
    st = C.written_star(spark, SF_SMALL, bridge_columns=["CLAVE_CONTRATO"])
    assert st["bridge"].columns == ["OCID", "CLAVE_CONTRATO"]
    assert st["bridge"].count() == C.contract_supplier_bridge(spark, SF_SMALL).count()  # distinct over all columns first


def test_orphans_and_distinct_keys_within_a_process(spark):
    child = spark.createDataFrame([("o1", "a"), ("o1", "a"), ("o2", "b"), ("o2", None)], "OCID string, k string")
    parent = spark.createDataFrame([("o1", "a"), ("o3", "c")], "OCID string, k string")
    assert Q.orphans(child, "k", parent, "k", "x", ["OCID"]).first().HUERFANOS == 1
    assert Q.orphans(child, "k", parent, "k", "x").first().HUERFANOS == 1
    assert Q.distinct_count(child, "k", ["OCID"]).first().n == 2 == Q.distinct_count(child, "k").first().n


def test_suppliers_and_customers_are_standardised_once_each(spark, tmp_path):
    import datetime as dt
    day = dt.datetime(2020, 1, 2)
    rows = {"lineitem": ([(1, 1, 5, 1, "F", day, "A"), (2, 2, 6, 2, "O", day, "R"), (3, 3, 7, 1, None, None, None)],
                         "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_linestatus string, l_shipdate timestamp_ntz, "
                         "l_returnflag string"),
            "supplier": ([(1, "Straße N° 1"), (2, None), (6, "İst  x"), (3, " a ")], "s_suppkey long, s_name string"),
            "orders": ([(1, 1, day), (2, 4, day), (3, 3, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
            "customer": ([(1, "Ñandú s.a.", 0, "a/b"), (4, None, 0, None), (3, "x", 0, " ")],
                         "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            "nation": ([(0, "PERU", 0)], "n_nationkey int, n_name string, n_regionkey int"),
            "region": ([(0, "AMERICA")], "r_regionkey int, r_name string")}
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = A.Tables(spark, str(tmp_path))
    for df, original, standard, ruc, valid in (
            (A.stg_proveedores(t), "NOMBRE_PROVEEDOR_ORIGINAL", "NOMBRE_PROVEEDOR_ESTANDAR", "RUC_PROVEEDOR", "RUC_PROVEEDOR_VALIDO"),
            (A.stg_partes(t), "NOMBRE_ORGANIZACION_ORIGINAL", "NOMBRE_ORGANIZACION_ESTANDAR", "RUC_ORGANIZACION", "RUC_VALIDO")):
        got = df.withColumns({"_s": A.T.standard_name(F.col(original)), "_v": A.R.validate_ruc(F.col(ruc))}).collect()
        assert got and all(r[standard] == r._s and r[valid] == r._v for r in got)
        tree = df.select(standard)._jdf.queryExecution().optimizedPlan().toString()
        assert tree.index("Join") < tree.index("regexp_replace")


def test_contract_keys_come_to_the_bridge_of_the_process(spark, monkeypatch):
    plain = {WP.bridge_keys: sorted(map(str, WP.bridge_keys(spark, SF_SMALL).collect()))}
    _cut(spark, monkeypatch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query, rows in plain.items():
            df = query(spark, SF_SMALL)
            assert not [k for k in _exchanged(df) if "ClaveContrato" in k or "CLAVE_CONTRATO" in k], query
            assert sorted(map(str, df.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        SE.cut_exchanges(spark, 0)


def test_the_entity_is_looked_up_last(spark):
    w = WP.Warehouse(spark, SF_SMALL, {})
    plan = w.fact.select("EntidadKey", "MetodoKey")._jdf.queryExecution().analyzed().toString()
    assert plan.index("CLAVE_ENTIDAD#") < plan.index("_MetodoKey_bk")
