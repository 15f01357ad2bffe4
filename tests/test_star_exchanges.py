"""What the star's large tables send through exchanges beside the rows themselves."""

import re
from types import SimpleNamespace

from conftest import SF_SMALL
from licita import session as SE
from licita.operators import star as S
from licita.plans import curated as C
from licita.plans import reports as RP
from pyspark.sql import functions as F


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning\(.*?\), \w+)", plan)


def test_parties_are_dealt_by_customer_like_the_records(spark):
    plan = [p for p in _exchanges(C.org_master(spark, SF_SMALL)) if "o_custkey" in p and "REPARTITION_BY_COL" in p]
    assert len(plan) == 2, plan


def test_roles_hand_on_a_key_once(spark):
    org = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "CLAVE_ORGANIZACION string, v int")
    used = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "c").alias("CLAVE_ENTIDAD"))
    used = used.withColumn("CLAVE_PROVEEDOR", F.col("CLAVE_ENTIDAD"))
    for dim in (S.dim_entidad(org, used), S.dim_proveedor(org, used)):
        assert [tuple(r) for r in dim.collect()] == [("a", 1)]
        assert re.search(r"Join LeftSemi(.|\n)*Aggregate \[", dim._jdf.queryExecution().optimizedPlan().toString())


def test_the_bridge_takes_the_fact_of_large_tables_where_it_is(spark, monkeypatch):
    star = SimpleNamespace(t=SimpleNamespace(spark=spark), cut=True)
    assert C.WrittenStar(star)._dealt and not C.WrittenStar(SimpleNamespace(t=star.t, cut=False))._dealt
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(60).select((F.col("id") % 7).cast("string").alias("OCID"), F.lit("1").alias("ID_ADJUDICACION"),
                                      F.col("id").cast("string").alias("CLAVE_CONTRATO"))
        fact = SE.materialise_dealt(SE.dealt_by(rows, "OCID"), "OCID", "fact")
        sup = SE.dealt_by(spark.range(7).select(
            F.col("id").cast("string").alias("OCID"), F.lit("1").alias("ID_ADJUDICACION"), F.lit("p").alias("CLAVE_PROVEEDOR"),
            *[F.lit("x").alias(c) for c in S.BRIDGE_COLUMNS[2:]], F.lit(1).alias("ANIO_ARCHIVO"), F.lit(1).alias("MES_ARCHIVO")), "OCID")
        bridge = S.bridge_contrato_proveedor(fact, sup)
        assert bridge.count() == 60 and len(_exchanges(bridge)) == 1  # the suppliers'
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_review_samples_match_keys_alone(spark):
    plan = RP.review_samples(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    left = re.search(r"Join LeftAnti.*\n\W*Project \[(.*)\]", plan)
    assert left and left[1].startswith("CLAVE_CONTRATO#") and "," not in left[1], plan
