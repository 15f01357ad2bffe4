"""How often the star's rows are dealt out, and that the results stay the same."""

import re

from conftest import SF_SMALL
from licita.operators import star as S
from licita.plans import curated as C


def exchanges(df) -> list[str]:
    """Exchanges of the plan before it runs, by what they are dealt by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning\(.*?\), \w+)", plan)


def test_contract_rows_of_the_fact_are_dealt_once(spark):
    plan = exchanges(C.fact_keys_and_hash(spark, SF_SMALL))
    # by the line's OCID while narrow, and the records of both joins by OCID
    assert all("REPARTITION_BY_COL" in p for p in plan), plan
    assert not any("CLAVE_CONTRATO" in p or "CLAVE_ENTIDAD" in p for p in plan)


def test_bridge_is_dealt_by_process_only(spark):
    plan = exchanges(C.contract_supplier_bridge(spark, SF_SMALL))
    assert plan and not any("CLAVE_CONTRATO" in p or "ID_ADJUDICACION" in p for p in plan)


def test_equal_candidates_are_counted_before_the_newest_values_are_chosen(spark):
    schema = ("CLAVE_ORGANIZACION string, ID_ORGANIZACION_ORIGINAL string, RUC string, RUC_VALIDO boolean, "
              "NOMBRE_ORIGINAL string, NOMBRE_ESTANDAR string, DIRECCION string, LOCALIDAD string, REGION string, "
              "DEPARTAMENTO string, PAIS string, ES_ENTIDAD int, ES_PROVEEDOR int, ANIO_ARCHIVO int, MES_ARCHIVO int, "
              "PRIORIDAD_FUENTE int, COMPLETITUD int")

    def row(name, year, month, prio=3, place="LIMA", roles=(1, 0)):
        return ("ID|1", "1", None, None, name, name, None, None, None, place, "PERU", *roles, year, month, prio, 2)
    rows = [row("b", 2023, 5), row("a", 2024, 2), row("b", 2022, 1), row("b", 2024, 1),
            row(None, 2024, 3, place=None, roles=(0, 1)), row("c", None, None)]
    df = S.dim_organizacion(spark.createDataFrame(rows, schema))
    assert "HashAggregate" in df._jdf.queryExecution().executedPlan().toString()
    r = df.collect()[0]
    assert (r.NOMBRE_ORIGINAL, r.DEPARTAMENTO, r.TIPO_ORGANIZACION) == ("a", "LIMA", S.ORG_BOTH)
    assert (r.PERIODO_PRIMERA_APARICION, r.PERIODO_ULTIMA_APARICION) == (202201, 202403)


def test_entity_locations_cover_every_key_of_the_process(spark):
    records = spark.createDataFrame(
        [("o1", "111", None, "7", "8"), ("o1", None, None, "7", None), ("o2", None, "222", "9", None),
         ("o3", None, None, None, None), (None, "111", None, "7", None)],
        "OCID string, RUC_ENTIDAD_CONTRATANTE string, RUC_COMPRADOR string, ID_ENTIDAD_CONTRATANTE string, ID_COMPRADOR string")
    org = spark.createDataFrame([("RUC|111", "u1"), ("RUC|222", "u2"), ("ID|7", "u3"), ("ID|9", None)],
                                "CLAVE_ORGANIZACION string, CLAVE_UBICACION string")
    got = {tuple(r) for r in S.entity_locations(records, org).collect()}
    assert got == {("o1", "RUC|111", "u1"), ("o1", "ID|7", "u3"), ("o2", "RUC|222", "u2")}
