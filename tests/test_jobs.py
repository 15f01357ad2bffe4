"""End to end: generated landing CSVs -> staging -> curated -> warehouse."""

import csv
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from licita.plans import jobs as J

REG_H = ["Open Contracting ID", "Entrega compilada:ID de Entrega",
         "Entrega compilada:Comprador:ID de Organización",
         "Entrega compilada:Comprador:Nombre de la Organización",
         "Entrega compilada:Licitación:ID de licitación",
         "Entrega compilada:Licitación:Entidad contratante:ID de Organización",
         "Entrega compilada:Licitación:Entidad contratante:Nombre de la Organización",
         "Entrega compilada:Licitación:Método de contratación",
         "Entrega compilada:Licitación:Categoría principal de contratación",
         "Entrega compilada:Fecha de entrega", "Columna ajena"]
CON_H = ["Open Contracting ID", "Entrega compilada:ID de Entrega",
         "Entrega compilada:Contratos:ID del Contrato", "Entrega compilada:Contratos:ID de Adjudicación",
         "Entrega compilada:Contratos:Valor:Monto", "Entrega compilada:Contratos:Valor:Moneda",
         "Entrega compilada:Contratos:Fecha de firma",
         "Entrega compilada:Contratos:Descripción del contrato"]
PRO_H = ["Open Contracting ID", "Entrega compilada:ID de Entrega",
         "Entrega compilada:Adjudicaciones:ID de Adjudicación",
         "Entrega compilada:Adjudicaciones:Proveedores:ID de Organización",
         "Entrega compilada:Adjudicaciones:Proveedores:Nombre de la Organización"]
PAR_H = ["Open Contracting ID", "Entrega compilada:ID de Entrega",
         "Entrega compilada:Partes involucradas:ID de Entidad",
         "Entrega compilada:Partes involucradas:Nombre común",
         "Entrega compilada:Partes involucradas:Identificador principal:ID",
         "Entrega compilada:Partes involucradas:Roles de las partes",
         "Entrega compilada:Partes involucradas:Dirección:Región",
         "Entrega compilada:Partes involucradas:Dirección:Departamento",
         "Entrega compilada:Partes involucradas:Dirección:País"]

VALID_RUC = "20131312955"   # check digit valid
SUPPLIER_RUC = "20100070970"


def _write(root, y, m, sheet, header, rows):
    d = os.path.join(root, str(y), f"{m:02d}", "extraido")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"paquete_{sheet}.csv"), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _landing(root, feb_amount="1.400,00"):
    _write(root, 2024, 1, "Registros", REG_H, [
        ["ocds-1", "1", "PE-RUC-" + VALID_RUC, "Ministerio de Salud", "LIC-1", "", "", "Directa",
         "goods", "2024-01-10", "x"],
        ["ocds-2", "1", "", "", "LIC-2", VALID_RUC + ".0", "Municipalidad  de Áncash", "Subasta",
         "services", "2024-01-11", "x"],
        ["ocds-3", "5", "77", "Gobierno Regional", "LIC-3", "", "", "", "works", "", "x"]])
    _write(root, 2024, 1, "Ent_Contratos", CON_H, [
        ["ocds-1", "1", "C1", "A1", "100", "PEN", "2024-01-15", "primera versión"],
        ["ocds-2", "1", "C1", "A2", "1,234.56", "USD", "15/01/2024", "texto"],
        ["ocds-3", "9", "C1", "A3", "S/ 10", "", "2024-01-20", ""],
        ["ocds-4", "1", "C1", "A4", "texto", "PEN", "nan", "sin registro"],
        ["", "1", "C9", "A9", "1", "PEN", "2024-01-01", "rechazada"]])
    _write(root, 2024, 1, "Ent_Adj_Proveedores", PRO_H, [
        ["ocds-1", "1", "A1", SUPPLIER_RUC, "Proveedor Uno SAC"],
        ["ocds-1", "1", "A1", "PE-RUC-20100070971", "Proveedor Dos"],
        ["ocds-2", "1", "A2", "555", "Proveedor Tres"]])
    _write(root, 2024, 1, "Ent_PartesInvolucradas", PAR_H, [
        ["ocds-1", "1", "PE-RUC-" + VALID_RUC, "Ministerio de Salud", "PE-RUC-" + VALID_RUC,
         "buyer;procuringEntity", "Lima", "Lima", "Perú"],
        ["ocds-1", "1", SUPPLIER_RUC, "Proveedor Uno SAC", SUPPLIER_RUC, "supplier", "Cusco", "Cusco",
         "Perú"]])
    _write(root, 2024, 2, "Ent_Contratos", CON_H, [
        ["ocds-1", "2", "C1", "A1", feb_amount, "PEN", "2024-02-01", "segunda versión"]])
    _write(root, 2024, 2, "Registros", REG_H, [
        ["ocds-1", "2", "PE-RUC-" + VALID_RUC, "Ministerio de Salud", "LIC-1", "", "", "Directa",
         "goods", "2024-02-02", "x"]])
    _write(root, 2024, 2, "Ent_Adj_Proveedores", PRO_H, [
        ["ocds-1", "2", "A1", SUPPLIER_RUC, "Proveedor Uno S.A.C."]])
    # a file whose path has no valid period is reported, not processed
    _write(root, 2019, 5, "Ent_Contratos", CON_H, [["ocds-x", "1", "C1", "A1", "1", "PEN", "", ""]])


def _contracts(root, month, name, rows):
    d = os.path.join(root, "2024", f"{month:02d}", "extraido")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{name}_Ent_Contratos.csv"), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(CON_H)
        w.writerows(rows)


def _staged(spark, staging):
    return sorted((r.OCID, r.MONTO_CONTRATO) for r in spark.read.parquet(f"{staging}/contratos").collect())


def test_a_changed_file_keeps_its_sisters_rows(spark, tmpdir_path):
    landing, staging = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "staging")
    line = lambda i, v: [f"ocds-{i}", "1", "C1", "A1", str(v), "PEN", "2024-01-15", "x"]
    _contracts(landing, 1, "a", [line(1, 10), line(2, 20)])
    _contracts(landing, 1, "b", [line(3, 30)])
    _contracts(landing, 2, "c", [line(4, 40)])
    _contracts(landing, 1, "~$a", [["lock"]])  # a spreadsheet's lock file
    J.run_staging(spark, f"file://{landing}", staging)
    assert _staged(spark, staging) == [("ocds-1", 10.0), ("ocds-2", 20.0), ("ocds-3", 30.0), ("ocds-4", 40.0)]
    _contracts(landing, 1, "b", [line(3, 33), line(5, 50)])
    rows = {r.RUTA[-len("a_Ent_Contratos.csv"):][0]: r for r in J.run_staging(spark, f"file://{landing}", staging).collect()}
    assert (rows["a"].ESTADO, rows["a"].PROCESADO) == ("SIN_CAMBIO", True)
    assert (rows["b"].ESTADO, rows["b"].PROCESADO) == ("MODIFICADO", True) and not rows["c"].PROCESADO
    assert _staged(spark, staging) == [("ocds-1", 10.0), ("ocds-2", 20.0), ("ocds-3", 33.0), ("ocds-4", 40.0), ("ocds-5", 50.0)]
    assert J.run_staging(spark, f"file://{landing}", staging).filter("PROCESADO").count() == 0


def test_an_unreadable_file_is_recorded_and_others_go_on(spark, tmpdir_path):
    landing, staging = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "staging")
    line = lambda i: [f"ocds-{i}", "1", "C1", "A1", "1", "PEN", "2024-01-15", "x"]
    _contracts(landing, 1, "a", [line(1)])
    _contracts(landing, 2, "c", [line(2)])
    J.run_staging(spark, landing, staging)
    bad = os.path.join(landing, "2024", "01", "extraido", "b_Ent_Contratos.csv")
    with open(bad, "wb") as f:
        f.write(bytes([0, 255, 254, 0]) * 50)
    _contracts(landing, 2, "c", [line(2), line(3)])
    rows = {r.RUTA[-len("a_Ent_Contratos.csv"):][0]: r for r in J.run_staging(spark, landing, staging).collect()}
    assert rows["b"].ESTADO == "ERROR" and "ilegible" in rows["b"].ERROR and not rows["b"].PROCESADO
    assert not rows["a"].PROCESADO and rows["c"].PROCESADO
    assert [r[0] for r in _staged(spark, staging)] == ["ocds-1", "ocds-2", "ocds-3"]


def test_parties_are_asked_of_spark_and_missing_ones_raise(spark, tmpdir_path):
    landing, staging = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "staging")
    _landing(landing)
    J.run_staging(spark, landing, staging)
    org = {r.CLAVE_ORGANIZACION: r for r in J.build_curated_tables(spark, f"file://{staging}")["dim_organizacion"].collect()}
    assert org["RUC|" + VALID_RUC].DEPARTAMENTO == "LIMA"
    os.rename(f"{staging}/partes", f"{staging}/otras")
    with pytest.raises(AnalysisException):
        J.build_curated_tables(spark, staging)
    without = J.build_curated_tables(spark, staging, with_parties=False)["dim_organizacion"]
    assert without.filter("DEPARTAMENTO is not null").count() == 0


def test_a_failed_gate_leaves_the_old_version_published(spark, tmpdir_path):
    landing, staging, curated, dw = (os.path.join(tmpdir_path, x) for x in ("landing", "staging", "curated", "dw"))
    _landing(landing)
    J.run_staging(spark, landing, staging)
    J.run_curated(spark, staging, curated)
    assert J.current_version(spark, dw) is None
    first = J.run_warehouse(spark, curated, dw)["version"]
    fact = spark.read.parquet(f"{curated}/fact_contrato_actual")
    rows = fact.collect()
    spark.createDataFrame(rows + rows[:1], fact.schema).write.mode("overwrite").parquet(f"{curated}/fact_contrato_actual")
    with pytest.raises(RuntimeError):
        J.run_warehouse(spark, curated, dw)
    assert J.current_version(spark, dw) == first
    assert sorted(r.ESTADO for r in spark.read.parquet(f"{dw}/_control").collect()) == ["ERROR", "OK"]


def test_a_second_load_keeps_the_keys(spark, tmpdir_path):
    landing, staging, curated, dw = (os.path.join(tmpdir_path, x) for x in ("landing", "staging", "curated", "dw"))
    _landing(landing)
    J.run_staging(spark, landing, staging)
    J.run_curated(spark, staging, curated)
    first = J.run_warehouse(spark, curated, dw)["tables"]
    keys = lambda t, bk, sk: {r[bk]: r[sk] for r in t.collect()}
    contracts = keys(first["FactContrato"], "ClaveContrato", "ContratoKey")
    entities = keys(first["DimEntidad"], "CLAVE_ORGANIZACION", "EntidadKey")
    assert {r.CLAVE_ORGANIZACION: r.UbicacionKey is not None for r in first["DimEntidad"].collect()}["RUC|" + VALID_RUC]
    # a contract that sorts before all others, of an entity that does too
    _write(landing, 2024, 3, "Ent_Contratos", CON_H, [["ocds-0", "1", "C1", "A0", "5", "PEN", "2024-03-01", "nuevo"]])
    _write(landing, 2024, 3, "Registros", REG_H, [
        ["ocds-0", "1", "1", "Alcaldía", "LIC-0", "", "", "", "goods", "2024-03-01", "x"]])
    J.run_staging(spark, landing, staging)
    J.run_curated(spark, staging, curated)
    second = J.run_warehouse(spark, curated, dw)["tables"]
    now = keys(second["FactContrato"], "ClaveContrato", "ContratoKey")
    assert {k: now[k] for k in contracts} == contracts and now["ocds-0|C1"] == max(contracts.values()) + 1
    later = keys(second["DimEntidad"], "CLAVE_ORGANIZACION", "EntidadKey")
    assert {k: later[k] for k in entities} == entities and later["ID|1"] == max(entities.values()) + 1


def test_cardinality_is_checked(spark):
    from licita.operators.one_year import CardinalityError, checked_join
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q")], "k int, y string")
    with pytest.raises(CardinalityError):
        checked_join(left, right, ["k"], "left", "many_to_one")
    assert checked_join(left, right, ["k"], "left", "one_to_many").count() == 3


def test_scratch_needs_a_shared_folder_off_local_masters():
    from types import SimpleNamespace
    from licita.session import checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        checkpoint_dir(cluster)


def test_end_to_end(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    staging = os.path.join(tmpdir_path, "staging")
    curated = os.path.join(tmpdir_path, "curated")
    dw = os.path.join(tmpdir_path, "dw")
    _landing(landing)

    res = {(r.DATASET, r.RUTA.split("/landing/")[-1]): (r.ESTADO, r.PROCESADO)
           for r in J.run_staging(spark, landing, staging).collect()}
    assert res[("contratos", "2019/05/extraido/paquete_Ent_Contratos.csv")] == ("ERROR", False)
    assert res[("contratos", "2024/01/extraido/paquete_Ent_Contratos.csv")] == ("NUEVO", True)

    stg = spark.read.parquet(f"{staging}/contratos")
    assert stg.count() == 5  # the row without OCID is discarded
    ctl = spark.read.parquet(f"{staging}/_control").filter(F.col("TABLA") == "CONTRATOS") \
        .filter(F.col("MES_ARCHIVO") == 1).first()
    assert (ctl.FILAS_ORIGEN, ctl.FILAS_SALIDA, ctl.FILAS_DESCARTADAS) == (5, 4, 1)
    amounts = {r.OCID: r.MONTO_CONTRATO for r in stg.filter(F.col("mes") == "01").collect()}
    assert amounts == {"ocds-1": 100.0, "ocds-2": 1234.56, "ocds-3": 10.0, "ocds-4": None}

    # second run: nothing changed, nothing processed
    again = J.run_staging(spark, landing, staging).filter("PROCESADO").count()
    assert again == 0

    # republished February file: only that month is rewritten
    jan_files = sorted(os.listdir(f"{staging}/contratos/anio=2024/mes=01"))
    _write(landing, 2024, 2, "Ent_Contratos", CON_H,
           [["ocds-1", "2", "C1", "A1", "1.500,00", "PEN", "2024-02-01", "segunda versión"]])
    rerun = {r.RUTA.split("/landing/")[-1]: r.ESTADO
             for r in J.run_staging(spark, landing, staging).filter("PROCESADO").collect()}
    assert rerun == {"2024/02/extraido/paquete_Ent_Contratos.csv": "MODIFICADO"}
    assert sorted(os.listdir(f"{staging}/contratos/anio=2024/mes=01")) == jan_files

    tables = J.run_curated(spark, staging, curated, csv=True)
    fact = {r.CLAVE_CONTRATO: r for r in tables["fact_contrato_actual"].collect()}
    assert fact["ocds-1|C1"].MONTO_CONTRATO == 1500.0          # newest month wins
    assert fact["ocds-1|C1"].TIPO_RELACION_REGISTRO == "OCID_Y_ENTREGA"
    assert fact["ocds-2|C1"].CLAVE_ENTIDAD == "RUC|" + VALID_RUC  # entity from .0 id
    assert fact["ocds-3|C1"].TIPO_RELACION_REGISTRO == "RESPALDO_OCID"
    assert fact["ocds-3|C1"].CLAVE_ENTIDAD == "ID|77"
    assert fact["ocds-4|C1"].TIPO_RELACION_REGISTRO == "SIN_REGISTRO"
    assert fact["ocds-1|C1"].CLAVE_MONEDA == "MONEDA|PEN"
    bridge = tables["bridge_contrato_proveedor"].filter(F.col("CLAVE_CONTRATO") == "ocds-1|C1")
    assert sorted(r.CLAVE_PROVEEDOR for r in bridge.collect()) == ["RUC|20100070970",
                                                                  "RUC|20100070971"]
    org = {r.CLAVE_ORGANIZACION: r for r in tables["dim_organizacion"].collect()}
    assert org["RUC|" + VALID_RUC].RUC_VALIDO is True
    assert org["RUC|" + VALID_RUC].DEPARTAMENTO == "LIMA"
    assert os.path.isdir(f"{curated}/csv/fact_contrato_actual")
    load = {r.TABLA: r.FILAS for r in spark.read.parquet(f"{curated}/_carga").collect()}
    assert load["fact_contrato_actual"] == len(fact)
    assert spark.sql("SELECT count(*) AS n FROM fact_contrato_actual").first().n == len(fact)

    out = J.run_warehouse(spark, curated, dw)
    assert out["checks"].filter(~F.col("CUMPLE")).count() == 0
    assert J.current_version(spark, dw) == out["version"]
    f = out["tables"]["FactContrato"]
    assert f.count() == len(fact)
    assert sorted(r.ContratoKey for r in f.collect()) == list(range(1, len(fact) + 1))
    ctl = spark.read.parquet(f"{dw}/_control").collect()
    assert [r.ESTADO for r in ctl] == ["OK"]
