"""Staging queries: raw landing sheets derived from the whole test tables,
with the published header spellings (stray spaces included), two header
variants united by name, messy cell values and entirely empty rows, run
through the real staging transforms of ``licita.operators.staging``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import staging as ST
from ..session import compiled_code, materialise, scratch_path
from .adapters import Tables
from .scalar import _amount_text

NBSP = " "


def _null(c: Column, cond: Column) -> Column:
    return F.when(cond, F.lit(None).cast("string")).otherwise(c)


def raw_contratos(t: Tables, drop_empty: bool = True) -> DataFrame:
    l = t("lineitem")
    k, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    empty = (ln == 7) & (pk % 5 == 0)
    ship = F.col("l_shipdate")
    v = k % 5
    fdate = (F.when(v == 0, F.date_format(ship, "yyyy-MM-dd"))
             .when(v == 1, F.date_format(ship, "dd/MM/yyyy"))
             .when(v == 2, F.date_format(ship, "yyyy-MM-dd HH:mm:ss"))
             .when(v == 3, F.lit("nan")).otherwise(F.lit("31/02/1999")))
    common = {
        "Open Contracting ID": _null(F.concat(k.cast("string"),
                                              F.when(ln % 3 == 0, F.lit(".0")).otherwise(F.lit(""))),
                                     (ln == 7) & (pk % 2 == 0)),
        "Entrega compilada:ID de Entrega": F.col("l_linestatus"),
        "Entrega compilada:Contratos:ID del Contrato": F.concat(
            F.when(ln % 2 == 0, F.lit(" ")).otherwise(F.lit("")), ln.cast("string")),
        "Entrega compilada:Contratos:ID de Adjudicación": F.col("l_suppkey").cast("string"),
        "  Entrega compilada:Contratos:Título  del contrato ": F.concat(
            F.lit("  Contrato\n"), pk.cast("string"), F.lit(f"\t{NBSP}nº  "),
            F.col("l_returnflag")),
        "Entrega compilada:Contratos:Valor:Monto": _amount_text(F.col("l_extendedprice"), ln),
        "Entrega compilada:Contratos:Fecha de firma": fdate,
    }
    lineage = {"ANIO_ARCHIVO": F.year(ship), "MES_ARCHIVO": F.month(ship),
               "ARCHIVO_ORIGEN": F.concat(F.lit("contratos_"), F.date_format(ship, "yyyyMM"),
                                          F.lit(".csv"))}

    def sheet(df, extra):
        cols = {**common, **extra}
        return df.select(*[_null(c.cast("string"), empty).alias(n) for n, c in cols.items()],
                         *[c.cast("int").alias(n) if n != "ARCHIVO_ORIGEN" else c.alias(n)
                           for n, c in lineage.items()])
    a = sheet(l.filter(ln % 2 == 1), {
        "Entrega compilada:Contratos:Valor:Moneda": F.when(F.col("l_returnflag") == "N", "nan")
        .otherwise(F.lit("PEN")),
        "Columna sin mapa": F.lit("x")})
    b = sheet(l.filter(ln % 2 == 0), {
        "Entrega compilada:Contratos:Periodo:Fecha de inicio": F.date_format(ship, "dd/MM/yyyy"),
        "Entrega compilada:Contratos:Periodo:Duración (días)":
            F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(",0"))})
    both = a.unionByName(b, allowMissingColumns=True)
    if not drop_empty:
        return both
    data_cols = [c for c in both.columns if c not in lineage]
    return both.na.drop(how="all", subset=data_cols)


def _staged_contratos(spark, sf_dir) -> DataFrame:
    """Cleaned once, by compiled code, and written: the duplicate flag reads it twice."""
    with compiled_code(spark):
        staged, _ = ST.stage_contratos(raw_contratos(Tables(spark, sf_dir)), None,
                                       lambda df: materialise(df, "clean-contratos"))
    return staged


def staging_contratos(spark, sf_dir) -> DataFrame:
    """PRJ-1..PRJ-8 + F-1/F-3/F-9/F-10/F-12 + WIN-5 on every lineitem row."""
    return _staged_contratos(spark, sf_dir)


def file_controls(spark, sf_dir) -> DataFrame:
    """AGG-10: per-file source / output / discarded / duplicated counters."""
    _, controls = ST.stage_contratos(raw_contratos(Tables(spark, sf_dir)))
    return controls


def raw_partes(t: Tables) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select("r_regionkey", "r_name")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")))
    k, ck = F.col("o_orderkey"), F.col("c_custkey")
    ruc = F.concat(F.lit("20"), F.lpad(ck.cast("string"), 9, "0"))
    roles = (F.when(ck % 4 == 0, "buyer;procuringEntity").when(ck % 4 == 1, "Supplier")
             .when(ck % 4 == 2, "Entidad contratante / proveedor").otherwise("tenderer"))
    od = F.col("o_orderdate")
    return j.select(
        F.concat(F.lit("ocds-"), k.cast("string")).alias("Open Contracting ID"),
        F.lit("1").alias("Entrega compilada:ID de Entrega"),
        _null(ck.cast("string"), ck % 9 == 0).alias("Entrega compilada:Partes involucradas:ID de Entidad"),
        F.col("c_name").alias("Entrega compilada:Partes involucradas:Nombre común"),
        _null(F.when(ck % 3 == 0, F.concat(F.lit("PE-RUC-"), ruc)).otherwise(F.concat(ruc, F.lit(".0"))),
              ck % 5 == 1).alias("Entrega compilada:Partes involucradas:Identificador principal:ID"),
        _null(F.concat(F.lit("Razón Social "), F.upper(F.col("c_name"))), ck % 2 == 0)
        .alias("Entrega compilada:Partes involucradas:Identificador principal:Nombre Legal"),
        F.concat(F.lit("Av. "), F.col("c_mktsegment"), F.lit(" Nº "), (ck % 900).cast("string"))
        .alias("Entrega compilada:Partes involucradas:Dirección:Dirección"),
        _null(F.concat(F.lit("Distrito "), (ck % 13).cast("string")), ck % 7 == 0)
        .alias("Entrega compilada:Partes involucradas:Dirección:Localidad"),
        F.initcap(F.col("r_name")).alias("Entrega compilada:Partes involucradas:Dirección:Región"),
        F.col("n_name").alias("Entrega compilada:Partes involucradas:Dirección:Departamento"),
        F.lit("Perú").alias("Entrega compilada:Partes involucradas:Dirección:País"),
        roles.alias("Entrega compilada:Partes involucradas:Roles de las partes"),
        F.year(od).cast("int").alias("ANIO_ARCHIVO"), F.month(od).cast("int").alias("MES_ARCHIVO"),
        F.concat(F.lit("partes_"), F.date_format(od, "yyyyMM"), F.lit(".csv")).alias("ARCHIVO_ORIGEN"))


def staging_partes(spark, sf_dir) -> DataFrame:
    """Parties staging: F-5, F-7, F-8, F-22, CLAVE_ORGANIZACION / CLAVE_PARTE, WIN-5."""
    staged, _ = ST.stage_partes(raw_partes(Tables(spark, sf_dir)))
    return staged.select("OCID", "ID_ENTREGA", "ID_ORGANIZACION", "IDENTIFICADOR_PRINCIPAL",
                         "NOMBRE_ORGANIZACION_ORIGINAL", "NOMBRE_ORGANIZACION_ESTANDAR",
                         "RUC_ORGANIZACION", "RUC_VALIDO", "DIRECCION_ESTANDAR",
                         "LOCALIDAD_ESTANDAR", "REGION_ESTANDAR", "DEPARTAMENTO_ESTANDAR",
                         "PAIS_ESTANDAR", "ROLES_ESTANDAR", "ES_COMPRADOR_O_ENTIDAD",
                         "ES_PROVEEDOR", "CLAVE_ORGANIZACION", "CLAVE_PARTE",
                         "ES_DUPLICADO_CLAVE", "ANIO_ARCHIVO", "MES_ARCHIVO")


def geo_catalog(spark, sf_dir) -> DataFrame:
    """SET-5 + PRJ-8 + S-1 + S-6 + SNK-8: numbered geographic catalog."""
    staged, _ = ST.stage_partes(raw_partes(Tables(spark, sf_dir)))
    return ST.geo_catalog(staged)


def staging_inventory(spark, sf_dir) -> DataFrame:
    """SNK-1 + SRC-5 + AGG-13: staged contracts written by month (dynamic
    overwrite) to the shared folder, then the partition inventory read back
    from file metadata and summed per month."""
    from ..sources import landing as L
    from ..sources import sinks as SK
    staged = _staged_contratos(spark, sf_dir)
    path = scratch_path(spark, "staging-contratos")
    SK.write_months(staged, path)
    inv = L.partition_inventory(spark, path, "CONTRATOS")
    return inv.groupBy("TABLA", "ANIO", "MES").agg(F.sum("FILAS").alias("FILAS"))


def sheet_rows(spark, sf_dir) -> DataFrame:
    """DQ-2: non-empty data rows per sheet file (empty rows present in the sheet)."""
    from ..operators.schema_checks import nonempty_rows
    return nonempty_rows(raw_contratos(Tables(spark, sf_dir), drop_empty=False))


QUERIES = {
    "staging_contratos": staging_contratos,
    "sheet_rows": sheet_rows,
    "staging_inventory": staging_inventory,
    "file_controls": file_controls,
    "staging_partes": staging_partes,
    "geo_catalog": geo_catalog,
}
