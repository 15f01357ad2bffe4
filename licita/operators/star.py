"""Curated star model: current versions, organisation master, fact, bridge,
role dimensions, complementary dimensions and the date dimension.

Inputs are staging-shaped DataFrames (canonical column names, see
``licita.sources.schemas``).  Each builder selects only the columns it needs,
so Catalyst prunes the Parquet scans, and never forces a physical strategy:
joins are plain equi-joins that AQE turns into broadcast joins when the
measured side is small and splits when a key is skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import keys as K
from ..session import dealt_by
from .versions import last_non_null, latest_by

# Priorities of the organisation sources.
PRIORITY_PARTIES = 3
PRIORITY_ENTITY = 2
PRIORITY_BUYER = 2
PRIORITY_SUPPLIER = 1
# Labels.
REL_EXACT = "OCID_Y_ENTREGA"
REL_FALLBACK = "RESPALDO_OCID"
REL_NONE = "SIN_REGISTRO"
ORG_BOTH = "ENTIDAD_Y_PROVEEDOR"
ORG_ENTITY = "ENTIDAD"
ORG_SUPPLIER = "PROVEEDOR"
ORG_OTHER = "OTRO"



def _epoch_1900() -> Column:
    return F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")

ORG_ATTRS = ["ID_ORGANIZACION_ORIGINAL", "RUC", "RUC_VALIDO", "NOMBRE_ORIGINAL",
             "NOMBRE_ESTANDAR", "DIRECCION", "LOCALIDAD", "REGION", "DEPARTAMENTO",
             "PAIS"]


def completeness(*cols: str) -> Column:
    """PRJ-14: number of non-NULL columns among ``cols``."""
    return reduce(lambda a, b: a + b,
                  [F.col(c).isNotNull().cast("int") for c in cols])


# ---------------------------------------------------------------- versions

def current_contracts(stg_contratos: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """WIN-1: newest version of every CLAVE_CONTRATO (``within``: see ``latest_by``)."""
    order = [F.col("ANIO_ARCHIVO"), F.col("MES_ARCHIVO"),
             F.coalesce(F.col("FECHA_FIRMA"), F.col("FECHA_INICIO"),
                        F.col("FECHA_FIN"), _epoch_1900()),
             F.col("ID_ENTREGA")]
    return latest_by(stg_contratos, ["CLAVE_CONTRATO"], order, within=within)


RECORD_COMPLETENESS = ["ID_ENTIDAD_CONTRATANTE", "NOMBRE_ENTIDAD_ESTANDAR",
                       "ID_COMPRADOR", "ID_LICITACION", "METODO_CONTRATACION",
                       "CATEGORIA_PRINCIPAL"]


def current_records(stg_registros: DataFrame, keys=("OCID", "ID_ENTREGA")) -> DataFrame:
    """WIN-2 / WIN-3: newest, most complete registro per key.

    The score is materialised as a column before ordering (a window or
    aggregate cannot reference a same-level alias), then dropped.
    """
    scored = stg_registros.withColumn("_COMPLETITUD", completeness(*RECORD_COMPLETENESS))
    order = [F.col("ANIO_ARCHIVO"), F.col("MES_ARCHIVO"), F.col("_COMPLETITUD"),
             F.coalesce(F.col("FECHA_ENTREGA"), F.col("FECHA_PUBLICACION"), _epoch_1900())]
    return latest_by(scored, list(keys), order).drop("_COMPLETITUD")


def current_suppliers(stg_proveedores: DataFrame) -> DataFrame:
    """WIN-4: newest supplier row per (OCID, award, supplier) + CLAVE_PROVEEDOR."""
    cur = latest_by(stg_proveedores, ["OCID", "ID_ADJUDICACION", "ID_PROVEEDOR"],
                    [F.col("ANIO_ARCHIVO"), F.col("MES_ARCHIVO"), F.col("ID_ENTREGA")])
    return cur.withColumn(
        "CLAVE_PROVEEDOR",
        F.when(F.col("RUC_PROVEEDOR").isNotNull(),
               F.concat(F.lit(K.RUC_PREFIX), F.col("RUC_PROVEEDOR")))
        .otherwise(F.concat(F.lit(K.ID_PREFIX), F.col("ID_PROVEEDOR"))))


# ---------------------------------------------------------- organisations

def _candidate(df: DataFrame, key: Column, ident: str, ruc: str, valid: str,
               name: str, std: str, geo: dict | None, is_entity: int | str,
               is_supplier: int | str, priority: int | Column, score: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    geo = geo or {}
    flag = (lambda v: F.lit(v) if isinstance(v, int) else F.col(v).cast("int"))
    return df.select(
        key.alias("CLAVE_ORGANIZACION"),
        F.col(ident).cast("string").alias("ID_ORGANIZACION_ORIGINAL"),
        F.col(ruc).alias("RUC"),
        F.col(valid).cast("boolean").alias("RUC_VALIDO"),
        F.col(name).alias("NOMBRE_ORIGINAL"),
        F.col(std).alias("NOMBRE_ESTANDAR"),
        *[(F.col(geo[g]) if g in geo else null).alias(g)
          for g in ["DIRECCION", "LOCALIDAD", "REGION", "DEPARTAMENTO", "PAIS"]],
        flag(is_entity).alias("ES_ENTIDAD"),
        flag(is_supplier).alias("ES_PROVEEDOR"),
        F.col("ANIO_ARCHIVO").cast("int").alias("ANIO_ARCHIVO"),
        F.col("MES_ARCHIVO").cast("int").alias("MES_ARCHIVO"),
        (priority if isinstance(priority, Column) else F.lit(priority)).alias("PRIORIDAD_FUENTE"),
        score.alias("COMPLETITUD"))


def _ruc_or_id(ruc: str, ident: str) -> Column:
    return (F.when(F.col(ruc).isNotNull(), F.concat(F.lit(K.RUC_PREFIX), F.col(ruc)))
            .otherwise(F.concat(F.lit(K.ID_PREFIX), F.col(ident).cast("string"))))


def org_candidates(stg_partes: DataFrame | None, stg_registros: DataFrame,
                   stg_proveedores: DataFrame) -> DataFrame:
    """SET-1: UNION ALL of parties (3), contracting entities (2), buyers (2)
    and suppliers (1), with a completeness score per source (PRJ-14/16)."""
    parts = []
    if stg_partes is not None:
        p = stg_partes.filter(F.col("CLAVE_ORGANIZACION").isNotNull())
        parts.append(_candidate(
            p, F.col("CLAVE_ORGANIZACION"), "ID_ORGANIZACION", "RUC_ORGANIZACION",
            "RUC_VALIDO", "NOMBRE_ORGANIZACION_ORIGINAL", "NOMBRE_ORGANIZACION_ESTANDAR",
            {"DIRECCION": "DIRECCION_ESTANDAR", "LOCALIDAD": "LOCALIDAD_ESTANDAR",
             "REGION": "REGION_ESTANDAR", "DEPARTAMENTO": "DEPARTAMENTO_ESTANDAR",
             "PAIS": "PAIS_ESTANDAR"},
            "ES_COMPRADOR_O_ENTIDAD", "ES_PROVEEDOR", PRIORITY_PARTIES,
            completeness("RUC_ORGANIZACION", "NOMBRE_ORGANIZACION_ESTANDAR",
                         "DEPARTAMENTO_ESTANDAR", "REGION_ESTANDAR", "LOCALIDAD_ESTANDAR")))
    # contracting entity and buyer of a record: one scan, up to two candidates
    # per row (explode), instead of two filtered passes over the records
    def role(ident, ruc, valid, name, std, prio):
        return F.when(F.col(ident).isNotNull(), F.struct(
            _ruc_or_id(ruc, ident).alias("k"), F.col(ident).alias("i"), F.col(ruc).alias("r"),
            F.col(valid).alias("v"), F.col(name).alias("n"), F.col(std).alias("s"),
            F.lit(prio).alias("p"), completeness(ruc, std).alias("c")))
    both = stg_registros.select(
        "ANIO_ARCHIVO", "MES_ARCHIVO",
        F.explode(F.array(
            role("ID_ENTIDAD_CONTRATANTE", "RUC_ENTIDAD_CONTRATANTE", "RUC_ENTIDAD_VALIDO",
                 "NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL", "NOMBRE_ENTIDAD_ESTANDAR", PRIORITY_ENTITY),
            role("ID_COMPRADOR", "RUC_COMPRADOR", "RUC_COMPRADOR_VALIDO",
                 "NOMBRE_COMPRADOR_ORIGINAL", "NOMBRE_COMPRADOR_ESTANDAR", PRIORITY_BUYER)))
        .alias("x")).filter(F.col("x").isNotNull())
    both = both.select("ANIO_ARCHIVO", "MES_ARCHIVO", "x.*")
    parts.append(_candidate(both, F.col("k"), "i", "r", "v", "n", "s", None, 1, 0,
                            F.col("p"), F.col("c")))
    sup = stg_proveedores.filter(F.col("ID_PROVEEDOR").isNotNull())
    parts.append(_candidate(
        sup, _ruc_or_id("RUC_PROVEEDOR", "ID_PROVEEDOR"),
        "ID_PROVEEDOR", "RUC_PROVEEDOR", "RUC_PROVEEDOR_VALIDO",
        "NOMBRE_PROVEEDOR_ORIGINAL", "NOMBRE_PROVEEDOR_ESTANDAR", None, 0, 1,
        PRIORITY_SUPPLIER, completeness("RUC_PROVEEDOR", "NOMBRE_PROVEEDOR_ESTANDAR")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def version_order(year="ANIO_ARCHIVO", month="MES_ARCHIVO", prio="PRIORIDAD_FUENTE",
                  score="COMPLETITUD") -> Column:
    """PRJ-15 in 64-bit arithmetic (year*10^6 overflows 32-bit ints)."""
    return (F.col(year).cast("long") * 1000000 + F.col(month).cast("long") * 10000
            + F.col(prio).cast("long") * 100 + F.col(score).cast("long"))


def dim_organizacion(candidates: DataFrame) -> DataFrame:
    """AGG-1..3 + PRJ-12: one row per organisation key.

    Each attribute is the newest *non-NULL* value (so one organisation may
    mix sources), roles are OR-ed, first/last period are min/max.  Ties on
    the version order are broken by the larger value, deterministically.

    Equal candidates of several periods are first counted as one with its newest
    order (of equal values only the newest can win): a hash aggregate, whose
    partial step leaves few rows to sort and to exchange.
    """
    period = (F.col("ANIO_ARCHIVO") * 100 + F.col("MES_ARCHIVO")).cast("int")
    c = candidates.filter(F.col("CLAVE_ORGANIZACION").isNotNull()) \
        .withColumns({"ORDEN_VERSION": version_order(), "_PERIODO": period}) \
        .groupBy("CLAVE_ORGANIZACION", *ORG_ATTRS, "ES_ENTIDAD", "ES_PROVEEDOR").agg(
            F.max("ORDEN_VERSION").alias("ORDEN_VERSION"),
            F.min("_PERIODO").alias("_PRIMERO"), F.max("_PERIODO").alias("_ULTIMO"))
    agg = c.groupBy("CLAVE_ORGANIZACION").agg(
        *[last_non_null(a, F.col("ORDEN_VERSION"), a) for a in ORG_ATTRS],
        F.max("ES_ENTIDAD").alias("ES_ENTIDAD"),
        F.max("ES_PROVEEDOR").alias("ES_PROVEEDOR"),
        F.min("_PRIMERO").alias("PERIODO_PRIMERA_APARICION"),
        F.max("_ULTIMO").alias("PERIODO_ULTIMA_APARICION"))
    tipo = (F.when((F.col("ES_ENTIDAD") == 1) & (F.col("ES_PROVEEDOR") == 1), ORG_BOTH)
            .when(F.col("ES_ENTIDAD") == 1, ORG_ENTITY)
            .when(F.col("ES_PROVEEDOR") == 1, ORG_SUPPLIER)
            .otherwise(ORG_OTHER))
    return agg.select(
        F.md5("CLAVE_ORGANIZACION").alias("ORGANIZACION_HASH"),
        "CLAVE_ORGANIZACION", "ID_ORGANIZACION_ORIGINAL", "RUC", "RUC_VALIDO",
        "NOMBRE_ORIGINAL", "NOMBRE_ESTANDAR", tipo.alias("TIPO_ORGANIZACION"),
        "DIRECCION", "LOCALIDAD", "REGION", "DEPARTAMENTO", "PAIS",
        K.location_key(F.col("PAIS"), F.col("DEPARTAMENTO"), F.col("REGION"),
                       F.col("LOCALIDAD")).alias("CLAVE_UBICACION"),
        "ES_ENTIDAD", "ES_PROVEEDOR", "PERIODO_PRIMERA_APARICION",
        "PERIODO_ULTIMA_APARICION")


def dim_ubicacion(dim_org: DataFrame) -> DataFrame:
    """SET-3: distinct locations of the organisation master."""
    return (dim_org.filter(F.col("CLAVE_UBICACION").isNotNull())
            .select("CLAVE_UBICACION", "PAIS", "DEPARTAMENTO", "REGION", "LOCALIDAD")
            .distinct())


# -------------------------------------------------------------------- fact

_FALLBACK_ATTRS = [
    ("RUC_ENTIDAD", ["RUC_ENTIDAD_CONTRATANTE", "RUC_COMPRADOR"]),
    ("ID_ENTIDAD", ["ID_ENTIDAD_CONTRATANTE", "ID_COMPRADOR"]),
    ("NOMBRE_ENTIDAD_ORIGINAL", ["NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL",
                                 "NOMBRE_COMPRADOR_ORIGINAL"]),
    ("NOMBRE_ENTIDAD_ESTANDAR", ["NOMBRE_ENTIDAD_ESTANDAR", "NOMBRE_COMPRADOR_ESTANDAR"]),
]
_TENDER_ATTRS = ["ID_LICITACION", "TITULO_LICITACION", "DESCRIPCION_LICITACION",
                 "METODO_CONTRATACION", "DETALLE_METODO_CONTRATACION",
                 "CATEGORIA_PRINCIPAL", "MONTO_LICITACION", "MONEDA_LICITACION",
                 "NOMBRE_MONEDA_LICITACION"]
_RECORD_COLS = sorted({c for _, cs in _FALLBACK_ATTRS for c in cs} | set(_TENDER_ATTRS))


def enrich_with_records(contracts: DataFrame, reg_by_key: DataFrame,
                        reg_by_ocid: DataFrame) -> DataFrame:
    """J-1 + J-2 + PRJ-12/13: exact (OCID, ID_ENTREGA) match first, then the
    OCID-only fallback; attributes coalesce exact before fallback."""
    re_ = reg_by_key.select(F.col("OCID").alias("_re_ocid"),
                            F.col("ID_ENTREGA").alias("_re_ent"),
                            *[F.col(c).alias(f"re_{c}") for c in _RECORD_COLS])
    ro = reg_by_ocid.select(F.col("OCID").alias("_ro_ocid"),
                            *[F.col(c).alias(f"ro_{c}") for c in _RECORD_COLS])
    j = (contracts
         .join(re_, (F.col("OCID") == F.col("_re_ocid")) &
               (F.col("ID_ENTREGA") == F.col("_re_ent")), "left")
         .join(ro, F.col("OCID") == F.col("_ro_ocid"), "left"))
    rel = (F.when(F.col("_re_ocid").isNotNull(), REL_EXACT)
           .when(F.col("_ro_ocid").isNotNull(), REL_FALLBACK).otherwise(REL_NONE))
    out = [F.col(c) for c in contracts.columns] + [rel.alias("TIPO_RELACION_REGISTRO")]
    for name, srcs in _FALLBACK_ATTRS:
        out.append(F.coalesce(*[F.col(f"{p}_{s}") for p in ("re", "ro") for s in srcs])
                   .alias(name))
    for a in _TENDER_ATTRS:
        out.append(F.coalesce(F.col(f"re_{a}"), F.col(f"ro_{a}")).alias(a))
    return j.select(*out)


FACT_COLUMNS = [
    "CONTRATO_HASH", "CLAVE_CONTRATO", "OCID", "ID_ENTREGA", "ID_CONTRATO",
    "ID_ADJUDICACION", "CLAVE_ENTIDAD", "CLAVE_UBICACION_ENTIDAD", "CLAVE_MONEDA",
    "CLAVE_CATEGORIA", "CLAVE_METODO", "FECHA_FIRMA_KEY", "FECHA_INICIO_KEY",
    "FECHA_FIN_KEY", "TITULO_CONTRATO", "DESCRIPCION_CONTRATO", "FECHA_FIRMA",
    "FECHA_INICIO", "FECHA_FIN", "FECHA_FIN_IMPLEMENTACION", "DURACION_DIAS",
    "MONTO_CONTRATO", "MONEDA_CONTRATO", "NOMBRE_MONEDA_CONTRATO", "MONTO_FINAL",
    "MONEDA_FINAL", "NOMBRE_MONEDA_FINAL", "RUC_ENTIDAD", "ID_ENTIDAD",
    "NOMBRE_ENTIDAD_ORIGINAL", "NOMBRE_ENTIDAD_ESTANDAR", *_TENDER_ATTRS,
    "TIPO_RELACION_REGISTRO", "ANIO_ARCHIVO", "MES_ARCHIVO", "ARCHIVO_ORIGEN",
    "HASH_FILA"]


def entity_locations(records: DataFrame, dim_org: DataFrame) -> DataFrame:
    """(OCID, entity key, its location) for every entity key that a contract of
    the process can get from ``records``: a record with a tax id gives only
    tax-id keys, one without gives its ids (see ``_FALLBACK_ATTRS``, ``K.org_key``)."""
    rucs, ids = (dict(_FALLBACK_ATTRS)[a] for a in ("RUC_ENTIDAD", "ID_ENTIDAD"))
    null = F.lit(None).cast("string")
    has_ruc = F.coalesce(*rucs).isNotNull()
    keys = F.when(has_ruc, F.array(*[K.org_key(F.col(r), null) for r in rucs])) \
        .otherwise(F.array(*[K.org_key(null, F.col(i)) for i in ids]))
    pairs = records.select("OCID", F.explode(F.array_distinct(keys)).alias("CLAVE_ORGANIZACION")) \
        .filter(F.col("OCID").isNotNull() & F.col("CLAVE_ORGANIZACION").isNotNull())
    placed = pairs.join(dim_org.select("CLAVE_ORGANIZACION", "CLAVE_UBICACION")
                        .filter(F.col("CLAVE_UBICACION").isNotNull()), "CLAVE_ORGANIZACION")
    return dealt_by(placed.dropDuplicates(["CLAVE_ORGANIZACION", "OCID"]).select(
        F.col("OCID").alias("_org_ocid"), F.col("CLAVE_ORGANIZACION").alias("_org_key"),
        F.col("CLAVE_UBICACION").alias("CLAVE_UBICACION_ENTIDAD")), "_org_ocid")


def fact_contrato(contracts: DataFrame, reg_by_key: DataFrame, reg_by_ocid: DataFrame,
                  dim_org: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Fact of current contracts with entity, keys, date keys and row hash.

    With ``records`` (the staged rows that both record frames are chosen from)
    the entities' locations are looked up per process and joined on it, so wide
    contract rows that are dealt by OCID are not dealt again by entity, a key
    that is often NULL and often the same.
    """
    e = enrich_with_records(contracts, reg_by_key, reg_by_ocid)
    e = e.withColumns({
        "CLAVE_ENTIDAD": K.org_key(F.col("RUC_ENTIDAD"), F.col("ID_ENTIDAD")),
        "CLAVE_MONEDA": K.currency_key(F.col("MONEDA_CONTRATO"),
                                       F.col("NOMBRE_MONEDA_CONTRATO")),
        "CLAVE_CATEGORIA": K.category_key(F.col("CATEGORIA_PRINCIPAL")),
        "CLAVE_METODO": K.method_key(F.col("METODO_CONTRATACION"),
                                     F.col("DETALLE_METODO_CONTRATACION")),
    })
    if records is None:
        org = dim_org.select(F.col("CLAVE_ORGANIZACION").alias("_org_key"),
                             F.col("CLAVE_UBICACION").alias("CLAVE_UBICACION_ENTIDAD"))
        j = e.join(org, F.col("CLAVE_ENTIDAD") == F.col("_org_key"), "left")
    else:
        j = e.join(entity_locations(records, dim_org), (F.col("OCID") == F.col("_org_ocid")) &
                   (F.col("CLAVE_ENTIDAD") == F.col("_org_key")), "left")
    j = j.withColumns({
        "CONTRATO_HASH": F.md5("CLAVE_CONTRATO"),
        "FECHA_FIRMA_KEY": D.date_key(F.col("FECHA_FIRMA")),
        "FECHA_INICIO_KEY": D.date_key(F.col("FECHA_INICIO")),
        "FECHA_FIN_KEY": D.date_key(F.col("FECHA_FIN")),
        "HASH_FILA": K.row_hash(F.col("CLAVE_CONTRATO"), F.col("CLAVE_ENTIDAD"),
                                F.col("MONTO_CONTRATO"), F.col("MONEDA_CONTRATO"),
                                F.col("FECHA_FIRMA"), F.col("FECHA_INICIO"),
                                F.col("FECHA_FIN"), F.col("DESCRIPCION_CONTRATO")),
    })
    return j.select(*FACT_COLUMNS)  # a missing column raises


# ------------------------------------------------------------------ bridge

BRIDGE_COLUMNS = ["CLAVE_CONTRATO", "CLAVE_PROVEEDOR", "ID_PROVEEDOR", "RUC_PROVEEDOR",
                  "NOMBRE_PROVEEDOR_ORIGINAL", "NOMBRE_PROVEEDOR_ESTANDAR"]


def bridge_contrato_proveedor(contracts: DataFrame, suppliers: DataFrame,
                              one_row_per_key: bool = False, process: bool = False) -> DataFrame:
    """J-4 + SET-3: contract x supplier on (OCID, award), distinct.

    ``one_row_per_key`` keeps one row per (contract, supplier) -- the newest
    name -- so the warehouse primary key holds (trap: the reference's DISTINCT
    keeps name variants as separate rows).  ``contracts`` has a contract once,
    so its OCID may stand among the columns of the distinct: rows joined on
    OCID are then not dealt out again.  ``process``: with the contract's OCID.
    """
    c = contracts.select("CLAVE_CONTRATO", "OCID", "ID_ADJUDICACION")
    s = suppliers.filter(F.col("CLAVE_PROVEEDOR").isNotNull()).select(
        F.col("OCID").alias("_s_ocid"), F.col("ID_ADJUDICACION").alias("_s_adj"),
        *[c_ for c_ in BRIDGE_COLUMNS[1:]], "ANIO_ARCHIVO", "MES_ARCHIVO")
    j = c.join(s, (F.col("OCID") == F.col("_s_ocid")) &
               (F.col("ID_ADJUDICACION") == F.col("_s_adj")), "inner")
    if not one_row_per_key:
        rows = j.select("OCID", *BRIDGE_COLUMNS).distinct()
        return rows if process else rows.drop("OCID")
    return latest_by(j.select(*BRIDGE_COLUMNS, "ANIO_ARCHIVO", "MES_ARCHIVO"),
                     ["CLAVE_CONTRATO", "CLAVE_PROVEEDOR"],
                     [F.col("ANIO_ARCHIVO"), F.col("MES_ARCHIVO")]) \
        .select(*BRIDGE_COLUMNS)


# --------------------------------------------------------------- role dims

def dim_entidad(dim_org: DataFrame, fact: DataFrame) -> DataFrame:
    """J-5: organisations used as entity by the fact (semi join; each task
    hands on a key once)."""
    used = fact.select(F.col("CLAVE_ENTIDAD").alias("CLAVE_ORGANIZACION")) \
        .filter(F.col("CLAVE_ORGANIZACION").isNotNull()).distinct()
    return dim_org.join(used, "CLAVE_ORGANIZACION", "left_semi")


def dim_proveedor(dim_org: DataFrame, bridge: DataFrame) -> DataFrame:
    """J-5: organisations used as supplier by the bridge (semi join)."""
    used = bridge.select(F.col("CLAVE_PROVEEDOR").alias("CLAVE_ORGANIZACION")) \
        .filter(F.col("CLAVE_ORGANIZACION").isNotNull()).distinct()
    return dim_org.join(used, "CLAVE_ORGANIZACION", "left_semi")


# ------------------------------------------------------ complementary dims

def _one_per_key(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Deterministic single row per key: smallest attribute tuple (NULLs last)."""
    best = F.min(F.struct(*[F.struct(F.col(a).isNull().alias("n"),
                                     F.col(a).alias("v")).alias(f"a{i}")
                            for i, a in enumerate(attrs)]))
    agg = df.groupBy(key).agg(best.alias("_b"))
    return agg.select(key, *[F.col(f"_b.a{i}.v").alias(a) for i, a in enumerate(attrs)])


def dim_moneda(fact: DataFrame, one_row_per_key: bool = False) -> DataFrame:
    d = fact.select("CLAVE_MONEDA", F.col("MONEDA_CONTRATO").alias("CODIGO_MONEDA"),
                    F.col("NOMBRE_MONEDA_CONTRATO").alias("NOMBRE_MONEDA"))
    if one_row_per_key:
        return _one_per_key(d, "CLAVE_MONEDA", ["CODIGO_MONEDA", "NOMBRE_MONEDA"])
    return d.distinct()


def dim_categoria(fact: DataFrame, one_row_per_key: bool = False) -> DataFrame:
    d = fact.filter(F.col("CLAVE_CATEGORIA").isNotNull()) \
        .select("CLAVE_CATEGORIA", "CATEGORIA_PRINCIPAL")
    if one_row_per_key:
        return _one_per_key(d, "CLAVE_CATEGORIA", ["CATEGORIA_PRINCIPAL"])
    return d.distinct()


def dim_metodo(fact: DataFrame, one_row_per_key: bool = False) -> DataFrame:
    d = fact.filter(F.col("CLAVE_METODO").isNotNull()) \
        .select("CLAVE_METODO", "METODO_CONTRATACION", "DETALLE_METODO_CONTRATACION")
    if one_row_per_key:
        return _one_per_key(d, "CLAVE_METODO",
                            ["METODO_CONTRATACION", "DETALLE_METODO_CONTRATACION"])
    return d.distinct()


# ---------------------------------------------------------------- date dim

def date_range_bounds(df: DataFrame, date_cols: list[str]) -> DataFrame:
    """AGG-14 + SET-2 + PRJ-9: one row (FECHA_MINIMA, FECHA_MAXIMA) over the
    union of the date columns restricted to 2000..2100, with defaults."""
    lo = F.lit(D.DATE_DIM_MIN).cast("date")
    hi = F.lit(D.DATE_DIM_MAX).cast("date")
    stacked = df.select(F.explode(F.array(*[F.col(c).cast("date") for c in date_cols]))
                        .alias("FECHA"))
    inrange = stacked.filter(F.col("FECHA").between(lo, hi))
    return inrange.agg(
        F.coalesce(F.min("FECHA"), F.lit(D.DATE_DIM_DEFAULT_FROM).cast("date"))
        .alias("FECHA_MINIMA"),
        F.coalesce(F.max("FECHA"), F.lit(D.DATE_DIM_DEFAULT_TO).cast("date"))
        .alias("FECHA_MAXIMA"))


def dim_fecha(df: DataFrame, date_cols: list[str]) -> DataFrame:
    """GEN-1 + F-21: one row per day between the bounds (dates, not times)."""
    b = date_range_bounds(df, date_cols)
    days = b.select(F.explode(F.sequence("FECHA_MINIMA", "FECHA_MAXIMA",
                                         F.expr("INTERVAL 1 DAY"))).alias("FECHA"))
    cols = D.calendar_columns(F.col("FECHA"))
    return days.select(*[v.alias(k) for k, v in cols.items()])
