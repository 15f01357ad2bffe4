"""DuckDB SQL oracles for the registered queries.

Written independently of the DataFrame code: the adapters' NULL-injection
rules and the reference's curated SQL semantics, expressed as plain SQL over
the pre-registered views.  ``ROW_NUMBER`` windows stand where the Spark side
uses ``max(struct)`` aggregates, so the two engines reach the same rows by
different plans.
"""

from __future__ import annotations

from . import adapters as A


def std_name(x: str, keep: str = "A-Z0-9Ñ& ") -> str:
    """Standard name in DuckDB (accents stripped; sharp s expanded first)."""
    return (f"NULLIF(trim(regexp_replace(regexp_replace(strip_accents(upper(replace("
            f"{x}, 'ß', 'SS'))), '[^{keep}]+', ' ', 'g'), ' +', ' ', 'g')), '')")


def ruc_valid(r: str) -> str:
    weights = [5, 4, 3, 2, 7, 6, 5, 4, 3, 2]
    s = " + ".join(f"CAST(substr({r}, {i + 1}, 1) AS INTEGER) * {w}"
                   for i, w in enumerate(weights))
    return (f"(CASE WHEN {r} IS NULL THEN NULL WHEN NOT regexp_full_match({r}, '[0-9]{{11}}') "
            f"THEN false ELSE ((11 - (({s}) % 11)) % 10) = CAST(substr({r}, 11, 1) AS INTEGER) END)")


def syn_ruc(k: str) -> str:
    return f"('20' || lpad(CAST({k} AS VARCHAR), 9, '0'))"


def nul(cond: str, expr: str) -> str:
    return f"CASE WHEN {cond} THEN NULL ELSE {expr} END"


def loc_key(p="PAIS", d="DEPARTAMENTO", r="REGION", l="LOCALIDAD") -> str:
    return (f"CASE WHEN {p} IS NOT NULL OR {d} IS NOT NULL OR {r} IS NOT NULL OR {l} IS NOT NULL "
            f"THEN md5(concat_ws('|', coalesce({p}, ''), coalesce({d}, ''), coalesce({r}, ''), "
            f"coalesce({l}, ''))) ELSE NULL END")


CUR = "CASE l_returnflag WHEN 'A' THEN 'PEN' WHEN 'R' THEN 'USD' ELSE NULL END"
CUR_NAME = ("CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Soles' "
            "WHEN l_returnflag = 'A' THEN 'soles ' WHEN l_returnflag = 'R' THEN 'Dolares' "
            "WHEN l_linestatus = 'F' THEN 'Euro' ELSE NULL END")
FIN = "(l_shipdate + to_days(CAST(l_quantity AS INTEGER)))"

LINE_OCID = ("(CASE WHEN l_partkey % 13 = 0 THEN 'SR-' || CAST(l_orderkey AS VARCHAR) "
             "ELSE CAST(l_orderkey AS VARCHAR) END)")

STG_CONTRATOS = f"""stg_contratos AS (
  SELECT {LINE_OCID} AS OCID, l_linestatus AS ID_ENTREGA,
    CAST(l_linenumber AS VARCHAR) AS ID_CONTRATO, CAST(l_suppkey AS VARCHAR) AS ID_ADJUDICACION,
    'PARTE ' || CAST(l_partkey AS VARCHAR) AS TITULO_CONTRATO,
    {nul("l_partkey % 11 = 0", "'item ' || CAST(l_partkey AS VARCHAR) || ' qty ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)")} AS DESCRIPCION_CONTRATO,
    {nul("l_partkey % 7 = 0", "l_shipdate + INTERVAL 1 DAY")} AS FECHA_INICIO,
    {FIN} AS FECHA_FIN, l_quantity AS DURACION_DIAS, l_extendedprice AS MONTO_CONTRATO,
    {CUR} AS MONEDA_CONTRATO, {CUR_NAME} AS NOMBRE_MONEDA_CONTRATO,
    {nul("l_partkey % 5 = 0", "l_shipdate")} AS FECHA_FIRMA,
    l_extendedprice * (CAST(1.0 AS DOUBLE) - l_discount) AS MONTO_FINAL,
    {CUR} AS MONEDA_FINAL, {CUR_NAME} AS NOMBRE_MONEDA_FINAL,
    {FIN} AS FECHA_FIN_IMPLEMENTACION,
    {LINE_OCID} || '|' || CAST(l_linenumber AS VARCHAR) AS CLAVE_CONTRATO,
    CAST(year(l_shipdate) AS INTEGER) AS ANIO_ARCHIVO,
    CAST(month(l_shipdate) AS INTEGER) AS MES_ARCHIVO,
    'paquete_' || strftime(l_shipdate, '%Y%m') || '.xlsx' AS ARCHIVO_ORIGEN
  FROM lineitem)"""


def _registros_version(v: int) -> str:
    fdate = "o_orderdate" if v != 1 else "(o_orderdate + INTERVAL 1 MONTH)"
    where = {0: "", 1: "WHERE o_orderkey % 3 = 0", 2: "WHERE o_orderkey % 7 = 0"}[v]
    b_name = nul("o_orderkey % 3 = 0", "'Comprador ' || CAST(o_custkey AS VARCHAR)")
    e_name = nul("o_orderkey % 5 = 0 OR o_orderkey % 11 = 1",
                 "'Entidad N° ' || CAST(o_custkey AS VARCHAR)")
    b_ruc = nul("o_orderkey % 3 = 0 OR o_custkey % 4 = 0", syn_ruc("o_custkey"))
    e_ruc = nul("o_orderkey % 5 = 0 OR o_custkey % 4 = 0", syn_ruc("o_custkey"))
    lic = "NULL" if v == 1 else nul("o_orderkey % 9 = 0", "'LIC-' || CAST(o_orderkey AS VARCHAR)")
    cat = "NULL" if v == 1 else nul(
        "o_orderkey % 8 = 0",
        "CASE o_orderstatus WHEN 'F' THEN 'bienes' WHEN 'O' THEN 'Bienes ' ELSE 'servicios' END")
    method = "NULL" if v == 2 else nul("o_orderkey % 10 = 0", "o_orderpriority")
    return f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS OCID, o_orderstatus AS ID_ENTREGA,
    {nul("o_orderkey % 4 = 0", "o_orderdate")} AS FECHA_ENTREGA,
    o_orderdate - INTERVAL 2 DAY AS FECHA_PUBLICACION,
    {nul("o_orderkey % 3 = 0", "CAST(o_custkey AS VARCHAR)")} AS ID_COMPRADOR,
    {b_name} AS NOMBRE_COMPRADOR_ORIGINAL,
    {b_ruc} AS RUC_COMPRADOR, {ruc_valid(b_ruc)} AS RUC_COMPRADOR_VALIDO,
    {std_name(b_name)} AS NOMBRE_COMPRADOR_ESTANDAR,
    {nul("o_orderkey % 5 = 0", "CAST(o_custkey AS VARCHAR)")} AS ID_ENTIDAD_CONTRATANTE,
    {e_name} AS NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL,
    {e_ruc} AS RUC_ENTIDAD_CONTRATANTE, {ruc_valid(e_ruc)} AS RUC_ENTIDAD_VALIDO,
    {std_name(e_name)} AS NOMBRE_ENTIDAD_ESTANDAR,
    CAST({lic} AS VARCHAR) AS ID_LICITACION,
    'Licitacion ' || CAST(o_orderkey AS VARCHAR) AS TITULO_LICITACION,
    {nul("o_orderkey % 2 = 1", "'Compra de ' || o_orderpriority")} AS DESCRIPCION_LICITACION,
    CAST({method} AS VARCHAR) AS METODO_CONTRATACION,
    {nul("o_orderkey % 2 = 1", "lower(o_orderpriority)")} AS DETALLE_METODO_CONTRATACION,
    CAST({cat} AS VARCHAR) AS CATEGORIA_PRINCIPAL,
    o_totalprice AS MONTO_LICITACION, 'PEN' AS MONEDA_LICITACION,
    'Soles' AS NOMBRE_MONEDA_LICITACION,
    CAST(year({fdate}) AS INTEGER) AS ANIO_ARCHIVO, CAST(month({fdate}) AS INTEGER) AS MES_ARCHIVO,
    'paquete_' || strftime({fdate}, '%Y%m') || '.xlsx' AS ARCHIVO_ORIGEN
  FROM orders {where}"""


STG_REGISTROS = ("stg_registros AS (" + " UNION ALL ".join(
    _registros_version(v) for v in (0, 1, 2)) + ")")

_SUP_RUC = nul("s_suppkey % 6 = 0", syn_ruc("s_suppkey"))
STG_PROVEEDORES = f"""stg_proveedores AS (
  WITH both_ AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_shipdate, s_suppkey, s_name AS nm
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    UNION ALL
    SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, l_shipdate, s_suppkey, lower(s_name) AS nm
    FROM lineitem JOIN supplier ON l_suppkey + 1 = s_suppkey WHERE l_linenumber = 1)
  SELECT {LINE_OCID} AS OCID, l_linestatus AS ID_ENTREGA,
    CAST(l_suppkey AS VARCHAR) AS ID_ADJUDICACION, CAST(s_suppkey AS VARCHAR) AS ID_PROVEEDOR,
    nm AS NOMBRE_PROVEEDOR_ORIGINAL, {_SUP_RUC} AS RUC_PROVEEDOR,
    {ruc_valid(_SUP_RUC)} AS RUC_PROVEEDOR_VALIDO, {std_name("nm")} AS NOMBRE_PROVEEDOR_ESTANDAR,
    CAST(year(l_shipdate) AS INTEGER) AS ANIO_ARCHIVO, CAST(month(l_shipdate) AS INTEGER) AS MES_ARCHIVO,
    'paquete_' || strftime(l_shipdate, '%Y%m') || '.xlsx' AS ARCHIVO_ORIGEN
  FROM both_)"""

_ROLES = ("(CASE c_custkey % 4 WHEN 0 THEN 'buyer, procuringEntity' WHEN 1 THEN 'supplier' "
          "WHEN 2 THEN 'Proveedor / Comprador' ELSE " + nul("o_orderkey % 2 = 0", "'tenderer'") + " END)")
_PARTY_RUC = nul("c_custkey % 4 = 0", syn_ruc("c_custkey"))
STG_PARTES = f"""stg_partes AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS OCID, 'F' AS ID_ENTREGA,
    CAST(c_custkey AS VARCHAR) AS ID_ORGANIZACION, {_PARTY_RUC} AS RUC_ORGANIZACION,
    {ruc_valid(_PARTY_RUC)} AS RUC_VALIDO, c_name AS NOMBRE_ORGANIZACION_ORIGINAL,
    {std_name("c_name")} AS NOMBRE_ORGANIZACION_ESTANDAR,
    {nul("o_orderkey % 4 = 1", std_name("c_mktsegment", "A-Z0-9Ñ&/ -"))} AS DIRECCION_ESTANDAR,
    {nul("c_custkey % 5 = 0", "'LOC ' || CAST(c_custkey % 17 AS VARCHAR)")} AS LOCALIDAD_ESTANDAR,
    {nul("o_orderkey % 6 = 0", "r_name")} AS REGION_ESTANDAR,
    n_name AS DEPARTAMENTO_ESTANDAR, 'PERU' AS PAIS_ESTANDAR,
    {_ROLES} AS ROLES_ORIGINAL, {std_name(_ROLES, "A-Z0-9Ñ&/ -")} AS ROLES_ESTANDAR,
    coalesce(regexp_matches({std_name(_ROLES, "A-Z0-9Ñ&/ -")}, 'BUYER|PROCURINGENTITY|COMPRADOR|ENTIDAD CONTRATANTE'), false) AS ES_COMPRADOR_O_ENTIDAD,
    coalesce(regexp_matches({std_name(_ROLES, "A-Z0-9Ñ&/ -")}, 'SUPPLIER|PROVEEDOR'), false) AS ES_PROVEEDOR,
    CASE WHEN {_PARTY_RUC} IS NOT NULL THEN 'RUC|' || {_PARTY_RUC}
         ELSE 'ID|' || CAST(c_custkey AS VARCHAR) END AS CLAVE_ORGANIZACION,
    CAST(year(o_orderdate) AS INTEGER) AS ANIO_ARCHIVO, CAST(month(o_orderdate) AS INTEGER) AS MES_ARCHIVO
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def desc_all(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def payload(cols, keys) -> list[str]:
    return [c for c in cols if c not in keys]


CONTRATO_ACTUAL = f"""contrato_actual AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY CLAVE_CONTRATO ORDER BY
      ANIO_ARCHIVO DESC NULLS LAST, MES_ARCHIVO DESC NULLS LAST,
      coalesce(FECHA_FIRMA, FECHA_INICIO, FECHA_FIN, TIMESTAMP '1900-01-01') DESC NULLS LAST,
      ID_ENTREGA DESC NULLS LAST, {desc_all(payload(A.CONTRACT_COLUMNS, ['CLAVE_CONTRATO']))}) AS rn
    FROM stg_contratos WHERE CLAVE_CONTRATO IS NOT NULL) WHERE rn = 1)"""

_COMPLETENESS = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in
                           ["ID_ENTIDAD_CONTRATANTE", "NOMBRE_ENTIDAD_ESTANDAR", "ID_COMPRADOR",
                            "ID_LICITACION", "METODO_CONTRATACION", "CATEGORIA_PRINCIPAL"])


def registro_actual(name: str, keys: list[str], where: str = "") -> str:
    # tie-break columns: the payload in adapter order with the score in front
    # of nothing (score is computed, then excluded, exactly as on Spark).
    pl = payload(A.RECORD_COLUMNS, keys)
    part = ", ".join(keys)
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    extra = f" AND {where}" if where else ""
    return f"""{name} AS (
  SELECT * EXCLUDE (completitud) FROM (
    SELECT *, {_COMPLETENESS} AS completitud FROM stg_registros
    WHERE {notnull}{extra}) x
  QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY ANIO_ARCHIVO DESC NULLS LAST,
      MES_ARCHIVO DESC NULLS LAST, completitud DESC NULLS LAST,
      coalesce(FECHA_ENTREGA, FECHA_PUBLICACION, TIMESTAMP '1900-01-01') DESC NULLS LAST,
      {desc_all(pl)}) = 1)"""


PROVEEDOR_ACTUAL = f"""proveedor_actual AS (
  SELECT * EXCLUDE (rn),
    CASE WHEN RUC_PROVEEDOR IS NOT NULL THEN 'RUC|' || RUC_PROVEEDOR ELSE 'ID|' || ID_PROVEEDOR END
      AS CLAVE_PROVEEDOR
  FROM (SELECT *, row_number() OVER (PARTITION BY OCID, ID_ADJUDICACION, ID_PROVEEDOR ORDER BY
      ANIO_ARCHIVO DESC NULLS LAST, MES_ARCHIVO DESC NULLS LAST, ID_ENTREGA DESC NULLS LAST,
      {desc_all(payload(A.SUPPLIER_COLUMNS, ['OCID', 'ID_ADJUDICACION', 'ID_PROVEEDOR']))}) AS rn
    FROM stg_proveedores
    WHERE OCID IS NOT NULL AND ID_ADJUDICACION IS NOT NULL AND ID_PROVEEDOR IS NOT NULL)
  WHERE rn = 1)"""


def _cand(src, key, ident, ruc, valid, name, std, geo, ent, sup, prio, score, where):
    g = {k: geo.get(k, "CAST(NULL AS VARCHAR)") for k in
         ["DIRECCION", "LOCALIDAD", "REGION", "DEPARTAMENTO", "PAIS"]}
    return f"""SELECT {key} AS CLAVE_ORGANIZACION, CAST({ident} AS VARCHAR) AS ID_ORGANIZACION_ORIGINAL,
    {ruc} AS RUC, CAST({valid} AS BOOLEAN) AS RUC_VALIDO, {name} AS NOMBRE_ORIGINAL,
    {std} AS NOMBRE_ESTANDAR, {g['DIRECCION']} AS DIRECCION, {g['LOCALIDAD']} AS LOCALIDAD,
    {g['REGION']} AS REGION, {g['DEPARTAMENTO']} AS DEPARTAMENTO, {g['PAIS']} AS PAIS,
    CAST({ent} AS INTEGER) AS ES_ENTIDAD, CAST({sup} AS INTEGER) AS ES_PROVEEDOR,
    ANIO_ARCHIVO, MES_ARCHIVO, {prio} AS PRIORIDAD_FUENTE, {score} AS COMPLETITUD
  FROM {src} WHERE {where}"""


def _sc(*cols):
    return "(" + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols) + ")"


ORG_CANDIDATO = "organizacion_candidato AS (" + " UNION ALL ".join([
    _cand("stg_partes", "CLAVE_ORGANIZACION", "ID_ORGANIZACION", "RUC_ORGANIZACION", "RUC_VALIDO",
          "NOMBRE_ORGANIZACION_ORIGINAL", "NOMBRE_ORGANIZACION_ESTANDAR",
          {"DIRECCION": "DIRECCION_ESTANDAR", "LOCALIDAD": "LOCALIDAD_ESTANDAR",
           "REGION": "REGION_ESTANDAR", "DEPARTAMENTO": "DEPARTAMENTO_ESTANDAR",
           "PAIS": "PAIS_ESTANDAR"}, "ES_COMPRADOR_O_ENTIDAD", "ES_PROVEEDOR", 3,
          _sc("RUC_ORGANIZACION", "NOMBRE_ORGANIZACION_ESTANDAR", "DEPARTAMENTO_ESTANDAR",
              "REGION_ESTANDAR", "LOCALIDAD_ESTANDAR"), "CLAVE_ORGANIZACION IS NOT NULL"),
    _cand("stg_registros", "CASE WHEN RUC_ENTIDAD_CONTRATANTE IS NOT NULL THEN 'RUC|' || "
          "RUC_ENTIDAD_CONTRATANTE ELSE 'ID|' || ID_ENTIDAD_CONTRATANTE END",
          "ID_ENTIDAD_CONTRATANTE", "RUC_ENTIDAD_CONTRATANTE", "RUC_ENTIDAD_VALIDO",
          "NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL", "NOMBRE_ENTIDAD_ESTANDAR", {}, 1, 0, 2,
          _sc("RUC_ENTIDAD_CONTRATANTE", "NOMBRE_ENTIDAD_ESTANDAR"),
          "ID_ENTIDAD_CONTRATANTE IS NOT NULL"),
    _cand("stg_registros", "CASE WHEN RUC_COMPRADOR IS NOT NULL THEN 'RUC|' || RUC_COMPRADOR "
          "ELSE 'ID|' || ID_COMPRADOR END", "ID_COMPRADOR", "RUC_COMPRADOR",
          "RUC_COMPRADOR_VALIDO", "NOMBRE_COMPRADOR_ORIGINAL", "NOMBRE_COMPRADOR_ESTANDAR", {},
          1, 0, 2, _sc("RUC_COMPRADOR", "NOMBRE_COMPRADOR_ESTANDAR"), "ID_COMPRADOR IS NOT NULL"),
    _cand("stg_proveedores", "CASE WHEN RUC_PROVEEDOR IS NOT NULL THEN 'RUC|' || RUC_PROVEEDOR "
          "ELSE 'ID|' || ID_PROVEEDOR END", "ID_PROVEEDOR", "RUC_PROVEEDOR",
          "RUC_PROVEEDOR_VALIDO", "NOMBRE_PROVEEDOR_ORIGINAL", "NOMBRE_PROVEEDOR_ESTANDAR", {},
          0, 1, 1, _sc("RUC_PROVEEDOR", "NOMBRE_PROVEEDOR_ESTANDAR"), "ID_PROVEEDOR IS NOT NULL"),
]) + ")"

_ORG_ATTRS = ["ID_ORGANIZACION_ORIGINAL", "RUC", "RUC_VALIDO", "NOMBRE_ORIGINAL",
              "NOMBRE_ESTANDAR", "DIRECCION", "LOCALIDAD", "REGION", "DEPARTAMENTO", "PAIS"]

DIM_ORGANIZACION = """dim_organizacion_agg AS (
  SELECT CLAVE_ORGANIZACION, """ + ", ".join(
    f"(max({{'o': ORDEN_VERSION, 'v': {a}}}) FILTER (WHERE {a} IS NOT NULL)).v AS {a}"
    for a in _ORG_ATTRS) + """,
    max(ES_ENTIDAD) AS ES_ENTIDAD, max(ES_PROVEEDOR) AS ES_PROVEEDOR,
    CAST(min(ANIO_ARCHIVO * 100 + MES_ARCHIVO) AS INTEGER) AS PERIODO_PRIMERA_APARICION,
    CAST(max(ANIO_ARCHIVO * 100 + MES_ARCHIVO) AS INTEGER) AS PERIODO_ULTIMA_APARICION
  FROM (SELECT *, CAST(ANIO_ARCHIVO AS BIGINT) * 1000000 + MES_ARCHIVO * 10000
          + PRIORIDAD_FUENTE * 100 + COMPLETITUD AS ORDEN_VERSION
        FROM organizacion_candidato WHERE CLAVE_ORGANIZACION IS NOT NULL)
  GROUP BY CLAVE_ORGANIZACION),
dim_organizacion AS (
  SELECT md5(CLAVE_ORGANIZACION) AS ORGANIZACION_HASH, CLAVE_ORGANIZACION,
    ID_ORGANIZACION_ORIGINAL, RUC, RUC_VALIDO, NOMBRE_ORIGINAL, NOMBRE_ESTANDAR,
    CASE WHEN ES_ENTIDAD = 1 AND ES_PROVEEDOR = 1 THEN 'ENTIDAD_Y_PROVEEDOR'
         WHEN ES_ENTIDAD = 1 THEN 'ENTIDAD' WHEN ES_PROVEEDOR = 1 THEN 'PROVEEDOR'
         ELSE 'OTRO' END AS TIPO_ORGANIZACION,
    DIRECCION, LOCALIDAD, REGION, DEPARTAMENTO, PAIS,
    """ + loc_key() + """ AS CLAVE_UBICACION,
    ES_ENTIDAD, ES_PROVEEDOR, PERIODO_PRIMERA_APARICION, PERIODO_ULTIMA_APARICION
  FROM dim_organizacion_agg)"""

_RE_COLS = ["RUC_ENTIDAD_CONTRATANTE", "RUC_COMPRADOR", "ID_ENTIDAD_CONTRATANTE", "ID_COMPRADOR",
            "NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL", "NOMBRE_COMPRADOR_ORIGINAL",
            "NOMBRE_ENTIDAD_ESTANDAR", "NOMBRE_COMPRADOR_ESTANDAR"]
_TENDER = ["ID_LICITACION", "TITULO_LICITACION", "DESCRIPCION_LICITACION", "METODO_CONTRATACION",
           "DETALLE_METODO_CONTRATACION", "CATEGORIA_PRINCIPAL", "MONTO_LICITACION",
           "MONEDA_LICITACION", "NOMBRE_MONEDA_LICITACION"]


def _dk(c):
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def _ts(c):
    return f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')"


FACT = f"""enriquecido AS (
  SELECT c.*,
    CASE WHEN re.OCID IS NOT NULL THEN 'OCID_Y_ENTREGA' WHEN ro.OCID IS NOT NULL THEN 'RESPALDO_OCID'
         ELSE 'SIN_REGISTRO' END AS TIPO_RELACION_REGISTRO,
    coalesce(re.RUC_ENTIDAD_CONTRATANTE, re.RUC_COMPRADOR, ro.RUC_ENTIDAD_CONTRATANTE, ro.RUC_COMPRADOR) AS RUC_ENTIDAD,
    coalesce(re.ID_ENTIDAD_CONTRATANTE, re.ID_COMPRADOR, ro.ID_ENTIDAD_CONTRATANTE, ro.ID_COMPRADOR) AS ID_ENTIDAD,
    coalesce(re.NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL, re.NOMBRE_COMPRADOR_ORIGINAL, ro.NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL, ro.NOMBRE_COMPRADOR_ORIGINAL) AS NOMBRE_ENTIDAD_ORIGINAL,
    coalesce(re.NOMBRE_ENTIDAD_ESTANDAR, re.NOMBRE_COMPRADOR_ESTANDAR, ro.NOMBRE_ENTIDAD_ESTANDAR, ro.NOMBRE_COMPRADOR_ESTANDAR) AS NOMBRE_ENTIDAD_ESTANDAR,
    {", ".join(f"coalesce(re.{a}, ro.{a}) AS {a}" for a in _TENDER)}
  FROM contrato_actual c
  LEFT JOIN registro_actual_clave re ON c.OCID = re.OCID AND c.ID_ENTREGA = re.ID_ENTREGA
  LEFT JOIN registro_actual_ocid ro ON c.OCID = ro.OCID),
llaves AS (
  SELECT *,
    CASE WHEN RUC_ENTIDAD IS NOT NULL THEN 'RUC|' || RUC_ENTIDAD
         WHEN ID_ENTIDAD IS NOT NULL THEN 'ID|' || ID_ENTIDAD ELSE NULL END AS CLAVE_ENTIDAD,
    CASE WHEN coalesce(MONEDA_CONTRATO, NOMBRE_MONEDA_CONTRATO) IS NOT NULL
         THEN 'MONEDA|' || upper(trim(coalesce(MONEDA_CONTRATO, NOMBRE_MONEDA_CONTRATO)))
         ELSE 'MONEDA|SIN_MONEDA' END AS CLAVE_MONEDA,
    CASE WHEN CATEGORIA_PRINCIPAL IS NOT NULL THEN md5(upper(trim(CATEGORIA_PRINCIPAL))) END AS CLAVE_CATEGORIA,
    CASE WHEN METODO_CONTRATACION IS NOT NULL OR DETALLE_METODO_CONTRATACION IS NOT NULL
         THEN md5(concat_ws('|', upper(trim(coalesce(METODO_CONTRATACION, ''))),
                                  upper(trim(coalesce(DETALLE_METODO_CONTRATACION, ''))))) END AS CLAVE_METODO
  FROM enriquecido),
fact AS (
  SELECT md5(CLAVE_CONTRATO) AS CONTRATO_HASH, llaves.*,
    org.CLAVE_UBICACION AS CLAVE_UBICACION_ENTIDAD,
    {_dk("FECHA_FIRMA")} AS FECHA_FIRMA_KEY, {_dk("FECHA_INICIO")} AS FECHA_INICIO_KEY,
    {_dk("FECHA_FIN")} AS FECHA_FIN_KEY,
    md5(concat_ws('|', coalesce(CLAVE_CONTRATO, ''), coalesce(CLAVE_ENTIDAD, ''),
      coalesce(CAST(CAST(MONTO_CONTRATO AS DECIMAL(28,4)) AS VARCHAR), ''), coalesce(MONEDA_CONTRATO, ''),
      {_ts("FECHA_FIRMA")}, {_ts("FECHA_INICIO")}, {_ts("FECHA_FIN")},
      coalesce(DESCRIPCION_CONTRATO, ''))) AS HASH_FILA
  FROM llaves LEFT JOIN dim_organizacion org ON llaves.CLAVE_ENTIDAD = org.CLAVE_ORGANIZACION)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CURATED_BASE = [STG_CONTRATOS, STG_REGISTROS, STG_PROVEEDORES, STG_PARTES]
ORG = [ORG_CANDIDATO, DIM_ORGANIZACION]
FACT_CTES = CURATED_BASE + [CONTRATO_ACTUAL,
                            registro_actual("registro_actual_clave", ["OCID", "ID_ENTREGA"]),
                            registro_actual("registro_actual_ocid", ["OCID"])] + ORG + [FACT]
BRIDGE = """bridge AS (
  SELECT DISTINCT c.CLAVE_CONTRATO, p.CLAVE_PROVEEDOR, p.ID_PROVEEDOR, p.RUC_PROVEEDOR,
    p.NOMBRE_PROVEEDOR_ORIGINAL, p.NOMBRE_PROVEEDOR_ESTANDAR
  FROM contrato_actual c JOIN proveedor_actual p
    ON c.OCID = p.OCID AND c.ID_ADJUDICACION = p.ID_ADJUDICACION
  WHERE p.CLAVE_PROVEEDOR IS NOT NULL)"""

REC_OUT = ("OCID, ID_ENTREGA, ID_LICITACION, METODO_CONTRATACION, CATEGORIA_PRINCIPAL, "
           "ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN")

ORACLES: dict[str, str] = {
    "latest_contract_version": with_(STG_CONTRATOS, CONTRATO_ACTUAL)
    + "SELECT * FROM contrato_actual",

    "latest_record_by_completeness": with_(
        STG_REGISTROS, registro_actual("rk", ["OCID", "ID_ENTREGA"]), registro_actual("ro", ["OCID"]))
    + f"SELECT 'CLAVE' AS NIVEL, {REC_OUT} FROM rk UNION ALL SELECT 'OCID' AS NIVEL, {REC_OUT} FROM ro",

    "duplicate_key_flag": with_(STG_CONTRATOS) + """
  SELECT ANIO_ARCHIVO, count(*) AS FILAS, count(*) FILTER (WHERE n > 1) AS FILAS_CLAVE_DUPLICADA,
    count(DISTINCT CLAVE_CONTRATO) AS CLAVES, count(*) - count(DISTINCT CLAVE_CONTRATO) AS FILAS_EXTRA
  FROM (SELECT ANIO_ARCHIVO, CLAVE_CONTRATO, count(*) OVER (PARTITION BY CLAVE_CONTRATO) AS n
        FROM stg_contratos) GROUP BY ANIO_ARCHIVO""",

    "keep_last_per_key": """
  SELECT user_id, ts, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
    event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST) = 1""",

    "org_master": with_(*CURATED_BASE[1:], *ORG) + "SELECT * FROM dim_organizacion",

    "location_dim": with_(*CURATED_BASE[1:], *ORG) + """
  SELECT DISTINCT CLAVE_UBICACION, PAIS, DEPARTAMENTO, REGION, LOCALIDAD
  FROM dim_organizacion WHERE CLAVE_UBICACION IS NOT NULL""",

    "fact_with_fallback": with_(*FACT_CTES) + """
  SELECT CLAVE_CONTRATO, TIPO_RELACION_REGISTRO, CLAVE_ENTIDAD, RUC_ENTIDAD, ID_ENTIDAD,
    NOMBRE_ENTIDAD_ORIGINAL, NOMBRE_ENTIDAD_ESTANDAR, ID_LICITACION, METODO_CONTRATACION,
    CATEGORIA_PRINCIPAL, CLAVE_UBICACION_ENTIDAD FROM fact""",

    "fact_keys_and_hash": with_(*FACT_CTES) + """
  SELECT CLAVE_CONTRATO, CONTRATO_HASH, CLAVE_MONEDA, CLAVE_CATEGORIA, CLAVE_METODO,
    FECHA_FIRMA_KEY, FECHA_INICIO_KEY, FECHA_FIN_KEY, HASH_FILA FROM fact""",

    "contract_supplier_bridge": with_(STG_CONTRATOS, STG_PROVEEDORES, CONTRATO_ACTUAL,
                                      PROVEEDOR_ACTUAL, BRIDGE) + "SELECT * FROM bridge",

    "role_dims": with_(*FACT_CTES, PROVEEDOR_ACTUAL, BRIDGE) + """
  SELECT 'ENTIDAD' AS ROL, CLAVE_ORGANIZACION, TIPO_ORGANIZACION, NOMBRE_ESTANDAR, CLAVE_UBICACION
  FROM dim_organizacion WHERE CLAVE_ORGANIZACION IN (SELECT CLAVE_ENTIDAD FROM fact WHERE CLAVE_ENTIDAD IS NOT NULL)
  UNION ALL
  SELECT 'PROVEEDOR' AS ROL, CLAVE_ORGANIZACION, TIPO_ORGANIZACION, NOMBRE_ESTANDAR, CLAVE_UBICACION
  FROM dim_organizacion WHERE CLAVE_ORGANIZACION IN (SELECT CLAVE_PROVEEDOR FROM bridge WHERE CLAVE_PROVEEDOR IS NOT NULL)""",

    "currency_dim": with_(*FACT_CTES) + """
  SELECT DISTINCT CLAVE_MONEDA, MONEDA_CONTRATO AS CODIGO_MONEDA, NOMBRE_MONEDA_CONTRATO AS NOMBRE_MONEDA
  FROM fact""",

    "currency_dim_one_per_key": with_(*FACT_CTES) + """
  SELECT CLAVE_MONEDA, CODIGO_MONEDA, NOMBRE_MONEDA FROM (
    SELECT CLAVE_MONEDA, MONEDA_CONTRATO AS CODIGO_MONEDA, NOMBRE_MONEDA_CONTRATO AS NOMBRE_MONEDA
    FROM fact) QUALIFY row_number() OVER (PARTITION BY CLAVE_MONEDA
      ORDER BY CODIGO_MONEDA ASC NULLS LAST, NOMBRE_MONEDA ASC NULLS LAST) = 1""",

    "category_dim": with_(*FACT_CTES) + """
  SELECT DISTINCT CLAVE_CATEGORIA, CATEGORIA_PRINCIPAL FROM fact WHERE CLAVE_CATEGORIA IS NOT NULL""",

    "method_dim": with_(*FACT_CTES) + """
  SELECT CLAVE_METODO, METODO_CONTRATACION, DETALLE_METODO_CONTRATACION FROM fact
  WHERE CLAVE_METODO IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY CLAVE_METODO ORDER BY METODO_CONTRATACION ASC NULLS LAST,
    DETALLE_METODO_CONTRATACION ASC NULLS LAST) = 1""",

    "date_dim": with_(*FACT_CTES, """bounds AS (
    SELECT coalesce(min(d), DATE '2022-01-01') AS lo, coalesce(max(d), DATE '2030-12-31') AS hi
    FROM (SELECT CAST(FECHA_FIRMA AS DATE) AS d FROM fact UNION ALL
          SELECT CAST(FECHA_INICIO AS DATE) FROM fact UNION ALL
          SELECT CAST(FECHA_FIN AS DATE) FROM fact)
    WHERE d BETWEEN DATE '2000-01-01' AND DATE '2100-12-31')""",
        "days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS FECHA FROM bounds)") + """
  SELECT FECHA, CAST(strftime(FECHA, '%Y%m%d') AS INTEGER) AS FECHA_KEY,
    CAST(year(FECHA) AS INTEGER) AS ANIO, CAST((month(FECHA) - 1) // 6 + 1 AS INTEGER) AS SEMESTRE,
    CAST(quarter(FECHA) AS INTEGER) AS TRIMESTRE, CAST(month(FECHA) AS INTEGER) AS MES_NUMERO,
    ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',
     'Noviembre','Diciembre'][month(FECHA)] AS MES_NOMBRE,
    strftime(FECHA, '%Y-%m') AS ANIO_MES, CAST(day(FECHA) AS INTEGER) AS DIA,
    CAST(isodow(FECHA) AS INTEGER) AS DIA_SEMANA_NUMERO,
    ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(FECHA)] AS DIA_SEMANA_NOMBRE,
    isodow(FECHA) >= 6 AS ES_FIN_SEMANA
  FROM days""",

    "extra_copies": with_(STG_CONTRATOS) + """
  SELECT count(*) - count(DISTINCT CLAVE_CONTRATO) AS FILAS_DUPLICADAS FROM stg_contratos""",
}


# ------------------------------------------------------------------ reports

STAR_CTES = FACT_CTES + [PROVEEDOR_ACTUAL, BRIDGE, """dim_entidad AS (
  SELECT * FROM dim_organizacion WHERE CLAVE_ORGANIZACION IN
    (SELECT CLAVE_ENTIDAD FROM fact WHERE CLAVE_ENTIDAD IS NOT NULL))""", """dim_proveedor AS (
  SELECT * FROM dim_organizacion WHERE CLAVE_ORGANIZACION IN
    (SELECT CLAVE_PROVEEDOR FROM bridge WHERE CLAVE_PROVEEDOR IS NOT NULL))""", """dim_ubicacion AS (
  SELECT DISTINCT CLAVE_UBICACION, PAIS, DEPARTAMENTO, REGION, LOCALIDAD
  FROM dim_organizacion WHERE CLAVE_UBICACION IS NOT NULL)"""]


def _ind(i, name, sql):
    return f"SELECT {i} AS o, '{name}' AS INDICADOR, CAST(({sql}) AS BIGINT) AS VALOR"


ORACLES.update({
    "annual_summary": with_(*FACT_CTES) + """
  SELECT CAST(coalesce(year(FECHA_FIRMA), ANIO_ARCHIVO) AS INTEGER) AS ANIO, count(*) AS CONTRATOS,
    CAST(sum(CAST(coalesce(MONTO_CONTRATO, 0.0) AS DECIMAL(24,4))) AS DOUBLE) AS MONTO_TOTAL
  FROM fact GROUP BY 1""",

    "monthly_summary": with_(STG_CONTRATOS) + """
  SELECT ANIO_ARCHIVO, MES_ARCHIVO, count(*) AS FILAS, count(DISTINCT CLAVE_CONTRATO) AS CLAVES_UNICAS,
    count(FECHA_FIRMA) AS CON_FECHA_FIRMA, count(DESCRIPCION_CONTRATO) AS CON_DESCRIPCION_CONTRATO,
    count(MONEDA_CONTRATO) AS CON_MONEDA_CONTRATO
  FROM stg_contratos GROUP BY ANIO_ARCHIVO, MES_ARCHIVO""",

    "geo_counts": with_(*STAR_CTES) + """
  SELECT DEPARTAMENTO, REGION, LOCALIDAD, count(*) AS CANTIDAD, 'ENTIDAD' AS ROL
  FROM dim_entidad WHERE CLAVE_UBICACION IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT DEPARTAMENTO, REGION, LOCALIDAD, count(*) AS CANTIDAD, 'PROVEEDOR' AS ROL
  FROM dim_proveedor WHERE CLAVE_UBICACION IS NOT NULL GROUP BY ALL""",

    "supplier_list_per_contract": with_(STG_CONTRATOS, STG_PROVEEDORES, CONTRATO_ACTUAL,
                                        PROVEEDOR_ACTUAL, BRIDGE) + """
  SELECT c.CLAVE_CONTRATO, coalesce(p.lst, '') AS PROVEEDORES,
    CAST(coalesce(p.n, 0) AS BIGINT) AS CANTIDAD_PROVEEDORES
  FROM contrato_actual c LEFT JOIN (
    SELECT CLAVE_CONTRATO,
      string_agg(DISTINCT nullif(trim(NOMBRE_PROVEEDOR_ORIGINAL), ''), ' | '
                 ORDER BY nullif(trim(NOMBRE_PROVEEDOR_ORIGINAL), '')) AS lst,
      count(DISTINCT ID_PROVEEDOR) AS n
    FROM bridge GROUP BY CLAVE_CONTRATO) p ON c.CLAVE_CONTRATO = p.CLAVE_CONTRATO""",

    "indicators": with_(*STAR_CTES) + "SELECT INDICADOR, VALOR FROM (" + " UNION ALL ".join([
        _ind(0, "Filas staging contratos", "SELECT count(*) FROM stg_contratos"),
        _ind(1, "Contratos actuales", "SELECT count(*) FROM fact"),
        _ind(2, "Claves de contrato únicas", "SELECT count(DISTINCT CLAVE_CONTRATO) FROM fact"),
        _ind(3, "Contratos sin entidad", "SELECT count(*) FROM fact WHERE CLAVE_ENTIDAD IS NULL"),
        _ind(4, "Contratos con respaldo por OCID",
             "SELECT count(*) FROM fact WHERE TIPO_RELACION_REGISTRO = 'RESPALDO_OCID'"),
        _ind(5, "Contratos sin registro relacionado",
             "SELECT count(*) FROM fact WHERE TIPO_RELACION_REGISTRO = 'SIN_REGISTRO'"),
        _ind(6, "Relaciones contrato-proveedor", "SELECT count(*) FROM bridge"),
        _ind(7, "Contratos con proveedor", "SELECT count(DISTINCT CLAVE_CONTRATO) FROM bridge"),
        _ind(8, "Organizaciones únicas", "SELECT count(*) FROM dim_organizacion"),
        _ind(9, "Entidades únicas", "SELECT count(*) FROM dim_entidad"),
        _ind(10, "Proveedores únicos", "SELECT count(*) FROM dim_proveedor"),
        _ind(11, "Organizaciones con ubicación",
             "SELECT count(*) FROM dim_organizacion WHERE CLAVE_UBICACION IS NOT NULL"),
        _ind(12, "Entidades con ubicación",
             "SELECT count(*) FROM dim_entidad WHERE CLAVE_UBICACION IS NOT NULL"),
        _ind(13, "Proveedores con ubicación",
             "SELECT count(*) FROM dim_proveedor WHERE CLAVE_UBICACION IS NOT NULL"),
        _ind(14, "Ubicaciones únicas", "SELECT count(*) FROM dim_ubicacion"),
        _ind(15, "Monedas", "SELECT count(*) FROM (SELECT DISTINCT CLAVE_MONEDA, MONEDA_CONTRATO, "
                            "NOMBRE_MONEDA_CONTRATO FROM fact)"),
        _ind(16, "Categorías", "SELECT count(*) FROM (SELECT DISTINCT CLAVE_CATEGORIA, "
                               "CATEGORIA_PRINCIPAL FROM fact WHERE CLAVE_CATEGORIA IS NOT NULL)"),
        _ind(17, "Métodos de contratación",
             "SELECT count(*) FROM (SELECT DISTINCT CLAVE_METODO, METODO_CONTRATACION, "
             "DETALLE_METODO_CONTRATACION FROM fact WHERE CLAVE_METODO IS NOT NULL)"),
    ]) + ")",

    "coverage_profile": with_(STG_PARTES) + """
  SELECT ANIO_ARCHIVO, MES_ARCHIVO, count(*) AS FILAS,
    count(*) FILTER (WHERE RUC_ORGANIZACION IS NOT NULL) AS CON_RUC,
    count(*) FILTER (WHERE RUC_VALIDO = true) AS RUC_VALIDOS,
    count(*) FILTER (WHERE DEPARTAMENTO_ESTANDAR IS NOT NULL) AS CON_DEPARTAMENTO,
    count(*) FILTER (WHERE REGION_ESTANDAR IS NOT NULL) AS CON_REGION,
    count(*) FILTER (WHERE LOCALIDAD_ESTANDAR IS NOT NULL) AS CON_LOCALIDAD,
    count(*) FILTER (WHERE DIRECCION_ESTANDAR IS NOT NULL) AS CON_DIRECCION,
    count(*) FILTER (WHERE ES_COMPRADOR_O_ENTIDAD) AS COMPRADORES_O_ENTIDADES,
    count(*) FILTER (WHERE ES_PROVEEDOR) AS PROVEEDORES
  FROM stg_partes GROUP BY ANIO_ARCHIVO, MES_ARCHIVO""",

    "geo_ranking": with_(*STAR_CTES) + """
  SELECT ROL, DEPARTAMENTO, CANTIDAD,
    row_number() OVER (PARTITION BY ROL ORDER BY CANTIDAD DESC, DEPARTAMENTO NULLS FIRST) AS RANGO FROM (
    SELECT 'ENTIDAD' AS ROL, DEPARTAMENTO, count(*) AS CANTIDAD FROM dim_entidad WHERE CLAVE_UBICACION IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT 'PROVEEDOR' AS ROL, DEPARTAMENTO, count(*) AS CANTIDAD FROM dim_proveedor WHERE CLAVE_UBICACION IS NOT NULL GROUP BY ALL)""",

    "role_frequency": with_(STG_PARTES) + """
  SELECT ROLES_ESTANDAR, count(*) AS FRECUENCIA FROM stg_partes GROUP BY ROLES_ESTANDAR""",

    "orphans_and_anti": with_(*STAR_CTES) + """
  SELECT 'lineitem->orders' AS RELACION, count(*) AS HUERFANOS FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
  UNION ALL SELECT 'orders->customer', count(*) FROM orders
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
  UNION ALL SELECT 'lineitem->supplier', count(*) FROM lineitem
    WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)
  UNION ALL SELECT 'fact->dim_entidad', count(*) FROM fact
    WHERE CLAVE_ENTIDAD IS NOT NULL AND CLAVE_ENTIDAD NOT IN (SELECT CLAVE_ORGANIZACION FROM dim_organizacion)
  UNION ALL SELECT 'bridge->fact', count(*) FROM bridge
    WHERE CLAVE_CONTRATO IS NOT NULL AND CLAVE_CONTRATO NOT IN (SELECT CLAVE_CONTRATO FROM fact)
  UNION ALL SELECT 'organizacion->ubicacion', count(*) FROM dim_organizacion
    WHERE CLAVE_UBICACION IS NOT NULL AND CLAVE_UBICACION NOT IN (SELECT CLAVE_UBICACION FROM dim_ubicacion)
  UNION ALL SELECT 'orders sin lineitem', count(*) FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
  UNION ALL SELECT 'customer sin orders', count(*) FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
  UNION ALL SELECT 'contratos sin proveedor', count(*) FROM fact f
    WHERE NOT EXISTS (SELECT 1 FROM bridge b WHERE b.CLAVE_CONTRATO = f.CLAVE_CONTRATO)""",

    "review_samples": with_(*STAR_CTES) + """
  (SELECT 'SIN_ENTIDAD' AS MUESTRA, CLAVE_CONTRATO, OCID, ID_CONTRATO, MONTO_CONTRATO, TIPO_RELACION_REGISTRO
   FROM fact WHERE CLAVE_ENTIDAD IS NULL ORDER BY CLAVE_CONTRATO LIMIT 1000)
  UNION ALL
  (SELECT 'SIN_PROVEEDOR' AS MUESTRA, CLAVE_CONTRATO, OCID, ID_CONTRATO, MONTO_CONTRATO, TIPO_RELACION_REGISTRO
   FROM fact f WHERE NOT EXISTS (SELECT 1 FROM bridge b WHERE b.CLAVE_CONTRATO = f.CLAVE_CONTRATO)
   ORDER BY CLAVE_CONTRATO LIMIT 1000)""",
})


# ---------------------------------------------------------------- warehouse

DAYS = """bounds AS (
    SELECT coalesce(min(d), DATE '2022-01-01') AS lo, coalesce(max(d), DATE '2030-12-31') AS hi
    FROM (SELECT CAST(FECHA_FIRMA AS DATE) AS d FROM fact UNION ALL
          SELECT CAST(FECHA_INICIO AS DATE) FROM fact UNION ALL
          SELECT CAST(FECHA_FIN AS DATE) FROM fact)
    WHERE d BETWEEN DATE '2000-01-01' AND DATE '2100-12-31'),
  days AS (SELECT CAST(strftime(CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE), '%Y%m%d') AS INTEGER)
           AS FECHA_KEY FROM bounds)"""

DW_DIMS = """DimUbicacion AS (SELECT CLAVE_UBICACION, row_number() OVER (ORDER BY CLAVE_UBICACION) AS UbicacionKey
                 FROM dim_ubicacion),
  DimEntidad AS (SELECT CLAVE_ORGANIZACION, row_number() OVER (ORDER BY CLAVE_ORGANIZACION) AS EntidadKey
                 FROM dim_entidad),
  DimProveedor AS (SELECT CLAVE_ORGANIZACION, row_number() OVER (ORDER BY CLAVE_ORGANIZACION) AS ProveedorKey
                 FROM dim_proveedor),
  DimMoneda AS (SELECT CLAVE_MONEDA, row_number() OVER (ORDER BY CLAVE_MONEDA) AS MonedaKey
                FROM (SELECT DISTINCT CLAVE_MONEDA FROM fact)),
  DimCategoria AS (SELECT CLAVE_CATEGORIA, row_number() OVER (ORDER BY CLAVE_CATEGORIA) AS CategoriaKey
                FROM (SELECT DISTINCT CLAVE_CATEGORIA FROM fact WHERE CLAVE_CATEGORIA IS NOT NULL)),
  DimMetodo AS (SELECT CLAVE_METODO, row_number() OVER (ORDER BY CLAVE_METODO) AS MetodoKey
                FROM (SELECT DISTINCT CLAVE_METODO FROM fact WHERE CLAVE_METODO IS NOT NULL)),
  fact_dw AS (
    SELECT row_number() OVER (ORDER BY f.CLAVE_CONTRATO) AS ContratoKey, f.CLAVE_CONTRATO AS ClaveContrato,
      e.EntidadKey, u.UbicacionKey AS UbicacionEntidadKey, CAST(m.MonedaKey AS INTEGER) AS MonedaKey,
      CAST(c.CategoriaKey AS INTEGER) AS CategoriaKey, CAST(mt.MetodoKey AS INTEGER) AS MetodoKey,
      d1.FECHA_KEY AS FechaFirmaKey, d2.FECHA_KEY AS FechaInicioKey, d3.FECHA_KEY AS FechaFinKey,
      TRY_CAST(f.MONTO_CONTRATO AS DECIMAL(28,4)) AS MontoContrato
    FROM fact f
      LEFT JOIN DimEntidad e ON f.CLAVE_ENTIDAD = e.CLAVE_ORGANIZACION
      LEFT JOIN DimUbicacion u ON f.CLAVE_UBICACION_ENTIDAD = u.CLAVE_UBICACION
      LEFT JOIN DimMoneda m ON f.CLAVE_MONEDA = m.CLAVE_MONEDA
      LEFT JOIN DimCategoria c ON f.CLAVE_CATEGORIA = c.CLAVE_CATEGORIA
      LEFT JOIN DimMetodo mt ON f.CLAVE_METODO = mt.CLAVE_METODO
      LEFT JOIN days d1 ON f.FECHA_FIRMA_KEY = d1.FECHA_KEY
      LEFT JOIN days d2 ON f.FECHA_INICIO_KEY = d2.FECHA_KEY
      LEFT JOIN days d3 ON f.FECHA_FIN_KEY = d3.FECHA_KEY
    WHERE f.CLAVE_CONTRATO IS NOT NULL)"""

# warehouse fact: column, curated column, type or length
_FACT_DW = [
    *[f"substr(f.{c}, 1, {n}) AS {a}" for a, c, n in [
        ("ContratoHash", "CONTRATO_HASH", 32), ("HashFila", "HASH_FILA", 32), ("Ocid", "OCID", 200),
        ("IdEntrega", "ID_ENTREGA", 300), ("IdContrato", "ID_CONTRATO", 300), ("IdAdjudicacion", "ID_ADJUDICACION", 300),
        ("IdLicitacion", "ID_LICITACION", 300), ("TituloContrato", "TITULO_CONTRATO", 2000),
        ("DescripcionContrato", "DESCRIPCION_CONTRATO", 100000), ("MonedaContrato", "MONEDA_CONTRATO", 50),
        ("NombreMonedaContrato", "NOMBRE_MONEDA_CONTRATO", 200), ("MonedaFinal", "MONEDA_FINAL", 50),
        ("NombreMonedaFinal", "NOMBRE_MONEDA_FINAL", 200), ("RucEntidad", "RUC_ENTIDAD", 20), ("IdEntidad", "ID_ENTIDAD", 300),
        ("NombreEntidadOriginal", "NOMBRE_ENTIDAD_ORIGINAL", 1000), ("NombreEntidadEstandar", "NOMBRE_ENTIDAD_ESTANDAR", 1000),
        ("TituloLicitacion", "TITULO_LICITACION", 2000), ("DescripcionLicitacion", "DESCRIPCION_LICITACION", 100000),
        ("MetodoContratacion", "METODO_CONTRATACION", 500), ("DetalleMetodoContratacion", "DETALLE_METODO_CONTRATACION", 1000),
        ("CategoriaPrincipal", "CATEGORIA_PRINCIPAL", 500), ("MonedaLicitacion", "MONEDA_LICITACION", 50),
        ("NombreMonedaLicitacion", "NOMBRE_MONEDA_LICITACION", 200), ("TipoRelacionRegistro", "TIPO_RELACION_REGISTRO", 50),
        ("ArchivoOrigen", "ARCHIVO_ORIGEN", 500)]],
    *[f"CAST(TRY_CAST(f.{c} AS DECIMAL({t})) AS VARCHAR) AS {a}" for a, c, t in [
        ("DuracionDias", "DURACION_DIAS", "18,2"), ("MontoContrato", "MONTO_CONTRATO", "28,4"),
        ("MontoFinal", "MONTO_FINAL", "28,4"), ("MontoLicitacion", "MONTO_LICITACION", "28,4")]],
    *[f"f.{c} AS {a}" for a, c in [
        ("FechaFirma", "FECHA_FIRMA"), ("FechaInicio", "FECHA_INICIO"), ("FechaFin", "FECHA_FIN"),
        ("FechaFinImplementacion", "FECHA_FIN_IMPLEMENTACION"), ("AnioArchivo", "ANIO_ARCHIVO"), ("MesArchivo", "MES_ARCHIVO")]]]


def _dim_org_dw(dim: str, keyed: str, key: str) -> str:
    return f"""
  SELECT d.CLAVE_ORGANIZACION, d.ORGANIZACION_HASH, d.ID_ORGANIZACION_ORIGINAL, d.RUC, d.NOMBRE_ORIGINAL, d.NOMBRE_ESTANDAR,
    d.TIPO_ORGANIZACION, d.DIRECCION, d.LOCALIDAD, d.REGION, d.DEPARTAMENTO, d.PAIS, TRY_CAST(d.RUC_VALIDO AS BOOLEAN) AS RUC_VALIDO,
    TRY_CAST(d.ES_ENTIDAD AS BOOLEAN) AS ES_ENTIDAD, TRY_CAST(d.ES_PROVEEDOR AS BOOLEAN) AS ES_PROVEEDOR,
    d.PERIODO_PRIMERA_APARICION, d.PERIODO_ULTIMA_APARICION, d.CLAVE_UBICACION, k.{key}, u.UbicacionKey
  FROM {dim} d JOIN {keyed} k ON d.CLAVE_ORGANIZACION = k.CLAVE_ORGANIZACION
    LEFT JOIN DimUbicacion u ON d.CLAVE_UBICACION = u.CLAVE_UBICACION"""


WH_CTES = STAR_CTES + [DAYS, DW_DIMS]

ORACLES.update({
    "dim_entidad_dw": with_(*WH_CTES) + _dim_org_dw("dim_entidad", "DimEntidad", "EntidadKey"),
    "dim_proveedor_dw": with_(*WH_CTES) + _dim_org_dw("dim_proveedor", "DimProveedor", "ProveedorKey"),

    "fact_dw_full": with_(*WH_CTES) + f"""
  SELECT d.ContratoKey, d.ClaveContrato, d.EntidadKey, d.UbicacionEntidadKey, d.MonedaKey, d.CategoriaKey, d.MetodoKey,
    d.FechaFirmaKey, d.FechaInicioKey, d.FechaFinKey, {", ".join(_FACT_DW)}
  FROM fact_dw d JOIN fact f ON d.ClaveContrato = f.CLAVE_CONTRATO""",

    "orphans_dw": with_(*WH_CTES) + """
  SELECT RELACION, CAST(n AS BIGINT) AS HUERFANOS FROM (
    SELECT 'FACT_ENTIDAD' AS RELACION, count(*) FILTER (WHERE EntidadKey NOT IN (SELECT EntidadKey FROM DimEntidad)) AS n FROM fact_dw
    UNION ALL SELECT 'FACT_MONEDA', count(*) FILTER (WHERE MonedaKey NOT IN (SELECT MonedaKey FROM DimMoneda)) FROM fact_dw
    UNION ALL SELECT 'FACT_CATEGORIA', count(*) FILTER (WHERE CategoriaKey NOT IN (SELECT CategoriaKey FROM DimCategoria)) FROM fact_dw
    UNION ALL SELECT 'FACT_METODO', count(*) FILTER (WHERE MetodoKey NOT IN (SELECT MetodoKey FROM DimMetodo)) FROM fact_dw
    UNION ALL SELECT 'BRIDGE_CONTRATO', count(*) FILTER (WHERE CLAVE_CONTRATO NOT IN (SELECT ClaveContrato FROM fact_dw)) FROM bridge
    UNION ALL SELECT 'BRIDGE_PROVEEDOR', count(*) FILTER (WHERE CLAVE_PROVEEDOR NOT IN (SELECT CLAVE_ORGANIZACION FROM DimProveedor)) FROM bridge)""",

    "warehouse_indicators": with_(*WH_CTES) + """
  , bridge_rows AS (SELECT DISTINCT f.ContratoKey, p.ProveedorKey, b.* FROM bridge b
      JOIN fact_dw f ON b.CLAVE_CONTRATO = f.ClaveContrato JOIN DimProveedor p ON b.CLAVE_PROVEEDOR = p.CLAVE_ORGANIZACION)
  SELECT GRUPO, INDICADOR, CAST(VALOR AS BIGINT) AS VALOR FROM (
    SELECT 'INDICADOR' AS GRUPO, 'Contratos curated' AS INDICADOR, count(*) AS VALOR FROM fact
    UNION ALL SELECT 'INDICADOR', 'Contratos DW', count(*) FROM fact_dw
    UNION ALL SELECT 'INDICADOR', 'Contratos duplicados por clave', count(*) FROM (SELECT ClaveContrato FROM fact_dw GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'INDICADOR', 'Relaciones proveedor curated', count(*) FROM bridge
    UNION ALL SELECT 'INDICADOR', 'Relaciones proveedor DW', count(*) FROM bridge_rows
    UNION ALL SELECT 'INDICADOR', 'Entidades', count(*) FROM DimEntidad
    UNION ALL SELECT 'INDICADOR', 'Proveedores', count(*) FROM DimProveedor
    UNION ALL SELECT 'INDICADOR', 'Ubicaciones', count(*) FROM DimUbicacion
    UNION ALL SELECT 'INDICADOR', 'Monedas', count(*) FROM DimMoneda
    UNION ALL SELECT 'INDICADOR', 'Categorías', count(*) FROM DimCategoria
    UNION ALL SELECT 'INDICADOR', 'Métodos de contratación', count(*) FROM DimMetodo
    UNION ALL SELECT 'INDICADOR', 'Fechas', count(*) FROM days
    UNION ALL SELECT 'INDICADOR', 'Contratos sin entidad', count(*) FROM fact_dw WHERE EntidadKey IS NULL
    UNION ALL SELECT 'INDICADOR', 'Contratos sin proveedor', count(*) FROM fact_dw WHERE ContratoKey NOT IN (SELECT ContratoKey FROM bridge_rows)
    UNION ALL SELECT 'INDICADOR', 'Entidades sin ubicación', count(*) FROM dim_entidad WHERE CLAVE_UBICACION IS NULL
    UNION ALL SELECT 'INDICADOR', 'Proveedores sin ubicación', count(*) FROM dim_proveedor WHERE CLAVE_UBICACION IS NULL
    UNION ALL SELECT 'TABLA', 'FactContrato', count(*) FROM fact_dw
    UNION ALL SELECT 'TABLA', 'BridgeContratoProveedor', count(*) FROM bridge_rows
    UNION ALL SELECT 'TABLA', 'DimEntidad', count(*) FROM DimEntidad
    UNION ALL SELECT 'TABLA', 'DimProveedor', count(*) FROM DimProveedor
    UNION ALL SELECT 'TABLA', 'DimUbicacion', count(*) FROM DimUbicacion
    UNION ALL SELECT 'TABLA', 'DimMoneda', count(*) FROM DimMoneda
    UNION ALL SELECT 'TABLA', 'DimCategoria', count(*) FROM DimCategoria
    UNION ALL SELECT 'TABLA', 'DimMetodoContratacion', count(*) FROM DimMetodo
    UNION ALL SELECT 'TABLA', 'DimFecha', count(*) FROM days)""",

    "star_lookup": with_(*WH_CTES) + """
  SELECT ContratoKey, ClaveContrato, EntidadKey, UbicacionEntidadKey, MonedaKey, CategoriaKey, MetodoKey,
    FechaFirmaKey, FechaInicioKey, FechaFinKey FROM fact_dw""",

    "bridge_keys": with_(*WH_CTES) + """
  SELECT ContratoKey, ProveedorKey, IdProveedorOriginal, NombreProveedorOriginal FROM (
    SELECT DISTINCT f.ContratoKey, p.ProveedorKey, substr(b.ID_PROVEEDOR, 1, 300) AS IdProveedorOriginal,
      substr(b.RUC_PROVEEDOR, 1, 20) AS RucProveedor,
      substr(b.NOMBRE_PROVEEDOR_ORIGINAL, 1, 1000) AS NombreProveedorOriginal,
      substr(b.NOMBRE_PROVEEDOR_ESTANDAR, 1, 1000) AS NombreProveedorEstandar
    FROM bridge b JOIN fact_dw f ON b.CLAVE_CONTRATO = f.ClaveContrato
      JOIN DimProveedor p ON b.CLAVE_PROVEEDOR = p.CLAVE_ORGANIZACION)""",

    "typed_warehouse_row": with_(*FACT_CTES) + """
  SELECT CLAVE_CONTRATO, TRY_CAST(OCID AS BIGINT) AS OCID_NUM, TRY_CAST(ID_CONTRATO AS INTEGER) AS ID_CONTRATO_NUM,
    TRY_CAST(TITULO_CONTRATO AS INTEGER) AS TITULO_COMO_NUMERO, substr(TITULO_CONTRATO, 1, 8) AS TITULO_CORTO,
    substr(NOMBRE_ENTIDAD_ESTANDAR, 1, 10) AS ENTIDAD_CORTA,
    CAST(TRY_CAST(MONTO_CONTRATO AS DECIMAL(28,4)) AS VARCHAR) AS MONTO_TEXTO,
    CAST(TRY_CAST(DURACION_DIAS AS DECIMAL(18,2)) AS VARCHAR) AS DURACION_TEXTO,
    TRY_CAST(FECHA_FIRMA AS DATE) AS FECHA_FIRMA_DIA,
    TRY_CAST(ANIO_ARCHIVO AS TINYINT) AS ANIO_TINYINT, TRY_CAST(MES_ARCHIVO AS TINYINT) AS MES_TINYINT
  FROM fact""",

    "reconcile": with_(*WH_CTES) + """,
  j AS (
    SELECT f.CLAVE_CONTRATO IS NOT NULL AND d.ClaveContrato IS NOT NULL AS k,
      f.CLAVE_ENTIDAD IS NOT DISTINCT FROM e.CLAVE_ORGANIZACION AS ent,
      CAST(f.MONTO_CONTRATO AS DECIMAL(28,4)) IS NOT DISTINCT FROM d.MontoContrato AS monto,
      f.CLAVE_UBICACION_ENTIDAD IS NOT DISTINCT FROM u.CLAVE_UBICACION AS ub
    FROM fact f FULL OUTER JOIN fact_dw d ON f.CLAVE_CONTRATO = d.ClaveContrato
      LEFT JOIN DimEntidad e ON d.EntidadKey = e.EntidadKey
      LEFT JOIN DimUbicacion u ON d.UbicacionEntidadKey = u.UbicacionKey),
  c AS (SELECT 'CLAVE' AS VALIDACION, k AS CUMPLE FROM j UNION ALL SELECT 'ENTIDAD', ent FROM j
        UNION ALL SELECT 'MONTO', monto FROM j UNION ALL SELECT 'UBICACION', ub FROM j)
  SELECT VALIDACION, count(*) FILTER (WHERE CUMPLE) AS OK, count(*) FILTER (WHERE NOT CUMPLE) AS REVISAR,
    CASE WHEN count(*) FILTER (WHERE NOT CUMPLE) = 0 THEN 'OK' ELSE 'REVISAR' END AS ESTADO
  FROM c GROUP BY VALIDACION""",

    "quality_gate": with_(*WH_CTES) + """,
  checks AS (
    SELECT 'DQ-3 claves de contrato duplicadas' AS CONTROL,
      (SELECT count(*) FROM (SELECT CLAVE_CONTRATO FROM fact GROUP BY 1 HAVING count(*) > 1)) AS VALOR, true AS z
    UNION ALL SELECT 'DQ-4 claves de puente duplicadas',
      (SELECT count(*) FROM (SELECT CLAVE_CONTRATO, CLAVE_PROVEEDOR FROM bridge GROUP BY 1, 2 HAVING count(*) > 1)), true
    UNION ALL SELECT 'DQ-5 huerfanos fact->entidad',
      (SELECT count(*) FROM fact WHERE CLAVE_ENTIDAD IS NOT NULL AND CLAVE_ENTIDAD NOT IN (SELECT CLAVE_ORGANIZACION FROM dim_organizacion)), true
    UNION ALL SELECT 'DQ-5 huerfanos puente->fact',
      (SELECT count(*) FROM bridge WHERE CLAVE_CONTRATO NOT IN (SELECT CLAVE_CONTRATO FROM fact)), true
    UNION ALL SELECT 'DQ-6 monedas sin dimension',
      (SELECT count(*) FROM fact WHERE CLAVE_MONEDA NOT IN (SELECT CLAVE_MONEDA FROM fact)), true
    UNION ALL SELECT 'DQ-7 diferencia filas curated-dw', (SELECT count(*) FROM fact) - (SELECT count(*) FROM fact_dw), true
    UNION ALL SELECT 'DQ-13 contratos sin entidad', (SELECT count(*) FROM fact WHERE CLAVE_ENTIDAD IS NULL), false
    UNION ALL SELECT 'DQ-13 contratos sin proveedor',
      (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM bridge b WHERE b.CLAVE_CONTRATO = f.CLAVE_CONTRATO)), false
    UNION ALL SELECT 'DQ-14 filas staging sin OCID o contrato',
      (SELECT count(*) FROM stg_contratos WHERE OCID IS NULL OR ID_CONTRATO IS NULL), true),
  rows_ AS (SELECT CONTROL, CAST(VALOR AS BIGINT) AS VALOR, CASE WHEN z THEN VALOR = 0 ELSE true END AS CUMPLE FROM checks)
  SELECT * FROM rows_
  UNION ALL SELECT 'ESTADO GENERAL', CAST(NULL AS BIGINT), coalesce(bool_and(CUMPLE), true) FROM rows_""",
})


# ------------------------------------------------------------------ scalars

WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def clean_sql(x: str) -> str:
    t = f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"
    return f"CASE WHEN {t} IN ('', 'nan', 'None', '<NA>') THEN NULL ELSE {t} END"


def std_full(x: str, keep: str = "A-Z0-9Ñ& ") -> str:
    return std_name(f"regexp_replace({x}, '{WS}', ' ', 'g')", keep)


def ruc_extract_sql(x: str) -> str:
    t = f"trim({x})"
    run = f"regexp_extract({t}, '(?:^|[^0-9])([0-9]{{11}})(?:$|[^0-9])', 1)"
    dig = f"regexp_replace({t}, '[^0-9]', '', 'g')"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {run} <> '' THEN {run} "
            f"WHEN length({dig}) = 11 THEN {dig} ELSE NULL END)")


def norm_id_sql(x: str) -> str:
    return f"regexp_replace({clean_sql(x)}, '^([0-9]+)\\.0$', '\\1')"


_IDV = """(CASE l_linenumber WHEN 1 THEN CAST(l_orderkey AS VARCHAR) || '.0'
  WHEN 2 THEN ' ' || CAST(l_orderkey AS VARCHAR) || '.0' || chr(9)
  WHEN 3 THEN CAST(l_orderkey AS VARCHAR) || '.5' WHEN 4 THEN 'nan'
  WHEN 5 THEN '00' || CAST(l_orderkey AS VARCHAR) WHEN 6 THEN '  '
  ELSE CAST(l_orderkey AS VARCHAR) END)"""

_R = "('20' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'))"
_RUC_RAW = f"""(CASE c_custkey % 7 WHEN 0 THEN {_R} WHEN 1 THEN 'PE-RUC-' || {_R}
  WHEN 2 THEN substr({_R}, 1, 2) || '-' || substr({_R}, 3, 4) || '.' || substr({_R}, 7, 5)
  WHEN 3 THEN {_R} || '.0' WHEN 4 THEN '1' || {_R}
  WHEN 5 THEN 'RUC ' || {_R} || ' / ALT 10' || {_R} ELSE NULL END)"""
_FALLBACK = "('ORG-' || lpad(CAST(c_custkey AS VARCHAR), 11, '7'))"


def parse_number_sql(x: str) -> str:
    t = f"replace(replace(replace(replace({x}, chr(160), ''), ' ', ''), 'S/', ''), '$', '')"
    rc, rd = f"strpos(reverse({t}), ',')", f"strpos(reverse({t}), '.')"
    conv = (f"CASE WHEN {rc} > 0 AND {rd} > 0 AND {rc} < {rd} THEN replace(replace({t}, '.', ''), ',', '.') "
            f"WHEN {rc} > 0 AND {rd} > 0 THEN replace({t}, ',', '') "
            f"WHEN {rc} > 0 THEN replace({t}, ',', '.') ELSE {t} END")
    return f"TRY_CAST(regexp_replace({conv}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_IP = f"CAST({_CENTS} // 100 AS BIGINT)"
_FRAC = f"lpad(CAST({_CENTS} % 100 AS VARCHAR), 2, '0')"
_GRP = f"format('{{:,}}', {_IP})"
_AMT = f"""(CASE l_linenumber WHEN 1 THEN {_GRP} || '.' || {_FRAC}
  WHEN 2 THEN replace({_GRP}, ',', '.') || ',' || {_FRAC}
  WHEN 3 THEN 'S/ ' || CAST({_IP} AS VARCHAR) || '.' || {_FRAC}
  WHEN 4 THEN '$' || {_GRP} || ' ' WHEN 5 THEN CAST({_IP} AS VARCHAR) || ',' || {_FRAC}
  WHEN 6 THEN 'sin monto' ELSE '' END)"""

_DTXT = """(CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN 3 THEN strftime(o_orderdate, '%Y%m%d') WHEN 4 THEN 'sin fecha'
  WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-05:00'
  WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.250'
  ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' END)"""
_DPARSE = ("coalesce(" + ", ".join(f"try_strptime(trim({_DTXT}), '{f}')" for f in
           ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%d/%m/%Y %H:%M:%S",
            "%d/%m/%Y", "%Y%m%d"]) + f", CASE WHEN regexp_matches({_DTXT}, '[.]|Z$|[+-][0-9]{{2}}:[0-9]{{2}}$')"
           f" THEN try_cast(regexp_replace({_DTXT}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$', '') AS TIMESTAMP)"
           f" - to_hours(coalesce(TRY_CAST(regexp_extract({_DTXT}, 'T.*([+-][0-9]{{2}}):[0-9]{{2}}$', 1) AS INTEGER), 0)) END)")

ORACLES.update({
    "random_sample": """
  SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY md5('20260101|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 20""",

    "clean_text": f"""
  SELECT doc_id, {clean_sql('text')} AS TEXTO_LIMPIO,
    CASE WHEN regexp_replace(text, '\\A{WS}|{WS}\\z', '', 'g') IN ('', 'nan', 'None', '<NA>') THEN NULL
         ELSE regexp_replace(text, '\\A{WS}|{WS}\\z', '', 'g') END AS TEXTO_RECORTADO
  FROM documents""",

    "normalize_id": f"""
  SELECT l_orderkey, l_linenumber, {_IDV} AS ID_CRUDO, {norm_id_sql(_IDV)} AS ID_NORMALIZADO FROM lineitem""",

    "standard_name": f"""
  SELECT doc_id, {std_full('text')} AS NOMBRE_ESTANDAR, {std_full('text', 'A-Z0-9Ñ&/ -')} AS VALOR_CATALOGO
  FROM documents""",

    "ruc_extract_validate": f"""
  SELECT c_custkey, IDENTIFICADOR, RUC, {ruc_valid('RUC')} AS RUC_VALIDO,
    coalesce({ruc_extract_sql('IDENT')}, {ruc_extract_sql(_FALLBACK)}) AS RUC_CON_RESPALDO
  FROM (SELECT c_custkey, IDENTIFICADOR, IDENT, {ruc_extract_sql('IDENT')} AS RUC FROM (
    SELECT c_custkey, {_RUC_RAW} AS IDENTIFICADOR, {norm_id_sql(_RUC_RAW)} AS IDENT FROM customer))""",

    "parse_number": f"""
  SELECT l_orderkey, l_linenumber, {_AMT} AS MONTO_TEXTO, {parse_number_sql(_AMT)} AS MONTO,
    TRY_CAST(l_returnflag AS INTEGER) AS BANDERA_NUMERO FROM lineitem""",

    "parse_date": f"""
  SELECT o_orderkey, {_DTXT} AS FECHA_TEXTO, {_DPARSE} AS FECHA,
    CAST(strftime({_DPARSE}, '%Y%m%d') AS INTEGER) AS FECHA_KEY FROM orders""",
})


# -------------------------------------------------------------- incremental

def _snap(previous: bool) -> str:
    price = ("CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"
             if previous else "o_totalprice")
    key = "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END" if previous else "o_orderkey"
    return f"""SELECT o_orderkey, o_custkey, MONTO, o_orderstatus, o_orderdate,
      md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
        coalesce(CAST(CAST(MONTO AS DECIMAL(28,4)) AS VARCHAR), ''), coalesce(o_orderstatus, ''),
        coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), ''), '', '', '')) AS HASH_FILA
    FROM (SELECT * REPLACE ({key} AS o_orderkey), {price} AS MONTO FROM orders)"""


SNAPS = [f"old_snap AS ({_snap(True)})", f"new_snap AS ({_snap(False)})"]
CLASSIFY = """actions AS (
  SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
    CASE WHEN o.o_orderkey IS NULL THEN 'INSERTAR' WHEN n.o_orderkey IS NULL THEN 'AUSENTE'
         WHEN o.HASH_FILA IS NOT DISTINCT FROM n.HASH_FILA THEN 'SIN_CAMBIO' ELSE 'ACTUALIZAR' END AS ACCION
  FROM old_snap o FULL OUTER JOIN new_snap n ON o.o_orderkey = n.o_orderkey)"""
LINKS = """links AS (SELECT DISTINCT l_orderkey AS o_orderkey, l_suppkey FROM lineitem)"""
PRORATE = LINKS + """,
  per AS (SELECT o_orderkey, count(*) AS n, min(l_suppkey) AS first_ FROM links GROUP BY o_orderkey),
  base AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(28,4)) AS amt, per.n, per.first_,
             -- exact half-up rounding in integer units of 1/10000 (DuckDB divides decimals in double)
             CAST(CAST((CAST(CAST(o.o_totalprice AS DECIMAL(28,4)) * 10000 AS HUGEINT) * 2 + per.n) // (2 * per.n)
                  AS DECIMAL(38,0)) / 10000 AS DECIMAL(28,4)) AS share
           FROM orders o JOIN per ON o.o_orderkey = per.o_orderkey),
  prorated AS (
    SELECT l.o_orderkey, l.l_suppkey, 1.0 / b.n AS PESO,
      CASE WHEN l.l_suppkey = b.first_ THEN CAST(b.share + (b.amt - b.share * b.n) AS DECIMAL(28,4))
           ELSE b.share END AS MONTO_PRORRATEADO, b.amt AS MONTO_ORIGINAL
    FROM links l JOIN base b ON l.o_orderkey = b.o_orderkey)"""

ORACLES.update({
    "upsert": with_(*SNAPS, CLASSIFY) + "SELECT o_orderkey, ACCION FROM actions",

    "upsert_idempotence": with_(*SNAPS, """first_ AS (
    SELECT * FROM new_snap UNION ALL
    SELECT * FROM old_snap WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_snap))""", """a2 AS (
    SELECT CASE WHEN o.o_orderkey IS NULL THEN 'INSERTAR' WHEN n.o_orderkey IS NULL THEN 'AUSENTE'
         WHEN o.HASH_FILA IS NOT DISTINCT FROM n.HASH_FILA THEN 'SIN_CAMBIO' ELSE 'ACTUALIZAR' END AS ACCION
    FROM first_ o FULL OUTER JOIN new_snap n ON o.o_orderkey = n.o_orderkey)""") + """
  SELECT a.ACCION, CAST(coalesce(c.FILAS, 0) AS BIGINT) AS FILAS
  FROM (VALUES ('INSERTAR'), ('ACTUALIZAR'), ('SIN_CAMBIO'), ('AUSENTE')) a(ACCION)
  LEFT JOIN (SELECT ACCION, count(*) AS FILAS FROM a2 GROUP BY ACCION) c ON a.ACCION = c.ACCION""",

    "scd2_history": with_(*SNAPS, """open_ AS (
    SELECT *, DATE '1998-01-01' AS FECHA_DESDE, CAST(NULL AS DATE) AS FECHA_HASTA, 1 AS EJECUCION_ID FROM old_snap)""",
                          """closed AS (
    SELECT o_orderkey, o_custkey, MONTO - 5 AS MONTO, o_orderstatus, o_orderdate, md5(HASH_FILA || 'v0') AS HASH_FILA,
      DATE '1997-01-01' AS FECHA_DESDE, DATE '1998-01-01' AS FECHA_HASTA, 0 AS EJECUCION_ID
    FROM old_snap WHERE o_orderkey % 20 = 0)""", CLASSIFY, """changed AS (
    SELECT o_orderkey FROM actions WHERE ACCION IN ('INSERTAR', 'ACTUALIZAR'))""") + """
  SELECT * FROM closed
  UNION ALL SELECT * REPLACE (DATE '1999-01-01' AS FECHA_HASTA) FROM open_ WHERE o_orderkey IN (SELECT o_orderkey FROM changed)
  UNION ALL SELECT * FROM open_ WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed)
  UNION ALL SELECT *, DATE '1999-01-01' AS FECHA_DESDE, CAST(NULL AS DATE) AS FECHA_HASTA, 2 AS EJECUCION_ID
    FROM new_snap WHERE o_orderkey IN (SELECT o_orderkey FROM changed)""",

    "late_versions": with_(*SNAPS, """seen AS (
    SELECT *, DATE '1999-01-01' AS dia, 1 AS ejecucion FROM new_snap UNION ALL SELECT *, DATE '1998-01-01', 2 FROM old_snap
    UNION ALL SELECT *, DATE '1997-01-01', 3 FROM new_snap WHERE o_custkey % 3 != 0)""", """marked AS (
    SELECT *, lag(HASH_FILA) OVER w IS DISTINCT FROM HASH_FILA AS cambia FROM seen WINDOW w AS (PARTITION BY o_orderkey ORDER BY dia))""") + """
  SELECT * EXCLUDE (dia, ejecucion, cambia), dia AS FECHA_DESDE, lead(dia) OVER (PARTITION BY o_orderkey ORDER BY dia) AS FECHA_HASTA,
    ejecucion AS EJECUCION_ID
  FROM marked WHERE cambia""",

    "upsert_balance": with_(*SNAPS, CLASSIFY) + """
  SELECT (SELECT count(*) FROM new_snap) AS PROCESADAS, count(*) FILTER (ACCION = 'INSERTAR') AS INSERTADAS,
    count(*) FILTER (ACCION = 'ACTUALIZAR') AS ACTUALIZADAS, count(*) FILTER (ACCION = 'SIN_CAMBIO') AS SIN_CAMBIO,
    count(*) FILTER (ACCION != 'AUSENTE') = (SELECT count(*) FROM new_snap) AS CUADRA
  FROM actions""",

    "digest_reconcile": with_(*SNAPS, CLASSIFY) + """
  SELECT o_orderkey, CASE ACCION WHEN 'INSERTAR' THEN 'SOLO_DESTINO' WHEN 'AUSENTE' THEN 'SOLO_ORIGEN' ELSE 'DISTINTO' END AS ESTADO
  FROM actions WHERE ACCION != 'SIN_CAMBIO'""",

    "digest_agreement": """
  SELECT DISTINCT l_orderkey, l_linenumber, 'DISTINTO' AS ESTADO FROM lineitem WHERE l_partkey % 500 = 0""",

    "bridge_rebuild": with_(*SNAPS, CLASSIFY, """affected AS (
    SELECT DISTINCT o_orderkey FROM actions WHERE ACCION IN ('INSERTAR', 'ACTUALIZAR'))""") + """
  SELECT DISTINCT l_orderkey AS o_orderkey, CASE WHEN l_linenumber > 3 THEN -l_suppkey ELSE l_suppkey END AS l_suppkey
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM affected)
  UNION ALL
  SELECT DISTINCT l_orderkey AS o_orderkey, l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM affected)""",

    "soft_delete": with_(*SNAPS) + """
  SELECT coalesce(s.o_orderkey, p.o_orderkey) AS o_orderkey,
    CAST(CASE WHEN p.o_orderkey IS NOT NULL THEN 0 ELSE coalesce(s.a, 0) + 1 END AS INTEGER) AS AUSENCIAS_CONSECUTIVAS,
    (CASE WHEN p.o_orderkey IS NOT NULL THEN 0 ELSE coalesce(s.a, 0) + 1 END) < 2 AS VIGENTE
  FROM (SELECT o_orderkey, CAST((abs(o_orderkey) // 2) % 3 AS INTEGER) AS a FROM old_snap) s
  FULL OUTER JOIN (SELECT DISTINCT o_orderkey FROM new_snap) p ON s.o_orderkey = p.o_orderkey""",

    "prorated_amount": with_(PRORATE) + """
  SELECT o_orderkey, l_suppkey, PESO, CAST(MONTO_PRORRATEADO AS VARCHAR) AS MONTO_PRORRATEADO,
    CAST(MONTO_ORIGINAL AS VARCHAR) AS MONTO_ORIGINAL FROM prorated""",

    "proration_check": with_(PRORATE) + """
  SELECT CAST(d AS VARCHAR) AS DIFERENCIA, count(*) AS CONTRATOS FROM (
    SELECT o_orderkey, sum(MONTO_PRORRATEADO) - first(MONTO_ORIGINAL) AS d FROM prorated GROUP BY o_orderkey)
  GROUP BY 1""",

    "future_dates": """
  SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderdate > TIMESTAMP '1998-08-02'""",

    "batch_compare": with_(*SNAPS) + """
  SELECT coalesce(a.ANIO, b.ANIO) AS ANIO, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
    coalesce(a.n, 0) AS FILAS_ANTERIOR, coalesce(b.n, 0) AS FILAS_ACTUAL, coalesce(b.n, 0) - coalesce(a.n, 0) AS DIFERENCIA
  FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS ANIO, o_orderstatus, count(*) AS n FROM old_snap GROUP BY ALL) a
  FULL OUTER JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS ANIO, o_orderstatus, count(*) AS n FROM new_snap GROUP BY ALL) b
    ON a.ANIO = b.ANIO AND a.o_orderstatus = b.o_orderstatus""",

    "dimension_upsert": """WITH old AS (
    SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS CLAVE_CLIENTE, CAST(c_custkey // 2 AS BIGINT) + 1 AS CLIENTE_KEY
    FROM customer WHERE c_custkey % 2 = 0),
  dim AS (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS CLAVE_CLIENTE, c_name AS NOMBRE FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders))
  SELECT o.CLAVE_CLIENTE, o.CLIENTE_KEY, d.NOMBRE FROM old o LEFT JOIN dim d ON o.CLAVE_CLIENTE = d.CLAVE_CLIENTE
  UNION ALL
  SELECT CLAVE_CLIENTE, (SELECT max(CLIENTE_KEY) FROM old) + row_number() OVER (ORDER BY CLAVE_CLIENTE) AS CLIENTE_KEY, NOMBRE
  FROM dim WHERE CLAVE_CLIENTE NOT IN (SELECT CLAVE_CLIENTE FROM old)""",

    "manifest_changes": """WITH cur AS (
    SELECT 'landing/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS RUTA, sha256(text) AS SHA256 FROM documents),
  prev AS (SELECT 'landing/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS RUTA,
    sha256(CASE WHEN doc_id % 10 = 1 THEN text || 'x' ELSE text END) AS SHA256 FROM documents WHERE doc_id % 4 <> 0)
  SELECT c.RUTA, c.SHA256, CASE WHEN p.SHA256 IS NULL THEN 'NUEVO' WHEN p.SHA256 = c.SHA256 THEN 'SIN_CAMBIO'
    ELSE 'MODIFICADO' END AS ESTADO, (p.SHA256 IS NULL OR p.SHA256 <> c.SHA256) AS PROCESAR
  FROM cur c LEFT JOIN prev p ON c.RUTA = p.RUTA""",

    "package_changes": """WITH pk AS (
    SELECT 'pkg-' || strftime(d, '%Y%m%d') AS PAQUETE, strftime(max_ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP_API,
      day(d) AS dd FROM (SELECT CAST(ts AS DATE) AS d, max(ts) AS max_ts FROM events GROUP BY 1)),
  st AS (SELECT PAQUETE, CASE WHEN dd % 3 = 0 THEN '1900-01-01 00:00:00' ELSE TIMESTAMP_API END AS ts_ FROM pk WHERE dd % 5 <> 0)
  SELECT p.PAQUETE, p.TIMESTAMP_API, CASE WHEN s.ts_ IS NULL THEN 'NUEVO' WHEN s.ts_ = p.TIMESTAMP_API THEN 'SIN_CAMBIO'
    ELSE 'MODIFICADO' END AS ESTADO, (s.ts_ IS NULL OR s.ts_ <> p.TIMESTAMP_API) AS PROCESAR
  FROM pk p LEFT JOIN st s ON p.PAQUETE = s.PAQUETE""",
})


# ------------------------------------------------------------------ staging

def parse_date_sql(x: str) -> str:
    return ("coalesce(" + ", ".join(f"try_strptime(trim({x}), '{f}')" for f in
            ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%d/%m/%Y %H:%M:%S",
             "%d/%m/%Y", "%Y%m%d"]) + ")")


_EMPTY = "(l_linenumber = 7 AND l_partkey % 5 = 0)"
_FD = """(CASE l_orderkey % 5 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y')
  WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN 'nan' ELSE '31/02/1999' END)"""
_AMT_L = _AMT  # same amount renderings, keyed by l_linenumber

RAW_CONTRATOS = f"""raw AS (
  SELECT
    CASE WHEN {_EMPTY} OR (l_linenumber = 7 AND l_partkey % 2 = 0) THEN NULL
         ELSE CAST(l_orderkey AS VARCHAR) || CASE WHEN l_linenumber % 3 = 0 THEN '.0' ELSE '' END END AS r_ocid,
    CASE WHEN {_EMPTY} THEN NULL ELSE l_linestatus END AS r_ent,
    CASE WHEN {_EMPTY} THEN NULL ELSE CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE '' END || CAST(l_linenumber AS VARCHAR) END AS r_idc,
    CASE WHEN {_EMPTY} THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS r_adj,
    CASE WHEN {_EMPTY} THEN NULL ELSE '  Contrato' || chr(10) || CAST(l_partkey AS VARCHAR) || chr(9) || chr(160) || 'nº  ' || l_returnflag END AS r_tit,
    CASE WHEN {_EMPTY} THEN NULL ELSE {_AMT_L} END AS r_monto,
    CASE WHEN {_EMPTY} THEN NULL ELSE {_FD} END AS r_firma,
    CASE WHEN {_EMPTY} OR l_linenumber % 2 = 0 THEN NULL WHEN l_returnflag = 'N' THEN 'nan' ELSE 'PEN' END AS r_mon,
    CASE WHEN {_EMPTY} OR l_linenumber % 2 = 1 THEN NULL ELSE strftime(l_shipdate, '%d/%m/%Y') END AS r_ini,
    CASE WHEN {_EMPTY} OR l_linenumber % 2 = 1 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',0' END AS r_dur,
    CAST(year(l_shipdate) AS INTEGER) AS ANIO_ARCHIVO, CAST(month(l_shipdate) AS INTEGER) AS MES_ARCHIVO,
    'contratos_' || strftime(l_shipdate, '%Y%m') || '.csv' AS ARCHIVO_ORIGEN,
    {_EMPTY} AS empty_row
  FROM lineitem)"""

STAGED_CONTRATOS = f"""cleaned AS (
  SELECT {norm_id_sql('r_ocid')} AS OCID, {norm_id_sql('r_ent')} AS ID_ENTREGA, {norm_id_sql('r_idc')} AS ID_CONTRATO,
    {norm_id_sql('r_adj')} AS ID_ADJUDICACION, {clean_sql('r_tit')} AS TITULO_CONTRATO,
    CAST(NULL AS VARCHAR) AS DESCRIPCION_CONTRATO, {parse_date_sql(clean_sql('r_ini'))} AS FECHA_INICIO,
    CAST(NULL AS TIMESTAMP) AS FECHA_FIN, {parse_number_sql(clean_sql('r_dur'))} AS DURACION_DIAS,
    {parse_number_sql(clean_sql('r_monto'))} AS MONTO_CONTRATO, {clean_sql('r_mon')} AS MONEDA_CONTRATO,
    CAST(NULL AS VARCHAR) AS NOMBRE_MONEDA_CONTRATO, {parse_date_sql(clean_sql('r_firma'))} AS FECHA_FIRMA,
    CAST(NULL AS DOUBLE) AS MONTO_FINAL, CAST(NULL AS VARCHAR) AS MONEDA_FINAL,
    CAST(NULL AS VARCHAR) AS NOMBRE_MONEDA_FINAL, CAST(NULL AS TIMESTAMP) AS FECHA_FIN_IMPLEMENTACION,
    ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN
  FROM raw WHERE NOT empty_row),
staged AS (
  SELECT *, OCID || '|' || ID_CONTRATO AS CLAVE_CONTRATO,
    count(*) OVER (PARTITION BY ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN, OCID || '|' || ID_CONTRATO) > 1 AS ES_DUPLICADO_CLAVE
  FROM cleaned WHERE OCID IS NOT NULL AND ID_CONTRATO IS NOT NULL)"""

_CK_RUC = "('20' || lpad(CAST(c_custkey AS VARCHAR), 9, '0'))"
RAW_PARTES = f"""raw AS (
  SELECT 'ocds-' || CAST(o_orderkey AS VARCHAR) AS r_ocid, '1' AS r_ent,
    CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS r_idorg,
    c_name AS r_comun,
    CASE WHEN c_custkey % 5 = 1 THEN NULL WHEN c_custkey % 3 = 0 THEN 'PE-RUC-' || {_CK_RUC} ELSE {_CK_RUC} || '.0' END AS r_ident,
    CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'Razón Social ' || upper(c_name) END AS r_legal,
    'Av. ' || c_mktsegment || ' Nº ' || CAST(c_custkey % 900 AS VARCHAR) AS r_dir,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Distrito ' || CAST(c_custkey % 13 AS VARCHAR) END AS r_loc,
    r_name AS r_reg, n_name AS r_dep, 'Perú' AS r_pais,
    CASE c_custkey % 4 WHEN 0 THEN 'buyer;procuringEntity' WHEN 1 THEN 'Supplier'
      WHEN 2 THEN 'Entidad contratante / proveedor' ELSE 'tenderer' END AS r_roles,
    CAST(year(o_orderdate) AS INTEGER) AS ANIO_ARCHIVO, CAST(month(o_orderdate) AS INTEGER) AS MES_ARCHIVO,
    'partes_' || strftime(o_orderdate, '%Y%m') || '.csv' AS ARCHIVO_ORIGEN
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

_CAT = "A-Z0-9Ñ&/ -"
STAGED_PARTES = f"""c1 AS (
  SELECT {norm_id_sql('r_ocid')} AS OCID, {norm_id_sql('r_ent')} AS ID_ENTREGA, {norm_id_sql('r_idorg')} AS ID_ORGANIZACION,
    {norm_id_sql('r_ident')} AS IDENTIFICADOR_PRINCIPAL,
    coalesce({clean_sql('r_legal')}, {clean_sql('r_comun')}) AS NOMBRE_ORGANIZACION_ORIGINAL,
    {std_full(clean_sql('r_dir'), _CAT)} AS DIRECCION_ESTANDAR, {std_full(clean_sql('r_loc'), _CAT)} AS LOCALIDAD_ESTANDAR,
    {std_full(clean_sql('r_reg'), _CAT)} AS REGION_ESTANDAR, {std_full(clean_sql('r_dep'), _CAT)} AS DEPARTAMENTO_ESTANDAR,
    {std_full(clean_sql('r_pais'), _CAT)} AS PAIS_ESTANDAR, {std_full(clean_sql('r_roles'), _CAT)} AS ROLES_ESTANDAR,
    ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN
  FROM raw),
c2 AS (
  SELECT *, {std_full('NOMBRE_ORGANIZACION_ORIGINAL', _CAT)} AS NOMBRE_ORGANIZACION_ESTANDAR,
    coalesce({ruc_extract_sql('IDENTIFICADOR_PRINCIPAL')}, {ruc_extract_sql('ID_ORGANIZACION')}) AS RUC_ORGANIZACION,
    coalesce(regexp_matches(ROLES_ESTANDAR, 'BUYER|PROCURINGENTITY|COMPRADOR|ENTIDAD CONTRATANTE'), false) AS ES_COMPRADOR_O_ENTIDAD,
    coalesce(regexp_matches(ROLES_ESTANDAR, 'SUPPLIER|PROVEEDOR'), false) AS ES_PROVEEDOR
  FROM c1 WHERE OCID IS NOT NULL AND ID_ENTREGA IS NOT NULL
    AND (ID_ORGANIZACION IS NOT NULL OR IDENTIFICADOR_PRINCIPAL IS NOT NULL OR NOMBRE_ORGANIZACION_ORIGINAL IS NOT NULL)),
c3 AS (
  SELECT *, {ruc_valid('RUC_ORGANIZACION')} AS RUC_VALIDO,
    CASE WHEN RUC_ORGANIZACION IS NOT NULL THEN 'RUC|' || RUC_ORGANIZACION
         WHEN ID_ORGANIZACION IS NOT NULL THEN 'ID|' || ID_ORGANIZACION END AS CLAVE_ORGANIZACION,
    OCID || '|' || ID_ENTREGA || '|' || coalesce(ID_ORGANIZACION, IDENTIFICADOR_PRINCIPAL, NOMBRE_ORGANIZACION_ESTANDAR) AS CLAVE_PARTE
  FROM c2),
staged AS (
  SELECT *, count(*) OVER (PARTITION BY ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN, CLAVE_PARTE) > 1 AS ES_DUPLICADO_CLAVE FROM c3)"""

ORACLES.update({
    "staging_contratos": with_(RAW_CONTRATOS, STAGED_CONTRATOS) + "SELECT * FROM staged",

    "file_controls": with_(RAW_CONTRATOS, STAGED_CONTRATOS) + """
  SELECT 'CONTRATOS' AS TABLA, s.ANIO_ARCHIVO, s.MES_ARCHIVO, s.ARCHIVO_ORIGEN, s.n AS FILAS_ORIGEN,
    coalesce(o.n, 0) AS FILAS_SALIDA, s.n - coalesce(o.n, 0) AS FILAS_DESCARTADAS,
    coalesce(o.d, 0) AS CLAVES_DUPLICADAS, CAST(0 AS BIGINT) AS RUC_PRESENTES, CAST(0 AS BIGINT) AS RUC_VALIDOS
  FROM (SELECT ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN, count(*) AS n FROM raw WHERE NOT empty_row GROUP BY ALL) s
  LEFT JOIN (SELECT ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN, count(*) AS n,
               count(*) FILTER (WHERE ES_DUPLICADO_CLAVE) AS d FROM staged GROUP BY ALL) o
    USING (ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN)""",

    "staging_partes": with_(RAW_PARTES, STAGED_PARTES) + """
  SELECT OCID, ID_ENTREGA, ID_ORGANIZACION, IDENTIFICADOR_PRINCIPAL, NOMBRE_ORGANIZACION_ORIGINAL,
    NOMBRE_ORGANIZACION_ESTANDAR, RUC_ORGANIZACION, RUC_VALIDO, DIRECCION_ESTANDAR, LOCALIDAD_ESTANDAR,
    REGION_ESTANDAR, DEPARTAMENTO_ESTANDAR, PAIS_ESTANDAR, ROLES_ESTANDAR, ES_COMPRADOR_O_ENTIDAD, ES_PROVEEDOR,
    CLAVE_ORGANIZACION, CLAVE_PARTE, ES_DUPLICADO_CLAVE, ANIO_ARCHIVO, MES_ARCHIVO FROM staged""",

    "geo_catalog": with_(RAW_PARTES, STAGED_PARTES) + """
  SELECT *, row_number() OVER (ORDER BY PAIS_ESTANDAR ASC NULLS LAST, DEPARTAMENTO_ESTANDAR ASC NULLS LAST,
      REGION_ESTANDAR ASC NULLS LAST, LOCALIDAD_ESTANDAR ASC NULLS LAST) AS UBICACION_KEY
  FROM (SELECT DISTINCT PAIS_ESTANDAR, DEPARTAMENTO_ESTANDAR, REGION_ESTANDAR, LOCALIDAD_ESTANDAR FROM staged
        WHERE coalesce(PAIS_ESTANDAR, DEPARTAMENTO_ESTANDAR, REGION_ESTANDAR, LOCALIDAD_ESTANDAR) IS NOT NULL)""",
})


# ------------------------------------------------------------------ landing

_PK = """pk AS (
  SELECT event_id, ts, event_type AS src, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    CAST(2020 + event_id % 5 AS VARCHAR) AS year, lpad(CAST(1 + user_id % 12 AS VARCHAR), 2, '0') AS month,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type || '-' || CAST(2020 + event_id % 5 AS VARCHAR) || '-'
      || lpad(CAST(1 + user_id % 12 AS VARCHAR), 2, '0') END AS raw_id
  FROM events),
pk2 AS (SELECT *, coalesce(nullif(raw_id, ''), src || '-' || year || '-' || month) AS PAQUETE_ID,
  'https://datos.example.org/api/v1/file/' || src || '/' AS base FROM pk)"""


def _u(fmt):
    return f"base || '{fmt}/' || year || '/' || month || '/'"


_WSC = WS.replace("]+", "]+")
_CELL = lambda x: f"coalesce(trim(regexp_replace(CAST({x} AS VARCHAR), '{WS}', ' ', 'g')), '')"

_FILES = """files AS (
  SELECT CASE lang WHEN 'en' THEN 2022 WHEN 'fr' THEN 2023 WHEN 'de' THEN 2024 WHEN 'es' THEN 2025 END AS ANIO,
    CAST(1 + CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 14 AS INTEGER) AS MES,
    source || '_' || lang || '.xlsx' AS ARCHIVO, sum(n_chars) AS BYTES,
    count(*) FILTER (WHERE n_chars < 200) AS COLUMNAS_FALTANTES, CAST(count(*) AS VARCHAR) AS FILAS_CONTRATOS
  FROM documents GROUP BY ALL)"""
_EXPECTED = """expected AS (
  SELECT y AS ANIO, CAST(unnest(generate_series(1, CASE WHEN y < 2026 THEN 12 WHEN y = 2026 THEN 6 ELSE 0 END)) AS INTEGER) AS MES
  FROM (SELECT unnest([2022, 2023, 2024, 2025, 2026]) AS y))"""
_STATUS = """per AS (
  SELECT ANIO, MES, count(*) AS n, arg_max(ARCHIVO, {'b': BYTES, 'a': ARCHIVO}) AS princ,
    arg_max(BYTES, {'b': BYTES, 'a': ARCHIVO}) AS pbytes, arg_max(COLUMNAS_FALTANTES, {'b': BYTES, 'a': ARCHIVO}) AS pmiss,
    arg_max(FILAS_CONTRATOS, {'b': BYTES, 'a': ARCHIVO}) AS pfilas
  FROM files GROUP BY ANIO, MES),
status AS (
  SELECT e.ANIO, e.MES, CAST(coalesce(p.n, 0) AS BIGINT) AS CANTIDAD_ARCHIVOS, coalesce(p.princ, '') AS ARCHIVO_PRINCIPAL,
    coalesce(round(p.pbytes / 1048576, 2), 0.0) AS TAMANO_MB, p.pfilas AS FILAS_CONTRATOS,
    CASE WHEN coalesce(p.n, 0) = 0 THEN 'FALTANTE' WHEN p.pmiss > 0 THEN 'ERROR' WHEN p.n > 1 THEN 'ADVERTENCIA'
         ELSE 'OK' END AS ESTADO,
    CASE WHEN coalesce(p.n, 0) = 0 THEN 'No existe un archivo XLSX extraído para este mes.'
         ELSE concat_ws(' ', CASE WHEN p.n > 1 THEN 'Se encontraron ' || CAST(p.n AS VARCHAR) || ' archivos XLSX.' END,
                        CASE WHEN p.pmiss > 0 THEN 'Existen columnas críticas faltantes.' END) END AS OBSERVACION
  FROM expected e LEFT JOIN per p ON e.ANIO = p.ANIO AND e.MES = p.MES)"""

_PATH = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"

ORACLES.update({
    "catalog_formats": with_(_PK) + f"""
  SELECT PAQUETE_ID, 'csv' AS FORMATO, {_u('csv')} AS URL FROM pk2
  UNION ALL SELECT PAQUETE_ID, 'xlsx', {_u('xlsx')} FROM pk2 WHERE k % 2 = 0
  UNION ALL SELECT PAQUETE_ID, 'xlsx_es', {_u('xlsx')} || 'es' FROM pk2 WHERE k % 3 <> 0""",

    "package_selection": with_(_PK) + f""",
  last_ AS (SELECT * FROM pk2 QUALIFY row_number() OVER (PARTITION BY PAQUETE_ID ORDER BY ts DESC, event_id DESC) = 1)
  SELECT PAQUETE_ID, month, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp,
    CASE WHEN k % 3 <> 0 THEN 'xlsx_es' ELSE 'xlsx' END AS FORMATO_ELEGIDO,
    CASE WHEN k % 3 <> 0 THEN {_u('xlsx')} || 'es' ELSE {_u('xlsx')} END AS URL_DESCARGA
  FROM last_ WHERE year = '2022' AND src = 'click' AND (k % 3 <> 0 OR k % 2 = 0)""",

    "url_predicate": f"""
  SELECT page_id, url,
    coalesce(""" + " OR ".join(f"ends_with(lower({_PATH}), '{e}')" for e in
                              [".json", ".csv", ".xlsx", ".xls", ".zip", ".gz", ".sha", ".txt"]) + """, false) AS DESCARGABLE,
    coalesce(""" + " OR ".join(f"contains(lower(regexp_extract({_PATH}, '([^/]*)$', 1) || ' ' || url), '{k}')"
                              for k in ["contrato", "contracts", "award", "adjudic", "ocds"]) + """, false) AS PARECE_CONTRATOS
  FROM pages""",

    "landing_months": with_(_FILES, _EXPECTED, _STATUS) + "SELECT * FROM status",

    "landing_summary": with_(_FILES, _EXPECTED, _STATUS) + """
  SELECT 'Meses esperados' AS INDICADOR, count(*) AS VALOR FROM status
  UNION ALL SELECT 'Meses OK', count(*) FILTER (WHERE ESTADO = 'OK') FROM status
  UNION ALL SELECT 'Meses con advertencia', count(*) FILTER (WHERE ESTADO = 'ADVERTENCIA') FROM status
  UNION ALL SELECT 'Meses con error', count(*) FILTER (WHERE ESTADO = 'ERROR') FROM status
  UNION ALL SELECT 'Meses faltantes', count(*) FILTER (WHERE ESTADO = 'FALTANTE') FROM status
  UNION ALL SELECT 'Filas de contratos', CAST(sum(coalesce(TRY_CAST(FILAS_CONTRATOS AS BIGINT), 0)) AS BIGINT) FROM status""",

    "unexpected_months": with_(_FILES, _EXPECTED) + """
  SELECT DISTINCT ANIO, MES FROM files WHERE (ANIO, MES) NOT IN (SELECT (ANIO, MES) FROM expected)""",

    "ordered_outputs": """
  (SELECT 'TOP_PEDIDOS' AS REPORTE, o_orderkey AS CLAVE, o_totalprice AS VALOR, CAST(year(o_orderdate) AS INTEGER) AS ANIO,
     CAST(NULL AS VARCHAR) AS GRUPO, CAST(NULL AS INTEGER) AS RANGO
   FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10)
  UNION ALL
  SELECT 'TOP_CLIENTES_NACION', c_custkey, c_acctbal, CAST(NULL AS INTEGER), upper(trim(c_mktsegment)), CAST(r AS INTEGER)
  FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer)
  WHERE r <= 3""",

    "pipe_row_export": f"""
  SELECT concat_ws('|', {_CELL('doc_id')}, {_CELL('lang')}, {_CELL('source')}, {_CELL('text')}) AS FILA
  FROM documents
  WHERE greatest(length({_CELL('doc_id')}), length({_CELL('lang')}), length({_CELL('source')}), length({_CELL('text')})) > 0""",

    "separator_audit": """
  SELECT 'doc_id' AS COLUMNA, count(*) FILTER (WHERE contains(CAST(doc_id AS VARCHAR), '|')) AS CELDAS_CON_SEPARADOR FROM documents
  UNION ALL SELECT 'lang', count(*) FILTER (WHERE contains(lang, '|')) FROM documents
  UNION ALL SELECT 'source', count(*) FILTER (WHERE contains(source, '|')) FROM documents
  UNION ALL SELECT 'text', count(*) FILTER (WHERE contains(text, '|')) FROM documents""",
})


# ----------------------------------------------------------------- one year

def _last(name, src, keys, payload):
    order = ", ".join(["TRY_CAST(MES_ARCHIVO AS INTEGER) DESC NULLS LAST", "ARCHIVO_ORIGEN DESC NULLS LAST"]
                      + [f"{c} DESC NULLS LAST" for c in payload])
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"{name} AS (SELECT * FROM {src} WHERE {nn} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1)")


def _str(cols):
    return ", ".join(f"CAST({c} AS VARCHAR) AS {a}" for c, a in cols)


_OY_C = ["CLAVE_CONTRATO", "OCID", "ID_ENTREGA", "ID_CONTRATO", "ID_ADJUDICACION", "MONTO_CONTRATO",
         "MONEDA_CONTRATO", "MES_ARCHIVO", "ARCHIVO_ORIGEN"]
_OY_R = [("OCID", "OCID"), ("ID_ENTREGA", "ID_ENTREGA"), ("ID_LICITACION", "ID_LICITACION"),
         ("ID_ENTIDAD_CONTRATANTE", "ID_ENTIDAD_CONTRATANTE"),
         ("NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL", "NOMBRE_ENTIDAD_CONTRATANTE"),
         ("ID_COMPRADOR", "ID_COMPRADOR"), ("NOMBRE_COMPRADOR_ORIGINAL", "NOMBRE_COMPRADOR"),
         ("METODO_CONTRATACION", "METODO_CONTRATACION"), ("CATEGORIA_PRINCIPAL", "CATEGORIA_PRINCIPAL"),
         ("MES_ARCHIVO", "MES_ARCHIVO"), ("ARCHIVO_ORIGEN", "ARCHIVO_ORIGEN")]
_OY_P = [("OCID", "OCID"), ("ID_ENTREGA", "ID_ENTREGA"), ("ID_ADJUDICACION", "ID_ADJUDICACION"),
         ("ID_PROVEEDOR", "ID_PROVEEDOR"), ("NOMBRE_PROVEEDOR_ORIGINAL", "NOMBRE_PROVEEDOR"),
         ("MES_ARCHIVO", "MES_ARCHIVO"), ("ARCHIVO_ORIGEN", "ARCHIVO_ORIGEN")]

ONE_YEAR = [STG_CONTRATOS, STG_REGISTROS, STG_PROVEEDORES,
            f"oc AS (SELECT {_str([(c, c) for c in _OY_C])} FROM stg_contratos WHERE ANIO_ARCHIVO = 1998)",
            f"orr AS (SELECT {_str(_OY_R)} FROM stg_registros WHERE ANIO_ARCHIVO = 1998)",
            f"op AS (SELECT {_str(_OY_P)} FROM stg_proveedores WHERE ANIO_ARCHIVO = 1998)",
            _last("cur", "oc", ["CLAVE_CONTRATO"], _OY_C[1:]),
            _last("reg", "orr", ["OCID", "ID_ENTREGA"], [a for _, a in _OY_R[2:]]),
            _last("sup", "op", ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "ID_PROVEEDOR"],
                  ["NOMBRE_PROVEEDOR", "MES_ARCHIVO", "ARCHIVO_ORIGEN"]),
            """f0 AS (
  SELECT cur.*, reg.ID_LICITACION, reg.ID_ENTIDAD_CONTRATANTE, reg.NOMBRE_ENTIDAD_CONTRATANTE, reg.ID_COMPRADOR,
    reg.NOMBRE_COMPRADOR,
    CASE WHEN reg.ID_LICITACION IS NOT NULL THEN 'SI' ELSE 'NO' END AS REGISTRO_RELACIONADO,
    coalesce(reg.ID_ENTIDAD_CONTRATANTE, reg.ID_COMPRADOR) AS ID_ENTIDAD_MODELO,
    coalesce(reg.NOMBRE_ENTIDAD_CONTRATANTE, reg.NOMBRE_COMPRADOR) AS NOMBRE_ENTIDAD_MODELO,
    CASE WHEN reg.ID_ENTIDAD_CONTRATANTE IS NOT NULL THEN 'ENTIDAD_CONTRATANTE'
         WHEN reg.ID_COMPRADOR IS NOT NULL THEN 'COMPRADOR_RESPALDO' ELSE 'SIN_ENTIDAD' END AS ORIGEN_ENTIDAD_MODELO
  FROM cur LEFT JOIN reg ON cur.OCID = reg.OCID AND cur.ID_ENTREGA = reg.ID_ENTREGA)""",
            """b0 AS (
  SELECT k.OCID, k.ID_ENTREGA, k.ID_ADJUDICACION, k.CLAVE_CONTRATO, s.ID_PROVEEDOR, s.NOMBRE_PROVEEDOR,
    s.MES_ARCHIVO, s.ARCHIVO_ORIGEN
  FROM (SELECT DISTINCT CLAVE_CONTRATO, OCID, ID_ENTREGA, ID_ADJUDICACION FROM f0) k
  JOIN sup s ON k.OCID = s.OCID AND k.ID_ENTREGA = s.ID_ENTREGA AND k.ID_ADJUDICACION = s.ID_ADJUDICACION)""",
            _last("bridge1", "b0", ["CLAVE_CONTRATO", "ID_PROVEEDOR"],
                  ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "NOMBRE_PROVEEDOR"]),
            """summ AS (
  SELECT CLAVE_CONTRATO, count(DISTINCT ID_PROVEEDOR) AS n,
    string_agg(DISTINCT nullif(trim(ID_PROVEEDOR), ''), ' | ' ORDER BY nullif(trim(ID_PROVEEDOR), '')) AS ids,
    string_agg(DISTINCT nullif(trim(NOMBRE_PROVEEDOR), ''), ' | ' ORDER BY nullif(trim(NOMBRE_PROVEEDOR), '')) AS noms
  FROM bridge1 GROUP BY CLAVE_CONTRATO)""",
            """f1 AS (
  SELECT f0.*, CAST(coalesce(summ.n, 0) AS INTEGER) AS CANTIDAD_PROVEEDORES, summ.ids AS IDS_PROVEEDORES,
    summ.noms AS NOMBRES_PROVEEDORES, CASE WHEN coalesce(summ.n, 0) > 0 THEN 'SI' ELSE 'NO' END AS TIENE_PROVEEDOR
  FROM f0 LEFT JOIN summ ON f0.CLAVE_CONTRATO = summ.CLAVE_CONTRATO)""",
            _last("dsup", "sup", ["ID_PROVEEDOR"], ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "NOMBRE_PROVEEDOR"]),
            """ent0 AS (SELECT *, coalesce(ID_ENTIDAD_CONTRATANTE, ID_COMPRADOR) AS ID_ENTIDAD_MODELO,
    coalesce(NOMBRE_ENTIDAD_CONTRATANTE, NOMBRE_COMPRADOR) AS NOMBRE_ENTIDAD_MODELO,
    CASE WHEN ID_ENTIDAD_CONTRATANTE IS NOT NULL THEN 'ENTIDAD_CONTRATANTE' ELSE 'COMPRADOR_RESPALDO' END
      AS ORIGEN_ENTIDAD_MODELO FROM reg)""",
            _last("dent", "ent0", ["ID_ENTIDAD_MODELO"],
                  ["OCID", "ID_ENTREGA"] + [a for _, a in _OY_R[2:9]] + ["NOMBRE_ENTIDAD_MODELO",
                                                                       "ORIGEN_ENTIDAD_MODELO"])]

ORACLES.update({
    "one_year_fact": with_(*ONE_YEAR) + """
  SELECT CLAVE_CONTRATO, OCID, ID_ENTREGA, MONTO_CONTRATO, MES_ARCHIVO, REGISTRO_RELACIONADO, ID_ENTIDAD_MODELO,
    NOMBRE_ENTIDAD_MODELO, ORIGEN_ENTIDAD_MODELO, CANTIDAD_PROVEEDORES, IDS_PROVEEDORES, NOMBRES_PROVEEDORES,
    TIENE_PROVEEDOR FROM f1""",

    "one_year_quality": with_(*ONE_YEAR) + """
  SELECT 'Total de contratos' AS INDICADOR, count(*) AS CANTIDAD FROM f1
  UNION ALL SELECT 'Claves de contrato únicas', count(DISTINCT CLAVE_CONTRATO) FROM f1
  UNION ALL SELECT 'Filas duplicadas por clave', count(*) - count(DISTINCT CLAVE_CONTRATO) FROM f1
  UNION ALL SELECT 'Contratos sin registro relacionado', count(*) FILTER (WHERE ID_LICITACION IS NULL) FROM f1
  UNION ALL SELECT 'Contratos sin entidad', count(*) FILTER (WHERE ID_ENTIDAD_MODELO IS NULL) FROM f1
  UNION ALL SELECT 'Contratos sin proveedor', count(*) FILTER (WHERE CANTIDAD_PROVEEDORES = 0) FROM f1
  UNION ALL SELECT 'Contratos con varios proveedores', count(*) FILTER (WHERE CANTIDAD_PROVEEDORES > 1) FROM f1
  UNION ALL SELECT 'Relaciones contrato-proveedor', count(*) FROM bridge1
  UNION ALL SELECT 'Proveedores únicos', count(*) FROM dsup
  UNION ALL SELECT 'Entidades únicas', count(*) FROM dent""",
})


# the streamed upsert must end in the same state as the batch "last per key"
ORACLES["stream_upsert"] = ORACLES["keep_last_per_key"]

ORACLES["staging_inventory"] = with_(RAW_CONTRATOS, STAGED_CONTRATOS) + """
  SELECT 'CONTRATOS' AS TABLA, ANIO_ARCHIVO AS ANIO, MES_ARCHIVO AS MES, count(*) AS FILAS
  FROM staged GROUP BY ALL"""

ORACLES["sheet_rows"] = with_(RAW_CONTRATOS) + """
  SELECT ARCHIVO_ORIGEN, count(*) AS FILAS_DATOS FROM raw WHERE NOT empty_row GROUP BY ARCHIVO_ORIGEN"""


# ------------------------------------------------------------- landing files

_WHOLE = """concat_ws(',', CAST(l_orderkey AS VARCHAR), l_linestatus, CAST(l_linenumber AS VARCHAR),
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
  CASE WHEN month(l_shipdate) % 3 = 0 THEN strftime(l_shipdate, '%m/%d/%Y') ELSE strftime(l_shipdate, '%d/%m/%Y') END)"""
_LANDED = f"""landed AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS ANIO_ARCHIVO, CAST(month(l_shipdate) AS INTEGER) AS MES_ARCHIVO,
    CASE WHEN l_partkey % 97 = 0 THEN concat_ws(',', CAST(l_orderkey AS VARCHAR), l_linestatus)
         WHEN l_partkey % 89 = 0 THEN {_WHOLE} || ',sobra'
         WHEN l_partkey % 83 = 0 THEN {_WHOLE} || chr(65533) ELSE {_WHOLE} END AS REGISTRO,
    CASE WHEN l_partkey % 97 = 0 OR l_partkey % 89 = 0 THEN 'numero de celdas distinto del encabezado'
         WHEN l_partkey % 83 = 0 THEN 'caracteres ilegibles' END AS MOTIVO,
    l_orderkey, l_linenumber
  FROM lineitem),
good AS (
  SELECT *, count(*) OVER (PARTITION BY ANIO_ARCHIVO, MES_ARCHIVO, l_orderkey, l_linenumber) > 1 AS dup
  FROM landed WHERE MOTIVO IS NULL)"""

ORACLES.update({
    "quarantined_rows": f"""
  WITH {_LANDED}
  SELECT 'contratos' AS DATASET, ANIO_ARCHIVO, MES_ARCHIVO, 'paquete_Ent_Contratos.csv' AS ARCHIVO_ORIGEN, MOTIVO, REGISTRO
  FROM landed WHERE MOTIVO IS NOT NULL""",

    "run_summary": f"""
  WITH {_LANDED},
  files AS (SELECT count(*) AS n FROM (SELECT DISTINCT ANIO_ARCHIVO, MES_ARCHIVO FROM landed))
  SELECT 'contratos' AS DATASET, n AS ARCHIVOS_ENCONTRADOS, n AS ARCHIVOS_PROCESADOS, 0 AS ARCHIVOS_OMITIDOS,
    0 AS ARCHIVOS_CON_ERROR, (SELECT count(*) FROM landed) AS FILAS_LEIDAS, (SELECT count(*) FROM good) AS FILAS_ESCRITAS,
    0 AS FILAS_DESCARTADAS, (SELECT count(*) FROM landed WHERE MOTIVO IS NOT NULL) AS FILAS_CUARENTENA,
    (SELECT count(*) FROM good WHERE dup) AS CLAVES_DUPLICADAS, true AS CUADRA
  FROM files""",

    "landing_controls": f"""
  WITH {_LANDED},
  per AS (SELECT ANIO_ARCHIVO, MES_ARCHIVO, count(*) AS n, count(*) FILTER (MOTIVO IS NOT NULL) AS c FROM landed GROUP BY 1, 2),
  d AS (SELECT ANIO_ARCHIVO, MES_ARCHIVO, count(*) FILTER (dup) AS d FROM good GROUP BY 1, 2)
  SELECT 'CONTRATOS' AS TABLA, ANIO_ARCHIVO, MES_ARCHIVO, 'paquete_Ent_Contratos.csv' AS ARCHIVO_ORIGEN, n AS FILAS_ORIGEN,
    n - c AS FILAS_SALIDA, 0 AS FILAS_DESCARTADAS, coalesce(d, 0) AS CLAVES_DUPLICADAS, 0 AS RUC_PRESENTES, 0 AS RUC_VALIDOS,
    c AS FILAS_CUARENTENA
  FROM per LEFT JOIN d USING (ANIO_ARCHIVO, MES_ARCHIVO)""",

    "date_layouts": """
  WITH raw AS (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ANIO_ARCHIVO, CAST(month(l_shipdate) AS INTEGER) AS MES_ARCHIVO,
      CASE WHEN l_partkey % 50 = 0 THEN strftime(l_shipdate, '%-m-%-d-%Y %H:%M:%S')
           WHEN month(l_shipdate) % 3 = 0 THEN strftime(l_shipdate, '%m/%d/%Y') ELSE strftime(l_shipdate, '%d/%m/%Y') END AS a,
      CASE WHEN month(l_shipdate) % 2 = 0 THEN strftime(l_shipdate + to_days(CAST(l_quantity AS INTEGER)), '%-m.%-d.%Y')
           WHEN l_partkey % 7 = 0 THEN '31/31/1999' ELSE strftime(l_shipdate + to_days(CAST(l_quantity AS INTEGER)), '%Y-%m-%d') END AS b
    FROM lineitem),
  long AS (SELECT ANIO_ARCHIVO, MES_ARCHIVO, 'FECHA_FIRMA' AS COLUMNA, a AS s FROM raw
           UNION ALL SELECT ANIO_ARCHIVO, MES_ARCHIVO, 'FECHA_FIN', b FROM raw),
  cut AS (
    SELECT *, regexp_matches(s, '^[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{4}') AS pair,
      TRY_CAST(regexp_replace(s, '^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})', '\\3-\\2-\\1') AS TIMESTAMP) AS d,
      TRY_CAST(regexp_replace(s, '^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})', '\\3-\\1-\\2') AS TIMESTAMP) AS m
    FROM long),
  votes AS (
    SELECT ANIO_ARCHIVO, MES_ARCHIVO, COLUMNA,
      count(*) FILTER (pair AND d IS NOT NULL AND m IS NULL) AS DIA_PRIMERO,
      count(*) FILTER (pair AND m IS NOT NULL AND d IS NULL) AS MES_PRIMERO,
      count(*) FILTER (pair AND m IS NOT NULL AND d IS NOT NULL) AS AMBIGUAS,
      count(*) FILTER (pair AND m IS NULL AND d IS NULL) AS IMPOSIBLES
    FROM cut GROUP BY ALL),
  parsed AS (
    SELECT c.ANIO_ARCHIVO, c.MES_ARCHIVO, c.COLUMNA,
      CASE WHEN NOT pair THEN TRY_CAST(s AS TIMESTAMP) WHEN MES_PRIMERO > DIA_PRIMERO THEN m ELSE d END AS f
    FROM cut c JOIN votes USING (ANIO_ARCHIVO, MES_ARCHIVO, COLUMNA))
  SELECT v.*, CASE WHEN MES_PRIMERO > DIA_PRIMERO THEN 'MES' ELSE 'DIA' END AS DISPOSICION, FECHAS, PRIMERA, ULTIMA
  FROM votes v JOIN (SELECT ANIO_ARCHIVO, MES_ARCHIVO, COLUMNA, count(f) AS FECHAS, min(f) AS PRIMERA, max(f) AS ULTIMA
                     FROM parsed GROUP BY ALL) USING (ANIO_ARCHIVO, MES_ARCHIVO, COLUMNA)""",
})
