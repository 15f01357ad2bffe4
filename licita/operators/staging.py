"""Landing rows -> staging rows (PRJ-1..PRJ-8, F-1..F-12, F-22, WIN-5, AGG-10).

Input: a DataFrame of string columns whose names are the published headers
(any subset, any order, extra columns allowed) plus the lineage columns
ANIO_ARCHIVO, MES_ARCHIVO, ARCHIVO_ORIGEN.  Output: the typed staging table
and a per-file control table.  Files are independent, so every per-file
computation (duplicate flags, counters) groups by file; nothing is per-row
Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import keys as K
from ..functions import numbers as N
from ..functions import ruc as R
from ..functions import text as T
from ..sources import schemas as SC
from . import layouts as LY
from .versions import duplicate_flag

FILE_KEYS = ["ANIO_ARCHIVO", "MES_ARCHIVO", "ARCHIVO_ORIGEN"]


def conform(raw: DataFrame, mapping: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """PRJ-1 + PRJ-2 + PRJ-3: normalise headers, rename by name, add missing
    columns as NULL strings, drop extras, fixed order (lineage kept)."""
    normalised = {T.normalize_header(c): c for c in raw.columns}
    exprs = []
    for canon in columns:
        src = next((orig for norm, orig in normalised.items()
                    if mapping.get(norm) == canon or norm == canon), None)
        exprs.append((F.col(f"`{src}`").cast("string") if src is not None
                      else F.lit(None).cast("string")).alias(canon))
    lineage = [F.col(c) for c in SC.LINEAGE if c in raw.columns]
    return raw.select(*exprs, *lineage)


def _with_dup(df: DataFrame, key: str, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``cut`` writes the cleaned rows and reads them back: the flag reads them twice,
    and would clean and parse them twice.  So are the keys that repeat."""
    return duplicate_flag(cut(df) if cut else df, FILE_KEYS + [key], written=cut is not None)


def _controls(staged: DataFrame, source: DataFrame, table: str, ruc: str | None,
              valid: str | None) -> DataFrame:
    """AGG-10: source rows, output rows, discarded, duplicated, RUC counters per file."""
    src = source.groupBy(*FILE_KEYS).agg(F.count(F.lit(1)).alias("FILAS_ORIGEN"))
    out = staged.groupBy(*FILE_KEYS).agg(
        F.count(F.lit(1)).alias("FILAS_SALIDA"),
        F.count_if(F.col("ES_DUPLICADO_CLAVE")).alias("CLAVES_DUPLICADAS"),
        (F.count(ruc) if ruc else F.lit(0).cast("bigint")).alias("RUC_PRESENTES"),
        (F.count_if(F.coalesce(F.col(valid), F.lit(False))) if valid
         else F.lit(0).cast("bigint")).alias("RUC_VALIDOS"))
    j = src.join(out, FILE_KEYS, "left")
    zero = F.lit(0).cast("bigint")
    return j.select(F.lit(table).alias("TABLA"), *FILE_KEYS, "FILAS_ORIGEN",
                    F.coalesce("FILAS_SALIDA", zero).alias("FILAS_SALIDA"),
                    (F.col("FILAS_ORIGEN") - F.coalesce("FILAS_SALIDA", zero)).alias("FILAS_DESCARTADAS"),
                    F.coalesce("CLAVES_DUPLICADAS", zero).alias("CLAVES_DUPLICADAS"),
                    F.coalesce("RUC_PRESENTES", zero).alias("RUC_PRESENTES"),
                    F.coalesce("RUC_VALIDOS", zero).alias("RUC_VALIDOS"))


# Counter columns of each dataset: table name, tax id and whether it is valid.
COUNTED = {"registros": ("REGISTROS", "RUC_ENTIDAD_CONTRATANTE", "RUC_ENTIDAD_VALIDO"),
           "contratos": ("CONTRATOS", None, None),
           "proveedores": ("PROVEEDORES", "RUC_PROVEEDOR", "RUC_PROVEEDOR_VALIDO"),
           "partes": ("PARTES", "RUC_ORGANIZACION", "RUC_VALIDO")}
DATES = {"registros": (SC.REGISTROS_MAP, SC.REGISTROS_COLUMNS,
                       ["FECHA_ENTREGA", "FECHA_PUBLICACION", "FECHA_PUBLICACION_LICITACION"]),
         "contratos": (SC.CONTRATOS_MAP, SC.CONTRATOS_COLUMNS,
                       ["FECHA_INICIO", "FECHA_FIN", "FECHA_FIRMA", "FECHA_FIN_IMPLEMENTACION"])}


def file_controls(dataset: str, staged: DataFrame, source: DataFrame) -> DataFrame:
    """AGG-10 of a written staging table against its source rows."""
    return _controls(staged, source, *COUNTED[dataset])


def date_votes(dataset: str, raw: DataFrame) -> DataFrame | None:
    """F-10: the date layouts of a sheet's files (None: the sheet has no dates)."""
    if dataset not in DATES:
        return None
    mapping, columns, dates = DATES[dataset]
    return LY.layout_votes(conform(raw, mapping, columns), FILE_KEYS, dates)


def _dates(df: DataFrame, dataset: str, votes: DataFrame | None) -> DataFrame:
    columns = DATES[dataset][2]
    if votes is None:
        return df.withColumns({c: D.parse_date(F.col(c)) for c in columns})
    return LY.parse_dates(df, FILE_KEYS, columns, votes)


def _clean(df: DataFrame, ids: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """F-1 and F-3 (``T.clean_text``, ``T.normalize_id``) in two steps, so that a text
    is collapsed once for the test of the null tokens and for its value."""
    df = df.withColumns({c: T.collapse_ws(F.col(c).cast("string")) for c in [*ids, *texts]})
    return df.withColumns({**{c: T.no_float_suffix(T.null_tokens(F.col(c))) for c in ids},
                           **{c: T.null_tokens(F.col(c)) for c in texts}})


def stage_registros(raw: DataFrame, votes: DataFrame | None = None,
                    cut: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    c = conform(raw, SC.REGISTROS_MAP, SC.REGISTROS_COLUMNS)
    ids = ["OCID", "ID_ENTREGA", "ID_COMPRADOR_ORIGINAL", "ID_LICITACION",
           "ID_ENTIDAD_CONTRATANTE_ORIGINAL"]
    texts = [x for x in SC.REGISTROS_COLUMNS if x not in ids]
    c = _dates(_clean(c, ids, texts), "registros", votes)
    c = c.withColumns({
        "MONTO_LICITACION": N.parse_number(F.col("MONTO_LICITACION")),
        "MONTO_LICITACION_PEN": N.parse_number(F.col("MONTO_LICITACION_PEN")),
        "ID_COMPRADOR": F.col("ID_COMPRADOR_ORIGINAL"),
        "ID_ENTIDAD_CONTRATANTE": F.col("ID_ENTIDAD_CONTRATANTE_ORIGINAL"),
        "RUC_COMPRADOR": R.extract_ruc(F.col("ID_COMPRADOR_ORIGINAL")),
        "RUC_ENTIDAD_CONTRATANTE": R.extract_ruc(F.col("ID_ENTIDAD_CONTRATANTE_ORIGINAL")),
        "NOMBRE_COMPRADOR_ESTANDAR": T.standard_name(F.col("NOMBRE_COMPRADOR_ORIGINAL")),
        "NOMBRE_ENTIDAD_ESTANDAR": T.standard_name(F.col("NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL")),
    })
    c = c.withColumns({
        "RUC_COMPRADOR_VALIDO": R.validate_ruc(F.col("RUC_COMPRADOR")),
        "RUC_ENTIDAD_VALIDO": R.validate_ruc(F.col("RUC_ENTIDAD_CONTRATANTE")),
    })
    staged = c.filter(F.col("OCID").isNotNull() & F.col("ID_ENTREGA").isNotNull()) \
        .withColumn("CLAVE_REGISTRO", K.pipe_key(F.col("OCID"), F.col("ID_ENTREGA")))
    staged = _with_dup(staged, "CLAVE_REGISTRO", cut)
    return staged, file_controls("registros", staged, raw)


def stage_contratos(raw: DataFrame, votes: DataFrame | None = None,
                    cut: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    c = conform(raw, SC.CONTRATOS_MAP, SC.CONTRATOS_COLUMNS)
    ids = ["OCID", "ID_ENTREGA", "ID_CONTRATO", "ID_ADJUDICACION"]
    texts = ["TITULO_CONTRATO", "DESCRIPCION_CONTRATO", "MONEDA_CONTRATO",
             "NOMBRE_MONEDA_CONTRATO", "MONEDA_FINAL", "NOMBRE_MONEDA_FINAL"]
    c = _dates(_clean(c, ids, texts), "contratos", votes)
    c = c.withColumns({n: N.parse_number(F.col(n)) for n in
                       ["DURACION_DIAS", "MONTO_CONTRATO", "MONTO_FINAL"]})
    staged = c.filter(F.col("OCID").isNotNull() & F.col("ID_CONTRATO").isNotNull()) \
        .withColumn("CLAVE_CONTRATO", K.pipe_key(F.col("OCID"), F.col("ID_CONTRATO")))
    staged = _with_dup(staged, "CLAVE_CONTRATO", cut)
    return staged, file_controls("contratos", staged, raw)


def stage_proveedores(raw: DataFrame, votes: DataFrame | None = None,
                      cut: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    c = conform(raw, SC.PROVEEDORES_MAP, SC.PROVEEDORES_COLUMNS)
    ids = ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "ID_PROVEEDOR_ORIGINAL"]
    c = _clean(c, ids, ["NOMBRE_PROVEEDOR_ORIGINAL"])
    c = c.withColumns({
        "ID_PROVEEDOR": F.col("ID_PROVEEDOR_ORIGINAL"),
        "RUC_PROVEEDOR": R.extract_ruc(F.col("ID_PROVEEDOR_ORIGINAL")),
        "NOMBRE_PROVEEDOR_ESTANDAR": T.standard_name(F.col("NOMBRE_PROVEEDOR_ORIGINAL")),
    })
    c = c.withColumn("RUC_PROVEEDOR_VALIDO", R.validate_ruc(F.col("RUC_PROVEEDOR")))
    ok = (F.col("OCID").isNotNull() & F.col("ID_ENTREGA").isNotNull()
          & F.col("ID_ADJUDICACION").isNotNull() & F.col("ID_PROVEEDOR").isNotNull())
    staged = c.filter(ok).withColumn(
        "CLAVE_PROVEEDOR_ADJUDICACION",
        K.pipe_key(F.col("OCID"), F.col("ID_ADJUDICACION"), F.col("ID_PROVEEDOR")))
    staged = _with_dup(staged, "CLAVE_PROVEEDOR_ADJUDICACION", cut)
    return staged, file_controls("proveedores", staged, raw)


def stage_partes(raw: DataFrame, votes: DataFrame | None = None,
                 cut: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    c = conform(raw, SC.PARTES_MAP, SC.PARTES_COLUMNS)
    ids = ["OCID", "ID_ENTREGA", "ID_ORGANIZACION", "IDENTIFICADOR_PRINCIPAL"]
    texts = [x for x in SC.PARTES_COLUMNS if x not in ids]
    c = _clean(c, ids, texts)
    name = F.coalesce(F.col("NOMBRE_LEGAL_ORIGINAL"), F.col("NOMBRE_COMUN_ORIGINAL"))
    c = c.withColumns({
        "NOMBRE_ORGANIZACION_ORIGINAL": name,
        "NOMBRE_ORGANIZACION_ESTANDAR": T.catalog_value(name),
        "RUC_ORGANIZACION": R.ruc_from(F.col("IDENTIFICADOR_PRINCIPAL"), F.col("ID_ORGANIZACION")),
        **{f"{g}_ESTANDAR": T.catalog_value(F.col(f"{g}_ORIGINAL"))
           for g in ["DIRECCION", "LOCALIDAD", "REGION", "DEPARTAMENTO", "PAIS", "ROLES"]},
    })
    c = c.withColumns({
        "RUC_VALIDO": R.validate_ruc(F.col("RUC_ORGANIZACION")),
        "ES_COMPRADOR_O_ENTIDAD": T.is_buyer_role(F.col("ROLES_ESTANDAR")),
        "ES_PROVEEDOR": T.is_supplier_role(F.col("ROLES_ESTANDAR")),
    })
    ok = (F.col("OCID").isNotNull() & F.col("ID_ENTREGA").isNotNull()
          & (F.col("ID_ORGANIZACION").isNotNull() | F.col("IDENTIFICADOR_PRINCIPAL").isNotNull()
             | F.col("NOMBRE_ORGANIZACION_ORIGINAL").isNotNull()))
    c = c.filter(ok)
    part_id = F.coalesce(F.col("ID_ORGANIZACION"), F.col("IDENTIFICADOR_PRINCIPAL"),
                         F.col("NOMBRE_ORGANIZACION_ESTANDAR"))
    staged = c.withColumns({
        "CLAVE_ORGANIZACION": K.org_key(F.col("RUC_ORGANIZACION"), F.col("ID_ORGANIZACION")),
        "CLAVE_PARTE": K.pipe_key(F.col("OCID"), F.col("ID_ENTREGA"), part_id),
    })
    staged = _with_dup(staged, "CLAVE_PARTE", cut)
    return staged, file_controls("partes", staged, raw)


STAGERS = {"registros": stage_registros, "contratos": stage_contratos,
           "proveedores": stage_proveedores, "partes": stage_partes}


def geo_catalog(partes: DataFrame) -> DataFrame:
    """SNK-8 input: distinct locations (all-NULL rows dropped), numbered 1..n
    in (country, department, region, locality) order, NULLs last."""
    from .warehouse import sequential_key
    cols = ["PAIS_ESTANDAR", "DEPARTAMENTO_ESTANDAR", "REGION_ESTANDAR", "LOCALIDAD_ESTANDAR"]
    g = partes.select(*cols).na.drop(how="all").dropDuplicates()
    return sequential_key(g, [F.col(c).asc_nulls_last() for c in cols], "UBICACION_KEY")
