"""Staging-shaped inputs derived from the driver's test tables.

The reference consumes monthly procurement packages; the test tables are a
TPC-H-like star.  These adapters re-express them in the staging vocabulary
so every curated/warehouse operator runs, unchanged, over the whole tables:

* contract versions   <- lineitem   (OCID = order, contract = line number,
                                      file period = ship month; keys repeat)
* procurement records <- orders     (+ republished / less complete copies)
* award suppliers     <- lineitem x supplier (two suppliers on line 1)
* parties             <- orders x customer x nation x region

NULLs are injected with fixed modulus rules so the fallback, completeness and
last-non-NULL logic has work to do.  The same rules are written in DuckDB SQL
in ``oracle_sql`` for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ruc as R
from ..functions import text as T
from ..session import dealt_by


def _null_s() -> Column:
    return F.lit(None).cast("string")


class Tables:
    """Lazy access to ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        # one relation per table: listing and footer reads happen once, and
        # repeated uses are recognisably the same scan to the optimizer
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _null_when(cond: Column, c: Column, dtype: str = "string") -> Column:
    return F.when(cond, F.lit(None).cast(dtype)).otherwise(c)


def synthetic_ruc(k: Column) -> Column:
    """11-digit taxpayer id '20' + 9-digit zero-padded key."""
    return F.concat(F.lit("20"), F.lpad(k.cast("string"), 9, "0"))


def _period(ts: Column) -> tuple[Column, Column]:
    return F.year(ts).cast("int"), F.month(ts).cast("int")


def _file(ts: Column) -> Column:
    return F.concat(F.lit("paquete_"), F.date_format(ts, "yyyyMM"), F.lit(".xlsx"))


def _line_ocid() -> Column:
    """The order's number; lines of every 13th part belong to processes that
    no record tells of (a number of their own)."""
    ok = F.col("l_orderkey").cast("string")
    return F.when(F.col("l_partkey") % 13 == 0, F.concat(F.lit("SR-"), ok)).otherwise(ok)


CONTRACT_COLUMNS = [
    "OCID", "ID_ENTREGA", "ID_CONTRATO", "ID_ADJUDICACION", "TITULO_CONTRATO",
    "DESCRIPCION_CONTRATO", "FECHA_INICIO", "FECHA_FIN", "DURACION_DIAS",
    "MONTO_CONTRATO", "MONEDA_CONTRATO", "NOMBRE_MONEDA_CONTRATO", "FECHA_FIRMA",
    "MONTO_FINAL", "MONEDA_FINAL", "NOMBRE_MONEDA_FINAL", "FECHA_FIN_IMPLEMENTACION",
    "CLAVE_CONTRATO", "ANIO_ARCHIVO", "MES_ARCHIVO", "ARCHIVO_ORIGEN"]


def stg_contratos(t: Tables, dealt: bool = False) -> DataFrame:
    """Contract versions; ``dealt``: dealt out by OCID while the rows are narrow."""
    l = t("lineitem")
    if dealt:
        l = dealt_by(l, _line_ocid())
    ship = F.col("l_shipdate")
    pk = F.col("l_partkey")
    cur = (F.when(F.col("l_returnflag") == "A", "PEN")
           .when(F.col("l_returnflag") == "R", "USD").otherwise(_null_s()))
    cur_name = (F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "Soles")
                .when(F.col("l_returnflag") == "A", "soles ")
                .when(F.col("l_returnflag") == "R", "Dolares")
                .when(F.col("l_linestatus") == "F", "Euro").otherwise(_null_s()))
    fin = F.expr("timestampadd(DAY, CAST(l_quantity AS INT), l_shipdate)")
    y, m = _period(ship)
    ocid = _line_ocid()
    idc = F.col("l_linenumber").cast("string")
    return l.select(
        ocid.alias("OCID"),
        F.col("l_linestatus").alias("ID_ENTREGA"),
        idc.alias("ID_CONTRATO"),
        F.col("l_suppkey").cast("string").alias("ID_ADJUDICACION"),
        F.concat(F.lit("PARTE "), pk.cast("string")).alias("TITULO_CONTRATO"),
        _null_when(pk % 11 == 0, F.concat(F.lit("item "), pk.cast("string"), F.lit(" qty "),
                                          F.col("l_quantity").cast("bigint").cast("string")))
        .alias("DESCRIPCION_CONTRATO"),
        _null_when(pk % 7 == 0, ship + F.expr("INTERVAL 1 DAY"), "timestamp_ntz")
        .alias("FECHA_INICIO"),
        fin.alias("FECHA_FIN"),
        F.col("l_quantity").alias("DURACION_DIAS"),
        F.col("l_extendedprice").alias("MONTO_CONTRATO"),
        cur.alias("MONEDA_CONTRATO"),
        cur_name.alias("NOMBRE_MONEDA_CONTRATO"),
        _null_when(pk % 5 == 0, ship, "timestamp_ntz").alias("FECHA_FIRMA"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("MONTO_FINAL"),
        cur.alias("MONEDA_FINAL"),
        cur_name.alias("NOMBRE_MONEDA_FINAL"),
        fin.alias("FECHA_FIN_IMPLEMENTACION"),
        F.concat(ocid, F.lit("|"), idc).alias("CLAVE_CONTRATO"),
        y.alias("ANIO_ARCHIVO"), m.alias("MES_ARCHIVO"),
        _file(ship).alias("ARCHIVO_ORIGEN"))


RECORD_COLUMNS = [
    "OCID", "ID_ENTREGA", "FECHA_ENTREGA", "FECHA_PUBLICACION", "ID_COMPRADOR",
    "NOMBRE_COMPRADOR_ORIGINAL", "RUC_COMPRADOR", "RUC_COMPRADOR_VALIDO",
    "NOMBRE_COMPRADOR_ESTANDAR", "ID_ENTIDAD_CONTRATANTE",
    "NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL", "RUC_ENTIDAD_CONTRATANTE",
    "RUC_ENTIDAD_VALIDO", "NOMBRE_ENTIDAD_ESTANDAR", "ID_LICITACION",
    "TITULO_LICITACION", "DESCRIPCION_LICITACION", "METODO_CONTRATACION",
    "DETALLE_METODO_CONTRATACION", "CATEGORIA_PRINCIPAL", "MONTO_LICITACION",
    "MONEDA_LICITACION", "NOMBRE_MONEDA_LICITACION", "ANIO_ARCHIVO", "MES_ARCHIVO",
    "ARCHIVO_ORIGEN"]


def stg_registros(t: Tables, dealt: str | None = None) -> DataFrame:
    """Records: every order (v0), a republished next-month copy of every third
    order with tender id and category blanked (v1), and a same-month, less
    complete copy of every seventh order (v2).

    The copies are produced by exploding a version tag, so ``orders`` is
    scanned once and all versions share one projection.  ``dealt`` (OCID or
    a column of ``orders``): dealt out by it before that.
    """
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           "o_orderdate", "o_orderpriority")
    if dealt == "OCID":
        o = dealt_by(o.withColumn("OCID", F.col("o_orderkey").cast("string")), "OCID")
    elif dealt:
        o = dealt_by(o, dealt)
    ocid = F.col("OCID") if dealt == "OCID" else F.col("o_orderkey").cast("string")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    od = F.col("o_orderdate")
    tags = F.explode(F.array(F.lit(0), F.when(ok % 3 == 0, F.lit(1)),
                             F.when(ok % 7 == 0, F.lit(2))))
    o = o.select("*", tags.alias("_v")).filter(F.col("_v").isNotNull())
    v = F.col("_v")
    fdate = F.when(v == 1, F.add_months(od, 1).cast("timestamp_ntz")).otherwise(od)
    y, m = _period(fdate)
    buyer = _null_when(ok % 3 == 0, ck.cast("string"))
    entity = _null_when(ok % 5 == 0, ck.cast("string"))
    b_ruc = _null_when((ok % 3 == 0) | (ck % 4 == 0), synthetic_ruc(ck))
    e_ruc = _null_when((ok % 5 == 0) | (ck % 4 == 0), synthetic_ruc(ck))
    b_name = _null_when(ok % 3 == 0, F.concat(F.lit("Comprador "), ck.cast("string")))
    e_name = _null_when((ok % 5 == 0) | (ok % 11 == 1),
                        F.concat(F.lit("Entidad N° "), ck.cast("string")))
    lic = _null_when((v == 1) | (ok % 9 == 0), F.concat(F.lit("LIC-"), ok.cast("string")))
    cat = (F.when(F.col("o_orderstatus") == "F", "bienes")
           .when(F.col("o_orderstatus") == "O", "Bienes ").otherwise("servicios"))
    cat = _null_when((v == 1) | (ok % 8 == 0), cat)
    method = _null_when((v == 2) | (ok % 10 == 0), F.col("o_orderpriority"))
    base = o.select(
        ocid.alias("OCID"),
        F.col("o_orderstatus").alias("ID_ENTREGA"),
        _null_when(ok % 4 == 0, od, "timestamp_ntz").alias("FECHA_ENTREGA"),
        (od - F.expr("INTERVAL 2 DAYS")).alias("FECHA_PUBLICACION"),
        buyer.alias("ID_COMPRADOR"),
        b_name.alias("NOMBRE_COMPRADOR_ORIGINAL"),
        b_ruc.alias("RUC_COMPRADOR"),
        entity.alias("ID_ENTIDAD_CONTRATANTE"),
        e_name.alias("NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL"),
        e_ruc.alias("RUC_ENTIDAD_CONTRATANTE"),
        lic.alias("ID_LICITACION"),
        F.concat(F.lit("Licitacion "), ok.cast("string")).alias("TITULO_LICITACION"),
        _null_when(ok % 2 == 1, F.concat(F.lit("Compra de "), F.col("o_orderpriority")))
        .alias("DESCRIPCION_LICITACION"),
        method.alias("METODO_CONTRATACION"),
        _null_when(ok % 2 == 1, F.lower(F.col("o_orderpriority")))
        .alias("DETALLE_METODO_CONTRATACION"),
        cat.alias("CATEGORIA_PRINCIPAL"),
        F.col("o_totalprice").alias("MONTO_LICITACION"),
        F.lit("PEN").alias("MONEDA_LICITACION"),
        F.lit("Soles").alias("NOMBRE_MONEDA_LICITACION"),
        y.alias("ANIO_ARCHIVO"), m.alias("MES_ARCHIVO"),
        _file(fdate).alias("ARCHIVO_ORIGEN"))
    derived = {
        "RUC_COMPRADOR_VALIDO": R.validate_ruc(F.col("RUC_COMPRADOR")),
        "NOMBRE_COMPRADOR_ESTANDAR": T.standard_name(F.col("NOMBRE_COMPRADOR_ORIGINAL")),
        "RUC_ENTIDAD_VALIDO": R.validate_ruc(F.col("RUC_ENTIDAD_CONTRATANTE")),
        "NOMBRE_ENTIDAD_ESTANDAR": T.standard_name(F.col("NOMBRE_ENTIDAD_CONTRATANTE_ORIGINAL")),
    }
    return base.select(*[derived[c].alias(c) if c in derived else F.col(c)
                         for c in RECORD_COLUMNS])


SUPPLIER_COLUMNS = ["OCID", "ID_ENTREGA", "ID_ADJUDICACION", "ID_PROVEEDOR",
                    "NOMBRE_PROVEEDOR_ORIGINAL", "RUC_PROVEEDOR", "RUC_PROVEEDOR_VALIDO",
                    "NOMBRE_PROVEEDOR_ESTANDAR", "ANIO_ARCHIVO", "MES_ARCHIVO",
                    "ARCHIVO_ORIGEN"]


def stg_proveedores(t: Tables, dealt: bool = False) -> DataFrame:
    """Award suppliers: the line's supplier, plus supplier+1 (lower-case
    spelling) on line 1 -- two suppliers per award, two spellings.  ``dealt``:
    dealt out by OCID while the rows are narrow."""
    l = t("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus",
                             "l_shipdate", "l_partkey")
    if dealt:
        l = dealt_by(l, _line_ocid())
    # one scan: the line's supplier, plus supplier+1 on line 1 (second spelling)
    target = F.explode(F.array(
        F.struct(F.col("l_suppkey").alias("k"), F.lit(False).alias("alt")),
        F.when(F.col("l_linenumber") == 1,
               F.struct((F.col("l_suppkey") + 1).alias("k"), F.lit(True).alias("alt")))))
    l = l.select("*", target.alias("_t")).filter(F.col("_t").isNotNull())
    sk = F.col("s_suppkey")
    # what the supplier alone determines is worked out once a supplier, not once a line
    s = t("supplier").select("s_suppkey", "s_name", F.lower("s_name").alias("_alt_name"),
                             _null_when(sk % 6 == 0, synthetic_ruc(sk)).alias("_ruc"))
    s = s.withColumns({"_valid": R.validate_ruc(F.col("_ruc")), "_std": T.standard_name(F.col("s_name")),
                       "_alt_std": T.standard_name(F.col("_alt_name"))})
    both = l.join(s, F.col("_t.k") == F.col("s_suppkey"), "inner")
    alt = F.col("_t.alt")
    y, m = _period(F.col("l_shipdate"))
    return both.select(
        _line_ocid().alias("OCID"),
        F.col("l_linestatus").alias("ID_ENTREGA"),
        F.col("l_suppkey").cast("string").alias("ID_ADJUDICACION"),
        sk.cast("string").alias("ID_PROVEEDOR"),
        F.when(alt, F.col("_alt_name")).otherwise(F.col("s_name")).alias("NOMBRE_PROVEEDOR_ORIGINAL"),
        F.col("_ruc").alias("RUC_PROVEEDOR"),
        F.col("_valid").alias("RUC_PROVEEDOR_VALIDO"),
        F.when(alt, F.col("_alt_std")).otherwise(F.col("_std")).alias("NOMBRE_PROVEEDOR_ESTANDAR"),
        y.alias("ANIO_ARCHIVO"), m.alias("MES_ARCHIVO"),
        _file(F.col("l_shipdate")).alias("ARCHIVO_ORIGEN")).select(*SUPPLIER_COLUMNS)


def stg_partes(t: Tables, dealt: bool = False) -> DataFrame:
    """Parties: the buying organisation of every order with its geography.
    nation/region are fixed-size TPC-H tables (25 and 5 rows), so they are
    broadcast explicitly; customer is joined normally (AQE decides).  ``dealt``:
    dealt out by customer while the rows are narrow."""
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if dealt:
        o = dealt_by(o, "o_custkey")
    ok, ck = F.col("o_orderkey"), F.col("c_custkey")
    ruc = F.col("_ruc")
    # what the customer alone determines is worked out once a customer, not once an order
    c = t("customer").select("c_custkey", "c_name", "c_nationkey", T.catalog_value(F.col("c_mktsegment")).alias("_segment"),
                             T.standard_name(F.col("c_name")).alias("_std"),
                             _null_when(ck % 4 == 0, synthetic_ruc(ck)).alias("_ruc"))
    c = c.withColumn("_valid", R.validate_ruc(ruc))
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select("r_regionkey", "r_name")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
         .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
         .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "inner"))
    ident = ck.cast("string")
    y, m = _period(F.col("o_orderdate"))
    roles = (F.when(ck % 4 == 0, "buyer, procuringEntity").when(ck % 4 == 1, "supplier")
             .when(ck % 4 == 2, "Proveedor / Comprador").otherwise(_null_when(ok % 2 == 0, F.lit("tenderer"))))
    roles_std = T.catalog_value(roles)
    return j.select(
        ok.cast("string").alias("OCID"),
        F.lit("F").alias("ID_ENTREGA"),
        ident.alias("ID_ORGANIZACION"),
        ruc.alias("RUC_ORGANIZACION"),
        F.col("c_name").alias("NOMBRE_ORGANIZACION_ORIGINAL"),
        F.col("_std").alias("NOMBRE_ORGANIZACION_ESTANDAR"),
        _null_when(ok % 4 == 1, F.col("_segment")).alias("DIRECCION_ESTANDAR"),
        _null_when(ck % 5 == 0, F.concat(F.lit("LOC "), (ck % 17).cast("string")))
        .alias("LOCALIDAD_ESTANDAR"),
        _null_when(ok % 6 == 0, F.col("r_name")).alias("REGION_ESTANDAR"),
        F.col("n_name").alias("DEPARTAMENTO_ESTANDAR"),
        F.lit("PERU").alias("PAIS_ESTANDAR"),
        roles.alias("ROLES_ORIGINAL"),
        roles_std.alias("ROLES_ESTANDAR"),
        T.is_buyer_role(roles_std).alias("ES_COMPRADOR_O_ENTIDAD"),
        T.is_supplier_role(roles_std).alias("ES_PROVEEDOR"),
        F.when(ruc.isNotNull(), F.concat(F.lit("RUC|"), ruc))
        .otherwise(F.concat(F.lit("ID|"), ident)).alias("CLAVE_ORGANIZACION"),
        y.alias("ANIO_ARCHIVO"), m.alias("MES_ARCHIVO"), F.col("_valid").alias("RUC_VALIDO"))
