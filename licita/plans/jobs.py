"""End-to-end jobs: landing files -> staging -> curated -> warehouse.

Each job is a sequence of DataFrame writes; the driver only handles file
lists, manifests and scalar results.  Layout:

    landing/{YYYY}/{MM}/extraido/<name>_<Sheet>.csv     (one file per sheet)
    staging/{registros,contratos,proveedores,partes}/anio=YYYY/mes=MM/
    curated/<table>/                                      (ZSTD Parquet, + pipe CSV)
    dw/v=<run>/<table>/  and  dw/_CURRENT                 (published version pointer)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import quality as Q
from ..operators import schema_checks as SCH
from ..operators import staging as ST
from ..operators import star as S
from ..operators import warehouse as W
from ..session import compiled_code, materialise, release_scratch, scratch_mark
from ..sources import landing as L
from ..sources import manifest as M
from ..sources import schemas as SC
from ..sources import sinks as SK

DATASETS = ["registros", "contratos", "proveedores", "partes"]
CURATED_TABLES = ["fact_contrato_actual", "bridge_contrato_proveedor", "dim_organizacion",
                  "dim_entidad", "dim_proveedor", "dim_ubicacion", "dim_moneda", "dim_categoria",
                  "dim_metodo", "dim_fecha"]


def _now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _listing(spark: SparkSession, root: str, glob: str, manifest: DataFrame) -> DataFrame:
    """RUTA, BYTES, MODIFICADO, SHA256 of the landing files.  Only files whose
    length or time differ from the manifest are read for their hash."""
    files = L.list_files(spark, root, glob).select(
        F.col("path").alias("RUTA"), F.col("length").alias("BYTES"), F.col("modificationTime").alias("MODIFICADO"))
    known = files.join(manifest.select("RUTA", "BYTES", "MODIFICADO", "SHA256"), ["RUTA", "BYTES", "MODIFICADO"], "left")
    fresh = [r.RUTA for r in known.filter("SHA256 is null").select("RUTA").collect()]
    if not fresh:
        return known
    hashed = M.file_hashes(spark.read.format("binaryFile").load(fresh)).select(
        "RUTA", F.col("SHA256").alias("_nuevo"))
    return known.join(hashed, "RUTA", "left").select(
        "RUTA", "BYTES", "MODIFICADO", F.coalesce("SHA256", "_nuevo").alias("SHA256"))


UNREADABLE = "[\\x00\ufffd]"  # what bytes that are no text turn into


def _good_and_bad(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a written sheet that can be staged, and the others with a reason."""
    cells = [c for c in sheet.columns if c not in (L.BAD, L.PATH, *SC.LINEAGE)]
    broken = F.col(L.BAD).isNotNull()
    line = F.concat_ws(",", *[F.col(f"`{c}`") for c in cells])
    reason = F.when(broken, "numero de celdas distinto del encabezado").when(
        line.rlike(UNREADABLE), "caracteres ilegibles")
    bad = sheet.withColumns({"MOTIVO": reason, "REGISTRO": F.coalesce(L.BAD, line)}).filter("MOTIVO is not null")
    return (sheet.filter(reason.isNull()).drop(L.BAD, L.PATH),
            bad.select(*SC.LINEAGE, F.col(L.PATH).alias("RUTA"), "MOTIVO", "REGISTRO"))


def _stage_dataset(spark: SparkSession, ds: str, sheet: DataFrame, staging_root: str) -> dict:
    """Writes one dataset's months, quarantine, date layouts and controls.  The
    landing files are parsed once, into a scratch table; the run's totals are
    observed as that table and the months are written."""
    read, wrote = Observation(f"{ds}-leidas"), Observation(f"{ds}-escritas")
    sheet = materialise(sheet.observe(read, F.count(F.lit(1)).alias("n")), f"sheet-{ds}")
    good, bad = _good_and_bad(sheet)
    run = {"DATASET": F.lit(ds), "REGISTRADO_EN": F.lit(_now())}
    SK.append_history(bad.withColumns(run), f"{staging_root}/_cuarentena")
    votes = ST.date_votes(ds, good)
    if votes is not None:
        votes = materialise(votes, f"layouts-{ds}")
        SK.append_history(votes.withColumns(run), f"{staging_root}/_disposicion")
    staged, _ = ST.STAGERS[ds](good, votes, lambda df: materialise(df, f"clean-{ds}"))
    SK.write_months(staged.observe(wrote, F.count(F.lit(1)).alias("n"), F.count_if("ES_DUPLICADO_CLAVE").alias("d")),
                    f"{staging_root}/{ds}")
    # the controls read what was written, of these months alone
    written = L.read_staging(spark, f"{staging_root}/{ds}").join(
        good.select("ANIO_ARCHIVO", "MES_ARCHIVO").distinct(), ["ANIO_ARCHIVO", "MES_ARCHIVO"], "left_semi")
    rejected = bad.groupBy(*ST.FILE_KEYS).agg(F.count(F.lit(1)).alias("FILAS_CUARENTENA"))
    controls = ST.file_controls(ds, written, sheet).join(rejected, ST.FILE_KEYS, "left").withColumns({
        "FILAS_CUARENTENA": F.coalesce("FILAS_CUARENTENA", F.lit(0).cast("bigint")),
        "FILAS_DESCARTADAS": F.col("FILAS_DESCARTADAS") - F.coalesce("FILAS_CUARENTENA", F.lit(0).cast("bigint"))})
    controls = materialise(controls.withColumn("PROCESADO_EN", F.lit(_now())), f"controls-{ds}")
    SK.append_history(controls, f"{staging_root}/_control")
    kept = controls.agg(F.sum("FILAS_CUARENTENA").alias("c"), F.sum("FILAS_DESCARTADAS").alias("x")).first()
    return {"DATASET": ds, "FILAS_LEIDAS": read.get["n"], "FILAS_ESCRITAS": wrote.get["n"], "FILAS_CUARENTENA": kept.c,
            "FILAS_DESCARTADAS": kept.x, "CLAVES_DUPLICADAS": wrote.get["d"]}


ROWS_SCHEMA = ("DATASET string, FILAS_LEIDAS bigint, FILAS_ESCRITAS bigint, FILAS_CUARENTENA bigint, "
               "FILAS_DESCARTADAS bigint, CLAVES_DUPLICADAS bigint")


def run_staging(spark: SparkSession, landing_root: str, staging_root: str, force: bool = False,
                fmt: str = "csv", multi_line: bool = True, first_year: int = SC.FIRST_YEAR,
                last_year: int | None = None) -> DataFrame:
    """Staging build (entry 1).  A month with a new or changed file is restaged
    from all of its files and replaced (SNK-1), so files that did not change
    keep their rows.  Invalid paths and unreadable files are recorded, not
    fatal (INC-3); a month with a file whose header cannot be read is left as it
    was; of a file broken further down only the bad lines are lost, to
    ``_cuarentena``, with their file and reason (INC-10).  Controls and run
    history are appended (AGG-10, SNK-6), the run's totals to ``_ejecucion``
    (AGG-19), and the manifest is saved after each dataset.  Returns the per-file
    result table."""
    manifest_path = f"{staging_root}/_manifest"
    manifest = M.read_manifest(spark, manifest_path)
    results, totals, mark, started = [], [], scratch_mark(), _now()
    for ds in DATASETS:
        listed = _listing(spark, landing_root, f"*{SC.SHEETS[ds]}.{fmt}", manifest)
        changes = M.changed_inputs(listed, manifest, force=force).withColumns({
            "VALIDA": L.valid_period(F.col("RUTA"), first_year, last_year),
            "MES": F.concat_ws("-", F.regexp_extract("RUTA", L.PATH_PERIOD, 1),
                               F.regexp_extract("RUTA", L.PATH_PERIOD, 2).try_cast("int"))})
        rows = changes.collect()  # one row per file (metadata)
        months = {r.MES for r in rows if r.PROCESAR and r.VALIDA}
        todo = [r for r in rows if r.VALIDA and r.MES in months]
        found, errors = L.headers(spark, [r.RUTA for r in todo], fmt) if todo else ({}, {})
        errors = {L._plain(q): e for q, e in errors.items()}
        bad = {r.RUTA: errors[L._plain(r.RUTA)] for r in todo if L._plain(r.RUTA) in errors}
        blocked = {r.MES for r in todo if r.RUTA in bad}
        todo = [r for r in todo if r.MES not in blocked]
        paths = {r.RUTA for r in todo}
        for r in rows:
            error = (None if r.VALIDA else "ruta sin anio / mes valido") or bad.get(r.RUTA)
            if error is None and r.PROCESAR and r.MES in blocked:
                error = "mes con un archivo ilegible: no se reemplaza"
            results.append((ds, r.RUTA, "ERROR" if error else r.ESTADO, r.RUTA in paths, error))
        if not todo:
            continue
        sheet = L.read_sheet(spark, sorted(paths), fmt, multi_line, found, keep_bad=True,
                             first_year=first_year, last_year=last_year)
        with compiled_code(spark):
            totals.append(_stage_dataset(spark, ds, sheet, staging_root))
        done = (changes.filter("VALIDA").filter(F.col("MES").isin(sorted({r.MES for r in todo})))
                .select("RUTA", "SHA256", F.lit(_now()).alias("PROCESADO_EN"),
                        F.array(F.lit(f"{staging_root}/{ds}")).alias("SALIDAS"), "BYTES", "MODIFICADO"))
        M.write_manifest(M.updated_manifest(manifest, done), manifest_path, f"{_now():%Y%m%d%H%M%S%f}")
        manifest = M.read_manifest(spark, manifest_path)
    out = spark.createDataFrame(results, "DATASET string, RUTA string, ESTADO string, "
                                         "PROCESADO boolean, ERROR string")
    SK.append_history(out.withColumn("EJECUTADO_EN", F.lit(_now())), f"{staging_root}/_historial")
    counted = spark.createDataFrame([tuple(t[c.split()[0]] for c in ROWS_SCHEMA.split(", ")) for t in totals], ROWS_SCHEMA)
    SK.append_history(SCH.run_summary(out, counted).withColumns(
        {"INICIO": F.lit(started), "FIN": F.lit(_now()), "FORZADO": F.lit(force)}), f"{staging_root}/_ejecucion")
    release_scratch(spark, mark)
    return out


def _current_tables(spark: SparkSession, staging_root: str, with_parties: bool) -> tuple:
    """Contracts, records by delivery and by process, suppliers (current versions)
    and the organisation master over the staging layer."""
    read = lambda name: L.read_staging(spark, f"{staging_root}/{name}")
    c, r, p = (read(t).drop("anio", "mes", "ES_DUPLICADO_CLAVE") for t in ("contratos", "registros", "proveedores"))
    by_delivery = S.current_records(r, ("OCID", "ID_ENTREGA"))
    # newest of the per-delivery winners (staging already drops records without
    # ID_ENTREGA, so no record is lost by starting from them)
    by_process = S.current_records(by_delivery, ("OCID",))
    org = S.dim_organizacion(S.org_candidates(read("partes") if with_parties else None, r, p))
    return S.current_contracts(c), by_delivery, by_process, S.current_suppliers(p), org


def _role_tables(org: DataFrame, fact: DataFrame, bridge: DataFrame) -> dict[str, DataFrame]:
    return {"dim_entidad": S.dim_entidad(org, fact), "dim_proveedor": S.dim_proveedor(org, bridge),
            "dim_ubicacion": S.dim_ubicacion(org), "dim_moneda": S.dim_moneda(fact),
            "dim_categoria": S.dim_categoria(fact), "dim_metodo": S.dim_metodo(fact),
            "dim_fecha": S.dim_fecha(fact, ["FECHA_FIRMA", "FECHA_INICIO", "FECHA_FIN"])}


def build_curated_tables(spark: SparkSession, staging_root: str,
                         with_parties: bool = True) -> dict[str, DataFrame]:
    """Curated model (entry 2) as DataFrames over the staging layer.  A missing
    table raises; a source without parties says so (``with_parties``)."""
    contracts, by_delivery, by_process, suppliers, org = _current_tables(spark, staging_root, with_parties)
    fact = S.fact_contrato(contracts, by_delivery, by_process, org)
    bridge = S.bridge_contrato_proveedor(contracts, suppliers)
    return {"fact_contrato_actual": fact, "bridge_contrato_proveedor": bridge, "dim_organizacion": org,
            **_role_tables(org, fact, bridge)}


def run_curated(spark: SparkSession, staging_root: str, curated_root: str,
                csv: bool = False, with_parties: bool = True) -> dict[str, DataFrame]:
    """Writes every curated table once (SNK-2/3) and reads them back: the fact is
    built on the written master, the bridge on the written fact's contracts, the
    rest, the quality step and the warehouse on the written tables."""
    contracts, by_delivery, by_process, suppliers, master = _current_tables(spark, staging_root, with_parties)
    out, timings = {}, []

    def write(name: str, df: DataFrame) -> DataFrame:
        t0 = _now()
        SK.export_table(df, f"{curated_root}/{name}", f"{curated_root}/csv/{name}" if csv else None)
        out[name] = spark.read.parquet(f"{curated_root}/{name}")
        timings.append((name, (_now() - t0).total_seconds()))
        return out[name]

    org = write("dim_organizacion", master)
    fact = write("fact_contrato_actual", S.fact_contrato(contracts, by_delivery, by_process, org))
    bridge = write("bridge_contrato_proveedor", S.bridge_contrato_proveedor(fact, suppliers))
    for name, df in _role_tables(org, fact, bridge).items():
        write(name, df)
    SK.export_table(SK.data_dictionary(spark, out), f"{curated_root}/_diccionario")
    SK.export_table(SK.relationships(spark), f"{curated_root}/_relaciones")
    # SNK-7: load summary (rows from footers, seconds per table)
    secs = spark.createDataFrame(timings, "TABLA string, SEGUNDOS double")
    SK.export_table(Q.table_counts(out).join(secs, "TABLA", "left"), f"{curated_root}/_carga")
    # SRC-9/SRC-10: the curated tables as views for SQL access
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out


def run_warehouse(spark: SparkSession, curated_root: str, dw_root: str) -> dict:
    """Warehouse build (entry 3) with validate-then-publish (INC-11, SNK-9):
    tables are written under a new version folder; only when the quality gate
    passes is the ``_CURRENT`` pointer moved to it.  A failed run leaves the
    previous version published and records ERROR in the control table."""
    started = _now()
    run = started.strftime("%Y%m%d%H%M%S%f")
    vdir = f"{dw_root}/v={run}"
    mark = scratch_mark()
    try:
        star = {t: spark.read.parquet(f"{curated_root}/{t}") for t in CURATED_TABLES}
        star["fact"] = star["fact_contrato_actual"]
        star["bridge"] = star["bridge_contrato_proveedor"]
        last = current_version(spark, dw_root)  # members and contracts of the last load keep their keys
        stored = {n: spark.read.parquet(f"{last}/{n}") for n in (*W.DIM_KEYS, "FactContrato")} if last else None
        dims = W.build_dims(star, stored)
        fact = W.with_contract_keys(
            W.fact_contrato_dw(star["fact_contrato_actual"], dims, star["dim_fecha"]),
            star["fact_contrato_actual"], stored and stored["FactContrato"])
        written = {}
        for name, df in {**dims, "DimFecha": W.dim_fecha_dw(star["dim_fecha"])}.items():
            df.write.mode("overwrite").parquet(f"{vdir}/{name}")
            written[name] = spark.read.parquet(f"{vdir}/{name}")
        fact.write.mode("overwrite").parquet(f"{vdir}/FactContrato")
        written["FactContrato"] = spark.read.parquet(f"{vdir}/FactContrato")
        bridge = W.bridge_dw(star["bridge_contrato_proveedor"], written["FactContrato"],
                             written["DimProveedor"])
        bridge.write.mode("overwrite").parquet(f"{vdir}/BridgeContratoProveedor")
        written["BridgeContratoProveedor"] = spark.read.parquet(f"{vdir}/BridgeContratoProveedor")
        checks = validate(written, star)
        ok = checks.agg(F.bool_and("CUMPLE")).first()[0]
        if not ok:
            raise RuntimeError("validaciones del modelo no superadas")
        spark.createDataFrame([(vdir, run)], "RUTA string, EJECUCION string") \
            .coalesce(1).write.json(f"{dw_root}/_CURRENT/v={run}")  # a marker of its own: never overwritten
        _control(spark, dw_root, started, "OK", "")
        return {"version": vdir, "tables": written, "checks": checks}
    except Exception as e:
        _control(spark, dw_root, started, "ERROR", str(e)[:4000])
        raise
    finally:
        release_scratch(spark, mark)  # what is returned reads the written tables


def validate(dw: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """DQ-3/4/5/7: unique keys, no orphans, row conservation (CONTROL/VALOR/CUMPLE)."""
    f, b = dw["FactContrato"], dw["BridgeContratoProveedor"]
    n = F.count(F.lit(1))

    def row(name, df):
        return df.select(F.lit(name).alias("CONTROL"), F.col("v").cast("bigint").alias("VALOR"),
                         (F.col("v") == 0).alias("CUMPLE"))
    cons = (star["fact_contrato_actual"].select(F.lit(1).alias("s"))
            .unionByName(f.select(F.lit(-1).alias("s"))).agg(F.sum("s").alias("v")))
    return Q.union_all([
        row("FactContrato clave duplicada", Q.duplicate_keys(f, ["ClaveContrato"]).agg(n.alias("v"))),
        row("Bridge clave duplicada",
            Q.duplicate_keys(b, ["ContratoKey", "ProveedorKey"]).agg(n.alias("v"))),
        row("Fact sin entidad valida", Q.orphans(f, "EntidadKey", dw["DimEntidad"], "EntidadKey", "x")
            .select(F.col("HUERFANOS").alias("v"))),
        row("Bridge sin proveedor valido",
            Q.orphans(b, "ProveedorKey", dw["DimProveedor"], "ProveedorKey", "x")
            .select(F.col("HUERFANOS").alias("v"))),
        row("Filas curated - dw", cons),
    ])


def _control(spark, dw_root, started, state, message):
    """SNK-9: one execution control row per run (appended)."""
    spark.createDataFrame([(started, _now(), state, message)],
                          "FECHA_INICIO timestamp, FECHA_FIN timestamp, ESTADO string, MENSAJE string") \
        .write.mode("append").parquet(f"{dw_root}/_control")


def current_version(spark: SparkSession, dw_root: str) -> str | None:
    """The version that was published last; None before the first."""
    try:
        marks = spark.read.schema("RUTA string, EJECUCION string").json(f"{dw_root}/_CURRENT")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    newest = marks.agg(F.max_by("RUTA", "EJECUCION")).first()
    return newest[0] if newest else None


__all__ = ["run_staging", "run_curated", "run_warehouse", "current_version"]
