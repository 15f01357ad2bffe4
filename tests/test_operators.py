"""Operators on small hand-made tables: versions, keys, incremental load."""

import datetime as dt
import random

from pyspark.sql import functions as F

from licita.operators import incremental as I
from licita.operators import star as S
from licita.operators import warehouse as W
from licita.operators.versions import duplicate_flag, last_non_null, latest_by


def test_latest_by_order_nulls_and_ties(spark):
    rows = [("k1", 2024, 1, "a"), ("k1", 2024, 2, "b"), ("k1", 2024, 2, "c"),
            ("k2", None, 1, "x"), ("k2", 2023, 1, "y"), (None, 2030, 1, "z")]
    df = spark.createDataFrame(rows, "k string, y int, m int, v string")
    got = {r.k: r.v for r in latest_by(df, ["k"], [F.col("y"), F.col("m")]).collect()}
    # newest period wins, a full tie is broken by the remaining columns (desc),
    # NULL orders last, NULL keys are dropped
    assert got == {"k1": "c", "k2": "y"}


def test_latest_by_is_shuffle_invariant(spark):
    rows = [(k % 7, random.Random(k).randint(0, 3), k) for k in range(300)]
    a = spark.createDataFrame(rows, "k int, o int, v int")
    b = spark.createDataFrame(list(reversed(rows)), "k int, o int, v int").repartition(5)
    pick = lambda d: sorted(tuple(r) for r in latest_by(d, ["k"], [F.col("o")]).collect())
    assert pick(a) == pick(b)


def test_last_non_null_differs_from_max_by(spark):
    rows = [("o", 1, "old"), ("o", 2, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    r = df.groupBy("k").agg(last_non_null("v", F.col("o"), "lnn"),
                            F.max_by("v", "o").alias("mb")).first()
    assert (r.lnn, r.mb) == ("old", None)


def test_duplicate_flag_keeps_all_members(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    got = sorted((r.k or "", r.ES_DUPLICADO_CLAVE) for r in duplicate_flag(df, ["k"]).collect())
    assert got == [("", False), ("a", True), ("a", True), ("b", False)]


def test_org_master_mixes_sources_by_last_non_null(spark):
    cand = spark.createDataFrame([
        ("RUC|1", "1", "1", True, "Old", "OLD", "Lima", 1, 0, 2024, 1, 3, 5),
        ("RUC|1", "1", "1", True, None, None, None, 0, 1, 2024, 2, 1, 2)],
        "CLAVE_ORGANIZACION string, ID_ORGANIZACION_ORIGINAL string, RUC string, RUC_VALIDO boolean,"
        " NOMBRE_ORIGINAL string, NOMBRE_ESTANDAR string, DEPARTAMENTO string, ES_ENTIDAD int,"
        " ES_PROVEEDOR int, ANIO_ARCHIVO int, MES_ARCHIVO int, PRIORIDAD_FUENTE int, COMPLETITUD int")
    for c in ["DIRECCION", "LOCALIDAD", "REGION", "PAIS"]:
        cand = cand.withColumn(c, F.lit(None).cast("string"))
    r = S.dim_organizacion(cand).first()
    assert (r.NOMBRE_ORIGINAL, r.TIPO_ORGANIZACION, r.PERIODO_PRIMERA_APARICION,
            r.PERIODO_ULTIMA_APARICION) == ("Old", "ENTIDAD_Y_PROVEEDOR", 202401, 202402)
    assert r.CLAVE_UBICACION is not None


def test_sequential_key_consecutive(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = W.sequential_key(df, ["k"], "SK").collect()
    got = sorted((r.k, r.SK) for r in out)
    assert [s for _, s in got] == list(range(1, 5001))
    assert all(k + 1 == s for k, s in got)


def test_with_surrogate_keeps_existing_keys(spark):
    old = spark.createDataFrame([("b", 10), ("z", 3)], "bk string, key long")
    dim = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "w")], "bk string, attr string")
    got = {r.bk: r.key for r in W.with_surrogate(dim, "bk", "key", existing=old).collect()}
    assert got == {"b": 10, "z": 3, "a": 11, "c": 12}


def test_upsert_classify_idempotent_and_scd2(spark):
    tgt = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "k int, HASH_FILA string")
    src = spark.createDataFrame([(1, "h1"), (2, "h2x"), (4, "h4")], "k int, HASH_FILA string")
    acts = {r.k: r.ACCION for r in I.classify_changes(tgt, src, ["k"]).collect()}
    assert acts == {1: I.UNCHANGED, 2: I.UPDATE, 3: I.ABSENT, 4: I.INSERT}
    after = I.apply_upsert(tgt, src, ["k"])
    counts = {r.ACCION: r.FILAS for r in I.action_counts(I.classify_changes(after, src, ["k"])).collect()}
    assert counts[I.INSERT] == 0 and counts[I.UPDATE] == 0
    hist = spark.createDataFrame([(1, "h1", dt.date(2024, 1, 1), None, 1),
                                  (2, "h2", dt.date(2024, 1, 1), None, 1)],
                                 "k int, HASH_FILA string, FECHA_DESDE date, FECHA_HASTA date, EJECUCION_ID int")
    h = I.scd2(hist, src.withColumn("x", F.lit(0)).drop("x"), ["k"], 2, F.lit(dt.date(2024, 2, 1)))
    rows = sorted((r.k, r.HASH_FILA, str(r.FECHA_HASTA)) for r in h.collect())
    assert rows == [(1, "h1", "None"), (2, "h2", "2024-02-01"), (2, "h2x", "None"), (4, "h4", "None")]


def test_soft_delete_needs_confirmation(spark):
    state = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "k int, AUSENCIAS_CONSECUTIVAS int")
    present = spark.createDataFrame([(1,), (4,)], "k int")
    got = {r.k: (r.AUSENCIAS_CONSECUTIVAS, r.VIGENTE) for r in I.soft_delete(state, present, "k").collect()}
    assert got == {1: (0, True), 2: (2, False), 3: (1, True), 4: (0, True)}


def test_prorate_adds_up_exactly(spark):
    c = spark.createDataFrame([(1, 100.0), (2, 0.01), (3, 337955.91)], "k int, amt double")
    links = spark.createDataFrame([(1, s) for s in range(3)] + [(2, s) for s in range(7)]
                                  + [(3, s) for s in range(8)], "k int, p int")
    p = I.prorate(c, links, "k", "amt", "p")
    assert {r.k: float(r.DIFERENCIA) for r in I.proration_check(p, "k").collect()} == {1: 0.0, 2: 0.0, 3: 0.0}


def test_rebuild_bridge_only_affected(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, s string")
    new = spark.createDataFrame([(1, "a"), (1, "d"), (2, "z")], "k int, s string")
    aff = spark.createDataFrame([(1,)], "k int")
    assert sorted(tuple(r) for r in I.rebuild_bridge(old, new, aff, "k").collect()) == \
        [(1, "a"), (1, "d"), (2, "c")]


def test_schema_checks(spark):
    from licita.operators import schema_checks as SC
    miss = SC.missing_columns(spark, ["ocid", " ID  de Entrega "], ["OCID", "ID de Entrega", "Monto"],
                              "Ent_Contratos", True).collect()
    assert [(r.COLUMNA, r.SEVERIDAD) for r in miss] == [("Monto", "ERROR")]
    d = SC.header_differences(spark, {"a": ["x", "y z"], "b": ["X", "y  z"], "c": ["x", "w", "v"]})
    assert sorted(tuple(r) for r in d.collect()) == [("c", 2, "Y_Z", "W"), ("c", 3, None, "V")]
    f1 = spark.createDataFrame([("1", "a"), (None, " ")], "`Col A` string, b string")
    f2 = spark.createDataFrame([("2", "b")], "`col a` string, B string")
    rows, counts = SC.append_checked({"f1": f1, "f2": f2})
    assert rows.count() == 2
    assert {r.ARCHIVO_ORIGEN: (r.FILAS_LEIDAS, r.FILAS_VACIAS) for r in counts.collect()} == \
        {"f1": (2, 1), "f2": (1, 0)}
