"""Date layouts by vote, broken landing files, run totals and all-or-nothing streams."""

import os

import pytest
from pyspark.sql import functions as F

from licita.operators import layouts as LY
from licita.plans import jobs as J
from licita.plans import landing_files as LF
from licita.streaming import arrival as A

from test_jobs import CON_H, _contracts, _staged


def dates_of(spark, rows):
    df = spark.createDataFrame(rows, "f string, d string")
    votes = LY.layout_votes(df, ["f"], ["d"])
    got = LY.parse_dates(df.withColumn("i", F.monotonically_increasing_id()), ["f"], ["d"], votes).orderBy("i").collect()
    return {(r.f): r for r in votes.collect()}, [r.d and r.d.isoformat() for r in got]


def test_one_value_decides_for_its_file(spark):
    votes, got = dates_of(spark, [("us", "03/04/2024"), ("us", "03/25/2024"), ("pe", "03/04/2024"), ("pe", "25/03/2024"),
                                  ("none", "03/04/2024"), ("us", "2024-05-06"), ("us", "3-4-2024 07:08"), ("us", None), ("us", "nan")])
    assert got == ["2024-03-04T00:00:00", "2024-03-25T00:00:00", "2024-04-03T00:00:00", "2024-03-25T00:00:00",
                   "2024-04-03T00:00:00", "2024-05-06T00:00:00", "2024-03-04T07:08:00", None, None]
    assert {f: r.DISPOSICION for f, r in votes.items()} == {"us": "MES", "pe": "DIA", "none": "DIA"}
    assert (votes["us"].MES_PRIMERO, votes["us"].DIA_PRIMERO, votes["us"].AMBIGUAS) == (1, 0, 2)


def test_tie_minority_and_impossible_values(spark):
    votes, got = dates_of(spark, [("t", "25/03/2024"), ("t", "03/25/2024"), ("m", "03/25/2024"), ("m", "04/26/2024"),
                                  ("m", "27/03/2024"), ("m", "31/31/2024"), ("m", "02/30/2024"), (None, "12/31/2023"), (None, "01/02/2023")])
    assert got == ["2024-03-25T00:00:00", None, "2024-03-25T00:00:00", "2024-04-26T00:00:00", None, None, None,
                   "2023-12-31T00:00:00", "2023-01-02T00:00:00"]
    assert (votes["t"].DISPOSICION, votes["m"].DISPOSICION, votes["m"].IMPOSIBLES, votes[None].DISPOSICION) == ("DIA", "MES", 2, "MES")


def test_empty_table_has_no_votes(spark):
    votes, got = dates_of(spark, [])
    assert (votes, got) == ({}, [])


def line(i, v, day="2024-01-15"):
    return [f"ocds-{i}", "1", "C1", "A1", str(v), "PEN", day, "x"]


def test_a_file_broken_inside_loses_only_its_bad_lines(spark, tmpdir_path):
    landing, staging = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "staging")
    _contracts(landing, 1, "a", [line(1, 10), line(2, 20), line(3, 30)])
    path = os.path.join(landing, "2024", "01", "extraido", "a_Ent_Contratos.csv")
    with open(path, "ab") as f:
        f.write(b"ocds-4,1,C1\r\nocds-5,1,C1,A1,50,PEN,2024-01-15,x,extra\r\nocds-6,1,C1,A1,60,PEN,2024-01-15,\xff\xfe\r\n"
                b"ocds-7,1,C1,A1,70,PEN,2024-01-15,x\r\n,1,C8,A1,80,PEN,2024-01-15,x\r\nocds-9,1")
    _contracts(landing, 2, "b", [line(10, 1), line(10, 2)])
    J.run_staging(spark, landing, staging)
    assert _staged(spark, staging) == [("ocds-1", 10.0), ("ocds-10", 1.0), ("ocds-10", 2.0), ("ocds-2", 20.0), ("ocds-3", 30.0),
                                       ("ocds-7", 70.0)]
    bad = spark.read.parquet(f"{staging}/_cuarentena").collect()
    assert sorted((r.REGISTRO.split(",")[0], r.MOTIVO.split()[0], r.MES_ARCHIVO, r.ARCHIVO_ORIGEN) for r in bad) == [
        ("ocds-4", "numero", 1, "a_Ent_Contratos.csv"), ("ocds-5", "numero", 1, "a_Ent_Contratos.csv"),
        ("ocds-6", "caracteres", 1, "a_Ent_Contratos.csv"), ("ocds-9", "numero", 1, "a_Ent_Contratos.csv")]
    ctl = {r.MES_ARCHIVO: r for r in spark.read.parquet(f"{staging}/_control").collect()}
    assert (ctl[1].FILAS_ORIGEN, ctl[1].FILAS_SALIDA, ctl[1].FILAS_DESCARTADAS, ctl[1].FILAS_CUARENTENA) == (9, 4, 1, 4)
    assert (ctl[2].FILAS_ORIGEN, ctl[2].CLAVES_DUPLICADAS, ctl[2].FILAS_CUARENTENA) == (2, 2, 0)
    total = {r.DATASET: r for r in spark.read.parquet(f"{staging}/_ejecucion").collect()}["contratos"]
    assert (total.ARCHIVOS_ENCONTRADOS, total.ARCHIVOS_PROCESADOS, total.ARCHIVOS_CON_ERROR) == (2, 2, 0)
    assert (total.FILAS_LEIDAS, total.FILAS_ESCRITAS, total.FILAS_DESCARTADAS, total.FILAS_CUARENTENA, total.CLAVES_DUPLICADAS,
            total.CUADRA) == (11, 6, 1, 4, 2, True)


def test_staging_reads_each_file_by_its_own_layout(spark, tmpdir_path):
    landing, staging = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "staging")
    _contracts(landing, 1, "us", [line(1, 1, "03/04/2024"), line(2, 1, "03/25/2024")])
    _contracts(landing, 1, "pe", [line(3, 1, "03/04/2024"), line(4, 1, "25/03/2024")])
    J.run_staging(spark, landing, staging)
    got = {r.OCID: f"{r.FECHA_FIRMA:%Y-%m-%d}" for r in spark.read.parquet(f"{staging}/contratos").collect()}
    assert got == {"ocds-1": "2024-03-04", "ocds-2": "2024-03-25", "ocds-3": "2024-04-03", "ocds-4": "2024-03-25"}
    kinds = spark.read.parquet(f"{staging}/_disposicion").filter("COLUMNA = 'FECHA_FIRMA'").collect()
    assert {r.ARCHIVO_ORIGEN[:2]: r.DISPOSICION for r in kinds} == {"us": "MES", "pe": "DIA"}


def test_repeated_and_blank_headers_are_told_apart(spark, tmpdir_path):
    from licita.sources import landing as L
    folder = os.path.join(tmpdir_path, "2024", "01", "extraido")
    os.makedirs(folder)
    path = os.path.join(folder, "x.csv")
    with open(path, "w") as f:
        f.write("a,A,,b\n1,2,3,4\n5,6\n")
    assert L._field_names(("a", "A", "", "b")) == ["a0", "A1", "_c2", "b"]
    got = L.read_sheet(spark, [path], keep_bad=True).cache()
    assert {(r.b, r[L.BAD]) for r in got.collect()} == {("4", None), (None, "5,6")}


# --- streams

SCHEMA = "k long, v long"


def files(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, base):
    return A.run_upsert_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema, f"{base}/table", f"{base}/check",
                               ["k"], [F.col("v")], files_per_trigger=1, buckets=4)


def rows(df):
    return sorted(map(tuple, df.collect()))


WANT = [(k, 2 * k + 100 * (k % 3 == 0)) for k in range(30)]
BATCHES = [[(k, k) for k in range(20)], [(k, 2 * k) for k in range(30)], [(k, 2 * k + 100) for k in range(0, 30, 3)]]


@pytest.mark.parametrize("dies_at", [0, 1, 2])
def test_death_between_writing_and_marking_loses_and_doubles_nothing(spark, tmpdir_path, monkeypatch, dies_at):
    files(spark, f"{tmpdir_path}/in", BATCHES)
    real, calls = A.commit, []

    def commit(*args):
        calls.append(1)
        if len(calls) == dies_at + 1:
            raise OSError("killed")
        return real(*args)
    monkeypatch.setattr(A, "commit", commit)
    with pytest.raises(Exception, match="killed"):
        run(spark, tmpdir_path)
    schema = spark.createDataFrame([], SCHEMA).schema
    seen = rows(A.read_target(spark, f"{tmpdir_path}/table", schema))
    assert len({k for k, _ in seen}) == len(seen) and (seen == [] if dies_at == 0 else len(seen) >= 10)
    assert rows(run(spark, tmpdir_path)) == WANT
    assert A.last_commit(spark, f"{tmpdir_path}/table")["version"] == 2


def test_replay_after_the_mark_does_nothing(spark, tmpdir_path):
    target, one = f"{tmpdir_path}/table", spark.createDataFrame([(1, 1), (2, 2), (1, 3)], SCHEMA)
    upsert = lambda df, epoch, stream="s": A.upsert_batch(df, target, ["k"], [F.col("v")], 4, stream, epoch)
    assert upsert(one, 0) and not upsert(one, 0)
    assert upsert(spark.createDataFrame([(2, 1), (3, 9)], SCHEMA), 1)
    assert not upsert(spark.createDataFrame([(1, 99)], SCHEMA), 0)  # the epoch decides, not the rows
    assert upsert(spark.createDataFrame([(4, 4)], SCHEMA), 0, "other")  # epochs count within a stream
    assert rows(A.read_target(spark, target, one.schema)) == [(1, 3), (2, 2), (3, 9), (4, 4)]
    assert A.last_commit(spark, target)["streams"] == {"s": 1, "other": 0}


def test_only_touched_buckets_are_written_and_old_folders_go(spark, tmpdir_path):
    target = f"{tmpdir_path}/table"
    upsert = lambda df, epoch: A.upsert_batch(df, target, ["k"], [F.col("v")], 16, "s", epoch)
    many = spark.createDataFrame([(k, 0) for k in range(200)], SCHEMA)
    upsert(many, 0)
    upsert(spark.createDataFrame([(7, 1)], SCHEMA), 1)
    assert [d for d in os.listdir(f"{target}/data/s-1") if d.startswith("_BUCKET=")].__len__() == 1
    upsert(many.withColumn("v", F.lit(5).cast("long")), 2)
    os.makedirs(f"{target}/data/s-3")  # an attempt that died
    assert A.vacuum(spark, target) == ["s-0", "s-1", "s-3"]
    assert rows(A.read_target(spark, target, many.schema)) == [(k, 5) for k in range(200)]


def test_second_writer_of_a_version_fails(spark, tmpdir_path):
    target = f"{tmpdir_path}/table"
    before = A.last_commit(spark, target)
    A.commit(spark, target, before, {"s": 0}, {})
    with pytest.raises(RuntimeError, match="another writer"):
        A.commit(spark, target, before, {"t": 0}, {})
    assert A.last_commit(spark, target)["streams"] == {"s": 0}


def test_landing_lines_of_all_months_are_files(spark, tmpdir_path):
    lines = spark.createDataFrame([(2024, 1, "1,a"), (2024, 11, "2,b"), (2023, 2, "3,c"), (2024, 1, "4,d")], "anio int, mes int, linea string")
    LF.write_landing(spark, lines, tmpdir_path, "Hoja", ["x", "y"])
    with open(f"{tmpdir_path}/2024/01/extraido/paquete_Hoja.csv") as f:
        text = f.read().split()
    assert text[0] == "x,y" and sorted(text[1:]) == ["1,a", "4,d"]
    assert os.path.exists(f"{tmpdir_path}/2023/02/extraido/paquete_Hoja.csv") and len(CON_H) == 8


# --- versions from batches in any order

def plain_history(batches):
    out = []
    for k in sorted({k for _, _, rows in batches for k, _ in rows}):
        seen = {}
        for run, day, rows in sorted(batches):
            for key, h in rows:
                if key == k:
                    seen[day] = (run, h)
        days = [d for i, d in enumerate(sorted(seen)) if i == 0 or seen[d][1] != seen[sorted(seen)[i - 1]][1]]
        out += [(k, seen[d][1], d, e, seen[d][0]) for d, e in zip(days, [*days[1:], None])]
    return sorted(out, key=str)


def test_batches_in_any_order_give_the_same_history(spark):
    from itertools import permutations
    from licita.operators import incremental as I
    batches = [(1, "2024-01-01", [(1, "a"), (2, "a"), (3, None)]), (2, "2024-02-01", [(1, "b"), (2, "a"), (4, "z")]),
               (3, "2024-03-01", [(1, "a"), (2, "c"), (3, None), (4, "y")]), (4, "2024-02-01", [(1, "a"), (5, "q")])]
    want = plain_history(batches)
    for order in list(permutations(batches))[::5]:
        history = None
        for run_id, day, keyed in order:
            source = spark.createDataFrame(keyed, "k long, HASH_FILA string").coalesce(1)
            history = I.merge_versions(history, source, ["k"], run_id, F.lit(day))
            history = spark.createDataFrame(history.collect(), history.schema)
        got = [(r.k, r.HASH_FILA, str(r.FECHA_DESDE), r.FECHA_HASTA and str(r.FECHA_HASTA), r.EJECUCION_ID) for r in history.collect()]
        assert sorted(got, key=str) == want


def test_balance_sees_a_repeated_key(spark):
    from licita.operators import incremental as I
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, HASH_FILA string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k long, HASH_FILA string")
    assert tuple(I.upsert_balance(I.classify_changes(old, new, ["k"]), new).first()) == (3, 1, 1, 1, True)
    assert not I.upsert_balance(I.classify_changes(old, new, ["k"]), new.unionByName(new)).first().CUADRA


# --- digests of key ranges

def test_equal_tables_agree_by_their_digests_alone(spark, monkeypatch):
    from licita.operators import digests as DG
    t = spark.range(5000).selectExpr("id as k", "id % 7 as a", "case when id % 11 = 0 then null else id end as b")
    again = t.repartition(9, "a").orderBy("b")
    assert DG.differing_ranges(DG.digest(t, ["k"], t.columns), DG.digest(again, ["k"], t.columns)).count() == 0
    monkeypatch.setattr(DG, "_within", None)  # no rows are looked at
    assert DG.reconcile(t, again, ["k"]).count() == 0


def test_planted_differences_are_found_in_their_ranges(spark):
    from licita.operators import digests as DG
    t = spark.range(5000).selectExpr("id as k", "id % 7 as a", "cast(null as long) as b")
    other = (t.filter("k != 17").withColumn("a", F.expr("case when k = 99 then a + 1 else a end"))
             .withColumn("b", F.expr("case when k = 100 then a else b end"))
             .unionByName(t.filter("k in (5, 6)")).unionByName(t.filter("k = 6"))
             .unionByName(spark.sql("select 9000L as k, 1L as a, null as b union all select null, 1L, 1L")))
    found = DG.differing_ranges(DG.digest(t, ["k"], t.columns), DG.digest(other, ["k"], t.columns))
    keys = spark.createDataFrame([(k,) for k in (17, 99, 100, 5, 6, 9000, None)], "k long")
    assert {r[0] for r in found.collect()} == {r[0] for r in keys.select(DG.key_range(["k"], 8)).collect()}
    assert sorted(map(tuple, DG.reconcile(t, other, ["k"]).collect()), key=str) == sorted([
        (17, "SOLO_ORIGEN"), (99, "DISTINTO"), (100, "DISTINTO"), (5, "DISTINTO"), (6, "DISTINTO"), (9000, "SOLO_DESTINO"),
        (None, "SOLO_DESTINO")], key=str)


def test_digests_of_empty_tables(spark):
    from licita.operators import digests as DG
    t = spark.range(3).selectExpr("id as k", "id as v")
    assert DG.reconcile(t.limit(0), t.limit(0), ["k"]).count() == 0
    assert {r.ESTADO for r in DG.reconcile(t, t.limit(0), ["k"]).collect()} == {"SOLO_ORIGEN"}
