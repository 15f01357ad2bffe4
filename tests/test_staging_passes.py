"""The staging job cleans every row once; its faster expressions give what the plain ones give."""

from licita.functions import dates as D
from licita.functions import text as T
from licita.operators import staging as ST
from licita.session import compiled_code
from licita.sources import landing as L
from pyspark.sql import functions as F


def test_rows_are_written_once_before_the_flag_reads_them_twice(spark):
    rows = [("a", "1", "x", 2024, 1, "f"), ("a", "1", "y", 2024, 1, "f"), ("b", "2", "z", 2024, 1, "f"), (None, "3", "w", 2024, 1, "f")]
    raw = spark.createDataFrame(rows, "`OCID` string, `ID_CONTRATO` string, `TITULO_CONTRATO` string, ANIO_ARCHIVO int, "
                                      "MES_ARCHIVO int, ARCHIVO_ORIGEN string")
    given = []
    staged, _ = ST.stage_contratos(raw, None, lambda df: given.append(df) or df)
    assert len(given) == 1 and "CLAVE_CONTRATO" in given[0].columns
    plain, _ = ST.stage_contratos(raw)
    assert sorted(map(str, staged.collect())) == sorted(map(str, plain.collect())) and staged.count() == 3


def test_pairs_of_day_and_month_as_by_parts(spark):
    values = ["3/4/2024", "03-04-2024 9:05", "13.01.2024 10:00:59", "31/02/2024", "1/13/2024", "03/04/2024\n", " 03/04/2024",
              "2024-01-02", "3/4-2024", "", None, "00/01/2024", "12/12/2024 25:00", "1/2/2024 1:02:03"]
    df = spark.createDataFrame([(v, m) for v in values for m in (True, False, None)], "s string, m boolean")
    part = lambda i: F.regexp_extract("s", r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})(.*)$", i)
    day, month = F.when(F.col("m"), part(2)).otherwise(part(1)), F.when(F.col("m"), part(1)).otherwise(part(2))
    parts = F.when(F.col("s").rlike(D.PAIR_SHAPE), F.concat(
        part(3), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"), part(4)).try_cast("timestamp_ntz"))
    got = df.select(D.parse_pair(F.col("s"), F.col("m")).alias("a"), parts.alias("b")).collect()
    assert all(r.a == r.b for r in got) and sum(r.a is not None for r in got) >= 15


def test_white_space_as_by_character_class(spark):
    values = ["abc", " a  b\t", "a b", "ñ", "a ", "", " ", "x\ny", "\x7f", "a\x00b", "\x85z", None, "12.0"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(T.collapse_ws(F.col("s")).alias("a"), F.trim(F.regexp_replace("s", T.WS_RUN, " ")).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_file_names_as_by_expression(spark):
    paths = ["file:/x/2024/01/extraido/paquete_a.csv", "file:/x/2024/1/b c", "/x/2024/12/"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = L.with_lineage(df, F.col("p")).withColumn("b", F.regexp_extract("p", r"([^/]+)$", 1)).collect()
    assert all(r.ARCHIVO_ORIGEN == r.b for r in got) and got[0].b == "paquete_a.csv"


def test_the_session_gets_its_limit_back(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with compiled_code(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == before
