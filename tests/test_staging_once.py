"""The staging queries clean every row once; the steps give what the functions give."""

from conftest import SF_SMALL
from licita.functions import dates as D
from licita.functions import text as T
from licita.operators import staging as ST
from licita.operators.versions import duplicate_flag
from licita.plans import staging as P
from licita.sources import sinks as SK
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_staged_contracts_read_cleaned_rows(spark):
    df = P.staging_contratos(spark, SF_SMALL)
    assert "RLIKE" not in _plan(df) and "l_orderkey" not in _plan(df)
    plain, _ = ST.stage_contratos(P.raw_contratos(P.Tables(spark, SF_SMALL)))
    assert sorted(map(str, df.collect())) == sorted(map(str, plain.select(df.columns).collect()))


def test_the_inventory_writes_cleaned_rows(spark, monkeypatch):
    given, write = [], SK.write_months
    monkeypatch.setattr(SK, "write_months", lambda df, path: given.append(_plan(df)) or write(df, path))
    rows = P.staging_inventory(spark, SF_SMALL).collect()
    assert rows and len(given) == 1 and "RLIKE" not in given[0] and "l_orderkey" not in given[0]


def test_steps_of_cleaning_as_the_functions(spark):
    values = [" nan ", "nan", "None", "<NA>", "", " \t", "a  b", " 12.0 ", "12.0", "12.50", "<NA>x", "\xa0None\n", None]
    df = spark.createDataFrame([(v, v, v) for v in values], "s string, i string, t string")
    got = ST._clean(df, ["i"], ["t"]).select("i", "t", T.normalize_id(F.col("s")).alias("a"), T.clean_text(F.col("s")).alias("b"))
    assert all(r.i == r.a and r.t == r.b for r in got.collect())
    # the collapsed text is a column of its own, not part of the test and of the value
    assert _plan(ST._clean(df, [], ["t"]).select("t")).count("Project") == 2


def test_keys_that_repeat_may_be_written(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    flags = [{r.v: r.ES_DUPLICADO_CLAVE for r in duplicate_flag(df, ["k"], written=w).collect()} for w in (False, True)]
    assert flags[0] == flags[1] == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_days_that_no_month_has_are_not_parsed(spark):
    values = ["31/02/1999", "30/02/2000", "31/04/2000", "29/02/2000", "29/02/1999", "30/04/2000", "31/12/2000", "00/01/2000",
              "01/00/2000", "01/13/2000", "30/13/2000", " 10/10/2010"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    parsed = F.try_to_timestamp(F.trim("s"), F.lit("dd/MM/yyyy")).cast("timestamp_ntz")
    shaped = F.trim("s").rlike(D.DATE_SHAPES[4])
    got = df.select(D.parse_date(F.col("s")).alias("a"), parsed.alias("b"), shaped.alias("shaped")).collect()
    assert [r.a for r in got] == [r.b for r in got] and sum(r.a is not None for r in got) == 4
    assert [r.shaped for r in got][:3] == [False] * 3
