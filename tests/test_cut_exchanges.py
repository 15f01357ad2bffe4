"""Exchanges of large tables are cut into parts that a task sorts in memory."""

from licita import session as SE
from licita.functions import text as T
from licita.plans import curated as C
from pyspark.sql import functions as F

NUMBER, SIZE = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def _tables(spark, folder, n: int) -> str:
    spark.range(n).select(
        (F.col("id") % 50).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"),
        F.col("id").cast("double").alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.lit("2001-02-03 00:00:00").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(3).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S "), "id").alias("s_name")).write.parquet(
        f"{folder}/supplier.parquet")
    spark.range(50).select(F.col("id").alias("o_orderkey")).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_parts_grow_with_the_table_and_small_tables_leave_the_session_as_it_was(spark, tmp_path, monkeypatch):
    before = spark.conf.get(NUMBER, None), spark.conf.get(SIZE, None)
    large, small = _tables(spark, tmp_path / "large", 400), _tables(spark, tmp_path / "small", 6)
    plain = sorted(map(tuple, C.contract_supplier_bridge(spark, large).collect()))
    monkeypatch.setattr(SE, "ROWS_PER_TASK", 10)
    cut = C.contract_supplier_bridge(spark, large)
    assert int(spark.conf.get(NUMBER)) == max(40, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert spark.conf.get(SIZE) == SE.EXCHANGE_BYTES
    assert plain and sorted(map(tuple, cut.collect())) == plain
    C.contract_supplier_bridge(spark, small)
    assert (spark.conf.get(NUMBER, None), spark.conf.get(SIZE, None)) == before


def test_ascii_names_skip_the_accents_and_others_lose_them(spark):
    df = spark.createDataFrame([("Ab c1",), ("Entidad N° ñandú",), ("ıſ",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(T.strip_marks(F.col("s"))).collect()]
    want = [r[0] for r in df.select(F.translate(F.upper("s"), T.ACCENT_FROM, T.ACCENT_TO)).collect()]
    assert got == want and got[0] == "AB C1"
