"""Streaming query: events arrive as one file per day; the latest event per
user is kept by a Structured Streaming upsert (INC-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming.arrival import run_upsert_stream
from .adapters import Tables


def stream_upsert(spark, sf_dir) -> DataFrame:
    """Daily event files -> AvailableNow stream -> bucketed keyed upsert."""
    e = Tables(spark, sf_dir)("events").select("user_id", "ts", "event_id", "event_type", "value")
    src = scratch_path(spark, "arrivals")
    e.withColumn("dia", F.date_format("ts", "yyyyMMdd")).write.partitionBy("dia").parquet(src)
    out = run_upsert_stream(spark, src, e.schema.add("dia", "string"), scratch_path(spark, "upsert-target"),
                            scratch_path(spark, "upsert-checkpoint"), ["user_id"],
                            [F.col("ts"), F.col("event_id")])
    return out.select("user_id", "ts", "event_id", "event_type", "value")


QUERIES = {"stream_upsert": stream_upsert}
