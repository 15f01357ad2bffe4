"""Processing manifest: which inputs changed since the last run (INC-1, INC-2).

The manifest is a keyed table (path or package id -> content hash or
publication timestamp) stored as Parquet next to the outputs.  A missing
manifest reads as empty; an unreadable one raises (corruption is not
silently treated as "nothing processed").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

# Change states.
NEW = "NUEVO"
CHANGED = "MODIFICADO"
SAME = "SIN_CAMBIO"

MANIFEST_SCHEMA = ("RUTA string, SHA256 string, PROCESADO_EN timestamp, SALIDAS array<string>,"
                   " BYTES bigint, MODIFICADO timestamp")


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST_SCHEMA) -> DataFrame:
    """SRC-8: the newest manifest under ``path``, or an empty table with its
    schema when there is none."""
    try:
        stored = spark.read.schema(f"{schema}, v string").parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
    newest = stored.agg(F.max("v")).first()[0]
    return stored.filter(F.col("v") == newest).drop("v")


def write_manifest(manifest: DataFrame, path: str, run: str) -> None:
    """A manifest is never overwritten: each run writes a version of its own
    (``v=<run>``), so a run that dies leaves the one before readable."""
    manifest.write.mode("overwrite").parquet(f"{path}/v={run}")


def file_hashes(binary_files: DataFrame) -> DataFrame:
    """F-25 re-aimed: SHA-256 of whole file contents from the binaryFile source."""
    return binary_files.select(F.col("path").alias("RUTA"), F.sha2(F.col("content"), 256).alias("SHA256"),
                               F.col("length").alias("BYTES"))


def changed_inputs(current: DataFrame, manifest: DataFrame, key: str = "RUTA",
                   digest: str = "SHA256", force: bool = False) -> DataFrame:
    """INC-1: NEW / CHANGED / SAME per input and whether to process it
    (``force`` reprocesses everything, like the reference's --force)."""
    m = manifest.select(F.col(key), F.col(digest).alias("_prev"))
    j = current.join(m, key, "left")
    state = (F.when(F.col("_prev").isNull(), F.lit(NEW))
             .when(F.col("_prev") == F.col(digest), F.lit(SAME)).otherwise(F.lit(CHANGED)))
    return j.select(*current.columns, state.alias("ESTADO"),
                    (F.lit(force) | (state != SAME)).alias("PROCESAR"))


def updated_manifest(manifest: DataFrame, processed: DataFrame, key: str = "RUTA") -> DataFrame:
    """Manifest after a run: processed entries replace their previous rows."""
    return manifest.join(processed.select(key), key, "left_anti").unionByName(
        processed.select(*manifest.columns))
