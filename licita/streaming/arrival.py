"""New monthly/daily files picked up exactly once and upserted into a table.

``readStream`` over the landing folder (file source: the checkpoint is the
manifest of processed files), ``Trigger.AvailableNow`` for scheduled runs,
and ``foreachBatch`` applying the keyed upsert.  The target is bucketed by a
hash of the key; a micro-batch rewrites only the buckets its keys fall in, so
the cost of a batch follows the batch, not the table.

All or nothing: nothing that a reader sees is ever overwritten.  A batch
writes the new state of its buckets into a folder of its own and then commits by
one marker file, which lists for every bucket the folder that holds it:

    target/data/<stream>-<epoch>/_BUCKET=<b>/...
    target/_commits/<version>.json     {"streams": {stream: epoch}, "buckets": {b: folder}}

A run that dies before the marker leaves the table as it was, and its folder is
written again by the replay.  A run that dies after it is replayed by Spark under
the same epoch, which the marker names as done, so the replay does nothing.
Two writers cannot commit the same version: the later one fails.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.versions import latest_by
from ..session import delete_path

BUCKET = "_BUCKET"
EMPTY = {"version": -1, "streams": {}, "buckets": {}}


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def last_commit(spark: SparkSession, target: str) -> dict:
    """The newest marker: version, streams (last epoch of each) and buckets.  It
    has one entry a bucket, so its size does not follow the table's."""
    fs, folder = _files(spark, f"{target}/_commits")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    done = sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))
    if not done:
        return dict(EMPTY)
    _, path = _files(spark, f"{target}/_commits/{done[-1]}")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {"version": int(done[-1].split(".")[0]), **json.loads(text)}


def commit(spark: SparkSession, target: str, before: dict, streams: dict, buckets: dict) -> None:
    """Writes the next marker aside and moves it into place; that fails if
    another writer was first."""
    name = f"{before['version'] + 1:012d}.json"
    fs, aside = _files(spark, f"{target}/_commits/.{uuid.uuid4().hex}")
    _, final = _files(spark, f"{target}/_commits/{name}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps({"streams": streams, "buckets": buckets}, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(aside, final):
        fs.delete(aside, False)
        raise RuntimeError(f"{target}: version {name} was committed by another writer")


def _read(spark: SparkSession, target: str, buckets: dict, schema: StructType) -> DataFrame:
    """The rows of these buckets (number -> folder)."""
    if not buckets:
        return spark.createDataFrame([], schema)
    # folders by data file: one scan; the folder names are at most one a bucket
    paths = [f"{target}/data/{folder}/{BUCKET}={b}" for b, folder in sorted(buckets.items())]
    return spark.read.schema(schema).parquet(*paths)


def read_target(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The table as of the newest marker."""
    return _read(spark, target, last_commit(spark, target)["buckets"], schema)


def upsert_batch(batch: DataFrame, target: str, keys: Sequence[str], order: Sequence, buckets: int,
                 stream: str, epoch: int, files_per_bucket: int = 4) -> bool:
    """Merge one micro-batch into the bucketed target (newest per key wins).
    False: this epoch of the stream is in the target already."""
    spark = batch.sparkSession
    before = last_commit(spark, target)
    if before["streams"].get(stream, -1) >= epoch:
        return False
    schema = batch.schema
    new = latest_by(batch, keys, order).withColumn(BUCKET, _bucket(keys, buckets))
    # at most ``buckets`` numbers: only the buckets they name are read and written again
    touched = [str(r[0]) for r in new.select(BUCKET).distinct().collect()]
    held = {b: before["buckets"][b] for b in touched if b in before["buckets"]}
    current = _read(spark, target, held, schema).withColumn(BUCKET, _bucket(keys, buckets))
    merged = latest_by(current.unionByName(new), keys, order)
    folder = f"{stream}-{epoch}"
    # each touched bucket is written by up to ``files_per_bucket`` tasks, so a
    # large bucket is never funnelled through one task.  What an attempt that died has
    # left in the folder is replaced as a whole
    sub = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit("sub")), F.lit(files_per_bucket))
    (merged.repartition(F.col(BUCKET), sub).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{target}/data/{folder}"))
    commit(spark, target, before, {**before["streams"], stream: epoch},
           {**before["buckets"], **{b: folder for b in touched}})
    return True


def vacuum(spark: SparkSession, target: str) -> list[str]:
    """Deletes the folders that the newest marker names for no bucket (attempts
    that died, states replaced since); to be run while no batch is."""
    used = set(last_commit(spark, target)["buckets"].values())
    fs, data = _files(spark, f"{target}/data")
    names = [f.getPath().getName() for f in fs.listStatus(data)] if fs.exists(data) else []
    gone = sorted(n for n in names if n not in used)
    for n in gone:
        delete_path(spark, f"{target}/data/{n}")
    return gone


def run_upsert_stream(spark: SparkSession, source_dir: str, schema: StructType, target_path: str,
                      checkpoint: str, keys: Sequence[str], order: Sequence,
                      files_per_trigger: int = 10, buckets: int = 64) -> DataFrame:
    """Process every file not yet seen (AvailableNow) and return the target.

    ``buckets`` sets the rewrite granularity: a batch costs roughly
    (touched buckets / buckets) of the table, so size it to the target
    (for example one bucket per few GB).  Epochs count within a checkpoint, so the
    stream is named after it."""
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_dir))
    q = (stream.writeStream
         .foreachBatch(lambda df, epoch: upsert_batch(df, target_path, keys, order, buckets, name, epoch) and None)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_target(spark, target_path, schema)
