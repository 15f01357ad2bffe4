"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins/partition counts at
# runtime, splits skewed join partitions, and the session time zone is pinned
# so timestamp text and date keys do not depend on the host.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # sides dealt by one column stay where they are in joins on that and others
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # plan construction: skip per-call Python stack capture for error context
    # (three extra JVM round-trips per Column call)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "licita",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster (ignored once a JVM runs)
        conf["spark.driver.memory"] = "12g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a shared, fault-tolerant
    filesystem): a machine-local folder would lose rows, so its absence is an
    error.  Only on a ``local`` master (tests) a private scratch folder is made.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors "
                             f"share (master {spark.sparkContext.master})")
        d = tempfile.mkdtemp(prefix="licita-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def dealt_by(df, *columns):
    """``df`` dealt out by ``columns``: windows, joins and distincts over keys
    that hold them then need no further exchange, so several steps on one
    process cost one exchange of its (still narrow) rows."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    df.sparkSession.conf.set(key, SCALE_CONF[key])  # sessions of others too
    return df.repartition(*columns)


ROWS_PER_TASK = 200_000
EXCHANGE_BYTES = "8m"  # compressed; the rows that a task makes of them are some ten times as large
_cut: dict[str, str] = {}


def cut_exchanges(spark: SparkSession, rows: int) -> bool:
    """Exchanges of tables of ``rows`` rows cut into parts that a task sorts in
    memory: their number grows with the table, so a part stays as large as it
    is.  Without it a fixed number of parts, or parts of 64 MB narrow rows that
    become wide behind the exchange, are sorted on disk once tables are large.
    Tables of few parts leave the session as it was set.  Says whether they are cut."""
    parts = rows // ROWS_PER_TASK
    number, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if parts >= 8:
        fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = {number: str(max(parts, fixed)), size: EXCHANGE_BYTES}
    else:
        wanted = {}
    for key in (number, size):
        if key in wanted:
            spark.conf.set(key, wanted[key])
            _cut[key] = wanted[key]
        elif spark.conf.get(key, None) == _cut.pop(key, ""):
            spark.conf.unset(key)
    return bool(wanted)


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; the random part keeps two drivers
    that share the folder apart."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def materialise(df, name: str = "tmp"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back (computed once; survives executor loss; the
    read is columnar and prunable, unlike an RDD checkpoint)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_dealt(df, columns: str | list[str], name: str = "tmp", path: str | None = None):
    """Like :func:`materialise`, but the table remembers by buckets that its rows are
    dealt out by ``columns``: joins on them (and others) do not exchange them again.
    For rows that are dealt by them already: then a bucket is one file."""
    spark = df.sparkSession
    path, table = path or scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    fixed = spark.conf.get("spark.sql.shuffle.partitions")
    number = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or fixed)
    (df.write.bucketBy(number, columns).format("parquet").option("compression", "zstd")
     .option("path", path).saveAsTable(table))
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # the name alone; the files stay until the scratch is released


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's filesystem layer (any scheme)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


@contextmanager
def compiled_code(spark: SparkSession):
    """Plans run inside have no generated method that is too long for the JVM to
    compile: over 8000 bytes of code it is interpreted, value by value."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of plans that nobody refers to any more be deleted.
    Spark does so when the driver collects its garbage, which a driver with little
    to do puts off for half an hour; a job of many steps calls this between them.
    Handles that Python has dropped reach the driver's JVM within a second."""
    time.sleep(1)
    spark.sparkContext._jvm.System.gc()


def release_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables made after the ``since``-th; call it once the
    results that read them are written."""
    while len(_scratch) > since:
        delete_path(spark, _scratch.pop())


def scratch_mark() -> int:
    """Position to hand to :func:`release_scratch` after a job."""
    return len(_scratch)
