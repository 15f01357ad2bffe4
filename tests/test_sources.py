"""Sources and streaming: catalog pages, manifest, streaming upsert."""

import json
import os

from pyspark.sql import functions as F

from licita.operators import catalog as C
from licita.sources import landing as L
from licita.sources import manifest as M
from licita.streaming.arrival import run_upsert_stream


def test_catalog_pages(spark, tmpdir_path):
    page = {"results": [
        {"id": "src-2024-02", "year": "2024", "month": "02", "monthName": "febrero", "source": "src",
         "timestamp": "2024-03-01T10:00:00-05:00",
         "files": {"xlsx": "https://x.example/xlsx/2024/02/", "csv": "https://x.example/csv/2024/02/",
                   "sha": "ftp://x.example/sha"}},
        {"id": "", "year": "2024", "month": "01", "source": "src", "timestamp": "t",
         "files": {"xlsx_es": "https://x.example/xlsx/2024/01/es"}},
        {"id": "otro-2024-01", "year": "2024", "month": "01", "source": "otro", "timestamp": "t",
         "files": {"json": "https://x.example/json"}},
        {"year": "2024", "month": "03", "source": "src"}],
        "pagination": {"page": 1, "num_pages": 1, "total_results": 4, "has_next": False}}
    path = os.path.join(tmpdir_path, "page1.json")
    with open(path, "w") as f:
        json.dump(page, f)
    pk = L.read_catalog(spark, path)
    assert pk.count() == 3  # the object without a files map is not a package
    urls = C.package_urls(pk.withColumn("id", C.package_id()))
    assert urls.filter(F.col("URL").startswith("ftp")).count() == 0
    sel = C.dedup_packages(pk, [F.col("month")])
    chosen = [(r.PAQUETE_ID, r.FORMATO_ELEGIDO) for r in C.select_packages(sel, 2024, "src").collect()]
    assert chosen == [("src-2024-01", "xlsx_es"), ("src-2024-02", "xlsx")]


def test_manifest_roundtrip(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "manifest")
    m = M.read_manifest(spark, p)
    assert m.count() == 0 and "SHA256" in m.columns
    cur = spark.createDataFrame([("a", "1"), ("b", "2")], "RUTA string, SHA256 string")
    prev = spark.createDataFrame([("a", "1"), ("b", "9")], "RUTA string, SHA256 string")
    got = {r.RUTA: (r.ESTADO, r.PROCESAR) for r in M.changed_inputs(cur, prev).collect()}
    assert got == {"a": ("SIN_CAMBIO", False), "b": ("MODIFICADO", True)}
    forced = {r.RUTA: r.PROCESAR for r in M.changed_inputs(cur, prev, force=True).collect()}
    assert forced == {"a": True, "b": True}


def test_streaming_upsert_matches_batch(spark, tmpdir_path):
    rows = [(u, d, i, float(i)) for i, (u, d) in enumerate((u, d) for d in range(1, 6) for u in range(7))]
    df = spark.createDataFrame(rows, "user_id int, dia int, event_id int, value double")
    src = os.path.join(tmpdir_path, "src")
    df.write.partitionBy("dia").parquet(src)
    out = run_upsert_stream(spark, src, df.schema, os.path.join(tmpdir_path, "tgt"),
                            os.path.join(tmpdir_path, "ckpt"), ["user_id"],
                            [F.col("dia"), F.col("event_id")], files_per_trigger=2, buckets=4)
    got = sorted((r.user_id, r.event_id) for r in out.collect())
    assert got == [(u, 4 * 7 + u) for u in range(7)]
    # a second run finds nothing new and leaves the table unchanged
    again = run_upsert_stream(spark, src, df.schema, os.path.join(tmpdir_path, "tgt"),
                              os.path.join(tmpdir_path, "ckpt"), ["user_id"],
                              [F.col("dia"), F.col("event_id")], files_per_trigger=2, buckets=4)
    assert sorted((r.user_id, r.event_id) for r in again.collect()) == got
