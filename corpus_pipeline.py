"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before kept, written and read again, and all
but the last return the columns of ``documents``:

1. quality: documents that the classifier scores below one half go;
2. near_duplicates: of each component of documents whose five-word shingles
   are alike by four fifths, the one with the least doc_id stays;
3. secrets: reported spans are replaced by a placeholder in the text;
4. mixing: every document is repeated as often as its source's target asks
   (not at all, once, up to three times);
5. packing: pieces of at most 2,048 tokens with their sequence and offset.

SQL cannot express the classifier, so there is no ORACLE_SQL.  Near duplicates,
strong secrets, mixing and packing are tested against plain Python and SQL on a
small table; quality only against its own operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from licita.llm import jaccard, mixing, packing, quality, secret_scan
from licita.llm.queries import table, vocabulary
from licita.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs, n=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [("quality", keep_good), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("mixing", mix_sources), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
