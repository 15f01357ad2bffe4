"""The registered queries: each applies its operator to a whole table and
derives the agreed columns from what the operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (chat, embed_dedup, jaccard, lexical_search, mixing, packing, phrases, pii, quality, secret_scan, sharding,
               simhash, url_filter)


PSEUDONYM_KEY = "example key"

#: fixed values of the contract: rules on URLs
URL_RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]
#: hosts (or any of their labels) whose pages make up the list of unwanted URLs
UNWANTED_SITES = r"(?:^|\.)(?:ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\."


#: rows that go to a Python worker at a time: texts are long, so fewer than Spark's 10,000
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")), "score")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, edited, after = (F.col(c) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"))
    return simhash.fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256",
        simhash.shown(own).alias("fingerprint"), simhash.shown(edited).alias("edited_fingerprint"),
        simhash.likeness(own, edited).alias("near_edited"), simhash.likeness(own, after).alias("near_next"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    n = lambda kind: F.size(of(kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its PII.  The key here is an example: a
    production run passes its own secret."""
    return pii.scrub(table(spark, sf_dir, "documents"), PSEUDONYM_KEY, counts=True)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(table(spark, sf_dir, "conversations"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is made of the table's own pages on unwanted sites, as a feed of
    reported URLs would be: it grows with the table and holds URLs, not sites."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.select("url").filter(url_filter.host_of(F.col("url")).rlike(UNWANTED_SITES))
    return url_filter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "listed")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_embed_dedup, op3_packing, op4_fingerprints, op5_secrets,
                                     op6_pii, op7_jaccard, op8_mixing, op9_sharding, op10_chat, op11_search,
                                     op12_urls, op13_phrases)}
