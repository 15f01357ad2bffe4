"""Ranked lexical search by bag deduplication.

All documents are ranked for each item of a query table by the integer BM25
form of the contract.  What a document scores depends only on how often it holds
the items' terms and on its length figure ``m``, so:

1. one pass over the texts keeps of each document its terms that occur in an
   item (the vocabulary) with their counts, and its number of terms;
2. documents with the same counts and the same ``m`` are one class: classes meet by
   a hash and are told apart by the values themselves;
3. each class is scored once.  A block of classes times the items is a product of
   whole numbers below 2^53, which a matrix product in doubles gives exactly; a task
   keeps the best classes of each item, by score and least doc_id: a class that is
   not among the first ``top`` has no document there either;
4. the members of the classes still in are found again by hash and values, at most
   ``top`` of each by ascending doc_id, and ranked.

Items are taken in blocks of BLOCK_ITEMS, each with its own vocabulary, so
what is sent to the tasks is bounded (the terms of so many items and a matrix of 0
and 1) whatever the number of items; the corpus is read once a block.

Defined cases: a null or empty text, or one without terms, is counted nowhere
and found by nothing; an item without terms, or whose terms no document holds,
gives no rows; repeated documents are documents of their own and share a class, a
repeated item is one item; a null doc_id comes after the others; different texts
of one item_id are answered one by one under that id; an empty table gives an empty result.  Columns other than
``doc_id``, ``text`` and ``item_id`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise

TOP = 50
#: items that are scored in one pass
BLOCK_ITEMS = 1000
#: cells of a dense block of classes
BLOCK_CELLS = 4_000_000
BAGS = "doc_id long, n long, terms array<int>, tfs array<int>"
BEST = "item int, first_id long, class long, score long"

#: every byte that is no term's becomes a blank; A-Z become small
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The text's terms in turn, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, n (its terms) and those of the
    vocabulary it holds (terms, ascending, and tfs)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = known.value.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = terms_of(text)
                if words:
                    ids = np.array([i for i in map(get, words) if i is not None], dtype=np.int32)
                    found, tfs = np.unique(ids, return_counts=True)
                    rows.append((doc_id, len(words), found, tfs.astype(np.int32)))
            frame = pd.DataFrame(rows, columns=["doc_id", "n", "terms", "tfs"])
            frame["doc_id"] = pd.array(frame["doc_id"], dtype="Int64")
            yield frame
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInPandas(run, BAGS)


def classes_of(bag: DataFrame, n_docs: int, n_terms: int) -> tuple[DataFrame, DataFrame]:
    """(members, classes) of the bags that hold a term of the vocabulary: members
    has the bag's columns with m and hash; classes has hash, m, terms, tfs, the
    least doc_id (first_id) and members."""
    m = F.lit(50) + F.expr(f"(50L * n * {n_docs}L) div {max(n_terms, 1)}L")
    members = bag.filter(F.size("terms") > 0).withColumn("m", m).withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    classes = members.groupBy("hash", "m", "terms", "tfs").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("members"))
    return members, classes


def _best(holds: np.ndarray, weights: np.ndarray, top: int):
    """Scores blocks of classes for all items and keeps each item's best."""
    most = int(weights.max(initial=0)) * 1_000_000 * max(int(holds.sum(axis=0).max(initial=0)), 1)
    exact = most < 1 << 53  # else whole numbers of 64 bits, slower

    def scores(ids: np.ndarray, row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        kind = np.float64 if exact else np.int64
        dense = np.zeros((n, len(weights)), dtype=kind)
        dense[row, ids] = value
        return (dense @ holds.astype(kind)).astype(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame({"item": [], "first_id": [], "class": [], "score": []})
        least = np.ones(holds.shape[1], dtype=np.int64)  # what a class must score to be among an item's best here
        for batch in batches:
            step = max(1, BLOCK_CELLS // max(len(weights), holds.shape[1], 1))
            for at in range(0, len(batch), step):
                part = batch.iloc[at:at + step]
                sizes = part["terms"].map(len).to_numpy()
                ids = np.concatenate(part["terms"].to_numpy()).astype(np.int64)
                tfs = np.concatenate(part["tfs"].to_numpy()).astype(np.int64)
                row = np.repeat(np.arange(len(part)), sizes)
                m = part["m"].to_numpy().astype(np.int64)[row]
                value = weights[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m))
                got = scores(ids, row, value, len(part))
                row, item = np.nonzero(got >= least)
                found = pd.DataFrame({"item": item.astype(np.int32), "first_id": part["first_id"].to_numpy()[row],
                                      "class": part["class"].to_numpy()[row], "score": got[row, item]})
                kept = _first(pd.concat([kept, found], ignore_index=True) if len(kept) else found, top)
                full = kept.groupby("item")["score"].agg(["size", "min"])
                full = full[full["size"] == top]
                least[full.index] = np.maximum(full["min"], 1)
        yield kept.assign(first_id=pd.array(kept["first_id"], dtype="Int64"))
    return run


def _first(rows: pd.DataFrame, top: int) -> pd.DataFrame:
    rows = rows.sort_values(["item", "score", "first_id", "class"], ascending=[True, False, True, True],
                            na_position="last", kind="stable")
    return rows[rows.groupby("item", sort=False).cumcount() < top]


def rank_texts(docs: DataFrame, texts: list[str], top: int = TOP) -> DataFrame:
    """(text, rank, doc_id, score) of the ``top`` best documents of each of these query texts."""
    spark = docs.sparkSession
    held = [sorted(set(terms_of(text))) for text in texts]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*held)))} if held else {}
    bag = materialise(bags(docs, vocabulary), "search-bags")
    n_docs, n_terms = bag.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holds = np.zeros((len(vocabulary), len(texts)), dtype=np.int8)
    for i, words in enumerate(held):
        holds[[vocabulary[w] for w in words], i] = 1
    df = np.zeros(len(vocabulary), dtype=np.int64)
    counts = bag.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).toArrow()
    df[counts["t"].to_numpy()] = counts["n"].to_numpy()  # one number a term of the vocabulary
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    members, classes = classes_of(bag, n_docs, n_terms)
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "search-classes")
    best = (classes.select("first_id", "class", "m", "terms", "tfs").mapInPandas(_best(holds, weights, top), BEST))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first_id"), "class")
    best = materialise(best.withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") <= top)
                       .select("item", "class", "score"), "search-best")
    # members again by hash, told apart by the values; of a class only the first can be ranked
    wanted = classes.join(best.select("class").distinct(), "class", "left_semi").select("hash", "m", "terms", "tfs", "class")
    nth = Window.partitionBy("class").orderBy(F.asc_nulls_last("doc_id"))
    found = (members.join(wanted, ["hash", "m", "terms", "tfs"]).select("class", "doc_id")
             .withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= top).select("class", "doc_id"))
    ranks = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame(list(enumerate(texts)), "item int, text string")
    return (best.join(found, "class").withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= top)
            .join(F.broadcast(names), "item").select("text", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of ``docs``
    (doc_id, text) for every different row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    asked = items.select("item_id", "text").filter("text is not null").distinct()
    texts = materialise(asked.select("text").distinct(), "search-items")
    blocks = max(1, -(-texts.count() // block_items))
    found = spark.createDataFrame([], "text string, rank int, doc_id long, score long")
    for b in range(blocks):
        here = [r.text for r in texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()]
        if here:
            found = found.unionByName(rank_texts(docs, sorted(here), top))
    return asked.join(found, "text").select("item_id", "rank", "doc_id", "score")
