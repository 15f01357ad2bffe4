"""Quality classifier by nearest-neighbour voting on latent-semantic vectors.

A document is a bag of hashed terms: its words, and their shapes (runs of
capitals, small letters, digits and other marks), with square-root counts.  A
few terms say how often it repeats itself.  Weights of rarity and the leading
directions of the labelled documents' term matrix (latent semantics) turn the
bag into a vector of DIMS numbers.  The vectors of the labelled documents are
broadcast, every document's cosines with all of them are computed exactly, a
block of documents at a time, and the NEIGHBOURS nearest vote with their label,
weighted by similarity.

Labelled documents are bounded by ``max_labelled`` (a documented parameter):
those with the least hash of doc_id are taken, half of them of each label where
there are enough.  So the broadcast is at most max_labelled x DIMS numbers,
4 MB, and the driver sees at most max_labelled x TERMS numbers, of which it makes
one copy (its fit holds no matrix of terms by terms); every
document is scored, whatever the size.  Labels, lang, source and doc_id enter
no vector; doc_id only chooses whose labels may be seen.

Defined cases: null and empty texts have an empty bag and score 0.5, the two
labels weighing the same in all; repeated rows
are scored alike; without labels every score is 0.5; a doc_id labelled both
good and bad counts as bad; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

TERMS = 2048
DIMS = 64
#: directions carried besides, and turns, in the search for the leading ones
SPARE_DIMS, TURNS = 32, 12
NEIGHBOURS = 25
MAX_LABELLED = 4096
#: similarity is raised to this power before it weighs a vote
SHARPNESS = 4
BLOCK = 256

_SHAPES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[a-zß-öø-ÿœ]+"), "a"), (re.compile(r"[0-9]+"), "9"))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _shape(word: str) -> str:
    for pattern, mark in _SHAPES:
        word = pattern.sub(mark, word)
    return word[:6]


_shape_of: dict[str, int] = {}
_term_of: dict[str, int] = {}


def _slot(word: str, cache: dict, of, base: int, size: int) -> int:
    at = cache.get(word)
    if at is None:
        if len(cache) > 200_000:
            cache.clear()
        at = cache[word] = base + zlib.crc32(of(word).encode()) % size
    return at


def bag(text: str | None) -> np.ndarray:
    """Square-root counts of the hashed terms, half the slots for words, a
    quarter for shapes, the last for repetition and length."""
    out = np.zeros(TERMS, dtype=np.float32)
    words = (text or "").split()
    if not words:
        return out
    count = Counter(words)
    half, quarter = TERMS // 2, TERMS // 4
    terms = np.fromiter((_slot(w, _term_of, str.lower, 0, half) for w in count), np.int64, len(count))
    shapes = np.fromiter((_slot(w, _shape_of, _shape, half, quarter) for w in count), np.int64, len(count))
    n = np.fromiter(count.values(), np.float32, len(count))
    np.add.at(out, terms, n)
    np.add.at(out, shapes, n)
    np.sqrt(out, out)
    lines = [x for x in text.split("\n") if x.strip()]
    special = half + quarter
    long = np.sqrt(len(words), dtype=np.float32)
    repeats = int(8 * (1 - len(count) / len(words)))
    doubled = int(8 * (1 - len(set(lines)) / len(lines)))
    out[special + repeats] = out[special + 16 + doubled] = long
    out[special + 32 + min(15, len(words).bit_length())] = long / 4
    return out


def _bags(texts) -> np.ndarray:
    return np.stack([bag(t) for t in texts]) if len(texts) else np.zeros((0, TERMS), np.float32)


class Voters:
    """Latent-semantic vectors of labelled documents, and the way to them."""

    def __init__(self, bags: np.ndarray, labels: np.ndarray, dims: int = DIMS):
        self.labels = labels.astype(np.float32)
        seen = np.count_nonzero(bags, axis=0)
        self.rarity = np.log((1 + len(bags)) / (1 + seen)).astype(np.float32) + np.float32(0.1)
        weighted = bags.astype(np.float32)  # the one copy that is made of the bags
        weighted *= self.rarity
        size = np.sqrt(np.einsum("ij,ij->i", weighted, weighted))[:, None]
        np.divide(weighted, size, out=weighted, where=size > 0)
        self.axes = self._principal(weighted, dims)
        self.vectors = self._unit(weighted @ self.axes)
        # each label's votes weigh the same in all
        good = max(1.0, float(self.labels.sum()))
        bad = max(1.0, len(labels) - float(self.labels.sum()))
        self.weight = np.where(self.labels > 0, 1 / good, 1 / bad).astype(np.float32)
        self.weight /= self.weight.mean()

    @staticmethod
    def _principal(x: np.ndarray, dims: int) -> np.ndarray:
        """The leading right singular vectors of ``x`` by subspace iteration from a
        fixed start: no matrix of terms by terms is made on the driver."""
        width = min(dims + SPARE_DIMS, *x.shape)
        axes = np.random.default_rng(0).standard_normal((x.shape[1], width)).astype(np.float32)
        for _ in range(TURNS):
            axes, _ = np.linalg.qr(x.T @ (x @ np.linalg.qr(axes)[0]))
        _, _, turn = np.linalg.svd(x @ axes, full_matrices=False)
        return np.ascontiguousarray((axes @ turn.T)[:, :dims])

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        size = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.divide(x, size, out=np.zeros_like(x), where=size > 0)

    def _weigh(self, bags: np.ndarray) -> np.ndarray:
        return self._unit(bags * self.rarity)

    def score(self, bags: np.ndarray, neighbours: int) -> np.ndarray:
        """Weighted share of good labels among the nearest, per document."""
        cosine = self._unit(self._weigh(bags) @ self.axes) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        alike = np.take_along_axis(cosine, near, axis=1)
        votes = (np.clip(alike, 0, None) ** SHARPNESS + 1e-6) * self.weight[near]
        share = (votes * self.labels[near]).sum(axis=1, dtype=np.float64) / votes.sum(axis=1, dtype=np.float64)
        return np.where(bags.any(axis=1), share, 0.5)


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Voters | None:
    """Voters from labelled documents that are not held out; None without any.

    The bags are made on the executors; the driver gets at most
    ``max_labelled`` of them, chosen by the least hash of doc_id by label.
    """
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .withColumn("order", F.xxhash64("doc_id")))
    chosen = known.filter("quality != 0").orderBy("order", "doc_id").limit(max_labelled // 2).unionByName(
        known.filter("quality = 0").orderBy("order", "doc_id").limit(max_labelled // 2)).drop("order")
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), BLOCK):
                part = batch.iloc[i:i + BLOCK]
                yield pd.DataFrame({"doc_id": part["doc_id"], "quality": part["quality"],
                                    "bag": [b.astype(np.float16).tobytes() for b in _bags(part["text"])]})

    got = (some.mapInPandas(make, "doc_id long, quality int, bag binary")
           .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    if not got.num_rows:
        return None
    bags = np.stack([np.frombuffer(x.as_buffer(), dtype=np.float16) for x in got["bag"]])
    labels = got["quality"].to_numpy() != 0
    del got
    pa.default_memory_pool().release_unused()
    return Voters(bags, labels)


def score(docs: DataFrame, voters: Voters | None, name: str = "quality_score",
          neighbours: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with its score (0 to 1, higher: likelier good) as last column
    ``name``; a column of that name in ``docs`` gives way."""
    sent = docs.sparkSession.sparkContext.broadcast(voters)
    kept = docs.select(*[c for c in docs.columns if c != name])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = sent.value
        for batch in batches:
            out = np.full(len(batch), 0.5)
            if judge is not None:
                for i in range(0, len(batch), BLOCK):
                    out[i:i + BLOCK] = judge.score(_bags(batch["text"].iloc[i:i + BLOCK]), neighbours)
            yield batch.assign(**{name: out})
        _term_of.clear()  # a worker may go on to other work
        _shape_of.clear()
        pa.default_memory_pool().release_unused()

    return kept.mapInPandas(run, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, their columns as they were."""
    scored = score(docs, learn(docs, labels), "__quality")
    return scored.filter(F.col("__quality") >= least).select(*docs.columns)
