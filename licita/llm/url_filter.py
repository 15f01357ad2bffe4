"""URL filter: rules by host and path, and a list of canonical URLs behind a
blocked Bloom filter.

A URL that a rule fits takes the rule's verdict (the longest rule wins).  The
others are blocked when their canonical form is on the list.  The list is a
table of any size, so it is asked in two steps:

1. a blocked Bloom filter: the listed URLs' hashes choose a block of 512 bits
   and set one bit in each of its eight words.  The blocks are built by an
   aggregate and sized by the list; up to MAX_BLOCKS of them (32 MB) are broadcast, and a
   larger filter is joined on the block number instead;
2. an exact hash join of the possible hits alone with the list, which removes the
   false positives.  Pages that the filter clears never cross the network.

Canonical form: no scheme, user, port 80 or 443, leading ``www.`` or ``m.`` or
fragment; the host in small letters; no ``/index.html`` and no slash at the end of
the path; the parameters without tracking ones, sorted.

Defined cases: a null url, or one without ``://``, has an empty host and path,
meets no rule and is never listed (allow); null and such URLs in the list are passed over;
repeated rows are judged one by one; an empty list blocks nothing; an empty
table gives an empty result.  Columns other than ``page_id`` and ``url`` are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
#: fixed values: parameters that name a visit, not a page
TRACKING = r"^(?:utm_[a-z]+|ref|gclid|fbclid)(?:=|$)"

WORDS = 8
#: bits of the filter a listed URL (about one false positive in a thousand)
BITS_PER_URL = 16
#: 512-bit blocks that may be broadcast: 32 MB of bits
MAX_BLOCKS = 1 << 19


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains, where the path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form of a URL; null where it has no host."""
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        host_of(url), "^.*@", ""), ":(?:80|443)$", ""), r"^(?:www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", ""), "/+$", "")
    query = F.substring(F.regexp_extract(url, PARTS, 3), 2, 1 << 30)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(
        F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def fitting(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (struct of rule and verdict; null: none).  Of
    equally long ones a blocking rule wins, then the least text."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    choice = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                     F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in order]
    return F.coalesce(*choice, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _bit(key: Column, word: int) -> Column:
    """The bit that a URL has in this word of its block."""
    return F.shiftright(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63)).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def blocks_for(urls: int, bits_per_url: int = BITS_PER_URL) -> int:
    return max(1, -(-urls * bits_per_url // (64 * WORDS)))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of the blocks that hold a listed URL (column canonical)."""
    key = F.col("canonical")
    return listed.groupBy(_block(key, blocks).alias("block")).agg(
        *[F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key, i))).alias(f"w{i}")
          for i in range(WORDS)])


def with_possible(pages: DataFrame, filter_: DataFrame, blocks: int, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` (with a column canonical; null: not asked) with ``possible``:
    false only where the URL is surely not listed."""
    key = F.col("canonical")
    table = filter_.withColumnRenamed("block", "__block")
    if blocks <= max_blocks:
        table = F.broadcast(table)
    hit = reduce(and_, [F.call_function("shiftrightunsigned", F.col(f"w{i}"), _bit(key, i))
                        .bitwiseAND(F.lit(1)) == 1 for i in range(WORDS)])
    joined = pages.join(table, F.when(key.isNotNull(), _block(key, blocks)) == F.col("__block"), "left")
    return joined.select(*[pages[c] for c in pages.columns], F.coalesce(hit, F.lit(False)).alias("possible"))


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], max_blocks: int = MAX_BLOCKS,
          bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict,
    possible (what the filter said) and listed.  ``listed`` has a column url."""
    names = materialise(listed.select(canonical(F.col("url")).alias("canonical"))
                        .filter("canonical is not null").distinct(), "url-list")
    blocks = blocks_for(names.count(), bits_per_url)
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "url")
    ruled = (split.withColumn("fits", fitting(F.col("host"), F.col("path"), rules))
             .select("page_id", "host", "path", F.col("fits.rule").alias("rule"), F.col("fits.verdict").alias("verdict"),
                     F.when(F.col("fits").isNull(), canonical(F.col("url"))).alias("canonical")))
    asked = with_possible(ruled, bloom(names, blocks), blocks, max_blocks)
    out = ["page_id", "host", "path", "rule", "verdict", "possible", "listed"]
    clear = asked.filter(~F.col("possible")).withColumn("listed", F.lit(False))
    hits = (asked.filter("possible").join(names.withColumn("__on", F.lit(True)), "canonical", "left")
            .withColumn("listed", F.coalesce("__on", F.lit(False))))
    both = clear.select(*out).unionByName(hits.select(*out))
    return both.withColumn("verdict", F.coalesce("verdict", F.when(F.col("listed"), "block").otherwise("allow")))
