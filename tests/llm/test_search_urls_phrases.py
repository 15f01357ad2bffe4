"""Lexical search, URL filter and phrase mining against plain Python, and their defined cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from licita.llm import lexical_search, phrases, queries, url_filter
from pyspark.sql import functions as F

from .conftest import SCHEMA, messy_rows

ITEMS = "item_id long, text string"
PAGES = "page_id long, url string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- lexical search

def plain_search(docs, items, top=50):
    bags = [(i, TERM.findall((t or "").translate(SMALL))) for i, t in docs]
    bags = [(i, len(b), Counter(b)) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, b in bags for t in b)
    out = []
    for item_id, text in sorted({(i, t) for i, t in items if t is not None}, key=str):
        scored = []
        for doc_id, n, bag in bags:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
                        for t in set(TERM.findall(text.translate(SMALL))) if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -score)
                for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def item_rows(rng):
    words = [w for r in messy_rows() for w in (r[1] or "").split()[:40]]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(25)] + [
        (30, None), (31, ""), (32, "!?"), (33, "STRASSE Straße 漢字"), (33, "another text"), (None, "one two"), (34, "zzzqqq")]


def test_search_is_the_plain_ranking(spark, messy):
    items = item_rows(random.Random(3))
    got = lexical_search.search(messy, spark.createDataFrame(items + items[:3], ITEMS))
    assert found(got) == plain_search([(r[0], r[1]) for r in messy_rows()], items)


def test_search_ties_and_copies_by_doc_id(spark):
    # a hot class of 400 copies, classes of equal score that interleave, and more than top members
    texts = ["alpha beta gamma"] * 400 + ["beta alpha gamma"] * 7 + ["alpha beta delta"] * 90 + ["alpha"] * 3
    rng = random.Random(5)
    docs = [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))] + [(None, "alpha beta gamma")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = [(1, "alpha beta"), (2, "gamma"), (3, "delta beta"), (4, "alpha")]
    got = lexical_search.search(frame, spark.createDataFrame(items, ITEMS), top=50)
    assert found(got) == plain_search(docs, items)


def test_search_in_blocks_of_items_is_the_same(spark, messy):
    items = item_rows(random.Random(4))
    frame = spark.createDataFrame(items, ITEMS)
    assert found(lexical_search.search(messy, frame, top=5, block_items=10)) == found(
        lexical_search.search(messy, frame, top=5))


def test_search_classes_are_told_apart_and_scored_once(spark):
    docs = spark.createDataFrame([(1, "a b x"), (2, "b a y"), (3, "a a b"), (4, "q"), (5, None)], "doc_id long, text string")
    bag = lexical_search.bags(docs, {b"a": 0, b"b": 1}).cache()
    assert sorted((r.doc_id, r.n, list(r.terms), list(r.tfs)) for r in bag.collect()) == [
        (1, 3, [0, 1], [1, 1]), (2, 3, [0, 1], [1, 1]), (3, 3, [0, 1], [2, 1]), (4, 1, [], [])]
    _, classes = lexical_search.classes_of(bag, 4, 10)
    assert sorted((r.first_id, r.members) for r in classes.collect()) == [(1, 2), (3, 1)]


def test_search_scores_beyond_doubles_stay_whole():
    # weights so large that sums pass 2^53: the block product turns to 64-bit numbers
    import pandas as pd
    holds, weights = np.ones((2, 1), dtype=np.int8), np.array([(1 << 40) + 1, (1 << 41) + 1])
    run = lexical_search._best(holds, weights, 5)
    part = pd.DataFrame({"first_id": pd.array([1], dtype="Int64"), "class": [9], "m": [50],
                         "terms": [np.array([0, 1])], "tfs": [np.array([1, 1])]})
    each = 1_000_000_000 // 2000
    assert next(run(iter([part])))["score"].tolist() == [int(weights.sum()) * each]


def test_search_empty_tables(spark, empty, messy):
    items = spark.createDataFrame([(1, "one two")], ITEMS)
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(messy, spark.createDataFrame([], ITEMS)).count() == 0


def test_search_ignores_other_columns(spark, messy, clashing):
    items = spark.createDataFrame(item_rows(random.Random(6))[:8], ITEMS)
    other = items.select("*", *[F.lit("x").alias(c) for c in ("rank", "score", "doc_id", "class", "item", "n")])
    assert found(lexical_search.search(clashing, other)) == found(lexical_search.search(messy, items))


# --- URL filter

def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(SMALL), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def plain_canonical(url):
    host, path = plain_parts(url)
    if not host:
        return None
    host = re.sub(r"^(www|m)\.", "", re.sub(r":(80|443)$", "", re.sub(r"^.*@", "", host, flags=re.S)))
    path = re.sub(r"/+$", "", re.sub(r"/index\.html?$", "", path))
    rest = url.split("://", 1)[1].split("#")[0]
    query = rest.split("?", 1)[1] if "?" in rest else ""
    kept = sorted(p for p in query.split("&") if p and not re.match(r"(utm_[a-z]+|ref|gclid|fbclid)(=|$)", p))
    return host + path + ("?" + "&".join(kept) if kept else "")


def plain_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


URLS = ["http://example.net", "http://example.net/", "http://a.example.net/en/1", "HTTP://A.Example.NET/EN/1", "https://x.org/fr/2?q=1#z",
        "http://org/fr/", "http://notorg/fr/", "http://borg.example.com/de/x", "https://example.com/de", "https://example.com/de/",
        "https://www.example.com/a/index.html?b=2&a=1&utm_source=x", "http://m.example.com:443/a/?a=1&b=2#f", "http://u:p@example.com/a?b=2&a=1",
        "mailto:someone", "", None, "://", "http://", "http:///path", "x://y://z/p", "http://h?x/y", "http://h#a?b", "http://" + "a" * 5000 + "/" + "b" * 50000]


def test_parts_canonical_and_rules(spark):
    u = F.col("url")
    rows = spark.createDataFrame(list(enumerate(URLS)), PAGES).select(
        "url", url_filter.host_of(u).alias("h"), url_filter.path_of(u).alias("p"), url_filter.canonical(u).alias("c"),
        url_filter.fitting(url_filter.host_of(u), url_filter.path_of(u), queries.URL_RULES).alias("r")).collect()
    for r in rows:
        assert (r.h, r.p) == plain_parts(r.url)
        assert r.c == plain_canonical(r.url)
        rule = plain_rule(r.h, r.p)
        assert (r.r and (r.r.rule, r.r.verdict)) == (rule and (rule.text, rule.verdict))


def site_urls(rng, n):
    return ["http%s://%s%s.example.com/%s%s" % (rng.choice(["", "s"]), rng.choice(["", "www.", "m.", "blog."]),
            rng.choice(["casino", "news", "shop"]), rng.randint(0, n), rng.choice(["", "/", "?ref=a", "?p=1", "#x"])) for _ in range(n)]


@pytest.mark.parametrize("max_blocks,bits", [(url_filter.MAX_BLOCKS, 16), (0, 16), (url_filter.MAX_BLOCKS, 1)])
def test_judge_is_exact_whatever_the_filter(spark, max_blocks, bits):
    rng = random.Random(8)
    urls = URLS + site_urls(rng, 2000)
    listed = [u for u in urls if rng.random() < 0.3] + [None, "no url"]
    pages = spark.createDataFrame([(None if i == 3 else i, u) for i, u in enumerate(urls)] + [(5, urls[5])], PAGES).repartition(5)
    got = url_filter.judge(pages, spark.createDataFrame([(u,) for u in listed], "url string"), queries.URL_RULES,
                           max_blocks, bits).collect()
    names = {plain_canonical(u) for u in listed} - {None}
    want = []
    for i, u in [(None if i == 3 else i, u) for i, u in enumerate(urls)] + [(5, urls[5])]:
        host, path = plain_parts(u)
        rule = plain_rule(host, path)
        on = rule is None and plain_canonical(u) in names
        want.append((i, host, path, rule and rule.text, rule.verdict if rule else "block" if on else "allow", on))
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in got], key=str) == sorted(want, key=str)
    assert all(r.possible for r in got if r.listed)  # no listed URL is missed


def test_filter_clears_most_other_urls(spark):
    listed = spark.range(20_000).select(F.concat(F.lit("site.com/"), F.col("id").cast("string")).alias("canonical"))
    other = spark.range(20_000, 120_000).select(F.concat(F.lit("site.com/"), F.col("id").cast("string")).alias("canonical"))
    blocks = url_filter.blocks_for(20_000)
    passed = url_filter.with_possible(other, url_filter.bloom(listed, blocks), blocks).filter("possible").count()
    assert passed < 500  # a thousandth is expected
    assert url_filter.with_possible(listed, url_filter.bloom(listed, blocks), blocks).filter("possible").count() == 20_000


def test_judge_empty_and_clashing(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], PAGES)
    nothing = spark.createDataFrame([], "url string")
    assert [r.verdict for r in url_filter.judge(pages, nothing, []).orderBy("page_id").collect()] == ["allow", "allow"]
    assert url_filter.judge(pages.limit(0), pages.select("url"), queries.URL_RULES).count() == 0
    wide = pages.select("*", *[F.lit("x").alias(c) for c in ("host", "path", "rule", "verdict", "canonical", "block", "w0", "listed", "possible")])
    a = sorted(map(str, url_filter.judge(wide, wide, queries.URL_RULES).collect()))
    assert a == sorted(map(str, url_filter.judge(pages, pages.select("url"), queries.URL_RULES).collect()))


# --- phrases

def plain_counts(docs, max_words=5):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return f, n


def plain_collocations(docs, least, top, max_words=5):
    f, n = plain_counts(docs, max_words)
    f = Counter({p: c for p, c in f.items() if c >= least})
    by_lang = {}
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        inside = any(q_lang == lang and len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
                     for (q_lang, q), c in f.items())
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score)
                  for lang, rows in by_lang.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def mined(frame):
    return sorted(map(tuple, frame.collect()))


def chatter(rng, n):
    """Texts of few words with fixed phrases, so that many phrases are frequent."""
    fixed = ["in the long run", "as soon as possible", "New York", "x x x x x x x", "é ü"]
    out = []
    for _ in range(n):
        words = [rng.choice(["the", "of", "A", "b", "c\t", "d", "\u00a0e", "f\x1c"]) if rng.random() < 0.8 else rng.choice(fixed)
                 for _ in range(rng.randint(0, 60))]
        out.append((rng.choice(["en", "en", "en", "de", None, "und"]),
                    "".join(w + rng.choice([" ", " ", " ", "  ", ", ", ".", "\n", "\r\n"]) for w in words)))
    return out + [("en", None), ("en", ""), (None, " ,.\n"), ("en", "long " * 30_000)]


@pytest.mark.parametrize("shards,cells,chunk", [(4, phrases.MAX_CELLS, 250_000), (1, 1 << 16, 300), (7, 2, 200)])
def test_phrases_are_the_plain_counts(spark, shards, cells, chunk, monkeypatch):
    docs = chatter(random.Random(11), 150)
    frame = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(docs)], "doc_id long, text string, lang string")
    found_, totals = phrases.frequent_phrases(frame.repartition(5), least=20, shards=shards, max_cells=cells, chunk_words=chunk)
    f, n = plain_counts(docs)
    assert {(r.lang, r.phrase): (r.size, r.n) for r in found_.collect()} == {
        (lang, " ".join(p)): (len(p), c) for (lang, p), c in f.items() if c >= 20}
    assert {r.lang: r.n for r in totals.collect()} == {k: v for k, v in n.items() if v}


@pytest.mark.parametrize("top", [2000, 5])
def test_collocations_are_the_plain_ones(spark, top):
    docs = chatter(random.Random(12), 200)
    frame = spark.createDataFrame([(t, lang) for lang, t in docs], "text string, lang string").repartition(3)
    assert mined(phrases.collocations(frame, least=15, top=top, chunk_words=500)) == plain_collocations(docs, 15, top)


def test_collocations_empty_and_clashing(spark, empty, messy, clashing):
    assert phrases.collocations(empty).count() == 0
    assert mined(phrases.collocations(clashing, least=2)) == mined(phrases.collocations(messy, least=2))
    assert mined(phrases.collocations(messy, least=2)) == plain_collocations([(r[2], r[1]) for r in messy_rows()], 2, 2000)


def test_scores_pass_64_bits(spark):
    top = 10 ** 12
    big = spark.createDataFrame([(3 * top, 7 * top, top + 1, top + 3)], "a long, n long, l long, r long")
    score = phrases.score_of(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    assert big.select(score).first()[0] == 1000 * 3 * top * 7 * top // ((top + 1) * (top + 3))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cc", "\n"]), max_size=40), st.integers(1, 4), st.integers(1, 5))
def test_each_active_phrase_is_counted_once_a_cycle(words, shards, max_words):
    """With everything known from the first step, one cycle counts every phrase."""
    numbers = {"\n": 0}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in [*words, "\n"]], dtype=np.int32)
    names = list(numbers)
    hashes = np.ascontiguousarray(phrases._hashes("en", [w.encode() for w in names])[:, 0])
    since = np.zeros(1 << 10, dtype=np.uint8)  # every cell known at step 0: active in steps 1 .. shards
    want = plain_counts([("en", " ".join(words))], max_words)[0]
    for step in range(1, shards + 2):
        got = {}
        for size, places, _, counts, starts in phrases.active_phrases(ids, hashes, since, step, shards, max_words):
            assert set(starts.tolist()) <= {1}
            got |= {("en", tuple(names[i] for i in ids[p:p + size])): c for p, c in zip(places, counts.tolist())}
        assert got == (dict(want) if step <= shards else {})
