import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from licita.llm import jaccard, mixing, quality, secret_scan
from licita.session import materialise

from .conftest import SCHEMA, words

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, at, SF), f"test-{name}")
        before, after = {r.doc_id: r.text for r in at.collect()}, out.collect()
        if name == "packing":
            assert {r.doc_id for r in after} == set(before)
            break
        assert out.columns == columns
        ids = [r.doc_id for r in after]
        if name == "quality":
            scored = quality.score(at, quality.learn(at, labels)).collect()
            assert set(ids) == {r.doc_id for r in scored if r.quality_score >= 0.5} and ids
        elif name == "near_duplicates":
            assert sorted(ids) == sorted({r.component_id for r in jaccard.join(at, n=5, percent=80).collect()})
        elif name == "secrets":
            assert sorted(ids) == sorted(before)
            assert sum(len(r.spans) for r in secret_scan.scan(out).collect() if r.spans and r.spans[0].kind < 3) == 0
        elif name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.plan_mix(at).collect()}
            assert {i: ids.count(i) for i in set(ids)} == {i: c for i, c in copies.items() if c}
        at = out


def kept_by_brute_force(texts, n=5, percent=80):
    """The least doc_id of each component of ``texts`` (doc_id -> text); those without words all stay."""
    sets, home = {}, {i: i for i in texts}
    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()

    def root(i):
        while home[i] != i:
            i = home[i]
        return i
    for i in sorted(texts):
        for j in sorted(texts):
            common = len(sets[i] & sets[j]) if j < i else 0
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                home[b] = a
    return {i for i in texts if home[i] == i}


def test_near_duplicates_match_brute_force(spark):
    """Words replaced far apart: five-word shingles alike by 0.8, three-word ones by less than 0.9."""
    rng = random.Random(13)
    texts = {}
    for g in range(40):
        text = words(rng, rng.randint(60, 300)).split()
        texts[len(texts)] = " ".join(text)
        for k in range(1, 6):
            near = list(text)
            for at in rng.sample(range(len(near)), k):
                near[at] = f"edit{rng.random()}"
            texts[len(texts)] = " ".join(near)
    base = words(rng, 100).split()
    texts[1000] = " ".join(base)
    texts[1001] = " ".join("other" + w if i in (30, 60) else w for i, w in enumerate(base))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts.items()], SCHEMA)
    want = kept_by_brute_force(texts)
    assert 1001 not in want and want != kept_by_brute_force(texts, 3, 90)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == sorted(want)


def test_stages_match_plain_python_on_the_small_table(spark):
    """Near duplicates, strong secrets, mixing and packing, each on all documents."""
    from tokenizers import Tokenizer

    from .test_text_operators import base_spans

    from licita.llm.oracle_sql import ORACLES
    from licita.llm.queries import vocabulary
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == sorted(kept_by_brute_force(texts))

    redacted = {r.doc_id: r.text or "" for r in corpus_pipeline.redact_secrets(spark, docs, SF).collect()}
    assert set(redacted) == set(texts) and not any(base_spans(t) for t in redacted.values())
    assert all("[SECRET]" in redacted[i] for i, t in texts.items() if base_spans(t))

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    plan = con.execute(f"select doc_id, size, taken from ({ORACLES['op8_mixing']})").fetchall()
    copies = Counter({i: taken // size for i, size, taken in plan if size})
    mixed = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF).collect())
    assert {i: mixed[i] for i in copies} == dict(copies)

    tokenizer, want = Tokenizer.from_file(vocabulary()), Counter()
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 2048):
            piece = np.array(ids[at:at + 2048], dtype="<u4")
            want[i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    packed = corpus_pipeline.pack(spark, docs, SF).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed) == want
    ends = Counter()
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048


def test_run_and_queries(spark):
    import __spark_entry__ as entry
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                      "sequence_id", "offset"]
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["op5_secrets", "op8_mixing"])
def test_oracles(spark, name):
    import __spark_entry__ as entry
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda d: sorted(map(str, d[sorted(d.columns)].itertuples(index=False)))
    assert key(got) == key(want)
