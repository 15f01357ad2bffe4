import random
from collections import Counter

import numpy as np
import pytest

from licita.llm import chat, embed_dedup, graph
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_links(rows, least=0.93):
    def usable(v, label):
        return (label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
                and any(x != 0 for x in v))
    x = [np.array(v, dtype=np.float32).astype(float) if usable(v, label) else None for _, v, label in rows]
    n, home = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while home[i] != i:
            i = home[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is None or x[j] is None or rows[i][2] != rows[j][2] or len(x[i]) != len(x[j]):
                continue
            if x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= least:
                n[i] += 1
                n[j] += 1
                home[root(i)] = root(j)
    low = {}
    for i, (vec_id, *_) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), vec_id), vec_id)
    return Counter((r[0], n[i], low[root(i)], r[0] == low[root(i)]) for i, r in enumerate(rows))


def vectors(seed, groups, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 12))):
            v = centre + noise * rng.standard_normal(64)
            rows.append((len(rows), [float(np.float32(a)) for a in v], int(g % 3)))
    return rows


def test_embedding_links_match_brute_force(spark):
    rows = vectors(1, 60, 0.1)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(4)]  # exact copies
    rows += [(2000, rows[5][1], None), (2001, None, 1), (2002, [0.0] * 64, 1), (2003, [float("nan")] + [1.0] * 63, 1),
             (2004, [None] + [1.0] * 63, 1), (2005, [float("inf")] + [1.0] * 63, 1), (2006, [1.0, 2.0], 1),
             (2007, [2.0, 4.0], 1), (2008, [], 1), (2009, [-a for a in rows[5][1]], rows[5][2])]
    got = embed_dedup.link(spark.createDataFrame(rows, VECTORS)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_links(rows)


def test_recall_near_the_threshold(spark):
    """Pairs just above the least cosine: at least nine tenths of the links are
    found, none below."""
    rows = vectors(3, 150, 0.255)
    want = {k[0]: k[1] for k in brute_links(rows)}
    got = {r.vec_id: r.n_links for r in embed_dedup.link(spark.createDataFrame(rows, VECTORS)).collect()}
    assert sum(want.values()) > 100 and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 3)
    rows = vectors(5, 25, 0.05)
    got = embed_dedup.link(spark.createDataFrame(rows, VECTORS)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_links(rows)


def test_embedding_edges(spark):
    assert embed_dedup.link(spark.createDataFrame([], VECTORS)).count() == 0
    rows = vectors(6, 10, 0.05)
    frame = spark.createDataFrame(rows + rows[:3], VECTORS)
    plain = sorted(map(tuple, embed_dedup.link(frame).collect()))
    more = frame.select("*", *[F.lit(1).alias(c) for c in ("key", "size", "cell", "block", "links", "n", "component")])
    assert sorted(map(tuple, embed_dedup.link(more).collect())) == plain


def test_collision_windows():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal((20, 5)), rng.standard_normal((30, 5))
    want = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.4).sum(axis=2)
    assert (embed_dedup.collisions(a, b, 0.4) == want).all()


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in range(200, 203)}}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


CHAT = "conv_id long, turn long, role string, text string"


def test_quotes_are_parsed_by_level():
    clean, quotes, n, units = chat.parse(
        "Hello there.\n\nOn Monday Ada wrote:\n> I agree.\n>> Shall we  go?\n>\n> Yes.\nThanks\n> bye")
    assert clean == "Hello there.\n\nThanks" and n == 4
    assert (1, "i agree.") in quotes and (2, "shall we go?") in quotes and (1, "bye") in quotes
    assert "hello there." in units and "thanks" in units and not any("wrote" in u for u in units)
    assert chat.parse(None) == (None, [], 0, []) and chat.parse("") == ("", [], 0, [])
    assert chat.parse("a > b")[0] == "a > b"


def test_replies_follow_quotes(spark):
    rows = [(1, 0, "user", "First question about owls"), (1, 1, "assistant", "Owls hunt at night.\nThey see well."),
            (1, 2, "user", "Thanks"), (1, 3, "user", "> First question about OWLS\n\nHere is my other view"),
            (1, 4, "user", "> Here is my other view\n>> First question about owls\n\nNested"),
            (2, 0, "user", "> Owls hunt at night.\n\nIs that so?"), (2, 1, "assistant", "Yes"),
            (2, 3, "assistant", "> unknown words\n\nGap before"), (3, 0, "user", None), (3, 1, "user", ""),
            (None, 0, "user", "> Thanks"), (4, None, "user", "x"), (5, 0, "user", "> loop\nloop"),
            (2, 1, "assistant", "Yes")]
    got = {}
    for r in chat.link(spark.createDataFrame(rows, CHAT)).collect():
        got.setdefault((r.conv_id, r.turn), r)
    reply = {k: (r.reply_conv, r.reply_turn) for k, r in got.items()}
    assert reply[1, 0] == (None, None) and reply[1, 1] == (1, 0) and reply[1, 2] == (1, 1)
    assert reply[1, 3] == (1, 0) and reply[1, 4] == (1, 3)
    assert reply[2, 0] == (1, 1) and reply[2, 1] == (2, 0) and reply[2, 3] == (2, 1)
    assert (got[2, 3].thread_conv, got[2, 3].thread_turn, got[2, 3].depth) == (1, 0, 4)
    assert got[1, 4].depth == 2 and got[1, 4].text == "Nested" and got[1, 4].quote_levels == 2
    assert got[3, 0].text is None and got[3, 1].text == "" and got[None, 0].depth == 0 and got[4, None].depth == 0
    assert chat.link(spark.createDataFrame(rows, CHAT)).count() == len(rows)


def test_long_conversations_and_edges(spark):
    rows = [(7, t, "user", f"turn {t}") for t in range(0, 1400, 2)]
    got = {r.turn: r for r in chat.link(spark.createDataFrame(rows, CHAT)).collect()}
    assert all(got[t].depth == t // 2 and got[t].thread_turn == 0 for t in got) and got[1398].reply_turn == 1396
    assert chat.link(spark.createDataFrame([], CHAT)).count() == 0
    frame = spark.createDataFrame(rows[:20], CHAT)
    more = frame.select("*", *[F.lit(1).alias(c) for c in ("hash", "prev", "depth", "block", "units", "done")])
    assert sorted(map(tuple, chat.link(more).collect())) == sorted(map(tuple, chat.link(frame).collect()))
    chats = chat.formatted(frame).collect()
    assert len(chats) == 1 and [m.turn for m in chats[0].messages] == [r[1] for r in rows[:20]]


def test_format_against_brute_force(spark):
    """Random threads of quotes, by the rules in plain Python."""
    rng = random.Random(8)
    rows, said = [], {}
    for conv in range(12):
        for turn in range(rng.randint(1, 9)):
            own = f"message {conv} {turn} {rng.random()}"
            quote = rng.choice(sorted(said)) if said and rng.random() < 0.5 else None
            text = own if quote is None else f"> {said[quote].upper()}\n\n{own}"
            rows.append((conv, turn, "user", text, quote))
            said[conv, turn] = own
    parent, depth = {}, {}
    for conv, turn, _, _, quote in rows:
        parent[conv, turn] = quote or ((conv, turn - 1) if turn else None)
    for k in parent:
        d, at = 0, k
        while parent[at]:
            d, at = d + 1, parent[at]
        depth[k] = (d, at)
    for r in chat.link(spark.createDataFrame([x[:4] for x in rows], CHAT)).collect():
        k = (r.conv_id, r.turn)
        assert ((r.reply_conv, r.reply_turn) if r.reply_turn is not None else None) == parent[k]
        assert (r.depth, (r.thread_conv, r.thread_turn)) == depth[k] and r.text == said[k]
