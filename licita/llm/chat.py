"""Chat formatting by quotation linking.

A message's lines are parsed into nested quote levels (leading ``>`` marks).
Quoted runs of lines, their paragraphs and their lines are normalised (lower
case, white space as one blank) and hashed; so are the unquoted parts of every
message.  A join on the hash finds the message that a passage was first said
in, of the same conversation if it is there and earlier, or else the earliest
of all.  A message replies to the one whose text it quotes at the outermost
level; without a quote that is found, to the one before it in its
conversation.  Replies make threads: each message gets the thread's first
message and its depth, by pointer doubling, and its text without quotes.
Sorted by (thread, depth, conv_id, turn), every message comes after the one
it replies to.

Messages are told apart by (conv_id, turn).  A reply points to a message that
is earlier by (conv_id, turn), so threads have no cycles.

Defined cases: a null or empty text has no quotes and stays as it is; a
message that quotes only itself or nothing known keeps its place in the
conversation; rows with null conv_id or turn are threads of their own (depth
0); rows with the same (conv_id, turn) share reply, thread and depth; an empty
table gives an empty result.  Columns other than conv_id, turn, role and text
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

_MARKS = re.compile(r"^(?:[ \t]*>)+[ \t]?")
#: the line that mail programs put before a quote
_WROTE = re.compile(r"^(?:On|Am|Le|El)\b.*(?:wrote|schrieb|a écrit|escribió)[ ]?:[ \t]*$")
#: consecutive turns that a window numbers together
TURN_BLOCK = 256

PARSED = ("conv_id long, turn long, role string, text string, n_quotes int, quote_levels int, "
          "quotes array<struct<level:int,hash:long,chars:int>>, units array<long>")


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def _units(lines: list[str]) -> dict[str, int]:
    """Normalised passages of a run of lines: all of it, its paragraphs, its lines."""
    paragraphs = re.split(r"\n[ \t]*\n", "\n".join(lines))
    found = (normalise(t) for t in ["\n".join(lines), *paragraphs, *lines])
    return {t: len(t) for t in found if t}


def parse(text: str | None) -> tuple[str | None, list[tuple[int, str]], int, list[str]]:
    """The text without quotes, the quoted passages with their level, the
    number of quoted runs and the passages of the own text."""
    if not text:
        return text, [], 0, []
    runs: list[tuple[int, list[str]]] = []
    for line in text.splitlines():
        marks = _MARKS.match(line)
        level = marks.group().count(">") if marks else 0
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(line[marks.end():] if marks else line)
    quotes = [(level, t) for level, lines in runs if level for t in _units(lines)]
    if not any(level for level, _ in runs):
        return text, [], 0, list(_units(text.splitlines()))
    own: list[list[str]] = []
    for i, (level, lines) in enumerate(runs):
        if level == 0:
            quoted_next = i + 1 < len(runs)
            filled = [k for k, x in enumerate(lines) if x.strip()]
            if quoted_next and filled and _WROTE.match(lines[filled[-1]]):
                lines = lines[:filled[-1]]
            own.append(lines)
    units = {t for lines in own for t in _units(lines)}
    clean = "\n\n".join(t for t in ("\n".join(lines).strip("\n") for lines in own) if t.strip())
    return clean, quotes, sum(1 for level, _ in runs if level), sorted(units)


def parsed(messages: DataFrame) -> DataFrame:
    """Per row: the text without quotes, its quotes and its passages, hashed."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        import xxhash
        key = lambda t: int(np.uint64(xxhash.xxh3_64_intdigest(t.encode())).astype(np.int64))
        for batch in batches:
            rows = []
            for conv, turn, role, text in zip(batch["conv_id"], batch["turn"], batch["role"], batch["text"]):
                clean, quotes, n, units = parse(text)
                rows.append((conv, turn, role, clean, n, max((q[0] for q in quotes), default=0),
                             [{"level": q[0], "hash": key(q[1]), "chars": len(q[1])} for q in quotes],
                             [key(u) for u in units]))
            frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text", "n_quotes", "quote_levels",
                                                "quotes", "units"])
            for c in ("conv_id", "turn"):
                frame[c] = pd.array(frame[c], dtype="Int64")
            yield frame
    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInPandas(run, PARSED)


def before(keys: DataFrame) -> DataFrame:
    """(conv_id, turn, prev) of distinct messages: the turn before in the same
    conversation.  Blocks of turns are numbered on their own, then their last
    turns, so that a long conversation is not one task's."""
    block = F.floor(F.col("turn") / TURN_BLOCK)
    keys = keys.withColumn("block", block)
    ends = keys.groupBy("conv_id", "block").agg(F.max("turn").alias("end"))
    ends = ends.select("conv_id", "block", F.lag("end").over(Window.partitionBy("conv_id").orderBy("block")).alias("end"))
    within = F.lag("turn").over(Window.partitionBy("conv_id", "block").orderBy("turn"))
    return (keys.withColumn("prev", within).join(ends, ["conv_id", "block"])
            .select("conv_id", "turn", F.coalesce("prev", "end").alias("prev")))


def _earlier(conv: Column, turn: Column) -> Column:
    return (conv < F.col("conv_id")) | ((conv == F.col("conv_id")) & (turn < F.col("turn")))


def quoted(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_conv, reply_turn) of messages that quote one that
    is known: at the outermost level, the longest passage, the earliest message."""
    said = rows.select("conv_id", "turn", F.explode("units").alias("hash"))
    here = said.groupBy("hash", F.col("conv_id").alias("here_conv")).agg(F.min("turn").alias("here_turn"))
    anywhere = said.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    asked = rows.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    found = (asked.join(here, (asked["hash"] == here["hash"]) & (F.col("conv_id") == F.col("here_conv")), "left")
             .drop(here["hash"]).join(anywhere, "hash", "left"))
    target = (F.when(F.col("here_turn") < F.col("turn"), F.struct(F.col("conv_id"), F.col("here_turn").alias("turn")))
              .when(_earlier(F.col("first.conv_id"), F.col("first.turn")), F.col("first")))
    found = found.withColumn("target", target).filter("target is not null")
    best = F.max_by("target", F.struct(-F.col("level"), F.col("chars"), -F.col("target.conv_id"), -F.col("target.turn")))
    return (found.groupBy("conv_id", "turn").agg(best.alias("t"))
            .select("conv_id", "turn", F.col("t.conv_id").alias("reply_conv"), F.col("t.turn").alias("reply_turn")))


def threads(parents: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(conv_id, turn, thread_conv, thread_turn, depth) from (conv_id, turn,
    reply_conv, reply_turn): the first message up the replies, and how far.

    Each round doubles the way that is known; messages whose first message is
    found are left alone, so a message that many reply to is no hot key.
    """
    state = materialise(parents.select(
        "conv_id", "turn", F.coalesce("reply_conv", "conv_id").alias("up_conv"),
        F.coalesce("reply_turn", "turn").alias("up_turn"),
        F.when(F.col("reply_turn").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        F.col("reply_turn").isNull().alias("done")), "threads")
    for _ in range(max_rounds):
        open_ = state.filter("not done")
        if open_.isEmpty():
            return state.select("conv_id", "turn", F.col("up_conv").alias("thread_conv"),
                                F.col("up_turn").alias("thread_turn"), "depth")
        up = state.select(F.col("conv_id").alias("up_conv"), F.col("turn").alias("up_turn"),
                          F.col("up_conv").alias("n_conv"), F.col("up_turn").alias("n_turn"),
                          F.col("depth").alias("n_depth"), F.col("done").alias("n_done"))
        moved = open_.join(up, ["up_conv", "up_turn"]).select(
            "conv_id", "turn", F.col("n_conv").alias("up_conv"), F.col("n_turn").alias("up_turn"),
            (F.col("depth") + F.col("n_depth")).alias("depth"), F.col("n_done").alias("done"))
        state = materialise(state.filter("done").unionByName(moved), "threads")
    raise RuntimeError(f"threads not found within {max_rounds} rounds")


def link(messages: DataFrame) -> DataFrame:
    """Per row of ``messages``: conv_id, turn, role, text (without quotes),
    n_quotes, quote_levels, reply_conv, reply_turn, thread_conv, thread_turn
    and depth."""
    rows = materialise(parsed(messages), "chat-parsed")
    named = rows.filter("conv_id is not null and turn is not null")
    order = before(named.select("conv_id", "turn").distinct())
    parents = materialise(order.join(quoted(named), ["conv_id", "turn"], "left").select(
        "conv_id", "turn",
        F.coalesce("reply_conv", F.when(F.col("prev").isNotNull(), F.col("conv_id"))).alias("reply_conv"),
        F.coalesce("reply_turn", "prev").alias("reply_turn")), "chat-replies")
    placed = parents.join(threads(parents), ["conv_id", "turn"])
    return (rows.join(placed, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "text", "n_quotes", "quote_levels", "reply_conv", "reply_turn",
                    F.coalesce("thread_conv", "conv_id").alias("thread_conv"),
                    F.coalesce("thread_turn", "turn").alias("thread_turn"),
                    F.coalesce("depth", F.lit(0)).alias("depth")))


def formatted(messages: DataFrame) -> DataFrame:
    """Threads as chats: thread_conv, thread_turn and ``messages``, an array of
    (depth, conv_id, turn, role, text) in reply order.  A thread is one row
    here, as a chat is one training example; for threads too long for that,
    write :func:`link` sorted by the same columns."""
    return (link(messages).groupBy("thread_conv", "thread_turn")
            .agg(F.sort_array(F.collect_list(F.struct("depth", "conv_id", "turn", "role", "text"))).alias("messages")))
