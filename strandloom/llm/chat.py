"""Conversations in reply order by linking quotations.

A line that starts with ``>`` marks is quoted, at the level of their number;
a passage is a maximal run of lines of one level.  A passage is normalised
(marks off, A-Z in lower case, its lines joined and white space collapsed, so
that another line width changes nothing) and hashed: all its windows of
``WINDOW`` words, and its lines and sentences of fewer words.  The hashes of
quoted passages meet those of the unquoted passages of earlier messages of
their conversation.  A hash links to the latest earlier message that holds it;
of the messages that a reply's quotes of the least matched level link to, the
one with most hashes, then the latest, is what it replies to.

Linking looks only at conversations that hold quotes.  The latest earlier
holder is found by a window over (conversation, hash) in turn order, so that
passages that recur do not multiply.  Paths through replies are doubled each
round (a message takes over the path of its ancestor), so rounds grow with the
logarithm of the longest chain.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.common import Scratch

# A line's quote marks, and what the line that announces a quote holds before its colon: a digit, an address, or a word for writing.
MARKS = r"^(?:[ \t]*>)+"
ANNOUNCES = r"(?:[0-9@]|wrote|writes|said|schrieb|a écrit|escribió)[^\n]*:[ \t\r]*$"
#: Words of a hashed window.
WINDOW = 6

_BLANK = re.compile(r"[ \t\n\r\f\x0B]+")
_SENTENCE = re.compile(r"(?<=[.!?])[ \t\r\f\x0B]+|\n")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def passages(text: str) -> list[tuple[int, str]]:
    """(level, lines without their marks) of every maximal run of lines of one level; announcing lines belong to none."""
    lines = text.split("\n")
    marks = [re.match(MARKS, x) for x in lines]
    out: list[tuple[int, list[str]]] = []
    for i, (line, mark) in enumerate(zip(lines, marks, strict=True)):
        if not mark and i + 1 < len(lines) and marks[i + 1] and re.search(ANNOUNCES, line):
            continue
        level = mark[0].count(">") if mark else 0
        if not out or out[-1][0] != level:
            out.append((level, []))
        out[-1][1].append(line[mark.end() :] if mark else line)
    return [(level, "\n".join(part)) for level, part in out]


def units(passage: str) -> Iterator[str]:
    """What is hashed of a passage: windows of its words, and its lines and sentences of fewer words than a window."""
    low = passage.translate(_LOWER)
    words = [w for w in _BLANK.split(low) if w]
    for i in range(len(words) - WINDOW + 1):
        yield " ".join(words[i : i + WINDOW])
    pieces = {" ".join(w for w in _BLANK.split(x) if w) for cut in (_SENTENCE.split(low), low.split("\n")) for x in cut}
    if 0 < len(words) < WINDOW:
        pieces.add(" ".join(words))
    yield from (x for x in pieces if x and x.count(" ") < WINDOW - 1)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages to (conv, turn, level, hash, n)."""
    for b in batches:
        for i, text in enumerate(b.column(b.schema.get_field_index("text"))):
            found: Counter = Counter()
            for level, passage in passages(text.as_py() or ""):
                found.update((level, hashlib.blake2b(u.encode(), digest_size=8).digest()) for u in units(passage))
            if not found:
                continue
            take = pa.array(np.full(len(found), i))
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(b.schema.get_field_index(c)).take(take) for c in ("conv", "turn")),
                    pa.array([level for level, _ in found], pa.int32()),
                    pa.array([int.from_bytes(h, "big", signed=True) for _, h in found], pa.int64()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                names=["conv", "turn", "level", "hash", "n"],
            )


def unquoted(text: Column) -> Column:
    """The text without quoted lines and without the line that announces a quote; outer white space goes."""
    lines = F.split(text, "\n", -1)

    def stays(line: Column, i: Column) -> Column:
        after = F.coalesce(F.try_element_at(lines, i + 2), F.lit(""))
        return ~line.rlike(MARKS) & ~(after.rlike(MARKS) & line.rlike(ANNOUNCES))

    kept = F.array_join(F.filter(lines, stays), "\n")
    return F.when(text.rlike(r"(?m)^[ \t]*>"), F.regexp_replace(kept, r"^[ \t\r\n]+|[ \t\r\n]+$", "")).otherwise(text)


def replies(messages: DataFrame, conv_id: str, turn: str, text: str) -> DataFrame:
    """(conv, turn, parent) of the messages whose quotes link to an earlier message."""
    base = messages.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(text).cast("string").alias("text")).filter("conv is not null and turn is not null")
    quoting = base.filter(F.col("text").rlike(r"(?m)^[ \t]*>"))
    mine = base.join(quoting.select("conv").distinct(), "conv", "left_semi")
    hashed = mine.mapInArrow(_hashed, f"conv {base.schema['conv'].dataType.simpleString()}, turn long, level int, hash long, n long")
    earlier = Window.partitionBy("conv", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    linked = hashed.withColumn("source", F.max(F.when(F.col("level") == 0, F.col("turn"))).over(earlier)).filter("level > 0 and source is not null")
    votes = linked.groupBy("conv", "turn", "level", "source").agg(F.sum("n").alias("n"))
    return votes.groupBy("conv", "turn").agg(F.min_by("source", F.struct("level", -F.col("n"), -F.col("source"))).alias("parent"))


def conversations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages in reply order, without quotes: conv_id, turn, role, parent_turn, depth, reply_path, n_quoted, text, chat.

    reply_path joins the turns from the thread's first message to this one, as
    12 digits each; rows come ordered by conversation and path, dealt by ranges
    of both, so that a very large conversation spans several tasks.  chat is
    the message as ``<|role|>`` line, text and ``<|end|>``.  A message that
    links to none starts a thread.

    Null texts count as empty; null conversations, turns and roles are kept and
    never linked (their path is "-").  Repeated rows are kept and share their
    link; messages that share conversation and turn are one for linking.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = messages.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), body.alias("raw"))
    step = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    paths = scratch.keep("paths0", replies(base, "conv_id", "turn", "raw").select("conv", "turn", F.col("parent").alias("above"), "parent", step("turn").alias("path"), F.lit(1).alias("depth")))
    rounds = 0
    while not paths.filter("above is not null").isEmpty():
        rounds += 1
        up = paths.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("above").alias("next"), F.col("path").alias("head"), F.col("depth").alias("more"))
        joined = paths.join(up, (F.col("conv") == F.col("c")) & (F.col("above") == F.col("t")), "left")
        # An ancestor without a row of its own starts the thread.
        head = F.when(F.col("above").isNull(), F.lit("")).otherwise(F.concat(F.coalesce("head", step("above")), F.lit(".")))
        paths = scratch.keep(f"paths{rounds}", joined.select("conv", "turn", F.col("next").alias("above"), "parent", F.concat(head, "path").alias("path"), (F.col("depth") + F.when(F.col("above").isNull(), 0).otherwise(F.coalesce("more", F.lit(1)))).alias("depth")))
    out = base.join(paths.select("conv", F.col("turn").alias("t"), "parent", "path", "depth"), (F.col("conv_id") == F.col("conv")) & (F.col("turn") == F.col("t")), "left")
    clean = unquoted(F.col("raw"))
    own = F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.lit("-")).otherwise(step("turn"))
    result = out.select(
        "conv_id",
        "turn",
        "role",
        F.col("parent").alias("parent_turn"),
        F.coalesce("depth", F.lit(1)).cast("int").alias("depth"),
        F.coalesce("path", own).alias("reply_path"),
        F.size(F.filter(F.split("raw", "\n", -1), lambda x: x.rlike(MARKS))).cast("int").alias("n_quoted"),
        clean.alias("text"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), clean, F.lit("\n<|end|>\n")).alias("chat"),
    )
    return result.repartitionByRange("conv_id", "reply_path").sortWithinPartitions("conv_id", "reply_path")


def transcripts(messages: DataFrame, most: int = 1 << 20, **columns: str) -> DataFrame:
    """Whole conversations in reply order: conv_id, part, n_messages, n_chars, chat.

    A conversation is one row, part 0, until its messages reach ``most``
    characters; then it goes on in further parts, so that no row is unbounded.
    Messages without conversation are left out, as they are of none; messages
    that share conversation and turn follow one another by their text.
    """
    rows = conversations(messages, **columns).filter("conv_id is not null")
    size = F.length("chat")
    before = Window.partitionBy("conv_id").orderBy("reply_path", "chat").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.select("conv_id", "reply_path", "chat", F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / most).alias("part"))
    packed = parts.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("reply_path", "chat"))).alias("m"), F.sum(size).alias("n_chars"))
    return packed.select("conv_id", "part", F.size("m").alias("n_messages"), "n_chars", F.array_join(F.transform("m", lambda x: x["chat"]), "").alias("chat"))
