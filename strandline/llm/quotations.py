"""Conversations in reply order, by linking quotations.

Lines that begin with quote marks (`>`, nested as `>>` or `> >`) are quoted; a passage is a run of lines of one
level without a blank line between. Passages and their single lines are normalised (lower case, white space
collapsed) and hashed. A quotation of any level is joined to the latest earlier message of its conversation whose own
text has that passage. A message replies to the one that most of its quoted characters come from (equal: the
latest), counted at the lowest level that has an original: deeper levels quote what the original itself quoted, and
decide only where no lower one does. Every message keeps its own text, without quotations and without the line that
announces one ("... wrote:").

Replies form a forest, as originals are earlier. Paths from each thread's first message are found by pointer
doubling, so a thread of depth d takes log2(d) joins; sorting by (conv_id, reply_path) reads a conversation in reply
order. Joins are on conversation and passage (or turn), so a conversation of any size is spread over tasks, and only
passages that are quoted somewhere are compared.

as_replies() writes a table of messages the way mail quotes: each message above the one that it answers, marked one level
deeper. reply_ordered() takes that apart again.

Null texts are empty. A null conversation or turn links with nothing. Rows that repeat a conversation and turn
are one message's: they share its reply. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import durable, pieces, stored

MARKS = re.compile(r"^\s{0,3}((?:>[ \t]?)+)")
ANNOUNCES = re.compile(r"(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$", re.I)
LINES = re.compile(r"\r\n|\r|\n")


def levels(text: str) -> list[tuple[int, str]]:
    """Quote level and content of each line."""
    out = []
    for line in LINES.split(text):
        m = MARKS.match(line)
        out.append((m[1].count(">"), line[m.end() :]) if m else (0, line))
    return out


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def parsed(text: str) -> tuple[str, int, list[tuple[int, int, int]]]:
    """Own text, number of quoted lines, and units: (level, hash, characters) of passages and lines."""
    lines = levels(text)
    own = [line for k, (level, line) in enumerate(lines) if level == 0 and not (k + 1 < len(lines) and lines[k + 1][0] > 0 and ANNOUNCES.search(line))]
    units, run, at = set(), [], None

    def close() -> None:
        if len(run) > 1:
            x = " ".join(run)
            units.add((at, xxhash.xxh64_intdigest(x) - (1 << 63), len(x)))
        run.clear()

    for level, line in lines:
        x = normal(line)
        if level != at or not x:
            close()
        at = level
        if x:
            units.add((level, xxhash.xxh64_intdigest(x) - (1 << 63), len(x)))
            run.append(x)
    close()
    return "\n".join(own).strip(), sum(level > 0 for level, _ in lines), sorted(units)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("chars", pa.int64())]))
    for batch in batches:
        for part in pieces(batch, "text"):
            found = [parsed(t or "") for t in part.column(3).to_pylist()]
            units = pa.array([[{"level": a, "hash": b, "chars": c} for a, b, c in f[2]] for f in found], kind)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), units], ["conv_id", "turn", "role", "text", "n_quoted", "units"])


def reply_ordered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text (own), n_quoted (lines), reply_to, thread_turn, depth and reply_path of every message."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (conv_col, turn_col, role_col)}
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    schema = f"conv_id {kinds[conv_col]}, turn {kinds[turn_col]}, role {kinds[role_col]}, text string, n_quoted long, units array<struct<level:int,hash:long,chars:long>>"
    messages = stored(rows.mapInArrow(_units, schema))
    units = messages.filter("conv_id is not null and turn is not null").select("conv_id", "turn", F.inline("units"))
    quotes = units.filter("level > 0").select("conv_id", "turn", "level", "hash", "chars").distinct()
    asked = quotes.select("conv_id", "hash").distinct()
    originals = units.filter("level = 0").join(asked, ["conv_id", "hash"], "left_semi").select("conv_id", "hash", "turn").distinct()
    # one row for each turn that has or quotes a passage, so that "earlier" is a frame of rows whatever type turns have
    asks = quotes.groupBy("conv_id", "hash", "turn").agg(F.collect_set(F.struct("level", "chars")).alias("asked"))
    both = asks.join(originals.withColumn("original", F.col("turn")), ["conv_id", "hash", "turn"], "full_outer")
    earlier = Window.partitionBy("conv_id", "hash").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    linked = both.withColumn("from", F.last("original", ignorenulls=True).over(earlier)).filter(F.col("asked").isNotNull() & F.col("from").isNotNull())
    linked = linked.select("conv_id", "turn", "from", F.inline("asked"))
    best = linked.groupBy("conv_id", "turn", "level", "from").agg(F.sum("chars").alias("chars")).groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("nearest"), "chars", "from"))["from"].alias("reply_to"))
    # path: turns from below `above` (null: from the thread's first message) to the message
    now = durable(best.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("above"), F.array("turn").alias("path")))
    while not now.filter("above is not null").isEmpty():
        up = now.select("conv_id", F.col("turn").alias("above"), F.col("above").alias("next"), F.col("path").alias("upper"))
        open_ = now.filter("above is not null").join(up, ["conv_id", "above"], "left")
        moved = open_.select("conv_id", "turn", "reply_to", F.col("next").alias("above"), F.concat(F.coalesce("upper", F.array("above")), "path").alias("path"))
        now = durable(moved.union(now.filter("above is null")))
    threads = messages.drop("units").join(now.drop("above"), ["conv_id", "turn"], "left")
    path = F.coalesce("path", F.array("turn"))
    return threads.select(
        F.col("conv_id").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("text").alias(text_col),
        "n_quoted",
        "reply_to",
        F.element_at(path, 1).alias("thread_turn"),
        (F.size(path) - 1).cast("long").alias("depth"),
        F.array_join(F.transform(path, lambda t: F.lpad(t.cast("string"), 10, "0")), "/").alias("reply_path"),
    )


def as_replies(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each message with an announcement and, marked line by line, the message of the turn before and (one level deeper) the
    one before that; a first message, and one whose turn before has no row or several, quotes nothing there."""
    own = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), own.alias("text"))
    single = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n"), F.min("text").alias("text")).filter("n = 1")
    marked = lambda mark, text: F.when(text != "", F.concat(F.lit("\n" + mark), F.regexp_replace(text, r"\r\n|\r|\n", "\n" + mark)))
    before = single.select("conv_id", (F.col("turn") + 1).alias("turn"), marked("> ", F.col("text")).alias("one"))
    deeper = single.select("conv_id", (F.col("turn") + 2).alias("turn"), marked("> > ", F.col("text")).alias("two"))
    quoted = rows.join(before, ["conv_id", "turn"], "left").join(deeper, ["conv_id", "turn"], "left")
    text = F.concat("text", F.coalesce(F.concat(F.lit("\nSomeone wrote:"), "one", F.coalesce("two", F.lit(""))), F.lit("")))
    return quoted.select(F.col("conv_id").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), text.alias(text_col))
