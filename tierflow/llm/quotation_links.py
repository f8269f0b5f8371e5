"""Conversations without quotations, in reply order.

Lines that begin with quote marks belong to a quoted passage; its level is the number of marks, and
neighbouring lines of one level are one passage. The normalised lines of each passage are hashed and joined,
inside the conversation, to the lines of original messages: a line's original is the earliest message that
has it outside quotations. The message that most lines of a passage come from is the passage's original (the
later one if equal), and the original of the outermost quotation is the message replied to. Pointer jumping
then gives every message the root of its thread and its depth, so (thread_root, turn) orders a conversation
with every message after the one it answers.

The table of originals has one row per line text and conversation, so the join never multiplies rows, however
often a line occurs and however long a conversation is; no conversation is gathered in one place.

Edge cases: NULL and empty texts have no lines. Messages with a NULL conversation or turn are never linked and
are their own thread. Rows that repeat (conversation, turn) are one message for links: the latest original
counts. Quotations of unknown messages are removed and counted, but link nothing. Columns named in ``keep``
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import let, stored

MARKS = r"^(?:[ \t]*>)+"


def normalised(line: Column) -> Column:
    """Letters and digits in lower case, everything else one blank."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    def parsed(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 0)
        content = F.substring(x, F.char_length(marks) + 1, F.char_length(x))
        level = F.char_length(marks) - F.char_length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.rtrim(F.when(level > 0, F.ltrim(content)).otherwise(content)).alias("content"))

    return F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n"), parsed)


def _passages(lines: Column) -> Column:
    """Runs of quoted lines of one level, in order: (level, hashes of their normalised lines)."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]),
    )

    def cut(at: Column) -> Column:
        runs = F.transform(at, lambda a, k: F.slice(lines, a + 1, F.coalesce(F.get(at, k + 1), F.size(lines)) - a))
        return F.transform(
            F.filter(runs, lambda r: r[0]["level"] > 0),
            lambda r: F.struct(r[0]["level"].alias("level"), _hashes(r).alias("hashes")),
        )

    return let(starts, cut)


def _hashes(lines: Column) -> Column:
    texts = F.filter(F.transform(lines, lambda x: normalised(x["content"])), lambda t: t != "")
    return F.array_distinct(F.transform(texts, lambda t: F.xxhash64(t)))


def parsed(messages: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Add body (text without quotations), passages and own_lines (hashes of the body's lines)."""

    def parts(lines: Column) -> Column:
        own = F.filter(lines, lambda x: x["level"] == 0)
        return F.struct(
            F.trim(F.array_join(F.transform(own, lambda x: x["content"]), "\n"), F.lit(" \n\t")).alias("body"),
            _passages(lines).alias("passages"),
            _hashes(own).alias("own_lines"),
        )

    return messages.select(*keep, let(_lines(F.col(text_col)), parts).alias("__p")).select(*keep, "__p.*")


def linked(messages: DataFrame, conv: str, turn: str) -> DataFrame:
    """(conversation, turn, parent_turn) of parsed messages whose outermost quotation has an original."""
    originals = (
        messages.where(F.col(conv).isNotNull() & F.col(turn).isNotNull())
        .select(conv, F.col(turn).alias("original"), F.explode("own_lines").alias("line"))
        .groupBy(conv, "line").agg(F.min("original").alias("original"))
    )
    quoted = messages.select(conv, turn, F.posexplode("passages").alias("passage", "p")).select(
        conv, turn, "passage", F.col("p.level").alias("level"), F.explode("p.hashes").alias("line")
    )
    votes = (
        quoted.join(originals, [conv, "line"]).where(F.col("original") < F.col(turn))
        .groupBy(conv, turn, "passage", "level", "original").agg(F.count(F.lit(1)).alias("lines"))
    )
    best = votes.groupBy(conv, turn, "passage", "level").agg(F.max(F.struct("lines", "original"))["original"].alias("original"))
    return best.groupBy(conv, turn).agg(F.max(F.struct(-F.col("level"), "original"))["original"].alias("parent_turn"))


def _threads(links: DataFrame, conv: str, turn: str) -> DataFrame:
    """(conversation, turn, thread_root, depth) of linked messages by pointer jumping: rounds grow with log(depth).

    A round works on the messages whose pointer still moved in the one before; the others are set aside.
    """
    moving = stored(links.select(conv, turn, F.col("parent_turn").alias("thread_root"), F.lit(1).cast("long").alias("depth")), "threads")
    done = None
    while True:
        known = moving if done is None else moving.unionByName(done)
        above = known.select(conv, F.col(turn).alias("thread_root"), F.col("thread_root").alias("__next"), F.col("depth").alias("__more"))
        moved = stored(
            moving.join(above, [conv, "thread_root"], "left").select(
                conv, turn, F.coalesce("__next", "thread_root").alias("thread_root"),
                (F.col("depth") + F.coalesce("__more", F.lit(0))).alias("depth"), F.col("__next").isNotNull().alias("__moved"),
            ),
            "threads",
        )
        at_root = moved.where("NOT __moved").drop("__moved")
        done, moving = at_root if done is None else done.unionByName(at_root), moved.where("__moved").drop("__moved")
        if moving.isEmpty():
            return done


def reply_ordered(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Each message with body, n_passages, max_level, parent_turn, thread_root and depth. Runs jobs."""
    kept = [conv_col, turn_col, *[c for c in keep or [] if c not in (conv_col, turn_col)]]
    rows = stored(parsed(messages, text_col, kept), "parsed")
    links = stored(linked(rows, conv_col, turn_col), "links")
    threads = _threads(links, conv_col, turn_col).join(links, [conv_col, turn_col])
    return rows.join(threads, [conv_col, turn_col], "left").select(
        *kept, "body", F.size("passages").cast("long").alias("n_passages"),
        F.coalesce(F.array_max(F.transform("passages", lambda p: p["level"])), F.lit(0)).cast("long").alias("max_level"),
        "parent_turn", F.coalesce("thread_root", turn_col).alias("thread_root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
