"""Chat formatting by quotation linking.

A line that starts with ``>`` marks is quoted; the number of marks is its
level. The own lines of every message and the quoted lines are normalised
(lower case, white space as one space) and hashed; the original of a quoted
line is the first message of its conversation that has the line as its own,
compared by hash and text. A message answers the original of its lowest quote
level (then of most lines, then the latest); one whose quotes lead nowhere, or
that has none, answers the message before it. Quoted lines, and a line ending
in "wrote:" directly above them, are removed.

All of it is DataFrame functions. The first message with a line is a grouped
minimum, so a line that a third of all messages share is one row per task; the
order within a conversation comes from one range partitioning by (conversation,
turn) with offsets, so a conversation of any length is spread over tasks; reply
depths come from pointer doubling.

Defined cases: a null text is empty; a null conversation is one conversation,
a null turn comes first; rows that repeat a conversation and turn are all
returned, with the same place and parent; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audival.llm.shared import stages
from audival.plans.stage import Stager

#: Messages of one piece of a written conversation.
PIECE = 64
_MARKS = r"^[ \t]*(>[ \t>]*)"
_ATTRIBUTION = r"(?i)wrote:[ \t]*$"


def level(line: Column) -> Column:
    """How many quote marks a line starts with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), r"[^>]", ""))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r?\n")


def own_lines(lines: Column) -> Column:
    """The lines that are not quoted, without attributions of quotes."""
    above = lambda i: F.coalesce(level(F.get(lines, i + 1)) > 0, F.lit(False))
    return F.filter(lines, lambda x, i: (level(x) == 0) & ~(x.rlike(_ATTRIBUTION) & above(i)))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))


def _originals(messages: DataFrame) -> DataFrame:
    """(conv, turn, answers, n_linked): the original each message answers."""
    lines = _lines(F.col("text"))
    own = messages.select("conv", "turn", F.explode(F.transform(own_lines(lines), normalised)).alias("line"))
    first = own.filter("line != ''").groupBy("conv", F.xxhash64("line").alias("hash"), "line").agg(
        F.min("turn").alias("original"))
    quoted = messages.select("conv", "turn", F.explode(F.filter(F.transform(
        lines, lambda x: F.struct(level(x).alias("level"), normalised(x).alias("line"))),
        lambda q: (q["level"] > 0) & (q["line"] != ""))).alias("q"))
    quoted = quoted.select("conv", "turn", "q.level", F.xxhash64("q.line").alias("hash"), "q.line").distinct()
    met = quoted.join(first, ["conv", "hash", "line"]).filter("original < turn")
    votes = met.groupBy("conv", "turn", "level", "original").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("conv", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("near"), "n", "original")).alias("best"),
        F.sum("n").alias("n_linked")).select("conv", "turn", F.col("best.original").alias("answers"), "n_linked")


def _places(keys: DataFrame, store: Stager) -> DataFrame:
    """(conv, turn, position, before): place in the conversation and the turn
    before it, for distinct (conv, turn)."""
    spread = store.write(keys.repartitionByRange("conv", "turn").sortWithinPartitions("conv", "turn").withColumn(
        "part", F.spark_partition_id()), "spread")
    ends = spread.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last"))
    earlier = Window.partitionBy("conv").orderBy("part")  # a row per task that holds some of the conversation
    ends = ends.select("conv", "part", F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
                                                  F.lit(0)).alias("offset"),
                       F.lag("last").over(earlier).alias("previous"))
    within = Window.partitionBy("part", "conv").orderBy("turn")
    here = spread.select("*", F.row_number().over(within).alias("i"), F.lag("turn").over(within).alias("lagged"))
    return here.join(ends, ["conv", "part"]).select(
        "conv", "turn", (F.col("offset") + F.col("i") - 1).alias("position"),
        F.when(F.col("i") == 1, F.col("previous")).otherwise(F.col("lagged")).alias("before"))


def _depths(parents: DataFrame, store: Stager) -> DataFrame:
    """(conv, turn, depth) by pointer doubling: rounds grow with the logarithm
    of the longest reply chain."""
    state = store.write(parents.select("conv", "turn", F.col("parent").alias("up"),
                                       F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")), "up-0")
    turn = 0
    while not state.filter("up is not null").isEmpty():
        turn += 1
        far = state.select("conv", F.col("turn").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        state = store.write(state.join(far, ["conv", "up"], "left").select(
            "conv", "turn", F.col("further").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), f"up-{turn}")
    return state.select("conv", "turn", "depth")


def reply_order(messages: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, position (place in the conversation),
    parent_turn (the message it answers), linked (found by quotation),
    n_quoted and n_linked lines, depth and text without quotes."""
    store = stages(messages.sparkSession)
    # nulls get values of their own, so that every key joins
    low = F.lit(-(2**63))
    rows = messages.select(F.coalesce(F.col("conv_id").cast("long"), low).alias("conv"),
                           F.coalesce(F.col("turn").cast("long"), low).alias("turn"), F.col("role"), F.col("text"))
    places = store.write(_places(rows.select("conv", "turn").distinct(), store), "places")
    originals = store.write(_originals(rows), "originals")
    parents = places.join(originals, ["conv", "turn"], "left").select(
        "conv", "turn", "position", F.coalesce("answers", "before").alias("parent"),
        F.col("answers").isNotNull().alias("linked"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
    parents = store.write(parents, "parents")
    depths = _depths(parents, store)
    lines = _lines(F.col("text"))
    texts = rows.select("conv", "turn", "role",
                        F.size(F.filter(lines, lambda x: level(x) > 0)).cast("long").alias("n_quoted"),
                        F.regexp_replace(F.array_join(own_lines(lines), "\n"), r"^\s+|\s+$", "").alias("text"))
    out = texts.join(parents, ["conv", "turn"]).join(depths, ["conv", "turn"])
    back = lambda c: F.when(F.col(c) != low, F.col(c))
    return out.select(back("conv").alias("conv_id"), back("turn").alias("turn"), "role", "position",
                      back("parent").alias("parent_turn"), "linked", "n_quoted", "n_linked", "depth", "text")


def conversations(messages: DataFrame, piece: int = PIECE) -> DataFrame:
    """Reply-ordered conversations without quotes, in pieces of at most
    ``piece`` places: conv_id, piece, messages (position, parent_turn, role,
    text)."""
    got = reply_order(messages)
    return got.groupBy("conv_id", F.floor(F.col("position") / piece).alias("piece")).agg(F.array_sort(F.collect_list(
        F.struct("position", "parent_turn", "role", "text"))).alias("messages"))


def reply_digests(messages: DataFrame) -> DataFrame:
    """``reply_order`` with the text as its SHA-256."""
    got = reply_order(messages)
    return got.select(*[c for c in got.columns if c != "text"], F.sha2("text", 256).alias("text_sha256"))
