"""Multi-party chat formatting: the dialogue from each participant's side.

For every participant of a conversation the dialogue is rendered once with that speaker as ``assistant`` and everyone else as a named user; the mask holds the character ranges to learn from, the speaker's own turns with their end marks, counted from the dialogue's start. Speakers named ``system`` take no part: their turns are rendered as ``system`` in every perspective.

All by DataFrame functions. A conversation and participant is one row, whatever the number of turns up to ``part_turns`` and of characters up to ``part_chars``. Beyond either the dialogue goes on in the next part: a turn's part follows from how many turns and characters of the conversation come before it. ``begin`` is where a part's text starts in the dialogue; parts joined in order are the dialogue, and their masks, which all count from its start, are its mask. So no task holds more than a part, and a conversation with a third of all turns is rendered by as many tasks as it has parts.

Defined results: turns sort by number (null first), then speaker and text. A null speaker is named ``unknown``, a null text is empty. A null conversation id is a conversation. Repeated rows are rendered repeatedly. Conversations with no participant give no row. Control marks inside texts are broken up by a space and cannot open or close a turn. A single turn is never cut, however long. Extra columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, skew_join

#: Turns, and characters of their texts, after which a part ends: some megabytes a row.
PART_TURNS, PART_CHARS = 4096, 4 << 20
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, ASSISTANT, NAMED = "system", "assistant", "user name="


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|im_"), F.lit("< |im_"))


def _as_user(speaker: Column) -> Column:
    return F.when(speaker == SYSTEM, SYSTEM).otherwise(F.concat(F.lit(NAMED), _plain(speaker)))


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def _body(text: Column) -> Column:
    return F.concat(_plain(text), F.lit(CLOSE))


def _blocks(turns: DataFrame, *keys: str) -> DataFrame:
    """The turns of each part in order, as one array."""
    return turns.groupBy(*keys).agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))


def _people(turns: DataFrame) -> DataFrame:
    return turns.filter(F.col("speaker") != SYSTEM).select(F.col("key").alias("_key"), F.col("speaker").alias("who")).distinct()


def _in_order(turns: DataFrame, part_turns: int, part_chars: int) -> DataFrame:
    """``turns`` with ``a`` and ``b``, the numbers of whole ``part_turns`` and ``part_chars`` before the row in its conversation. Equal rows are counted; different ones are sorted over tasks, so what is before a row is a running sum within its task and the sums of the tasks before."""
    order = ["turn", "speaker", "text"]
    rows = materialize(turns.groupBy("key", *order).agg(F.first("conv_id").alias("conv_id"), F.count("*").alias("n")).withColumn("chars", F.length("text").cast("long")), "rows")
    ranged = materialize(rows.repartitionByRange("key", *order).withColumn("task", F.spark_partition_id()), "ranged")
    tasks = ranged.groupBy("key", "task").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("chars")).alias("chars"))
    earlier = W.partitionBy("key").orderBy("task")
    tasks = tasks.select("key", "task", *[(F.sum(c).over(earlier) - F.col(c)).alias(f"{c}_before") for c in ("n", "chars")])
    within = W.partitionBy("key", "task").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = ranged.join(tasks, ["key", "task"]).withColumns(
        {
            "rank": F.sum("n").over(within) - F.col("n") + F.col("n_before"),
            "at": F.sum(F.col("n") * F.col("chars")).over(within) - F.col("n") * F.col("chars") + F.col("chars_before"),
        }
    )
    far = placed.withColumn("a", F.explode(F.expr(f"sequence(rank div {part_turns}L, (rank + n - 1) div {part_turns}L)")))
    first, last = F.greatest(F.col("rank"), F.col("a") * part_turns), F.least(F.col("rank") + F.col("n"), (F.col("a") + 1) * part_turns) - 1
    each = far.withColumn("_i", F.explode(F.sequence(first, last)))
    return each.withColumn("b", F.expr(f"(at + (_i - rank) * chars) div {part_chars}L")).select("key", "conv_id", *order, "a", "b")


def _large(turns: DataFrame, part_turns: int, part_chars: int) -> DataFrame:
    """(conv_id, who, part, begin, turns) of conversations of several parts."""
    placed = materialize(_in_order(turns, part_turns, part_chars), "placed")
    length = F.length(_head(_as_user(F.col("speaker")))) + F.length(_body(F.col("text")))
    before = W.partitionBy("key").orderBy("a", "b").rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("key", "a", "b").agg(F.sum(length.cast("long")).alias("_n")).select("key", "a", "b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("start"), (F.row_number().over(W.partitionBy("key").orderBy("a", "b")) - 1).cast("long").alias("part"))
    own = placed.groupBy(F.col("key").alias("_k"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("speaker").alias("_who")).agg(F.count("*").alias("own"))
    people = _people(placed)
    sides = parts.join(people, parts["key"] == people["_key"])
    sides = sides.join(own, (sides["key"] == own["_k"]) & (sides["a"] == own["_a"]) & (sides["b"] == own["_b"]) & (sides["who"] == own["_who"]), "left")
    # Texts start where they would if all were named users, but for the speaker's own heads.
    spoken = F.coalesce(F.sum("own").over(W.partitionBy("key", "who").orderBy("a", "b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    begin = F.col("start") + spoken * (F.lit(len(ASSISTANT)) - F.length(_as_user(F.col("who"))))
    sides = materialize(sides.select("key", "a", "b", "who", "part", begin.cast("long").alias("begin")), "sides")
    return _blocks(placed, "key", "a", "b").join(sides, ["key", "a", "b"]).select("conv_id", "who", "part", "begin", "turns")


def rotate_perspectives(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", part_turns: int = PART_TURNS, part_chars: int = PART_CHARS) -> DataFrame:
    """A row per conversation, participant and part: conv_id, speaker, part, begin, n_turns, n_own, rendered, mask (array of start and end, in code points from the dialogue's start)."""
    turns = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("key"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(speaker_col), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    sizes = turns.groupBy("key").agg(F.count("*").alias("_w"), F.sum(F.length("text")).alias("_chars"))
    large = materialize(sizes.filter((F.col("_w") > part_turns) | (F.col("_chars") > part_chars)).select("key", "_w", F.lit(True).alias("_large")), "large")
    usual, rest = turns, None
    if not large.isEmpty():
        told = skew_join(turns, large, "key", "_w")
        usual, rest = told.filter(F.col("_large").isNull()), told.filter(F.col("_large").isNotNull()).drop("_large")
    people = _people(usual)
    blocks = _blocks(usual, "key")
    sides = blocks.join(people, blocks["key"] == people["_key"]).select("conv_id", "who", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("begin"), "turns")
    if rest is not None:
        sides = sides.unionByName(_large(rest, part_turns, part_chars))

    def head(t: Column) -> Column:
        return _head(F.when(t["speaker"] == F.col("who"), ASSISTANT).otherwise(_as_user(t["speaker"])))

    said = F.transform("turns", lambda t: F.struct(head(t).alias("head"), _body(t["text"]).alias("body"), (t["speaker"] == F.col("who")).alias("own")))
    start = F.struct(F.col("begin").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("mask"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(t["head"])
        end = begin + F.length(t["body"])
        span = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(end.cast("long").alias("at"), F.when(t["own"], F.concat(acc["mask"], span)).otherwise(acc["mask"]).alias("mask"))

    shown = sides.select("conv_id", F.col("who").alias("speaker"), "part", "begin", said.alias("said"))
    return shown.select(
        "conv_id",
        "speaker",
        "part",
        "begin",
        F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("said", lambda t: t["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["body"])), "").alias("rendered"),
        F.aggregate("said", start, step)["mask"].alias("mask"),
    )
