"""Multi-party perspective rotation of dialogues into training text.

For every participant of a conversation the whole dialogue is rendered once
with that speaker as the assistant and the others as named users; only the
assistant's turns are trained on. Built-in expressions only.

The result has one row per (conversation, perspective, turn) with the rendered
segment and its place in the rendering, so no conversation is ever gathered
into one row or one task: turns are range-partitioned by (conversation, order),
places come from running sums inside a partition plus the totals of the
partitions before it.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"


def _same(left: str, right: str, columns: list[str]) -> Column:
    return functools.reduce(Column.__and__, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _name(speaker: Column) -> Column:
    """A speaker as a header-safe name: white space and control marks become '_'."""
    return F.regexp_replace(speaker, "[\\s<>|]+", "_")


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Columns conv_id, perspective, seq, turn, role, name, segment, start,
    train_start, train_chars.

    seq numbers the turns of a conversation from 0 by (turn, speaker, text), nulls
    first, so ties have a defined order and repeated rows stay repeated turns.
    ``segment`` is ``<|im_start|>role[ name=..]\\n text <|im_end|>\\n``; ``start`` is
    its character offset in the whole rendering. The trained span (text and end
    mark) begins at character train_start of the rendering and has train_chars
    characters; both are null and 0 for turns that are masked out.

    System turns stay system turns and are no participant. A null speaker counts
    as a participant named ``unknown``, a null text as empty, a null conversation
    id as one conversation of its own. Control marks inside a text are broken up
    (``<|`` becomes ``< |``) so that a text cannot open or close a turn. A
    conversation of system turns alone, like an empty table, gives no rows.
    Columns beyond the four named ones are ignored.
    """
    order = ["turn", "speaker", "body"]
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
                        F.replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("body"))
    # equal rows may be dealt to several partitions: the tie number only separates equals
    dealt = (rows.withColumn("tie", F.monotonically_increasing_id())
             .repartitionByRange("conv_id", *order, "tie").sortWithinPartitions("conv_id", *order, "tie")
             .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    placed = materialize(dealt.drop("tie"), "turns")   # fixes partition numbers and places

    people = placed.filter(F.col("speaker") != SYSTEM).select("conv_id", "speaker").distinct().select(
        "conv_id", F.col("speaker").alias("perspective"))
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == SYSTEM
    views = (placed.alias("t").join(people.alias("p"), F.col("t.conv_id").eqNullSafe(F.col("p.conv_id")))
             .select("t.*", "perspective")
             .withColumns({"role": F.when(system, SYSTEM).when(own, "assistant").otherwise("user"),
                           "name": F.when(~system & ~own, _name(F.col("speaker")))})
             .withColumn("head", F.concat(F.lit(START), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n")))
             .withColumn("segment", F.concat("head", "body", F.lit(END + "\n"))))
    group = ["conv_id", "perspective"]
    totals = views.groupBy(*group, "part").agg(F.sum(F.length("segment")).alias("chars"), F.count("*").alias("rows"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = totals.select(*group, "part", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars"),
                          F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows"))
    inside = Window.partitionBy(*group, "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    run = views.withColumns({"c": F.coalesce(F.sum(F.length("segment")).over(inside), F.lit(0)), "n": F.count("*").over(inside)})
    start = F.col("b.chars") + F.col("v.c")
    trained = F.col("v.role") == "assistant"
    return run.alias("v").join(bases.alias("b"), _same("v", "b", [*group, "part"])).select(
        "v.conv_id", "v.perspective", (F.col("b.rows") + F.col("v.n")).alias("seq"), "v.turn", "v.role", "v.name", "v.segment",
        start.alias("start"), F.when(trained, start + F.length("v.head")).alias("train_start"),
        F.when(trained, F.length("v.segment") - F.length("v.head") - 1).otherwise(0).cast("long").alias("train_chars"))


def render(rotated: DataFrame) -> DataFrame:
    """Whole renderings, one row per (conv_id, perspective): text and trained spans.
    Gathers a conversation into one row: for conversations of ordinary length."""
    parts = F.array_sort(F.collect_list(F.struct("seq", "segment", "train_start", "train_chars")))
    return (rotated.groupBy("conv_id", "perspective").agg(parts.alias("parts"))
            .select("conv_id", "perspective", F.array_join("parts.segment", "").alias("text"),
                    F.transform(F.filter("parts", lambda p: p["train_chars"] > 0),
                                lambda p: F.struct(p["train_start"].alias("start"), p["train_chars"].alias("chars"))).alias("spans")))
