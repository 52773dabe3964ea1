"""Dialogues seen by each participant, with training masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

END = "<|end|>\n"


def escaped(said: Column) -> Column:
    """Without the characters that begin a mark, so that no text or role can forge one."""
    return F.replace(said, F.lit("<|"), F.lit("<\\|"))


def numbered_turns(turns: DataFrame, *, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, role, text and the place `i` of each row in its conversation.

    Sorted by range, so that one long conversation spans several partitions;
    places count inside a partition and go on from the rows of earlier ones.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        escaped(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    cut = materialize(
        rows.repartitionByRange(*order).withColumn("shard", F.spark_partition_id()), "chat-turns"
    )
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.groupBy("conv_id", "shard")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("conv_id").alias("of"),
            F.col("shard").alias("at"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("conv_id", "shard").orderBy("turn", "role", "text"))
    return (
        cut.withColumn("n", inside)
        .join(before, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("at")))
        .select("conv_id", "role", "text", (F.col("before") + F.col("n") - 1).alias("i"))
    )


def perspectives(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    narrators: Sequence[str] = ("system",),
    part_turns: int = 64,
) -> DataFrame:
    """conv_id, speaker, part, n_turns, n_trained, text, mask.

    Every participant of a conversation in turn is the assistant; the other ones
    are users with their names, and narrators are the system, which nobody
    plays. The text renders up to `part_turns` turns, in order; `mask` lists the
    (start, end) characters to train on: what the assistant says and the end
    mark after it. Long conversations continue in further parts, so no row grows
    without bound, and all participants get the same parts.

    Turns with equal numbers are ordered by role and text; null numbers come
    first; null roles are "unknown" and null texts empty; rows with null conv_id
    form one conversation; repeated rows are repeated turns; an empty table
    gives no rows; marks in a text or role are escaped. Other columns are not looked at.
    """
    placed = materialize(numbered_turns(turns, conv=conv, turn=turn, role=role, text=text), "chat-placed")
    parts = (
        placed.groupBy("conv_id", F.floor(F.col("i") / part_turns).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("i", "role", "text"))).alias("said"))
    )
    speakers = (
        placed.filter(~F.col("role").isin(*narrators))
        .select(F.col("conv_id").alias("of"), F.col("role").alias("speaker"))
        .distinct()
    )
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
    mine = lambda t: t["role"] == F.col("speaker")

    def head(t: Column) -> Column:
        return (
            F.when(mine(t), F.lit("<|assistant|>\n"))
            .when(t["role"].isin(*narrators), F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), escaped(t["role"]), F.lit("|>\n")))
        )

    def add(a: Column, t: Column) -> Column:
        start = a["at"] + F.length(head(t))
        end = start + F.length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(mine(t), F.concat(a["mask"], span)).otherwise(a["mask"]).alias("mask")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    return seen.select(
        "conv_id",
        "speaker",
        F.col("part").cast("long").alias("part"),
        F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("said", mine)).cast("long").alias("n_trained"),
        F.array_join(F.transform("said", lambda t: F.concat(head(t), t["text"], F.lit(END))), "").alias("text"),
        F.aggregate("said", start, add, lambda a: a["mask"]).alias("mask"),
    )
