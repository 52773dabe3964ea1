"""Ordering: rank over a whole table, top rows and business orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

def global_rank(df: DataFrame, score: str, name: str, kind: str = "int") -> DataFrame:
    """Add the rank by descending `score` over all rows; ties share a rank.

    Same values as `rank()` over an unpartitioned window, without moving every
    row to one task: the rank of a score is one more than the number of rows
    with a higher score. Rows are counted per score, the scores sorted by range
    into partitions, and counts summed up inside each partition; one row per
    partition says how many rows the partitions before it hold. Nulls come last.

    `df` is read twice; hand in a stored table, not a long computation. The
    ranks, one row per score, are stored as well: with their size known the
    planner broadcasts them if they are small, and `df` is not shuffled at all.
    """
    descending = F.desc_nulls_last("_score")
    ranges = materialize(
        df.groupBy(F.col(score).alias("_score"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .repartitionByRange(descending)
        .withColumn("_range", F.spark_partition_id()),
        f"{name}-ranges",
    )
    before = (Window.unboundedPreceding, -1)
    totals = (
        ranges.groupBy("_range")
        .agg(F.sum("_rows").alias("_total"))
        .select(
            F.col("_range").alias("_of"),
            F.sum("_total").over(Window.orderBy("_range").rowsBetween(*before)).alias("_above"),
        )
    )
    inside = ranges.withColumn(
        "_higher",
        F.sum("_rows").over(Window.partitionBy("_range").orderBy(descending).rowsBetween(*before)),
    )
    ahead = F.coalesce("_above", F.lit(0)) + F.coalesce("_higher", F.lit(0))
    ranks = inside.join(totals, F.col("_range") == F.col("_of")).select(
        "_score", (ahead + 1).cast(kind).alias(name)
    )
    stored = materialize(ranks, name)
    return df.join(stored, F.col(score).eqNullSafe(F.col("_score")), "left").drop("_score")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First `k` rows in a total order; each task keeps at most `k` rows."""
    return df.orderBy(*order).limit(k)


def first_rows(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Any `n` rows of the named columns, for a look at a table."""
    return df.select(*columns).limit(n)


def ordinal(column: str, order: Sequence[str]) -> Column:
    """Position of the value in `order`, counted from one; others come after."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    return F.when(place > 0, place.cast("int")).otherwise(F.lit(len(order) + 1))
