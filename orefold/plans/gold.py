"""Gold tables: a filter, a grouped summary and, if wanted, a global rank."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import Measure, all_parts, cut_means, finished, global_rank, summarize
from ..session import materialize
from ..sources import read_table


@dataclass(frozen=True)
class RankBy:
    score: str
    name: str


@dataclass(frozen=True)
class GoldTable:
    """Conditions and orders are callables, as a Column needs a live session."""

    name: str
    keys: Sequence[str]
    measures: Sequence[Measure]
    where: Callable[[], Column] | None = None
    rank: RankBy | None = None
    order: Callable[[], Column] | None = None


def build_gold(silver: DataFrame, table: GoldTable) -> DataFrame:
    kept = silver if table.where is None else silver.filter(table.where())
    groups = summarize(kept, table.keys, table.measures)
    if table.rank is None:
        return groups
    # Ranking reads the groups twice; stored, the facts are scanned only once.
    return _ranked(materialize(groups, table.name), table)


def _ranked(groups: DataFrame, table: GoldTable) -> DataFrame:
    return groups if table.rank is None else global_rank(groups, table.rank.score, table.rank.name)


def _inside(table: GoldTable) -> Column:
    return F.lit(True) if table.where is None else F.coalesce(table.where(), F.lit(False))


def group_finest(tables: Sequence[GoldTable]) -> Column:
    """Names the group a row falls into if no table's keys are left out."""
    keys = dict.fromkeys(key for table in tables for key in table.keys)
    return F.xxhash64(*keys, *[_inside(table) for table in tables])


def gold_parts(silver: DataFrame, tables: Sequence[GoldTable], *, pre_aggregate: bool = False) -> DataFrame:
    """The mergeable parts of all tables from one scan of `silver`.

    Column `_table` is the place in `tables`, `_key<place>:<name>` its keys.
    Each row meets the key set of every table (one Expand) and is merged per
    group within its map task, so what is shuffled are the groups of all
    tables. A row outside a table's filter falls into one group that is
    dropped. `pre_aggregate` first sums up by all keys together: right where
    these make far fewer groups than there are rows, as then the rows are
    not multiplied, and only then.
    """
    measures = [m for table in tables for m in table.measures]
    parts = all_parts(measures, dict(silver.dtypes))
    keys = dict.fromkeys(key for table in tables for key in table.keys)
    flags = [f"_in{i}" for i in range(len(tables))]
    flagged = silver.withColumns({flag: _inside(table) for flag, table in zip(flags, tables)})
    prepared = cut_means(flagged, measures)
    if pre_aggregate:
        prepared = prepared.groupBy(*keys, *flags).agg(*[p.over_rows().alias(p.name) for p in parts])
        aggregates = [p.merge(f"`{p.name}`").alias(p.name) for p in parts]
    else:
        aggregates = [p.over_rows().alias(p.name) for p in parts]

    sets = [[flag, *(f"_key{i}:{key}" for key in table.keys)] for i, (flag, table) in enumerate(zip(flags, tables))]
    own_keys = {
        f"_key{i}:{key}": F.when(F.col(flag), F.col(key))
        for i, (flag, table) in enumerate(zip(flags, tables))
        for key in table.keys
    }
    expanded = prepared.withColumns(own_keys).groupingSets(
        [[F.col(f"`{name}`") for name in names] for names in sets], *[F.col(f"`{name}`") for names in sets for name in names]
    )
    grouped = expanded.agg(*[F.grouping(flag).alias(f"{flag}_out") for flag in flags], *aggregates)
    place = F.coalesce(*[F.when(F.col(f"{flag}_out") == 0, F.lit(i)) for i, flag in enumerate(flags)])
    # In the group of table i only the flag of table i is set.
    inside = grouped.withColumn("_table", place).filter(F.coalesce(*flags))
    return inside.drop(*flags, *[f"{flag}_out" for flag in flags])


def build_gold_tables(
    silver: DataFrame, tables: Sequence[GoldTable], *, pre_aggregate: bool = False
) -> dict[str, DataFrame]:
    """All `tables` by name, with one scan of `silver` for them together.

    The parts are stored, partitioned by table, so each frame reads its own.
    """
    if not tables:
        return {}
    types = dict(silver.dtypes)
    stored = materialize(gold_parts(silver, tables, pre_aggregate=pre_aggregate), "gold-parts", ["_table"])

    def table_of(i: int, table: GoldTable) -> DataFrame:
        keys = [F.col(f"`_key{i}:{key}`").alias(key) for key in table.keys]
        return _ranked(finished(stored.filter(F.col("_table") == i), keys, table.measures, types), table)

    return {table.name: table_of(i, table) for i, table in enumerate(tables)}


def read_gold(spark: SparkSession, layer: str, table: GoldTable) -> DataFrame:
    """A published gold table in its reading order.

    Sorting belongs here: a sort before the write costs a range shuffle and is
    not kept by the readers of the files anyway. The group keys break ties, so
    that many rows with one value can still be spread over tasks.
    """
    stored = read_table(spark, f"{layer}.{table.name}")
    return stored if table.order is None else stored.orderBy(table.order(), *table.keys)
