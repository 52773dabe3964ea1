"""Dashboard panels as queries over gold tables.

Each takes a stored gold table; the ones that need a grand total read it twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import round_mean
from ..functions.exact import mean_parts, sum_of_parts, sum_parts, with_limbs
from ..operators import Measure, summarize, top_k


def distinct_kpi(gold: DataFrame, column: str, name: str) -> DataFrame:
    return gold.agg(F.count_distinct(column).alias(name))


def mean_kpi(gold: DataFrame, column: str, name: str, digits: int = 2) -> DataFrame:
    """Unweighted mean over the rows of the gold table: a mean of group means."""
    return summarize(gold, [], [Measure(name, "mean", column, digits)])


def bars(gold: DataFrame, label: str, value: str, color: str) -> DataFrame:
    return gold.select(label, value, color).orderBy(F.desc(value), label, color)


def donut(gold: DataFrame, label: str, value: str, share: str = "share_pct") -> DataFrame:
    """Value and its percentage of the total, largest first."""
    total = gold.agg(F.sum(value)).scalar()
    part = round_mean(F.try_divide(F.col(value) * 100.0, total), 2)
    return gold.select(label, value, part.alias(share)).orderBy(F.desc(value), label)


def top_bars(gold: DataFrame, label: str, value: str, color: str, k: int = 10) -> DataFrame:
    return top_k(gold.select(label, value, color), [F.desc(value), label, color], k)


def scatter(gold: DataFrame, x: str, y: str, size: str, tooltip: str) -> DataFrame:
    """Points with both coordinates; one without a coordinate cannot be drawn."""
    placed = F.col(x).isNotNull() & F.col(y).isNotNull()
    return gold.filter(placed).select(tooltip, x, y, size)


def matrix(gold: DataFrame, row: str, weight: str, values: Mapping[str, int]) -> DataFrame:
    """Group means rolled up per row, each group counting by its `weight`."""
    # Exact sums of value times weight and of weight: a mean over mean-parts each.
    products = {f"_product:{name}": F.col(name) * F.col(weight) for name in values}
    known = {f"_weight:{name}": F.when(F.col(name).isNotNull(), F.col(weight).cast("bigint")) for name in values}
    weighed = gold.withColumns({**products, **known})
    cut = with_limbs(weighed, products)
    parts = [
        part
        for name in values
        for part in (*mean_parts(f"_product:{name}", "double"), *sum_parts(f"_weight:{name}", "bigint"))
    ]
    rolled = cut.groupBy(row).agg(*[part.over_rows().alias(part.name) for part in parts])
    sums = rolled.withColumns(
        {
            f"_mean:{name}": F.try_divide(sum_of_parts(f"_product:{name}", "double"), sum_of_parts(f"_weight:{name}", "bigint"))
            for name in values
        }
    )
    return sums.select(row, *[round_mean(F.col(f"`_mean:{name}`"), digits).alias(name) for name, digits in values.items()])


def treemap(gold: DataFrame, group: str, value: str) -> DataFrame:
    return gold.groupBy(group).agg(F.sum(value).alias(value))
