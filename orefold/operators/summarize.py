"""Grouped summaries described by data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_mean
from ..functions.exact import (
    Part,
    distinct_parts,
    high_part,
    is_cut,
    low_part,
    mean_of_parts,
    mean_parts,
    rows_part,
    trues_part,
    with_limbs,
)


@dataclass(frozen=True)
class Measure:
    """One output column of a summary.

    kind: `mean`, `low`, `high` (rounded to `digits`), `rows`, `true_rows`
    or `true_percent`; all but `rows` need a `column`.
    """

    name: str
    kind: str
    column: str | None = None
    digits: int = 0

    def parts(self, types: Mapping[str, str]) -> list[Part]:
        """The mergeable aggregates this measure is made of; `types` of the columns."""
        if self.kind == "rows":
            return [rows_part()]
        if self.kind == "mean":
            return mean_parts(self.column, types[self.column])
        if self.kind == "low":
            return [low_part(self.column)]
        if self.kind == "high":
            return [high_part(self.column)]
        if self.kind == "true_rows":
            return [trues_part(self.column)]
        if self.kind == "true_percent":
            return [trues_part(self.column), rows_part()]
        raise ValueError(f"unknown measure kind {self.kind!r}")

    def finish(self) -> Column:
        """The output column from merged parts; means are in `_mean:<column>`."""

        def part(name: str) -> Column:
            return F.col(f"`{name}:{self.column}`")

        if self.kind == "rows":
            made = F.col("_rows")
        elif self.kind == "mean":
            made = round_mean(part("_mean"), self.digits)
        elif self.kind == "low":
            made = F.round(part("_low"), self.digits)
        elif self.kind == "high":
            made = F.round(part("_high"), self.digits)
        elif self.kind == "true_rows":
            made = part("_true")
        else:
            made = round_mean(part("_true") * 100.0 / F.col("_rows"), self.digits)
        return made.alias(self.name)


def all_parts(measures: Sequence[Measure], types: Mapping[str, str]) -> list[Part]:
    """The parts of all measures, those they share once."""
    return list(distinct_parts(part for m in measures for part in m.parts(types)).values())


def cut_means(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Adds what the means over doubles are summed from."""
    types = dict(df.dtypes)
    averaged = dict.fromkeys(m.column for m in measures if m.kind == "mean")
    return with_limbs(df, [c for c in averaged if is_cut(types[c])])


def finished(merged: DataFrame, keys: Sequence[str | Column], measures: Sequence[Measure], types: Mapping[str, str]) -> DataFrame:
    """The keys and measures from one row of merged parts per group."""
    averaged = dict.fromkeys(m.column for m in measures if m.kind == "mean")
    # Columns of their own, as rounding looks at a mean more than once.
    means = merged.withColumns({f"_mean:{c}": mean_of_parts(c, types[c]) for c in averaged})
    return means.select(*keys, *[m.finish() for m in measures])


def summarize(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Group by `keys` (null is a group of its own) and compute the measures.

    Every measure merges from partial results, so each map task sends one row
    per group and a hot group costs its reducer no more than any other. Means
    come from exact sums: the partitioning does not show in any bit.
    """
    types = dict(df.dtypes)
    parts = [part.over_rows().alias(part.name) for part in all_parts(measures, types)]
    return finished(cut_means(df, measures).groupBy(*keys).agg(*parts), keys, measures, types)
