"""Row-level measures derived from cleaned columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_value


def safe_ratio(numerator: str, denominator: str, digits: int) -> Column:
    """Rounded quotient; null unless the denominator is known and positive."""
    top, bottom = F.col(numerator), F.col(denominator)
    return F.when(bottom > 0, round_value(top / bottom, digits))


def band(
    column: str, cuts: Sequence[tuple[float, str]], top: str, missing: str
) -> Column:
    """Name of the first cut the value is below, else `top`; nulls get `missing`."""
    value = F.col(column)
    below = reduce(
        lambda chain, cut: chain.when(value < cut[0], cut[1]), cuts[1:],
        F.when(value < cuts[0][0], cuts[0][1]),
    )
    return below.when(value.isNotNull(), top).otherwise(missing)


def weighted_blend(weights: Mapping[str, float], digits: int) -> Column:
    """Rounded weighted sum; null as soon as one part is null."""
    terms = [F.col(name) * F.lit(float(weight)) for name, weight in weights.items()]
    return round_value(reduce(add, terms), digits)


def flag(column: str, value: str) -> Column:
    """True where the column equals `value`, false otherwise, never null."""
    return F.coalesce(F.col(column) == value, F.lit(False))
