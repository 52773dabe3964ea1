"""Sums and means that do not depend on the order of their terms.

A double is cut into three whole numbers, which are summed as integers and put
together after the last merge. Values below 2^63 count to 2^-37, far below the
eight decimals at which means are settled, so the mean of equal rows has equal
bits however they are partitioned. The upper numbers hold any sum below 7 * 10^22,
the lower ones any 2^38 rows; beyond, an overflow is an error under ANSI.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units of the three whole numbers; the lower two have 25 bits.
_UPPER, _MIDDLE, _LOWER = 2.0**13, 2.0**-12, 2.0**-37
_LIMIT = 2.0**63
_INTEGRAL = ("tinyint", "smallint", "int")


@dataclass(frozen=True)
class Part:
    """A mergeable piece of a summary: an aggregate over rows, and how two of them become one."""

    name: str
    over_rows: Callable[[], Column]
    merge: Callable[[Column | str], Column] = F.sum


def rows_part() -> Part:
    return Part("_rows", lambda: F.count(F.lit(1)))


def known_part(column: str) -> Part:
    return Part(f"_known:{column}", lambda: F.count(F.col(column)))


def low_part(column: str) -> Part:
    return Part(f"_low:{column}", lambda: F.min(F.col(column)), F.min)


def high_part(column: str) -> Part:
    return Part(f"_high:{column}", lambda: F.max(F.col(column)), F.max)


def trues_part(column: str) -> Part:
    return Part(f"_true:{column}", lambda: F.sum(F.col(column).cast("bigint")))


def with_limbs(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Adds the whole numbers that the sums of the double `columns` are made of.

    Remainders are below 2^13, so what rounding them loses is far below 2^-37.
    Step by step, as the optimiser keeps a column apart that is used twice, so
    nothing is computed twice. Values from 2^63 on, infinities and NaN go to a
    column of their own.
    """
    columns = list(columns)

    def step(df: DataFrame, name: str, made: Callable[[Callable[[str], Column], Column], Column]) -> DataFrame:
        def of(c: str) -> Callable[[str], Column]:
            return lambda other: F.col(f"`{other}:{c}`")

        return df.withColumns({f"{name}:{c}": made(of(c), F.col(c).cast("double")) for c in columns})

    if not columns:
        return df
    df = step(df, "_fits", lambda _, value: F.when(F.abs(value) < _LIMIT, value))
    df = step(df, "_upper", lambda of, _: F.floor(of("_fits") * (1 / _UPPER)))
    df = step(df, "_rest", lambda of, _: of("_fits") - of("_upper") * _UPPER)
    df = step(df, "_middle", lambda of, _: F.floor(of("_rest") * (1 / _MIDDLE)))
    df = step(df, "_lower", lambda of, _: F.floor((of("_rest") - of("_middle") * _MIDDLE) * (1 / _LOWER) + 0.5))
    return step(df, "_beyond", lambda of, value: F.when(of("_fits").isNull(), value))


def is_cut(kind: str) -> bool:
    """Whether sums over this type need `with_limbs`."""
    return kind in ("double", "float")


def sum_parts(column: str, kind: str) -> list[Part]:
    """The parts of an exact sum over `column`, whose type is `kind`."""

    def summed(name: str) -> Part:
        return Part(f"_sum{name}:{column}", lambda: F.sum(F.col(f"`{name}:{column}`")))

    if is_cut(kind):
        return [summed(name) for name in ("_upper", "_middle", "_lower", "_beyond")]
    if kind == "bigint":
        low_half = F.lit(2**32 - 1)
        return [
            Part(f"_high_half:{column}", lambda: F.sum(F.shiftright(F.col(column), 32))),
            Part(f"_low_half:{column}", lambda: F.sum(F.col(column).bitwiseAND(low_half))),
        ]
    if kind in _INTEGRAL:
        return [Part(f"_whole:{column}", lambda: F.sum(F.col(column).cast("bigint")))]
    if kind.startswith("decimal"):
        return [Part(f"_decimal:{column}", lambda: F.sum(F.col(column)))]
    raise ValueError(f"no sum over {column} of type {kind}")


def mean_parts(column: str, kind: str) -> list[Part]:
    return [*sum_parts(column, kind), known_part(column)]


def sum_of_parts(column: str, kind: str) -> Column:
    """The sum, as a double, from merged parts; null without a known value."""

    def part(name: str) -> Column:
        return F.col(f"`{name}:{column}`")

    if is_cut(kind):
        upper, middle, lower = (part(f"_sum{name}").cast("decimal(38,0)") for name in ("_upper", "_middle", "_lower"))
        # In units of 2^-37: at most 2^113.
        exact = upper * F.lit(2**50) + middle * F.lit(2**25) + lower
        finite, beyond = exact.cast("double") * _LOWER, part("_sum_beyond")
        return F.when(beyond.isNull(), finite).otherwise(F.coalesce(finite, F.lit(0.0)) + beyond)
    if kind == "bigint":
        return (part("_high_half").cast("decimal(38,0)") * F.lit(2**32) + part("_low_half")).cast("double")
    return part("_whole" if kind in _INTEGRAL else "_decimal").cast("double")


def mean_of_parts(column: str, kind: str) -> Column:
    """The mean from merged `mean_parts`: one exact sum, one division; null without a known value."""
    known = F.col(f"`_known:{column}`").cast("double")
    return F.when(known > 0, sum_of_parts(column, kind) / known)


def distinct_parts(parts: Iterable[Part]) -> Mapping[str, Part]:
    """By name, each part once."""
    return {part.name: part for part in parts}
