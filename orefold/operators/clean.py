"""Cleaning of raw string tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import normalized, unmasked
from ..session import materialize


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def sentinel_to_null(
    df: DataFrame, columns: Iterable[str] | None = None, sentinel: str = "?"
) -> DataFrame:
    """Turn the masked null into a real one; `None` means every string column."""
    names = string_columns(df) if columns is None else columns
    return df.withColumns({name: unmasked(F.col(name), sentinel) for name in names})


def cast_columns(
    df: DataFrame, types: Mapping[str, str], lenient: bool = False
) -> DataFrame:
    """Cast columns to the given types.

    Strict casts raise on malformed text, whatever the session's ANSI setting;
    it is looked at when the plan is made.
    Lenient ones give null; `reject_counters` tells how often.
    """

    have = dict(df.dtypes)
    ansi = df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"

    def strict(name: str, kind: str) -> Column:
        if have[name] == kind:  # nothing can fail, and filters still reach the scan
            return F.col(name)
        if ansi:  # the cast itself raises, and stays one expression where filters copy it
            return F.col(name).cast(kind)
        tried = F.col(name).try_cast(kind)
        complaint = F.concat(F.lit(f"CAST_INVALID_INPUT: column {name} holds no {kind}: "), F.col(name).cast("string"))
        malformed = F.col(name).isNotNull() & tried.isNull()
        return F.when(malformed, F.raise_error(complaint).cast(kind)).otherwise(tried)

    return df.withColumns(
        {
            name: F.col(name).try_cast(kind) if lenient else strict(name, kind)
            for name, kind in types.items()
        }
    )


def reject_counters(types: Mapping[str, str]) -> list[Column]:
    """Per column, how many non-null values a lenient cast would turn into null."""
    return [
        F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).alias(name)
        for name, kind in types.items()
    ]


def count_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row with the reject count of every column."""
    return df.agg(*reject_counters(types))


def rejected_values(
    df: DataFrame, types: Mapping[str, str], keep: Sequence[str] = (), row_columns: Sequence[str] | None = None
) -> DataFrame:
    """A row per value that a lenient cast would turn into null: `keep`, column, value, row.

    `row` is the whole row as JSON, of `row_columns` or else all columns, nulls
    included; it is only written out for rows with a malformed value.
    """
    entries = F.array(
        *[
            F.when(
                F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(),
                F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")),
            )
            for name, kind in types.items()
        ]
    )
    if not types:
        entries = F.array().cast("array<struct<column:string,value:string>>")
    whole = F.to_json(F.struct(*(row_columns or df.columns)), {"ignoreNullFields": "false"})
    met = df.withColumn("_met", F.array_compact(entries)).filter(F.size("_met") > 0)
    return met.select(F.explode("_met").alias("_one"), *keep, whole.alias("row")).select(
        "_one.column", "_one.value", "row", *keep
    )


def normalize_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: normalized(F.col(name)) for name in columns})


def dedupe(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; nulls count as equal.

    Every column is part of the shuffle key, so project to the columns that
    matter first. Copies within a map task collapse before the shuffle, which
    keeps a row with very many copies from flooding one reducer.
    """
    return df.dropDuplicates()


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row as two longs; rows that are equal as groups have equal ones.

    Never null. Nulls are hashed as such: alone they would be passed over, and rows that
    differ by the place of a null would meet.
    """
    nulls = F.concat(*[F.col(name).isNull().cast("int").cast("string") for name in columns])
    backwards = list(reversed(columns))
    return [F.xxhash64(nulls, *columns).alias("_print_a"), F.xxhash64(F.lit("b"), *backwards, nulls).alias("_print_b")]


def dedupe_by_fingerprint(df: DataFrame, prints: Callable[[Sequence[str]], list[Column]] = fingerprint) -> DataFrame:
    """The rows of `dedupe`, shuffling 16 bytes a row instead of whole rows.

    Fingerprints are counted first. A row whose fingerprint is its own has no
    copy and goes through untouched; rows that share one are compared as a
    whole, so a collision loses nothing. The repeated fingerprints are stored:
    with their measured size the planner broadcasts them if they are few, and
    unique rows are then never moved. `df` is computed twice; hand in a stored
    table or a few row-wise steps over one. Made for wide, mostly unique tables:
    with many copies `dedupe` is the better one, as it drops them in the map
    tasks.
    """
    named = prints(df.columns)
    pair = ["_print_a", "_print_b"]
    repeated = materialize(
        df.select(*named).groupBy(*pair).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(*pair), "copies"
    )
    marked = df.select("*", *named)
    single = marked.join(repeated, pair, "left_anti").select(*df.columns)
    return single.union(marked.join(repeated, pair, "left_semi").select(*df.columns).dropDuplicates())


def dedupe_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after de-duplication on `keys`, rows removed."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    before = F.coalesce(F.sum("copies"), F.lit(0))
    after = F.count(F.lit(1))
    return per_key.agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
    )
