"""Adding the columns of a dimension to a fact table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .ranking import top_k


def dimension_snapshot(
    df: DataFrame,
    where: Column,
    rename: Mapping[str, str],
    drop: Iterable[str] = (),
) -> DataFrame:
    """The dimension rows valid for the join, renamed so that no name collides.

    The filter comes first, so that it can reach the scan.
    """
    return df.filter(where).drop(*drop).withColumnsRenamed(dict(rename))


def require_unique(dim: DataFrame, key: str) -> DataFrame:
    """`dim`, failing at run time if a non-null key occurs twice.

    The check is a scalar subquery over the key column alone, so it runs inside
    the query that uses `dim` and leaves the shape of a later join as it is.
    """
    most = (
        dim.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.max("rows"), F.lit(0)).alias("most"))
        .scalar()
    )
    complaint = F.raise_error(F.lit(f"dimension key {key} is not unique"))
    return dim.filter(F.when(most <= 1, F.lit(True)).otherwise(complaint))


def hot_keys(facts: DataFrame, key: str, limit: int) -> Column:
    """The `limit` most frequent keys as an array, a scalar subquery.

    Counting merges map-side and each task keeps `limit` keys, so neither a hot
    key nor many rare ones end up in one place. A key with more than 1/limit of
    all rows is always among them.
    """
    frequent = (
        facts.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .transform(top_k, [F.desc("rows"), key], limit)
    )
    return frequent.agg(F.collect_list(key).alias("hot")).scalar()


# Keys that the sketch of frequent ones holds; see `frequent_keys`.
SKETCH_ITEMS = 2048


def frequent_keys(key: Column, limit: int, items: int = SKETCH_ITEMS) -> Column:
    """The `limit` most frequent values as an aggregate that merges, an array of (item, count).

    A sketch of frequent items in bounded memory, so it can be observed while
    rows are written for another reason. Counts are too low by at most 3.5 /
    `items` of the rows, and a value with more than twice that share is always
    held; as long as there are fewer values than `items` all counts are exact.
    A task that runs again counts twice.
    """
    return F.call_function("approx_top_k", key, F.lit(limit), F.lit(items))


def enrich_left(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    *,
    unique: bool = True,
    salt_buckets: int = 0,
    hot_limit: int = 100,
    keys: DataFrame | None = None,
    hot: Sequence[Any] | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Left join on the one key column; facts without a match keep nulls.

    No broadcast is forced: the planner broadcasts `dim` when its measured size
    allows. Otherwise both sides shuffle on the key and adaptive execution
    splits a hot partition. With `salt_buckets` the `hot_limit` most frequent
    keys and the null key are spread explicitly: their facts over that many
    buckets by row hash, and only their dimension rows are repeated per bucket.
    That also works where the join output feeds an aggregation on the same key,
    which keeps adaptive execution from splitting. The frequent keys are counted
    on `keys`, a frame with the key column, or else on the facts themselves,
    which runs the plan of the facts once more; `hot` names them where they are
    known already, as from `frequent_keys`, and nothing is counted.

    With `shuffled` both sides shuffle on the key, also where `dim` is small
    enough to broadcast, so that the rows of a key come out together and are summed
    up by it with few groups per task. The facts are not sorted, but each task holds
    its part of `dim`; meant for one that is not far from being broadcast.

    `unique=False` lets a dimension with several rows per key multiply facts.
    """
    checked = require_unique(dim, on) if unique else dim
    if shuffled:
        checked = checked.hint("shuffle_hash")
    if not salt_buckets:
        return facts.join(checked, on=on, how="left")

    key = F.col(on)
    if hot is None:
        listed = hot_keys(facts if keys is None else keys, on, hot_limit)
    else:
        listed = F.array(*map(F.lit, hot)).cast(ArrayType(facts.schema[on].dataType))
    # A function of the row, so a re-run task sends it to the same place again.
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(salt_buckets)).cast("int")
    every_bucket = F.sequence(F.lit(0), F.lit(salt_buckets - 1))
    salted_facts = facts.withColumn(
        "_salt",
        F.when(key.isNull() | F.array_contains(listed, key), spread).otherwise(F.lit(0)),
    )
    salted_dim = checked.withColumn(
        "_salt",
        F.explode(
            F.when(F.array_contains(listed, key), every_bucket).otherwise(F.array(F.lit(0)))
        ),
    )
    return salted_facts.join(salted_dim, on=[on, "_salt"], how="left").drop("_salt")
