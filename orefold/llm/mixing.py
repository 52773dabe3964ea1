"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Hash bits that each level of the histogram resolves. What is left after the
# last level, 60 bits in all, is told apart by the hash itself.
_LEVELS = (12, 14)
_HASH_BITS = 60


def mix_hash(*columns: Column, seed: str) -> Column:
    """60 bits of an md5 as a long: uniform, and the same in any engine."""
    text = F.concat_ws("/", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    max_repeats: int = 3,
) -> DataFrame:
    """(source, source_size, target) for the sizes summed up per source.

    Sources in code point order, null last, take the `weights` in turn. Each is
    due its part by weight of `share` of all sizes, but at most `max_repeats`
    times its own size; what that cuts off is dealt to the others by weight
    until nobody is above. With the sources ordered by the level at which they
    fill up, the final level is the highest of the levels that remain after
    filling the first 0, 1, 2, ... of them.

    One row per source is ranked in one task; documents are not.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(by_name) - 1
    turn = F.array(*[F.lit(int(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(turn, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    cap = F.col("source_size") * max_repeats
    filling = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        weighed.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .select("source", "source_size", F.least(cap.cast("double"), F.col("_level") * F.col("weight")).alias("target"))
    )


def mix_sources(
    docs: DataFrame,
    *,
    size: Column,
    key: Sequence[str] = ("doc_id",),
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    max_repeats: int = 3,
    seed: str = "mix",
    whole_rows: bool = False,
) -> DataFrame:
    """`key`, source, size, source_size, target and copies of every document.

    `copies` says how often the mix repeats the document. A source takes each
    document target / source_size times rounded down, and for the rest of its
    budget those with the smallest hashes of `key`: a threshold that two
    histograms of (source, hash bucket) sums find, the second over the one
    bucket of each source that the first leaves open, and then the hashes
    inside the one bucket that the second leaves open. Budgets are nested: a
    larger one takes the same documents and more. Nothing is sorted but
    histogram rows, and only sums are shuffled.

    Null sources form one source, null sizes count 0, rows with equal keys
    share a hash and are taken together, an empty table stays empty, a source
    without words takes nothing, and columns not named here are not looked at.
    Reruns agree, as the hash is a function of the key. With `whole_rows` the
    result is each given row as the struct `row` with its copies, from a second
    scan instead of a join.
    """
    hashed = mix_hash(*[F.col(c) for c in key], seed=seed).alias("_hash")
    base = materialize(
        docs.select(
            *[F.col(c) for c in key],
            F.col(source).alias("source"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            hashed,
        ),
        "mixing",
    )
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = materialize(
        source_targets(sizes, weights, share, max_repeats)
        .withColumn("_whole", F.coalesce(whole, F.lit(0)).cast("long"))
        .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")),
        "mixing-targets",
    )
    last = _thresholds(base, targets)
    budget = targets.join(last, F.col("source").eqNullSafe(F.col("_of")), "left").select(
        F.col("source").alias("_name"), "source_size", "target", "_whole", "_last"
    )
    # A row per source: stored, its size is known and the documents need no shuffle by a few sources.
    budget = materialize(budget, "mixing-budget")
    one_more = (F.col("_hash") <= F.coalesce("_last", F.lit(-1))).cast("long")
    copies = F.least(F.col("_whole") + one_more, F.lit(max_repeats)).alias("copies")
    if whole_rows:
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        base, shown = docs.select(row, F.col(source).alias("source"), hashed), ["row"]
    else:
        shown = [*key, "source", "size", "source_size", "target"]
    return base.join(budget, F.col("source").eqNullSafe(F.col("_name")), "left").select(*shown, copies)


def _thresholds(base: DataFrame, targets: DataFrame) -> DataFrame:
    """(_of source, _last hash): documents up to that hash fill the rest best."""
    open_ = targets.select(
        F.col("source").alias("_of"), "_rest",
        F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_before"),
    )
    bits = 0
    for level in _LEVELS:
        bits += level
        unit = 2 ** (_HASH_BITS - bits)
        open_ = materialize(_open_bucket(base, open_, 2 ** (_HASH_BITS - bits + level), unit), f"mixing-{bits}")
    inside = _cumulated(base, open_, unit, 1)
    # The hash whose middle still lies inside the budget is the last one taken.
    taken = F.col("_start") + F.col("_sum") / 2 <= F.col("_rest")
    last = inside.groupBy("_of", "_prefix").agg(F.max(F.when(taken, F.col("_bucket"))).alias("_found"))
    return last.select("_of", F.coalesce("_found", F.col("_prefix") * unit - 1).alias("_last"))


def _cumulated(base: DataFrame, open_: DataFrame, width: int, unit: int) -> DataFrame:
    """Sums per bucket of `unit` hashes inside the open buckets of `width` hashes."""
    same_source = F.col("source").eqNullSafe(F.col("_of"))
    chosen = base.join(open_, same_source & (F.expr(f"_hash div {width}") == F.col("_prefix")))
    sums = chosen.groupBy("_of", "_prefix", "_rest", "_before", F.expr(f"_hash div {unit}").alias("_bucket")).agg(F.sum("size").alias("_sum"))
    so_far = Window.partitionBy("_of").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_sum").over(so_far), F.lit(0)))


def _open_bucket(base: DataFrame, open_: DataFrame, width: int, unit: int) -> DataFrame:
    """The bucket of each source in which its budget ends."""
    cumulated = _cumulated(base, open_, width, unit)
    ends_here = (F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_sum"))
    return cumulated.filter(ends_here).select(
        "_of", "_rest", F.col("_bucket").alias("_prefix"), F.col("_start").alias("_before")
    )
