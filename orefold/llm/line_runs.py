"""Repeated runs of lines by prefix doubling over line ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import chunks, lines, text_buffers, words

_PLACE = ["doc_id", "tie", "i"]


def _numbering(min_words: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = {c: batch[c].to_numpy() for c in ("doc_id", "tie")}
            for first, last in chunks(offsets):
                tokens = lines(data, offsets, first, last)
                starts = np.cumsum(tokens.counts) - tokens.counts
                # A line feed ends a word, so the words of a line begin in it.
                begins = words(data, offsets, first, last).start
                n_words = np.searchsorted(begins, tokens.end) - np.searchsorted(begins, tokens.start)
                yield pa.record_batch(
                    {
                        **{c: pa.array(v[first:last][tokens.text]) for c, v in ids.items()},
                        "i": pa.array(np.arange(len(tokens.text)) - starts[tokens.text]),
                        "rank": pa.array(tokens.hashes().view(np.int64)),
                        "long": pa.array(n_words >= min_words),
                    }
                )

    return number


def _cutting():
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, places in zip(batch["text"], batch["places"].to_pylist()):
                parts = text.as_py().split("\n")
                gone = np.zeros(len(parts) + 1, bool)
                copied, reached = [], 0
                for place in sorted(places or (), key=lambda p: (p["i"], -p["n"])):
                    gone[place["i"] : place["i"] + place["n"]] = True
                    if place["i"] + place["n"] > reached:
                        copied.append(place)
                        reached = place["i"] + place["n"]
                gone = gone[:-1]
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                spans = np.stack([edges[::2], edges[1::2]], 1)
                kept = "\n".join(x for x, g in zip(parts, gone.tolist()) if not g)
                longest = int((spans[:, 1] - spans[:, 0]).max(initial=0))
                rows.append((len(parts), int(gone.sum()), len(spans), longest, hashlib.sha256(kept.encode()).hexdigest(), kept, copied))
            names = ("n_lines", "n_removed", "n_runs", "longest_run", "kept_sha256", "kept_text", "copied")
            runs = pa.list_(pa.struct({"i": pa.int64(), "n": pa.int64()}))
            kinds = (pa.int64(),) * 4 + (pa.string(),) * 2 + (runs,)
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.record_batch(
                {"doc_id": batch["given_id"], **{n: pa.array(c, k) for n, k, c in zip(names, kinds, columns)}}
            )

    return cut


def repeated_line_runs(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_lines: int = 2, min_words: int = 50
) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, longest_run, kept_sha256, kept_text, copied of every row.

    Lines are what line feeds separate. A line goes if a run of `min_lines`
    lines that covers it also starts earlier, in a document with a smaller id or
    further up in the same one, or if it has `min_words` words and stands
    earlier by itself; so of every repeated run the first copy stays and later
    ones are cut as far as they agree. `copied` holds the maximal runs that are
    cut (first line `i` from 0, `n` lines): each occurs earlier as a whole, and
    none lies within another. `n_runs` and `longest_run` describe what they
    cover together, the deleted spans.

    Ranks of line runs double in length until none is shared: first the line
    ids, then pairs of the rank at a place and the rank one run further on.
    Places whose rank is unique drop out of every later round. The rounds a
    place survives bound its common prefix, the longest run from there that also
    starts earlier; from the last round back to the first, halving lengths are
    added to it (`_common_prefixes`). Counts and first places are merged before
    they move, so a very common line costs a row per task.

    Line runs are compared by 64-bit hashes. A null or empty text has one empty
    line; blank lines count as lines. Rows equal in id and text are one
    document; texts that share an id are ordered by hash; null ids come last;
    other columns are not looked at.
    """
    if min_lines < 1:
        raise ValueError("a run has a line or more")
    whole = docs.select(
        F.col(key).cast("long").alias("given_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    places = whole.select("doc_id", "tie", "text").mapInArrow(
        _numbering(min_words), "doc_id long, tie long, i long, rank long, long boolean"
    )
    levels = _levels(_repeated(places.distinct(), "lines-1"))
    single = levels[0].filter(F.col("long") & _not_first()).select("doc_id", "tie", "i", F.lit(1).cast("long").alias("n"))
    in_order = Window.partitionBy("doc_id", "tie").orderBy("i")
    runs = (
        _common_prefixes(levels, min_lines)
        .withColumn("covered", (F.lag("i").over(in_order) == F.col("i") - 1) & (F.lag("n").over(in_order) > F.col("n")))
        .filter(~F.coalesce("covered", F.lit(False)))
        .drop("covered")
    )
    later = runs.union(single).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("i", "n")).alias("places"))
    return (
        whole.join(later, ["doc_id", "tie"], "left")
        .select("given_id", "text", "places")
        .mapInArrow(
            _cutting(),
            "doc_id long, n_lines long, n_removed long, n_runs long, longest_run long,"
            " kept_sha256 string, kept_text string, copied array<struct<i: long, n: long>>",
        )
    )


def _not_first() -> Column:
    return F.struct(*_PLACE) != F.col("first")


def _levels(lines: DataFrame) -> list[DataFrame]:
    """The places whose run of 1, 2, 4, ... lines is shared, as long as there are any."""
    levels = [lines]
    while len(levels) == 1 or not levels[-1].isEmpty():
        step = 2 ** (len(levels) - 1)
        in_order = Window.partitionBy("doc_id", "tie").orderBy("i")
        pairs = levels[-1].select(
            *_PLACE,
            F.xxhash64("rank", F.lead("rank", step).over(in_order)).alias("rank"),
            F.lead("i", step).over(in_order).alias("next"),
        )
        # A place in between that has dropped out also rules the longer run out.
        levels.append(_repeated(pairs.filter(F.col("next") == F.col("i") + step).drop("next"), f"lines-{2 * step}"))
    return levels


def _common_prefixes(levels: list[DataFrame], min_lines: int) -> DataFrame:
    """doc_id, tie, i, n: the most lines from a place that also start earlier, if `min_lines` or more.

    A place belongs to the class of runs, of `n` lines, of which it is a later
    copy; the first copy is named by `first`. The last round in which it is a
    later copy gives its class. Then, for every shorter length of the rounds, the
    places of a class that go on with the same run become a class of their own,
    except for the first of them. That one stays, as no earlier place of the
    class goes on as it does, and stands for the others in the old class. So each
    place is held once, in its longest class.
    """
    least = min_lines.bit_length() - 1  # the last round of runs that are not longer than `min_lines`
    held = None
    for level in range(len(levels) - 2, -1, -1):
        if held is not None:
            held = _extended(held, levels[level], 2**level)
        if level >= least:
            further = levels[level + 1].filter(_not_first()).select(*_PLACE)
            stay = levels[level].filter(_not_first()).join(further, _PLACE, "left_anti")
            stay = stay.select(*_PLACE, "rank", F.lit(2**level).cast("long").alias("n"), "first")
            held = stay if held is None else held.union(stay)
    if held is None:
        held = levels[0].select(*_PLACE, "rank", F.lit(0).cast("long").alias("n"), "first")
    return held.filter(F.col("n") >= min_lines).select(*_PLACE, "n")


def _extended(held: DataFrame, shared: DataFrame, step: int) -> DataFrame:
    """`held` after the places of each class have been told apart by the `step` lines that follow."""
    held = materialize(held, "lines-classes")
    firsts = held.select("first.*", "rank", "n").distinct()
    following = shared.select("doc_id", "tie", F.col("i").alias("at"), F.col("rank").alias("then"))
    going_on = (
        held.select(*_PLACE, "rank", "n")
        .union(firsts.select(*_PLACE, "rank", "n"))
        .withColumn("at", F.col("i") + F.col("n"))
        .join(following, ["doc_id", "tie", "at"])
        .select(*_PLACE, F.col("rank").alias("class"), "n", "then")
    )
    going_on = materialize(going_on, "lines-going-on")
    parts = (
        going_on.groupBy("class", "n", "then")
        .agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(*_PLACE)).alias("new_first"))
        .filter("times > 1")
    )
    moved = (
        going_on.join(parts.drop("times"), ["class", "n", "then"])
        .filter(F.struct(*_PLACE) != F.col("new_first"))
        .select(*_PLACE, F.xxhash64("class", "n", "then").alias("new_rank"), "new_first")
    )
    is_moved = F.col("new_first").isNotNull()
    return held.join(moved, _PLACE, "left").select(
        *_PLACE,
        F.coalesce("new_rank", "rank").alias("rank"),
        F.when(is_moved, F.col("n") + step).otherwise(F.col("n")).alias("n"),
        F.when(is_moved, F.col("new_first")).otherwise(F.col("first")).alias("first"),
    )


def _repeated(places: DataFrame, label: str) -> DataFrame:
    """The places whose rank occurs twice or more, with its first place."""
    places = materialize(places, f"{label}-ranks")
    shared = (
        places.groupBy("rank")
        .agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(*_PLACE)).alias("first"))
        .filter("times > 1")
    )
    return materialize(places.join(shared.drop("times"), "rank"), label)
