"""Repeated byte strings: prefix doubling over sampled positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import PrefixHashes, chunks, mix, text_buffers

_LOW = np.uint64(0xFFFFFFFF)
# Occurrences in a chunk from which on a seed counts as frequent there.
_OFTEN = 16
_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


class Windows:
    """All strings of `length` bytes of some texts, by rolling hashes.

    The sampled positions are those whose first `seed` bytes have the smallest
    hash among the seeds inside some string of `length` bytes (the leftmost of
    equal ones). So every string has one sampled position, and equal strings
    have theirs at the same place.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
        n = len(data)
        self.offsets, self.length = offsets, length
        self.hash = PrefixHashes(data)
        sizes = np.diff(offsets)
        ends = np.repeat(offsets[1:], sizes) if n else np.zeros(0, np.int64)
        #: starts of the strings that lie inside one text
        self.starts = np.flatnonzero(np.arange(n) + length <= ends)
        if not len(self.starts):
            self.sampled = np.zeros(0, np.int64)
            return
        seeds = self.hash.windows(seed)
        ranked = (seeds & ~_LOW) | np.arange(len(seeds), dtype=np.uint64)
        lowest = sliding_minimum(ranked, length - seed + 1)
        #: sampled position of each string
        self.sampled = (lowest[self.starts] & _LOW).astype(np.int64)
        self.seeds = seeds

    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions with the first and last string that each belongs to."""
        if not len(self.starts):
            return self.sampled, self.starts, self.starts
        new = np.ones(len(self.starts), bool)
        new[1:] = self.sampled[1:] != self.sampled[:-1]
        begin = np.flatnonzero(new)
        finish = np.append(begin[1:], len(new)) - 1
        return self.sampled[begin], self.starts[begin], self.starts[finish]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i : i + width] for each i, cut at the end."""
    n = len(values)
    blocks = -(-n // width) + 1
    grid = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = values
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


# Rows of hot seeds: runs of later strings, runs of strings that may be the first, strings.
_LATER, _OPEN, _STRING = 0, 1, 2


def _bytes_of(batch: pa.RecordBatch, length: int, seed: int):
    data, offsets = text_buffers(batch["text"])
    for first, last in chunks(offsets):
        part = offsets[first : last + 1]
        yield first, last, Windows(data[part[0] : part[-1]], part - part[0], length, seed)


def _sampling(length: int, seed: int, buckets: int):
    """Seed hashes of the sampled positions with their texts, dealt by hash.

    A hash that is frequent in a chunk is repeated for sure: its entries go to
    any bucket, and two of them to its own, to tell the other chunks. So a hot
    seed sends its bucket two entries per chunk.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text_a"].to_numpy()
            for first, last, windows in _bytes_of(batch, length, seed):
                at, _, _ = windows.samples()
                if not len(at):
                    continue
                hashes = windows.seeds[at]
                text = texts[first:last][np.searchsorted(windows.offsets, at, "right") - 1]
                order = np.argsort(hashes, kind="stable")
                hashes, text = hashes[order], text[order]
                begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
                times = np.diff(np.append(begin, len(hashes)))
                place = np.arange(len(hashes)) - np.repeat(begin, times)
                often = np.repeat(times, times) >= _OFTEN
                for sure, use in ((False, ~often | (place < 2)), (True, often)):
                    h, t = hashes[use], text[use]
                    if not len(h):
                        continue
                    by = t.view(np.uint64) if sure else h
                    bucket = (mix(by) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                    parts = np.split(order, cuts[1:])
                    yield pa.record_batch(
                        {
                            "bucket": pa.array(bucket[order][cuts]),
                            "sure": pa.array([sure] * len(parts)),
                            "hashes": pa.array([h[p].tobytes() for p in parts], pa.binary()),
                            "texts": pa.array([t[p].tobytes() for p in parts], pa.binary()),
                        }
                    )

    return sample


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with equal `key` from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        ids = batch[key].to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1][key][0].as_py() != ids[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(of text_a, seed hash) of the sampled positions whose seed is not unique."""
    for group in _groups(batches, "bucket"):
        for sure in (False, True):
            part = group.filter(pa.compute.equal(group["sure"], sure))
            hashes, texts = _joined(part["hashes"], np.uint64), _joined(part["texts"], np.int64)
            if not sure:
                order = np.argsort(hashes)
                hashes, texts = hashes[order], texts[order]
                same = np.zeros(len(hashes), bool)
                same[1:] = hashes[1:] == hashes[:-1]
                same[:-1] |= same[1:]
                hashes, texts = hashes[same], texts[same]
            yield pa.record_batch({"of": pa.array(texts), "seed": pa.array(hashes.view(np.int64))})


def _surrounding(length: int, seed: int, hot: bool):
    """Sampled positions with repeated seeds: their strings' bytes, or hashes if hot."""

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffers(batch["text"])
            lists = batch["seeds"]
            bounds = lists.offsets.to_numpy()
            known = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            ids = ("doc_id", "text_a", "text_b")
            docs = {c: batch[c].to_numpy() for c in ids}
            for first, last, windows in _bytes_of(batch, length, seed):
                at, low, high = windows.samples()
                if not len(at):
                    continue
                text = np.searchsorted(windows.offsets, at, "right") - 1
                # Seeds of other texts of the chunk may slip in, which adds
                # candidates and no result.
                keep = np.isin(windows.seeds[at], known[bounds[first] : bounds[last]])
                at, low, high, text = at[keep], low[keep], high[keep], text[keep]
                if hot:
                    # Strings met before in the chunk are later ones for sure. So is
                    # every other one that is not the first of all chunks: they
                    # leave as runs too, and by hash to find the first.
                    count = high - low + 1
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    low, text = np.repeat(low, count) + step, np.repeat(text, count)
                    hashes = windows.hash(low, low + length)
                    order = np.lexsort([docs[c][first:last] for c in reversed(ids)])
                    rank = np.empty(len(order), np.int64)
                    rank[order] = np.arange(len(order))
                    by = np.lexsort((low, rank[text], hashes))
                    later = np.zeros(len(by), bool)
                    later[by[1:]] = hashes[by[1:]] == hashes[by[:-1]]
                    rest = np.flatnonzero(~later)
                    sure, open_ = _runs(later, text, low), _runs(~later, text, low)
                    use = np.concatenate([sure[0], open_[0], rest])
                    until = np.concatenate([sure[1], open_[1], rest])
                    kinds = np.repeat([_LATER, _OPEN, _STRING], [len(sure[0]), len(open_[0]), len(rest)])
                    until = low[until] - windows.offsets[text[use]]
                    low, text = low[use], text[use]
                    kind = {
                        "kind": pa.array(kinds.astype(np.int32)),
                        "string": pa.array(hashes[use].view(np.int64), mask=kinds != _STRING),
                        "last": pa.array(until),
                    }
                else:
                    base = limits[first]
                    cut = zip((base + low).tolist(), (base + high + length).tolist())
                    kind = {
                        "seed": pa.array(windows.seeds[at].view(np.int64)),
                        "around": pa.array([data[a:b].tobytes() for a, b in cut], pa.binary()),
                    }
                own = {c: pa.array(docs[c][first:last][text]) for c in ids}
                yield pa.record_batch({**kind, **own, "start": pa.array(low - windows.offsets[text])})

    return surround


def _deciding(length: int):
    """Runs of strings that also start earlier, from all strings of each seed."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for group in _groups(batches, "seed"):
            held += group.to_batches()
            size += group.nbytes
            if size > 1 << 20:
                yield from _later_runs(pa.Table.from_batches(held), length)
                held, size = [], 0
        if held:
            yield from _later_runs(pa.Table.from_batches(held), length)

    return decide


def _runs(later: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of marked neighbours in one row."""
    found = np.flatnonzero(later)
    new = np.ones(len(found), bool)
    new[1:] = (row[found[1:]] != row[found[:-1]]) | (place[found[1:]] != place[found[:-1]] + 1)
    begin = np.flatnonzero(new)
    return found[begin], found[np.append(begin[1:], len(found)) - 1] if len(found) else found


def _later_runs(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    rows = rows.combine_chunks()
    around = rows["around"].combine_chunks()
    bounds = np.frombuffer(around.buffers()[1], np.int32)[around.offset :][: len(around) + 1].astype(np.int64)
    data = np.frombuffer(around.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    count = np.diff(bounds) - length + 1
    windows = Windows(data, bounds, length, length)
    row = np.repeat(np.arange(len(rows)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    hashes = windows.hash(windows.starts, windows.starts + length)
    doc, a, b = (rows[c].to_numpy() for c in ("doc_id", "text_a", "text_b"))
    start = rows["start"].to_numpy()
    order = np.lexsort((start, b, a, doc))  # rows in the order of their texts
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by = np.lexsort((step, rank[row], hashes))
    later = np.zeros(len(row), bool)
    later[by[1:]] = hashes[by[1:]] == hashes[by[:-1]]
    begin, finish = _runs(later, row, step)
    of = row[begin]
    yield pa.record_batch(
        {
            "doc_id": pa.array(doc[of]),
            "text_a": pa.array(a[of]),
            "text_b": pa.array(b[of]),
            "from": pa.array(start[of] + step[begin]),
            "to": pa.array(start[of] + step[finish] + length),
        }
    )


def _cutting(length: int):
    """Cuts the spans out of the texts: given ones, and strings of open runs but for the first ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffers(batch["text"])
            lists = {}
            for name in ("spans", "open"):
                column = batch[name]
                low, high = (column.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                lists[name] = column.offsets.to_numpy(), low, high
            firsts = batch["firsts"].offsets.to_numpy(), batch["firsts"].values.to_numpy(zero_copy_only=False)
            removed, spans, digests, merged = [], [], [], []
            for i in range(len(batch)):
                text = data[limits[i] : limits[i + 1]]
                at, low, high = lists["spans"]
                low, high = low[at[i] : at[i + 1]], high[at[i] : at[i + 1]]
                at, begin, last = lists["open"]
                begin, count = begin[at[i] : at[i + 1]], last[at[i] : at[i + 1]] - begin[at[i] : at[i + 1]] + 1
                strings = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                later = np.setdiff1d(strings, firsts[1][firsts[0][i] : firsts[0][i + 1]])
                low, high = np.concatenate([low, later]), np.concatenate([high, later + length])
                order = np.argsort(low, kind="stable")
                low, high = low[order], high[order]
                if len(low):
                    reach = np.maximum.accumulate(high)
                    new = np.append(True, low[1:] > reach[:-1])
                    low, high = low[new], reach[np.append(np.flatnonzero(new)[1:], len(reach)) - 1]
                edges = np.concatenate([[0], np.stack([low, high], 1).ravel(), [len(text)]]).astype(np.int64)
                kept = hashlib.sha256()
                for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    kept.update(text[x:y].data)
                removed.append(int((high - low).sum()))
                spans.append(len(low))
                digests.append(kept.hexdigest())
                merged.append([{"from": x, "to": y} for x, y in zip(low.tolist(), high.tolist())])
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "text_a": batch["text_a"],
                    "text_b": batch["text_b"],
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(spans, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                    "removed": pa.array(merged, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                }
            )

    return cut


def repeated_bytes(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = 100,
    seed: int = 40,
    hot: int = 1000,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed spans of every row.

    A byte is removed if a string of `length` bytes that covers it also starts
    earlier: in a document with a smaller id, or further left in the same one.

    Equal texts are one text, that of the smallest id; the others go whole. Of
    the rest, a sample of positions is ranked by growing prefixes. First by
    `seed` bytes: positions with a unique rank drop out. The others are ranked
    by all strings of `length` bytes that belong to them, which is the
    threshold, so that equal ranks are repeats. Every string belongs to one
    sampled position and equal strings have it at the same place, so sampling
    (one position in about 30) loses nothing. Positions of one seed meet in one
    task; for a seed that more than `hot` positions share, the first place of
    each string is sought by its own hash, merged before it moves, and all
    other strings of such seeds are later ones: they need no rows of their own.

    Strings are compared by 64-bit hashes, texts by 120-bit ones. Null text is
    empty. Rows equal in id and text are one document; texts that share an id
    are ordered by hash; null ids come last. Other columns are not looked at.
    """
    spark = docs.sparkSession
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))

    def number(at: int) -> Column:
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")

    given = docs.select(
        F.col(key).cast("long").alias("given_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        number(1).alias("text_a"),
        number(16).alias("text_b"),
    )
    names = ["text_a", "text_b"]
    long_enough = given.filter(F.octet_length("text") >= length)
    # All branches below read the same shuffled texts.
    texts = long_enough.groupBy(*names).agg(F.min("doc_id").alias("doc_id"), F.any_value("text").alias("text"))
    known = long_enough.groupBy(*names).agg(F.min("doc_id").alias("first_id"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1) * 4
    seeds = (
        texts.mapInArrow(_sampling(length, seed, buckets), "bucket long, sure boolean, hashes binary, texts binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_repeated, "of long, seed long")
    )
    seeds = materialize(seeds, "repeat-seeds")
    shared = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("positions")).filter(F.col("positions") > hot)
    shared = materialize(shared.select("seed", F.lit(True).alias("is_hot")), "repeat-hot-seeds")
    per_text = (
        seeds.join(shared, "seed", "left")
        .groupBy("of")
        .agg(
            F.collect_set(F.when(F.col("is_hot").isNull(), F.col("seed"))).alias("cool"),
            F.collect_set(F.when(F.col("is_hot"), F.col("seed"))).alias("hot"),
        )
    )
    lists = materialize(
        known.join(per_text, F.col("text_a") == F.col("of")).select(*names, "cool", "hot"), "repeat-seed-lists"
    )

    def near(kind: str, schema: str) -> DataFrame:
        chosen = lists.filter(F.size(kind) > 0).select(*names, F.col(kind).alias("seeds"))
        return (
            texts.join(chosen, names)
            .select("doc_id", *names, "text", "seeds")
            .mapInArrow(_surrounding(length, seed, kind == "hot"), schema)
        )

    place = "doc_id long, text_a long, text_b long, start long"
    cool_runs = (
        near("cool", f"seed long, around binary, {place}")
        .repartition("seed")
        .sortWithinPartitions("seed")
        .mapInArrow(_deciding(length), "doc_id long, text_a long, text_b long, from long, to long")
    )
    hot_rows = materialize(near("hot", f"kind int, string long, last long, {place}"), "repeat-hot-strings")
    # Of each hot string only its first place is sought, merged before it moves.
    here = F.struct("doc_id", *names, "start")
    first = hot_rows.filter(F.col("kind") == _STRING).groupBy("string").agg(F.min(here).alias("first"))
    firsts = first.select("first.text_a", "first.text_b", F.lit(_STRING).alias("kind"), F.col("first.start").alias("from"))
    run_end = F.when(F.col("kind") == _LATER, F.col("last") + length).otherwise(F.col("last"))
    hot_runs = hot_rows.filter(F.col("kind") != _STRING).select(*names, "kind", F.col("start").alias("from"), run_end.alias("to"))
    marked = (
        cool_runs.select(*names, F.lit(_LATER).alias("kind"), "from", "to")
        .union(hot_runs)
        .union(firsts.withColumn("to", F.lit(None).cast("long")))
    )

    def listed(kind: int, value: Column) -> Column:
        return F.collect_list(F.when(F.col("kind") == kind, value))

    runs = marked.groupBy(*names).agg(
        listed(_LATER, F.struct("from", "to")).alias("spans"),
        listed(_OPEN, F.struct("from", "to")).alias("open"),
        listed(_STRING, F.col("from")).alias("firsts"),
    )
    cut = (
        texts.join(runs, names)
        .select("doc_id", *names, "text", "spans", "open", "firsts")
        .mapInArrow(
            _cutting(length),
            "doc_id long, text_a long, text_b long, n_removed long, n_spans long, kept_sha256 string,"
            " removed array<struct<from:long,to:long>>",
        )
        .drop("doc_id")
    )
    found = known.join(materialize(cut, "repeat-cut"), names, "left")
    rows = given.select(
        "given_id", "doc_id", *names, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
    )
    later = F.col("doc_id") > F.col("first_id")
    return rows.join(found, names, "left").select(
        F.col("given_id").alias("doc_id"),
        "n_bytes",
        F.when(later, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(later, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(later, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(later, F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("n_bytes").alias("to"))))
        .otherwise(F.coalesce("removed", F.array().cast("array<struct<from:long,to:long>>")))
        .alias("removed"),
    )
