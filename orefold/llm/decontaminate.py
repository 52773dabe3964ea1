"""Benchmark passages in documents: CGK embedding, bit sampling, edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import Tokens, _cut, chunks, mix, text_buffers

# Bits of the filter for seeds. Its size does not depend on the benchmark.
_FILTER_BITS = 24
_PAD = np.uint64(0)
_NEVER = np.uint64(2**64 - 1)

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def plain_words(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> tuple[np.ndarray, Tokens]:
    """Hashes of the words made of letters and digits, ASCII capitals as small ones.

    ASCII punctuation separates words; bytes beyond ASCII belong to them.
    """
    data, offsets = _cut(data, offsets, first, last)
    inside = _IN_WORD[data]
    filled = np.diff(offsets) > 0
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    at, stop = offsets[:-1][filled], offsets[1:][filled] - 1
    start[at], end[stop] = inside[at], inside[stop]
    tokens = Tokens(data, offsets, np.flatnonzero(start), np.flatnonzero(end) + 1)
    return tokens.hashes(lower=True), tokens


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each place on; the last places are cut."""
    n = max(len(words) - size + 1, 0)
    folded = mix(words[:n] + np.uint64(size))
    for k in range(1, size):
        folded = mix(folded * np.uint64(0x9FB21C651E98DF25) + words[k : n + k])
    return folded


def allowed_edits(n: int, percent: int) -> int:
    return n * (100 - percent) // 100


def seeds_of(n: int, percent: int) -> tuple[int, list[int]]:
    """Seed size and places: one of these pieces survives all allowed edits."""
    pieces = allowed_edits(n, percent) + 1
    return n // pieces, [i * n // pieces for i in range(pieces)]


def walk_keys(
    rows: np.ndarray,
    lengths: np.ndarray,
    repeats: int,
    samples: int,
    sought: np.ndarray | None = None,
    start: np.ndarray | None = None,
) -> np.ndarray:
    """LSH keys (rows x repeats) of padded word sequences.

    Each repeat walks through the sequence: a step writes the current word and
    moves on or stays, as a random bit for the step and the word says. Walks
    over two sequences fall into step again soon after an edit, so few edits
    leave most of the written words equal. The key of a repeat hashes `samples`
    of the words written.

    `sought` is the length of the item that a sequence may be: the steps sampled
    depend on it, so that a sequence cut off by its text keeps them. `start` is
    below 0 where words are missing in front.
    """
    n = len(rows)
    sought = lengths if sought is None else sought
    keys = np.zeros((n, repeats), np.uint64)
    if not n:
        return keys
    each = np.arange(n)
    for r in range(repeats):
        picks = mix(np.arange(1, samples + 1, dtype=np.uint64) + np.uint64(1000 * r))
        # A walk needs about twice its sequence's length; sample inside that.
        at = (picks[None, :] % np.maximum(sought * 3 // 2, 1).astype(np.uint64)[:, None]).astype(np.int64)
        place = np.zeros(n, np.int64) if start is None else start.astype(np.int64)
        sampled = np.zeros((n, samples), np.uint64)
        for step in range(int(at.max()) + 1):
            inside = (place >= 0) & (place < lengths)
            here = np.where(inside, rows[each, np.clip(place, 0, rows.shape[1] - 1)], _NEVER)
            for s in range(samples):
                hit = at[:, s] == step
                sampled[hit, s] = here[hit]
            place += (mix(here ^ np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64) ^ mix(picks[:1])) >> np.uint64(63)).astype(np.int64)
        key = mix(lengths.astype(np.uint64) * np.uint64(0) + np.uint64(r + 1))
        for s in range(samples):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + sampled[:, s])
        keys[:, r] = key
    return keys


def best_distance(items: np.ndarray, n_items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each item to any part of its text, and where it ends."""
    rows, width = texts.shape
    steps = np.arange(width + 1, dtype=np.int32)
    now = np.zeros((rows, width + 1), np.int32)
    found, ends = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    for i in range(items.shape[1]):
        new = np.empty_like(now)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(now[:, 1:] + 1, now[:, :-1] + (items[:, i : i + 1] != texts))
        now = np.minimum.accumulate(new - steps, axis=1) + steps
        done = n_items == i + 1
        if done.any():
            ends[done] = now[done].argmin(axis=1)
            found[done] = now[done].min(axis=1)
    return found, ends


def padded(lists: pa.ListArray, pad: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    limits = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    sizes = np.diff(limits)
    rows = np.full((len(sizes), max(int(sizes.max(initial=0)), 1)), pad, np.uint64)
    flat = np.arange(limits[0], limits[-1])
    row = np.repeat(np.arange(len(sizes)), sizes)
    rows[row, flat - limits[row]] = values[flat]
    return rows, sizes


def _list(values: np.ndarray, sizes) -> pa.ListArray:
    limits = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(limits), pa.array(values.astype(np.uint64).view(np.int64)))


def _indexing(percent: int, min_words: int, repeats: int, samples: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["item_id"].to_pylist()
            hashes, tokens = plain_words(data, offsets, 0, len(batch))
            stops = np.cumsum(tokens.counts)
            for i, stop in enumerate(stops.tolist()):
                words = hashes[stop - tokens.counts[i] : stop]
                n = len(words)
                if n < min_words:
                    continue
                size, places = seeds_of(n, percent)
                seeds = grams(words, size)[places]
                keys = walk_keys(words[None, :], np.array([n]), repeats, samples)[0]
                yield pa.record_batch(
                    {
                        "item_id": pa.array([ids[i]], pa.int64()),
                        "n": pa.array([n], pa.int64()),
                        "size": pa.array([size], pa.int64()),
                        "words": _list(words, [n]),
                        "seeds": _list(seeds, [len(seeds)]),
                        "places": _list(np.array(places), [len(places)]),
                        "keys": _list(keys, [repeats]),
                    }
                )

    return index


def _scanning(bits, sizes: list[int], margin: int):
    """Stretches of words around seed hits, with the hits in them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            valid = batch["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            for first, last in chunks(offsets):
                hashes, tokens = plain_words(data, offsets, first, last)
                stops = np.cumsum(tokens.counts)
                at, gram = [], []
                for size in sizes:
                    g = grams(hashes, size)
                    hit = np.flatnonzero(table[(g >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                    hit = hit[tokens.text[hit] == tokens.text[hit + size - 1]]
                    at.append(hit)
                    gram.append(g[hit])
                at, gram = np.concatenate(at), np.concatenate(gram)
                order = np.argsort(at, kind="stable")
                at, gram = at[order], gram[order]
                keep = valid[first:last][tokens.text[at]]
                at, gram = at[keep], gram[keep]
                if not len(at):
                    continue
                text = tokens.text[at]
                new = np.ones(len(at), bool)
                new[1:] = (text[1:] != text[:-1]) | (at[1:] - at[:-1] > margin)
                begin = np.flatnonzero(new)
                finish = np.append(begin[1:], len(at)) - 1
                bottom = stops - tokens.counts
                low = np.maximum(at[begin] - margin, bottom[text[begin]])
                high = np.minimum(at[finish] + margin, stops[text[begin]])
                pieces = [hashes[a:b] for a, b in zip(low.tolist(), high.tolist())]
                hits = finish - begin + 1
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(ids[first:last][text[begin]].astype(np.int64)),
                        "first": pa.array(low - bottom[text[begin]]),
                        "words": _list(np.concatenate(pieces), high - low),
                        "grams": _list(gram, hits),
                        "places": _list(at - np.repeat(low, hits), hits),
                    }
                )

    return scan


def _keying(repeats: int, samples: int):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            # Hits of one alignment follow each other and give the same window.
            ids = [batch[c].to_numpy() for c in ("doc_id", "tie", "begin", "n")]
            order = np.lexsort(ids[::-1])
            new = np.zeros(len(order), bool)
            new[:1] = True
            for x in ids:
                new[1:] |= x[order][1:] != x[order][:-1]
            batch = batch.take(pa.array(order[new]))
            rows, lengths = padded(batch["window"], _PAD)
            keys = walk_keys(rows, lengths, repeats, samples, batch["n"].to_numpy(), np.minimum(batch["start"].to_numpy(), 0))
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "tie": batch["tie"],
                    "at": batch["at"],
                    "around": batch["around"],
                    "keys": _list(keys.ravel(), np.full(len(keys), repeats)),
                }
            )

    return key


def _verifying(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 2048):
                batch = whole.slice(start, 2048)
                items, n = padded(pa.concat_arrays([batch["words"]]), _PAD)
                texts, _ = padded(pa.concat_arrays([batch["around"]]), _NEVER)
                distance, end = best_distance(items, n, texts)
                good = distance <= n * (100 - percent) // 100
                kept = batch.filter(pa.array(good))
                yield pa.record_batch(
                    {
                        "doc_id": kept["doc_id"],
                        "item_id": kept["item_id"],
                        "n_words": pa.array(n[good].astype(np.int64)),
                        "distance": pa.array(distance[good].astype(np.int64)),
                        "last_word": pa.array(kept["at"].to_numpy() + end[good]),
                    }
                )

    return verify


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    percent: int = 80,
    min_words: int = 5,
    repeats: int = 40,
    samples: int = 3,
) -> DataFrame:
    """doc_id, item_id, n_words, distance, last_word: a row per leaked item of a document.

    An item leaks if some part of the document is within (100 - `percent`) % of
    the item's words by edit distance over words; `last_word` is the number of
    words from the start of the document to the end of that part.

    Windows as long as an item are taken where one of the item's seeds occurs:
    pieces of which one survives any allowed edits, so no place is missed. A
    filter of fixed size carries the seeds to the scan. CGK walks embed windows
    and items so that edits become differing symbols; keys of `samples` of
    them, `repeats` times over, meet in a join (the tests measure the recall at
    the largest distance allowed). The candidates are confirmed by the exact
    edit distance to the surroundings of the window.

    Words are letters and digits, ASCII case aside. Null or empty texts leak
    nothing; items under `min_words` words, null or repeated items: ignored,
    ignored, reported each under its id; documents without id are not reported;
    repeated rows are reported once. Other columns are not looked at.
    """
    spark = docs.sparkSession
    items = materialize(
        benchmark.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
        .filter("item_id is not null")
        .mapInArrow(
            _indexing(percent, min_words, repeats, samples),
            "item_id long, n long, size long, words array<long>, seeds array<long>, places array<long>, keys array<long>",
        ),
        "leak-items",
    )
    # At most 2**24 places of the filter, whatever the benchmark holds.
    shift = 64 - _FILTER_BITS
    places = items.select(F.explode("seeds").alias("s")).select(F.shiftrightunsigned("s", shift).alias("b")).distinct()
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[places.toPandas()["b"].to_numpy(dtype=np.int64)] = True
    bits = spark.sparkContext.broadcast(np.packbits(table, bitorder="little").tobytes())
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    longest = items.agg(F.max("n")).first()[0] or 0
    margin = longest + allowed_edits(longest, percent) + 1

    stretches = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _scanning(bits, sizes, margin),
        "doc_id long, first long, words array<long>, grams array<long>, places array<long>",
    ) if sizes else spark.createDataFrame(
        [], "doc_id long, first long, words array<long>, grams array<long>, places array<long>"
    )
    seeds = items.select(
        "n", F.explode(F.arrays_zip(F.col("seeds").alias("gram"), F.col("places").alias("place"))).alias("s")
    ).select("n", F.col("s.gram").alias("gram"), F.col("s.place").alias("place")).distinct()
    # Texts that share an id are told apart by the words of the stretch.
    hits = stretches.select(
        "doc_id", F.xxhash64("words").alias("tie"), "first", "words",
        F.explode(F.arrays_zip(F.col("grams").alias("gram"), F.col("places").alias("at"))).alias("h"),
    ).select("doc_id", "tie", "first", "words", F.col("h.gram").alias("gram"), F.col("h.at").alias("hit"))
    slack = F.floor(F.col("n") * (100 - percent) / 100).cast("int")
    # An item that would begin before its document does is tried at both places.
    begin = (F.col("hit") - F.col("place")).cast("int")
    begins = F.array_distinct(F.array(begin, F.greatest(begin, F.lit(0))))
    start = F.col("start")
    low = F.greatest(start - slack, F.lit(0)).cast("int")
    windows = hits.join(seeds, "gram").select("*", F.explode(begins).alias("start")).select(
        "doc_id",
        "tie",
        (F.col("first") + start).alias("begin"),
        "start",
        (F.col("first") + low).alias("at"),
        "n",
        F.slice(
            "words", F.greatest(start, F.lit(0)) + 1, (F.col("n") + F.least(start, F.lit(0))).cast("int")
        ).alias("window"),
        F.slice("words", low + 1, (F.col("n") + slack * 2).cast("int")).alias("around"),
    )
    keyed = windows.mapInArrow(
        _keying(repeats, samples), "doc_id long, tie long, at long, around array<long>, keys array<long>"
    )
    candidates = (
        keyed.select("doc_id", "tie", "at", "around", F.explode("keys").alias("key"))
        .join(items.select("item_id", F.explode("keys").alias("key")), "key")
        .groupBy("doc_id", "tie", "at", "item_id")
        .agg(F.max(F.struct(F.size("around").alias("n"), "around")).alias("widest"))
        .select("doc_id", "at", "item_id", "widest.around")
        .join(items.select("item_id", "words"), "item_id")
    )
    return (
        candidates.select("doc_id", "at", "around", "item_id", "words")
        .mapInArrow(_verifying(percent), "doc_id long, item_id long, n_words long, distance long, last_word long")
        .groupBy("doc_id", "item_id")
        .agg(
            F.min("n_words").alias("n_words"),
            F.min(F.struct("distance", "last_word")).alias("best"),
        )
        .select("doc_id", "item_id", "n_words", "best.distance", "best.last_word")
    )
