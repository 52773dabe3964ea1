"""Ranked search, a term at a time, with a limited number of accumulators."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import chunks, text_buffers

# A term is a longest run of other characters; in UTF-8 all other bytes belong to terms.
TERM_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BREAKS = np.zeros(256, bool)
_BREAKS[:128] = [not chr(c).isalnum() for c in range(128)]
# Term bytes with A-Z made small; every break becomes a space.
_FOLDED = np.where(_BREAKS, 32, np.arange(256)).astype(np.uint8)
_FOLDED[65:91] = np.arange(97, 123)

# Documents that are searched at once, in bytes of text.
_BLOCK_BYTES = 8 << 20
_MERGE_PARTS = 32


def term_array(text: Column) -> Column:
    """The terms of the whole text in order; null counts as empty."""
    folded = F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _SMALL)
    return F.array_remove(F.split(folded, TERM_BREAKS, -1), "")


@dataclass
class Queries:
    """A block of items: `terms[i]` are the places in `vocabulary` of item i's terms."""

    vocabulary: dict[bytes, int]
    items: list[int | None]
    terms: list[list[int]]


def query_blocks(items: DataFrame, most_bytes: int) -> Iterator[Queries]:
    """The items in blocks whose terms take about `most_bytes`; an item is never cut.

    They are streamed in order, so the driver holds one block and one partition.
    """
    pairs = items.select("item_id", F.explode(term_array(F.col("text"))).alias("term")).distinct()
    block, size, last = Queries({}, [], []), 0, object()
    for item_id, term in pairs.orderBy("item_id", "term").toLocalIterator():
        if item_id != last:
            if size > most_bytes:
                yield block
                block, size = Queries({}, [], []), 0
            block.items.append(item_id)
            block.terms.append([])
            last = item_id
        word = term.encode()
        block.terms[-1].append(block.vocabulary.setdefault(word, len(block.vocabulary)))
        size += len(word) + 16
    if block.items:
        yield block


@dataclass
class Postings:
    """An inverted file over some documents, for the terms of a vocabulary.

    The postings of term t are `doc[start[t]:start[t + 1]]`, with `tf` beside
    them; `length` has the number of terms of each document.
    """

    length: np.ndarray
    start: np.ndarray
    doc: np.ndarray
    tf: np.ndarray

    @property
    def df(self) -> np.ndarray:
        return np.diff(self.start)


def invert(data: np.ndarray, offsets: np.ndarray, vocabulary: dict[bytes, int]) -> Postings:
    n = len(offsets) - 1
    folded = _FOLDED[data[offsets[0] : offsets[-1]]].tobytes()
    cuts = (offsets - offsets[0]).tolist()
    length = np.zeros(n, np.int64)
    found: list[np.ndarray] = []
    for i in range(n):
        terms = folded[cuts[i] : cuts[i + 1]].split()
        length[i] = len(terms)
        places = np.fromiter(map(vocabulary.get, terms, repeat(-1)), np.int64, len(terms))
        found.append(places[places >= 0] * n + i)
    pairs, tf = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    start = np.searchsorted(pairs, np.arange(len(vocabulary) + 1) * n)
    return Postings(length, start, pairs % max(n, 1), tf.astype(np.int64))


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[tuple[pa.Array, Postings]]:
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        for first, last in chunks(offsets, _BLOCK_BYTES):
            yield batch["doc_id"][first:last], invert(data, offsets[first : last + 1], vocabulary)


def _counting(vocabulary: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, with_terms, all_terms = np.zeros(len(vocabulary), np.int64), 0, 0
        for _, postings in _blocks(batches, vocabulary):
            df += postings.df
            with_terms += int((postings.length > 0).sum())
            all_terms += int(postings.length.sum())
        held = np.flatnonzero(df)
        yield pa.record_batch(
            {
                "place": np.append(held, -1),
                "n": np.append(df[held], with_terms),
                "terms": np.append(np.zeros(len(held), np.int64), all_terms),
            }
        )

    return count


@dataclass
class Statistics:
    """Over all documents: how many hold each term, how many any, and all terms."""

    df: np.ndarray
    documents: int
    terms: int

    def weights(self) -> np.ndarray:
        n = float(2 * self.documents + 2)
        return np.array([math.floor(1000 * math.log(n / (2 * df + 1))) for df in self.df.tolist()], np.int64)

    def length_factor(self, length: np.ndarray) -> np.ndarray:
        return 100 - 50 + (50 * length * self.documents) // max(self.terms, 1)


def statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> Statistics:
    """One pass over all documents; each task sends a number per term it met."""
    counted = docs.mapInArrow(_counting(vocabulary), "place long, n long, terms long")
    df, total = np.zeros(len(vocabulary), np.int64), (0, 0)
    for place, n, terms in counted.groupBy("place").agg(F.sum("n"), F.sum("terms")).toLocalIterator():
        if place < 0:
            total = (n, terms)
        else:
            df[place] = n
    return Statistics(df, *total)


def best_scores(
    postings: Postings, gains: np.ndarray, bounds: np.ndarray, terms: list[int], k: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of one item; all that can be among the best k are in.

    `terms` come rarest first. Documents get accumulators only while what the
    terms to come can add at most reaches the k-th best partial score, or
    `floor`, which k documents met before have reached. A document without one
    then stays below k others. Those that have one are scored to the end.
    """
    score = np.zeros(len(postings.length), np.int64)
    accumulated = np.zeros(len(score), bool)
    to_come = int(bounds[terms].sum())
    creating = to_come >= floor
    for term in terms:
        a, b = postings.start[term], postings.start[term + 1]
        doc, gain = postings.doc[a:b], gains[a:b]
        to_come -= int(bounds[term])
        if creating:
            score[doc] += gain
            accumulated[doc] = True
            partial = score[accumulated]
            reached = floor
            if len(partial) >= k:
                reached = max(floor, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            creating = to_come >= reached
        else:
            known = accumulated[doc]
            score[doc[known]] += gain[known]
    found = np.flatnonzero(score > 0)
    return found, score[found]


@dataclass
class Best:
    """The best k documents of an item so far: highest score, then smallest id, null last."""

    k: int
    score: np.ndarray
    unknown: np.ndarray
    doc_id: np.ndarray

    @classmethod
    def empty(cls, k: int) -> Best:
        return cls(k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, unknown: np.ndarray, doc_id: np.ndarray) -> None:
        score = np.concatenate([self.score, score])
        unknown = np.concatenate([self.unknown, unknown])
        doc_id = np.concatenate([self.doc_id, doc_id])
        order = np.lexsort((doc_id, unknown, -score))[: self.k]
        self.score, self.unknown, self.doc_id = score[order], unknown[order], doc_id[order]


def _searching(queries: Queries, known: Statistics, k: int):
    weights = known.weights()
    rarest_first = [sorted(terms, key=lambda t: (known.df[t], t)) for terms in queries.terms]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.empty(k) for _ in queries.items]
        for ids, postings in _blocks(batches, queries.vocabulary):
            if not len(postings.doc):
                continue
            term = np.repeat(np.arange(len(weights)), postings.df)
            factor = known.length_factor(postings.length)[postings.doc]
            gains = weights[term] * ((1_000_000_000 * postings.tf) // (1000 * postings.tf + 20 * factor))
            bounds = np.zeros(len(weights), np.int64)
            np.maximum.at(bounds, term, gains)
            unknown, doc_id = ids.is_null().to_numpy(False), ids.fill_null(0).to_numpy()
            for own, terms in zip(best, rarest_first):
                doc, score = best_scores(postings, gains, bounds, terms, k, own.floor)
                high = score >= own.floor
                doc = doc[high]
                own.add(score[high], unknown[doc], doc_id[doc])
        for item_id, own in zip(queries.items, best):
            if len(own.score):
                yield pa.record_batch(
                    {
                        "item_id": pa.array([item_id] * len(own.score), pa.int64()),
                        "doc_id": pa.array(own.doc_id, mask=own.unknown),
                        "score": own.score,
                    }
                )

    return search


def lexical_search(docs: DataFrame, items: DataFrame, *, k: int = 50, query_bytes: int = 4 << 20) -> DataFrame:
    """The `k` best documents of each item: (item_id, rank, doc_id, score).

    `docs` has (doc_id, text), `items` has (item_id, text); other columns are
    ignored. A term is a longest run of characters other than ASCII ones that
    are neither letter nor digit; only A-Z are lower-cased. With N documents
    holding a term, L terms in all, n terms in a document, df documents holding
    a term and tf its occurrences in the document, a term adds
    w * ((1000000000 * tf) div (1000 * tf + 20 * m)) to the document's score,
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and
    m = 50 + (50 * n * N) div L; terms of an item count once.

    Two passes over the documents, none of which shuffles them: one counts, one
    inverts and searches block by block. A task goes through the terms of an
    item from the rarest to the most frequent, stops creating accumulators once
    the terms to come cannot reach the k-th best score so far, and scores those
    it has to the end, so the result is exact. It sends k rows an item, which
    are merged in two steps. The items are worked on in blocks of `query_bytes`.

    Null and empty texts hold no terms: such documents are never found, such
    items give no rows, nor do documents with score 0. Equal scores go by
    ascending doc_id, null last; repeated rows are documents of their own.
    Items that share an id, null included, are one item with all their terms.
    Texts of any length are searched whole. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for queries in query_blocks(items, query_bytes):
        known = statistics(docs, queries.vocabulary)
        found = found.union(docs.mapInArrow(_searching(queries, known, k), found.schema))

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy("item_id", *keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    dealt = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(_MERGE_PARTS)))
    return first(first(dealt, "part")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
