"""Masked pseudo-likelihood of documents under a bidirectional window network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import chunks, mix, text_buffers, words

_CLASSES = 64
_MEMBERS = 64
_BUCKETS = 512  # ids that all rarer words share
_KNOWN = _CLASSES * _MEMBERS - _BUCKETS
_PAD = _CLASSES * _MEMBERS
_PREFIX = np.uint64(48)  # bits of a hash below the 16 that words are looked up by
_OFFSETS = (-2, -1, 1, 2)
_BATCH = 4096
_SCORE_BATCH = 1 << 13
_FAR = 60.0  # sums of e ** -60 to e ** 60 stay well inside a 32-bit float
_DISTINCT = 1 << 20  # distinct words a task holds before it passes counts on
_SHARED = 1 << 18  # words of the buckets whose shares every scoring task holds; the others are joined
_SCALE = 2.0**24
_BLOCK = 1 << 13
_FINE = 1e8


@dataclass
class Vocabulary:
    """Ids by frequency; the words beyond the most frequent share buckets by their hash."""

    hashes: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, ranked: np.ndarray) -> Vocabulary:
        order = np.argsort(ranked)
        return cls(ranked[order], order.astype(np.int32))

    def __post_init__(self):
        known = self.hashes >> _PREFIX
        self.first = np.searchsorted(known, np.arange(1 << 16, dtype=np.uint64)).astype(np.int32)
        self.longest = int(np.bincount(known.astype(np.int64)).max(initial=0))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        ids = (hashes % np.uint64(_BUCKETS)).astype(np.int32)
        ids += _KNOWN
        at = self.first[hashes >> _PREFIX]
        for _ in range(self.longest):  # known hashes that share a prefix stand side by side
            found = np.flatnonzero(np.take(self.hashes, at, mode="clip") == hashes)
            ids[found] = np.take(self.ids, at[found], mode="clip")
            at += 1
        return ids


class Network:
    """P(word | two words on either side), as P(class) P(word | class).

    Embeddings of the four neighbours meet in one hidden layer. Words are dealt
    to classes by frequency, so that a prediction costs two small softmaxes.
    """

    shapes = {
        "embedding": (_PAD + 1, 16),
        "hidden": (16 * len(_OFFSETS), 32),
        "hidden_bias": (32,),
        "classes": (32, _CLASSES),
        "class_bias": (_CLASSES,),
        "members": (_CLASSES, 32, _MEMBERS),
        "member_bias": (_CLASSES, _MEMBERS),
    }

    def __init__(self, flat: np.ndarray):
        at = 0
        self.p = {}
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            self.p[name] = flat[at : at + n].reshape(shape).astype(np.float32)
            at += n
        # Weights with their biases as a last row, which meets a column of ones; `p` keeps the parts.
        self.outer = np.concatenate([self.p["classes"], self.p["class_bias"][None]])
        self.inner = np.concatenate([self.p["members"], self.p["member_bias"][:, None]], axis=1)
        self.p |= {"classes": self.outer[:-1], "class_bias": self.outer[-1]}
        self.p |= {"members": self.inner[:, :-1], "member_bias": self.inner[:, -1]}
        self.squares = None

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes.values())

    @classmethod
    def initial(cls, counts: np.ndarray) -> np.ndarray:
        """Small random weights, and biases that give the word frequencies."""
        rng = np.random.default_rng(7)
        share = (counts + 1.0).reshape(_CLASSES, _MEMBERS)
        parts = []
        for name, shape in cls.shapes.items():
            if name == "class_bias":
                parts.append(np.log(share.sum(1) / share.sum()))
            elif name == "member_bias":
                parts.append(np.log(share / share.sum(1, keepdims=True)).ravel())
            elif name == "hidden_bias":
                parts.append(np.zeros(shape))
            else:
                parts.append(rng.normal(0, 0.1, shape).ravel())
        return np.concatenate(parts)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[n].ravel() for n in self.shapes]).astype(np.float64)

    def _hidden(self, context: np.ndarray):
        """Embeddings of the neighbours; the hidden layer beside a column of ones."""
        x = np.take(self.p["embedding"], context, axis=0, mode="clip").reshape(len(context), -1)
        part = x @ self.p["hidden"]
        part += self.p["hidden_bias"]
        h = np.ones((len(x), part.shape[1] + 1), np.float32)
        h[:, :-1] = np.tanh(part, out=part)
        return x, h

    def _member_logits(self, h: np.ndarray, cuts: list) -> np.ndarray:
        """Of rows in the order of their classes; all softmaxes are then taken at once."""
        out = np.empty((len(h), _MEMBERS), np.float32)
        for k, a, b in cuts:
            np.matmul(h[a:b], self.inner[k], out=out[a:b])
        return out

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, c, m, cuts = _by_class(target)
        _, h = self._hidden(context[order])
        found = _log_softmax_at(h @ self.outer, c).astype(np.float64)
        found += _log_softmax_at(self._member_logits(h, cuts), m)
        out = np.empty(len(order))
        out[order] = found
        return out

    def train(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One Adagrad step."""
        if self.squares is None:
            own = {n: self.p[n] for n in ("embedding", "hidden", "hidden_bias")}
            own |= {"outer": self.outer, "inner": self.inner}
            self.squares = {n: (v, np.full(v.shape, 1e-6, np.float32)) for n, v in own.items()}
        n = len(target)
        order, c, m, cuts = _by_class(target)
        context = context[order]
        x, h = self._hidden(context)
        error = _softmax(h @ self.outer)
        error[np.arange(n), c] -= 1
        inside = _softmax(self._member_logits(h, cuts))
        inside[np.arange(n), m] -= 1
        back = error @ self.outer[:-1].T
        part = np.empty_like(back)
        # A class without a row has no gradient and stays as it is.
        members = np.zeros(self.inner.shape, np.float32)
        for k, a, b in cuts:
            np.matmul(inside[a:b], self.inner[k, :-1].T, out=part[a:b])
            np.matmul(h[a:b].T, inside[a:b], out=members[k])
        back += part
        self._step("outer", h.T @ error, n, rate)
        self._step("inner", members, n, rate)
        h *= h
        back *= np.subtract(1, h[:, :-1], out=part)
        down = (back @ self.p["hidden"].T).reshape(n * len(_OFFSETS), -1)
        self._step("hidden", x.T @ back, n, rate)
        self._step("hidden_bias", np.ones(n, np.float32) @ back, n, rate)
        ids = context.ravel().astype(np.uint16, copy=False)  # two bytes are sorted in linear time
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.diff(ids, prepend=ids[:1] + np.uint16(1)))
        # Two numbers at a time are summed up as the parts of a complex one.
        down = np.take(down, order, axis=0, mode="clip").view(np.complex64)
        self._step("embedding", np.add.reduceat(down, first, axis=0).view(np.float32), n, rate, ids[first])

    def _step(self, name: str, gradient: np.ndarray, n: int, rate: float, at=...) -> None:
        """By the gradient summed over `n` rows, which is used up."""
        values, squares = self.squares[name]
        gradient /= n
        part = gradient * gradient
        part += squares[at]
        squares[at] = part
        gradient /= np.sqrt(part, out=part)
        gradient *= rate
        values[at] -= gradient


def _in_range(logits: np.ndarray) -> np.ndarray:
    """Less the maximum of each row, in place, where a float could not hold the exponentials."""
    if max(logits.max(initial=0), -logits.min(initial=0)) > _FAR:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Of each row, in place."""
    np.exp(_in_range(logits), out=logits)
    logits *= 1 / (logits @ np.ones(logits.shape[1], logits.dtype))[:, None]
    return logits


def _log_softmax_at(logits: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log softmax of one column of each row; `logits` are used up."""
    found = _in_range(logits)[np.arange(len(column)), column]
    np.exp(logits, out=logits)
    return found - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def _by_class(target: np.ndarray):
    """An order of the rows by class; class, member and the (class, first, last) in that order."""
    c, m = np.divmod(target.astype(np.uint16), np.uint16(_MEMBERS))
    order = np.argsort(c, kind="stable")
    c, m = c[order], m[order]
    limits = np.searchsorted(c, np.arange(_CLASSES + 1)).tolist()
    return order, c, m, [(k, a, b) for k, (a, b) in enumerate(zip(limits[:-1], limits[1:])) if a < b]


def _contexts(ids: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of the neighbours of the places `at`, the pad id beyond the text."""
    most = max(map(abs, _OFFSETS))
    ids = np.pad(ids.astype(np.uint16), most, constant_values=_PAD)
    text = np.pad(text, most, constant_values=-1)
    out = np.empty((len(at), len(_OFFSETS)), np.uint16)
    at = at + most
    own = text[at]
    for j, offset in enumerate(_OFFSETS):
        near = at + offset
        out[:, j] = np.where(text[near] == own, ids[near], _PAD)
    return out


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, held_counts, size = [], [], 0

    def merged() -> pa.RecordBatch:
        values, inverse = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(held_counts)).astype(np.int64)
        return pa.record_batch({"word": pa.array(values.view(np.int64)), "n": pa.array(total)})

    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        for first, last in chunks(offsets):
            values, n = np.unique(words(data, offsets, first, last).hashes(lower=True), return_counts=True)
            held.append(values)
            held_counts.append(n)
            size += len(values)
            if size > _DISTINCT:
                yield merged()
                held, held_counts, size = [], [], 0
    if size:
        yield merged()


def _masked(hashes: np.ndarray, place: np.ndarray, percent: int, round_: int) -> np.ndarray:
    """Whether each place is a target of the round; each round goes on where the last one stopped."""
    part = mix(hashes + place * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(100)
    return (part + np.uint64(100 - round_ * percent % 100)) % np.uint64(100) < percent


def _training(shared, rate: float, percent: int, round_: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat = shared.value
        network = Network(flat)
        seen = 0
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for first, last in chunks(offsets):
                tokens = words(data, offsets, first, last)
                hashes = tokens.hashes(lower=True)
                ids = vocabulary(hashes)
                place = np.arange(len(ids), dtype=np.uint64)
                masked = np.flatnonzero(_masked(hashes, place, percent, round_))
                context, target = _contexts(ids, tokens.text, masked), ids[masked]
                for a in range(0, len(masked), _BATCH):
                    network.train(context[a : a + _BATCH], target[a : a + _BATCH], rate)
                seen += len(masked)
        if seen:
            # Integers, so that the sum over tasks does not depend on their order.
            values = np.rint(network.flat() * _SCALE).astype(np.int64) * 1
            weight = max(seen // _BATCH, 1)
            for b in range(0, len(values), _BLOCK):
                part = values[b : b + _BLOCK] * weight
                yield pa.record_batch(
                    {
                        "block": pa.array([b // _BLOCK]),
                        "weight": pa.array([weight]),
                        "total": pa.array([part.tobytes()], pa.binary()),
                    }
                )

    return train


def _adding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for block, weight, total in zip(*(batch[c].to_pylist() for c in ("block", "weight", "total"))):
            values = np.frombuffer(total, np.int64)
            if block in sums:
                sums[block][0] += weight
                sums[block][1] += values
            else:
                sums[block] = [weight, values.copy()]
    for block, (weight, values) in sorted(sums.items()):
        yield pa.record_batch(
            {
                "block": pa.array([block]),
                "weight": pa.array([weight]),
                "total": pa.array([values.tobytes()], pa.binary()),
            }
        )


def _rare(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of each text, text by text, and how often they occur in it."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return hashes[at], text[at], np.diff(np.append(at, len(hashes)))


@dataclass
class Shares:
    """log P(word | bucket) of the most frequent words of the buckets, for the tasks that score."""

    hashes: np.ndarray
    log_share: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, n: np.ndarray, totals: np.ndarray) -> Shares:
        hashes = words.astype(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        return cls(hashes, np.log(n[order] / (totals[(hashes % np.uint64(_BUCKETS)).astype(np.int64)] + 1)))

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is one of them, and the shares of those that are."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(0)
        at = np.searchsorted(self.hashes, hashes)
        found = np.take(self.hashes, at, mode="clip") == hashes
        return found, self.log_share[at[found]]


def _shared(rare: DataFrame) -> tuple[Shares, np.ndarray, int]:
    """Shares of at most `_SHARED` words, words in each bucket, and the least count of the shares.

    The counts of a level are within a factor of 1.1, so there are a few hundred levels at most.
    """
    bucket = F.col("word").bitwiseAND(F.lit(_BUCKETS - 1)).alias("bucket")
    found = rare.groupBy(bucket).agg(F.sum("n").alias("total")).toPandas()
    totals = np.zeros(_BUCKETS)
    totals[found["bucket"].to_numpy(np.int64)] = found["total"].to_numpy(np.float64)
    level = F.floor(F.log2("n") * 8).alias("level")
    levels = rare.groupBy(level).agg(F.min("n").alias("least"), F.count("*").alias("words")).toPandas()
    levels = levels.sort_values("least", ascending=False)
    taken = levels[levels["words"].cumsum() <= _SHARED]
    if not len(taken):
        return Shares.of(np.zeros(0, np.int64), np.zeros(0), totals), totals, 2**62
    least = int(taken["least"].iloc[-1])
    most = rare.where(F.col("n") >= least).select("word", "n").toPandas()
    return Shares.of(most["word"].to_numpy(np.int64), most["n"].to_numpy(np.float64), totals), totals, least


def _inside(places: DataFrame, rare: DataFrame, totals: np.ndarray, least: int) -> DataFrame:
    """row, inside: sum of log P(word | bucket) over `places` (row, word, times) of words below `least`.

    One count more than a bucket holds is left to words that were not counted.
    These count as words that occur once do, so the latter need not be joined.
    """
    spark = places.sparkSession
    bucket = F.col("word").bitwiseAND(F.lit(_BUCKETS - 1)).alias("bucket")
    own = spark.createDataFrame(list(enumerate(totals.astype(np.int64).tolist())), "bucket long, total long")
    share = F.log(F.coalesce(F.col("n"), F.lit(1)) / (F.col("total") + 1))
    # Integers, so that a sum does not depend on the order of its terms.
    part = F.round(F.col("times") * share * _FINE).cast("long")
    return (
        places.join(rare.where((F.col("n") > 1) & (F.col("n") < least)), "word", "left")
        .select("row", "times", "n", bucket)
        .join(F.broadcast(own), "bucket")
        .groupBy("row")
        .agg((F.sum(part) / _FINE).alias("inside"))
    )


def _scoring(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat, shares = shared.value
        network = Network(flat)
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for first, last in chunks(offsets):
                tokens = words(data, offsets, first, last)
                hashes = tokens.hashes(lower=True)
                ids = vocabulary(hashes)
                context = _contexts(ids, tokens.text, np.arange(len(ids)))
                each = np.zeros(len(ids))
                for a in range(0, len(ids), _SCORE_BATCH):
                    at = slice(a, a + _SCORE_BATCH)
                    each[at] = network.log_probabilities(context[at], ids[at])
                at = np.flatnonzero(ids >= _KNOWN)
                found, inside = shares(hashes[at])
                each[at[found]] += inside
                total = np.bincount(tokens.text, each, minlength=last - first)
                at = at[~found]
                rare, text, times = _rare(hashes[at], tokens.text[at])
                limits = np.searchsorted(text, np.arange(last - first + 1)).astype(np.int32)
                yield pa.record_batch(
                    {
                        "row": batch["row"].slice(first, last - first),
                        "doc_id": batch["doc_id"].slice(first, last - first),
                        "n_words": pa.array(tokens.counts.astype(np.int64)),
                        "log_likelihood": pa.array(total),
                        "rare": pa.ListArray.from_arrays(pa.array(limits), pa.array(rare.view(np.int64))),
                        "times": pa.ListArray.from_arrays(pa.array(limits), pa.array(times.astype(np.int32))),
                    }
                )

    return score


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often each word occurs in all `docs` (text), by the hash of the word."""
    counts = docs.mapInArrow(_counting, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts, "lm-words")


def train_network(
    docs: DataFrame, *, rounds: int = 2, percent: int = 50, rate: float = 0.1, counts: DataFrame | None = None
):
    """Vocabulary and weights learnt from all `docs` (text).

    Words are counted over all documents; the most frequent get ids. In each
    round every task goes through its documents from the weights so far, masks
    `percent` % of the words (other ones each round, so that 100 / `percent`
    rounds cover every word once) and predicts them from both sides; the weights of all tasks are averaged by the number of their steps.
    What a task sends back is of fixed size, and partial sums are merged by
    block of weights.
    """
    spark = docs.sparkSession
    counts = word_counts(docs) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(_KNOWN).toPandas()
    vocabulary = Vocabulary.of(top["word"].to_numpy(np.int64).view(np.uint64))
    frequency = np.zeros(_PAD)
    frequency[: len(top)] = top["n"]
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequency[_KNOWN:] = (total - frequency.sum()) / _BUCKETS
    flat = Network.initial(frequency)
    for round_ in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, flat))
        schema = "block long, weight long, total binary"
        parts = docs.mapInArrow(_training(shared, rate, percent, round_), schema)
        merged = parts.repartition("block").mapInArrow(_adding, schema).toPandas()
        if len(merged):
            merged = merged.sort_values("block")
            flat = np.concatenate(
                [np.frombuffer(t, np.int64) / (_SCALE * w) for t, w in zip(merged["total"], merged["weight"])]
            )
    return vocabulary, flat


def pseudo_likelihood(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", rounds: int = 2, percent: int = 50
) -> DataFrame:
    """doc_id, n_words, log_likelihood, per_word of every row.

    `log_likelihood` sums the log probability of every word of the whole text
    given its neighbours on both sides, under a network trained on all
    documents (`train_network`); `per_word` is its mean. ASCII case is ignored.
    The network predicts the 3584 most frequent words and 512 buckets of all
    others; a word of a bucket takes its share of the bucket's probability by
    its count, so that every distinct word has a probability of its own. The
    counts of the most frequent of these are sent to the tasks, the others are joined.

    Null and word-free texts have no words, log_likelihood 0 and null per_word.
    Repeated rows get equal scores; an empty table gives none; other columns are
    not looked at. Reruns over the same files and splits train the same network.
    """
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = word_counts(given.select("text"))
    vocabulary, flat = train_network(given.select("text"), rounds=rounds, percent=percent, counts=counts)
    spark = docs.sparkSession
    known = spark.createDataFrame([(w,) for w in vocabulary.hashes.view(np.int64).tolist()], "word long")
    rare = counts.join(F.broadcast(known), "word", "left_anti")
    shares, totals, least = _shared(rare)
    shared = spark.sparkContext.broadcast((vocabulary, flat, shares))
    scored = materialize(
        given.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _scoring(shared),
            "row long, doc_id long, n_words long, log_likelihood double, rare array<long>, times array<int>",
        ),
        "lm-scores",
    )
    places = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")
    )
    inside = _inside(places, rare, totals, least)
    summed = scored.drop("rare", "times").join(inside, "row", "left").withColumn(
        "log_likelihood", F.col("log_likelihood") + F.coalesce(F.col("inside"), F.lit(0.0))
    )
    return summed.select(
        "doc_id",
        "n_words",
        F.round("log_likelihood", 4).alias("log_likelihood"),
        F.when(F.col("n_words") > 0, F.round(F.col("log_likelihood") / F.col("n_words"), 4)).alias("per_word"),
    )
