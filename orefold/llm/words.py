"""What all operators take as a word, as column expressions and over byte buffers.

A word is a longest run of characters other than space and the control
characters 09 to 0D. All separators are single bytes in UTF-8, so words can be
found on bytes as well as on characters.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"

_WORD_SEPARATORS = np.zeros(256, bool)
_WORD_SEPARATORS[[9, 10, 11, 12, 13, 32]] = True
_LINE_SEPARATORS = np.zeros(256, bool)
_LINE_SEPARATORS[10] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_HASH_BLOCK = 1 << 15  # bytes


# --- column expressions -----------------------------------------------------


def word_count(text: Column) -> Column:
    """Words of the whole text as a long; null counts as empty."""
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1)

    def inner(words: Column) -> Column:
        first = (F.element_at(words, 1) == "").cast("int")
        last = (F.element_at(words, -1) == "").cast("int")
        return F.greatest(F.size(words) - first - last, F.lit(0)).cast("long")

    return bind(parts, inner)


def word_array(text: Column) -> Column:
    """The words of the whole text in order; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# --- byte buffers -----------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_VALUES_31 = {lower: values % np.uint64(2**31 - 1) for lower, values in _VALUES.items()}


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their offsets; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset or not column.buffers()[2]:
        column = pa.concat_arrays([column]) if column.buffers()[2] else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, most: int = 1 << 20):
    """Ranges of texts of about `most` bytes together; a longer text is alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n - 1 modulo 2**64; kept for the next call."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 20), base)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 1 << 22:  # those for a very long text are not worth their memory
            _powers[int(base)] = known
    return known[:n]


_PRIME = np.uint64(2**31 - 1)
_BITS = np.uint64(31)
_BASE_31 = 1_220_703_125  # a generator's power; any would do
_INVERSE_31 = pow(_BASE_31, -1, 2**31 - 1)
_powers_31: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number equal to `x` modulo 2**31 - 1: below 2**32 for products, 2**31 + 8 after another."""
    low = x & _PRIME
    low += x >> _BITS
    return low


def _residues(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n - 1 modulo 2**31 - 1; kept for the next call."""
    known = _powers_31.get(base)
    if known is None or len(known) < n:
        known = np.ones(1, np.uint64)
        while len(known) < max(n, 1 << 20):
            known = np.append(known, known * np.uint64(pow(base, len(known), 2**31 - 1)) % _PRIME)
        if n <= 1 << 22:
            _powers_31[base] = known
    return known[:n]


class PrefixHashes:
    """Sums of byte values times powers; their differences identify strings.

    Modulo 2**64 alone, long strings can be built that collide for any base
    (Thue-Morse words), so a second sum goes modulo a prime.
    """

    def __init__(self, data: np.ndarray, lower: bool = False):
        self.wide = np.zeros(len(data) + 1, np.uint64)
        values = _VALUES[lower][data]
        values *= powers(_BASE, len(data))
        np.cumsum(values, out=self.wide[1:])
        self.prime = np.zeros(len(data) + 1, np.uint64)
        values = _VALUES_31[lower][data]
        values *= _residues(_BASE_31, len(data))
        np.cumsum(_fold(values), out=self.prime[1:])

    def spans(self, start, end) -> np.ndarray:
        """Hashes of the strings data[start:end], the same wherever they stand.

        `start` and `end` are arrays of places, or slices of them.
        """
        wide = (self.wide[end] - self.wide[start]) * powers(_INVERSE, len(self.wide))[start]
        prime = _fold(_fold(self.prime[end] - self.prime[start])) * _residues(_INVERSE_31, len(self.wide))[start]
        prime = _fold(_fold(prime))
        prime[prime >= _PRIME] -= _PRIME
        prime *= _BASE
        wide += prime
        return wide

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.spans(start, end) + np.asarray(end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all strings of `width` bytes."""
        n = len(self.wide) - width
        return mix(self.spans(slice(0, max(n, 0)), slice(width, None)))


class Tokens:
    """Spans of bytes with their texts: `text[i]` owns bytes `start[i]:end[i]`."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start, end):
        self.data, self.offsets, self.start, self.end = data, offsets, start, end
        self.n_texts = len(offsets) - 1
        self.counts = np.diff(np.searchsorted(start, offsets))
        self.text = np.repeat(np.arange(self.n_texts), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each span's bytes.

        Polynomials over random byte values from prefix sums: every pass is
        vectorised over the bytes of a block, which stay in the processor's cache.
        """
        out = np.empty(len(self.start), np.uint64)
        first, n = 0, len(out)
        while first < n:
            at = self.start[first]
            last = max(int(np.searchsorted(self.start, at + _HASH_BLOCK)), first + 1)
            start, end = self.start[first:last] - at, self.end[first:last] - at
            out[first:last] = PrefixHashes(self.data[at : at + end[-1]], lower)(start, end)
            first = last
        return out


def words(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> Tokens:
    """The words of texts `first` to `last`, counted from `first`."""
    data, offsets = _cut(data, offsets, first, last)
    inside = ~_WORD_SEPARATORS[data]
    at = offsets[:-1][np.diff(offsets) > 0]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[at] = inside[at]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    end[ends] = inside[ends]
    return Tokens(data, offsets, np.flatnonzero(start), np.flatnonzero(end) + 1)


def lines(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> Tokens:
    """The lines between line feeds, empty ones included; an empty text has one."""
    data, offsets = _cut(data, offsets, first, last)
    feeds = np.flatnonzero(_LINE_SEPARATORS[data])
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    tokens = Tokens.__new__(Tokens)
    tokens.data, tokens.offsets, tokens.start, tokens.end = data, offsets, start, end
    tokens.n_texts = len(offsets) - 1
    of_feed = np.searchsorted(offsets, feeds, "right") - 1
    tokens.counts = 1 + np.bincount(of_feed, minlength=tokens.n_texts)
    tokens.text = np.repeat(np.arange(tokens.n_texts), tokens.counts)
    return tokens


def _cut(data, offsets, first, last):
    offsets = offsets[first : last + 1]
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
