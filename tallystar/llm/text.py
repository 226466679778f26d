"""Words, lines and n-grams of whole Arrow string columns, as numpy arrays.

A chunk of texts is handled as one byte array with the texts' offsets in it. Words are runs of
bytes of a class; as every class here holds all or none of the bytes of a non-ASCII character,
bytes and characters give the same words. Nothing crosses the border of a text. A null text
counts as an empty one.

Words and grams are compared by 64-bit hashes. Two different ones in the same comparison have the
same hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at a time. A longer text is handled by itself, whole.
CHUNK_BYTES = 1 << 20
#: Powers of a base that a worker keeps at most.
KEPT_POWERS = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ASCII letters and digits, and all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Signs that quality rules count.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64; kept for the next chunk."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
        if size > KEPT_POWERS:  # of one very long text: not kept
            del _powers[base]
    return have[:n]


@dataclass
class Texts:
    """Texts of a chunk: all their bytes, and len + 1 offsets."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column; null gives no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches with about `size` bytes of text, with their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        all_texts = texts_of(batch.column(column))
        first = 0
        while first < batch.num_rows:
            limit = all_texts.offsets[first] + size
            last = max(first + 1, int(np.searchsorted(all_texts.offsets, limit, "right")) - 1)
            ends = all_texts.offsets[first : last + 1]
            part = Texts(all_texts.data[ends[0] : ends[-1]], ends - ends[0])
            yield batch.slice(first, last - first), part
            first = last
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


@dataclass
class Words:
    """Words of a chunk: bytes from start to end; text t has those from bounds[t] to bounds[t+1]."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.count)


def words(texts: Texts, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of a class."""
    inside = kind[texts.data]
    n = len(inside)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    border = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    starts[border] = inside[border]
    ends[border - 1] = inside[border - 1]
    start = np.flatnonzero(starts)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, texts.offsets))


def span_hashes(
    texts: Texts, start: np.ndarray, end: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash of the bytes from start to end; `lower` folds A-Z."""
    if not len(start):
        return np.zeros(0, np.uint64)
    values = _VALUES[_LOWER] if lower else _VALUES
    total = np.zeros(len(texts.data) + 1, np.uint64)
    np.cumsum(values[texts.data] * _power(_STEP, len(texts.data)), out=total[1:])
    return mix((total[end] - total[start]) * _power(_BACK, int(start[-1]) + 1)[start])


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive entries; entry i starts at i."""
    n = max(0, len(hashes) - k + 1)
    out = hashes[:n] + U(k)
    for i in range(1, k):
        out = mix(out) + hashes[i : i + n]
    return mix(out)


def shingles(found: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every run of k words; of the whole text where it has fewer, but not none."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count, text = found.count, found.text
    place = np.arange(len(hashes))
    whole = chain(hashes, k)
    fits = place[: len(whole)] + k <= found.bounds[1:][text[: len(whole)]]
    texts_, grams = [text[: len(whole)][fits]], [whole[fits]]
    for short in range(1, k):
        of = np.flatnonzero(count == short)
        if len(of):
            texts_.append(of)
            grams.append(chain(hashes, short)[found.bounds[:-1][of]])
    return np.concatenate(texts_), np.concatenate(grams)


def distinct(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, sorted by text, then value."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column: list t holds the values from bounds[t] to bounds[t + 1]."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the entries from each bound to the next."""
    total = np.zeros(len(flags) + 1, np.float64 if flags.dtype.kind == "f" else np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_lines(texts_: Texts, found: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(texts_.data)
    breaks = np.flatnonzero(texts_.data == 10)
    start = np.union1d(texts_.offsets[:-1][texts_.sizes > 0], breaks + 1)
    start = start[start < n]
    end = np.append(start, n)[1:]
    end = end - ((end > start) & (texts_.data[np.maximum(end, 1) - 1] == 10))
    full = np.searchsorted(found.start, end) > np.searchsorted(found.start, start)
    start, end = start[full], end[full]
    text = np.searchsorted(texts_.offsets, start, "right") - 1
    once, _ = distinct(text, span_hashes(texts_, start, end))
    size = len(texts_)
    return np.bincount(text, minlength=size) - np.bincount(once, minlength=size)


def repeated_words(found: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Words inside windows of `size` words that their text has twice or more."""
    text = found.text
    grams = chain(hashes, size)
    place = np.arange(len(grams))
    place = place[place + size <= found.bounds[1:][text[: len(grams)]]]
    order = place[np.lexsort((grams[place], text[place]))]
    same = (text[order][1:] == text[order][:-1]) & (grams[order][1:] == grams[order][:-1])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    inside = np.zeros(len(hashes), bool)
    for i in range(size):
        inside[order[again] + i] = True
    return sums(inside, found.bounds)
