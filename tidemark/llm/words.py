"""Words and their hashes for whole Arrow arrays of texts, by numpy inside tasks.

Texts are taken as UTF-8 bytes (null counts as empty). Words are runs of word
bytes; all separators used here are ASCII, so bytes and code points agree. Work
goes through the texts in chunks of about CHUNK bytes, so that memory beside the
Arrow batch stays bounded whatever the batch holds; one text is never split.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18

_U = np.uint64


def byte_table(not_in: bytes) -> np.ndarray:
    """True for each byte value that belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(not_in)] = False
    return table


#: words [^\x20\x09-\x0D]+
SPACED = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower-cased
ALNUM = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def give_back() -> None:
    """Memory that nothing uses any more goes back to the system, as far as the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(batches: Iterator) -> Iterator:
    """The batches; what each has left unused is given back after it, as workers live on from stage to stage."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def lists(parts: list[np.ndarray]) -> pa.Array:
    """Lists of 64-bit numbers, one for each part."""
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([np.zeros(0, np.int64), *[p.view(np.int64) for p in parts]])
    if ends[-1] >= 1 << 31:
        raise ValueError("too many numbers for one batch")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the offsets of each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `limit` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> _U(27))
        x = x * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = mix(np.arange(1, 257, dtype=np.uint64))


class Hasher:
    """64-bit hashes of byte ranges: differences of one running sum of code x base^position."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, _U)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, 2 * len(self.powers))
            with np.errstate(over="ignore"):
                self.powers = np.multiply.accumulate(np.r_[_U(1), np.full(n - 1, _BASE, _U)])
                self.inverses = np.multiply.accumulate(np.r_[_U(1), np.full(n - 1, _BASE_INVERSE, _U)])

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of data[s:e] for each range, ordered by start; piece by piece for very long data."""
        out = np.empty(len(starts), _U)
        first = 0
        while first < len(starts):
            at = int(starts[first])
            last = max(first + 1, int(np.searchsorted(starts, at + 2 * CHUNK, "left")))
            end = int(ends[first:last].max())
            n = end - at
            self._grow(n + 1)
            with np.errstate(over="ignore"):
                sums = np.zeros(n + 1, _U)
                np.cumsum(_CODES[data[at:end]] * self.powers[:n], out=sums[1:])
                s, e = starts[first:last] - at, ends[first:last] - at
                out[first:last] = mix((sums[e] - sums[s]) * self.inverses[s] + (e - s).astype(_U))
            first = last
        return out


@dataclass
class Words:
    """Words of a chunk of texts: byte ranges, the text (from 0) each stands in, words before each text."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """offsets: of the texts in data, the first 0."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = table[data]
    step = np.diff(inside)
    starts = np.flatnonzero(step == 1)
    ends = np.flatnonzero(step == -1)
    # a word never goes on from one text into the next
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)] if len(cuts) else cuts
    if len(cuts):
        starts = np.sort(np.r_[starts, cuts])
        ends = np.sort(np.r_[ends, cuts])
    bounds = np.searchsorted(starts, offsets, "left")
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(starts, ends, text, bounds)


def windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `size` consecutive words of one text, and the index of the first word of each."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, _U)
        for k in range(size):
            total = (total + hashes[k : k + n]) * _U(0xD6E8FEB86659FD93)
            total ^= total >> _U(32)
    first = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    return mix(total[first]), first


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hashes of pairs of stretches that follow each other."""
    total = left * _U(0xD6E8FEB86659FD93)
    total += right
    total *= _U(0x9E3779B97F4A7C15)
    total ^= total >> _U(32)
    return total


def long_windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As `windows`, with other hashes: stretches are doubled and put together, in steps as the logarithm of `size`."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total, done, stretch, length = None, 0, hashes, 1
        while done < size:
            if size & length:
                piece = stretch[done : done + n]
                total = piece if total is None else _joined(total, piece)
                done += length
            if done < size:
                stretch = _joined(stretch[:-length], stretch[length:])
                length *= 2
    first = window_starts(words, size)
    return mix(total[first]), first


def window_starts(words: Words, size: int) -> np.ndarray:
    """The index of the first word of each `size` consecutive words of one text."""
    n = len(words.text) - size + 1
    return np.flatnonzero(words.text[:n] == words.text[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
