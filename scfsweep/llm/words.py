"""Words and word n-grams of Arrow text columns as numpy arrays.

Texts stay UTF-8 bytes. A word is a run of bytes of a class, so one pass over the bytes of many texts
finds all of their words; prefix sums give every word a 64-bit hash without a Python loop over words. Each
byte adds a random number of its own for its place in the word: no structure of two words makes them
collide, as it does under a polynomial modulo a power of two. Work goes in chunks of about ``CHUNK_BYTES`` (a longer text is a chunk of its own), so
memory does not depend on the number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Letters, digits and everything beyond ASCII; A-Z only after LOWER.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

# Everything but the six blanks of ASCII.
PRINTED = np.ones(256, dtype=bool)
PRINTED[0x09:0x0E] = PRINTED[0x20] = False


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every bit depends on all."""
    values = (values ^ (values >> np.uint64(33))) * _MIX
    return values ^ (values >> np.uint64(29))


#: Random numbers of (place, byte) for the first places of a word
_PLACES = 64
_PLACED = mix(mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _BASE))


@dataclass
class Texts:
    """Consecutive rows of a batch: their bytes, and where each row's bytes begin and end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Word k is data[start[k]:end[k]]; row i holds words bounds[i]:bounds[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    stems: tuple[np.ndarray, ...] = ()

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    @property
    def last(self) -> np.ndarray:
        """For each word the end of its row's words."""
        return np.repeat(self.bounds[1:], self.counts)


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column's rows in chunks; a null is an empty text."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1)
        to = min(to, n)
        yield Texts(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def find_runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, none going on from one row to the next."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside
    after = np.empty(n + 1, bool)
    after[:n] = inside
    after[n] = False
    start = np.flatnonzero(after & (~before | begins))
    end = np.flatnonzero(before & (~after | begins))
    return start, end


def find_words(texts: Texts, letters: np.ndarray, lower: bool = False, stems: tuple[int, ...] = ()) -> Words:
    """All words of the rows, with a 64-bit hash each (equal words have equal hashes).

    ``stems`` asks for the hashes of each word's first so many bytes (of the whole word if shorter).
    """
    data = LOWER[texts.data] if lower else texts.data
    start, end = find_runs(letters[data], texts.offsets)
    bounds = np.searchsorted(start, texts.offsets)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_placed(data, start), out=sums[1:])
    upto = lambda end: mix(sums[end] - sums[start] + (end - start).astype(np.uint64) * _STEP)
    return Words(start, end, bounds, upto(end), tuple(upto(np.minimum(end, start + k)) for k in stems))


def _placed(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For every byte a random number of its own for its place in the word that starts last."""
    if not len(start):
        return np.zeros(len(data), np.uint64)
    place = np.arange(len(data)) - np.repeat(np.append(0, start), np.diff(np.concatenate([[0], start, [len(data)]])))
    codes = place * 256 + data
    out = _PLACED[np.minimum(codes, len(_PLACED) - 1)]
    far = np.flatnonzero(place >= _PLACES)
    out[far] = mix(mix((codes[far].astype(np.uint64) + np.uint64(1)) * _BASE))
    return out


def ngrams(words: Words, n: int, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Word index and hash of each n-gram that lies in one row; ``gap`` words are left out after the first.

    Every step mixes what came before, so the order of the words counts from the first one on.
    """
    total = len(words.hashes)
    span = n + gap
    count = max(total - span + 1, 0)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(np.arange(count) + span <= words.last[:count])
    hashed = words.hashes * _STEP
    out = mix(hashed[first])
    for k in range(1, n):
        out = (out + hashed[first + gap + k]) * _STEP
        out ^= out >> np.uint64(31)
    return first, mix(out + np.uint64(n * 1000 + gap))
