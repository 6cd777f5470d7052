"""Vectorised word handling over Arrow text columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; words never cross documents. Word and window hashes
are 64-bit polynomial prefix hashes finished by an avalanche mixer, so the hash of any run of words costs two lookups.
Two independent streams (``seed`` 0 and 1) give 128 bits where equality must not rest on one hash.
"""

from __future__ import annotations

import contextlib
import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ITEM = np.ones(256, dtype=bool)  # bytes that end a word of letters and digits: all ASCII but a-z and 0-9
_ITEM[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_MULTIPLIER = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_INVERSE = tuple(np.uint64(pow(int(m), -1, 1 << 64)) for m in _MULTIPLIER)
_BYTE = tuple(np.random.default_rng(1009 + s).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for s in (0, 1))
_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(seed: int, inverse: bool, n: int) -> np.ndarray:
    have = _powers.get((seed, inverse))
    if have is None or len(have) < n:
        base = np.full(max(n, 1 << 16), (_INVERSE if inverse else _MULTIPLIER)[seed], dtype=np.uint64)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if n <= CHUNK_BYTES + 1:  # a longer text has its own, for as long as it lasts
            _powers[seed, inverse] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    data: np.ndarray  # bytes of all documents, one after the other
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past its last byte
    first: np.ndarray  # first word of each document, and the number of words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def _sums(self, seed: int) -> np.ndarray:
        prefix = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[seed][self.data] * powers(seed, False, len(self.data)), out=prefix[1:])
        return prefix

    def hashes(self, seed: int = 0) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        prefix = self._sums(seed)
        h = prefix[self.end] - prefix[self.start]
        h *= powers(seed, True, len(self.data))[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def beginnings(self, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each size: the words longer than that many bytes, and the hash of their first bytes."""
        if not len(self.start):
            return [(np.zeros(0, np.int64), np.zeros(0, np.uint64)) for _ in sizes]
        prefix, back = self._sums(0), powers(0, True, len(self.data))
        out = []
        for k in sizes:
            at = np.flatnonzero(self.end - self.start > k)
            low = self.start[at]
            out.append((at, mix((prefix[low + k] - prefix[low]) * back[low] + np.uint64(0x4963EE407 * k))))
        return out


def runs_hash(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The hash of each ``length`` consecutive entries."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(seed, False, len(words)), out=prefix[1:])
    h = prefix[length:] - prefix[:-length]
    h *= powers(seed, True, n)
    return mix(h + np.uint64(length))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if at is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


#: Byte classes between which a word may be cut where no tokenizer of letters, digits and marks joins them: ASCII letters,
#: marks but the apostrophe, digits. Class 0 (the apostrophe and all bytes beyond ASCII) is never cut off.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 2
_CLASS[list(range(65, 91)) + list(range(97, 123))] = 1
_CLASS[48:58] = 3
_CLASS[39] = 0


def tokenise(column: pa.Array, lower: bool = False, items: bool = False, parts: bool = False) -> Words:
    """Words of each text; ``lower`` lower-cases A-Z, ``items`` also ends words at ASCII punctuation, ``parts`` cuts words
    between ASCII letters, marks and digits, and between digits."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    solid = ~(_ITEM if items else _SPACE)[data]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    before[cut] = False
    if parts and len(data):
        kind = _CLASS[data]
        split = (kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 3))
        before[1:] &= ~split
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    after[cut[cut > 0] - 1] = False
    if parts and len(data):
        after[:-1] &= ~split
    end = np.flatnonzero(solid & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def release() -> None:
    """Hands memory that this worker no longer uses back to the system: workers outlive their tasks and wait for the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batches, text: str = "text", size: int = CHUNK_BYTES):
    """Record batches cut so that each holds about ``size`` bytes of text; one longer document stays whole."""
    release()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = text_bytes(column)
        low, n = 0, batch.num_rows
        while low < n:
            high = min(n, max(low + 1, int(np.searchsorted(offsets, offsets[low] + size))))
            yield batch.slice(low, high - low)
            low = high
    release()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def binary_rows(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column whose row k holds values[cuts[k]:cuts[k + 1]]."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(cuts, np.int64) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.view(np.uint8))])


def repeated(key: np.ndarray, second: np.ndarray | None = None, heavy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether its (key, second) occurs twice or more, and whether it is the first of its kind.

    ``heavy`` marks entries that stand for several occurrences.
    """
    n = len(key)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    if second is not None:
        other = second[order]
        if (~new[1:] & (other[1:] != other[:-1])).any():
            order = np.lexsort((second, key))
            new[1:] = (key[order][1:] != key[order][:-1]) | (second[order][1:] != second[order][:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    weight = size if heavy is None else np.add.reduceat(1 + heavy[order].astype(np.int64), at)
    many, first = np.empty(n, bool), np.empty(n, bool)
    many[order] = np.repeat(weight > 1, size)
    first[order] = new
    return many, first
