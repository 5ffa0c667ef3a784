"""Words, lines and shingles of a batch of texts, as flat numpy arrays.

A batch is one run of UTF-8 bytes with document offsets, as Arrow holds it. White space
is ASCII (``[\\x20\\x09-\\x0D]``), so a cut at it never splits a character. Words are
compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time inside a task; a longer document is a slice alone.
SLICE_BYTES = 4 << 20

_SEED = 20240229
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_CODES[_SPACE] = 0
_LOWER_CODES = _BYTE_CODES.copy()
_LOWER_CODES[65:91] = _BYTE_CODES[97:123]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text or one document."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes, dtype=np.int64) - 1) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


@dataclass
class Texts:
    """Bytes of all texts of a batch, end to end, and where each text begins."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """Null is an empty text."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        return cls(whole[at[0] : at[-1]], at - at[0])

    @staticmethod
    def of_bytes(column: pa.LargeBinaryArray) -> bytes:
        """All values of a column without nulls, end to end."""
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[[column.offset, column.offset + len(column)]] if len(column) else (0, 0)
        return data[at[0] : at[1]].to_pybytes() if at[1] > at[0] else b""

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def space(self) -> np.ndarray:
        return _SPACE[self.data]

    @cached_property
    def word_starts(self) -> np.ndarray:
        """Byte position of the first byte of each word."""
        begins = ~self.space
        if len(begins):
            begins[1:] &= self.space[:-1] | self.text_begins[1:]
        return np.flatnonzero(begins)

    @cached_property
    def text_begins(self) -> np.ndarray:
        begins = np.zeros(len(self.data), bool)
        begins[self.offsets[:-1][self.offsets[:-1] < len(self.data)]] = True
        return begins

    @cached_property
    def word_docs(self) -> np.ndarray:
        return np.searchsorted(self.offsets, self.word_starts, side="right") - 1

    @cached_property
    def word_offsets(self) -> np.ndarray:
        """Number of words before each text; one more than there are texts."""
        return np.searchsorted(self.word_starts, self.offsets)

    def count_in_words(self, bytes_counted: np.ndarray) -> np.ndarray:
        """For each word, how many of its bytes the table of 256 flags counts."""
        if not len(self.word_starts):
            return np.zeros(0, np.int64)
        return np.add.reduceat((bytes_counted[self.data] & ~self.space).astype(np.int64), self.word_starts)

    def count_in_texts(self, bytes_counted: np.ndarray) -> np.ndarray:
        before = np.concatenate(([0], np.cumsum(bytes_counted[self.data], dtype=np.int64)))
        return before[self.offsets[1:]] - before[self.offsets[:-1]]

    def word_hashes(self, lower: bool = False, first_bytes: int | None = None) -> np.ndarray:
        """64-bit hash of each word; of its first bytes only, if their number is given."""
        starts = self.word_starts
        if not len(starts):
            return np.zeros(0, np.uint64)
        place = np.arange(starts[0], len(self.data))
        place -= np.repeat(starts, np.diff(np.append(starts, len(self.data))))
        codes = (_LOWER_CODES if lower else _BYTE_CODES)[self.data[starts[0] :]]
        codes *= _powers(int(place.max()) + 1)[place]
        if first_bytes is not None:
            codes[place >= first_bytes] = 0
        return mix(np.add.reduceat(codes, starts - starts[0]))

    def windows(self, hashes: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words inside one text, and its first word's index."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = hashes[:n].copy()
        for i in range(1, size):
            value = mix(value * _STEP + hashes[i : i + n])
        first = np.flatnonzero(self.word_docs[:n] == self.word_docs[size - 1 :])
        return value[first], first

    def line_hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text index and whether there is a word, for each \\n-separated line."""
        newline = np.flatnonzero(self.data == 10)
        n_lines = 1 + np.searchsorted(newline, self.offsets[1:]) - np.searchsorted(newline, self.offsets[:-1])
        docs = np.repeat(np.arange(len(self)), n_lines)
        starts = np.sort(np.concatenate((self.offsets[:-1], newline + 1)), kind="stable")
        ends = np.sort(np.concatenate((self.offsets[1:], newline)), kind="stable")
        length = ends - starts
        codes = _BYTE_CODES.copy()
        codes[_SPACE] = np.random.default_rng(_SEED + 1).integers(1, 2**63, int(_SPACE.sum()), dtype=np.uint64)
        filled = np.flatnonzero(length)
        hashes = np.zeros(len(starts), np.uint64)
        has_word = np.zeros(len(starts), bool)
        if len(filled):
            at = np.repeat(starts[filled] - np.concatenate(([0], np.cumsum(length[filled])[:-1])), length[filled])
            at += np.arange(len(at))
            begins = np.concatenate(([0], np.cumsum(length[filled])[:-1]))
            place = np.arange(len(at)) - np.repeat(begins, length[filled])
            hashes[filled] = mix(np.add.reduceat(codes[self.data[at]] * _powers(int(length.max()))[place], begins))
            has_word[filled] = np.add.reduceat((~self.space[at]).astype(np.int64), begins) > 0
        return hashes, docs, has_word


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, again
