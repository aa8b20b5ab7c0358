"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

The bytes of a batch are walked in pieces of some 64 KB that end between words,
so memory beyond the batch itself is bounded by the piece or the longest word.
A word's hash is a polynomial over random byte values, taken from running sums:
equal words have equal hashes, different words collide with odds of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PIECE = 1 << 16
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"[\x20\x09-\x0D]"

_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_AS_IS = np.arange(256, dtype=np.uint8)
_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[list(SPACES)] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "power" not in _tables or len(_tables["power"]) < n:
        _tables["power"], _tables["inverse"] = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    return _tables["power"], _tables["inverse"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; changes its argument."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of an ordered tuple of hash columns."""
    out = parts[0] * np.uint64(0x9E3779B97F4A7C15)
    for k, part in enumerate(parts[1:], 1):
        out = mix(out + part * np.uint64(2 * k + 0xA0761D6478BD642F))
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and each row's bounds in them; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


@dataclass
class Words:
    """``hashes`` of all words of a batch in order; row i has ``rows[i]:rows[i + 1]``."""

    hashes: np.ndarray
    rows: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts())


def split_words(column: pa.Array, fold: bool = True, alnum: bool = False) -> Words:
    """Words as runs of bytes other than ASCII white space, or of letters and digits with ``alnum``.

    ``fold`` lower-cases A-Z. Bytes of 0x80 and above belong to words either way,
    so runs of bytes are the runs of characters that the patterns describe.
    """
    data, bounds = text_bytes(column)
    return _words(data, bounds, _FOLD if fold else _AS_IS, _ALNUM if alnum else _NOT_SPACE)


def _words(data: np.ndarray, bounds: np.ndarray, fold: np.ndarray, kind: np.ndarray) -> Words:
    hashes, at = [], []
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    begin = 0
    while begin < len(data):
        end = _piece_end(data, cut, begin, fold, kind)
        low = fold[data[begin:end]]
        inside = kind[low]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        before[cut[begin:end]] = False
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[cut[begin + 1 : end + 1]] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        power, inverse = _power_tables(end - begin)
        sums = np.zeros(end - begin + 1, np.uint64)
        np.cumsum(_VALUES[low] * power[: end - begin], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverse[starts]
        hashes.append(mix(h + (ends - starts).astype(np.uint64)))
        at.append(starts + begin)
        begin = end
    positions = np.concatenate(at) if at else np.zeros(0, np.int64)
    rows = np.searchsorted(positions, bounds)
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), rows)


def _piece_end(data, cut, begin: int, fold, kind) -> int:
    """Where the piece from ``begin`` ends: at a row's bound or a byte outside words."""
    end = min(begin + PIECE, len(data))
    while end < len(data):
        for last in range(end, max(begin, end - 4096), -1):
            if cut[last] or not kind[fold[data[last - 1]]]:
                return last
        end = min(end + PIECE, len(data))
    return end


def word_hash(word: str | bytes) -> int:
    """The hash ``split_words`` gives this single word."""
    raw = word.encode() if isinstance(word, str) else word
    return int(split_words(pa.array([raw.decode()]), fold=False).hashes[0])


def rest() -> None:
    """Give free memory back: a worker lives on after its task, and its share is the executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def bytewise(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one hold about ``most`` bytes, or one longer text."""
    yield from _cut(batches, column, most)
    if not isinstance(batches, list):  # a task's input has come to its end
        rest()


def _cut(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        if not len(sizes):
            continue
        part = np.cumsum(sizes, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def per_batch(column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A ``mapInArrow`` function that applies ``work`` to batches of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytewise(batches, column):
            yield work(batch)

    return run


def row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per row; rows without words sum to 0."""
    running = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=running[1:])
    return running[rows[1:]] - running[rows[:-1]]
