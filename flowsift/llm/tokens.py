"""Word and shingle hashes of whole Arrow text columns, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once. Longer documents are one piece of their own.
PIECE = 1 << 19

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MULT = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _word_bytes(keep: str) -> np.ndarray:
    table = np.ones(256, bool)
    if keep == "spaced":
        table[[0x20, 9, 10, 11, 12, 13]] = False
    elif keep == "line":
        table[10] = False
    else:
        table[:128] = False
        table[0x61:0x7B] = True
        if keep == "alnum":
            table[0x30:0x3A] = True
    return table


#: Bytes inside words: not white space, not a line end, lower-case letters and digits, letters. Bytes
#: of characters beyond ASCII always belong to words.
_WORD_BYTE = {keep: _word_bytes(keep) for keep in ("spaced", "line", "alnum", "letters")}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _MULT[0]
    h = (h ^ (h >> np.uint64(27))) * _MULT[1]
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of bounded size. NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """Words of some documents: byte ``starts`` and ``ends``; document d has words first[d] to first[d + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keep: str, lower: bool) -> None:
        self.data = _LOWER[data] if lower else data
        inside = _WORD_BYTE[keep][self.data]
        n = len(inside)
        before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        before[1:] = inside
        after[:-1] = inside
        before[offsets] = False  # a document starts and ends words
        after[offsets] = False
        self.starts = np.flatnonzero(inside & ~before[:n])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits per word, equal for equal words in any document."""
        n = len(self.data)
        power, inverse = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power[:n], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def documents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def windows(hashes: np.ndarray, first: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every k consecutive words inside one document."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(salt * 2 + 1), np.uint64)
    for j in range(k):
        total = (total + hashes[j : j + n]) * np.uint64(pow(_BASE, 2 * salt + 3, 1 << 64))
    inside = np.ones(n, bool)
    for edge in np.unique(first[1:-1]):
        inside[max(0, edge - k + 1) : edge] = False
    at = np.flatnonzero(inside)
    return at, mix(total[at])


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in document order and where each document's begin.

    A document of fewer than ``k`` words has its whole sequence as the only one, without words none.
    """
    hashes = words.hashes()
    at, found = windows(hashes, words.first, k)
    document = np.searchsorted(words.first, at, "right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            longer = words.counts[short] > j
            whole[longer] = (whole[longer] + hashes[words.first[short[longer]] + j]) * np.uint64(_BASE)
        order = np.argsort(np.concatenate([document, short]), kind="stable")
        found = np.concatenate([found, mix(whole ^ words.counts[short].astype(np.uint64))])[order]
        document = np.concatenate([document, short])[order]
    return found, np.searchsorted(document, np.arange(len(words.counts) + 1))


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row: lower-cased A-Z, white-space words."""
    for _, data, offsets in pieces(column):
        found, begins = shingles(Words(data, offsets, "spaced", lower=True), k)
        for a, b in zip(begins[:-1], begins[1:]):
            yield np.unique(found[a:b])
