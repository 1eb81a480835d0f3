"""Character n-grams of up to three code points, counted text by text inside tasks.

A gram is a number: 21 bits for each code point, which is raised by one so that no gram is the end
of a longer one. Texts are counted in groups of a bounded length; a longer text is alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bits of a code point, and the longest gram that a number holds.
BITS, LONGEST = 21, 3
#: Characters counted at once: with one bit string for text and gram, 15 and 3 * 16 bits are enough.
GROUP_CHARS = 1 << 16
GRAMS = "array<struct<g: bigint, n: int>>"
#: \s and \p{Z}, as in ``SPACE_PATTERN``; the last place stands for all code points beyond.
_SPACES = np.zeros(0x3002, bool)
_SPACES[[*range(9, 14), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True

Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def _group_counts(texts: Sequence[str], low: int, high: int) -> Counts:
    lengths = np.array([len(t) + 2 for t in texts])
    points = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
    gap = _SPACES[np.minimum(points, len(_SPACES) - 1)]
    # of every run of spaces one is left: it ends one padded word and begins the next
    keep = np.ones(len(points), bool)
    keep[1:] = ~gap[1:] | ~gap[:-1] | (owner[1:] != owner[:-1])
    points, owner, gap = np.where(gap, np.uint32(0x20), points)[keep].astype(np.uint64) + np.uint64(1), owner[keep], gap[keep]
    symbols, bits = None, int(points.max()).bit_length()
    if high * bits + len(texts).bit_length() > 64:
        symbols, points = np.unique(points, return_inverse=True)
        points, bits = points.astype(np.uint64), max(1, (len(symbols) - 1).bit_length())
    owners, grams, numbers = [], [], []
    gram = points
    for n in range(1, high + 1):
        if n > 1:
            gram = gram[:-1] << np.uint64(bits) | points[n - 1 :]
        if n < low:
            continue
        if n == 1:
            whole = ~gap
        elif n == 2:
            whole = ~(gap[:-1] & gap[1:])
        else:
            whole = ~gap[1:-1]
        shift = np.uint64(n * bits)
        # a text that is alone may need all 64 bits for its grams
        marked = gram[whole] if len(texts) == 1 else (owner[: len(gram)][whole] << shift | gram[whole])
        found, number = np.unique(marked, return_counts=True)
        text = np.zeros(len(found), np.int64) if len(texts) == 1 else (found >> shift).astype(np.int64)
        packed = np.zeros(len(found), np.int64)
        for place in range(n - 1, -1, -1):
            part = (found >> np.uint64(place * bits)) & np.uint64((1 << bits) - 1)
            packed = packed << BITS | (part if symbols is None else symbols[part]).astype(np.int64)
        owners.append(text)
        grams.append(packed)
        numbers.append(number)
        if n == 1:
            # every word is padded on both sides
            words = np.bincount(owner[gap].astype(np.int64), minlength=len(texts)) - 1
            some = np.flatnonzero(words)
            owners.append(some)
            grams.append(np.full(len(some), 0x21))
            numbers.append(2 * words[some])
    text = np.concatenate(owners)
    order = np.argsort(text.astype(np.uint16), kind="stable")
    return text[order], np.concatenate(grams)[order], np.concatenate(numbers)[order]


def count_grams(texts: Sequence[str], low: int = 1, high: int = LONGEST) -> Iterator[tuple[int, Counts]]:
    """``(texts, (text, gram, occurrences))`` of groups of neighbouring texts, in order of their texts."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) + 2 > GROUP_CHARS:
            yield i - begin, _group_counts(texts[begin:i], low, high)
            begin, size = i, 0
        size += len(t) + 2
    if begin < len(texts):
        yield len(texts) - begin, _group_counts(texts[begin:], low, high)


def _lists(owner: np.ndarray, texts: int, **values: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(v) for v in values.values()], list(values)))


def opened(grams: pa.ListArray) -> Counts:
    """Text, gram and occurrences of a batch of counted texts."""
    flat = grams.flatten()
    owner = np.repeat(np.arange(len(grams)), grams.value_lengths().fill_null(0).to_numpy())
    return owner, flat.field(0).to_numpy(), flat.field(1).to_numpy()


def gram_counts(text: Column, low: int = 1, high: int = LONGEST) -> Column:
    """The distinct grams of ``char_ngrams`` with their occurrences, as numbers; ``high`` is at most 3."""
    if not 1 <= low <= high <= LONGEST:
        raise ValueError(f"grams of {low} to {high} code points")

    @F.arrow_udf(GRAMS)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [_lists(o, k, g=g, n=n.astype(np.int32)) for k, (o, g, n) in count_grams(batch.to_pylist(), low, high)]
            none = np.zeros(0, np.int64)
            yield pa.concat_arrays(parts or [_lists(none, 0, g=none, n=none.astype(np.int32))])

    return counted(F.lower(F.coalesce(text, F.lit(""))))


def gram_text(gram: Column) -> Column:
    """The code points of a gram as text."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            g = batch.to_numpy(zero_copy_only=False)
            points = np.stack([(g >> (BITS * i)) & ((1 << BITS) - 1) for i in range(LONGEST - 1, -1, -1)], axis=1)
            there = points > 0
            points = points - there
            width = (1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)) * there
            ends = np.concatenate([[0], np.cumsum(width.sum(axis=1))]).astype(np.int32)
            data = points[there].astype(np.uint32).tobytes().decode("utf-32-le").encode()
            yield pa.StringArray.from_buffers(len(g), pa.py_buffer(ends.tobytes()), pa.py_buffer(data))

    return text(gram)


def packed(terms: Sequence[str]) -> np.ndarray:
    """Terms of one to three code points as numbers."""
    out = np.zeros(len(terms), np.int64)
    for i, term in enumerate(terms):
        g = 0
        for c in term:
            g = g << BITS | (ord(c) + 1)
        out[i] = g
    return out


class Vocabulary:
    """Numbered grams, found by bisection."""

    def __init__(self, grams: np.ndarray) -> None:
        self.order = np.argsort(grams)
        self.grams = grams[self.order]

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each gram is listed, and the numbers of those that are."""
        if not len(self.grams):
            return np.zeros(len(grams), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        return known, self.order[at[known]]


def unit_weights(vocabulary: Vocabulary, idf: np.ndarray, counts: Counts, texts: int) -> Counts:
    """Text, number of the term and weight; the weights of a text have length 1."""
    owner, grams, n = counts
    known, term = vocabulary.find(grams)
    owner, weight = owner[known], n[known] * idf[term]
    return owner, term, weight / np.sqrt(np.bincount(owner, weight * weight, texts))[owner]


def gram_weights(spark: SparkSession, grams: Column, terms: np.ndarray, idf: np.ndarray) -> Column:
    """From counted grams the listed ones with their weights: ``array<struct<g, w>>``."""
    shared = spark.sparkContext.broadcast((terms, idf))

    @F.arrow_udf("array<struct<g: bigint, w: double>>")
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        listed, weights = shared.value
        vocabulary = Vocabulary(listed)
        for batch in batches:
            owner, term, w = unit_weights(vocabulary, weights, opened(batch), len(batch))
            yield _lists(owner, len(batch), g=listed[term], w=w)

    return weighed(grams)


def gram_vectors(spark: SparkSession, grams: Column, terms: np.ndarray, idf: np.ndarray) -> Column:
    """From counted grams the sparse vector of their weights, as the struct that a vector is stored as."""
    shared = spark.sparkContext.broadcast((terms, idf))

    @F.arrow_udf("struct<type: tinyint, size: int, indices: array<int>, values: array<double>>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        listed, weights = shared.value
        vocabulary = Vocabulary(listed)
        for batch in batches:
            owner, term, w = unit_weights(vocabulary, weights, opened(batch), len(batch))
            order = np.lexsort((term, owner))
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(batch)))]).astype(np.int32)
            parts = [np.zeros(len(batch), np.int8), np.full(len(batch), len(listed), np.int32)]
            lists = [pa.ListArray.from_arrays(ends, pa.array(v[order])) for v in (term.astype(np.int32), w)]
            yield pa.StructArray.from_arrays([*map(pa.array, parts), *lists], ["type", "size", "indices", "values"])

    return vectors(grams)
