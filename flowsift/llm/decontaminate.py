"""Benchmark phrases in documents, found by an FM-index per shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.llm.fmindex import FMIndex
from flowsift.llm.tokens import Words, pieces
from flowsift.llm.words import ALNUM, ascii_lower

#: Words of one shard of documents, and of one block of benchmark items.
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 18

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@dataclass
class Phrases:
    """Distinct windows of some items: symbols of the words, one row per window, and the items of each."""

    vocabulary: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int) -> Phrases:
        found: dict[bytes, set[str]] = {}
        for item, text in items:
            for _, data, offsets in pieces(pa.array([text], pa.large_string())):
                hashes = Words(data, offsets, "alnum", lower=True).hashes()
                for at in range(max(len(hashes) - window, 0) + 1 if len(hashes) else 0):
                    found.setdefault(hashes[at : at + window].tobytes(), set()).add(item)
        windows = [np.frombuffer(w, np.uint64) for w in found]
        vocabulary = np.unique(np.concatenate(windows)) if windows else np.zeros(0, np.uint64)
        rows = np.zeros((len(windows), window), np.int64)
        for i, w in enumerate(windows):
            rows[i, : len(w)] = np.searchsorted(vocabulary, w) + 1
        return cls(vocabulary, rows, np.array([len(w) for w in windows], np.int64), [sorted(x) for x in found.values()])

    def occurrences(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and phrase numbers of all occurrences in documents that begin at ``first``.

        The index holds runs of at least the shortest phrase's length of words that some phrase has;
        what lies between them can be in no occurrence.
        """
        none = np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(hashes):
            return none, none
        symbol = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[symbol] == hashes
        starts = known.copy()
        starts[1:] &= ~known[:-1]
        begins = first[:-1][first[:-1] < len(hashes)]
        starts[begins] = known[begins]
        run = np.cumsum(starts)[known] - 1
        at = np.flatnonzero(known)
        lengths = np.bincount(run, minlength=int(starts.sum()))
        long = lengths >= self.lengths.min()
        at = at[long[run]]
        if not len(at):
            return none, none
        lengths = lengths[long]
        index = FMIndex(symbol[at] + 1, lengths, len(self.vocabulary))
        low, high = index.search(self.rows, self.lengths)
        times = high - low
        phrase = np.repeat(np.arange(len(times)), times)
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        place = index.locate(rows)
        ends = np.cumsum(lengths + 1)
        return at[place - np.searchsorted(ends, place, "right")], phrase


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of bounded size; only one block is on the driver at a time."""
    slim = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sized = slim.distinct().withColumn("words", F.regexp_count(ascii_lower(F.col("text")), F.lit(ALNUM)))
    upto = F.sum("words").over(Window.orderBy("item", "text").rowsBetween(Window.unboundedPreceding, -1))
    dealt = sized.withColumn("block", F.floor(F.coalesce(upto, F.lit(0)) / BLOCK_WORDS))
    for number in [r.block for r in dealt.select("block").distinct().orderBy("block").collect()]:
        yield [(r.item, r.text) for r in dealt.where(F.col("block") == number).select("item", "text").collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Adds ``n_words, hit_spans, hit_items`` to the documents; their own columns of these names go.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A
    phrase is ``window`` consecutive words of an item, or all words of a shorter one. ``hit_spans``
    are the maximal runs of words that occurrences cover (end exclusive), ``hit_items`` the distinct
    ids, as sorted strings, of items with an occurring phrase. A NULL text has no words; an item
    without words has no phrase; a NULL id counts as an empty string. Repeated rows are searched
    each. Empty tables are fine: without phrases nothing is hit.

    Each task indexes its documents shard by shard and searches the phrases in every index, so no
    document is moved. A benchmark of more than ``BLOCK_WORDS`` words is searched in blocks, one after
    the other in the same task.
    """
    added = ("n_words", "hit_spans", "hit_items")
    own = [c for c in docs.columns if c not in added]
    out = docs.select(*own).withColumns({"n_words": F.lit(0).cast("bigint"), "hit_spans": F.lit(None).cast(SPANS), "hit_items": F.lit(None).cast("array<string>")})
    for block in _blocks(benchmark, item_id, item_text):
        out = _search(out, Phrases.of(block, window), text)
    return out


def _search(docs: DataFrame, phrases: Phrases, text: str) -> DataFrame:
    schema = docs.schema
    column = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[np.ndarray, np.ndarray]] = []
            begun = 0
            for row, data, offsets in pieces(batch.column(column)):
                words = Words(data, offsets, "alnum", lower=True)
                held.append((words.hashes(), words.counts))
                end = row + len(words.counts)
                if end == batch.num_rows or sum(len(h) for h, _ in held) >= SHARD_WORDS:
                    hashes, counts = (np.concatenate(x) for x in zip(*held))
                    yield _marked(batch.slice(begun, end - begun), hashes, counts, phrases)
                    held, begun = [], end

    return docs.mapInArrow(run, schema)


def _marked(batch: pa.RecordBatch, hashes: np.ndarray, counts: np.ndarray, phrases: Phrases) -> pa.RecordBatch:
    first = np.concatenate([[0], np.cumsum(counts)])
    place, phrase = phrases.occurrences(hashes, first)
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + phrases.lengths[phrase], -1)
    hit = np.cumsum(cover) > 0
    owner = np.searchsorted(first, place, "right") - 1
    spans = batch.column(batch.schema.get_field_index("hit_spans")).to_pylist()
    items = batch.column(batch.schema.get_field_index("hit_items")).to_pylist()
    for d in np.unique(owner):
        covered = hit[first[d] : first[d + 1]].copy()
        for s in spans[d] or ():
            covered[s["start"] : s["end"]] = True
        edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        spans[d] = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
        found = {item for p in np.unique(phrase[owner == d]) for item in phrases.items[p]}
        items[d] = sorted(found | set(items[d] or ()))
    new = {"n_words": pa.array(counts, pa.int64()), "hit_spans": spans, "hit_items": items}
    columns = [
        pa.array(new[f.name], f.type) if f.name in new else batch.column(i) for i, f in enumerate(batch.schema)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def hit_words() -> Column:
    """Number of words in ``hit_spans``."""
    return F.coalesce(F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]), F.lit(0).cast("bigint"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
