"""Removal of exact repeats across documents by fixed-block anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.tokens import Words, pieces, windows

#: Bytes of text per bucket of hashes, and per hand-over of a task to the buckets.
BUCKET_BYTES = 12 << 20
FLUSH_BYTES = 2 << 20

_ENTRIES = "bucket int, final boolean, ids binary, far_ids binary, parts binary, words binary, steps binary, far binary, keys binary, more binary"
_PACKED = "share int, ids binary, parts binary, counts binary, places binary"
_PLACES = "doc_id bigint, part int, places binary"


def _steps(places: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers as one byte per step; steps down and of 255 and more follow apart."""
    step = np.diff(places, prepend=0)
    far = (step < 0) | (step >= 255)
    return np.where(far, 255, step).astype(np.uint8).tobytes(), step[far].astype(np.int64).tobytes()


def _places(steps: bytes, far: bytes) -> np.ndarray:
    step = np.frombuffer(steps, np.uint8).astype(np.int64)
    step[step == 255] = np.frombuffer(far, np.int64)
    return np.cumsum(step)


class _Held:
    """Entries of some documents, counted from the first word held, until they go to their buckets."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.turn = buckets, 0
        self.clear()

    def clear(self) -> None:
        self.ids: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.more: list[np.ndarray] = []
        self.words = self.bytes = 0

    def add(self, ids, parts, words: Words, at, keys, more, size: int) -> None:
        self.ids.append(ids)
        self.parts.append(parts)
        self.starts.append(words.first[:-1] + self.words)
        self.at.append(at + self.words)
        self.keys.append(keys)
        self.more.append(more)
        self.words += len(words.starts)
        self.bytes += size

    def flush(self, resolve) -> Iterator[pa.RecordBatch]:
        """``resolve(ids, places in documents, keys, more)`` says which entries to send and which are hits already."""
        if not self.bytes:
            return
        ids, parts, starts, at, keys, more = map(np.concatenate, (self.ids, self.parts, self.starts, self.at, self.keys, self.more))
        self.clear()
        owner = np.searchsorted(starts, at, "right") - 1
        send, hit = resolve(ids[owner], at - starts[owner], keys, more)
        self.turn += 1
        rows = [self._row(self.turn % self.buckets, True, ids, parts, starts, at[hit], owner[hit], keys[:0], more[:0])] if hit.any() else []
        bucket = ((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int32)
        chosen = np.flatnonzero(send)
        chosen = chosen[np.argsort(bucket[chosen], kind="stable")]
        edges = np.searchsorted(bucket[chosen], np.arange(self.buckets + 1))
        for b in range(self.buckets):
            own = chosen[edges[b] : edges[b + 1]]
            if len(own):
                rows.append(self._row(b, False, ids, parts, starts, at[own], owner[own], keys[own], more[own] if len(more) else more))
        if rows:
            names = [f.split()[0] for f in _ENTRIES.split(", ")]
            kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 8]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def _row(self, bucket, final, ids, parts, starts, at, owner, keys, more) -> tuple:
        used = np.unique(owner)
        # the words before each document that is used, since the one before it
        words = np.diff(starts[used], prepend=0).astype(np.uint32)
        # the bucket holds the rest of the key
        return bucket, final, *_steps(ids[used]), parts[used].tobytes(), words.tobytes(), *_steps(at), keys.astype(np.uint32).tobytes(), more.tobytes()


def _read(row: dict) -> tuple[np.ndarray, ...]:
    at = _places(row["steps"], row["far"])
    starts = np.cumsum(np.frombuffer(row["words"], np.uint32).astype(np.int64))
    owner = np.searchsorted(starts, at, "right") - 1
    return (
        _places(row["ids"], row["far_ids"])[owner],
        np.frombuffer(row["parts"], np.int32)[owner],
        (at - starts[owner]).astype(np.int32),
        np.frombuffer(row["keys"], np.uint32),
        np.frombuffer(row["more"], np.uint32),
    )


def _runs(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Where documents begin and end in rows ordered by them."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (parts[1:] != parts[:-1])
    return np.append(np.flatnonzero(new), len(ids))


def _packed(ids: np.ndarray, parts: np.ndarray, places: np.ndarray, shares: int) -> pa.RecordBatch:
    """Hits, one row for each share of the documents that has any."""
    share = parts % shares
    order = np.lexsort((places, parts, ids, share))
    edges = np.searchsorted(share[order], np.arange(shares + 1))
    rows = []
    for s in np.flatnonzero(np.diff(edges)):
        own = order[edges[s] : edges[s + 1]]
        runs = _runs(ids[own], parts[own])
        first = own[runs[:-1]]
        rows.append((int(s), ids[first].tobytes(), parts[first].tobytes(), np.diff(runs).astype(np.uint32).tobytes(), places[own].astype(np.int32).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32(), *[pa.binary()] * 4])], [c.split()[0] for c in _PACKED.split(", ")])


def _by_document(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if held:
        ids, parts, places = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((places, parts, ids))
        ids, parts, places = ids[order], parts[order], places[order]
        edges = _runs(ids, parts)
        first = edges[:-1]
        blobs = [places[a:b].tobytes() for a, b in zip(first, edges[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(parts[first]), pa.array(blobs, pa.binary())], ["doc_id", "part", "places"])


def _resolved(entries: DataFrame, resolve, shares: int) -> DataFrame:
    """Hits of all entries by document. A task holds one bucket, then one share of the documents, at a time."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def hits() -> Iterator[pa.RecordBatch]:
            if held:
                ids, parts, places, keys, more = (np.concatenate(x) for x in zip(*held))
                held.clear()
                hit = resolve(ids, places, keys, more)[1]
                if hit.any():
                    yield _packed(ids[hit], parts[hit], places[hit], shares)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                if row["bucket"] != bucket:
                    yield from hits()
                    bucket = row["bucket"]
                if row["final"]:
                    yield _packed(*_read(row)[:3], shares)
                else:
                    held.append(_read(row))
        yield from hits()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                number, *blobs = (c[i].as_py() for c in batch.columns)
                ids, parts, counts, places = (np.frombuffer(b, t) for b, t in zip(blobs, (np.int64, np.int32, np.uint32, np.int32)))
                if number != share:
                    yield from _by_document(held)
                    held.clear()
                    share = number
                held.append((np.repeat(ids, counts), np.repeat(parts, counts), places))
        yield from _by_document(held)

    packed = entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, _PACKED)
    return packed.repartition("share").sortWithinPartitions("share").mapInArrow(gather, _PLACES)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where groups begin in it."""
    if keys.dtype == np.uint32:  # the key and the place in one number sort without a second array
        packed = (keys.astype(np.uint64) << np.uint64(32)) | np.arange(len(keys), dtype=np.uint64)
        packed.sort()
        order, keys = packed.astype(np.uint32), (packed >> np.uint64(32)).astype(np.uint32)
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = keys[1:] != keys[:-1]
    return order, np.flatnonzero(new)


def _spread(values: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(begins, n)))


def _anchors(block: int):
    """Anchors that meet a probe: a reference block stands at a multiple of ``block`` words of a document."""

    def resolve(ids, places, keys, more):
        send, hit = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        if not len(ids):
            return send, hit
        order, begins = _groups(keys)
        own, reference = ids[order], places[order] % block == 0
        smallest = np.minimum.reduceat(np.where(reference, own, np.iinfo(np.int64).max), begins)
        largest = np.maximum.reduceat(own, begins)
        probe_hit = _spread(smallest, begins, len(own)) < own
        largest = _spread(largest, begins, len(own))
        hit[order] = probe_hit | (reference & (largest > own))
        # what others need: the smallest reference, the largest probe, and probes that still miss one
        send[order] = ~probe_hit | (own == largest)
        return send, hit

    return resolve


def _repeats(ids, places, keys, more):
    """Windows that also start in a document of smaller id."""
    send, hit = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
    if len(ids):
        order, begins = _groups((keys.astype(np.uint64) << np.uint64(32)) ^ more)
        own = ids[order]
        smallest = _spread(np.minimum.reduceat(own, begins), begins, len(own))
        send[order], hit[order] = own == smallest, own > smallest
    return send, hit


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows that repeat an id are told apart by their text."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.hash(content).alias("part"), content.alias("text"))


def _scan(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids = batch.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        parts = batch.column(1).to_numpy()
        for row, data, offsets in pieces(batch.column(2)):
            rows = slice(row, row + len(offsets) - 1)
            yield batch, rows, known[rows], ids[rows], parts[rows], data, offsets


def find_repeats(docs: DataFrame, min_words: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Starts of all windows of ``min_words`` words that also start in a document of smaller id.

    Returns the texts with ``places``, the window starts as 32-bit numbers, NULL where there is none.

    Every document is cut into blocks of ``(min_words + 1) // 2`` words, so each window holds a whole
    block of any document it repeats. Blocks are the reference, every rolling window of a block's
    length is a probe; their hashes meet in buckets. Around each hit the windows of full length are
    compared by two hashes (64 bits and those of the bucket), and neighbouring repeats join into maximal ones. Tasks settle what they can
    among their own rows first: of a phrase that many documents share, a task hands on the probes that
    precede its first reference, its last probe, and later one window.
    """
    block = (min_words + 1) // 2
    slim = _texts(docs, doc_id, text)
    size = slim.agg(F.sum(F.octet_length("text")).alias("n")).head().n or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    anchors = _anchors(block)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(buckets)
        for _, _, known, ids, parts, data, offsets in _scan(batches):
            words = Words(data, offsets, "spaced", lower=False)
            at, keys = windows(words.hashes(), words.first, block)
            if not known.all():
                keep = known[np.searchsorted(words.first, at, "right") - 1]
                at, keys = at[keep], keys[keep]
            held.add(ids, parts, words, at, keys, np.zeros(0, np.uint32), len(data))
            if held.bytes >= FLUSH_BYTES:
                yield from held.flush(anchors)
        yield from held.flush(anchors)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(buckets)
        for batch, rows, known, ids, parts, data, offsets in _scan(batches):
            marked = batch.column(3).slice(rows.start, len(ids)).to_pylist()
            if not any(marked):
                continue
            words = Words(data, offsets, "spaced", lower=False)
            hits = np.zeros(len(words.starts) + min_words, np.int32)
            for d, found in enumerate(marked):
                if found:
                    hits[words.first[d] + np.frombuffer(found, np.int32)] = 1
            hashes = words.hashes()
            at, keys = windows(hashes, words.first, min_words)
            more = windows(hashes, words.first, min_words, salt=1)[1].astype(np.uint32)
            upto = np.concatenate([[0], np.cumsum(hits)])
            near = upto[at + min_words - block + 1] > upto[at]
            held.add(ids, parts, words, at[near], keys[near], more[near], len(data))
            if held.bytes >= FLUSH_BYTES:
                yield from held.flush(_repeats)
        yield from held.flush(_repeats)

    hits = _resolved(slim.mapInArrow(blocks, _ENTRIES), anchors, buckets)
    marked = slim.join(hits, ["doc_id", "part"], "left").select("doc_id", "part", "text", "places")
    return slim.join(_resolved(marked.mapInArrow(whole, _ENTRIES), _repeats, buckets), ["doc_id", "part"], "left").select("doc_id", "text", "places")


_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, min_words: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Takes out every word covered by a window of ``min_words`` words that starts in a document of smaller id too.

    Returns per row ``doc_id, n_words, n_removed, spans`` (maximal runs of removed words, end
    exclusive) and ``kept`` (the other words joined by one space). Words are separated by ASCII white
    space and compared unchanged; windows are judged on the input. A NULL text has no words. A row
    with a NULL id keeps all its words and removes none elsewhere. Rows that share an id never remove
    words from each other. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, gone, spans, kept = [], [], [], []
                for content, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = content.encode().split()
                    cover = np.zeros(len(words) + 1, np.int32)
                    if found:
                        starts = np.frombuffer(found, np.int32)
                        np.add.at(cover, starts, 1)
                        np.add.at(cover, starts + min_words, -1)
                    removed = np.cumsum(cover) > 0  # the last entry lies behind the text
                    edge = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                    n.append(len(words))
                    gone.append(int(removed.sum()))
                    if gone[-1]:
                        words = [w for w, r in zip(words, removed.tolist()) if not r]
                    kept.append(b" ".join(words).decode())
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "spans", "kept"])

    return find_repeats(docs, min_words, doc_id, text).mapInArrow(run, _RESULT)
