"""Threshold-scaled document sketches, and each document beside its successor."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.tokens import shingle_sets

#: One hash in so many is kept.
SCALE = 8
#: Rows of one range of ids.
RANGE_ROWS = 4096


def sketch(shingles: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sorted hashes below ``2**64 / scale``, and the smallest one so that no set with members has none."""
    kept = shingles[: int(np.searchsorted(shingles, np.uint64((1 << 64) // scale)))] if scale > 1 else shingles
    return kept if len(kept) else shingles[:1]


def encode(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of two texts taken together."""
    return np.union1d(a, b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(part: np.ndarray, whole: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second has, however long the second is."""
    return len(np.intersect1d(part, whole, assume_unique=True)) / len(part) if len(part) else 1.0


def sketches(texts: list[str], scale: int) -> list[np.ndarray]:
    return [sketch(s, scale) for s in shingle_sets(pa.array(texts, pa.large_string()))]


def fingerprint_documents(docs: DataFrame, scale: int = SCALE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every text; NULL counts as empty and has an empty fingerprint."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [encode(sketch(s, scale)) for s in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {id_type}, fingerprint string")


_PAIR = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], following: list[str], own: list[np.ndarray], after: list[np.ndarray], scale: int) -> pa.RecordBatch:
    edits = [_edited(t, f) for t, f in zip(texts, following)]
    edited = sketches(edits, scale)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
        pa.array([encode(x) for x in own], pa.string()),
        pa.array([encode(x) for x in edited], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, edited)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PAIR.split(", ")])


def compare_with_edits(docs: DataFrame, scale: int = SCALE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edit with the next text, and how near edit and next text are.

    The order is ascending id, then text; the last document is followed by the first, a single one
    by itself. The edit replaces the last half (rounded down) of the code points by the first as
    many of the next text. A NULL text is empty, NULL ids come first. Repeated rows are documents of
    their own. An empty table gives no rows; other columns are not read.

    One shuffle deals the texts into ranges of ids. Each range is streamed in order; only its first
    and last document are joined with those of the neighbouring ranges.
    """
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = max(1, -(-slim.count() // RANGE_ROWS))
    # the borders are sampled on the driver: beginnings of texts are enough, as they sort like the texts
    ranged = slim.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 32))
    in_order = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                own = sketches(texts, scale)
                if held:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], [held[2], *own]
                held = (ids[-1], texts[-1], own[-1])
                if len(ids) > 1:
                    yield _compare(ids[:-1], texts[:-1], texts[1:], own[:-1], own[1:], scale)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            if low is None:
                low = (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            high = (batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py())
        if low is not None:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "low_text": low[1], "doc_id": high[0], "text": high[1]}],
                pa.schema([("part", pa.int32()), ("low_text", pa.string()), ("doc_id", pa.int64()), ("text", pa.string())]),
            )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, following = (batch.column(i).to_pylist() for i in range(3))
            yield _compare(ids, texts, following, sketches(texts, scale), sketches(following, scale), scale)

    ends = in_order.withColumn("part", F.spark_partition_id()).mapInArrow(edges, "part int, low_text string, doc_id bigint, text string")
    ends = ends.repartition(min(ranges, 64), "part")
    ordered = ends.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    joined = (
        ends.select("part", "doc_id", "text")
        .join(ordered, "part")
        .join(ends.select(F.col("part").alias("next_part"), F.col("low_text").alias("following")), "next_part")
        .select("doc_id", "text", "following")
    )
    return in_order.mapInArrow(inside, _PAIR).unionByName(joined.mapInArrow(across, _PAIR))
