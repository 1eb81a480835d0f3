"""Quality scores: random Fourier features over document statistics, ridge, isotonic calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.tokens import Words, pieces, windows
from flowsift.session import stage

FEATURES = (
    "log_words",
    "word_length",
    "long_words",
    "distinct_words",
    "top_word",
    "distinct_pairs",
    "lines",
    "distinct_lines",
    "upper",
    "digits",
    "marks",
    "wide",
)
#: Equal steps of the raw score that calibration counts in.
STEPS = 2048

_CLASSES = np.zeros((256, 4), bool)
_CLASSES[0x41:0x5B, 0] = True
_CLASSES[0x30:0x3A, 1] = True
for _a, _b in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _CLASSES[_a:_b, 2] = True
_CLASSES[0x80:, 3] = True


def _piece_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n_docs = len(offsets) - 1
    out = np.zeros((n_docs, len(FEATURES)))
    words = Words(data, offsets, "spaced", lower=True)
    hashes, lengths = words.hashes(), words.ends - words.starts
    lines = Words(data, offsets, "line", lower=False)
    line_hashes = lines.hashes()
    pair_at, pairs = windows(hashes, words.first, 2)
    pair_first = np.searchsorted(pair_at, words.first)
    size = np.maximum(np.diff(offsets), 1)
    for c in range(4):
        upto = np.concatenate([[0], np.cumsum(_CLASSES[data, c])])
        out[:, 8 + c] = np.diff(upto[offsets]) / size
    n = np.maximum(words.counts, 1)
    for column, values in ((1, lengths), (2, lengths > 12)):
        upto = np.concatenate([[0], np.cumsum(values)])
        out[:, column] = np.diff(upto[words.first]) / n
    out[:, 0] = np.log1p(words.counts)
    out[:, 6] = lines.counts / n
    for d in range(n_docs):
        own = hashes[words.first[d] : words.first[d + 1]]
        if len(own):
            _, times = np.unique(own, return_counts=True)
            out[d, 3], out[d, 4] = len(times) / len(own), times.max() / len(own)
        own = pairs[pair_first[d] : pair_first[d + 1]]
        out[d, 5] = len(np.unique(own)) / len(own) if len(own) else 1.0
        own = line_hashes[lines.first[d] : lines.first[d + 1]]
        out[d, 7] = len(np.unique(own)) / len(own) if len(own) else 1.0
    return out


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and one double per statistic of the whole text; a NULL text counts as empty."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in pieces(batch.column(1)):
                found = _piece_statistics(data, offsets)
                ids = batch.column(0).slice(row, len(found))
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, np.ascontiguousarray(found.T))], ["doc_id", *FEATURES])

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class QualityModel:
    """Everything a task needs to score; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((np.nan_to_num(x) - self.mean) / self.scale, -6.0, 6.0)
        waves = math.sqrt(2.0 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])


def _summed(parts: DataFrame, partials: int) -> DataFrame:
    """Adds arrays held as bytes in two levels, each task holding one sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                x = np.frombuffer(value.as_buffer(), np.float64)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return parts.repartition(max(1, math.isqrt(partials))).mapInArrow(add, "sums binary").repartition(1).mapInArrow(add, "sums binary")


def rising(times: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Isotonic regression: pool neighbouring steps until means rise. Steps without rows must be left out."""
    blocks: list[list[float]] = []
    for n, s in zip(times, sums):
        blocks.append([float(n), float(s), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, s2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + s2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / n) for n, s, k in blocks])


def fit_quality(training: DataFrame, label: str = "label", waves: int = 256, ridge: float = 1e-3, seed: int = 11) -> QualityModel:
    """Fits on every row of ``training`` (the statistics and a 0/1 label; NULL labels are left out).

    Normal equations are summed per partition and then in two levels, so the driver receives one
    matrix of ``waves + 1`` rows. Calibration counts labels in ``STEPS`` equal steps of the raw
    score and pools them. Without rows every score is 0.5.
    """
    training = training.where(F.col(label).isNotNull())
    stats = training.agg(*[F.avg(f).alias(f"m_{f}") for f in FEATURES], *[F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES]).head()
    numbers = [[stats[f"{kind}_{f}"] or 0.0 for f in FEATURES] for kind in "ms"]
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean=np.array(numbers[0]),
        scale=np.maximum(np.array(numbers[1]), 1e-9),
        directions=rng.normal(0.0, 1.0 / math.sqrt(len(FEATURES)), (len(FEATURES), waves)),
        phases=rng.uniform(0.0, 2.0 * math.pi, waves),
        weights=np.zeros(waves + 1),
        knots=np.zeros(1),
        values=np.full(1, 0.5),
    )
    size = waves + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                z = model.expand(_matrix(part))
                y = part.column(label).to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    slim = training.select(*FEATURES, F.col(label).cast("double").alias(label))
    parts = int(training.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _summed(slim.mapInArrow(equations, "sums binary"), parts).collect()
    if not rows:
        return model
    total = np.frombuffer(rows[0].sums, np.float64).reshape(size, size + 1)
    seen = total[-1, size - 1]
    if not seen:
        return model
    model.weights = np.linalg.solve(total[:, :-1] + ridge * seen * np.diag([1.0] * waves + [1e-9]), total[:, -1])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch)), -0.5, 1.5)
            step = np.minimum((raw + 0.5) / 2.0 * STEPS, STEPS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(label), pa.array(raw)], ["step", "label", "raw"])

    counted = slim.mapInArrow(steps, "step int, label double, raw double").groupBy("step")
    table = counted.agg(F.count("*").alias("n"), F.sum("label").alias("s"), F.avg("raw").alias("at")).orderBy("step").collect()
    model.knots = np.array([r["at"] for r in table])
    model.values = rising(np.array([r["n"] for r in table]), np.array([r["s"] for r in table]))
    return model


def score_quality(statistics: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for rows of ``document_statistics``."""
    id_type = statistics.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return statistics.mapInArrow(run, f"doc_id {id_type}, score double")


def classify_quality(docs: DataFrame, labels: DataFrame, in_training: Column, label: str = "quality", doc_id: str = "doc_id") -> tuple[DataFrame, QualityModel]:
    """Scores every document after fitting on the labelled ones for which ``in_training`` holds.

    Only the text is an input of a score. Documents with several label rows count once for each;
    a NULL id never meets a label. Empty and NULL texts have statistics of zero words and a score.
    An empty table gives no rows. Other columns are not read. Returns ``doc_id, score`` and the model.
    """
    statistics = stage(document_statistics(docs, doc_id), "quality-statistics")
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
    training = statistics.where(in_training).join(known, "doc_id").drop("doc_id")
    model = fit_quality(training)
    return score_quality(statistics, model), model
