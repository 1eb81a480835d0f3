"""Bounded samples that are aggregated where the rows lie."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.draws import draw_key
from flowsift.schema import quoted
from flowsift.session import stage

#: Rows hashed at once, and groups that partial samples are merged in before the last merge.
CHUNK, MERGES = 1024, 64


def sample_hashes(keys: np.ndarray, samples: int) -> np.ndarray:
    """One uniform hash of 63 bits for every key and sample (finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        turn = np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = keys.astype(np.int64).view(np.uint64)[:, None] + turn
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


class Smallest:
    """The ``size`` smallest distinct hashes of every sample; two of them merge into one."""

    def __init__(self, samples: int, size: int) -> None:
        self.size = size
        self.kept = [np.zeros(0, np.int64) for _ in range(samples)]
        self.limit = np.full(samples, np.iinfo(np.int64).max)

    def add(self, sample: int, hashes: np.ndarray) -> None:
        kept = np.unique(np.concatenate([self.kept[sample], hashes]))[: self.size]
        self.kept[sample] = kept
        if len(kept) == self.size:
            self.limit[sample] = kept[-1]

    def add_keys(self, keys: np.ndarray) -> None:
        for a in range(0, len(keys), CHUNK):
            hashes = sample_hashes(keys[a : a + CHUNK], len(self.kept))
            smaller = hashes < self.limit
            for t in np.flatnonzero(smaller.any(axis=0)):
                self.add(t, hashes[smaller[:, t], t])


def _partial(samples: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest = Smallest(samples, size)
        for batch in batches:
            smallest.add_keys(batch.column("k").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(samples), pa.int32()), pa.array(smallest.kept, pa.list_(pa.int64()))], ["sample", "hashes"]
        )

    return run


def _merged(parts: DataFrame, size: int, *by: str) -> DataFrame:
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        smallest = Smallest(1, size)
        for hashes in group["hashes"]:
            smallest.add(0, np.asarray(hashes, np.int64))
        return pd.DataFrame({"sample": [int(group["sample"].iloc[0])], "hashes": [smallest.kept[0]]})

    return parts.groupBy("sample", *by).applyInPandas(merge, "sample int, hashes array<bigint>")


def _chosen(limits: np.ndarray):
    """Rows of each sample, those up to its limit; a key that repeats in a task comes once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = batch.column("k").to_numpy()
            for a in range(0, len(keys), CHUNK):
                hashes = sample_hashes(keys[a : a + CHUNK], len(limits))
                rows, samples = np.nonzero(hashes <= limits)
                found = []
                for row, sample in zip(rows.tolist(), samples.tolist()):
                    mark = (sample, int(hashes[row, sample]))
                    if mark not in seen:
                        seen.add(mark)
                        found.append((a + row, *mark))
                if found:
                    at, sample, h = zip(*found)
                    columns = [pa.array(sample, pa.int32()), pa.array(h, pa.int64()), batch.column("x").take(pa.array(at))]
                    yield pa.RecordBatch.from_arrays(columns, ["sample", "h", "x"])

    return run


def key_samples(df: DataFrame, keys: Sequence[str], values: Column, samples: int, size: int, seed: int) -> DataFrame:
    """(sample, h, x): for every sample the rows of the ``size`` smallest hashes of their keys.

    One rule at any size of the table: tasks keep the smallest hashes of every sample, those merge in two
    steps to one limit a sample, and a second scan hands over the rows up to it. Only the sampled rows
    are shuffled. Rows that repeat a key share its hash and count once; a sample is without replacement.
    """
    key = F.xxhash64(draw_key(keys, seed)).alias("k")
    partial = df.select(key).mapInArrow(_partial(samples, size), "sample int, hashes array<bigint>")
    partial = partial.withColumn("part", F.spark_partition_id() % MERGES)
    merged = _merged(_merged(partial, size, "part"), size)
    limits = np.full(samples, -1)
    for row in merged.select("sample", F.array_max("hashes").alias("limit")).collect():  # one row a sample
        limits[row["sample"]] = -1 if row["limit"] is None else row["limit"]
    return df.select(key, values.alias("x")).mapInArrow(_chosen(limits), "sample int, h bigint, x array<double>")


def stratified_sample(
    df: DataFrame, label: str, most: int, floor: int, seed: int, out: str = "represents"
) -> tuple[DataFrame, dict[object, int]]:
    """About ``most`` rows drawn within the classes of ``label``, and the rows of every class in ``df``.

    A class gets its share of ``most``, and ``floor`` rows (or all it has) if that is more, so the sample
    has at most ``most`` rows and a floor for each class. Every row draws for itself, copies of one row
    too. ``out`` is the number of rows that a sampled one stands for: it sums to the class's size. NULL is
    a class. Classes must be few, as those of a classifier are.

    Each task drops what cannot be among the smallest draws of its class, so about twice the sample is
    shuffled. The sample is written once, as the draws depend on the order of rows in a task.
    """
    counts = {r[0]: r[1] for r in df.groupBy(F.col(quoted(label))).count().collect()}
    total = sum(counts.values())
    wanted = {c: min(n, max(floor, round(most * n / total))) for c, n in counts.items()}
    if not counts:
        return df.withColumn(out, F.lit(1.0)), counts

    def by_class(of: dict[object, float]) -> Column:
        value = F.lit(None).cast("double")
        for c, x in of.items():
            value = F.when(F.col(quoted(label)).eqNullSafe(F.lit(c)), F.lit(float(x))).otherwise(value)
        return value

    # twice the share and 100 rows more: fewer than wanted come out once in more than e^30 samples,
    # and then the weights follow the rows there are
    bound = {c: min(1.0, (2 * wanted[c] + 100) / n) for c, n in counts.items()}
    drawn = df.withColumn("__draw", F.rand(seed)).where(F.col("__draw") <= by_class(bound))
    order = Window.partitionBy(F.col(quoted(label))).orderBy("__draw")
    chosen = drawn.withColumn("__turn", F.row_number().over(order)).where(F.col("__turn") <= by_class(wanted))
    sample = stage(chosen.drop("__draw", "__turn"), "sample")
    kept = {r[0]: r[1] for r in sample.groupBy(F.col(quoted(label))).count().collect()}
    return sample.withColumn(out, by_class({c: counts[c] / n for c, n in kept.items()})), counts
