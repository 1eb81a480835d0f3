"""Streaming forms of scoring, counters, histograms, deduplication and quarantine."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from flowsift.operators.columns import is_valid_event
from flowsift.operators.monitor import bucket_counts, event_counters, sketch_bucket, unpivot_buckets
from flowsift.plans.score import ScoringBundle
from flowsift.session import scratch_dir


#: State on local disk of the executors, with its changes in the checkpoint, instead of in their memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_CLASS = "spark.sql.streaming.stateStore.providerClass"


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet", files_per_batch: int | None = 64
) -> DataFrame:
    """Parquet files arriving in a folder. Without a limit, a batch takes all that have arrived."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


class Arrivals:
    """Rows that arrive in a folder by time, one part after another, each written by many tasks.

    The first part is there at once. Iterating yields once for every part, when it has arrived. Rows
    without a time come with the first part.
    """

    def __init__(self, rows: DataFrame, ts: str, parts: int, folder: str) -> None:
        self.rows, self.parts, self.folder = rows, parts, folder
        seconds = F.col(ts).cast("timestamp").cast("double")
        low, high = rows.agg(F.min(seconds), F.max(seconds)).head()
        share = (seconds - F.lit(low)) / F.lit(max((high or 0.0) - (low or 0.0), 1.0))
        self._part = F.coalesce(F.least(F.floor(share * parts), F.lit(parts - 1)), F.lit(0))
        self._write(0)

    def _write(self, i: int) -> None:
        self.rows.where(self._part == i).write.parquet(f"{self.folder}/part-{i}")

    def __iter__(self) -> Iterator[int]:
        yield 0
        for i in range(1, self.parts):
            self._write(i)
            yield i

    def stream(self) -> DataFrame:
        return read_stream(self.rows.sparkSession, f"{self.folder}/*", self.rows.schema, files_per_batch=None)


@contextmanager
def state_store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """Streams started inside keep their state in ``provider``; None leaves the session as it is."""
    before = spark.conf.get(STORE_CLASS, None)
    if provider is not None:
        spark.conf.set(STORE_CLASS, provider)
    try:
        yield
    finally:
        if provider is not None:
            spark.conf.unset(STORE_CLASS) if before is None else spark.conf.set(STORE_CLASS, before)


def stream_score(events: DataFrame, bundle: ScoringBundle) -> DataFrame:
    """Stateless scoring, append mode."""
    return bundle.score(events)


def stream_counters(
    events: DataFrame, ts: str, flag: Column, window: str, delay: str, by: Sequence[str] = ()
) -> DataFrame:
    """Counters per tumbling window; rows later than ``delay`` are left out."""
    slot = F.window(ts, window)
    counted = event_counters(events.withWatermark(ts, delay), flag, [slot, *by])
    return counted.select(F.col("window.start").alias("window_start"), *by, "events_scored", "threats", "threat_rate")


def stream_histogram(
    events: DataFrame, ts: str, value: str, bounds: Sequence[float], window: str, slide: str, delay: str
) -> DataFrame:
    """Cumulative buckets per sliding window."""
    v = F.col(value)
    wide = (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, window, slide))
        .agg(*bucket_counts(v, bounds), F.count(v).alias("observations"))
    )
    wide = wide.withColumn("window_start", F.col("window.start"))
    return unpivot_buckets(wide, ["window_start", "observations"], bounds)


def stream_quantiles(
    events: DataFrame, ts: str, value: str, window: str, delay: str, by: Sequence[str] = (), error: float = 0.01
) -> DataFrame:
    """Quantile sketch per tumbling window: counts of logarithmic buckets, see ``sketch_quantile``.

    Counts merge by addition, so tasks, batches and restarts merge too. State is a row for each bucket
    that a window has met, a bounded number, and goes when the watermark passes the window.
    """
    slot = F.window(ts, window)
    bucket = sketch_bucket(F.col(value), error).alias("bucket")
    counted = events.withWatermark(ts, delay).where(F.col(value).isNotNull()).groupBy(slot, *by, bucket)
    return counted.agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *by, "bucket", "n")


def stream_dedup(events: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    """First row per key; state is kept only as long as a copy may still arrive."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str, checkpoint: str
) -> StreamingQuery:
    """Process everything available, then stop. ``sink`` must tolerate a repeated batch."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Sink writing each batch to its own folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


@dataclass
class Drained:
    """What a stream wrote, and for every batch the state rows it held, removed and dropped as late."""

    table: DataFrame
    state: list[dict[str, int]] = field(default_factory=list)


def drain(
    stream: DataFrame, purpose: str, mode: str = "append", arrivals: Iterable[object] = (None,), provider: str | None = None
) -> Drained:
    """Run a stream into a table in the shared folder, once for each arrival, from its checkpoint on."""
    spark = stream.sparkSession
    root = scratch_dir(spark, purpose)
    states: list[dict[str, int]] = []
    with state_store(spark, provider):
        for _ in arrivals:
            query = run_available(stream, batch_writer(f"{root}/data"), mode, f"{root}/checkpoint")
            for progress in query.recentProgress:
                for state in progress["stateOperators"]:
                    states.append({k: int(state[k]) for k in ("numRowsTotal", "numRowsRemoved", "numRowsDroppedByWatermark")})
    return Drained(spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{root}/data"), states)


def run_to_table(stream: DataFrame, purpose: str, mode: str = "append", arrivals: Iterable[object] = (None,)) -> DataFrame:
    """Drain a stream into a table in the shared folder and read it back (with its batch number)."""
    return drain(stream, purpose, mode, arrivals).table


def latest_rows(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of an update-mode table: the newest batch wins for every key."""
    rest = [c for c in table.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), F.col("batch")).alias("__row")
    return table.groupBy(*keys).agg(newest).select(*keys, "__row.*")


def quarantine_writer(valid_path: str, rejected_path: str) -> Callable[[DataFrame, int], None]:
    """Sink diverting invalid events to their own table instead of failing the stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("__valid", is_valid_event()).persist()
        try:
            for path, wanted in ((valid_path, True), (rejected_path, False)):
                rows = batch.where(F.col("__valid") == wanted).drop("__valid")
                rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def run_quarantine(
    events: DataFrame, purpose: str = "quarantine", arrivals: Iterable[object] = (None,)
) -> tuple[DataFrame, DataFrame]:
    """Drain a stream of events into a valid and a rejected table."""
    spark = events.sparkSession
    root = scratch_dir(spark, purpose)
    valid, rejected = f"{root}/valid", f"{root}/rejected"
    schema = events.schema
    for _ in arrivals:
        run_available(events, quarantine_writer(valid, rejected), "append", f"{root}/checkpoint")
    return spark.read.schema(schema).parquet(valid), spark.read.schema(schema).parquet(rejected)
