import datetime as dt
import math
import time

import pytest
from pyspark.sql import functions as F

from flowsift.operators.monitor import event_counters, sketch_bucket, sketch_quantile
from flowsift.sources import views
from flowsift.streaming import events as streams


@pytest.fixture(scope="module")
def arrivals(spark, sf, tmp_path_factory):
    """The events in several files, out of order, with copies in other files."""
    folder = tmp_path_factory.mktemp("arrivals")
    events = views.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = events.unionByName(events.where("event_type = 'error'"))
    twice.withColumn("r", F.md5(F.col("event_id").cast("string"))).repartition(6, "r", "value").drop("r").write.mode(
        "append"
    ).parquet(str(folder))
    return str(folder), twice


def read(spark, arrivals, per_batch=2):
    return streams.read_stream(spark, arrivals[0], arrivals[1].schema, files_per_batch=per_batch)


def test_counters_over_batches_equal_batch(spark, arrivals):
    flag = F.col("value") > 50
    counted = streams.stream_counters(read(spark, arrivals), "ts", flag, "6 hours", "60 days", ["event_type"])
    table = streams.run_to_table(counted, "t", "update")
    assert table.select("batch").distinct().count() > 1
    got = streams.latest_rows(table, ["window_start", "event_type"]).select(
        "window_start", "event_type", "events_scored", "threats"
    )
    slot = F.window("ts", "6 hours")
    want = event_counters(arrivals[1], flag, [slot, "event_type"]).select(
        F.col("window.start").alias("window_start"), "event_type", "events_scored", "threats"
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_dedup_over_batches(spark, arrivals):
    once = streams.run_to_table(streams.stream_dedup(read(spark, arrivals), "ts", ["event_id"], "60 days"), "t")
    assert once.count() == once.select("event_id").distinct().count() == arrivals[1].select("event_id").distinct().count()


def test_late_rows_are_left_out(spark, tmp_path):
    """The first batches move the watermark past the window of the third."""
    start = dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "late")
    schema = "ts timestamp, v double"
    for hours in (48, 49, 0):
        spark.createDataFrame([(start + dt.timedelta(hours=hours), 1.0)], schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    stream = streams.read_stream(spark, folder, spark.read.parquet(folder).schema, files_per_batch=1)
    counted = streams.stream_counters(stream, "ts", F.col("v") > 0, "1 hour", "1 hour")
    rows = streams.run_to_table(counted, "t", "update").collect()
    assert sorted(r["window_start"] for r in rows) == [start + dt.timedelta(hours=h) for h in (48, 49)]


def test_quarantine_keeps_every_event(spark, sf, tmp_path):
    folder = str(tmp_path / "in")
    events = views.events_in(spark, sf)
    events.repartition(3).write.parquet(folder)
    valid, rejected = streams.run_quarantine(streams.read_stream(spark, folder, events.schema, files_per_batch=1))
    assert valid.count() + rejected.count() == events.count()
    assert rejected.where("payload is not null or size(features) > 0").count() == 0
    assert valid.where("payload is null and (features is null or size(features) = 0)").count() == 0


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = streams.batch_writer(str(tmp_path / "out"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_arrivals_come_in_order_and_whole(spark, sf, tmp_path):
    events = views.table(spark, sf, "events").select("event_id", "ts")
    feed = streams.Arrivals(events.unionByName(spark.createDataFrame([(-1, None)], events.schema)), "ts", 3, str(tmp_path / "in"))
    before, ids = None, []
    for i in feed:
        part = spark.read.parquet(f"{feed.folder}/part-{i}")
        low, high = part.agg(F.min("ts"), F.max("ts")).first()
        assert before is None or before < low
        before = high
        ids += [r["event_id"] for r in part.collect()]
    assert sorted(ids) == sorted([-1, *(r["event_id"] for r in events.collect())])


def test_keys_are_evicted_from_a_store_on_disk(spark, tmp_path):
    """One key an hour for 40 days: the state holds the keys of the delay and of one arrival, not all."""
    rows = spark.range(40 * 24).select("id", F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000).alias("ts"))
    feed = streams.Arrivals(rows, "ts", 8, str(tmp_path / "in"))
    before = spark.conf.get(streams.STORE_CLASS)
    drained = streams.drain(streams.stream_dedup(feed.stream(), "ts", ["id"], "1 day"), "t", arrivals=feed, provider=streams.ROCKSDB)
    assert spark.conf.get(streams.STORE_CLASS) == before
    assert drained.table.count() == 40 * 24
    held = [s["numRowsTotal"] for s in drained.state]
    assert sum(s["numRowsRemoved"] for s in drained.state) >= 30 * 24
    assert max(held) <= (5 + 2) * 24 + 2


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_sketch_is_within_its_error(spark, error):
    rows = spark.range(20_000).select(
        (F.col("id") % 3).alias("g"), (F.exp((F.xxhash64("id") % 1000) / 100.0) * F.when(F.col("id") % 7 == 0, -1).otherwise(1)).alias("v")
    ).unionByName(spark.createDataFrame([(0, 0.0)] * 50 + [(5, 0.0), (6, 1e300), (7, 1e-9)], "g bigint, v double"))
    counts = rows.groupBy("g", sketch_bucket(F.col("v"), error).alias("bucket")).agg(F.count("*").alias("n"))
    merged = counts.withColumn("n", F.col("n") - 1).unionByName(counts.withColumn("n", F.lit(1).cast("bigint")))
    for q in (0.0, 0.01, 0.5, 0.99, 1.0):
        got = {r["g"]: (r["n"], r["value"]) for r in sketch_quantile(merged, ["g"], q, error).collect()}
        for g in (0, 1, 2, 5, 6, 7):
            values = sorted(r["v"] for r in rows.where(F.col("g") == g).collect())
            exact = values[max(1, math.ceil(q * len(values))) - 1]
            assert got[g][0] == len(values)
            assert abs(got[g][1] - exact) <= error * abs(exact) + 1e-9


def test_streamed_quantiles_equal_batch(spark, arrivals):
    sketch = streams.stream_quantiles(read(spark, arrivals), "ts", "value", "1 day", "60 days", ["event_type"])
    table = streams.run_to_table(sketch, "t", "update")
    keys = ["window_start", "event_type"]
    got = sketch_quantile(streams.latest_rows(table, [*keys, "bucket"]), keys, 0.99, 0.01)
    slot = F.window("ts", "1 day")["start"].alias("window_start")
    exact = arrivals[1].groupBy(slot, "event_type").agg(F.array_sort(F.collect_list("value")).alias("vs"))
    exact = exact.withColumn("exact", F.get("vs", F.ceil(F.size("vs") * 0.99).cast("int") - 1))
    both = got.join(exact, keys, "full")
    assert both.count() > 50
    assert both.where("value IS NULL OR exact IS NULL OR abs(value - exact) > 0.01 * exact + 1e-9").count() == 0


def test_latency_without_a_duration_is_not_counted(spark, tmp_path):
    """Zero and negative values are in no bucket of the SQL; a day of nothing else has no row."""
    import duckdb

    from flowsift.catalog import load

    queries, oracles = load()
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(hours=i % 30), "view", v) for i, v in enumerate([0.0, -2.0, 1e-12, 3.0, 250.0] * 12)]
    rows += [(100, day + dt.timedelta(days=5), "click", 0.0), (101, day + dt.timedelta(days=5), "view", 7.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet")
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = con.execute(oracles["stream_latency_p99"]).fetchall()
    assert sorted(map(tuple, queries["stream_latency_p99"](spark, str(tmp_path)).collect())) == sorted(want)
