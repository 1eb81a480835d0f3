"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.draws import unit_draw
from flowsift.session import stage

#: Quality levels that shape the key ranges of one source; they affect the balance only.
LEVELS = 8
#: Documents in one key range, which one task sorts.
RANGE_ROWS = 4096


def source_targets(sized: DataFrame, weights: Sequence[float], budget: float, cap: float) -> DataFrame:
    """Words wanted of each source: ``source, source_size, target`` and the counts of documents.

    Sources by code point, NULL last, take the weights in turn and share ``budget`` times all words.
    A target stops at ``cap`` times its source; what is left over is shared again by weight. The
    stopped sources are those of smallest cap per weight, so one ordered pass over the sources
    finds the level of the others.
    """
    level = F.least(F.ceil(F.col("weight") * LEVELS), F.lit(LEVELS))
    shares = [F.count_if(level == i + 1).alias(f"level_{i}") for i in range(LEVELS)]
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"), *shares)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    per_source = per_source.withColumn("share", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1))
    per_source = per_source.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("most") / F.col("share"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level_here = left / F.sum("share").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    wanted = per_source.withColumn("level", level_here)
    wanted = wanted.withColumn("stopped", F.col("most") / F.col("share") <= F.col("level"))
    shared = F.max(F.when(~F.col("stopped"), F.col("level"))).over(everything)
    target = F.when(F.col("stopped"), F.col("most")).otherwise(F.least(shared * F.col("share"), F.col("most")))
    return wanted.select("source", "source_size", target.alias("target"), "docs", *[f"level_{i}" for i in range(LEVELS)])


def mix_sources(
    docs: DataFrame,
    size: Column,
    quality: Column,
    weights: Sequence[float] = (3, 1, 2),
    budget: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Words each document gives to the mix: ``doc_id, source, size, source_size, target, taken``.

    Every whole multiple of a source that fits its target is a complete epoch, taken from all its
    documents. The rest of the target is filled by documents in order of their exponential key
    ``-ln(u) / quality``; the last one gives as many words as are missing, so that a source's words
    equal its target rounded to a word. ``u`` is a hash of the document id: reruns agree.

    ``quality`` is clipped to (0, 1], NULL counts as the middle. A NULL or empty text has size 0 and
    gives 0. NULL is a source of its own. Rows that repeat an id are separate documents with one
    key. An empty table gives no rows; other columns of ``docs`` are not read.

    Ranges of keys split a source, so no task holds a whole source; each range is one sort.
    """
    quality = F.greatest(F.least(F.coalesce(quality.cast("double"), F.lit(0.5)), F.lit(1.0)), F.lit(0.01))
    sized = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.cast("bigint").alias("size"), quality.alias("weight")
        ),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, budget, cap)
    drawn = unit_draw([F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))], seed)
    # 1 - u lies in (0, 1]
    keyed = sized.withColumn("key", -F.log(F.lit(1.0) - drawn) / F.col("weight"))
    rows = keyed.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("d.*", "t.source_size", "t.target", "t.docs", *[f"t.level_{i}" for i in range(LEVELS)])
    # share of the source's documents that have a smaller key, by the levels of their weights
    smaller = sum(
        (F.col(f"level_{i}") * (1 - F.exp(-F.col("key") * ((i + 0.5) / LEVELS))) for i in range(LEVELS)), F.lit(0.0)
    ) / F.col("docs")
    ranges = F.ceil(F.col("docs") / RANGE_ROWS)
    rows = rows.withColumn("range", F.least(F.floor(smaller * ranges), ranges - 1)).drop("docs", *[f"level_{i}" for i in range(LEVELS)])
    per_range = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select("source", "range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start"))
    rows = rows.alias("r").join(
        starts.alias("s"),
        F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.range") == F.col("s.range")),
    ).select("r.*", "s.range_start")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    rest = F.floor(F.col("target") - epochs * F.col("source_size") + 0.5)
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    taken = (epochs * F.col("size") + part).cast("bigint")
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
