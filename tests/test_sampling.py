import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowsift.functions.draws import draw_key, unit_draw
from flowsift.operators import sampling
from flowsift.operators.joins import attach, salted_join, small_table
from flowsift.operators.ranking import ranked


@pytest.fixture(scope="module")
def skewed(spark):
    """One stratum holds most rows, one is NULL, one has a single row."""
    stratum = F.when(F.col("id") < 4200, "hot").when(F.col("id") < 4950, "warm").when(F.col("id") < 4999, None)
    return spark.range(5000).select("id", stratum.otherwise("lone").alias("s"), (F.col("id") % 7).alias("v"))


def test_ranked_equals_row_number(spark, skewed):
    keyed = skewed.withColumn("k", draw_key(["id"], 1))
    mine = {r["id"]: r["r"] for r in ranked(keyed, ["s"], "k", "r").collect()}
    plain = keyed.withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy("k")))
    assert mine == {r["id"]: r["r"] for r in plain.collect()}


def test_ranked_without_strata(spark, skewed):
    rows = ranked(skewed.withColumn("k", draw_key(["id"], 1)), [], "k", "r", prefix=1).select("r").collect()
    assert sorted(r["r"] for r in rows) == list(range(1, 5001))


@pytest.mark.parametrize("val", [0.1, 0.0])
def test_split_is_exact_per_stratum_and_whole(skewed, val):
    out = sampling.stratified_split(skewed, ["s"], ["id"], 0.2, val, 7)
    assert out.select("id").distinct().count() == out.count() == 5000
    assert out.columns == [*skewed.columns, "split"]
    counts = {(r["s"], r["split"]): r["rows"] for r in sampling.split_counts(out, "s", "split").collect()}
    for s, n in (("hot", 4200), ("warm", 750), (None, 49), ("lone", 1)):
        assert counts.get((s, "test"), 0) == int(n * 0.2 + 0.5)
        assert counts.get((s, "val"), 0) == int(n * val + 0.5)


def test_split_does_not_depend_on_partitions(spark, skewed):
    def split(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            out = sampling.stratified_split(skewed.repartition(parts), ["s"], ["id"], 0.2, 0.1, 7)
            return {r["id"]: r["split"] for r in out.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert split(4) == split(64)


def test_wide_rows_are_not_shuffled_by_the_split(skewed):
    plan = sampling.stratified_split(skewed, ["s"], ["id"], 0.2, 0.1, 7)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in physical and "Exchange hashpartitioning" not in physical


def test_random_split_shares(skewed):
    out = sampling.stratified_split(skewed, None, ["id"], 0.2, 0.1, 7)
    counts = {r["split"]: r["rows"] for r in sampling.split_counts(out, "split").collect()}
    assert abs(counts["test"] / 5000 - 0.2) < 0.03 and abs(counts["val"] / 5000 - 0.1) < 0.03


def test_kfold_is_balanced(skewed):
    rows = sampling.split_counts(sampling.kfold(skewed, "s", ["id"], 5, 3), "s", "fold").collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r["s"], []).append(r["rows"])
    assert sum(sum(v) for v in sizes.values()) == 5000
    assert all(max(v) - min(v) <= 1 for v in sizes.values())


def test_draw_rows_exact_count(skewed):
    drawn = sampling.draw_rows(skewed, ["id"], 1234, 5)
    assert drawn.count() == 1234 and drawn.columns == skewed.columns
    assert drawn.select("id").distinct().count() < 1234


def test_mix_quotas():
    quotas = sampling.mix_quotas({"a": 0.35, "b": 0.25, "c": 0.2, "d": 0.2}, 101)
    assert sum(quotas.values()) == 101 and quotas == {"a": 36, "b": 25, "c": 20, "d": 20}


def test_resample_keeps_all_of_a_scarce_class(skewed):
    out = sampling.resample_to_mix(skewed, "s", {"hot": 0.5, "lone": 0.5}, 100, ["id"], 1)
    counts = {r["s"]: r["rows"] for r in sampling.split_counts(out, "s").collect()}
    assert counts == {"hot": 50, "lone": 1}


def test_corrupt_cells_counts(skewed):
    df = skewed.select("id", F.col("v").cast("double").alias("v"), F.col("v").cast("double").alias("w"))
    bad = sampling.corrupt_cells(df, ["v", "w"], 0.0101, ["id"], 1)
    row = bad.agg(
        F.count_if(F.col("v") == float("inf")), F.count_if(F.isnan("v")), F.count_if(F.isnan("w")), F.count(F.lit(1))
    ).first()
    assert tuple(row) == (25, 25, 25, 5000)
    same = bad.where((F.col("v") == float("inf")) & (F.col("w") == float("inf"))).count()
    assert same < 25


def test_corrupt_cells_rounding_to_nothing(skewed):
    df = skewed.select("id", F.col("v").cast("double").alias("v"))
    assert sampling.corrupt_cells(df, ["v"], 0.0001, ["id"], 1).where(F.isnan("v")).count() == 0


def test_scale_by_class_and_drift(spark):
    df = spark.createDataFrame([("BENIGN", 2.0, 3.0), ("DoS", 2.0, 3.0), ("Other", 2.0, 3.0)], "c string, x double, y double")
    profile = spark.createDataFrame([("BENIGN", "x", 1.0), ("DoS", "x", 4.0)], "class string, feature string, factor double")
    rows = {r["c"]: (r["x"], r["y"]) for r in sampling.scale_by_class(df, "c", profile, drift=2.0).collect()}
    assert rows == {"BENIGN": (2.0, 3.0), "DoS": (16.0, 3.0), "Other": (2.0, 3.0)}


def test_pairing_follows_label(spark):
    flows = spark.range(4000).select("id", (F.col("id") % 4 == 0).cast("int").alias("attack"))
    texts = spark.range(30).select(F.col("id").alias("t"), (F.col("id") < 9).cast("bigint").alias("mal"))
    out = sampling.pair_payloads(flows, ["id"], "attack", texts, ["t"], "mal", 0.7, 0.03, 1)
    assert out.count() == 4000 and out.where("t is null").count() == 0
    rates = {r["attack"]: r["m"] for r in out.groupBy("attack").agg(F.avg("mal").alias("m")).collect()}
    assert abs(rates[1] - 0.7) < 0.06 and abs(rates[0] - 0.03) < 0.02
    assert out.select("t").distinct().count() == 30


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_pools_leave_out_other_labels(spark, partitions):
    flows = spark.range(500).withColumn("attack", (F.col("id") % 2).cast("int"))
    labels = [0] * 5 + [1] * 3 + [2, None] * 20
    texts = spark.createDataFrame([(f"t{i}", m) for i, m in enumerate(labels)], "t string, mal int").repartition(partitions)
    out = sampling.pair_payloads(flows, ["id"], "attack", texts, ["t"], "mal", 0.5, 0.5, 1)
    assert out.count() == 500 and out.where("t IS NULL OR mal NOT IN (0, 1)").count() == 0
    assert out.select("t").distinct().count() == 8
    with pytest.raises(ValueError, match="labelled 1"):
        sampling.pair_payloads(flows, ["id"], "attack", texts.where("mal = 0"), ["t"], "mal", 0.5, 0.5, 1)


def test_unit_draw_range(spark):
    row = spark.range(2000).select(unit_draw(["id"], 1).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] and row[1] < 1 and abs(row[2] - 0.5) < 0.03


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    dim = spark.createDataFrame([("hot", 1), ("lone", 2), ("unused", 3)], "s string, d int")
    def key(df):
        return sorted(df.select("id", "d").collect(), key=str)

    plain = skewed.join(dim, "s", how)
    assert key(salted_join(skewed, dim, ["s"], how)) == key(plain)
    assert key(attach(skewed, dim, ["s"], how)) == key(plain)
    assert key(attach(skewed, dim, ["s"], how, max_rows=1)) == key(plain)


def test_small_table_bounds(spark):
    df = spark.range(50).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert small_table(df).count() == 50
    assert small_table(df, max_rows=49) is None
    assert small_table(df, max_bytes=1000) is None
