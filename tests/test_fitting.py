import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.operators import fitting
from flowsift.operators.clean import clean_flows, dedup_exact, duplicate_report, inf_to_null
from flowsift.operators.columns import (
    count_nonfinite,
    encode_labels,
    normalise_columns,
    project_canonical,
    reindex,
    require_columns,
    schema_check,
)
from flowsift.sources import tables


@pytest.fixture(scope="module")
def numbers(spark):
    """Heavy ties, a long tail, missing values and an empty column."""
    return spark.range(20000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.pow(F.col("id") % 997, F.lit(2.0)) / 7).alias("a.b"),
        F.when(F.col("id") % 11 != 0, F.sin("id") * 1000).alias("c"),
        F.lit(5.0).alias("flat"),
        F.lit(None).cast("double").alias("empty"),
    )


COLS = ["a.b", "c", "flat", "empty"]


@pytest.mark.parametrize("ordered_values", [2, 50, 10**6])
def test_quantiles_equal_the_built_in_percentile(numbers, ordered_values):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = fitting.column_quantiles(numbers, COLS, probs, ordered_values)
    want = numbers.agg(*[F.percentile(F.col(f"`{c}`"), F.array(*map(F.lit, probs))) for c in COLS]).head()
    for c, w in zip(COLS, want, strict=True):
        assert got[c] == (list(w) if w is not None else [None] * len(probs))


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(x,) for x in (nan, None, -inf, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.7e308, inf, nan)]
    df = spark.createDataFrame(rows, "x double").repartition(3)
    assert fitting.column_quantiles(df, ["x"], [0.0, 0.5, 1.0], 2)["x"] == [-inf, 0.0, inf]
    only_nan = spark.createDataFrame([(nan,), (None,)], "x double")
    assert fitting.column_quantiles(only_nan, ["x"], [1.0])["x"] == [None]
    assert fitting.column_quantiles(df.limit(0), ["x"], [0.5])["x"] == [None]


def test_quantiles_equal_numpy(numbers):
    values = [r["c"] for r in numbers.select("c").collect() if r["c"] is not None]
    got = fitting.column_quantiles(numbers, ["c"], [0.3, 0.5])["c"]
    assert got == pytest.approx(list(np.quantile(values, [0.3, 0.5])))


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (1.0,), (1.0,), (9.0,), (None,)], "x double")
    assert fitting.column_modes(df, ["x"]) == {"x": 1.0}


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0), (6.0, 4.0)], "x double, y double")
    standard = fitting.fit_scaler(df, ["x", "y"], "standard")
    assert standard["x"] == (3.0, pytest.approx(math.sqrt(3.5))) and standard["y"] == (4.0, 1.0)
    robust = fitting.fit_scaler(df, ["x", "y"], "robust")
    assert robust["x"] == (2.5, pytest.approx(2.0)) and robust["y"] == (4.0, 1.0)
    assert fitting.fit_scaler(df, ["x"], "none") == {"x": (0.0, 1.0)}
    with pytest.raises(ValueError):
        fitting.fit_scaler(df, ["x"], "log")
    with pytest.raises(ValueError):
        fitting.fit_imputer(df, ["x"], "zero")


def flows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1.0, inf, "DoS"), (2, nan, 2.0, "BENIGN"), (3, 3.0, -inf, "BENIGN"), (4, 5.0, 6.0, "DoS"), (5, nan, nan, "DoS")]
    return spark.createDataFrame(rows, "id bigint, x double, y double, Label string")


def test_preprocessor_train_and_serve(spark, tmp_path):
    raw = flows(spark)
    pre = fitting.Preprocessor(("x", "y")).fit(raw)
    assert pre.fills == {"x": 3.0, "y": 4.0}
    out = pre.transform(raw, ["id"])
    assert out.count() == 5 and out.columns == ["id", "x", "y"]
    assert dict(out.dtypes)["x"] == "float"
    assert count_nonfinite(out, ["x", "y"]).first()["bad_cells"] == 0
    means = out.agg(F.avg("x"), F.avg("y")).first()
    assert abs(means[0]) < 1e-6 and abs(means[1]) < 1e-6

    path = tables.save_params(pre, spark, str(tmp_path / "params"))
    again = tables.load_params(spark, path)
    assert again == pre
    shuffled = raw.select("Label", "y", "x", "id", F.lit(1).alias("extra"))
    assert sorted(again.transform(shuffled, ["id"]).collect()) == sorted(out.collect())
    without = pre.transform(raw.drop("y"), ["id"]).select("y").distinct().collect()
    assert [r["y"] for r in without] == [0.0]


def test_unfitted_is_refused(spark):
    pre = fitting.Preprocessor(("x",))
    with pytest.raises(RuntimeError):
        pre.transform(flows(spark))
    with pytest.raises(RuntimeError):
        pre.to_table(spark)


def test_version_mismatch(spark):
    table = fitting.Preprocessor(("x",)).fit(flows(spark)).to_table(spark).withColumn("version", F.lit(99))
    with pytest.raises(ValueError, match="99"):
        fitting.Preprocessor.from_table(table)


def test_all_missing_column_is_filled_with_zero(spark):
    df = flows(spark).withColumn("z", F.lit(None).cast("double"))
    out = fitting.Preprocessor(("z", "x")).fit(df).transform(df).select("z").distinct().collect()
    assert [r["z"] for r in out] == [0.0]


def test_cleaning(spark):
    raw = flows(spark).drop("id").unionByName(flows(spark).drop("id"))
    assert inf_to_null(raw, ["x", "y"]).where("y is null").count() == 6
    assert raw.where("y = double('infinity')").count() == 2
    assert clean_flows(raw, ["x", "y"], training=True).count() == 4
    assert clean_flows(raw, ["x", "y"], drop_duplicates=False, training=True).count() == 8
    assert clean_flows(raw, ["x", "y"], training=False).count() == 10
    assert dedup_exact(raw, ["x", "y"]).count() == 5
    report = duplicate_report(inf_to_null(raw, ["x", "y"])).first()
    assert (report["rows"], report["distinct_rows"], report["surplus_rows"]) == (10, 5, 5) and report["has_duplicates"]


def test_cleaning_folds_before_dedup(spark):
    df = spark.createDataFrame([(float("inf"), 1.0, "a"), (float("nan"), 1.0, "a"), (None, 1.0, "b")], "x double, y double, Label string")
    assert clean_flows(df, ["x", "y"]).count() == 2


def test_clean_counts_are_observed(spark):
    from pyspark.sql import Observation

    rows_in, rows_out = Observation("in"), Observation("out")
    raw = flows(spark).drop("id")
    clean_flows(raw.unionByName(raw), ["x", "y"], rows_in=rows_in, rows_out=rows_out).collect()
    assert rows_in.get["rows"] == 10 and rows_out.get["rows"] == 4


def test_columns(spark):
    df = flows(spark).toDF("id", " x", "y ", " label ")
    fixed = normalise_columns(df)
    assert fixed.columns == ["id", "x", "y", "Label"]
    assert project_canonical(fixed, ["y", "x"]).columns == ["y", "x", "Label"]
    with pytest.raises(ValueError, match="2 feature columns"):
        require_columns(fixed, ["x", "q", "r"])
    with pytest.raises(ValueError, match="label"):
        require_columns(fixed.drop("Label"), ["x"])
    assert reindex(fixed, ["z", "x"], ["id"]).columns == ["id", "z", "x"]
    checked = schema_check(fixed.withColumn("y", F.lit("7x")), {"x": "double", "y": "int"}).collect()
    assert [tuple(r) for r in checked] == [("x", 0, 0), ("y", 0, 5)]


def test_encode_labels_lists_unknown(spark):
    df = spark.createDataFrame([("BENIGN",), ("Zeta",), ("Alpha",)], "Label string")
    with pytest.raises(ValueError, match="Alpha.*Zeta"):
        encode_labels(df)


def test_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    rows = {r["y"]: r["weight"] for r in fitting.class_weights(df, "y").collect()}
    assert rows == {0: pytest.approx(4 / 6), 1: 2.0}
    assert fitting.positive_weight(df, "y").first()[0] == 3.0
    assert fitting.positive_weight(df.where("y = 0"), "y").first()[0] == 3.0
    assert fitting.contamination(df, "y").first()[0] == 0.25
    assert fitting.contamination(df.where("y = 0"), "y").first()[0] == 0.001
    assert fitting.contamination(df.where("y = 1"), "y").first()[0] == 0.5
    assert fitting.contamination(df, "y", 0.07).first()[0] == 0.07


def test_minmax_average(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "a double, b double")
    assert [r["average"] for r in fitting.minmax_average(df, ["a", "b"]).orderBy("a").collect()] == [0.0, 0.5]



@pytest.mark.parametrize(
    "name",
    ["fit_impute_median", "apply_impute", "fit_scale_standard", "fit_scale_robust", "fit_scale_robust_wide", "apply_scale", "sink_params"]
    + ["stratified_split3", "resample_to_mix", "corrupt_cells", "scan_split", "split_counts"],
)
def test_flows_are_joined_once(spark, sf, monkeypatch, name):
    """The passes of a fit or a split read what one join wrote."""
    from flowsift.catalog import load
    from flowsift.sources import views

    made = []
    plain = views.flows

    def watched(*args):
        seen = spark.sparkContext.accumulator(0)
        made.append(seen)

        @F.udf("bigint")
        def count(key):
            seen.add(1)
            return key

        return plain(*args).withColumn("k_order", count.asNondeterministic()("k_order"))

    monkeypatch.setattr(views, "flows", watched)
    load()[0][name](spark, sf).collect()
    assert sum(seen.value for seen in made) <= spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_quantiles_of_both_signs_and_ends(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1e3, 4000), rng.normal(0, 1e-300, 50), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]])
    df = spark.createDataFrame([(float(v), None) for v in values] + [(float("nan"), None)], "x double, y double")
    probs = [0.0, 0.01, 0.4999, 0.5, 0.51, 0.99, 1.0]
    got = fitting.column_quantiles(df.repartition(5), ["x", "y"], probs, 3)
    assert np.allclose(got["x"], np.quantile(values, probs), rtol=1e-12, atol=0) and got["y"] == [None] * len(probs)
