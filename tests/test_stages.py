import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import functions as F

from flowsift.models.stages import FlowPreprocessor, FlowPreprocessorModel
from flowsift.operators.fitting import Preprocessor


@pytest.fixture(scope="module")
def flows(spark):
    rows = [(i, float(i % 7), None if i % 5 == 0 else i * 0.5, math.inf if i % 11 == 0 else float(-i), int(i % 3 == 0), f"r{i}") for i in range(200)]
    return spark.createDataFrame(rows, "id long, `a.b` double, x double, y double, label int, note string").cache()


@pytest.mark.parametrize("strategy, scaler", [("median", "standard"), ("mean", "robust"), ("most_frequent", "none")])
def test_stage_equals_plain_transform(flows, strategy, scaler):
    features = ["a.b", "x", "y", "absent"]
    model = FlowPreprocessor(inputCols=features, strategy=strategy, scaler=scaler, asFloat=False).fit(flows)
    plain = Preprocessor(tuple(features), strategy, scaler).fit(flows)
    got, want = model.transform(flows), plain.transform(flows, ["id", "label", "note"], as_float=False)
    assert got.columns == want.columns
    assert got.orderBy("id").collect() == want.orderBy("id").collect()
    assert model.preprocessor == plain


def test_pipeline_is_stored_and_loaded(flows, tmp_path):
    stage = FlowPreprocessor(inputCols=["x", "y"], outputCol="vector")
    pipeline = Pipeline(stages=[stage, LogisticRegression(featuresCol="vector", labelCol="label", maxIter=5)])
    pipeline.write().save(f"{tmp_path}/pipeline")
    fitted = Pipeline.load(f"{tmp_path}/pipeline").fit(flows)
    fitted.write().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    assert [type(s) for s in loaded.stages] == [FlowPreprocessorModel, LogisticRegressionModel]
    assert loaded.stages[0].getOrDefault("fills") == fitted.stages[0].getOrDefault("fills")
    columns = ["id", "x", "y", "vector", "prediction"]
    assert loaded.transform(flows).select(columns).collect() == fitted.transform(flows).select(columns).collect()


def test_parameters_are_checked_copied_and_overridden(flows):
    stage = FlowPreprocessor(inputCols=["x"])
    assert (stage.getStrategy(), stage.getScaler(), stage.getAsFloat()) == ("median", "standard", True)
    with pytest.raises(TypeError, match="none of"):
        FlowPreprocessor(inputCols=["x"], scaler="wide")
    copied = stage.copy({stage.strategy: "mean"})
    assert (copied.getStrategy(), stage.getStrategy()) == ("mean", "median")
    by_mean = stage.fit(flows, {stage.strategy: "mean"})
    exact = flows.agg(F.avg("x")).first()[0]
    assert by_mean.getOrDefault("fills") == [pytest.approx(exact)]
    assert by_mean.getStrategy() == "mean"


def test_new_rows_with_missing_columns(spark, flows):
    model = FlowPreprocessor(inputCols=["x", "y"], outputCol="v").fit(flows)
    fresh = spark.createDataFrame([(1, "k")], "y int, other string")
    row = model.transform(fresh).first()
    assert row["other"] == "k" and all(math.isfinite(c) for c in row["v"])
    assert dict(model.transform(fresh).dtypes)["x"] == "float"
    assert model.transform(flows.limit(0)).count() == 0
