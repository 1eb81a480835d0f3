"""Preprocessing as stages of a ``pyspark.ml`` pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.operators.fitting import Preprocessor
from flowsift.schema import quoted

STRATEGIES = ("median", "mean", "most_frequent")
SCALERS = ("standard", "robust", "none")


def _one_of(allowed: Sequence[str]):
    def convert(value: Any) -> str:
        value = TypeConverters.toString(value)
        if value not in allowed:
            raise TypeError(f"{value!r} is none of {', '.join(allowed)}")
        return value

    return convert


class _Settings(HasInputCols, HasOutputCol):
    """Parameters that estimator and model share; a fitted model takes them over."""

    strategy: Param[str] = Param(Params._dummy(), "strategy", "fill of missing cells: median, mean or most_frequent", _one_of(STRATEGIES))
    scaler: Param[str] = Param(Params._dummy(), "scaler", "standard, robust or none", _one_of(SCALERS))
    asFloat: Param[bool] = Param(Params._dummy(), "asFloat", "features as single precision", TypeConverters.toBoolean)

    def __init__(self, *args: Any) -> None:
        super().__init__(*args)
        self._setDefault(strategy="median", scaler="standard", asFloat=True)

    def getStrategy(self) -> str:
        return self.getOrDefault(self.strategy)

    def getScaler(self) -> str:
        return self.getOrDefault(self.scaler)

    def getAsFloat(self) -> bool:
        return self.getOrDefault(self.asFloat)


class FlowPreprocessor(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fits fills and scales of ``inputCols`` on the given rows.

    Non-finite cells count as missing, columns that the rows lack as missing altogether. The fitted
    model keeps every other column. With ``outputCol`` set, it also appends the features as one vector.
    """

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCol: str | None = None,
        strategy: str = "median",
        scaler: str = "standard",
        asFloat: bool = True,
    ) -> None:
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCol: str | None = None,
        strategy: str = "median",
        scaler: str = "standard",
        asFloat: bool = True,
    ) -> FlowPreprocessor:
        return self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FlowPreprocessorModel:
        features = tuple(self.getInputCols())
        fitted = Preprocessor(features, self.getStrategy(), self.getScaler()).fit(dataset)
        model = FlowPreprocessorModel(
            fills=[float(fitted.fills[c]) for c in features],
            centers=[float(fitted.scales[c][0]) for c in features],
            scales=[float(fitted.scales[c][1]) for c in features],
        )
        return self._copyValues(model)


class FlowPreprocessorModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted preprocessing; fill, center and scale of every feature are parameters and are stored as such."""

    fills: Param[list[float]] = Param(Params._dummy(), "fills", "value of missing cells, by feature", TypeConverters.toListFloat)
    centers: Param[list[float]] = Param(Params._dummy(), "centers", "subtracted, by feature", TypeConverters.toListFloat)
    scales: Param[list[float]] = Param(Params._dummy(), "scales", "divisor, by feature", TypeConverters.toListFloat)

    def __init__(
        self, fills: list[float] | None = None, centers: list[float] | None = None, scales: list[float] | None = None
    ) -> None:
        super().__init__()
        self._set(fills=fills, centers=centers, scales=scales)

    @property
    def preprocessor(self) -> Preprocessor:
        """The same parameters as the plain transform has them."""
        features = tuple(self.getInputCols())
        fills, centers, scales = (self.getOrDefault(p) for p in (self.fills, self.centers, self.scales))
        pairs = dict(zip(features, zip(centers, scales, strict=True), strict=True))
        return Preprocessor(features, self.getStrategy(), self.getScaler(), dict(zip(features, fills, strict=True)), pairs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        features = self.getInputCols()
        keep = [c for c in dataset.columns if c not in set(features)]
        out = self.preprocessor.transform(dataset, keep, self.getAsFloat())
        if self.isSet(self.outputCol):
            vector = array_to_vector(F.array(*[F.col(quoted(c)).cast("double") for c in features]))
            out = out.withColumn(self.getOutputCol(), vector)
        return out
