"""The contract every model keeps, and the MLlib-backed half of it."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpointed


class Fitted(ABC):
    """A trained model: adds a prediction column to any table with its features."""

    features: list[str]

    @abstractmethod
    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame: ...

    @abstractmethod
    def save(self, path: str) -> None: ...

    def importance(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError(f"{type(self).__name__} has no feature importance")


class Model(ABC):
    # Parameters that were given and have no effect here.
    unused: Sequence[str] = ()
    # Whether a fit reads its rows many times.
    iterative: bool = True

    @abstractmethod
    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> Fitted: ...

    @classmethod
    @abstractmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted: ...


_VECTOR = "_features"
_PREDICTION = "_prediction"


class FittedPipeline(Fitted):
    """Assembler + MLlib model.  `raw` keeps extra output columns such as probability."""

    def __init__(self, pipeline: PipelineModel):
        self.pipeline = pipeline
        assembler = next(s for s in pipeline.stages if isinstance(s, VectorAssembler))
        self.features = list(assembler.getInputCols())

    @property
    def model(self):
        return self.pipeline.stages[-1]

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        kept = [c for c in df.columns if c != output]
        return self.raw(df).select(*kept, F.col(_PREDICTION).alias(output))

    def raw(self, df: DataFrame) -> DataFrame:
        """All columns the MLlib model adds."""
        return self.pipeline.transform(df)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    def importance(self, spark: SparkSession) -> DataFrame:
        model = self.model
        if hasattr(model, "featureImportances"):
            scores = model.featureImportances.toArray()
        elif hasattr(model, "coefficients"):
            scores = abs(model.coefficients.toArray())
        else:
            return super().importance(spark)
        rows = [(f, float(s)) for f, s in zip(self.features, scores)]
        return spark.createDataFrame(rows, "feature string, score double").orderBy(F.desc("score"), "feature")


class MLlibModel(Model):
    """Any MLlib estimator; `build` gets the label and weight column names."""

    def __init__(self, build: Callable[[], Estimator], unused: Sequence[str] = ()):
        self.build, self.unused = build, unused

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "target", weight: str | None = None) -> FittedPipeline:
        estimator = self.build()
        settings: dict[str, Any] = {"featuresCol": _VECTOR, "labelCol": "_label", "predictionCol": _PREDICTION}
        if weight is not None:
            settings["weightCol"] = weight
        estimator.setParams(**settings)
        assembler = VectorAssembler(inputCols=list(features), outputCol=_VECTOR)
        table = df.select(
            *features, F.col(label).cast("double").alias("_label"), *([F.col(weight).alias(weight)] if weight else [])
        )
        if estimator.hasParam("checkpointInterval"):
            checkpointed(df.sparkSession)
        return FittedPipeline(Pipeline(stages=[assembler, estimator]).fit(table))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedPipeline:
        return FittedPipeline(PipelineModel.load(path))
