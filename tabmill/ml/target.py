"""Fit on a transformed label, predict in its original unit."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.pipeline import PipelineModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.targets import LOG_TARGET, RAW_TARGET, TargetTransform

TARGETS: dict[str, TargetTransform] = {"log": LOG_TARGET, "raw": RAW_TARGET}
FITTED_LABEL = "_label"


class _TargetParams(Params):
    target = Param(Params._dummy(), "target", "log or raw", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label in original units", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)


class TransformedTarget(Estimator, _TargetParams):
    """Wraps an estimator that reads its label from ``FITTED_LABEL``."""

    def __init__(self, estimator: Estimator, labelCol: str, target: str = "raw", predictionCol: str = "prediction"):
        super().__init__()
        if target not in TARGETS:
            raise ValueError(f"unknown target {target!r}")
        self.estimator = estimator
        self._set(target=target, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, df: DataFrame) -> "TransformedTargetModel":
        label = F.col(self.getOrDefault(self.labelCol)).cast("double")
        forward = TARGETS[self.getOrDefault(self.target)].forward
        fitted = self.estimator.fit(df.withColumn(FITTED_LABEL, forward(label)))
        return self._copyValues(TransformedTargetModel(fitted))


class TransformedTargetModel(Model, _TargetParams, MLWritable, MLReadable):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.predictionCol)
        inverse = TARGETS[self.getOrDefault(self.target)].inverse
        return self.model.transform(df).withColumn(name, inverse(F.col(name)))

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.model.write().overwrite().save(f"{path}/model")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(PipelineModel.load(f"{path}/model"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
