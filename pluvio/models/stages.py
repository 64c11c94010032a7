"""The predictors as Spark ML stages (ML5, ML6, ML7).

``TwoStageEstimator`` and ``SingleStageEstimator`` are ``Estimator`` s with
``Params``; their models are ``Model`` s that can be copied with other params,
written and read. So they run inside ``Pipeline``, ``CrossValidator`` and
``TrainValidationSplit``, and a saved pipeline holds them like any stage.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from pluvio.models.two_stage import SingleStageModel, TwoStageConfig, TwoStageModel, fit_single_stage, fit_two_stage


def _param(name: str, doc: str, kind=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Common(HasInputCols, HasLabelCol, HasPredictionCol):
    """Columns in and out; knobs are dicts by their reference names."""

    regParams = _param("regParams", "knobs of the regressor, by name")

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(labelCol="precip_t1", predictionCol="y_hat", regParams={})

    def _set_given(self, given: dict) -> None:
        self._set(**{k: v for k, v in given.items() if v is not None})

    def setParams(self, **given):
        """Set params by name; None leaves one as it is."""
        self._set_given(given)
        return self


class _TwoStageParams(_Common):
    clfParams = _param("clfParams", "knobs of the classifier, by name")
    threshold = _param("threshold", "probability above which an amount is predicted", TypeConverters.toFloat)
    logTarget = _param("logTarget", "fit the regressor on log(1 + y)", TypeConverters.toBoolean)
    clfThr = _param("clfThr", "a label above it is a positive of the classifier", TypeConverters.toFloat)
    regThr = _param("regThr", "a label above it is a row of the regressor", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(clfParams={}, threshold=0.3, logTarget=True, clfThr=0.5, regThr=0.5)

    def config(self) -> TwoStageConfig:
        g = self.getOrDefault
        return TwoStageConfig(features=list(self.getInputCols()), label=self.getLabelCol(), clf_params=dict(g("clfParams")), reg_params=dict(g("regParams")),
                              threshold=g("threshold"), log_target=g("logTarget"), clf_thr=g("clfThr"), reg_thr=g("regThr"))

    def _take(self, cfg: TwoStageConfig) -> None:
        self._set(inputCols=list(cfg.features), labelCol=cfg.label, clfParams=dict(cfg.clf_params), regParams=dict(cfg.reg_params), threshold=cfg.threshold,
                  logTarget=cfg.log_target, clfThr=cfg.clf_thr, regThr=cfg.reg_thr)


class _StageWriter(MLWriter):
    """Params as metadata, each fitted part beside them."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        parts = self.stage._parts()
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"parts": sorted(parts)})
        for name, model in parts.items():
            model.write().overwrite().save(f"{path}/{name}")


class _StageReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind(**{name: PipelineModel.load(f"{path}/{name}") for name in meta["parts"]})
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        return stage


class _FittedStage(Model, MLReadable, MLWritable):
    """Fitted parts by name; ``copy`` keeps them and takes other params."""

    def _parts(self) -> dict[str, PipelineModel]:
        raise NotImplementedError

    def copy(self, extra=None):
        made = type(self)(**self._parts())
        made._resetUid(self.uid)
        return self._copyValues(made, extra)

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader(cls)

    def _named(self, out: DataFrame) -> DataFrame:
        name = self.getPredictionCol()
        return out if name == "y_hat" else out.withColumnRenamed("y_hat", name)


class TwoStagePredictor(_FittedStage, _TwoStageParams):
    """``transform`` adds ``prob``, ``raw``, ``mm`` and the prediction."""

    def __init__(self, clf: PipelineModel | None = None, reg: PipelineModel | None = None):
        super().__init__()
        self.clf, self.reg = clf, reg

    def _parts(self) -> dict[str, PipelineModel]:
        return {n: m for n, m in (("clf", self.clf), ("reg", self.reg)) if m is not None}

    def plain(self) -> TwoStageModel:
        return TwoStageModel(self.config(), self.clf, self.reg)

    @classmethod
    def of(cls, model: TwoStageModel) -> "TwoStagePredictor":
        """A stage of a model that was fitted or loaded as a plain one."""
        made = cls(model.clf, model.reg)
        made._take(model.cfg)
        return made

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._named(self.plain().transform(dataset))

    def predict_proba(self, dataset: DataFrame) -> DataFrame:
        return self.plain().predict_proba(dataset)

    def predict_one(self, spark: SparkSession, row: dict) -> dict:
        return self.plain().predict_one(spark, row)


class TwoStageEstimator(Estimator, _TwoStageParams, DefaultParamsReadable, DefaultParamsWritable):
    """ML7 — classifier and wet-day regressor; see ``TwoStageConfig``."""

    def __init__(self, inputCols=None, labelCol=None, predictionCol=None, clfParams=None, regParams=None, threshold=None, logTarget=None,
                 clfThr=None, regThr=None):
        super().__init__()
        given = dict(inputCols=inputCols, labelCol=labelCol, predictionCol=predictionCol, clfParams=clfParams, regParams=regParams, threshold=threshold,
                     logTarget=logTarget, clfThr=clfThr, regThr=regThr)
        self._set_given(given)

    @classmethod
    def of(cls, cfg: TwoStageConfig) -> "TwoStageEstimator":
        made = cls()
        made._take(cfg)
        return made

    def _fit(self, dataset: DataFrame) -> TwoStagePredictor:
        m = fit_two_stage(dataset, self.config())
        return self._copyValues(TwoStagePredictor(m.clf, m.reg))


class SingleStagePredictor(_FittedStage, _Common):
    """``transform`` adds the prediction, not under 0."""

    def __init__(self, model: PipelineModel | None = None):
        super().__init__()
        self.model = model

    def _parts(self) -> dict[str, PipelineModel]:
        return {"model": self.model}

    def plain(self) -> SingleStageModel:
        return SingleStageModel(self.model, list(self.getInputCols()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._named(self.plain().transform(dataset))

    def predict_one(self, spark: SparkSession, row: dict) -> dict:
        return self.plain().predict_one(spark, row)


class SingleStageEstimator(Estimator, _Common, DefaultParamsReadable, DefaultParamsWritable):
    """ML6 — one regressor of the objective in ``regParams``."""

    def __init__(self, inputCols=None, labelCol=None, predictionCol=None, regParams=None):
        super().__init__()
        self._set_given(dict(inputCols=inputCols, labelCol=labelCol, predictionCol=predictionCol, regParams=regParams))

    def _fit(self, dataset: DataFrame) -> SingleStagePredictor:
        m = fit_single_stage(dataset, list(self.getInputCols()), self.getLabelCol(), dict(self.getOrDefault("regParams")))
        return self._copyValues(SingleStagePredictor(m.model))


__all__ = ["SingleStageEstimator", "SingleStagePredictor", "TwoStageEstimator", "TwoStagePredictor"]
