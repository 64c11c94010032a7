"""Single-stage and two-stage (hurdle) predictors on Spark MLlib (ML5-ML8).

Two-stage: a classifier learns "does it happen" (``y > clf_thr``) with
class weights ``n_neg/n_pos`` for the positives; a regressor learns "how
much" on the rows with ``y > reg_thr`` (``log1p`` target when ``log_target``).
Prediction = ``prob > threshold ? prob · max(expm1(raw), 0) : 0``.

One *global* model is trained over all series (series attributes can be
features), so training is a distributed MLlib fit — never a per-series loop
on the driver.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field
from typing import ClassVar

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.operators.models import hurdle, magnitude

# Gradient-boosting knob names of the reference → MLlib GBT parameters.
KNOBS = {
    "n_estimators": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth",
    "min_child_samples": "minInstancesPerNode", "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy", "random_state": "seed", "max_bins": "maxBins",
}
# Knobs about logging and threads, not about the fit.
QUIET = {"verbose", "n_jobs"}
# Knobs that weigh the classes (see ``positive_weight``) and that choose the
# regressor (see ``regressor``); handled there, not by the tree parameters.
WEIGHT_KNOBS = {"scale_pos_weight", "is_unbalance", "class_weight"}
OBJECTIVE_KNOBS = {"objective", "alpha", "tweedie_variance_power"}


def gbt_params(params: dict, handled: set[str] = frozenset()) -> dict:
    """Translate reference-style knobs to MLlib. A knob without a counterpart
    raises; none is ignored. ``num_leaves`` bounds the depth: a tree of depth
    d has at most 2^d leaves, so the depth is at most ceil(log2(leaves)).
    ``boosting_type`` must be the plain one."""
    out = {}
    for k, v in (params or {}).items():
        if k in QUIET or k in handled:
            continue
        if k == "boosting_type" and v == "gbdt":
            continue
        if k == "num_leaves":
            depth = max(1, math.ceil(math.log2(int(v))))
            out["maxDepth"] = min(depth, out.get("maxDepth", depth), int(params.get("max_depth", depth)))
            continue
        if k == "max_depth" and "num_leaves" in params:
            out["maxDepth"] = min(int(v), out.get("maxDepth", int(v)))
            continue
        if k in KNOBS:
            name = KNOBS[k]
            if name == "featureSubsetStrategy":
                v = str(float(v))
            elif name in ("maxIter", "maxDepth", "minInstancesPerNode", "seed", "maxBins"):
                v = int(v)
            else:
                v = float(v)
            out[name] = v
        else:
            raise ValueError(f"parameter {k!r} (= {v!r}) has no MLlib counterpart")
    out.setdefault("seed", 42)
    return out


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def assembled(df: DataFrame, features: list[str], *keep: str) -> DataFrame:
    """Only the ``keep`` columns and the model's inputs as one vector, which
    fits and scoring then take as it is."""
    return _assembler(features).transform(df).select(*keep, "features")


def _pipeline(df: DataFrame, features: list[str], estimator) -> Pipeline:
    return Pipeline(stages=[estimator] if "features" in df.columns else [_assembler(features), estimator])


def _one_row(spark: SparkSession, row: dict, features: list[str]) -> DataFrame:
    return spark.createDataFrame([tuple(float(row[c]) for c in features)], ", ".join(f"`{c}` double" for c in features))


@dataclass
class TwoStageConfig:
    features: list[str]
    label: str = "precip_t1"
    clf_params: dict = field(default_factory=dict)
    reg_params: dict = field(default_factory=dict)
    threshold: float = 0.3
    log_target: bool = True
    clf_thr: float = 0.5
    reg_thr: float = 0.5
    # Estimators that grow the trees; no part of what is saved or hashed.
    gbt_classifier: ClassVar[type] = GBTClassifier
    gbt_regressor: ClassVar[type] = GBTRegressor

    def gathered(self, df: DataFrame) -> DataFrame:
        """Rows that are counted or scored, laid out as the fits need them."""
        return df


class TwoStageModel:
    """Fitted two-stage model: ``transform`` adds ``prob``, ``raw``, ``mm``, ``y_hat``."""

    def __init__(self, cfg: TwoStageConfig, clf: PipelineModel, reg: PipelineModel | None):
        self.cfg, self.clf, self.reg = cfg, clf, reg

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """ML8 — probability of the positive class."""
        out = self.clf.transform(df)
        return out.withColumn("prob", vector_to_array("probability")[1]).drop(
            *self._made(df), "rawPrediction", "probability", "prediction")

    @staticmethod
    def _made(df: DataFrame) -> list[str]:
        """The vector column, unless the rows came with it."""
        return [] if "features" in df.columns else ["features"]

    def transform(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """ML8 — prob, magnitude and hurdle combination in one pass."""
        thr = self.cfg.threshold if threshold is None else threshold
        d = self.predict_proba(df)
        if self.reg is None:  # no wet rows at fit time: magnitude 0
            d = d.withColumn("raw", F.lit(0.0))
        else:
            d = self.reg.transform(d).withColumnRenamed("prediction", "raw").drop(*self._made(df))
        d = d.withColumn("mm", magnitude(F.col("raw"), self.cfg.log_target))
        return d.withColumn("y_hat", hurdle(F.col("prob"), F.col("mm"), thr))

    def save(self, path: str) -> None:
        """SNK7 — both pipelines plus the config as JSON."""
        self.clf.write().overwrite().save(f"{path}/clf")
        if self.reg is not None:
            self.reg.write().overwrite().save(f"{path}/reg")
        spark = SparkSession.getActiveSession()
        saved = {"config": asdict(self.cfg), "has_regressor": self.reg is not None}
        spark.createDataFrame([(json.dumps(saved),)], "cfg string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/config")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TwoStageModel":
        """SRC7 — read a saved model back. Only a model saved without a
        regressor loads without one; a missing or broken part is an error."""
        saved = json.loads(spark.read.text(f"{path}/config").first()[0])
        reg = PipelineModel.load(f"{path}/reg") if saved["has_regressor"] else None
        return cls(TwoStageConfig(**saved["config"]), PipelineModel.load(f"{path}/clf"), reg)

    def predict_one(self, spark: SparkSession, row: dict) -> dict:
        """ML6/ML8 — prob, mm and y_hat of one feature row."""
        return self.transform(_one_row(spark, row, self.cfg.features)).select("prob", "mm", "y_hat").first().asDict()


def class_weight(df: DataFrame, label: str, thr: float) -> float:
    """AGG15 — n_neg / n_pos (balanced classes), one aggregate action."""
    r = df.agg(F.count_if(F.col(label) > thr).alias("p"), F.count_if(~(F.col(label) > thr)).alias("n")).first()
    return (r["n"] / r["p"]) if r["p"] else 1.0


def balanced(p: dict) -> bool:
    """Do the classes of the training rows decide the weight?"""
    return p.get("scale_pos_weight") is None and (p.get("is_unbalance", True) is not False or p.get("class_weight") == "balanced")


def positive_weight(df: DataFrame, cfg: TwoStageConfig) -> float:
    """Weight of the positive rows: ``scale_pos_weight`` if given, 1 if
    balancing is switched off, else ``n_neg / n_pos``."""
    p = cfg.clf_params or {}
    if p.get("class_weight", "balanced") not in ("balanced", None):
        raise ValueError(f"class_weight {p['class_weight']!r} has no MLlib counterpart")
    if p.get("scale_pos_weight") is not None:
        return float(p["scale_pos_weight"])
    if not balanced(p):
        return 1.0
    return class_weight(cfg.gathered(df), cfg.label, cfg.clf_thr)


def fit_classifier(df: DataFrame, cfg: TwoStageConfig) -> PipelineModel:
    """ML7 stage 1 — GBT classifier on ``y > clf_thr`` with weighted positives."""
    w = positive_weight(df, cfg)
    lab = (F.col(cfg.label) > cfg.clf_thr).cast("double")
    d = df.withColumns({"_cls": lab, "_w": F.when(lab == 1.0, F.lit(w)).otherwise(F.lit(1.0))})
    return _pipeline(df, cfg.features, cfg.gbt_classifier(
        labelCol="_cls", weightCol="_w", featuresCol="features", **gbt_params(cfg.clf_params, WEIGHT_KNOBS))).fit(d)


def regressor(params: dict, label: str, gbt: type = GBTRegressor):
    """ML6 — the estimator of an ``objective``: squared or absolute loss are
    boosted trees, huber and tweedie are MLlib's linear estimators for them;
    any other objective (quantiles, say) raises. The linear ones take no tree
    knobs: only ``n_estimators`` maps, to their iterations."""
    p = dict(params or {})
    objective = p.get("objective", "regression")
    common = dict(labelCol=label, featuresCol="features")
    if objective in ("regression", "regression_l2", "l2", "mse", "regression_l1", "l1", "mae"):
        loss = "absolute" if objective in ("regression_l1", "l1", "mae") else "squared"
        return gbt(lossType=loss, **common, **gbt_params(p, {"objective"}))
    p = {k: v for k, v in p.items() if k not in QUIET}
    extra = set(p) - {"objective", "alpha", "tweedie_variance_power", "n_estimators", "random_state"}
    if objective not in ("huber", "tweedie") or extra:
        raise ValueError(f"objective {objective!r} with {sorted(extra)} has no MLlib counterpart")
    n = {"maxIter": int(p["n_estimators"])} if "n_estimators" in p else {}
    if objective == "huber":
        return LinearRegression(loss="huber", epsilon=float(p.get("alpha", 1.35)), **common, **n)
    return GeneralizedLinearRegression(family="tweedie", variancePower=float(p.get("tweedie_variance_power", 1.5)), linkPower=0.0, **common, **n)


def fit_regressor(df: DataFrame, cfg: TwoStageConfig) -> PipelineModel | None:
    """ML7 stage 2 — GBT regressor on the wet rows (``log1p`` target when
    ``log_target``); ``None`` when there is no wet row."""
    wet = df.filter(F.col(cfg.label) > cfg.reg_thr)
    if not cfg.gathered(wet).limit(1).count():
        return None
    tgt = F.log1p(cfg.label) if cfg.log_target else F.col(cfg.label)
    return _pipeline(df, cfg.features, regressor(cfg.reg_params, "_t", cfg.gbt_regressor)).fit(wet.withColumn("_t", tgt))


def fit_two_stage(df: DataFrame, cfg: TwoStageConfig, clf: PipelineModel | None = None) -> TwoStageModel:
    """ML7 — classifier (or a given fitted one) then regressor on wet rows."""
    return TwoStageModel(cfg, clf or fit_classifier(df, cfg), fit_regressor(df, cfg))


class SingleStageModel:
    """ML6 — one regressor, output clipped at 0."""

    def __init__(self, model: PipelineModel, features: list[str]):
        self.model, self.features = model, features

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df).drop("features")
        return out.withColumn("y_hat", magnitude(F.col("prediction"), log_target=False)).drop("prediction")

    def predict_one(self, spark: SparkSession, row: dict) -> dict:
        """ML6 — y_hat of one feature row."""
        return self.transform(_one_row(spark, row, self.features)).select("y_hat").first().asDict()

    def save(self, path: str) -> None:
        """The pipeline, and the feature names as JSON."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(self.features),)], "features string").coalesce(1).write.mode("overwrite").text(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SingleStageModel":
        return cls(PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/features").first()[0]))


def fit_single_stage(df: DataFrame, features: list[str], label: str, params: dict | None = None) -> SingleStageModel:
    """ML6 — ``Pipeline(VectorAssembler, regressor of the objective)``."""
    p = Pipeline(stages=[_assembler(features), regressor(params or {}, label)])
    return SingleStageModel(p.fit(df), features)
