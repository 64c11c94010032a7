"""The predictors as Spark ML stages."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from pluvio.models.stages import SingleStageEstimator, SingleStagePredictor, TwoStageEstimator, TwoStagePredictor
from pluvio.models.two_stage import SingleStageModel, fit_single_stage, fit_two_stage
from pluvio.plans import q_models as qm
from pluvio.session import scratch_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def clean(spark):
    c = qm._clean(spark, SF001)
    return c, qm._cfg(c)


def values(df, column="y_hat"):
    return [r[0] for r in df.orderBy("series", "fecha").select(column).collect()]


def test_estimator_equals_plain_fit(spark, clean):
    c, cfg = clean
    stage = TwoStageEstimator.of(cfg).fit(c)
    plain = fit_two_stage(c, cfg)
    assert values(stage.transform(c)) == values(plain.transform(c))
    row = c.first().asDict()
    assert stage.predict_one(spark, row) == plain.predict_one(spark, row)
    assert values(TwoStagePredictor.of(plain).transform(c)) == values(plain.transform(c))


def test_copy_takes_other_params(spark, clean):
    c, cfg = clean
    m = TwoStageEstimator.of(cfg).fit(c)
    other = m.copy({m.threshold: 0.99, m.predictionCol: "amount"})
    assert m.getOrDefault("threshold") == cfg.threshold and other.getOrDefault("threshold") == 0.99 and other.uid == m.uid
    a, b = values(m.transform(c)), values(other.transform(c), "amount")
    assert sum(x > 0 for x in b) < sum(x > 0 for x in a) and values(m.transform(c, {m.threshold: 0.99})) == b
    est = TwoStageEstimator.of(cfg)
    assert est.copy({est.threshold: 0.9}).fit(c).getOrDefault("threshold") == 0.9 and est.getOrDefault("threshold") == cfg.threshold
    assert est.setParams(threshold=0.4, labelCol=None).getOrDefault("threshold") == 0.4 and est.getLabelCol() == cfg.label


def test_pipeline_saved_and_loaded(spark, clean):
    c, cfg = clean
    path = scratch_path(spark, "stages")
    fitted = Pipeline(stages=[TwoStageEstimator.of(cfg)]).fit(c)
    fitted.write().save(f"{path}/fitted")
    back = PipelineModel.load(f"{path}/fitted")
    assert values(back.transform(c)) == values(fitted.transform(c)) and back.stages[0].config() == cfg
    Pipeline(stages=[TwoStageEstimator.of(cfg)]).write().save(f"{path}/plan")
    assert Pipeline.load(f"{path}/plan").getStages()[0].config() == cfg
    dry = fit_two_stage(c.withColumn(cfg.label, F.lit(0.0)).unionByName(c.limit(30).withColumn(cfg.label, F.lit(1.0))), cfg)
    stage = TwoStagePredictor.of(dry)  # no regressor
    stage.write().save(f"{path}/dry")
    assert dry.reg is None and TwoStagePredictor.load(f"{path}/dry").reg is None and set(values(stage.transform(c))) == {0.0}


def test_cross_validator_chooses_a_threshold(spark, clean):
    c, cfg = clean
    est = TwoStageEstimator.of(cfg)
    rmse = RegressionEvaluator(labelCol=cfg.label, predictionCol="y_hat")
    grid = ParamGridBuilder().addGrid(est.threshold, [0.2, 1.1]).build()  # 1.1: nothing is ever predicted
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=rmse, numFolds=2, seed=1).fit(c)
    assert len(cv.avgMetrics) == 2 and cv.avgMetrics[0] != cv.avgMetrics[1]
    assert cv.bestModel.getOrDefault("threshold") == [0.2, 1.1][cv.avgMetrics.index(min(cv.avgMetrics))]


def test_single_stage(spark, clean):
    c, cfg = clean
    path, row = scratch_path(spark, "single"), c.first().asDict()
    plain = fit_single_stage(c, cfg.features, cfg.label, qm.SMALL)
    plain.save(f"{path}/plain")
    again = SingleStageModel.load(spark, f"{path}/plain")
    stage = SingleStageEstimator(inputCols=cfg.features, labelCol=cfg.label, regParams=qm.SMALL).fit(c)
    stage.write().save(f"{path}/stage")
    loaded = SingleStagePredictor.load(f"{path}/stage")
    want = values(plain.transform(c))
    assert min(want) >= 0 and all(values(m.transform(c)) == want for m in (again, stage, loaded))
    one = plain.predict_one(spark, row)
    assert one == again.predict_one(spark, row) == loaded.predict_one(spark, row) and one["y_hat"] in want


def test_cross_validator_query_gives_its_rows(spark):
    """The metrics come as numpy numbers, which a row of doubles does not take."""
    rows = qm.q_two_stage_cross_validator(spark, SF001).collect()
    assert [r.threshold for r in rows] == [0.3, 0.5, 0.7] and sum(r.chosen for r in rows) == 1
    assert [r.rmse for r in rows if r.chosen] == [min(r.rmse for r in rows)]
