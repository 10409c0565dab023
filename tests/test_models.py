from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipecast.operators import model_frames
from pipecast.plans import models
from pipecast.queries import workspace as ws
from pipecast.schemas import LABEL, MODEL_FEATURES
from pipecast.sources.sinks import export_csv, run_folder
from pipecast.sources.readers import read_features_csv
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def split(spark):
    return ws.holdout_split(spark, SMALL)


def predictions(model, df):
    rows = models.predict(model, df).select("dt", "sales_div", "prediction").collect()
    return {(r[0], r[1]): r[2] for r in rows}


def test_split_is_stable_and_about_one_in_five(split):
    train, holdout = (df.count() for df in split)
    assert 0.17 < holdout / (train + holdout) < 0.23
    again = model_frames.with_holdout(split[1].repartition(5)).where(~F.col("is_test"))
    assert again.count() == 0


def test_linear_model_predicts_like_least_squares(spark, split):
    train, holdout = split
    model = models.fit(train, models.linear_regression())
    levels = sorted(r[0] for r in train.select("sales_div").distinct().collect())

    def matrix(df):
        rows = df.select("dt", "sales_div", LABEL, *MODEL_FEATURES).collect()
        x = np.array([[*r[3:], *[float(r[1] == level) for level in levels]] for r in rows])
        return rows, x, np.array([r[2] for r in rows])

    _, x, y = matrix(train)
    weights = np.linalg.lstsq(x, y, rcond=None)[0]
    rows, x_test, _ = matrix(holdout)
    found = predictions(model, holdout)
    expected = x_test @ weights
    got = np.array([found[(r[0], r[1])] for r in rows])
    # The features are collinear, so weights differ; fitted values do not.
    assert np.abs(got - expected).max() < 1e-6
    assert models.coefficients(spark, model).count() == len(models.feature_names(model)) + 1


def test_forest_is_reproducible_survives_storage_and_beats_the_mean(spark, split):
    train, holdout = split
    forest = models.random_forest(trees=10, max_depth=6)
    model = models.fit(train, forest)
    path = run_folder(spark, "forest")
    models.save_model(model, path)
    first = predictions(model, holdout)
    assert predictions(models.load_model(path), holdout) == first
    assert predictions(models.fit(train, forest), holdout) == first
    mean = train.agg(F.avg(LABEL)).first()[0]
    constant = holdout.agg(F.avg(F.abs(F.col(LABEL) - mean))).first()[0]
    assert models.score_model(model, holdout).first()["avg_abs_var_finish"] < constant
    importance = models.feature_importance(spark, model).collect()
    assert [r[1] for r in importance] == sorted(r[1] for r in importance)
    assert sum(r[1] for r in importance) == pytest.approx(1.0)


def test_unseen_division_can_be_scored(spark, split):
    train, holdout = split
    model = models.fit(train, models.linear_regression())
    odd = holdout.limit(3).withColumn("sales_div", F.lit("ATLANTIS"))
    assert models.predict(model, odd).where("prediction is null").count() == 0


def test_grid_search_reports_every_point(spark, split):
    train, _ = split
    result = models.grid_search(train, models.random_forest(trees=3), depths=(2, 4), leaves=(3, 50), folds=2)
    assert len(result.points) == 4
    assert result.best_score == min(score for *_, score in result.points)
    assert result.to_frame(spark).where("is_best").count() == 1
    assert predictions(result.model, train)


def test_csv_round_trip_keeps_every_value(spark):
    running = ws.stored_slice(spark, SMALL, "test")
    back = read_features_csv(spark, export_csv(running, run_folder(spark, "running")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, running.collect()))


def test_current_quarter_prediction_hides_the_outcome(spark):
    model = ws.model(spark, SMALL, "linear")
    predicted = models.predict_current_quarter(model, ws.stored_slice(spark, SMALL, "test"))
    assert LABEL not in predicted.columns and "direct_bookings" not in predicted.columns
    assert predicted.where("prediction is null").count() == 0
