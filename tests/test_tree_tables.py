"""Trees as tables against separate fits, least squares, the incremental store and published versions."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pipecast.operators.model_frames import with_fold
from pipecast.plans import least_squares, models, tree_tables
from pipecast.plans.features import build_features, refresh_features
from pipecast.queries import workspace as ws
from pipecast.schemas import LABEL
from pipecast.sources.sinks import cut_lineage, publish_table, run_folder
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def train(spark):
    return cut_lineage(ws.holdout_split(spark, SMALL)[0].where("dt >= '2000-06-01'"))


def encoded(train):
    rows = cut_lineage(with_fold(models.model_rows(train), 2))
    return Pipeline(stages=models.encoder_stages()).fit(rows).transform(rows).select(models.FEATURES, LABEL, "fold")


def test_a_deep_fit_holds_every_point_of_the_search(train):
    depths, leaves = (None, 2, 4), (3, 10)
    search = tree_tables.search_forest(train, depths, (2, 20), leaves, folds=2, trees=3, parallelism=2)
    assert len(search.points) == 12
    rows = encoded(train)
    for depth, split, leaf, scores in search.points:
        if split > 2:
            continue
        for metric in ("mae", "r2"):
            found = []
            for fold in range(2):
                model = models.random_forest(trees=3, max_depth=depth, leaf=leaf).fit(rows.where(F.col("fold") != fold).coalesce(2))
                scored = model.transform(rows.where(F.col("fold") == fold))
                found.append(RegressionEvaluator(labelCol=LABEL, metricName=metric).evaluate(scored))
            assert scores[metric] == pytest.approx(np.mean(found), abs=1e-9)
    assert search.best("r2")[3]["r2"] == max(p[3]["r2"] for p in search.points)


def test_collapsed_forests_score_like_the_points(spark, train):
    rows = encoded(train)
    model = models.random_forest(trees=3, leaf=3).fit(rows)
    scores = tree_tables.point_errors(model, rows, (None, 3), (2, 20))
    for i, split in enumerate((2, 20)):
        for j, depth in enumerate((None, 3)):
            cut = tree_tables.collapse(model, depth, split)
            assert max(t.depth for t in cut.trees) <= (depth or 30)
            mae = RegressionEvaluator(labelCol=LABEL, metricName="mae").evaluate(cut.transform(rows))
            assert scores["mae"][i, j] == pytest.approx(mae, abs=1e-9)
            counts = tree_tables.node_table(cut).where("left is not null").agg(F.min("count")).first()[0]
            assert counts >= split
    assert scores["mae"][1, 0] != scores["mae"][0, 0]


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_walks_by_joins_end_where_the_model_does(train, kind):
    rows = encoded(train).withColumn("key", F.monotonically_increasing_id())
    rows = cut_lineage(rows)
    estimator = models.random_forest(trees=3) if kind == "forest" else models.gradient_boosting(rounds=3)
    model = estimator.fit(rows)
    walked = tree_tables.predictions_by_walk(tree_tables.node_table(model), tree_tables.tree_weights(model), rows, "key")
    met = model.transform(rows).join(walked, "key")
    assert met.count() == rows.count()
    assert met.where(F.abs(F.col("prediction") - F.col("by_walk")) > 1e-9).count() == 0


def test_boosting_sends_few_earlier_trees_and_fits_the_same(train):
    """Trees grown since the last checkpoint travel with every task; how many does not change the model."""
    rows = cut_lineage(encoded(train).coalesce(2))
    often = models.gradient_boosting(rounds=4)
    assert 1 <= often.getCheckpointInterval() <= 2
    seldom = models.gradient_boosting(rounds=4).setCheckpointInterval(10)
    found, expected = (tree_tables.node_table(estimator.fit(rows)).orderBy("tree", "node").collect() for estimator in (often, seldom))
    assert found == expected


def test_best_forest_is_the_collapsed_winner(spark, train):
    search = tree_tables.search_forest(train, (2, 3), (2, 20), (3,), folds=2, trees=2, parallelism=2)
    model = tree_tables.fit_best(train, search, "mae", trees=2)
    assert max(t.depth for t in model.stages[-1].trees) <= 3
    assert models.predict(model, train).where("prediction is null").count() == 0
    assert search.to_frame(spark, "mae").where("is_best").count() == 1


def test_least_squares_with_dependent_and_empty_columns(spark):
    random = np.random.default_rng(2)
    x = random.normal(size=(300, 4))
    x = np.column_stack([x, x[:, 0] + 2 * x[:, 2], np.zeros(300), random.normal(size=300)])
    y = x @ [1.0, -2.0, 0.5, 3.0, 1.0, 0.0, 0.25] + random.normal(size=300) * 0.1
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "y"]).repartition(4)
    model = least_squares.LeastSquares("features", "y").fit(rows)
    found = least_squares.slot_coefficients(model, 7)
    assert found[4] == found[5] == 0
    assert np.abs(x @ found - x @ np.linalg.lstsq(x, y, rcond=None)[0]).max() < 1e-9


def stored_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_second_run_rewrites_the_running_quarter_only(spark):
    src = ws.sources(spark, SMALL)
    early = replace(ws.CONFIG, as_of=date(2001, 6, 1), min_dt=date(2000, 8, 1))
    late = replace(early, as_of=date(2001, 6, 15))
    path = run_folder(spark, "incremental")
    refresh_features(src, early, path)
    before = stored_files(path)
    features = refresh_features(src, late, path)
    after = stored_files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f.split("fy_quarter=")[1].split("/")[0] for f in set(before) - kept} == {"FY02 Q2"}
    assert len(kept) >= 3
    whole = build_features(src, late)
    assert features.exceptAll(whole).count() == 0 and whole.exceptAll(features).count() == 0


def test_published_tables_are_replaced_whole(spark):
    reader = None
    for n in (3, 5, 7):
        publish_table(spark.range(n).toDF("id"), "published_numbers")
        assert spark.table("published_numbers").count() == n
        if reader is not None:
            assert reader.count() == n - 2  # a reader that has begun keeps its version
        reader = spark.table("published_numbers")
    versions = [t.name for t in spark.catalog.listTables(pattern="published_numbers__v*")]
    assert len(versions) == 2
