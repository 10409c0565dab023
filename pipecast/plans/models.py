"""Fitting, tuning, scoring and storing the forecast models with Spark ML.

A pipeline encodes the division, assembles the features and regresses the share
of quota booked at quarter end. Encoding is fitted once, on training rows, and
travels with the model, so any later frame gets the same columns; divisions never
seen in training go to a bucket of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipecast.functions.labels import clean_header
from pipecast.operators.metrics import score
from pipecast.operators.model_frames import fill_missing, with_fold
from pipecast.plans.least_squares import LeastSquares, slot_coefficients
from pipecast.schemas import LABEL, MODEL_FEATURES
from pipecast.sources.sinks import cut_lineage

FEATURES = "features"
PREDICTION = "prediction"

# Spark grows trees level by level to at most 30 levels; that stands for "unlimited".
DEEPEST_TREE = 30

# The tuned leaf sizes, by whether divisions are merged, and the search grid.
FOREST_LEAF = {False: 3, True: 3}
BOOSTING_LEAF = {False: 4, True: 3}
TREES = 100
LEARNING_RATE = 0.1
GRID_DEPTHS = (None, 2, 3, 4, 5, 10)
GRID_LEAVES = (3, 4, 5, 10, 50)
FOLDS = 3
SEED = 42

# Partitions of the rows of a fit: more would multiply the statistics that deep trees send.
FIT_PARTITIONS = 2
# Boosting writes its rows' predictions to the shared folder every so many rounds. Until then every task of
# a level, thousands in all, is sent the whole trees grown since, which costs more than writing often.
CHECKPOINT_ROUNDS = 2


def encoder_stages() -> list:
    """Division one-hot encoded with all levels kept, after the numeric features."""
    return [
        StringIndexer(
            inputCol="sales_div",
            outputCol="sales_div_index",
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=["sales_div_index"], outputCols=["sales_div_levels"], dropLast=False),
        VectorAssembler(inputCols=[*MODEL_FEATURES, "sales_div_levels"], outputCol=FEATURES),
    ]


def linear_regression() -> LeastSquares:
    """Ordinary least squares without intercept."""
    return LeastSquares(FEATURES, LABEL)


def random_forest(
    together: bool = False, trees: int = TREES, max_depth: int | None = None, leaf: int | None = None
) -> RandomForestRegressor:
    """Bagged regression trees that look at every feature in every split."""
    return RandomForestRegressor(
        labelCol=LABEL,
        featuresCol=FEATURES,
        numTrees=trees,
        maxDepth=DEEPEST_TREE if max_depth is None else max_depth,
        minInstancesPerNode=FOREST_LEAF[together] if leaf is None else leaf,
        featureSubsetStrategy="all",
        subsamplingRate=1.0,
        seed=SEED,
        maxMemoryInMB=1024,
        cacheNodeIds=True,
    )


def gradient_boosting(
    together: bool = False, rounds: int = TREES, max_depth: int | None = None, leaf: int | None = None
) -> GBTRegressor:
    """Trees fitted one after another to the squared-loss residuals."""
    return GBTRegressor(
        labelCol=LABEL,
        featuresCol=FEATURES,
        maxIter=rounds,
        stepSize=LEARNING_RATE,
        lossType="squared",
        maxDepth=DEEPEST_TREE if max_depth is None else max_depth,
        minInstancesPerNode=BOOSTING_LEAF[together] if leaf is None else leaf,
        featureSubsetStrategy="all",
        seed=SEED,
        maxMemoryInMB=1024,
        cacheNodeIds=False,
        checkpointInterval=CHECKPOINT_ROUNDS,
    )


def lasso_on_scaled(alpha: float = 1.0) -> list[Estimator]:
    """Standardise the features by their sample deviation, then a lasso whose zero coefficients mark features to drop."""
    return [
        StandardScaler(inputCol=FEATURES, outputCol="scaled", withMean=True, withStd=True),
        LinearRegression(
            labelCol=LABEL,
            featuresCol="scaled",
            regParam=alpha,
            elasticNetParam=1.0,
            standardization=False,
            maxIter=1000,
            tol=1e-12,
        ),
    ]


def model_rows(df: DataFrame) -> DataFrame:
    """Rows as the models take them: no missing values."""
    return fill_missing(df)


def fit(train: DataFrame, *estimators: Estimator) -> PipelineModel:
    """Fit encoding and estimators on ``train``.

    Training reads its input many times, so the rows are computed once into reliable storage
    first. Every partition sends statistics of all open nodes at each level of a tree, so rows that
    are few (one a day and division) go into few partitions.
    """
    rows = cut_lineage(model_rows(train).coalesce(FIT_PARTITIONS))
    return Pipeline(stages=[*encoder_stages(), *estimators]).fit(rows)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All columns of ``df`` plus ``prediction``; rows keep their features side by side with it."""
    return model.transform(model_rows(df)).select(*df.columns, PREDICTION)


def compare_with_actual(model: PipelineModel, holdout: DataFrame) -> DataFrame:
    """Held-out rows with actual and predicted finish."""
    return predict(model, holdout)


def predict_current_quarter(model: PipelineModel, running: DataFrame) -> DataFrame:
    """The running quarter's rows with the predicted finish; the unknown outcome is left out."""
    return predict(model, running).drop("direct_bookings", LABEL)


def score_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    return score(predict(model, fill_missing(df)), LABEL, PREDICTION)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector's slots, in order, cleaned like column headers."""
    labels = next(s for s in model.stages if hasattr(s, "labelsArray")).labelsArray[0]
    levels = [clean_header(f"sales_div_{label}") for label in labels]
    return [*MODEL_FEATURES, *levels, "sales_div_unseen"]


def _per_feature(spark: SparkSession, model: PipelineModel, values, column: str) -> DataFrame:
    rows = [(name, float(value)) for name, value in zip(feature_names(model), values)]
    return spark.createDataFrame(rows, f"feature string, {column} double")


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature plus the intercept."""
    linear = model.stages[-1]
    nested = isinstance(linear, PipelineModel)
    values = slot_coefficients(linear, len(feature_names(model))) if nested else linear.coefficients.toArray()
    per_feature = _per_feature(spark, model, values, "coefficient")
    constant = 0.0 if nested else float(linear.intercept)
    intercept = spark.createDataFrame([("intercept", constant)], per_feature.schema)
    return per_feature.union(intercept)


def lasso_conditions(
    spark: SparkSession, model: PipelineModel, train: DataFrame, alpha: float, tolerance: float = 1e-5
) -> DataFrame:
    """(feature, optimal): the subgradient condition of each coefficient, from one pass over ``train``.

    The mean product of scaled feature and residual equals ``alpha`` times the coefficient's sign, or
    lies within ``alpha`` where the coefficient is 0.
    """
    scored = model.transform(model_rows(train)).select(
        (F.col(LABEL) - F.col(PREDICTION)).alias("missed"), F.posexplode(vector_to_array("scaled")).alias("slot", "x")
    )
    slopes = scored.groupBy("slot").agg(F.avg(F.col("x") * F.col("missed")).alias("slope"))
    slots = [(k, name) for k, name in enumerate(feature_names(model))]
    named = spark.createDataFrame(slots, "slot int, feature string").join(slopes, "slot", "left")
    values = coefficients(spark, model).withColumnRenamed("coefficient", "b")
    slope, b = F.coalesce(F.col("slope"), F.lit(0.0)), F.col("b")
    at_rest = F.when(b == 0, F.abs(slope) <= alpha + tolerance).otherwise(F.abs(slope - F.signum(b) * alpha) <= tolerance)
    return named.join(values, "feature").select("feature", at_rest.alias("optimal"))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance per feature, least first."""
    trees = model.stages[-1]
    return _per_feature(spark, model, trees.featureImportances.toArray(), "importance").orderBy("importance")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class GridResult:
    """Outcome of a search: the refitted winner and the mean score of every grid point."""

    model: PipelineModel
    best_params: dict[str, int]
    best_score: float
    points: list[tuple[int, int, float]]
    metric: str

    def to_frame(self, spark: SparkSession) -> DataFrame:
        best = (self.best_params["max_depth"], self.best_params["min_leaf"])
        rows = [(d, n, self.metric, s, (d, n) == best) for d, n, s in self.points]
        return spark.createDataFrame(
            rows, "max_depth int, min_leaf int, metric string, score double, is_best boolean"
        )


def grid_search(
    train: DataFrame,
    estimator: RandomForestRegressor | GBTRegressor,
    depths: tuple[int | None, ...] = GRID_DEPTHS,
    leaves: tuple[int, ...] = GRID_LEAVES,
    metric: str = "mae",
    folds: int = FOLDS,
    parallelism: int = 4,
) -> GridResult:
    """Cross-validate depth x leaf size, by mean absolute error or ``metric="r2"``.

    Encoding is fitted and applied once, ahead of the folds. ``parallelism`` fits
    run at a time; each is a Spark job of its own. ``None`` as depth stands for the
    deepest tree the estimator allows.
    """
    depth_values = list(dict.fromkeys(DEEPEST_TREE if depth is None else depth for depth in depths))
    rows = cut_lineage(with_fold(model_rows(train), folds))
    encoder = Pipeline(stages=encoder_stages()).fit(rows)
    encoded = cut_lineage(encoder.transform(rows).select(FEATURES, LABEL, "fold"))
    grid = (
        ParamGridBuilder()
        .addGrid(estimator.maxDepth, depth_values)
        .addGrid(estimator.minInstancesPerNode, list(leaves))
        .build()
    )
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=LABEL, metricName=metric),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    ).fit(encoded)
    points = [
        (params[estimator.maxDepth], params[estimator.minInstancesPerNode], float(value))
        for params, value in zip(grid, search.avgMetrics)
    ]
    pick = max if metric == "r2" else min
    depth, leaf, best = pick(points, key=lambda point: point[2])
    return GridResult(
        model=PipelineModel([*encoder.stages, search.bestModel]),
        best_params={"max_depth": depth, "min_leaf": leaf},
        best_score=best,
        points=points,
        metric=metric,
    )
