"""Ordinary least squares by the normal equations of independent features.

One pass over the rows sums the products of every pair of columns; their number does not depend on the
rows. Eliminating column by column shows which features are combinations of earlier ones. Those get the
coefficient 0, the others are fitted by a direct solver: fitted values are the least-squares ones, and
the coefficients are the same on every run and cluster.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A column whose rest after elimination is below this share of its square sum depends on earlier ones.
DEPENDENT = 1e-10


def cross_products(df: DataFrame, features: str, label: str) -> np.ndarray:
    """Sums of products of all pairs of vector slots, the label as last row and column."""
    values = df.select(F.concat(vector_to_array(features), F.array(F.col(label).cast("double"))).alias("all_values"))
    pairs = (
        values.select("all_values", F.posexplode("all_values").alias("a", "value_a"))
        .select("a", "value_a", F.posexplode("all_values").alias("b", "value_b"))
        .where("a <= b")
    )
    sums = pairs.groupBy("a", "b").agg(F.sum(F.col("value_a") * F.col("value_b")).alias("v")).collect()
    size = max((r["b"] for r in sums), default=-1) + 1
    out = np.zeros((size, size))
    for r in sums:
        out[r["a"], r["b"]] = out[r["b"], r["a"]] = r["v"]
    return out


def independent_slots(products: np.ndarray) -> list[int]:
    """Slots that are no combination of the ones before, in order; a slot of zeros is none."""
    sizes = np.sqrt(np.diag(products))
    rest = products / np.outer(*[np.where(sizes > 0, sizes, 1.0)] * 2)
    kept = []
    for k in range(len(rest)):
        if rest[k, k] > DEPENDENT:
            kept.append(k)
            rest = rest - np.outer(rest[:, k], rest[k]) / rest[k, k]
    return kept


class LeastSquares(Estimator):
    """Least squares without intercept; its model is a pipeline of a slicer and a linear model."""

    def __init__(self, features: str, label: str) -> None:
        super().__init__()
        self.features, self.label = features, label

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        slots = independent_slots(cross_products(dataset, self.features, self.label)[:-1, :-1])
        slicer = VectorSlicer(inputCol=self.features, outputCol="independent_features", indices=slots)
        linear = LinearRegression(
            labelCol=self.label,
            featuresCol="independent_features",
            fitIntercept=False,
            regParam=0.0,
            standardization=False,
            solver="normal",
        )
        return Pipeline(stages=[slicer, linear]).fit(dataset)


def slot_coefficients(model: PipelineModel, size: int) -> np.ndarray:
    """Coefficients of all ``size`` slots; dependent ones have 0."""
    slicer, linear = model.stages
    out = np.zeros(size)
    out[slicer.getIndices()] = linear.coefficients.toArray()
    return out
