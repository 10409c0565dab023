"""Fitted trees as tables: scoring by joins, and every point of a search from one deep fit.

Trees grow from the top, and whether a node is split depends on the rows in it alone. A tree of limited
depth is therefore the deep tree cut at that depth, and one with a least split size is the deep tree whose
smaller nodes are left unsplit. ``search_forest`` fits one forest of unlimited depth for each leaf size
and fold and reads all depths and split sizes off its nodes. (Boosting fits each tree to what the ones
before have left, so its points need fits of their own.)

Node tables are as large as the trees, whose nodes are at most twice the training rows (one a day and
division); ``predictions_by_walk`` and the scores of a search join them like any other table.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pipecast.operators.model_frames import with_fold
from pipecast.plans import models
from pipecast.schemas import LABEL
from pipecast.sources.sinks import cut_lineage, run_folder

# The least sizes of a node that is split, searched beside depth and leaf size.
GRID_SPLITS = (2, 3, 4, 5, 6, 20)
# Steps of a walk between two checkpoints: a longer plan would be redone from its start.
STEPS = 8

TreeModel = RandomForestRegressionModel | GBTRegressionModel


def node_table(model: TreeModel) -> DataFrame:
    """(tree, node, value, count, feature, threshold, categories, left, right), one row a node.

    ``count`` weighs rows as the tree's sample does. A leaf has null children. Of a feature with
    categories the listed ones go left, of others the values up to the threshold.
    """
    spark = SparkSession.builder.getOrCreate()
    path = run_folder(spark, "nodes")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    split = F.col("split")
    listed = split["numCategories"] >= 0
    return rows.select(
        "tree",
        F.col("id").alias("node"),
        F.col("prediction").alias("value"),
        F.col("rawCount").alias("count"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ~listed, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner & listed, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
    )


def tree_weights(model: TreeModel) -> list[float]:
    """What each tree's value counts for in a prediction."""
    if isinstance(model, GBTRegressionModel):
        return list(model.treeWeights)
    return [1.0 / model.getNumTrees] * model.getNumTrees


def predictions_by_walk(nodes: DataFrame, weights: list[float], df: DataFrame, *keys: str) -> DataFrame:
    """(keys, by_walk): rows walk down all trees, a join with the node table a step.

    ``df`` has the keys, which tell rows apart, and the vector of features.
    """
    tree_ids = F.explode(F.array(*[F.lit(t) for t in range(len(weights))])).alias("tree")
    walkers = df.select(*keys, vector_to_array(models.FEATURES).alias("x"), tree_ids).withColumn("node", F.lit(0))
    value = F.get(F.col("x"), F.col("feature"))
    goes_left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(
        value <= F.col("threshold")
    )
    going = walkers
    done = None
    while True:
        for _ in range(STEPS):
            met = going.join(nodes, ["tree", "node"])
            child = F.when(F.col("left").isNull(), F.col("node")).otherwise(F.when(goes_left, F.col("left")).otherwise(F.col("right")))
            going = met.select(*keys, "x", "tree", child.alias("node"))
        here = cut_lineage(going.join(nodes.select("tree", "node", "value", "left"), ["tree", "node"]))
        ended = here.where("left is null").select(*keys, "tree", "value")
        done = ended if done is None else done.unionByName(ended)
        going = here.where("left is not null").select(*keys, "x", "tree", "node")
        if going.isEmpty():
            break
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("tree"))
    return done.groupBy(*keys).agg(F.sum(F.col("value") * weight).alias("by_walk"))


def stopped_values(nodes: DataFrame, depths: Sequence[int | None], splits: Sequence[int]) -> DataFrame:
    """(tree, leaf, values): for each leaf, numbered from the left, the tree's value at every point.

    Points are depths within split sizes. A row that ends in this leaf stops earlier where the depth is
    reached or the node has fewer rows than a split needs.
    """
    limits = np.array([np.iinfo(np.int64).max if d is None else d for d in depths])
    least = np.array(splits)

    def stop(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        value, count = table["value"].to_numpy(), table["count"].to_numpy()
        left, right = (table[c].fill_null(-1).to_numpy() for c in ("left", "right"))
        held = {0: (0, np.zeros((len(least), len(limits))), np.ones(len(least), bool))}
        values = []
        for node in range(len(value)):  # a child's number is larger than its parent's
            depth, above, open_ = held.pop(node)
            now = np.where(open_[:, None] & (depth <= limits)[None, :], value[node], above)
            if left[node] < 0:
                values.append(now.ravel())
                continue
            below = (depth + 1, now, open_ & (count[node] >= least))
            held[int(left[node])] = held[int(right[node])] = below
        n = len(values)
        columns = [pa.array(np.full(n, table["tree"][0].as_py()), pa.int32()), pa.array(range(n), pa.int32())]
        return pa.Table.from_arrays([*columns, pa.array([list(v) for v in values], pa.list_(pa.float64()))], names=["tree", "leaf", "values"])

    needed = nodes.select("tree", "node", "value", "count", "left", "right")
    return needed.groupBy("tree").applyInArrow(stop, "tree int, leaf int, values array<double>")


def point_errors(model: RandomForestRegressionModel, rows: DataFrame, depths: Sequence[int | None], splits: Sequence[int]) -> dict[str, np.ndarray]:
    """Mean absolute error and R2 of every point over ``rows``, as arrays by split size and depth."""
    size = len(depths) * len(splits)
    leaves = stopped_values(node_table(model), depths, splits)
    model.setLeafCol("leaf_of_tree")
    found = model.transform(rows).select(F.monotonically_increasing_id().alias("row"), LABEL, vector_to_array("leaf_of_tree").alias("ends"))
    found = cut_lineage(found)
    ends = found.select("row", F.posexplode("ends").alias("tree", "leaf")).withColumn("leaf", F.col("leaf").cast("int"))
    met = ends.join(leaves, ["tree", "leaf"])
    sums = met.groupBy("row").agg(*[F.sum(F.col("values")[k]).alias(f"p{k}") for k in range(size)])
    label = F.col(LABEL)

    def missed(k: int) -> Column:
        return label - F.col(f"p{k}") / model.getNumTrees

    totals = found.select("row", LABEL).join(sums, "row").agg(
        F.count("*").alias("n"),
        F.var_pop(label).alias("variance"),
        *[F.sum(F.abs(missed(k))).alias(f"a{k}") for k in range(size)],
        *[F.sum(missed(k) * missed(k)).alias(f"s{k}") for k in range(size)],
    ).first()
    shape = (len(splits), len(depths))
    absolute = np.array([totals[f"a{k}"] for k in range(size)]).reshape(shape)
    squares = np.array([totals[f"s{k}"] for k in range(size)]).reshape(shape)
    return {"mae": absolute / totals["n"], "r2": 1 - squares / (totals["variance"] * totals["n"])}


@dataclass(frozen=True)
class ForestSearch:
    """Mean scores over the folds of every (depth, split size, leaf size)."""

    points: list[tuple[int | None, int, int, dict[str, float]]]

    def best(self, metric: str) -> tuple[int | None, int, int, dict[str, float]]:
        sign = -1 if metric == "r2" else 1
        return min(self.points, key=lambda point: sign * point[3][metric])

    def to_frame(self, spark: SparkSession, metric: str) -> DataFrame:
        """One row a point; a null depth is unlimited."""
        chosen = self.best(metric)[:3]
        rows = [(d, s, n, metric, scores[metric], (d, s, n) == chosen) for d, s, n, scores in self.points]
        return spark.createDataFrame(
            rows, "max_depth int, min_split int, min_leaf int, metric string, score double, is_best boolean"
        )


def search_forest(
    train: DataFrame,
    depths: Sequence[int | None] = models.GRID_DEPTHS,
    splits: Sequence[int] = GRID_SPLITS,
    leaves: Sequence[int] = models.GRID_LEAVES,
    folds: int = models.FOLDS,
    trees: int = models.TREES,
    parallelism: int = 4,
) -> ForestSearch:
    """Cross-validate all points, with ``len(leaves) * folds`` fits, ``parallelism`` at a time."""
    rows = cut_lineage(with_fold(models.model_rows(train), folds))
    encoder = Pipeline(stages=models.encoder_stages()).fit(rows)
    encoded = encoder.transform(rows).select(models.FEATURES, LABEL, "fold")
    parts = [
        (cut_lineage(encoded.where(F.col("fold") != k).coalesce(2)), cut_lineage(encoded.where(F.col("fold") == k)))
        for k in range(folds)
    ]

    def run(job: tuple[int, int]) -> dict[str, np.ndarray]:
        leaf, fold = job
        fit_rows, test_rows = parts[fold]
        deepest = None if None in depths else max(depths)
        model = models.random_forest(trees=trees, leaf=leaf, max_depth=deepest).fit(fit_rows)
        return point_errors(model, test_rows, depths, splits)

    jobs = [(leaf, fold) for leaf in leaves for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = dict(zip(jobs, pool.map(run, jobs)))
    points = []
    for leaf in leaves:
        mean = {m: np.mean([scores[leaf, fold][m] for fold in range(folds)], axis=0) for m in ("mae", "r2")}
        points += [
            (depth, split, leaf, {m: float(mean[m][i, j]) for m in mean})
            for i, split in enumerate(splits)
            for j, depth in enumerate(depths)
        ]
    return ForestSearch(points)


def collapse(model: RandomForestRegressionModel, max_depth: int | None, min_split: int) -> RandomForestRegressionModel:
    """The forest as if grown to ``max_depth`` with nodes below ``min_split`` rows left unsplit."""
    spark = SparkSession.builder.getOrCreate()
    deep, cut = run_folder(spark, "deep"), run_folder(spark, "collapsed")
    model.write().save(deep)
    model.write().save(cut)
    stored = spark.read.parquet(f"{deep}/data")
    limit = np.iinfo(np.int64).max if max_depth is None else max_depth

    def prune(table: pa.Table) -> pa.Table:
        rows = sorted(table["nodeData"].to_pylist(), key=lambda r: r["id"])
        kept: list[dict] = []

        def keep(number: int, depth: int) -> int:
            row = dict(rows[number], id=len(kept))
            kept.append(row)
            if row["leftChild"] >= 0 and (depth >= limit or row["rawCount"] < min_split):
                none = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
                row.update(leftChild=-1, rightChild=-1, gain=-1.0, split=none)
            elif row["leftChild"] >= 0:
                row["leftChild"] = keep(row["leftChild"], depth + 1)
                row["rightChild"] = keep(row["rightChild"], depth + 1)
            return row["id"]

        keep(0, 0)
        tree = pa.array([table["treeID"][0].as_py()] * len(kept), pa.int32())
        return pa.Table.from_arrays([tree, pa.array(kept, table.schema.field("nodeData").type)], names=["treeID", "nodeData"])

    pruned = stored.groupBy("treeID").applyInArrow(prune, stored.schema)
    pruned.write.mode("overwrite").parquet(f"{cut}/data")
    return RandomForestRegressionModel.load(cut)


def fit_best(train: DataFrame, search: ForestSearch, metric: str, trees: int = models.TREES) -> PipelineModel:
    """The winner of a search, fitted on all of ``train``."""
    depth, split, leaf, _ = search.best(metric)
    fitted = models.fit(train, models.random_forest(trees=trees, max_depth=depth, leaf=leaf))
    return PipelineModel([*fitted.stages[:-1], collapse(fitted.stages[-1], depth, split)])
