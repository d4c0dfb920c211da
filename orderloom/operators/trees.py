"""Fitted trees as a table of nodes, and models recomputed from what is stored of them.

A tree ensemble is a table: one row per node with its split, its children and its value. The nodes
of a model are bounded by its size parameters (trees times 2 ** (depth + 1)), so every task gets
them; a row stays in its task through all trees and levels, and only its sum moves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Largest ensemble that is broadcast; 2**21 nodes of 60 bytes are 120 MB.
MOST_NODES = 2**21


def node_table(spark: SparkSession, model_path: str, boosted: bool) -> DataFrame:
    """Nodes of a stored ensemble: tree, node, feature, threshold, left_values, left, right,
    value, weight, gain, rows_weight.

    The root is node 0. A row goes left if its feature is at most the threshold, or among
    ``left_values`` where the feature is a category. ``value`` is what a leaf says: the share of
    class 1 for a forest, the regression for boosted trees; ``weight`` is the weight of its tree.
    """
    weights = spark.read.parquet(f"{model_path}/treesMetadata").select(
        F.col("_1").alias("tree"), F.col("_3").alias("weight")
    )
    node = lambda name: F.col(f"nodeData.{name}")
    stats, split = node("impurityStats"), "nodeData.split"
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    inner = node("leftChild") >= 0
    category = F.col(f"{split}.numCategories") >= 0
    steps = F.col(f"{split}.leftCategoriesOrThreshold")
    value = node("prediction") if boosted else F.try_divide(F.get(stats, F.lit(1)), total)
    # the first number of a regression's statistics is the weight of its rows
    rows_weight = F.get(stats, F.lit(0)) if boosted else total
    return spark.read.parquet(f"{model_path}/data").select(
        F.col("treeID").alias("tree"), node("id").alias("node"),
        F.when(inner, F.col(f"{split}.featureIndex")).alias("feature"),
        F.when(inner & ~category, F.get(steps, F.lit(0))).alias("threshold"),
        F.when(inner & category, steps).alias("left_values"),
        F.when(inner, node("leftChild")).alias("left"),
        F.when(inner, node("rightChild")).alias("right"),
        value.alias("value"), node("gain").alias("gain"), rows_weight.alias("rows_weight"),
    ).join(weights, "tree")


def malformed(nodes: DataFrame) -> DataFrame:
    """One row of counts that are 0 for proper trees: nodes without parent other than the root,
    nodes with two parents, children that do not exist, and leaves without value."""
    child = nodes.where("left IS NOT NULL").select(
        "tree", F.explode(F.array("left", "right")).alias("node")
    ).groupBy("tree", "node").agg(F.count("*").alias("parents"))
    known = nodes.select("tree", "node", "value", "left", F.lit(True).alias("exists"))
    return known.join(child, ["tree", "node"], "full").agg(
        F.count_if(F.col("parents").isNull() & (F.col("node") != 0)).alias("orphans"),
        F.count_if((F.col("parents") > 1) | (F.col("parents").isNotNull() & (F.col("node") == 0)))
        .alias("shared"),
        F.count_if(F.col("exists").isNull()).alias("missing"),
        F.count_if(F.col("exists") & F.col("left").isNull() & F.col("value").isNull())
        .alias("mute"),
    )


def _arrays(nodes: DataFrame) -> dict[str, np.ndarray]:
    """Nodes as arrays, a tree after the other; children by place, -1 where there is none.

    A leaf is its own child. ``choice`` tells the row of ``goes_left`` that says which categories
    go left, 0 (none) where a threshold decides.
    """
    table = nodes.select(
        "tree", "node", "feature", "threshold", "left_values", "left", "right", "value", "weight"
    ).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    numbers = lambda name, other: table[name].to_pandas().fillna(other).to_numpy()
    tree, node = numbers("tree", 0).astype(np.int64), numbers("node", 0).astype(np.int64)
    inner = table["left"].is_valid().to_numpy()
    place, wide = tree * (node.max(initial=0) + 1) + node, node.max(initial=0) + 1

    def child(name: str) -> np.ndarray:
        step = numbers(name, 0).astype(np.int64)
        wanted = tree * wide + step
        found = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
        found = np.where((place[found] == wanted) & (step < wide), found, -1)
        return np.where(inner, found, np.arange(len(place)))

    chosen = [values or [] for values in table["left_values"].to_pylist()]
    has = np.array([len(v) > 0 for v in chosen], dtype=bool)
    categories = int(max((max(v) for v in chosen if v), default=-1)) + 1
    goes_left = np.zeros((has.sum() + 1, categories + 1), dtype=bool)
    for row, values in enumerate((v for v in chosen if v), start=1):
        goes_left[row, np.array(values, dtype=np.int64)] = True
    return {
        "children": np.stack([child("right"), child("left")], axis=1).ravel(),
        "feature": numbers("feature", 0).astype(np.int64),
        "threshold": numbers("threshold", np.nan).astype(float),
        "choice": np.where(has, np.cumsum(has), 0), "goes_left": goes_left, "leaf": ~inner,
        "value": (numbers("value", 0.0) * numbers("weight", 0.0)).astype(float),
        "weight": numbers("weight", 0.0).astype(float), "roots": np.flatnonzero(node == 0),
    }


def scored_by_nodes(
    rows: DataFrame, nodes: DataFrame, depth: int, boosted: bool, key: str = "customer_unique_id",
    features: str = "features",
) -> DataFrame:
    """key, score: probability of class 1, by walking every tree a level at a time.

    Keys must be unique, vectors not NULL. The nodes go to the tasks as arrays; a batch of rows
    walks a tree at once, so neither rows nor vectors are copied for the trees.
    """
    if nodes.count() > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes: score in groups of trees")
    a = _arrays(nodes)

    def walk(batches):
        unknown = a["goes_left"].shape[1] - 1  # no category, goes nowhere left
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            width, first = v.shape[1], np.arange(n) * v.shape[1]
            known = (v >= 0) & (v < unknown) & (v == np.floor(v))
            v, category = v.ravel(), np.where(known, v, unknown).astype(np.int64).ravel()
            total, weights = np.zeros(n), np.zeros(n)
            for root in a["roots"]:
                at = np.full(n, root)
                for _ in range(depth if width else 0):
                    slot = first + a["feature"][at]
                    left = v[slot] <= a["threshold"][at]
                    if unknown:
                        left |= a["goes_left"][a["choice"][at], category[slot]]
                    at = np.where(at < 0, -1, a["children"][2 * at + left])
                arrived = (at >= 0) & a["leaf"][at]
                total += np.where(arrived, a["value"][at], 0.0)
                weights += np.where(arrived, a["weight"][at], 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total), pa.array(weights)], ["key", "sum", "weights"])

    walked = rows.select(F.col(key).alias("key"), vector_to_array(features).alias("v")).mapInArrow(
        walk, StructType([StructField("key", rows.schema[key].dataType),
                          StructField("sum", DoubleType()), StructField("weights", DoubleType())])
    ).where("weights <> 0")
    added = walked.groupBy(F.col("key").alias(key)).agg(
        F.sum("sum").alias("_sum"), F.sum("weights").alias("_weights")
    )
    chance = F.lit(1.0) / (1 + F.exp(F.col("_sum") * -2)) if boosted else (
        F.col("_sum") / F.col("_weights")
    )
    return added.select(key, chance.alias("score"))


def importance_by_nodes(nodes: DataFrame, boosted: bool) -> DataFrame:
    """feature (place of the vector), importance: gain times weight of the rows, as a share.

    The trees of a forest count alike, those of a boosted model by their gains.
    """
    gains = nodes.where("left IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("rows_weight")).alias("_gain")
    )
    if not boosted:
        of_tree = gains.groupBy("tree").agg(F.sum("_gain").alias("_all"))
        gains = gains.join(of_tree, "tree").withColumn("_gain", F.col("_gain") / F.col("_all"))
    by_feature = gains.groupBy("feature").agg(F.sum("_gain").alias("_gain"))
    return by_feature.withColumn("_all", by_feature.agg(F.sum("_gain")).scalar()).select(
        "feature", (F.col("_gain") / F.col("_all")).alias("importance")
    )


# ---- logistic regression ------------------------------------------------------------------


def linear_chance(features: str, coefficients: Sequence[float], intercept: float) -> Column:
    """Probability of class 1 from the stored coefficients."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    products = F.zip_with(vector_to_array(features), weights, lambda a, b: a * b)
    margin = F.aggregate(products, F.lit(float(intercept)), lambda a, x: a + x)
    return F.lit(1.0) / (1 + F.exp(-margin))


def loss_gradient(
    rows: DataFrame, coefficients: Sequence[float], intercept: float, penalty: float,
    names: Sequence[str], label: str = "is_churned", weight: str = "weight",
    features: str = "features",
) -> DataFrame:
    """feature, gradient: slope of the weighted, penalised loss at stored coefficients.

    All slopes are 0 at the optimum of the convex loss, and only there: that certifies a fit
    without fitting again. Slots are in units of their deviation, in which the penalty is taken;
    a slot without spread has no say. The last row is the intercept, which is not penalised.
    """
    chance = linear_chance(features, coefficients, intercept)
    known = rows.select(
        F.col(weight).alias("_w"),
        (F.col(weight) * (chance - F.col(label))).alias("_residual"),
        vector_to_array(features).alias("_v"),
    )
    whole = known.agg(F.struct(
        F.sum("_w").alias("w"), F.sum(F.col("_w") * F.col("_w")).alias("ww"),
        F.sum("_residual").alias("residual"),
    )).scalar()
    slots = known.select("_w", "_residual", F.posexplode("_v").alias("slot", "x")).groupBy(
        "slot"
    ).agg(
        F.sum(F.col("_residual") * F.col("x")).alias("_slope"),
        F.sum(F.col("_w") * F.col("x")).alias("_wx"),
        F.sum(F.col("_w") * F.col("x") * F.col("x")).alias("_wxx"),
    ).withColumn("_all", whole)
    w, ww = F.col("_all.w"), F.col("_all.ww")
    spread = F.sqrt(F.greatest(
        (F.col("_wxx") - F.col("_wx") * F.col("_wx") / w) / (w - ww / w), F.lit(0.0)
    ))
    at = lambda values: F.get(F.array(*values), F.col("slot"))
    named = at([F.lit(n) for n in names])
    size = at([F.lit(float(c)) for c in coefficients])
    slope = F.when(
        spread > 0, F.col("_slope") / w / spread + F.lit(float(penalty)) * size * spread
    ).otherwise(F.lit(0.0))
    last = known.agg(F.try_divide(F.sum("_residual"), F.sum("_w")).alias("gradient"))
    return slots.select(named.alias("feature"), slope.alias("gradient")).unionByName(
        last.select(F.lit("intercept").alias("feature"), "gradient")
    )
