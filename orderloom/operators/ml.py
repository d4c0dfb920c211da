"""Churn models on Spark ML: preparation, three classifiers, evaluation and scoring.

Everything the driver sees is bounded by the number of columns or categories: medians, label
counts, model parameters and one row of metrics.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numeric import ratio, rounded
from ..session import exists, fresh_path, handed_over, own_folder
from . import trees
from .churn import CATEGORICAL_FEATURES, LEAKY_FEATURES, NUMERIC_FEATURES
from .ranking import medians, thresholds, with_running_totals

LABEL, WEIGHT, FEATURES = "is_churned", "weight", "features"
SEED = 42
#: Training rows of a partition; a row of features takes half a kilobyte.
MOST_ROWS = 500_000
MODELS = LOGISTIC, FOREST, BOOSTED = "logistic_regression", "random_forest", "gradient_boosting"


# ---- preparation --------------------------------------------------------------------------


def impute(
    df: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> DataFrame:
    """NULL numbers become the exact column median, NULL categories ``unknown``."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in numeric]
    missing = df.agg(*counts).first() if counts else {}
    lacking = [c for c in numeric if missing[c]]  # others need no median
    middle = {r.column_name: r.median for r in medians(df, lacking).collect()} if lacking else {}
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c))) for c in numeric
    }
    filled |= {c: F.coalesce(F.col(c), F.lit("unknown")) for c in categorical}
    return df.withColumns(filled)


def split_draw(key: Column | str, seed: int = SEED) -> Column:
    """Number between 0 and 2**60 that only the key and the seed decide."""
    key = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string"))), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def with_split(
    df: DataFrame, key: str = "customer_unique_id", train_share: float = 0.8, seed: int = SEED,
    label: str = LABEL,
) -> DataFrame:
    """Reproducible train/test mark: of each label exactly the rounded share is training.

    People are ordered by a hash of their key within their label, and the first ones train. The
    last of those is the threshold of its label; it comes from ordered slices of narrow rows, one
    threshold per label goes back to the rows, and the rows stay where they are. With more rows
    a threshold moves, so some people may change sides. Keys must be unique and not NULL.
    """
    drawn = df.withColumn("_draw", split_draw(key, seed))
    take = F.floor(F.lit(float(train_share)) * F.col("_size") + 0.5)
    last = thresholds(drawn, [label], ["_draw", key], take).select(
        F.col(label).alias("_of"), F.struct(F.col("_draw"), F.col(key)).alias("_last")
    )
    here = F.struct(F.col("_draw"), F.col(key))
    return (
        drawn.join(F.broadcast(last), F.col(label).eqNullSafe(F.col("_of")), "left")
        .withColumn("is_train", F.coalesce(here <= F.col("_last"), F.lit(False)))
        .drop("_draw", "_of", "_last")
    )


def label_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Both class sizes in one row."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("retained"),
        F.count_if(F.col(label) == 1).alias("churned"),
    )


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight of each class: ``balanced`` for both, ``ratio`` for the boosted model."""
    n, n0, n1 = F.col("retained") + F.col("churned"), F.col("retained"), F.col("churned")
    return label_counts(df, label).select(
        ratio(n, n0 * 2).alias("balanced_retained"),
        ratio(n, n1 * 2).alias("balanced_churned"),
        ratio(n1, n0).alias("ratio_churned"),
    )


def _weighted(df: DataFrame, model: str) -> DataFrame:
    """Training rows with their class weights, in the partitions they have."""
    sizes = label_counts(df).first()
    n = sizes.retained + sizes.churned
    if model == BOOSTED:
        retained, churned = 1.0, sizes.retained and sizes.churned / sizes.retained
    else:
        retained, churned = (k and n / (2.0 * k) for k in (sizes.retained, sizes.churned))
    # a class without rows has no weight and needs none
    return df.withColumn(
        WEIGHT, F.when(F.col(LABEL) == 1, float(churned or 1.0)).otherwise(float(retained or 1.0))
    )


def _dealt(train: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Training rows, evenly in as many partitions as there are cores, in the order of their key.

    Trees read these rows once per level, two thousand times for the boosted model, so each task
    too many costs more than what it reads. What trees draw depends on place and order of a row;
    here the keys decide both.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = cores * -(-train.count() // (MOST_ROWS * cores)) or cores
    return train.repartition(parts, key).sortWithinPartitions(key)


def scaling_stages(rows: DataFrame, numeric: Sequence[str]) -> list:
    """Numbers less their mean, over the deviation of the whole population of ``rows``.

    Spark's own scaler divides by n - 1. A number without spread becomes 0.
    """
    sums = rows.agg(*[f(c).alias(f"{p}{c}") for c in numeric
                      for p, f in (("mean_", F.mean), ("std_", F.stddev_pop))]).first()
    literal = lambda value: f"{float(value or 0.0)!r}D"
    scaled = ", ".join(
        f"({c} - {literal(sums[f'mean_{c}'])}) / {literal(sums[f'std_{c}'] or 1.0)} AS scaled_{c}"
        for c in numeric
    )
    return [
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"scaled_{c}" for c in numeric], outputCol="scaled"),
    ]


def encoding_stages(categorical: Sequence[str]) -> list:
    """Unseen categories get the extra index, whose column is dropped: all zeros."""
    names = list(categorical)
    return [
        StringIndexer(inputCols=names, outputCols=[f"{c}_index" for c in names],
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in names],
                      outputCols=[f"{c}_onehot" for c in names], dropLast=True),
    ]


def feature_pipeline(
    rows: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> Pipeline:
    """Preparation scaled by ``rows``; fit it on the same rows. Without numbers there is no scaling."""
    parts = [*(["scaled"] if numeric else []), *[f"{c}_onehot" for c in categorical]]
    return Pipeline(stages=[
        *(scaling_stages(rows, numeric) if numeric else []), *encoding_stages(categorical),
        VectorAssembler(inputCols=parts, outputCol=FEATURES),
    ])


def feature_names(
    prepared: PipelineModel, numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> list[str]:
    """Names of the vector slots, categories spelled out."""
    indexer = next(s for s in prepared.stages if isinstance(s, StringIndexerModel))
    names = list(numeric)
    for column, labels in zip(categorical, indexer.labelsArray):
        names += [f"{column}_{label}" for label in labels]
    return names


# ---- models -------------------------------------------------------------------------------


def classifier(model: str, **overrides):
    """Unfitted classifier with its default size; overrides are Spark ML parameters."""
    common = {"labelCol": LABEL, "featuresCol": FEATURES, "weightCol": WEIGHT}
    if model == LOGISTIC:
        return LogisticRegression(**{**common, "maxIter": 2000, "regParam": 1e-4,
                                     "tol": 1e-9, **overrides})
    common["seed"] = SEED
    if model == FOREST:
        return RandomForestClassifier(**{
            **common, "numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 5, **overrides
        })
    if model == BOOSTED:
        return GBTClassifier(**{
            **common, "maxIter": 300, "maxDepth": 6, "stepSize": 0.05,
            "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", **overrides,
        })
    raise ValueError(f"model must be one of: {[LOGISTIC, FOREST, BOOSTED]}")


def stored(spark: SparkSession, fitted):
    """The fitted model read back from shared storage.

    A fresh fit may carry its training summary, and with it a session that cannot travel to
    executors; the stored model is only its parameters.
    """
    path = fresh_path(spark, "model")
    fitted.write().save(path)
    return type(fitted).load(path)


def _numeric(drop_leaky: bool) -> list[str]:
    return [c for c in NUMERIC_FEATURES if not (drop_leaky and c in LEAKY_FEATURES)]


def prepare(features: DataFrame, drop_leaky: bool = False) -> tuple[PipelineModel, DataFrame]:
    """The preparation fitted on the training side, and key, split, label and vector of all rows.

    Nothing of it depends on the classifier, so it is stored under a name made of the rows, like a
    fit (``fitted_once``), and read back by every further model over the same rows.
    """
    spark = features.sparkSession
    path = f"{own_folder(spark)}/prepared/{digest(features, drop_leaky)}"
    if not exists(spark, f"{path}/ready/_SUCCESS"):
        rows = with_split(impute(features, _numeric(drop_leaky))).persist()
        try:
            train = rows.where("is_train")
            prepared = feature_pipeline(train, _numeric(drop_leaky)).fit(train)
            prepared.write().overwrite().save(f"{path}/pipeline")
            kept = prepared.transform(rows).select(
                "customer_unique_id", "is_train", LABEL, FEATURES)
            kept.write.mode("overwrite").parquet(f"{path}/ready")
        finally:
            rows.unpersist()
    return PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/ready")


def fit(
    features: DataFrame, model: str = FOREST, drop_leaky: bool = False, **overrides
) -> tuple[PipelineModel, object, DataFrame]:
    """Fit preparation and classifier on the training side.

    Returns the fitted preparation, the fitted classifier and all rows with their features.
    ``drop_leaky`` leaves out the inputs from which the label can be computed.
    """
    prepared, ready = prepare(features, drop_leaky)
    train = _dealt(_weighted(ready.where("is_train"), model)).select(
        LABEL, FEATURES, WEIGHT).persist()
    try:
        fitted = classifier(model, **overrides).fit(train)
    finally:
        train.unpersist()
    return prepared, stored(features.sparkSession, fitted), ready


class Fit(NamedTuple):
    """A stored fit: names of the vector slots, where the classifier lies, the classifier, all
    rows with their features, and all scores."""

    model: str
    names: list[str]
    path: str
    fitted: object
    ready: DataFrame
    scored: DataFrame


LOADERS = {
    LOGISTIC: LogisticRegressionModel, FOREST: RandomForestClassificationModel,
    BOOSTED: GBTClassificationModel,
}


def digest(rows: DataFrame, *more: object) -> str:
    """Name for these rows, in whatever order they come, and further settings."""
    hashed = F.xxhash64(*[F.col(c) for c in sorted(rows.columns)])
    found = rows.agg(F.count("*"), F.sum(hashed.cast("decimal(20,0)")), F.bit_xor(hashed)).first()
    return hashlib.sha256(repr((tuple(map(str, found)), more)).encode()).hexdigest()[:24]


def fitted_once(
    features: DataFrame, model: str = FOREST, drop_leaky: bool = False, **overrides
) -> Fit:
    """``fit`` under a name made of the rows and the settings, in the session's shared folder.

    A fit of the same rows is read back; other rows have another name, and what was released is
    fitted again. The names are written last, so half a fit is never taken for a whole one.
    """
    spark = features.sparkSession
    settings = (model, drop_leaky, sorted(overrides.items()))
    path = f"{own_folder(spark)}/fits/{digest(features, *settings)}"
    if not exists(spark, f"{path}/names/_SUCCESS"):
        prepared, fitted, ready = fit(features, model, drop_leaky, **overrides)
        names = list(enumerate(feature_names(prepared, _numeric(drop_leaky))))
        fitted.write().overwrite().save(f"{path}/classifier")
        scores(fitted, ready).write.mode("overwrite").parquet(f"{path}/scored")
        table = spark.createDataFrame(names, "slot int, name string").coalesce(1)
        table.write.mode("overwrite").parquet(f"{path}/names")
    names = spark.read.parquet(f"{path}/names").orderBy("slot").collect()
    return Fit(
        model, [r.name for r in names], f"{path}/classifier",
        LOADERS[model].load(f"{path}/classifier"),
        prepare(features, drop_leaky)[1], spark.read.parquet(f"{path}/scored"),
    )


def recomputed(found: Fit) -> DataFrame:
    """customer_unique_id, score: from the stored nodes or coefficients, without the classifier."""
    if found.model == LOGISTIC:
        chance = trees.linear_chance(
            FEATURES, found.fitted.coefficients.toArray(), found.fitted.intercept)
        return found.ready.select("customer_unique_id", chance.alias("score"))
    boosted = found.model == BOOSTED
    nodes = handed_over(trees.node_table(found.ready.sparkSession, found.path, boosted), "nodes")
    return trees.scored_by_nodes(
        found.ready, nodes, found.fitted.getOrDefault("maxDepth"), boosted)


def agreement(found: Fit, tolerance: float = 1e-9) -> DataFrame:
    """customer_unique_id, is_train, label, agrees: whether the recomputed score is the model's."""
    again = recomputed(found).withColumnRenamed("score", "_again")
    return found.scored.join(again, "customer_unique_id", "left").select(
        "customer_unique_id", "is_train", "label",
        F.coalesce(F.abs(F.col("score") - F.col("_again")) <= tolerance, F.lit(False))
        .alias("agrees"),
    )


def optimality(found: Fit) -> DataFrame:
    """feature, gradient of the training loss at the stored coefficients (``loss_gradient``)."""
    train = _weighted(found.ready.where("is_train"), LOGISTIC)
    return trees.loss_gradient(
        train, found.fitted.coefficients.toArray(), found.fitted.intercept,
        found.fitted.getOrDefault("regParam"), found.names, LABEL, WEIGHT, FEATURES,
    )


def importance_agreement(found: Fit, tolerance: float = 1e-9) -> DataFrame:
    """feature, agrees: the model's importances against those of its nodes or coefficients."""
    table = importance(found.fitted, found.names)
    if found.model == LOGISTIC:
        sizes = [(n, float(abs(c))) for n, c in zip(
            found.names, found.fitted.coefficientMatrix.toArray()[0])]
        again = table.sparkSession.createDataFrame(sizes, "feature string, _again double")
    else:
        boosted = found.model == BOOSTED
        nodes = handed_over(trees.node_table(table.sparkSession, found.path, boosted), "nodes")
        place = F.get(F.array(*[F.lit(n) for n in found.names]), F.col("feature"))
        again = trees.importance_by_nodes(nodes, boosted).select(
            place.alias("feature"), F.col("importance").alias("_again"))
    again = F.broadcast(again)  # one row per slot
    return table.join(again, "feature", "left").select(
        "feature",
        (F.abs(F.col("importance") - F.coalesce("_again", F.lit(0.0))) <= tolerance)
        .alias("agrees"),
    )


def scores(fitted, ready: DataFrame) -> DataFrame:
    """Churn probability of every row, as the model gives it."""
    chance = vector_to_array("probability").getItem(1)
    return fitted.transform(ready).select(
        "customer_unique_id", "is_train", F.col(LABEL).alias("label"), chance.alias("score"),
    )


# ---- evaluation ---------------------------------------------------------------------------
# Metrics are taken on the scores as they are. Rows of one score are counted first; cumulative
# counts run over slices of the ordered scores (``ranking``), never over a window in one task.


def _curve(scored: DataFrame, falling: bool) -> DataFrame:
    """Per distinct score: both counts, and both counts of everything up to it in the order."""
    counts = scored.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("ones"),
        F.count_if(F.col("label") == 0).alias("zeros"),
    )
    by = F.desc("score") if falling else F.asc("score")
    return with_running_totals(counts, [by], {"ones": "ones_upto", "zeros": "zeros_upto"})


def best_threshold(scored: DataFrame) -> DataFrame:
    """Score at which calling everything up to it retained gives the best F1 of that class."""
    curve = _curve(scored, falling=False)
    whole = scored.agg(F.count_if(F.col("label") == 0)).scalar()
    f1 = ratio(F.col("zeros_upto") * 2, F.col("zeros_upto") + F.col("ones_upto") + F.col("_zeros"))
    return curve.withColumn("_zeros", whole).withColumn("f1", f1).agg(
        F.coalesce(
            F.max_by(F.when(F.col("f1") > 0, F.col("score")), F.struct("f1", "score")),
            F.lit(0.5),
        ).alias("threshold"),
        F.max("f1").alias("best_f1"),
    )


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every score, highest score first."""
    curve = _curve(scored, falling=True)
    sizes = scored.agg(
        F.struct(F.count_if(F.col("label") == 0).alias("zeros"),
                 F.count_if(F.col("label") == 1).alias("ones"))
    ).scalar()
    return curve.withColumn("_sizes", sizes).select(
        "score",
        rounded(ratio("zeros_upto", F.col("_sizes")["zeros"]), 8).alias("fpr"),
        rounded(ratio("ones_upto", F.col("_sizes")["ones"]), 8).alias("tpr"),
    ).orderBy(F.desc("score"))


def ranking_quality(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve and average precision, from the score counts."""
    curve = _curve(scored, falling=True)
    ones, zeros = F.sum("ones"), F.sum("zeros")
    # pairs won: positives against the negatives scored below, ties count half
    above = F.col("zeros_upto") - F.col("zeros") * 0.5
    lost = F.sum(F.col("ones") * above)
    precision = ratio("ones_upto", F.col("ones_upto") + F.col("zeros_upto"))
    gained = F.sum((F.col("ones") * precision).cast("decimal(38,12)")).cast("double")
    return curve.agg(
        (F.lit(1.0) - ratio(lost, ones * zeros)).alias("roc_auc"),
        ratio(gained, ones).alias("average_precision"),
    )


def threshold_quality(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """Accuracy, F1 of both classes and recall of the retained at a threshold."""
    called = F.col("score") >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    one = F.col("label") == 1
    cells = scored.agg(
        F.count_if(one & called).alias("hit"), F.count_if(one & ~called).alias("missed"),
        F.count_if(~one & called).alias("false_alarm"), F.count_if(~one & ~called).alias("clear"),
    )
    hit, missed = F.col("hit"), F.col("missed")
    alarm, clear = F.col("false_alarm"), F.col("clear")
    f1_one = F.coalesce(ratio(hit * 2, hit * 2 + alarm + missed), F.lit(0.0))
    f1_zero = F.coalesce(ratio(clear * 2, clear * 2 + alarm + missed), F.lit(0.0))
    return cells.select(
        ratio(hit + clear, hit + missed + alarm + clear).alias("accuracy"),
        ((f1_one + f1_zero) / 2).alias("f1_macro"),
        f1_zero.alias("f1_retained"),
        F.coalesce(ratio(clear, clear + alarm), F.lit(0.0)).alias("recall_retained"),
    )


def evaluation(scored: DataFrame, digits: int = 4) -> DataFrame:
    """One row with every metric at the best threshold."""
    scored = handed_over(scored.select("label", "score"))  # read by each of the three parts
    threshold = best_threshold(scored).select("threshold").scalar()
    quality = ranking_quality(scored).agg(
        F.struct(F.first("roc_auc").alias("roc_auc"),
                 F.first("average_precision").alias("average_precision"))
    ).scalar()
    merged = threshold_quality(scored, threshold).withColumns(
        {"_quality": quality, "threshold": threshold}
    ).withColumns({c: F.col("_quality")[c] for c in ("roc_auc", "average_precision")})
    return merged.select(
        *[rounded(c, digits).alias(c) for c in (
            "roc_auc", "average_precision", "f1_macro", "f1_retained", "recall_retained",
            "accuracy",
        )],
        rounded("threshold", 3).alias("threshold"),
    )


def comparison(scored: Mapping[str, DataFrame]) -> DataFrame:
    """Metrics of several models on the same held-out rows, best ROC-AUC first."""
    rows = [evaluation(df).withColumn("model", F.lit(name)) for name, df in scored.items()]
    table = reduce(DataFrame.unionByName, rows)
    return table.select("model", *[c for c in table.columns if c != "model"]).orderBy(
        F.desc("roc_auc"), F.desc("average_precision"), "model"
    )


def importance(fitted, names: Sequence[str]) -> DataFrame:
    """Importance of every vector slot: tree gains, or the size of the coefficients."""
    values = (
        fitted.featureImportances if hasattr(fitted, "featureImportances")
        else fitted.coefficients
    )
    rows = [(name, float(abs(v))) for name, v in zip(names, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def top_features(table: DataFrame, limit: int = 20) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(limit)


def predictions(scored: DataFrame, threshold: DataFrame, model_name: str) -> DataFrame:
    """Score file: probability, label at the threshold, model and time."""
    bound = threshold.select("threshold").scalar()
    return scored.select(
        "customer_unique_id",
        F.round("score", 6).alias("churn_probability"),
        (F.col("score") >= bound).cast("int").alias("predicted_label"),
        F.lit(model_name).alias("model_name"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
        .alias("prediction_generated_at"),
    )
