"""Training, evaluation and scoring of binary classifiers with ``pyspark.ml``, on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import labels
from tidewell.functions.numbers import ratio
from tidewell.operators.monitor import SCORE
from tidewell.session import durable

VECTOR = "_features"
SEED = 42
# Minimum quality a model needs before it replaces another.
PROMOTION = {"roc_auc": 0.75, "precision": 0.60, "recall": 0.50}


# --- preparation ------------------------------------------------------------------------------


def _bucket(keys: Sequence[str], buckets: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(salt)), F.lit(buckets))


def stratified_split(
    df: DataFrame, keys: Sequence[str], share: float = 0.8, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by a hash of the key: repeatable, no shuffle, and independent of the
    label, so each label splits in about the same proportion."""
    in_train = _bucket(keys, 10_000, seed) < int(share * 10_000)
    return df.where(in_train), df.where(~in_train)


def fit_zscore(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregate over the training rows."""
    measures = [m for c in columns for m in (F.avg(c).cast("double"), F.stddev_pop(c).cast("double"))]
    row = train.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}


def zscore(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / deviation``; a constant column becomes 0."""
    scaled = {
        c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation or 1.0) for c, (mean, deviation) in scaling.items()
    }
    return df.withColumns(scaled)


def positive_weight(train: DataFrame, label: str, name: str = "_weight") -> DataFrame:
    """Weight negatives / positives on positive rows, 1 on the others."""
    row = train.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    weight = row["n"] / row["p"] if row["p"] else 1.0
    return train.withColumn(name, F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))


# --- training ---------------------------------------------------------------------------------


def _assembled(classifier: Estimator, features: Sequence[str]) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="keep")
    return Pipeline(stages=[assembler, classifier])


def logistic_regression(features: Sequence[str], label: str, penalty: float = 1e-3, **options) -> Pipeline:
    """L2-penalised; ``penalty`` is ``1 / (C * rows)`` of the C-parametrisation."""
    settings = {"maxIter": 1000, "regParam": penalty, "elasticNetParam": 0.0} | options
    return _assembled(LogisticRegression(featuresCol=VECTOR, labelCol=label, **settings), features)


def random_forest(features: Sequence[str], label: str, **options) -> Pipeline:
    """The node that a row has reached in each tree is kept from level to level; otherwise every level sends every row through every
    tree from its root. The forest is the same. A level follows from the one before, so none has to be written."""
    settings = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "seed": SEED, "cacheNodeIds": True, "checkpointInterval": -1} | options
    return _assembled(RandomForestClassifier(featuresCol=VECTOR, labelCol=label, **settings), features)


def gradient_boosting(features: Sequence[str], label: str, weight: str | None = "_weight", **options) -> Pipeline:
    """Boosted trees; the training rows carry the weight of :func:`positive_weight`."""
    settings = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": SEED} | options
    if weight:
        settings["weightCol"] = weight
    return _assembled(GBTClassifier(featuresCol=VECTOR, labelCol=label, **settings), features)


def cross_validate(
    train: DataFrame,
    pipeline: Pipeline,
    label: str,
    keys: Sequence[str],
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    parallelism: int = 2,
) -> tuple[CrossValidatorModel, DataFrame]:
    """The fitted validator and one row per parameter set with mean and deviation of the AUC.

    Folds come from a hash of the key, so every run uses the same ones.
    """
    classifier = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in (grid or {}).items():
        builder = builder.addGrid(getattr(classifier, name), list(values))
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    model = validator.fit(train.withColumn("_fold", _bucket(keys, folds, SEED + 1).cast("int")))
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in params.items()) or "default", float(mean), float(deviation))
        for params, mean, deviation in zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics)
    ]
    report = train.sparkSession.createDataFrame(rows, "params string, auc_mean double, auc_std double")
    return model, report


def importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Feature weights: impurity shares of trees, absolute coefficients of a linear model."""
    fitted = model.stages[-1]
    linear = hasattr(fitted, "coefficients")
    values = [abs(v) for v in fitted.coefficients] if linear else fitted.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def average_importance(reports: Sequence[DataFrame], n: int | None = None) -> DataFrame:
    """Mean importance over several models, greatest first."""
    stacked = reduce(DataFrame.unionByName, reports)
    mean = stacked.groupBy("feature").agg(F.avg("importance").alias("importance"))
    ranked = mean.orderBy(F.desc("importance"), "feature")
    return ranked.limit(n) if n else ranked


# --- evaluation -------------------------------------------------------------------------------


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with the four counts."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(yes & said).alias("true_positive"),
        F.count_if(~yes & said).alias("false_positive"),
        F.count_if(yes & ~said).alias("false_negative"),
        F.count_if(~yes & ~said).alias("true_negative"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1, six places; an undefined ratio is 0."""
    tp, fp = F.col("true_positive"), F.col("false_positive")
    fn, tn = F.col("false_negative"), F.col("true_negative")
    formulas = {
        "accuracy": (tp + tn, tp + tn + fp + fn),
        "precision": (tp, tp + fp),
        "recall": (tp, tp + fn),
        "f1_score": (2 * tp, 2 * tp + fp + fn),
    }
    return confusion(df, label, prediction).select(
        *[F.coalesce(ratio(top, bottom, 6), F.lit(0.0)).alias(n) for n, (top, bottom) in formulas.items()]
    )


def _score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, with running sums from the greatest score down.

    Scores are taken as they are, so there may be as many as rows. They are range-partitioned in order; sums run within
    a partition, and what lies above it is added from one row per partition.
    """
    groups = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
        .repartitionByRange(F.desc("threshold"))
    )
    placed = durable(groups.withColumn("_part", F.spark_partition_id()))
    parts = placed.groupBy("_part").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    above, whole = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    sums = parts.select(
        "_part",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_p", "_n")],
        F.sum("_p").over(whole).alias("positives"),
        F.sum("_n").over(whole).alias("negatives"),
    )
    down = W.partitionBy("_part").orderBy(F.desc("threshold")).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = {"tp": F.sum("p").over(down), "fp": F.sum("n").over(down)}
    joined = placed.withColumns(running).join(sums, "_part")
    moved = {"tp": F.col("tp") + F.col("_p_above"), "fp": F.col("fp") + F.col("_n_above")}
    return joined.withColumns(moved).drop("_part", "_p_above", "_n_above")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve: the chance that a positive outscores a negative, ties half."""
    won = F.col("n").cast("double") * (F.col("tp") - F.col("p") / 2.0)
    pairs = F.max("positives").cast("double") * F.max("negatives")
    area = F.sum(won) / F.nullif(pairs, F.lit(0.0))
    return _score_groups(df, label, score).agg(F.round(area, 6).alias("roc_auc"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct score."""
    return _score_groups(df, label, score).select(
        "threshold",
        ratio(F.col("fp"), F.col("negatives"), 6).alias("false_positive_rate"),
        ratio(F.col("tp"), F.col("positives"), 6).alias("true_positive_rate"),
    )


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall at every distinct score."""
    return _score_groups(df, label, score).select(
        "threshold",
        ratio(F.col("tp"), F.col("tp") + F.col("fp"), 6).alias("precision"),
        ratio(F.col("tp"), F.col("positives"), 6).alias("recall"),
    )


def compare(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """AUC per model, best first: ``{model name: score column}`` on the same rows."""
    parts = [roc_auc(df, label, column).select(F.lit(name).alias("model"), "roc_auc") for name, column in scores.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc_nulls_last("roc_auc"), "model")


def promotion_gate(quality: DataFrame, minimums: Mapping[str, float] = PROMOTION) -> DataFrame:
    """``promote`` is true when every metric reaches its minimum; a missing value blocks."""
    passed = [F.coalesce(F.col(m) >= F.lit(least), F.lit(False)) for m, least in minimums.items()]
    return quality.withColumn("promote", reduce(Column.__and__, passed))


# --- scoring ----------------------------------------------------------------------------------


def _audited(scored: DataFrame, model_name: str, stage: str) -> DataFrame:
    return scored.withColumns(
        {
            "churn_risk": labels.score_risk(F.col(SCORE)),
            "prediction_timestamp": F.current_timestamp(),
            "model_name": F.lit(model_name),
            "model_stage": F.lit(stage),
        }
    )


def score(df: DataFrame, model: PipelineModel, model_name: str = "churn", stage: str = "Production") -> DataFrame:
    """Probability (four places), risk class and audit columns for every row, inside the JVM."""
    kept = df.columns
    probability = F.round(vector_to_array("probability")[1], 4).alias(SCORE)
    return _audited(model.transform(df).select(*kept, probability), model_name, stage)


def save(model: PipelineModel, path: str) -> None:
    """Store a fitted model as a directory; a later job scores with :func:`load`."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


Predict = Callable[[pd.DataFrame], Sequence[float]]


def score_with_udf(
    df: DataFrame,
    features: Sequence[str],
    load: Callable[[], Predict],
    model_name: str = "churn",
    stage: str = "Production",
) -> DataFrame:
    """Like :func:`score` for a model that is not a Spark model.

    ``load`` runs once per task and returns the function that turns a batch of feature rows into
    probabilities; batches travel as Arrow.
    """

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model(batch), index=batch.index, dtype="float64")

    row = F.struct(*[F.col(f).cast("double").alias(f) for f in features])
    return _audited(df.withColumn(SCORE, F.round(predict(row), 4)), model_name, stage)
