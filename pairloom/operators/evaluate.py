"""Reports over scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.scalars import log_likelihood
from pairloom.operators.ordering import running_totals


def with_prediction(scored: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("predicted", (F.col(score) >= threshold).cast("int"))


def confusion_matrix(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """``(label, predicted, cnt)``."""
    return with_prediction(scored, score, threshold).groupBy(label, "predicted").agg(F.count("*").alias("cnt"))


def confusion_of(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, predicted, cnt)`` from a column that already holds the predicted label."""
    return predicted.groupBy(
        F.col(label).cast("int").alias(label), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count("*").alias("cnt"))


def accuracy(confusion: DataFrame, label: str) -> DataFrame:
    right = F.sum(F.when(F.col(label) == F.col("predicted"), F.col("cnt")).otherwise(0))
    return confusion.agg(F.sum("cnt").alias("total"), right.alias("right"),
                         F.try_divide(right, F.sum("cnt")).alias("accuracy"))


def auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``(auc, positives, negatives)``; tied scores count half, NULL when a class is missing.

    Rows collapse to one per distinct score before they are ordered, and the running count of negatives
    is taken by range partitions, so no task sees all scores.
    """
    per_score = scored.groupBy(F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("pos_n"), F.count_if(F.col(label) != 1).alias("neg_n")
    )
    run = running_totals(per_score, [], ["_score"], {"below": "neg_n"})
    wins = F.sum(F.col("pos_n") * (F.col("below") + F.col("neg_n") / 2))
    # doubles: the product of two class sizes may pass the range of a 64-bit integer
    cells = F.sum("pos_n").cast("double") * F.sum("neg_n").cast("double")
    return run.agg(
        F.try_divide(wins, cells).alias("auc"),
        F.sum("pos_n").alias("positives"),
        F.sum("neg_n").alias("negatives"),
    )


def entropy_matrix(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Mean log-likelihood per (label, predicted) cell."""
    return (
        with_prediction(scored, score, threshold)
        .groupBy(label, "predicted")
        .agg(F.avg(log_likelihood(label, score)).alias("entropy"))
    )


def regression_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows, mean absolute and squared error, bias and correlation of a numeric prediction (NULL when
    either column is constant)."""
    err = F.col(prediction) - F.col(label)
    spread = F.stddev_pop(prediction) * F.stddev_pop(label)
    return scored.agg(
        F.count("*").alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(err).alias("bias"),
        F.try_divide(F.covar_pop(prediction, label), spread).alias("corr"),
    )
