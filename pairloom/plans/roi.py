"""What a channel brings in: grouped sums, hold-out split, model of the total."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from pairloom.operators.evaluate import auc, confusion_matrix, regression_report
from pairloom.operators.features import feature_hasher
from pairloom.operators.models import LAMBDA, PASSES, LogisticSpec, score_logistic, train_logistic
from pairloom.operators.splits import grouped_sum, holdout_split
from pairloom.session import store


@dataclass(frozen=True)
class RoiReport:
    model: PipelineModel
    scored: DataFrame
    reports: dict[str, DataFrame]


def roi_groups(
    rows: DataFrame, key: str, group: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Rows split by key, measures summed per (split, group)."""
    return grouped_sum(holdout_split(rows, key), group, measures)


def roi_model(
    groups: DataFrame,
    group: Sequence[str],
    predictors: Sequence[str],
    target: str = "total",
    cut: float | None = None,
    passes: int = PASSES,
    features: int = 1000,
    lam: float = LAMBDA,
    tol: float = 1e-6,
) -> RoiReport:
    """With ``cut``: a logistic model of ``target > cut`` and its AUC and confusion. Without: an
    L1-regularised linear model of the target and its error report."""
    rows = store(groups)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    if cut is not None:
        spec = LogisticSpec("label", tuple(group), tuple(predictors), features)
        labelled = F.when(F.col(target) > cut, 1).otherwise(0).alias("label")
        model = train_logistic(train.select("*", labelled), spec, passes, lam, tol)
        scored = store(score_logistic(model, test.select("*", labelled), spec))
        return RoiReport(
            model,
            scored,
            {"auc": auc(scored, "label", "score"), "confusion": confusion_matrix(scored, "label", "score")},
        )
    texts = {c: F.col(c).cast("string") for c in group}
    model = Pipeline(
        stages=[
            feature_hasher(group, predictors, features),
            LinearRegression(labelCol=target, elasticNetParam=1.0, regParam=lam, maxIter=passes, tol=tol),
        ]
    ).fit(train.withColumns(texts))
    scored = store(model.transform(test.withColumns(texts)).drop("features").withColumnRenamed("prediction", "score"))
    return RoiReport(model, scored, {"regression": regression_report(scored, target, "score")})
