"""Who will pay: class distributions, down-sampled split, logistic or forest model, propensity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from pairloom.operators.clean import unconverted_only, valid_payment
from pairloom.operators.evaluate import accuracy, auc, confusion_matrix, confusion_of, entropy_matrix
from pairloom.operators.models import (
    LAMBDA,
    MAX_DEPTH,
    PASSES,
    TREES,
    LogisticSpec,
    score_forest,
    score_logistic,
    score_propensity,
    train_forest,
    train_logistic,
)
from pairloom.operators.splits import modulo_split
from pairloom.session import materialize, store
from pairloom.sources.tables import write_split
from pairloom.spec import DatasetSpec


@dataclass(frozen=True)
class Evaluation:
    """Reports over the test rows."""

    auc: DataFrame
    confusion: DataFrame
    entropy: DataFrame


def logistic_spec(spec: DatasetSpec, features: int = 1000) -> LogisticSpec:
    categorical, numeric = spec.split_roles([c for c in spec.model_columns() if c != spec.target])
    return LogisticSpec(spec.target, tuple(categorical), tuple(numeric), features)


def payment_split(payments: DataFrame, asof: str, key: str = "memberid", target: str = "iszat") -> DataFrame:
    """Valid payment rows with the age in place of the birthday, split and down-sampled by key."""
    return modulo_split(valid_payment(payments, asof), key, target)


def payment_logistic(
    split: DataFrame, spec: LogisticSpec, passes: int = PASSES, lam: float = LAMBDA, tol: float = 1e-6
) -> tuple[PipelineModel, DataFrame]:
    """Model and scored test rows."""
    rows = store(split)
    model = train_logistic(rows.where("split = 'train'"), spec, passes, lam, tol)
    return model, score_logistic(model, rows.where("split = 'test'"), spec)


def evaluate_scores(scored: DataFrame, label: str, threshold: float = 0.5) -> Evaluation:
    """AUC, confusion and entropy of scored rows."""
    rows = store(scored.select(label, "score"))
    return Evaluation(
        auc(rows, label, "score"),
        confusion_matrix(rows, label, "score", threshold),
        entropy_matrix(rows, label, "score", threshold),
    )


def payment_forest(
    split: DataFrame, spec: DatasetSpec, trees: int = TREES, seed: int = 42, max_depth: int = MAX_DEPTH
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model, confusion and accuracy on the test rows. NULL features count as 0."""
    features = [c for c in spec.model_columns() if c != spec.target]
    categorical, _ = spec.split_roles(features)
    rows = store(split.na.fill(0, features))
    model = train_forest(rows.where("split = 'train'"), spec.target, features, categorical, trees, max_depth, seed)
    confusion = materialize(confusion_of(score_forest(model, rows.where("split = 'test'")), spec.target, "prediction"))
    return model, confusion, accuracy(confusion, spec.target)


def payment_predict(
    model: PipelineModel,
    payments: DataFrame,
    spec: LogisticSpec,
    asof: str,
    threshold: float = 0.5,
    id: str = "memberid",
    city: str = "workcity",
    gender: str = "sex",
) -> DataFrame:
    """Non-payers with city, gender, target, score, log-likelihood and prediction."""
    rows = valid_payment(unconverted_only(payments, spec.label), asof)
    return score_propensity(model, rows, spec, [id, city, gender, spec.label], threshold)


def write_predictions(predicted: DataFrame, path: str) -> None:
    """Predicted payers and non-payers in directories of their own."""
    write_split(predicted.withColumn("predicted", F.col("predicted").cast("string")), "predicted", path,
                {"1": "pay", "0": "nopay"})
