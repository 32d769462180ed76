"""Train/test splits as functions of a record key, and grouped sums over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Which tenths of the key space each class sends where.
POSITIVE_TRAIN = (0, 2, 3, 4, 6, 8, 9)
NEGATIVE_TRAIN = (7,)
NEGATIVE_TEST = (5,)
HOLDOUT_TEST = (0, 2, 4)


def bucket(key: str) -> Column:
    return F.pmod(F.col(key), F.lit(10))


def modulo_split(
    df: DataFrame,
    key: str,
    target: str,
    positive_train: Sequence[int] = POSITIVE_TRAIN,
    negative_train: Sequence[int] = NEGATIVE_TRAIN,
    negative_test: Sequence[int] = NEGATIVE_TEST,
) -> DataFrame:
    """Adds ``split``. Positives go to train or test by bucket; of the negatives only the listed
    buckets are kept, which is the down-sampling."""
    positive, b = F.col(target) == 1, bucket(key)
    split = (
        F.when(positive & b.isin(list(positive_train)), "train")
        .when(positive, "test")
        .when(b.isin(list(negative_train)), "train")
        .when(b.isin(list(negative_test)), "test")
    )
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def holdout_split(df: DataFrame, key: str, test: Sequence[int] = HOLDOUT_TEST) -> DataFrame:
    """Adds ``split``: the listed buckets are test, all others train."""
    return df.withColumn("split", F.when(bucket(key).isin(list(test)), "test").otherwise("train"))


def grouped_sum(df: DataFrame, group: Sequence[str], measures: Sequence[str], split: str = "split") -> DataFrame:
    """Measures summed per (split, group columns)."""
    return df.groupBy(split, *group).agg(*[F.sum(m).alias(m) for m in measures])


def split_counts(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    return df.groupBy(split, label).agg(F.count("*").alias("cnt"))
