"""Row filters and column policies. All are stateless, so they also run on streaming frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.scalars import age_years, response_label
from pairloom.spec import DatasetSpec, Range

NULL_CODE = -1


def in_range(r: Range) -> Column:
    """One inclusive range, NULL counting as -1, written so the scan can push it down."""
    c = F.col(r.column)
    tests = [c >= r.low] if r.low is not None else []
    tests += [c <= r.high] if r.high is not None else []
    if not tests:
        return F.lit(True)
    inside = reduce(and_, tests)
    null_fits = (r.low is None or r.low <= NULL_CODE) and (r.high is None or r.high >= NULL_CODE)
    return inside | c.isNull() if null_fits else inside


def in_ranges(df: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """Rows whose every configured column lies in its range."""
    return df.where(reduce(and_, [in_range(r) for r in ranges])) if ranges else df


def valid_profile(df: DataFrame) -> DataFrame:
    """Usable profiles: height > 0, 0 < age < 100, sex 0 or 1, 0 < marriage < 10. NULL fails."""
    return df.where(
        (F.col("height") > 0)
        & (F.col("age") > 0)
        & (F.col("age") < 100)
        & F.col("sex").isin(0, 1)
        & (F.col("marriage") > 0)
        & (F.col("marriage") < 10)
    )


def drop_self_pairs(df: DataFrame, a: str = "aid", b: str = "bid") -> DataFrame:
    return df.where(F.col(a) != F.col(b))


def valid_payment(df: DataFrame, asof: str, birthday: str = "birthday", marriage: str = "marriage") -> DataFrame:
    """Payment rows with marriage in 0..10 and an age in 1..99; the birthday column becomes the age."""
    return (
        df.where(F.col(marriage).between(0, 10))
        .withColumn(birthday, age_years(birthday, asof))
        .where(F.col(birthday).between(1, 99))
    )


def unconverted_only(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is not 1, the ones left to score."""
    return df.where(F.col(target) != 1)


def drop_ignored(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.drop(*spec.ignored)


def null_to(df: DataFrame, sentinel, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL replaced by a sentinel of each column's own type (-1 for profiles, 0 for payments)."""
    chosen = set(columns or df.columns)
    fields = df.schema
    return df.select(
        [
            F.coalesce(F.col(c), F.lit(sentinel).cast(fields[c].dataType)).alias(c) if c in chosen else F.col(c)
            for c in df.columns
        ]
    )


def project_role(
    df: DataFrame, fields: Sequence[str], prefix: str, keep: Sequence[str] = ()
) -> DataFrame:
    """A role's feature list in configured order, NULL as -1, names prefixed; ``keep`` stays as is."""
    types = df.schema
    return df.select(
        *keep,
        *[F.coalesce(F.col(f), F.lit(NULL_CODE).cast(types[f].dataType)).alias(prefix + f) for f in fields],
    )


def label_response(
    df: DataFrame,
    resp: str,
    positives: Sequence,
    negatives: Sequence,
    default: int | None = None,
    name: str = "label",
) -> DataFrame:
    """Adds the 1/0 label. Other codes are dropped, or kept with ``default`` when it is given."""
    if default is None:
        df = df.where(F.col(resp).isin([*positives, *negatives]))
    return df.withColumn(name, response_label(resp, positives, negatives, default))


def split_by_gender(df: DataFrame, gender: str = "sex") -> dict[str, DataFrame]:
    """Male (0) and female (1) rows without the gender column, NULL as -1."""
    filled = null_to(df, NULL_CODE, [c for c in df.columns if c != gender])
    return {
        side: filled.where(F.col(gender) == code).drop(gender) for side, code in (("male", 0), ("female", 1))
    }


def key_by_gender_city(
    df: DataFrame, gender: str = "sex", city: str = "workcity", id: str = "userid"
) -> DataFrame:
    """Profiles keyed by (gender, city) with the rest as a feature struct, NULL as -1."""
    rest = [c for c in df.columns if c not in (gender, city, id)]
    filled = null_to(df, NULL_CODE, rest)
    return filled.select(gender, city, id, F.struct(*rest).alias("features"))
