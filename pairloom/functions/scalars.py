"""Row-level column expressions: sentinels, ages, ratios, scaling, log-likelihood."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

LOG_LIKELIHOOD_FLOOR = -100.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_token(c: Column | str) -> Column:
    """The text ``null`` in any case (and empty text) as SQL NULL."""
    text = F.trim(_col(c))
    return F.when((F.lower(text) == "null") | (text == ""), None).otherwise(text)


def age_years(birth: Column | str, asof: Column | str) -> Column:
    """``year(asof) - year(birth)`` for ``yyyy-MM-dd`` text; dash-free text is already an age.

    Whatever cannot be parsed is 0. ``asof`` is a date column or a date literal, never the clock.
    """
    text = _col(birth).cast("string")
    on = F.to_date(F.lit(asof)) if isinstance(asof, str) else asof
    day = F.try_to_timestamp(text, F.lit("yyyy-M-d"))
    years = F.when(F.instr(text, "-") == 0, text.try_cast("int")).otherwise(F.year(on) - F.year(day))
    return F.coalesce(years, F.lit(0))


def response_label(
    resp: Column | str,
    positives: Sequence,
    negatives: Sequence,
    default: int | None = None,
) -> Column:
    """1 for positive codes, 0 for negative ones, ``default`` otherwise. Positive wins when in both."""
    c = _col(resp)
    label = F.when(c.isin(list(positives)), 1).when(c.isin(list(negatives)), 0)
    return (label if default is None else label.otherwise(default)).cast("int")


def share(a: Column | str, b: Column | str) -> Column:
    """``a / (a + b)``, 0 when the sum is not positive."""
    a, b = _col(a), _col(b)
    return F.when(a + b > 0, a / (a + b)).otherwise(F.lit(0.0))


def per(a: Column | str, b: Column | str) -> Column:
    """``a / b``, 0 when ``b`` is not positive."""
    a, b = _col(a), _col(b)
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def max_scaled(x: Column | str, top: Column) -> Column:
    """``x / top``, 0 when either is 0."""
    x = _col(x)
    return F.when((x == 0) | (top == 0), F.lit(0.0)).otherwise(x / top)


def mean_centred(x: Column | str, mean: Column) -> Column:
    """``x - mean``, 0 when either is 0."""
    x = _col(x)
    return F.when((x == 0) | (mean == 0), F.lit(0.0)).otherwise(x - mean)


def log_scaled(x: Column | str) -> Column:
    """Natural logarithm, NULL for values that have none."""
    x = _col(x)
    return F.when(x > 0, F.log(x))


def log_likelihood(label: Column | str, p: Column | str) -> Column:
    """``y ln p + (1 - y) ln(1 - p)`` for one row, floored at -100."""
    label, p = _col(label), _col(p)
    chosen = F.when(label == 1, p).otherwise(1 - p)
    return F.when(chosen.isNull(), None).otherwise(
        F.greatest(F.lit(LOG_LIKELIHOOD_FLOOR), F.when(chosen > 0, F.log(chosen)))
    )
