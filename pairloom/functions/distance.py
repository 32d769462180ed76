"""Distances over named fields (mixed-type Gower) and over equal-length arrays.

Each one is a column expression for pairs of rows. ``Metric.to_centres`` is the same distance for batches
of points against a table of centres, as array arithmetic inside a task: a point meets every centre
there, which interpreted array lambdas would do a hundred times slower.

Inputs hold no NULL; the operators put the -1 code in its place first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

# Distances are compared after rounding, so ties do not depend on summation order.
PLACES = 9


def gower_similarity(
    x: Callable[[str], Column],
    y: Callable[[str], Column],
    categorical: Sequence[str],
    numeric: Sequence[str],
    ranges: Callable[[str], Column],
) -> Column:
    """Mean over fields: equality for categoricals, ``1 - |x - y| / range`` for numerics.

    A numeric field whose range is 0 counts as fully similar. ``x``, ``y`` and ``ranges`` map a
    field name to its column.
    """
    if not (categorical or numeric):
        raise ValueError("no fields to compare")
    terms = [(x(f) == y(f)).cast("double") for f in categorical]
    for f in numeric:
        terms.append(F.when(ranges(f) == 0, F.lit(1.0)).otherwise(1.0 - F.abs(x(f) - y(f)) / ranges(f)))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / F.lit(float(len(terms)))


def gower_distance(*args, **kwargs) -> Column:
    """``1 / (1 + similarity)``: 0.5 for identical rows, 1 for fully different ones."""
    return F.lit(1.0) / (F.lit(1.0) + gower_similarity(*args, **kwargs))


def sq_euclidean(x: Column, y: Column) -> Column:
    """Sum of squared differences of two arrays."""
    return F.aggregate(
        F.zip_with(x, y, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def hamming(x: Column, y: Column) -> Column:
    """Number of differing components of two arrays."""
    return F.aggregate(
        F.zip_with(x, y, lambda a, b: (~a.eqNullSafe(b)).cast("int")), F.lit(0), lambda acc, v: acc + v
    )


def hamming_fields(x: Callable[[str], Column], y: Callable[[str], Column], fields: Sequence[str]) -> Column:
    """Number of differing named fields."""
    total = F.lit(0)
    for f in fields:
        total = total + (~x(f).eqNullSafe(y(f))).cast("int")
    return total


def cosine(x: Column, y: Column) -> Column:
    """``1 - cos(x, y)``; 1 when either array has no length."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(
            F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v
        )

    return F.lit(1.0) - F.coalesce(F.try_divide(dot(x, y), F.sqrt(dot(x, x) * dot(y, y))), F.lit(0.0))


ARRAY_DISTANCES: dict[str, Callable[[Column, Column], Column]] = {
    "sq_euclidean": sq_euclidean,
    "hamming": hamming,
    "cosine": cosine,
}


@dataclass(frozen=True)
class Metric:
    """A distance chosen by name, applied to two rows given as ``field name -> column``."""

    name: str
    fields: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    ranges: Mapping[str, float] | None = None

    def __call__(self, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        self.check()
        if self.name == "gower":
            d = gower_distance(x, y, list(self.categorical), self.numeric, lambda f: F.lit(float(self.ranges[f])))
        else:
            if len(self.fields) == 1:
                a, b = x(self.fields[0]), y(self.fields[0])
            else:
                a, b = (F.array(*[side(f).cast("double") for f in self.fields]) for side in (x, y))
            d = ARRAY_DISTANCES[self.name](a, b)
        return F.round(d.cast("double"), PLACES)

    @property
    def numeric(self) -> list[str]:
        return [f for f in self.fields if f not in self.categorical]

    def check(self) -> None:
        if self.name == "gower":
            missing = [f for f in self.numeric if f not in (self.ranges or {})]
            if missing:
                raise ValueError(f"no value range for numeric fields {missing}")
        elif self.name not in ARRAY_DISTANCES:
            raise ValueError(f"unknown distance {self.name!r}; choose gower or one of {sorted(ARRAY_DISTANCES)}")

    def matrix(self, frame: pd.DataFrame) -> np.ndarray:
        """The arrays of a batch as rows."""
        if len(self.fields) == 1:
            return np.array(frame[self.fields[0]].tolist(), dtype=float)
        return frame[list(self.fields)].to_numpy(float)

    def to_all(self, points: pd.DataFrame, centres: pd.DataFrame) -> np.ndarray:
        """(points x centres) distances."""
        return np.array(list(self.to_centres(points, centres))).reshape(len(centres), len(points)).T

    def to_centres(self, points: pd.DataFrame, centres: pd.DataFrame) -> Iterator[np.ndarray]:
        """For every centre in turn, its distance to each point of the batch."""
        if self.name == "gower":
            # categories become positions in the centre's own list, so comparing them is comparing numbers
            pairs = []
            for f in self.categorical:
                known = pd.Index(centres[f].unique())
                pairs.append((known.get_indexer(points[f]), known.get_indexer(centres[f])))
            numbers = [
                (points[f].to_numpy(float), centres[f].to_numpy(float), self.ranges[f]) for f in self.numeric
            ]
            for i in range(len(centres)):
                same = np.zeros(len(points))
                for p, c in pairs:
                    same += p == c[i]
                for p, c, span in numbers:
                    same += 1.0 - np.abs(p - c[i]) / span if span else 1.0
                yield np.round(1.0 / (1.0 + same / len(self.fields)), PLACES)
            return

        x = self.matrix(points)
        lengths = np.sqrt((x * x).sum(axis=1)) if self.name == "cosine" else None
        for c in self.matrix(centres):
            if self.name == "sq_euclidean":
                d = ((x - c) ** 2).sum(axis=1)
            elif self.name == "hamming":
                d = (x != c).sum(axis=1).astype(float)
            else:
                scale = lengths * np.sqrt(c @ c)
                d = 1.0 - np.divide(x @ c, scale, out=np.zeros(len(x)), where=scale > 0)
            yield np.round(d, PLACES)
