"""Bounded samples of labelled rows, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def held_out(id: str = "doc_id") -> F.Column:
    """True for rows whose labels must not be learned from: ``crc32(id as text) mod 4 = 2``."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, per_class: dict[int, int], id: str = "doc_id") -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Up to ``per_class[y]`` labelled ids of each class ``y``, by the order of a hash of the id, and the count
    of all rows of each class. Held-out ids, null ids and null labels are left out; the driver gets as many rows as
    the bounds allow."""
    rows = labels.where(~held_out(id) & F.col(id).isNotNull()).select(F.col(id).cast("bigint").alias("_id"), F.col(label).cast("int").alias("_y"))
    counts = {r._y: r.n for r in rows.where("_y is not null").groupBy("_y").agg(F.count("*").alias("n")).collect() if r._y in per_class}
    chosen: dict[int, int] = {}
    for y, most in per_class.items():
        order = F.xxhash64("_id", F.lit(1))
        chosen |= {r._id: y for r in rows.where(F.col("_y") == y).orderBy(order, "_id").limit(most).collect()}
    return sorted(chosen.items()), counts


def rows_of(docs: DataFrame, sample: list[tuple[int, int]], id: str = "doc_id") -> DataFrame:
    """The documents of a sample, with ``_y``. The sample is bounded, so it is broadcast."""
    table = docs.sparkSession.createDataFrame(sample, "_sid long, _y int")
    return docs.join(F.broadcast(table), F.col(id) == F.col("_sid"))
