"""Comparing two row sets block by block, without a cross join and without a hot task.

Rows of a key are spread over ``ceil(rows / block)`` hash blocks, so a key with a third of all rows
simply has more blocks. Every (left block, right block) of a key meets in one task of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.session import broadcast_if_small


def _one_key(key: Sequence[str]) -> Column:
    """All key columns as one value that is never NULL, so rows with NULL keys meet, too."""
    return F.to_json(F.struct(*key), {"ignoreNullFields": "false"})


def _block_counts(df: DataFrame, key: Sequence[str], block: int, name: str) -> DataFrame:
    return df.groupBy(_one_key(key).alias("_key")).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))


def pair_blocks(left: DataFrame, right: DataFrame, key: Sequence[str], left_id: str, right_id: str, block: int = 1024) -> DataFrame:
    """Every pair of rows that share ``key``, whose columns are only taken from ``left``: blocks of about ``block`` rows meet
    each other by an equi-join, in as many parts as there are pairs of blocks (4,096 at most), so few keys keep all cores busy."""
    counts = _block_counts(left, key, block, "_ln").join(_block_counts(right, key, block, "_rn"), "_key")
    sizes = broadcast_if_small(counts)
    met = sizes.agg(F.sum(F.col("_ln").cast("double") * F.col("_rn"))).first()[0] or 1
    parts = int(min(4096, max(8, 2 * met)))

    def spread(df: DataFrame, row_id: str, own: str, count: str, other: str, other_count: str) -> DataFrame:
        # the key of the sizes: a key that is one known value in ``df`` would be left out of the join, which is then dealt anew
        met = df.withColumn("_own", _one_key(key)).join(sizes, F.col("_own") == F.col("_key")).drop("_own")
        placed = met.withColumn(own, F.pmod(F.xxhash64(row_id), F.col(count)).cast("int"))
        copies = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)))
        return copies.drop("_ln", "_rn").repartition(parts, "_key", "_lb", "_rb")

    lhs = spread(left, left_id, "_lb", "_ln", "_rb", "_rn")
    rhs = spread(right, right_id, "_rb", "_rn", "_lb", "_ln").drop(*key)
    return lhs.join(rhs.hint("shuffle_hash"), ["_key", "_lb", "_rb"]).drop("_key", "_lb", "_rb")


def compare_blocks(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    row_id: str,
    compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block: int = 1024,
    left_block: int | None = None,
    symmetric: bool = False,
) -> DataFrame:
    """Run ``compare`` on every pair of blocks that share ``key``.

    ``row_id`` is the column rows are spread by. ``compare`` sees the block numbers as ``_lb``/``_rb``.
    A NULL in a key column is a value like any other. Blocks hold about ``block`` rows, those of the left side ``left_block`` when it is given. With
    ``symmetric`` only block pairs with ``_lb <= _rb`` are formed.
    """
    counts = _block_counts(left, key, left_block or block, "_ln").join(
        _block_counts(right, key, block, "_rn"), "_key"
    )
    # one row per key: sent along when there are few keys, so that one hot key is not shuffled to one place
    sizes = broadcast_if_small(counts)

    def spread(df: DataFrame, own: str, count: str, other: str, other_count: str) -> DataFrame:
        placed = df.withColumn("_key", _one_key(key)).join(sizes, "_key").withColumn(
            own, F.pmod(F.xxhash64(row_id), F.col(count)).cast("int")
        )
        copies = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)))
        if symmetric:
            copies = copies.where(F.col("_lb") <= F.col("_rb"))
        return copies.drop("_ln", "_rn")

    on = ["_key", "_lb", "_rb"]
    lhs = spread(left, "_lb", "_ln", "_rb", "_rn").groupBy(*on)
    placed = spread(right, "_rb", "_rn", "_lb", "_ln")
    # both sides may come from one table; fresh names keep their columns apart
    rhs = placed.toDF(*placed.columns).groupBy(*on)
    return lhs.cogroup(rhs).applyInPandas(compare, schema)
