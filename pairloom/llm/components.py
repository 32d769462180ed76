"""Connected components by alternating large and small stars, over links that never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.session import store


def _large(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    moved = down.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of long ids to (a, b): every node that is not the smallest of its component, with the
    smallest. Links of a node to itself are ignored; no links give an empty table. Both halves of a round are written to
    the shared folder, so nothing is recomputed when an executor is lost, and no plan has more than one join: the
    driver keeps a thread for every shuffle and broadcast of the last minute."""
    now = store(edges.select("a", "b").where("a <> b").distinct())
    state = _state(now)
    while state[0]:
        now = store(_small(store(_large(now))).where("a <> b").distinct())
        before, state = state, _state(now)
        if before == state:
            break
    return now
