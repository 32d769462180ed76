"""Ranks and running totals over groups of any size, samples, and the best matches per user."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import store


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, Column | str] | None = None
) -> DataFrame:
    """Adds ``pos`` (0-based rank by ``order`` inside ``group``) and, per entry of ``sums``, the total
    of that column over all earlier rows of the group.

    No group is ever gathered in one task: rows are range-partitioned by (group, order), ranks are
    taken inside each partition, and every partition is shifted by what its group has in earlier
    partitions, a table of one row per (partition, group). ``order`` must tell all rows apart.
    """
    sums = dict(sums or {})
    spread = df.repartitionByRange(*[F.col(c) for c in [*group, *order]])
    # the partition number must be the same in both uses below, hence written down once
    placed = store(spread.withColumn("_part", F.spark_partition_id()))

    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part", *group).agg(
        F.count("*").alias("_rows"), *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    )
    shift = totals.select(
        "_part",
        *group,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    here = Window.partitionBy("_part", *group).orderBy(*order)
    above = here.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(
        "*",
        (F.row_number().over(here) - 1).alias("_pos"),
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_local_{n}") for n, c in sums.items()],
    )
    # NULL-safe keys: a group column may hold NULL
    joined = local.alias("l").join(
        shift.alias("s"),
        [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) if k != "_part" else F.col("l._part") == F.col("s._part")
         for k in ["_part", *group]],
    )
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("_pos") + F.col("_rows_before")).cast("bigint").alias("pos"),
        *[(F.col(f"_local_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums],
    )


def sample_k(df: DataFrame, id: str, k: int, seed: int = 42) -> DataFrame:
    """``k`` rows picked by the order of a seeded hash of their id: uniform, repeatable, and a top-k
    rather than a sort."""
    key = F.md5(F.concat_ws(":", F.col(id).cast("string"), F.lit(str(seed))))
    return df.orderBy(key, id).limit(k)


def top_matches(
    scored: DataFrame, user: str, other: str, score: str = "score", n: int = 30
) -> DataFrame:
    """The ``n`` best counterparts of every user, best first, ties by the lower counterpart id.

    Spark keeps only ``n`` rows per user in each input partition before the shuffle, so a user with
    very many candidates does not load one task.
    """
    best = Window.partitionBy(user).orderBy(F.desc(score), other)
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


#: pairs a task looks at together
PAIRS_AT_ONCE = 1 << 20


def _best_rows(user: np.ndarray, other: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` best rows of every user, ties by the lower ``other``."""
    order = np.lexsort((other, -score, user))
    at = user[order]
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, int)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return order[place < n]


def best_of_tasks(scored: DataFrame, left: str, right: str, score: str = "score", n: int = 30, threshold: float = 0.5) -> DataFrame:
    """``(user_id, other_id, score, pairs)``: what ``top_matches`` of either side's users can come from, so that scored pairs
    are neither written down nor shuffled. A task sends on the ``n`` best pairs it has of every user with a score of at least
    ``threshold``, once for each of the two users, and one row that only says how many pairs it has seen. Ids are whole numbers."""
    out = pa.schema([("user_id", pa.int64()), ("other_id", pa.int64()), ("score", pa.float64()), ("pairs", pa.int64())])

    def run(batches):
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        kept, fresh, waiting, seen = (none, none), [], 0, 0

        def fold(kept, fresh):
            found = []
            for side in (0, 1):
                user, other, s = (np.concatenate([k, *[f[i] for f in fresh]]) for i, k in zip((side, 1 - side, 2), kept[side]))
                best = _best_rows(user, other, s, n)
                found.append((user[best], other[best], s[best]))
            return tuple(found)

        for batch in batches:
            seen += len(batch)
            a, b, s = (batch[c].to_numpy(zero_copy_only=False) for c in (left, right, score))
            hit = s >= threshold
            fresh.append((a[hit], b[hit], s[hit]))
            waiting += int(hit.sum())
            if waiting >= PAIRS_AT_ONCE:
                kept, fresh, waiting = fold(kept, fresh), [], 0
        for user, other, s in fold(kept, fresh):
            yield pa.RecordBatch.from_arrays([pa.array(user), pa.array(other), pa.array(s), pa.nulls(len(user), pa.int64())], schema=out)
        yield pa.RecordBatch.from_pylist([{"pairs": seen}], schema=out)

    ids = [F.col(c).cast("bigint").alias(c) for c in (left, right)]
    return scored.select(*ids, F.col(score).cast("double").alias(score)).mapInArrow(run, "user_id bigint, other_id bigint, score double, pairs bigint")
