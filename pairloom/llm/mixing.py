"""Mixing sources to target weights by hierarchical budgets.

A token budget is handed down a tree of domain, language and source. At each node it is split among the
children by integer weights, no child getting more than its subtree can give (its tokens times
``max_epochs``); what a child cannot use goes to its siblings by their weights, and only what all siblings
together cannot use stays with the parent, whose own siblings have then already taken it. A leaf with
quota ``q`` and ``t`` tokens repeats all its documents ``q div t`` times and fills the rest with the
longest prefix of one more epoch, in the order of a seeded hash, whose running total stays within it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import store

LEVELS = ("domain", "lang", "source")
BIG = "decimal(38,0)"


def word_count(c: Column | str) -> Column:
    """Tokens as white-space separated words; null has none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(None).cast("bigint")
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return F.coalesce(out, F.lit(1)).cast("bigint")


def leaf_quotas(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], share: tuple[int, int], max_epochs: int, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Quota in tokens of every leaf; ``leaves`` has one row per leaf with its ``tokens``.

    The budget is ``tokens * share[0] div share[1]`` of the whole table. All sums are integers; the
    tokens lost to integer division are fewer than the nodes.
    """
    level_rows = leaves.withColumn("_cap", F.col("tokens") * max_epochs)
    parents = None
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        above = path[:-1]
        nodes = level_rows.groupBy(*path).agg(F.sum("_cap").alias("_cap"), F.sum("tokens").alias("_tokens")).withColumn("_w", _weight(level, weights))
        whole = F.expr(f"(sum(_tokens) over ()) * {share[0]} div {share[1]}")  # over the few nodes below the root
        nodes = nodes.join(parents, above) if parents is not None else nodes.withColumn("_budget", whole)
        by_need = Window.partitionBy(*above).orderBy(F.col("_cap").cast(BIG) * F.lit(1_000_000_000) / F.col("_w"), level)
        earlier, all_ = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*above)
        nodes = (
            nodes.withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0)))
            .withColumn("_rest", F.sum("_w").over(all_) - F.coalesce(F.sum("_w").over(earlier), F.lit(0)))
            .withColumn("_full", F.col("_cap").cast(BIG) * F.col("_rest") <= F.col("_left").cast(BIG) * F.col("_w"))
            .withColumn("_open", F.col("_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(all_), F.lit(0)))
            .withColumn("_open_w", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(all_))
            .withColumn(
                "_budget", F.when(F.col("_full"), F.col("_cap")).otherwise(F.expr(f"cast((cast(_open as {BIG}) * _w) div _open_w as bigint)"))
            )
        )
        parents = nodes.select(*path, "_budget")
    return leaves.join(parents, list(levels)).withColumnRenamed("_budget", "quota")


def mix_to_weights(
    df: DataFrame, id: str, text: str, domain: Column, weights: Mapping[str, Mapping[str, int]], share: tuple[int, int],
    max_epochs: int = 1, seed: int = 7, buckets: int = 3,
) -> DataFrame:
    """The rows chosen, with ``domain`` string, ``n_tokens`` long and ``copies`` int (epochs it is in).

    ``df`` has ``lang`` and ``source``; null ones count as ``unknown`` in the tree and stay null in the
    row. Rows repeat in one row with ``copies``, never as several rows. Rows without words add nothing and
    are in the prefix as far as it reaches. Repeated rows are rows of their own, next to each other in the
    order. Input columns named like an output column are replaced.

    No leaf is sorted as a whole: the seeded order is the hex MD5 of (seed, epoch, id), summed per leaf
    and first ``buckets`` digits; only the one bucket in which the quota runs out is numbered.
    """
    added = ("domain", "n_tokens", "copies")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        F.coalesce(domain, F.lit("unknown")).alias("domain"),
        F.coalesce(F.col("lang"), F.lit("unknown")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("unknown")).alias("source"),
        word_count(text).alias("n_tokens"),
        F.coalesce(F.col(id).cast("string"), F.lit("null")).alias("_id"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_tie"),
    )
    leaf = list(LEVELS)
    quotas = leaf_quotas(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), weights, share, max_epochs)
    quotas = quotas.select(
        *leaf,
        F.expr("case when tokens = 0 then 0 else quota div tokens end").alias("_full_epochs"),
        F.expr("case when tokens = 0 then 0 else quota % tokens end").alias("_rest"),
    )
    # a row per leaf, written down: its size is known, and as long as it is small no text is shuffled by leaf
    keyed = rows.join(store(quotas), leaf).withColumn(
        "_key", F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("_full_epochs") + 1).cast("string"), F.col("_id")))
    ).withColumn("_bucket", F.substring("_key", 1, buckets))
    sums = keyed.groupBy(*leaf, "_bucket").agg(F.sum("n_tokens").alias("_in"), F.first("_rest").alias("_r"))
    running = Window.partitionBy(*leaf).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_in").over(running), F.lit(0)))
    edge = (
        sums.where(F.col("_before") + F.col("_in") > F.col("_r"))
        .groupBy(*leaf).agg(F.min(F.struct("_bucket", "_before")).alias("_edge"))
        .select(*leaf, F.col("_edge._bucket").alias("_edge_bucket"), F.col("_edge._before").alias("_edge_before"))
    )
    placed = keyed.join(store(edge), leaf, "left")  # no edge: the rest is zero words of an empty leaf
    upto = Window.partitionBy(*leaf).orderBy("_key", "_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.where(F.col("_bucket") == F.col("_edge_bucket")).withColumn("_in", F.col("_edge_before") + F.sum("n_tokens").over(upto) <= F.col("_rest"))
    outside = placed.where(F.col("_edge_bucket").isNull() | (F.col("_bucket") != F.col("_edge_bucket"))).withColumn("_in", F.coalesce(F.col("_bucket") < F.col("_edge_bucket"), F.lit(True)))
    partial = F.col("_in") & ((F.col("_rest") > 0) | (F.col("_full_epochs") == 0))
    chosen = inside.unionByName(outside).withColumn("copies", (F.col("_full_epochs") + partial.cast("int")).cast("int"))
    return chosen.where("copies > 0").select(
        *[F.col("_row").getField(c).alias(c) for c in df.columns if c not in added], "domain", "n_tokens", "copies"
    )
