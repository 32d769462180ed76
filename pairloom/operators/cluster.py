"""Nearest centres, cluster profiles, bands, k-means and split clustering."""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pairloom.functions.distance import Metric, sq_euclidean
from pairloom.operators.blocks import compare_blocks
from pairloom.operators.features import filled_slots
from pairloom.operators.nearest import assign_nearest, best_of
from pairloom.operators.ordering import running_totals, sample_k
from pairloom.session import broadcast_if_small, materialize, store

# Fixed value: a band holds what lies within this of its smallest distance.
BAND_DELTA = 0.01


# -- distances to known centres -----------------------------------------------------------------------


def item_distance(
    assigned: DataFrame, centres: DataFrame, item: str, vector: str = "features", centre_id: str = "centre_id"
) -> DataFrame:
    """``(cluster, item, distance)``: squared distance of each item to its own centre; items whose
    centre is unknown are dropped."""
    own = broadcast_if_small(centres.select(centre_id, F.col(vector).alias("_centre")))
    return assigned.join(own, centre_id).select(
        F.col(centre_id), item, sq_euclidean(F.col(vector), F.col("_centre")).alias("distance")
    )


def vector_distance(
    assigned: DataFrame, model: KMeansModel, item: str, vector: str = "features", centre_id: str = "centre_id"
) -> DataFrame:
    """``item_distance`` of sparse vectors, by their filled places only: the k centres are a looked-up table."""
    centres = cluster_centres(assigned.sparkSession, model, centre_id, "_centre")
    norm = F.aggregate("_centre", F.lit(0.0), lambda a, c: a + c * c)
    known = broadcast_if_small(centres.withColumn("_norm", norm))
    rest = lambda a, s: a + s["value"] * (s["value"] - 2 * F.get("_centre", s["slot"]))
    distance = F.greatest(F.lit(0.0), F.aggregate(filled_slots(vector), F.col("_norm"), rest))
    return assigned.join(known, centre_id).select(F.col(centre_id), item, distance.alias("distance"))


# -- cluster profiles -------------------------------------------------------------------------------


def centre_of(
    df: DataFrame, group: Sequence[str], categorical: Sequence[str], numeric: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Per group the most frequent value of every categorical (ties: the smallest) and the mean of every
    numeric field. ``weight`` is a row multiplicity.

    Values are counted per (group, field, value) before a winner is picked, so a large group reaches the
    last step as a handful of counts.
    """
    w = F.col(weight) if weight else F.lit(1)
    means = df.groupBy(*group).agg(
        *[(F.sum(F.col(c) * w) / F.sum(w).cast("double")).alias(c) for c in numeric],
        F.sum(w).alias("members"),
    )
    if not categorical:
        return means
    out = means
    for common, columns in _by_kind(df, categorical).items():
        cells = df.select(*group, w.alias("_w"), *[F.col(c).cast(common).alias(c) for c in columns]).unpivot(
            [*group, "_w"], columns, "_attr", "_value"
        )
        counted = cells.groupBy(*group, "_attr", "_value").agg(F.sum("_w").alias("_n"))
        rank = F.struct((-F.col("_n")).alias("n"), F.col("_value").alias("v"))
        modes = counted.groupBy(*group).agg(
            *[F.min(F.when(F.col("_attr") == c, rank))["v"].cast(df.schema[c].dataType).alias(c) for c in columns]
        )
        out = modes.join(out, list(group))
    return out


def _by_kind(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type their values are compared in: whole numbers, other numbers, or text."""
    out: dict[str, list[str]] = {}
    for c in columns:
        kind = df.schema[c].dataType
        common = "bigint" if isinstance(kind, T.IntegralType) else "double" if isinstance(kind, T.NumericType) else "string"
        out.setdefault(common, []).append(c)
    return out


def _pairs_of(n: Column) -> Column:
    """``n (n - 1) / 2`` as an exact decimal; a large group has more pairs than a 64-bit integer holds."""
    wide = n.cast("decimal(18,0)")
    return (wide * (wide - 1) / 2).cast("decimal(38,0)")


def cluster_cohesion(df: DataFrame, cluster: str, fields: Sequence[str]) -> DataFrame:
    """Per cluster: members, pairs, pairs with equal vectors, pairs that differ in at most one field, and
    the percentage of the latter (NULL for a cluster without pairs).

    Linear: equal pairs come from group sizes, and pairs that differ only in field j from the group sizes
    with j left out, minus the equal ones. One grouping-set aggregation over the distinct vectors.
    """
    fields = list(fields)
    vectors = df.groupBy(cluster, *fields).agg(F.count("*").alias("_n"))
    sets = [[cluster, *fields], *[[cluster, *[f for f in fields if f != left]] for left in fields]]
    if len(fields) > 1:
        sets.append([cluster])
    grouped = vectors.groupingSets(sets, cluster, *fields).agg(
        F.sum("_n").alias("_s"),
        sum([F.grouping(f).cast("int") for f in fields], F.lit(0)).alias("_left_out"),
    )
    pairs, out, d = _pairs_of(F.col("_s")), F.col("_left_out"), len(fields)
    sums = grouped.groupBy(cluster).agg(
        F.sum(F.when(out == d, F.col("_s"))).alias("members"),
        F.sum(F.when(out == d, pairs)).alias("pairs"),
        F.sum(F.when(out == 0, pairs)).alias("equal_pairs"),
        F.sum(F.when(out == 1, pairs)).alias("_one_out"),
    )
    # every equal pair is also counted once per left-out field
    close = F.col("_one_out") - F.col("equal_pairs") * (d - 1)
    return sums.select(
        cluster,
        "members",
        "pairs",
        "equal_pairs",
        close.cast("decimal(38,0)").alias("close_pairs"),
        F.try_divide(close.cast("double") * 100.0, F.col("pairs").cast("double")).alias("close_pct"),
    )


def mean_cohesion(cohesion: DataFrame) -> DataFrame:
    """The percentage averaged over clusters; clusters without pairs do not count."""
    return cohesion.agg(F.avg("close_pct").alias("mean_close_pct"), F.count("close_pct").alias("clusters"))


MAX_CUBE_FIELDS = 10
#: beyond, the sets of fields are more than the pairs that a block compares
MAX_SUBSET_FIELDS = 14
#: distinct rows of a group whose sets of fields one task goes through
SUBSET_ROWS = 100_000


def distance_histogram(df: DataFrame, cluster: str, fields: Sequence[str], block: int = 1024) -> DataFrame:
    """``(cluster, distance, pairs)``: pairs of a cluster by the number of fields in which they differ.

    No pair is formed for up to ten fields: the pairs that agree on a set of fields follow from the sizes
    of the groups by that set, and inclusion-exclusion turns those sums into exact agreement counts. Up to fourteen fields
    the groups are taken apart field by field, as most soon hold one vector. Wider vectors are compared as distinct
    vectors, block by block.
    """
    fields = list(fields)
    vectors = df.groupBy(cluster, *fields).agg(F.count("*").alias("_n"))
    if len(fields) > MAX_SUBSET_FIELDS:
        return _block_histogram(vectors, cluster, fields, block)
    if len(fields) > MAX_CUBE_FIELDS:
        return _exact_agreement(_subset_agreement(vectors, cluster, fields), cluster, len(fields))
    d = len(fields)
    subsets = [[f for i, f in enumerate(fields) if mask >> i & 1] for mask in range(2**d)]
    grouped = vectors.groupingSets([[cluster, *s] for s in subsets], cluster, *fields).agg(
        F.sum("_n").alias("_s"),
        (F.lit(d) - sum([F.grouping(f).cast("int") for f in fields], F.lit(0))).alias("_kept"),
    )
    return _exact_agreement(grouped.groupBy(cluster, "_kept").agg(F.sum(_pairs_of(F.col("_s"))).alias("_agree")), cluster, d)


def _exact_agreement(agreeing: DataFrame, cluster: str, d: int) -> DataFrame:
    """``(cluster, distance, pairs)`` from ``(cluster, _kept, _agree)``, the pairs that agree on a set of ``_kept`` of the ``d``
    fields, summed over all such sets."""
    # pairs agreeing on exactly m fields = sum over j >= m of (-1)^(j-m) C(j, m) * agree(j)
    weights = F.array(
        *[
            F.array(*[F.struct(F.lit(m).alias("m"), F.lit((-1) ** (j - m) * math.comb(j, m)).alias("w")) for m in range(j + 1)])
            for j in range(d + 1)
        ]
    )
    terms = agreeing.select(cluster, "_agree", F.explode(F.element_at(weights, F.col("_kept") + 1)).alias("_t"))
    return (
        terms.groupBy(cluster, (F.lit(d) - F.col("_t.m")).alias("distance"))
        .agg(F.sum(F.col("_agree").cast("decimal(30,0)") * F.col("_t.w").cast("decimal(8,0)")).alias("pairs"))
        .where(F.col("pairs") > 0)
    )


def _field_codes(vectors: DataFrame, fields: list[str]) -> DataFrame:
    """Vectors with ``_rest``, their fields as whole numbers that are equal where the fields are, NULL being a value; the
    field with most values first, which splits groups soonest."""
    ends = vectors.agg(
        *[F.approx_count_distinct(f).alias(f"n{i}") for i, f in enumerate(fields)],
        *[F.min(F.col(f).cast("bigint")).alias(f"m{i}") for i, f in enumerate(fields) if isinstance(vectors.schema[f].dataType, T.IntegralType)],
    ).first().asDict()
    codes, at = [], vectors
    for i in sorted(range(len(fields)), key=lambda i: -ends[f"n{i}"]):
        f, least = fields[i], ends.get(f"m{i}")
        if least is not None and least > -(1 << 63):
            codes.append(F.coalesce(F.col(f).cast("bigint"), F.lit(least - 1)))  # below all values stands for NULL
            continue
        domain = vectors.select(F.col(f).alias("_value")).distinct().withColumn(f"_code{i}", F.monotonically_increasing_id())
        at = at.join(broadcast_if_small(domain), F.col(f).eqNullSafe(F.col("_value"))).drop("_value")
        codes.append(F.col(f"_code{i}"))
    return at.withColumn("_rest", F.array(*codes))


def _subset_agreement(vectors: DataFrame, cluster: str, fields: list[str]) -> DataFrame:
    """``(cluster, _kept, _agree)`` without a grouping set for each set of fields.

    A group are the rows of a cluster that agree on ``_kept`` fields, with the fields after the last of them. Groups of up
    to ``SUBSET_ROWS`` rows are gone through in a task. Of larger ones the pairs are counted, and their rows copied once for
    every later field into the groups that agree on it, too, where rows alike in what is left are one.
    """
    key = F.to_json(F.struct(F.col(cluster).alias("c")), {"ignoreNullFields": "false"})
    state = _field_codes(store(vectors), fields).select(F.col(cluster).alias("_cluster"), key.alias("_g"), F.lit(0).alias("_kept"), "_rest", "_n")
    whole = ["_cluster", "_g", "_kept"]
    kind = vectors.schema[cluster].dataType
    parts = []
    for _ in range(len(fields) + 1):
        state = store(state)
        large = store(state.groupBy(*whole).agg(F.count("*").alias("_rows"), F.sum("_n").alias("_s")).where(F.col("_rows") > SUBSET_ROWS))
        names = F.broadcast(large.select("_g"))  # one in SUBSET_ROWS rows at most
        small = state.join(names, "_g", "left_anti").repartition("_g").sortWithinPartitions("_g")
        out = T.StructType([T.StructField("_cluster", kind), T.StructField("_kept", T.IntegerType()), T.StructField("_agree", T.StringType())])
        found = small.select(*whole, "_rest", "_n").mapInArrow(_count_subsets, out).withColumn("_agree", F.col("_agree").cast("decimal(38,0)"))
        parts.append(found.unionByName(large.select("_cluster", "_kept", _pairs_of(F.col("_s")).alias("_agree"))))
        if large.isEmpty():
            break
        each = state.join(names, "_g", "left_semi").select("*", F.posexplode("_rest").alias("_j", "_v"))
        left = F.size("_rest") - F.col("_j") - 1
        state = (
            each.select("_cluster", F.concat_ws(",", "_g", F.size("_rest") - F.col("_j"), "_v").alias("_g"), F.col("_kept") + 1, F.slice("_rest", F.col("_j") + 2, left), "_n")
            .toDF(*whole, "_rest", "_n").groupBy(*whole, "_rest").agg(F.sum("_n").alias("_n"))
        )
    return reduce(DataFrame.unionByName, parts).groupBy(F.col("_cluster").alias(cluster), "_kept").agg(F.sum("_agree").alias("_agree"))


def _count_subsets(batches):
    """``(_cluster, _kept, _agree)`` of whole groups, which come one after the other; as many at a time as fit."""

    def out(table: pa.Table):
        place, sums = _agreement_of(table)
        at = [(c, k, str(n)) for (c, k), n in sums.items() if n]
        clusters = table["_cluster"].take(pa.array([place[c] for c, _, _ in at], pa.int64())).combine_chunks()
        return pa.RecordBatch.from_arrays([clusters, pa.array([k for _, k, _ in at], pa.int32()), pa.array([n for _, _, n in at], pa.string())], names=["_cluster", "_kept", "_agree"])

    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        waiting.append(batch)
        held += len(batch)
        if held < 2 * SUBSET_ROWS:
            continue
        table = pa.Table.from_batches(waiting)
        last = pc.equal(table["_g"], table["_g"][-1]).to_numpy()
        cut = int(last.argmax())  # the last group may go on
        if cut:
            yield out(table.slice(0, cut))
        waiting, held = table.slice(cut).to_batches(), len(table) - cut
    if held:
        yield out(pa.Table.from_batches(waiting))


def _agreement_of(table: pa.Table) -> tuple[list[int], dict[tuple[int, int], int]]:
    """A row of each cluster, and pairs by (cluster, fields agreed on) over all sets of the fields left to the groups."""
    groups = pd.factorize(table["_g"].to_pandas())[0]
    start = np.unique(groups, return_index=True)[1]
    names = [json.dumps(v, default=str) for v in table["_cluster"].take(pa.array(start)).to_pylist()]
    of_group, unique = pd.factorize(np.array(names, dtype=object))
    place = [int(start[np.flatnonzero(of_group == c)[0]]) for c in range(len(unique))]
    cluster_of = of_group[groups]
    kept, n = table["_kept"].to_numpy(), table["_n"].to_numpy().astype(np.int64)
    width = pc.list_value_length(table["_rest"]).to_numpy()
    sums: dict[tuple[int, int], int] = Counter()
    for k, fields in {(int(a), int(b)) for a, b in np.unique(np.column_stack([kept, width]), axis=0)}:
        own = np.flatnonzero((kept == k) & (width == fields))
        flat = pc.list_flatten(table["_rest"].take(pa.array(own))).to_numpy()
        codes = [pd.factorize(c)[0] for c in flat.reshape(len(own), fields).T]
        _walk_subsets(pd.factorize(groups[own])[0], cluster_of[own], n[own], codes, k, len(unique), sums)
    return place, sums


def _walk_subsets(group: np.ndarray, cluster_of: np.ndarray, n: np.ndarray, codes: list[np.ndarray], kept: int, clusters: int, sums: dict[tuple[int, int], int]) -> None:
    """Adds the pairs of the groups, and of what they fall into by every set of the fields ``codes``, to ``sums``."""
    fields = len(codes)
    width = [int(c.max()) + 1 for c in codes]
    tail = [np.zeros(len(group), np.int64)]  # rows with one number are alike in all fields from there on
    for c in reversed(codes):
        tail.append(pd.factorize(c * (int(tail[-1].max()) + 1) + tail[-1])[0])
    tail = tail[::-1]
    # sums of pairs stay whole numbers of 64 bits unless there are very many rows
    kind = np.int64 if float(n.sum()) ** 2 * 2**fields < 2**62 else object
    counted, alone = np.zeros((fields + 1, clusters), kind), np.zeros((fields + 1, fields + 1, clusters), kind)

    def pairs(total: np.ndarray) -> np.ndarray:
        total = np.rint(total).astype(np.int64).astype(kind)
        return total * (total - 1) // 2

    def visit(group: np.ndarray, rows: np.ndarray, n: np.ndarray, first: int, depth: int) -> None:
        m = int(group.max()) + 1
        cluster = np.empty(m, np.int64)
        cluster[group] = cluster_of[rows]
        size = np.bincount(group, minlength=m)
        total = pairs(np.bincount(group, n, m))
        np.add.at(counted[depth], cluster, total)
        if first == fields:
            return
        # what is one vector stays one group whatever else it has to agree on
        one = size == 1
        np.add.at(alone[depth, fields - first], cluster[one], total[one])
        more = ~one[group]
        if not more.any():
            return
        group, rows, n = group[more], rows[more], n[more]
        for f in range(first, fields):
            into = pd.factorize(group * width[f] + codes[f][rows])[0]
            alike = pd.factorize(into * (int(tail[f + 1].max()) + 1) + tail[f + 1][rows])[0]
            at = np.empty(int(alike.max()) + 1, np.int64)
            at[alike[::-1]] = np.arange(len(alike) - 1, -1, -1)
            visit(into[at], rows[at], np.bincount(alike, n), f + 1, depth + 1)

    # rows alike in all the fields are one from the start
    alike = pd.factorize(group * (int(tail[0].max()) + 1) + tail[0])[0]
    at = np.empty(int(alike.max()) + 1, np.int64)
    at[alike[::-1]] = np.arange(len(alike) - 1, -1, -1)
    visit(group[at], at, np.bincount(alike, n), 0, 0)
    for depth in range(fields + 1):
        for c in range(clusters):
            sums[c, kept + depth] += int(counted[depth, c])
            for left in range(1, fields + 1):
                if alone[depth, left, c]:
                    for j in range(1, left + 1):
                        sums[c, kept + depth + j] += int(alone[depth, left, c]) * math.comb(left, j)


def _block_histogram(vectors: DataFrame, cluster: str, fields: list[str], block: int) -> DataFrame:
    packed = vectors.select(
        F.col(cluster).alias("_cluster"), F.array(*[F.to_json(F.struct(f), {"ignoreNullFields": "false"}) for f in fields]).alias("_v"), "_n"
    ).withColumn("_row", F.xxhash64("_v"))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"_cluster": pd.Series([], dtype=object), "distance": pd.Series([], dtype="int32"), "pairs": pd.Series([], dtype="int64")})
        if a.empty or b.empty:
            return empty
        own = bool(a["_lb"].iat[0] == a["_rb"].iat[0])
        if own:
            b = a
        x = np.array(a["_v"].tolist(), dtype=object)
        y = np.array(b["_v"].tolist(), dtype=object)
        codes = np.unique(np.concatenate([x.ravel(), y.ravel()]).astype(str), return_inverse=True)[1]
        x, y = codes[: x.size].reshape(x.shape), codes[x.size :].reshape(y.shape)
        na, nb = a["_n"].to_numpy(np.int64), b["_n"].to_numpy(np.int64)
        differing = np.zeros((len(x), len(y)), np.uint8 if len(fields) < 256 else np.int32)
        for f in range(len(fields)):
            differing += x[:, f, None] != y[None, :, f]
        # of a block with itself, each pair once: its own products are halved, without those of a vector with itself
        totals = np.array([na @ ((differing == k) @ nb) for k in range(len(fields) + 1)], np.int64)
        if own:
            totals[0] -= na.sum()
            totals //= 2
        kept = np.flatnonzero(totals)
        return pd.DataFrame({"_cluster": pd.Series([a["_cluster"].iat[0]] * len(kept), dtype=a["_cluster"].dtype), "distance": kept, "pairs": totals[kept]})

    kind = vectors.schema[cluster].dataType.simpleString()
    parts = compare_blocks(
        packed, packed, ["_cluster"], "_row", compare, f"_cluster {kind}, distance int, pairs long", block, symmetric=True
    )
    return parts.groupBy(F.col("_cluster").alias(cluster), "distance").agg(
        F.sum(F.col("pairs").cast("decimal(38,0)")).cast("decimal(38,0)").alias("pairs")
    )


def distance_profile(
    assigned: DataFrame, cluster: str, id: str, distance: str = "distance", scale: float = 1000.0
) -> DataFrame:
    """The curve of a cluster's sorted distances around its middle row: ``x`` is the position minus the
    middle position, ``y`` the scaled distance minus the middle row's. Ties are ordered by id."""
    # placing rows by range samples them first, so the distances are written down before that
    ranked = store(running_totals(store(assigned.select(cluster, id, distance)), [cluster], [distance, id]))
    sizes = ranked.groupBy(cluster).agg(F.count("*").alias("members"))
    middles = (
        ranked.join(sizes, cluster)
        .where(F.col("pos") == F.floor(F.col("members") / 2))
        .select(cluster, F.col("pos").alias("_mid"), F.col(distance).alias("_mid_d"))
    )
    return ranked.join(middles, cluster).select(
        cluster,
        id,
        (F.col("pos") - F.col("_mid")).alias("x"),
        (F.col(distance) * scale - F.col("_mid_d") * scale).alias("y"),
    )


# -- bands ------------------------------------------------------------------------------------------

class Jumps:
    """What a run of ascending distances does to the last band start before it.

    The band before a run starts less than ``delta`` below where it can reach, so the first start in the run is one of
    the distances within ``delta`` of the run's first, or the first one beyond them. Each of these is followed to the last
    start of the run; neighbours that end alike are kept once. ``apply`` is the resulting function.
    """

    def __init__(self, delta: float):
        self.delta, self.window = delta, None
        self.entry, self.start, self.made = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        self.past = False  # whether the last chain is the one that enters beyond the window

    def reach(self, start):
        return np.round(start + self.delta, 9)

    def feed(self, d: np.ndarray) -> None:
        """The next ascending distances of the run."""
        if self.window is None:
            self.window = self.reach(d[0])
        near = d[d <= self.window] if not self.past else d[:0]
        fresh = d[: len(near) + 1] if not self.past and len(near) < len(d) else near
        self.past |= len(fresh) > len(near)
        self.entry = np.append(self.entry, fresh)
        self.start = np.append(self.start, fresh)
        self.made = np.append(self.made, np.ones(len(fresh), np.int64))
        while True:
            at = np.searchsorted(d, self.reach(self.start), side="right")
            on = at < len(d)
            if not on.any():
                return
            self.start[on] = d[at[on]]
            self.made[on] += 1

    def pack(self) -> tuple[list[float], list[float], list[int], bool]:
        keep = np.append((self.start[1:] != self.start[:-1]) | (self.made[1:] != self.made[:-1]), True)
        if self.past and len(keep) > 1:
            keep[-2] = True  # the chain beyond the window has no upper end
        return self.entry[keep].tolist(), self.start[keep].tolist(), self.made[keep].tolist(), self.past


def jump(entry: np.ndarray, start: np.ndarray, made: np.ndarray, past: bool, last: float | None, delta: float) -> tuple[float | None, int]:
    """(last start after the run, starts made in it) of packed ``Jumps``, coming from a last start (None: none yet)."""
    reach = -math.inf if last is None else float(np.round(last + delta, 9))
    k = int(np.searchsorted(entry[: len(entry) - past], reach, side="right"))
    return (float(start[k]), int(made[k])) if k < len(entry) else (last, 0)


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """(from, to) of the runs of one (part, key) in a sorted batch."""
    if not len(batch):
        return []
    new = np.ones(len(batch), bool)
    if len(batch) > 1:
        new[1:] = np.logical_or(*[pc.not_equal(batch[c].slice(1), batch[c].slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False) for c in ("_part", "_key")])
    at = np.flatnonzero(new)
    return list(zip(at.tolist(), [*at[1:].tolist(), len(batch)]))


def _border_jumps(delta: float):
    """Jump functions of the first and the last group of every part; the groups between lie in it whole."""

    def run(batches):
        key, jumps, first = None, None, True

        def row(k, j):
            entry, start, made, past = j.pack()
            return {"_part": k[0], "_key": k[1], "entry": entry, "start": start, "made": made, "past": past}

        def out(rows):
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("_part", pa.int32()), ("_key", pa.string()), ("entry", pa.list_(pa.float64())), ("start", pa.list_(pa.float64())), ("made", pa.list_(pa.int64())), ("past", pa.bool_())]))

        for batch in batches:
            rows = []
            d = batch["_d"].to_numpy(zero_copy_only=False)
            for i, j in _runs(batch):
                now = (batch["_part"][i].as_py(), batch["_key"][i].as_py())
                if now != key:
                    if key is not None and (first or now[0] != key[0]):
                        rows.append(row(key, jumps))
                    first = key is None or now[0] != key[0]
                    key, jumps = now, Jumps(delta)
                jumps.feed(d[i:j])
            if rows:
                yield out(rows)
        if key is not None:
            yield out([row(key, jumps)])

    return run


def _carry(delta: float):
    """Streams a group's parts in order: what each finds as the last start and the number of bands before it."""

    def run(frames):
        key, last, bands = None, None, 0
        for f in frames:
            found = []
            for part, k, entry, start, made, past in zip(f["_part"], f["_key"], f["entry"], f["start"], f["made"], f["past"]):
                if k != key:
                    key, last, bands = k, None, 0
                found.append((part, k, math.nan if last is None else last, bands))
                last, new = jump(entry, start, made, past, last, delta)
                bands += new
            yield pd.DataFrame(found, columns=["_part", "_key", "_last", "_bands"])

    return run


def _replay(group: list[str], delta: float):
    """Band starts of every part, going on from what was carried into it."""

    def run(batches):
        key, band, reach = None, -1, -math.inf
        for batch in batches:
            d = batch["_d"].to_numpy(zero_copy_only=False)
            at, bands = [], []
            for i, j in _runs(batch):
                now = (batch["_part"][i].as_py(), batch["_key"][i].as_py())
                if now != key:
                    last, before = batch["_last"][i].as_py(), batch["_bands"][i].as_py()
                    key, band = now, (before or 0) - 1
                    reach = -math.inf if last is None or math.isnan(last) else float(np.round(last + delta, 9))
                k = i + int(np.searchsorted(d[i:j], reach, side="right"))
                while k < j:
                    band, reach = band + 1, float(np.round(d[k] + delta, 9))
                    at.append(k)
                    bands.append(band)
                    k = i + int(np.searchsorted(d[i:j], reach, side="right"))
            if at:
                kept = pa.RecordBatch.from_arrays([batch[c] for c in [*group, "_d"]], names=[*group, "band_start"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*[kept[g] for g in group], pa.array(bands, pa.int32()), kept["band_start"]], names=[*group, "band", "band_start"])

    return run


def band_starts(assigned: DataFrame, group: Sequence[str], distance: str = "distance", delta: float = BAND_DELTA) -> DataFrame:
    """``(group..., band, band_start)``: the ascending band starts of every group.

    A band starts at the smallest distance not yet covered and covers everything up to start + delta. Distinct
    distances are placed by ranges of (group, distance), so a group of any size lies over many parts. Where a part's
    first start falls depends on the last one before it: each part gives its first and last group's ``Jumps``, these are
    applied one after the other per group, and the parts go on from there.
    """
    group = list(group)
    own = F.to_json(F.struct(*group), {"ignoreNullFields": "false"})
    values = assigned.select(*group, F.round(distance, 9).alias("_d")).where("_d is not null").distinct().withColumn("_key", own)
    placed = store(values.repartitionByRange("_key", "_d").withColumn("_part", F.spark_partition_id()))
    in_order = ["_part", "_key", "_d"]
    narrow = placed.select(*in_order).repartition("_part").sortWithinPartitions(*in_order)
    borders = narrow.mapInArrow(_border_jumps(delta), "_part int, _key string, entry array<double>, start array<double>, made array<bigint>, past boolean")
    carried = borders.repartition("_key").sortWithinPartitions("_key", "_part").mapInPandas(_carry(delta), "_part int, _key string, _last double, _bands long")
    known = placed.join(broadcast_if_small(carried), ["_part", "_key"], "left").select(*group, *in_order, "_last", "_bands")
    kinds = T.StructType([*[values.schema[g] for g in group], T.StructField("band", T.IntegerType()), T.StructField("band_start", T.DoubleType())])
    return known.repartition("_part").sortWithinPartitions(*in_order).mapInArrow(_replay(group, delta), kinds)


def distance_bands(assigned: DataFrame, group: Sequence[str], distance: str = "distance", delta: float = BAND_DELTA) -> DataFrame:
    """Rows with their ``band`` (0-based) and ``band_start`` inside the group; a NULL group is a group.

    A band spans at most three cells of width delta, so rows find theirs by an equi-join on (group, cell),
    which also spreads a large group.
    """

    def cell(c: str) -> Column:
        return F.floor(F.round(c, 9) / F.lit(delta))

    own = F.to_json(F.struct(*group), {"ignoreNullFields": "false"})
    bands = (
        band_starts(assigned, group, distance, delta)
        .select(own.alias("_group"), "band", "band_start")
        .withColumn("_cell", F.explode(F.sequence(cell("band_start"), cell("band_start") + 2)))
    )
    d = F.round(distance, 9)
    inside = (d >= F.col("band_start")) & (d <= F.round(F.col("band_start") + F.lit(delta), 9))
    return (
        assigned.withColumn("_cell", cell(distance))
        .withColumn("_group", own)
        .join(broadcast_if_small(bands), ["_group", "_cell"])
        .where(inside)
        .drop("_cell", "_group")
    )


# -- k-means ----------------------------------------------------------------------------------------


def kmeans(
    points: DataFrame,
    k: int,
    max_iter: int = 100,
    tol: float = 0.001,
    distance: str = "sq_euclidean",
    seed: int = 42,
    vector: str = "features",
    centre_id: str = "centre_id",
) -> tuple[KMeansModel, DataFrame]:
    """Random seeds, Lloyd iterations, then the points with their cluster."""
    measures = {"sq_euclidean": "euclidean", "cosine": "cosine"}
    if distance not in measures:
        raise ValueError(f"k-means runs on {sorted(measures)}, not {distance!r}")
    listed = isinstance(points.schema[vector].dataType, T.ArrayType)  # else vectors, taken as they are
    as_vector = points.withColumn("_vector", array_to_vector(F.col(vector).cast("array<double>")) if listed else F.col(vector))
    model = KMeans(
        k=k, maxIter=max_iter, tol=tol, seed=seed, initMode="random", distanceMeasure=measures[distance],
        featuresCol="_vector", predictionCol=centre_id,
    ).fit(as_vector)
    return model, model.transform(as_vector).drop("_vector")


def lloyd(
    points: DataFrame, metric: Metric, k: int = 10, max_iter: int = 100, seed: int = 42, weight: str | None = None
) -> tuple[DataFrame, DataFrame, int]:
    """Clusters by any named distance over scalar fields: random distinct points as seeds, then nearest centre
    (ties: the lowest id) and new centre (most frequent category, mean number) in turn, until no centre
    moves or ``max_iter`` rounds. Returns centres as ``(centre_id, fields...)``, the points with their
    centre and distance, and the rounds. A centre without points keeps its place. Each round is written down."""
    fields = list(metric.fields)
    numeric = [f for f in fields if f not in metric.categorical]
    seeds = seed_centres(points, fields, numeric, k, seed)
    by_key = Window.orderBy(_centre_key(fields))  # over k rows
    centres = store(seeds.withColumn("centre_id", F.row_number().over(by_key) - 1))
    typed = points.withColumns({f: F.col(f).cast("double") for f in numeric})
    for done in range(1, max_iter + 1):
        assigned = store(assign_nearest(typed, centres, metric, "first"))
        moved = centre_of(assigned, ["centre_id"], [f for f in fields if f in metric.categorical], numeric, weight).drop("members")
        moved = moved.select("centre_id", *[(F.round(f, 9) if f in numeric else F.col(f)).alias(f) for f in fields])
        kept = centres.join(moved.select("centre_id"), "centre_id", "left_anti").select("centre_id", *fields)
        after = store(moved.unionByName(kept))
        same = after.exceptAll(centres.select("centre_id", *fields)).isEmpty()
        centres = after
        if same:
            break
    return centres, assigned, done


def kmeans_step(
    points: DataFrame, centres: DataFrame, vector: str = "features", centre_id: str = "centre_id"
) -> DataFrame:
    """One Lloyd iteration: ``(centre_id, members, features)``. Centres without points keep their place."""
    assigned = assign_nearest(points, centres, Metric("sq_euclidean", (vector,)), "first", centre_id)
    width = centres.select(F.size(vector)).first()[0]
    moved = assigned.groupBy(centre_id).agg(
        F.count("*").alias("members"),
        F.array(*[F.avg(F.col(vector)[i]) for i in range(width)]).alias("_moved"),
    )
    return centres.join(moved, centre_id, "left").select(
        centre_id,
        F.coalesce("members", F.lit(0)).alias("members"),
        F.coalesce("_moved", F.col(vector).cast("array<double>")).alias(vector),
    )


def cluster_centres(spark, model: KMeansModel, centre_id: str = "centre_id", vector: str = "features") -> DataFrame:
    """The k centres of a fitted model."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, f"{centre_id} int, {vector} array<double>")


def cluster_sizes(assigned: DataFrame, centre_id: str = "centre_id") -> DataFrame:
    return assigned.groupBy(centre_id).agg(F.count("*").alias("members"))


# -- split clustering -------------------------------------------------------------------------------


def _centre_key(fields: Sequence[str]) -> Column:
    """A centre is identified by its feature tuple, written out as text."""
    return F.to_json(F.struct(*fields))


def _nearer(profiles: DataFrame, centres: DataFrame, metric: Metric) -> DataFrame:
    """Profiles with their nearest centres as ``_d`` and ``_ids``; where they have some already, ``centres`` are further
    ones. Centres are given as ``(fields...)`` and never move, so earlier distances hold."""
    fields, own = list(metric.fields), [c for c in profiles.columns if c not in ("_d", "_ids")]
    found = best_of(profiles, centres.select(*fields, _centre_key(fields).alias("centre_id")), metric)
    d, ids = F.col("_best.d"), F.col("_best.ids")
    if "_d" not in profiles.columns:
        return found.select(*own, d.alias("_d"), ids.alias("_ids"))
    kept = F.when(d < F.col("_d"), ids).when(d == F.col("_d"), F.concat("_ids", ids)).otherwise(F.col("_ids"))
    return found.select(*own, F.least(d, "_d").alias("_d"), kept.alias("_ids"))


def _split_round(state: DataFrame, centres: DataFrame, metric: Metric, weight: str, delta: float) -> DataFrame:
    """The next centres of profiles that know their nearest ones."""
    fields = list(metric.fields)
    categorical = [f for f in fields if f in metric.categorical]
    numeric = [f for f in fields if f not in metric.categorical]
    keyed = centres.select(*fields, _centre_key(fields).alias("centre_id"))
    assigned = state.select(*[c for c in state.columns if c not in ("_d", "_ids")], F.explode("_ids").alias("centre_id"), F.col("_d").alias("distance"))
    limit = F.round(F.col("_min") + F.lit(delta), 9)
    spread = store(assigned.groupBy("centre_id").agg(F.min("distance").alias("_min"), F.max("distance").alias("_max")))
    far = assigned.join(spread, "centre_id").where(F.col("distance") > limit).drop("_min", "_max")
    kept = keyed.join(spread, "centre_id").select(*fields, (F.col("_max") <= limit).alias("converged"))
    banded = distance_bands(far, ["centre_id"], delta=delta)
    added = centre_of(banded, ["centre_id", "band"], categorical, numeric, weight)
    types = centres.schema
    fresh = added.select(
        *[(F.round(f, 9) if f in numeric else F.col(f)).cast(types[f].dataType).alias(f) for f in fields],
        F.lit(False).alias("converged"),
    )
    return kept.unionByName(fresh).groupBy(*fields).agg(F.bool_or("converged").alias("converged"))


def split_step(profiles: DataFrame, centres: DataFrame, metric: Metric, weight: str = "n", delta: float = BAND_DELTA) -> DataFrame:
    """One round over weighted distinct profiles: the next centres as ``(fields..., converged)``. The
    given centres are distinct.

    Every centre that holds points is kept. It has converged when all its points lie within ``delta`` of
    its closest one; otherwise each distance band of the points beyond adds a centre made of their most
    frequent categories and mean numbers.
    """
    return _split_round(store(_nearer(profiles, centres, metric)), centres, metric, weight, delta)


def seed_centres(profiles: DataFrame, fields: Sequence[str], numeric: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """``k`` random distinct profiles as starting centres; numeric fields become doubles."""
    keyed = profiles.select(*fields).distinct().withColumn("_key", _centre_key(fields))
    picked = sample_k(keyed, "_key", k, seed)
    return picked.select(*[F.col(f).cast("double").alias(f) if f in numeric else F.col(f) for f in fields])


def split_clustering(
    profiles: DataFrame,
    metric: Metric,
    k: int = 10,
    delta: float = BAND_DELTA,
    max_iter: int = 100,
    seed: int = 42,
    weight: str = "n",
) -> tuple[DataFrame, int]:
    """Splits centres until all have converged, the set of centres stops changing, or ``max_iter``.

    Returns the centres as ``(fields..., converged)`` and the rounds taken. A profile keeps its nearest centres from
    round to round and is only compared with those added; a centre that lost all its profiles to nearer ones never wins
    them back. Each round is written down, so lineage does not grow and a lost executor costs one round at most.
    """
    fields = list(metric.fields)
    numeric = [f for f in fields if f not in metric.categorical]
    added = centres = materialize(seed_centres(profiles, fields, numeric, k, seed))
    state, n = profiles, centres.count()
    for done in range(1, max_iter + 1):
        if added is not None:
            state = store(_nearer(state, added, metric))
        after = materialize(_split_round(state, centres, metric, weight, delta))
        n_after, open_left = after.agg(F.count("*"), F.count_if(~F.col("converged"))).first()
        added = after.join(centres, fields, "left_anti")
        nothing_new = added.isEmpty()
        same = open_left > 0 and n_after == n and nothing_new
        centres, n = after, n_after
        if open_left == 0 or same:
            break
        added = None if nothing_new else added
    return centres, done
