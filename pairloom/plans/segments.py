"""Which users are alike: k-means over encoded attributes, and split clustering over mixed ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.distance import Metric
from pairloom.operators.clean import NULL_CODE, in_ranges
from pairloom.operators.cluster import (
    assign_nearest,
    cluster_centres,
    kmeans,
    split_clustering,
    vector_distance,
)
from pairloom.operators.distribution import attribute_distribution, cluster_distribution
from pairloom.operators.features import distinct_profiles, feature_vectors
from pairloom.session import materialize, store
from pairloom.spec import Range

GENDERS = {"male": 0, "female": 1}


@dataclass(frozen=True)
class Segments:
    """Clustered items: centres, (cluster, item, distance) rows and per-cluster value counts."""

    centres: DataFrame
    items: DataFrame
    profile: DataFrame | None = None


def cluster_items(
    df: DataFrame,
    id: str,
    fields: Sequence[str],
    categorical: Sequence[str],
    k: int = 10,
    max_iter: int = 100,
    tol: float = 0.001,
    distance: str = "sq_euclidean",
    seed: int = 42,
    dist: DataFrame | None = None,
) -> Segments:
    """Distribution, encoding, k-means, distance of each item to its centre, value counts per cluster.

    Numbers and texts may be mixed; the attributes travel with the vectors, which are sparse, so domains have any size.
    """
    dist = materialize(attribute_distribution(df, fields)) if dist is None else dist
    vectors = store(feature_vectors(df, id, fields, categorical, dist, keep=list(fields)))
    return _cluster_vectors(vectors, id, fields, k, max_iter, tol, distance, seed)


def _cluster_vectors(vectors: DataFrame, id: str, fields: Sequence[str], k: int, max_iter: int, tol: float, distance: str, seed: int) -> Segments:
    model, assigned = kmeans(vectors, k, max_iter, tol, distance, seed)
    assigned = store(assigned)
    items = vector_distance(assigned, model, id)
    profile = cluster_distribution(assigned.select("centre_id", *fields), "centre_id", fields)
    return Segments(cluster_centres(vectors.sparkSession, model), items, profile)


def cluster_users(
    profiles: DataFrame,
    fields: Sequence[str],
    categorical: Sequence[str],
    ranges: Sequence[Range],
    k: int = 10,
    max_iter: int = 100,
    tol: float = 0.001,
    id: str = "userid",
    gender: str = "sex",
    seed: int = 42,
) -> dict[str, Segments]:
    """The same per gender over range-checked profiles, all encoded once by one common distribution."""
    valid = in_ranges(profiles, ranges)
    dist = materialize(attribute_distribution(valid, fields))
    kept = list(dict.fromkeys([gender, *fields]))
    vectors = store(feature_vectors(valid, id, fields, categorical, dist, keep=kept))
    return {
        side: _cluster_vectors(vectors.where(F.col(gender) == code), id, fields, k, max_iter, tol, "sq_euclidean", seed)
        for side, code in GENDERS.items()
    }


def profile_metric(profiles: DataFrame, fields: Sequence[str], categorical: Sequence[str]) -> Metric:
    """Gower distance over ``fields`` with the value ranges found in the data."""
    numeric = [f for f in fields if f not in categorical]
    found = [F.coalesce(F.col(f).cast("double"), F.lit(float(NULL_CODE))) for f in numeric]
    spans = profiles.agg(*[(F.max(v) - F.min(v)).alias(f) for f, v in zip(numeric, found)]).first() if numeric else {}
    ranges = {f: float(spans[f] or 0.0) for f in numeric}
    return Metric("gower", tuple(fields), tuple(f for f in fields if f in categorical), ranges)


def split_cluster_groups(
    profiles: DataFrame, groups: Mapping[str, Sequence[str]], categorical: Sequence[str], ranges: Sequence[Range], **options
) -> dict[str, dict[str, tuple[DataFrame, DataFrame]]]:
    """``split_cluster_users`` for every named group of fields (``DatasetSpec.groups``) by itself."""
    return {
        name: split_cluster_users(profiles, fields, [f for f in fields if f in categorical], ranges, **options)
        for name, fields in groups.items()
    }


def split_cluster_users(
    profiles: DataFrame,
    fields: Sequence[str],
    categorical: Sequence[str],
    ranges: Sequence[Range],
    k: int = 10,
    delta: float = 0.01,
    max_iter: int = 100,
    gender: str = "sex",
    seed: int = 42,
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per gender: (centres, distinct profiles with their nearest centres)."""
    valid = in_ranges(profiles, ranges)
    metric = profile_metric(valid, fields, categorical)
    out = {}
    for side, code in GENDERS.items():
        distinct = store(distinct_profiles(valid.where(F.col(gender) == code), fields))
        centres, _ = split_clustering(distinct, metric, k, delta, max_iter, seed)
        keyed = centres.withColumn("centre_id", F.to_json(F.struct(*fields)))
        out[side] = (centres, assign_nearest(distinct, keyed, metric, "all"))
    return out
