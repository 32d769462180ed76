"""Encoding and item clustering over domains of any size."""

import numpy as np

from pairloom.operators.distribution import attribute_distribution
from pairloom.operators.features import feature_matrix, feature_vectors, one_hot
from pairloom.plans.segments import cluster_items


def test_items_of_a_wide_domain_are_clustered(spark):
    n = 10_001
    df = spark.range(n).selectExpr("id", "concat('city', id) as city", "cast(id % 7 as int) as age")
    got = cluster_items(df, "id", ["city", "age"], ["city"], k=2, max_iter=2)
    assert got.items.count() == n and got.items.where("distance is null or distance < 0").isEmpty()


def test_one_hot_of_a_wide_domain(spark):
    """No task holds the domain: places come by a join, and a value that was not counted has none."""
    df = spark.range(10_001).selectExpr("id", "id * 3 as city")
    dist = attribute_distribution(df, ["city"])
    some = spark.createDataFrame([(7, 21), (8, 22), (9, 30_000)], "id long, city long")
    hot = {r.id: r.hot for r in one_hot(some, "city", dist, "hot").collect()}
    assert [len(v) for v in hot.values()] == [10_001] * 3 and [sum(hot[i]) for i in (7, 8, 9)] == [1, 0, 1]
    assert hot[7][7] == 1 and hot[9][10_000] == 1
    vectors = {r.row: r.features for r in feature_vectors(some.withColumnRenamed("id", "row"), "row", ["city"], ["city"], dist).collect()}
    assert {k: (v.size, list(v.indices)) for k, v in vectors.items()} == {7: (10_001, [7]), 9: (10_001, [10_000])}


def test_distances_of_both_encodings(spark):
    rows = [(i, f"c{i % 5}", i % 7) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, city string, age int")
    got = cluster_items(df, "id", ["city", "age"], ["city"], k=3, max_iter=5)
    centres = {r.centre_id: np.array(r.features) for r in got.centres.collect()}
    dense = feature_matrix(df, "id", ["city", "age"], ["city"], attribute_distribution(df, ["city", "age"]))
    at = {r.id: np.array(r.features) for r in dense.collect()}
    found = {r.id: (r.centre_id, r.distance) for r in got.items.collect()}
    assert len(found) == 40
    for i, (centre, d) in found.items():
        assert abs(d - ((at[i] - centres[centre]) ** 2).sum()) < 1e-9
