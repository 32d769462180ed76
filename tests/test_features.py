import math

import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pairloom.operators import distribution as D
from pairloom.operators import features as X
from pairloom.spec import Range


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, 10, 1, None), (2, 100, 2, 3), (3, 0, 2, 3), (4, -1, 5, None)], "id int, x int, k int, c int"
    )


def test_distribution_counts_null_as_minus_one(people):
    got = D.attribute_distribution(people, ["k", "c"])
    assert rows(got) == [("c", -1, 2), ("c", 3, 2), ("k", 1, 1), ("k", 2, 2), ("k", 5, 1)]
    assert rows(D.attribute_distribution(people, ["k"], [Range("x", 1, 50)])) == [("k", 1, 1)]


def test_distribution_is_one_scan(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "p"))
    plan = D.attribute_distribution(spark.read.parquet(str(tmp_path / "p")), ["k", "c", "x"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_class_distribution(spark):
    df = spark.createDataFrame(
        [(1, 1, "1980-01-01", 4, 9), (2, 0, "30", None, 9), (3, 0, "bad", 4, 9)],
        "id int, paid int, birthday string, a int, skip int",
    )
    got = D.class_distribution(df, "paid", ["birthday", "a", "skip"], ["skip"], "birthday", "2014-01-01")
    assert rows(got) == [(0, "birthday", 30, 1), (1, "a", 4, 1), (1, "birthday", 34, 1)]


def test_cluster_distribution_truncates(spark):
    df = spark.createDataFrame([(0, 1.9), (0, 1.1), (1, -1.5), (1, None)], "c int, v double")
    assert rows(D.cluster_distribution(df, "c", ["v"])) == [(0, "v", 1, 2), (1, "v", -1, 2)]


def test_moments(spark, people):
    dist = D.attribute_distribution(people, ["x"])
    row = D.log_moments(dist, ["x"]).first()
    mu = (1 + 2) / 4
    sigma = math.sqrt(((1 - mu) ** 2 + (2 - mu) ** 2) / 3)
    assert (row.n, row.mu, row.sigma) == (4, pytest.approx(mu), pytest.approx(sigma))


@pytest.mark.parametrize("values", [[0, -1, 0], [7], [5, 5, 5]])
def test_moments_degenerate(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    moments = D.log_moments(D.attribute_distribution(df, ["x"]), ["x"])
    got = X.log_zscore(df, "x", moments, "z").collect()
    assert [r.z for r in got] == [0.0] * len(values)


def test_range_and_range_map(people):
    dist = D.attribute_distribution(people, ["x", "k"])
    assert D.range_map(dist, ["x", "k"]) == {"x": 101.0, "k": 4.0}


def test_descriptor(spark, people):
    df = people.withColumn("label", F.col("id") % 2)
    got = rows(D.dataset_descriptor(df, ["x", "k"], ["k"], "label"))
    assert got == [(0, "x", 0, 0, None), *[(1, "k", 1, 0, v) for v in "125"], *[(2, "label", 1, 1, v) for v in "01"]]


def test_distribution_keeps_kinds(spark):
    df = spark.createDataFrame([(0.0, "a"), (0.4, "b"), (0.9, None)], "x double, c string")
    assert D.range_map(D.attribute_distribution(df, ["x"]), ["x"]) == {"x": 0.9}
    assert rows(D.attribute_distribution(df, ["c"])) == [("c", "-1", 1), ("c", "a", 1), ("c", "b", 1)]


def test_one_hot(people):
    dist = D.attribute_distribution(people, ["c"])
    got = {r.id: r.hot for r in X.one_hot(people, "c", dist, "hot").collect()}
    assert got == {1: [1.0, 0.0], 2: [0.0, 1.0], 3: [0.0, 1.0], 4: [1.0, 0.0]}


def test_one_hot_range(people):
    got = {r.id: r.hot for r in X.one_hot_range(people, "k", 1, 5, "hot").collect()}
    assert got[2] == [0, 1, 0, 0, 0] and got[4] == [0, 0, 0, 0, 1]


def test_freq(people):
    dist = D.attribute_distribution(people, ["k"])
    assert {r.id: r.f for r in X.freq_encode(people, "k", dist, "f").collect()} == {1: 0.25, 2: 0.5, 3: 0.5, 4: 0.25}


def test_scale_columns(people):
    got = {r.id: r for r in X.scale_columns(people, ["x"]).collect()}
    assert got[1].x_max == pytest.approx(0.1) and got[1].x_mean == pytest.approx(10 - 27.25)
    assert (got[3].x_max, got[3].x_mean, got[3].x_log) == (0.0, 0.0, None)


def test_matrix_order_and_passthrough(people):
    dist = D.attribute_distribution(people, ["x", "k"])
    got = {r.id: r.features for r in X.feature_matrix(people, "id", ["k", "x", "c"], ["k", "c"], dist).collect()}
    mu, sigma = 0.75, math.sqrt((0.25**2 + 1.25**2) / 3)
    # c is not in the distribution, so it passes through as its number
    assert got[2] == pytest.approx([0.0, 1.0, 0.0, (2 - mu) / sigma, 3.0])
    assert got[3][3] == 0.0


def test_profiles_and_keys(people):
    assert rows(X.distinct_profiles(people, ["k", "c"])) == [(1, -1, 1), (2, 3, 2), (5, -1, 1)]
    keyed = X.profile_key(people, ["k", "c"])
    assert keyed.select("profile_key").distinct().count() == 3


def test_hashed_features(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 0.0)], "w string, x double")
    got = [r[0] for r in X.hash_features(df, ["w"], ["x"], 64).select(vector_to_array("features")).collect()]
    assert len(got[0]) == 64 and sorted(v for v in got[0] if v) == [1.0, 2.0] and sum(got[1]) == 1.0


def test_lookup_keeps_rows(spark, people):
    small = spark.createDataFrame([(1, "one")], "k int, name string")
    for limit in (1 << 20, 0):
        assert rows(X.lookup(people, small, ["k"], max_bytes=limit).select("id", "name")) == [
            (1, "one"), (2, None), (3, None), (4, None)]


def test_sparse_vectors_equal_the_dense_ones(people):
    dist = D.attribute_distribution(people, ["x", "k", "c"])
    args = (people, "id", ["k", "x", "c"], ["k", "c"], dist)
    sparse = X.feature_vectors(*args).select("id", vector_to_array("features").alias("features"))
    assert rows(sparse) == rows(X.feature_matrix(*args))
