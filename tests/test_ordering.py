import random

from conftest import rows
from pyspark.sql import functions as F

from pairloom.operators import evaluate as E
from pairloom.operators import ordering as O


def brute(data):
    out, seen = [], {}
    for g, v, w in sorted(data, key=lambda t: (t[0] is not None, t[0], t[1])):
        n, s = seen.get(g, (0, 0))
        out.append((g, v, w, n, s))
        seen[g] = (n + 1, s + w)
    return sorted(out, key=repr)


def test_running_totals_with_one_hot_group(spark):
    rng = random.Random(1)
    data = [("hot", i, rng.randint(0, 9)) for i in range(3000)]
    data += [(f"g{i % 50}", i, rng.randint(0, 9)) for i in range(500)] + [(None, i, 1) for i in range(20)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v int, w int").repartition(8)
    got = O.running_totals(df, ["g"], ["v"], {"before": "w"})
    assert got.columns == ["g", "v", "w", "pos", "before"]
    assert rows(got) == brute(data)


def test_hot_group_is_spread_over_partitions(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("g"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = df.repartitionByRange("g", "v").groupBy(F.spark_partition_id()).count().collect()
        got = O.running_totals(df, ["g"], ["v"]).agg(F.max("pos"), F.countDistinct("pos")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(placed) == 8 and max(r[1] for r in placed) < 10_000
    assert tuple(got) == (39_999, 40_000)


def test_empty_group_list(spark):
    df = spark.createDataFrame([(3, 1), (1, 5), (2, 2)], "v int, w int")
    assert rows(O.running_totals(df, [], ["v"], {"before": "w"})) == [(1, 5, 0, 0), (2, 2, 1, 5), (3, 1, 2, 7)]


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    first = rows(O.sample_k(df.repartition(3), "id", 10, 1))
    assert first == rows(O.sample_k(df.repartition(7), "id", 10, 1)) and len(first) == 10
    assert first != rows(O.sample_k(df, "id", 10, 2))
    assert O.sample_k(df, "id", 5000).count() == 1000


def test_top_matches_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, o, s) for o, s in [(5, 0.5), (4, 0.9), (3, 0.5), (2, 0.1)]], "u int, o int, score double")
    got = O.top_matches(df, "u", "o", n=2)
    assert rows(got) == [(1, 3, 0.5, 2), (1, 4, 0.9, 1)]
    big = spark.range(1000).select((F.col("id") % 3).alias("u"), F.col("id").alias("o"), F.rand(1).alias("score")).repartition(4)
    plan = O.top_matches(big, "u", "o", n=2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def auc_of(spark, data):
    return E.auc(spark.createDataFrame(data, "y int, p double"), "y", "p").first().auc


def test_auc(spark):
    assert auc_of(spark, [(1, 0.9), (0, 0.1)]) == 1.0
    assert auc_of(spark, [(1, 0.5), (0, 0.5), (0, 0.5)]) == 0.5
    assert auc_of(spark, [(1, 0.5), (1, 0.2)]) is None
    rng = random.Random(3)
    data = [(rng.randint(0, 1), rng.randint(0, 20) / 20) for _ in range(400)]
    p = [s for y, s in data if y == 1]
    q = [s for y, s in data if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in p for b in q) / (len(p) * len(q))
    assert abs(auc_of(spark, data) - wins) < 1e-12


def test_reports(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (0, 0.2)], "y int, p double")
    confusion = E.confusion_matrix(df, "y", "p")
    assert rows(confusion) == [(0, 0, 2), (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    assert tuple(E.accuracy(confusion, "y").first()) == (5, 3, 0.6)
    assert E.entropy_matrix(df, "y", "p").count() == 4
    reg = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "y double, p double")
    r = E.regression_report(reg, "y", "p").first()
    assert (r.n, r.mae, r.rmse, r.bias, r.corr) == (2, 1.0, 1.0, 0.0, None)
