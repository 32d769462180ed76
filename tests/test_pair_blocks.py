"""All pairs of a few keys, scored by a forest: spread over many tasks, and nothing but winners leaves them."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pairloom.operators import models, ordering
from pairloom.operators.blocks import pair_blocks


@pytest.fixture(scope="module")
def sides(spark):
    r = random.Random(3)
    left = spark.createDataFrame([(i, r.choice(["a", "a", "b", None, "only"]), r.choice("xyz"), r.random()) for i in range(300)], "l long, file string, m_k string, m_x double")
    right = spark.createDataFrame([(1000 + i, r.choice(["a", "a", "b", None]), r.choice("xyzw"), r.random()) for i in range(260)], "r long, file string, f_k string, f_x double")
    return left, right


@pytest.mark.parametrize("block", [16, 1024])
def test_every_pair_of_a_key_once(sides, block):
    left, right = sides
    want = left.join(right.withColumnRenamed("file", "_file"), F.col("file").eqNullSafe(F.col("_file"))).select("l", "r", "file")
    assert rows(pair_blocks(left, right, ["file"], "l", "r", block).select("l", "r", "file")) == rows(want)


def test_one_key_lies_in_many_tasks(spark):
    left, right = (spark.range(400).select(F.col("id").alias(n), F.lit("hot").alias("file")) for n in ("l", "r"))
    placed = pair_blocks(left, right, ["file"], "l", "r", 50).groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = sorted(r["count"] for r in placed)
    assert sum(sizes) == 160_000 and len(sizes) > 16 and sizes[-1] < 40_000


def test_no_block_shares_a_key(spark):
    left, right = (spark.range(5).select(F.col("id").alias(n), F.lit(n).alias("file")) for n in ("l", "r"))
    pairs = pair_blocks(left, right, ["file"], "l", "r")
    kept = ordering.best_of_tasks(pairs.withColumn("score", F.lit(1.0)), "l", "r").agg(F.coalesce(F.sum("pairs"), F.lit(0)), F.count("user_id")).first()
    assert tuple(kept) == (0, 0)


@pytest.mark.parametrize("at_once", [1, 1 << 20])
def test_winners_of_tasks_hold_the_best_matches(sides, monkeypatch, at_once):
    monkeypatch.setattr(ordering, "PAIRS_AT_ONCE", at_once)
    scored = pair_blocks(*sides, ["file"], "l", "r", 40).select("l", "r", F.round(F.pmod(F.xxhash64("l", "r"), F.lit(20)) / 20, 2).alias("score"))
    hit = scored.where("score >= 0.5")
    both = hit.selectExpr("l as user_id", "r as other_id", "score").unionByName(hit.selectExpr("r as user_id", "l as other_id", "score"))
    kept = ordering.best_of_tasks(scored, "l", "r", n=7)
    assert kept.agg(F.sum("pairs")).first()[0] == scored.count()
    got = ordering.top_matches(kept.where("pairs is null").drop("pairs"), "user_id", "other_id", n=7)
    assert rows(got) == rows(ordering.top_matches(both, "user_id", "other_id", n=7))
    assert kept.count() < both.count()


def test_sides_are_indexed_once(spark, sides):
    left, right = sides
    pairs = pair_blocks(left, right, ["file"], "l", "r")
    train = pairs.withColumn("y", ((F.col("m_k") == F.col("f_k")) != (F.col("m_x") > F.col("f_x"))).cast("int"))
    train = train.where("f_k <> 'w'")  # a value that training has not seen
    model = models.train_forest(train, "y", ["m_k", "m_x", "f_k", "f_x"], ["m_k", "f_k"], trees=3, max_depth=5)
    want = models.score_forest(model, pairs).select("l", "r", "score", "prediction")
    ready = [models.index_inputs(model, side) for side in sides]
    assert "m_k" not in ready[0].columns and "m_k__ix" in ready[0].columns and "m_x" in ready[0].columns
    assert rows(models.score_forest(model, pair_blocks(*ready, ["file"], "l", "r")).select("l", "r", "score", "prediction")) == rows(want)
