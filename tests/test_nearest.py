"""Pruned nearest centres, bands over range partitions and incremental split clustering against plain versions."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pairloom.functions.distance import Metric
from pairloom.operators import cluster as C, nearest as N

GOWER = Metric("gower", ("k", "s", "x", "y"), ("k", "s"), {"x": 100.0, "y": 7.0})
ODD = (None, "", "x")


def frame(n, seed, missing=False):
    r = random.Random(seed)
    return pd.DataFrame(
        {
            "_id": range(n), "k": [r.randint(0, 6) for _ in range(n)],
            "s": [r.choice(ODD if missing else "abcd") for _ in range(n)],
            "x": [float("nan") if missing and r.random() < 0.1 else float(r.randint(0, 100)) for _ in range(n)], "y": [float(r.randint(0, 7)) for _ in range(n)],
            "v": [[r.random() for _ in range(3)] for _ in range(n)],
        }
    )


def plain(metric, points, centres):
    d = metric.to_all(points, centres)
    best = np.fmin.reduce(d, axis=1)
    return [(b, sorted(centres["_id"][np.flatnonzero(row == b)])) if b == b else (np.inf, []) for b, row in zip(best, d)]


@pytest.mark.parametrize("missing", [False, True])
@pytest.mark.parametrize("metric", [GOWER, Metric("sq_euclidean", ("v",)), Metric("sq_euclidean", ("x", "y")), Metric("hamming", ("k", "y")), Metric("cosine", ("v",))])
def test_leaves_find_what_comparing_everything_finds(metric, missing):
    points, centres = frame(300, 1, missing), frame(500, 2, missing)
    found, compared = N.Index(metric, centres, leaf=16).nearest(points)
    assert [(d, sorted(i)) for d, i in zip(found["d"], found["ids"])] == plain(metric, points, centres)
    assert compared <= 300 * 500 and (metric is not GOWER or missing or compared < 300 * 500 / 3)


@pytest.mark.parametrize("metric", [GOWER, Metric("sq_euclidean", ("v",)), Metric("hamming", ("k", "y"))])
def test_blocks_find_the_same(spark, metric):
    cols = "_id long, k long, s string, x double, y double, v array<double>"
    p, c = frame(400, 3), frame(900, 4)
    points, centres = (spark.createDataFrame(f, cols).withColumnRenamed("_id", i) for f, i in ((p, "id"), (c, "centre_id")))
    want = sorted((i, j, d) for i, (d, ids) in enumerate(plain(metric, p, c)) for j in ids)
    for options in ({}, {"sent_bytes": 0, "per_task": 100}, {"sent_bytes": 0, "per_task": 10_000}):
        got = N.assign_nearest(points, centres, metric, "all", **options).select("id", "centre_id", "distance")
        assert rows(got) == sorted(want, key=repr)
    counted = N.pairs_compared(points, centres, metric, sent_bytes=0, per_task=100).first()
    assert counted.points == 400 and counted.centres == 900 and 0 < counted.compared <= 360_000
    assert counted.skipped_share == pytest.approx(1 - counted.compared / 360_000)
    if metric is GOWER:
        assert counted.skipped_share > 0.5


def greedy(values, delta=0.01):
    out = []
    for v in sorted(set(values)):
        if not out or v > round(out[-1] + delta, 9):
            out.append(v)
    return out


def test_one_group_over_many_parts(spark, monkeypatch):
    """Sixteen parts hold one large group and ends of others: band starts go on across their borders."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = random.Random(2)
        data = [("hot", round(0.5 + r.random() / 2, 6)) for _ in range(6000)] + [(None, round(r.random(), 9)) for _ in range(300)] + [("a", 0.7), ("z", 0.1), ("z", 0.11), ("z", 0.110000001)]
        df = spark.createDataFrame(data, "g string, distance double").repartition(5)
        starts = {}
        for row in C.band_starts(df, ["g"]).collect():
            starts.setdefault(row.g, []).append((row.band, row.band_start))
        for g in ("hot", None, "a", "z"):
            want = greedy([d for k, d in data if k == g])
            assert sorted(starts[g]) == list(enumerate(want))
        assert C.distance_bands(df, ["g"]).count() == len(data)
        placed = df.select("g", F.round("distance", 9).alias("d")).distinct().repartitionByRange("g", "d")
        assert placed.where("g = 'hot'").select(F.spark_partition_id()).distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_jump_functions_compose():
    r = random.Random(1)
    for _ in range(400):
        delta = r.choice([0.01, 0.05, 0.3])
        values = sorted({round(r.random(), r.choice([2, 3, 9])) for _ in range(r.randint(1, 60))})
        last, made = None, 0
        cuts = sorted({0, len(values), *[r.randint(0, len(values)) for _ in range(4)]})
        for a, b in zip(cuts, cuts[1:]):
            jumps, part = C.Jumps(delta), np.array(values[a:b])
            for x in np.array_split(part, r.randint(1, len(part))):
                jumps.feed(x)
            entry, start, count, past = jumps.pack()
            last, new = C.jump(np.array(entry), np.array(start), np.array(count), past, last, delta)
            made += new
        want = greedy(values, delta)
        assert (last, made) == (want[-1], len(want))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_clustering_compares_added_centres_only(spark, monkeypatch, seed):
    """The centres are those of comparing all profiles with all centres in every round."""
    r = random.Random(seed)
    data = [(r.randint(0, 3), r.choice("abc"), float(r.randint(0, 60)), r.randint(1, 5)) for _ in range(150)]
    metric = Metric("gower", ("k", "s", "x"), ("k", "s"), {"x": 60.0})
    profiles = spark.createDataFrame(data, "k long, s string, x double, n long").groupBy("k", "s", "x").agg(F.sum("n").alias("n"))
    fields = ["k", "s", "x"]
    now = spark.createDataFrame(C.seed_centres(profiles, fields, ["x"], 4).collect())
    seen, fresh = [], [now.count()]
    for rounds in range(1, 8):
        after = spark.createDataFrame(C.split_step(profiles, now, metric, delta=0.02).collect(), "k long, s string, x double, converged boolean")
        added = after.join(now, fields, "left_anti").count()
        state = (rows(after.select(*fields)), after.where("not converged").count())
        stop = state[1] == 0 or (added == 0 and after.count() == now.count())
        seen.append(state)
        now = after.select(*fields)
        if stop:
            break
        fresh.append(added)
    given = []
    best_of = C.best_of
    monkeypatch.setattr(C, "best_of", lambda p, c, *a, **b: (given.append(c.count()), best_of(p, c, *a, **b))[1])
    centres, done = C.split_clustering(profiles, metric, 4, delta=0.02, max_iter=7)
    assert done == rounds and rows(centres.select(*fields)) == seen[-1][0] and centres.where("not converged").count() == seen[-1][1]
    assert given == [f for f in fresh if f] and len(given) > 1
