import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pairloom.functions.distance import Metric
from pairloom.operators import cluster as C

MIXED = Metric("gower", ("k", "x"), ("k",), {"x": 10.0})


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(5)
    return spark.createDataFrame([(i, rng.choice("abc"), rng.randint(0, 10)) for i in range(200)], "id int, k string, x int")


@pytest.fixture(scope="module")
def centres(spark):
    data = [(i, "abc"[i % 3], float(i)) for i in range(10)] + [(99, "a", 0.0)]
    return spark.createDataFrame(data, "centre_id int, k string, x double")


def gower(p, c):
    return round(1 / (1 + ((p[1] == c[1]) + 1 - abs(p[2] - c[2]) / 10) / 2), 9)


def nearest(points, centres, ties):
    out = []
    all_centres = [tuple(c) for c in centres.collect()]
    for p in map(tuple, points.collect()):
        ds = [(gower(p, c), c[0]) for c in all_centres]
        best = min(ds)[0]
        ids = sorted(i for d, i in ds if d == best)
        out += [(*p, i, best) for i in (ids if ties == "all" else ids[:1])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("ties", ["all", "first"])
@pytest.mark.parametrize("sent_bytes", [1 << 20, 0])
def test_nearest(points, centres, ties, sent_bytes):
    got = C.assign_nearest(points, centres, MIXED, ties, sent_bytes=sent_bytes, per_task=3)
    assert rows(got) == nearest(points, centres, ties)


def test_nearest_is_map_only(points, centres):
    plan = C.assign_nearest(points, centres, MIXED)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_nearest_needs_centres(spark, points, centres):
    with pytest.raises(ValueError, match="no centres"):
        C.assign_nearest(points, centres.where("false"), MIXED)


@pytest.mark.parametrize("per_task", [1, 3])
def test_nearest_keeps_repeated_and_null_rows(spark, points, centres, per_task):
    """Centres in blocks give the same rows, whatever repeats or is NULL."""
    odd = points.unionByName(points).withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id")))
    small = C.assign_nearest(odd, centres, MIXED)
    assert rows(C.assign_nearest(odd, centres, MIXED, sent_bytes=0, per_task=per_task)) == rows(small) != []


def test_distances(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 4.0])], "x array<double>, y array<double>")
    x, y = (lambda c: (lambda f: F.col(c)))("x"), (lambda c: (lambda f: F.col(c)))("y")
    got = {n: df.select(Metric(n, ("v",))(x, y)).first()[0] for n in ("sq_euclidean", "hamming", "cosine")}
    assert got["sq_euclidean"] == 4.0 and got["hamming"] == 1.0 and got["cosine"] == pytest.approx(1 - 9 / (5 * 17) ** 0.5)
    with pytest.raises(ValueError, match="unknown distance"):
        df.select(Metric("nope", ("v",))(x, y))
    with pytest.raises(ValueError, match="no value range"):
        df.select(Metric("gower", ("v",))(x, y))


def test_gower_bounds(spark):
    df = spark.createDataFrame([("a", 1, "a", 1), ("a", 1, "b", 1), ("a", 0, "b", 10)], "k string, x int, k2 string, x2 int")
    side = (lambda f: F.col(f), lambda f: F.col(f + "2"))
    zero = Metric("gower", ("k", "x"), ("k",), {"x": 0.0})
    assert [r[0] for r in df.select(zero(*side)).collect()] == pytest.approx([0.5, 1 / 1.5, 1 / 1.5])
    assert [r[0] for r in df.select(MIXED(*side)).collect()] == pytest.approx([0.5, 1 / 1.5, 1.0])


def test_item_distance_drops_unknown(spark):
    items = spark.createDataFrame([(0, "a", [1.0, 1.0]), (7, "b", [0.0, 0.0])], "centre_id int, item string, features array<double>")
    cents = spark.createDataFrame([(0, [0.0, 3.0])], "centre_id int, features array<double>")
    assert rows(C.item_distance(items, cents, "item")) == [(0, "a", 5.0)]


def test_centre_of(spark):
    df = spark.createDataFrame(
        [(1, 7, "b", 1.0, 1), (1, 7, "b", 2.0, 1), (1, 3, "a", 3.0, 2), (2, 5, "z", 9.0, 4)], "g int, k int, s string, x double, n int"
    )
    got = rows(C.centre_of(df, ["g"], ["k", "s"], ["x"], "n").select("g", "k", "s", "x", "members"))
    assert got == [(1, "3", "a", 2.25, 4), (2, "5", "z", 9.0, 4)] or got == [(1, 3, "a", 2.25, 4), (2, 5, "z", 9.0, 4)]
    ints = rows(C.centre_of(df, ["g"], ["k"], []).select("g", "k", "members"))
    assert ints == [(1, 7, 3), (2, 5, 1)]


@pytest.fixture(scope="module")
def clustered(spark):
    rng = random.Random(9)
    data = [(rng.choice("ab"), *[rng.randint(0, 2) for _ in range(4)]) for _ in range(120)] + [("solo", 1, 1, 1, 1)]
    return data, spark.createDataFrame(data, "c string, p int, q int, r int, s int").repartition(5)


def histogram(data, width):
    out = Counter()
    for i, a in enumerate(data):
        for b in data[i + 1:]:
            if a[0] == b[0]:
                out[a[0], sum(x != y for x, y in zip(a[1:width + 1], b[1:width + 1]))] += 1
    return out


@pytest.mark.parametrize("fields", [["p"], ["p", "q"], ["p", "q", "r", "s"]])
def test_cohesion_and_histogram(clustered, fields):
    data, df = clustered
    brute = histogram(data, len(fields))
    hist = {(r.c, r.distance): int(r.pairs) for r in C.distance_histogram(df, "c", fields).collect()}
    assert hist == dict(brute)
    got = {r.c: r for r in C.cluster_cohesion(df, "c", fields).collect()}
    for c in "ab":
        pairs = sum(n for (k, _), n in brute.items() if k == c)
        close = brute[c, 0] + brute[c, 1]
        assert (got[c].members, int(got[c].pairs), int(got[c].equal_pairs), int(got[c].close_pairs)) == (
            sum(d[0] == c for d in data), pairs, brute[c, 0], close)
        assert got[c].close_pct == pytest.approx(100 * close / pairs)
    assert (got["solo"].members, int(got["solo"].pairs), got["solo"].close_pct) == (1, 0, None)
    mean = C.mean_cohesion(C.cluster_cohesion(df, "c", fields)).first()
    assert mean.clusters == 2


def test_wide_histogram_by_blocks(clustered, monkeypatch):
    data, df = clustered
    monkeypatch.setattr(C, "MAX_CUBE_FIELDS", 2)
    got = {(r.c, r.distance): int(r.pairs) for r in C.distance_histogram(df, "c", ["p", "q", "r", "s"], block=7).collect()}
    assert got == dict(histogram(data, 4))
    none = df.withColumn("c", F.lit(None).cast("string"))
    narrow = C.distance_histogram(none, "c", ["p"]).agg(F.sum("pairs")).first()[0]
    assert C.distance_histogram(none, "c", ["p", "q", "r", "s"], block=7).agg(F.sum("pairs")).first()[0] == narrow > 0


def test_bands(spark):
    values = [0.500, 0.505, 0.509, 0.511, 0.530]
    data = [("a", v) for v in values] + [("b", 0.7), (None, 0.2), (None, 0.3)]
    df = spark.createDataFrame(data, "g string, distance double")
    got = rows(C.distance_bands(df, ["g"]).select("g", "distance", "band", "band_start"))
    assert got == [("a", 0.5, 0, 0.5), ("a", 0.505, 0, 0.5), ("a", 0.509, 0, 0.5), ("a", 0.511, 1, 0.511),
                   ("a", 0.53, 2, 0.53), ("b", 0.7, 0, 0.7), (None, 0.2, 0, 0.2), (None, 0.3, 1, 0.3)]


def test_bands_of_many_values_agree(spark):
    rng = random.Random(12)
    data = [(g, round(0.5 + rng.random() ** 2 / 2, 6)) for g in "abc" for _ in range(400 if g != "c" else 1)]
    df = spark.createDataFrame(data, "g string, distance double")
    want = []
    for g in "abc":
        starts: list[float] = []
        for v in sorted({v for k, v in data if k == g}):
            if not starts or v > round(starts[-1] + 0.06, 9):
                starts.append(v)
        want += [(g, i, v) for i, v in enumerate(starts)]
    for n in (1, 5):
        assert rows(C.band_starts(df.repartition(n), ["g"], delta=0.06)) == sorted(want)


def test_mode_of_a_tie_is_typed(spark):
    """Whole numbers stay numbers beside texts: 9 comes before 10."""
    df = spark.createDataFrame([(1, 10, "b", 0.5), (1, 9, "a", 1.5)], "g int, k int, c string, x double")
    assert rows(C.centre_of(df, ["g"], ["k", "c"], ["x"]).select("k", "c", "x", "members")) == [(9, "a", 1.0, 2)]


def test_distance_profile(spark):
    data = [(0, i, d) for i, d in enumerate([0.5, 0.7, 0.6, 0.6])] + [(1, 9, 0.55)]
    df = spark.createDataFrame(data, "c int, id int, distance double")
    got = {(r.c, r.id): (r.x, round(r.y, 6)) for r in C.distance_profile(df, "c", "id").collect()}
    assert got == {(0, 0): (-2, -100.0), (0, 2): (-1, 0.0), (0, 3): (0, 0.0), (0, 1): (1, 100.0), (1, 9): (0, 0.0)}


def test_kmeans_separates_and_step_agrees(spark):
    rng = random.Random(2)
    data = [(i, [rng.gauss(c * 10, 1), rng.gauss(-c * 10, 1)]) for i, c in enumerate([0, 1, 2] * 40)]
    df = spark.createDataFrame(data, "id int, features array<double>")
    model, assigned = C.kmeans(df, 3, seed=1)
    cents = C.cluster_centres(spark, model)
    again = C.kmeans(df, 3, seed=1)[1]
    assert rows(assigned.select("id", "centre_id")) == rows(again.select("id", "centre_id"))
    assert sum(r.members for r in C.cluster_sizes(assigned).collect()) == 120

    def inertia(c):
        near = C.assign_nearest(df, c, Metric("sq_euclidean", ("features",)), "first")
        return near.agg(F.sum("distance")).first()[0]

    start = df.where("id < 3").select(F.col("id").alias("centre_id"), "features")
    moved = C.kmeans_step(df, start).select("centre_id", "features")
    assert inertia(moved) <= inertia(start)
    settled = C.kmeans_step(df, cents).select("centre_id", "features")
    assert inertia(cents) - inertia(settled) == pytest.approx(0, abs=1e-6)
    far = start.unionByName(spark.createDataFrame([(50, [1e6, 1e6])], "centre_id int, features array<double>"))
    lonely = {r.centre_id: r for r in C.kmeans_step(df, far).collect()}[50]
    assert (lonely.members, lonely.features) == (0, [1e6, 1e6])


def test_split_clustering_converges(spark):
    data = [(k, x, 1 + x % 3) for k in "ab" for x in range(0, 100, 5)]
    profiles = spark.createDataFrame(data, "k string, x int, n bigint")
    metric = Metric("gower", ("k", "x"), ("k",), {"x": 95.0})
    centres, rounds = C.split_clustering(profiles, metric, k=2, delta=0.02, max_iter=20, seed=3)
    assert rounds < 20 and centres.where("not converged").count() == 0
    keyed = centres.withColumn("centre_id", F.to_json(F.struct("k", "x")))
    near = C.assign_nearest(profiles, keyed, metric, "all")
    spread = near.groupBy("centre_id").agg((F.max("distance") - F.min("distance")).alias("w"))
    assert spread.agg(F.max("w")).first()[0] <= 0.02 + 1e-9
    again, _ = C.split_clustering(profiles.repartition(5), metric, k=2, delta=0.02, max_iter=20, seed=3)
    assert rows(again) == rows(centres)


def test_lloyd_by_gower_stands_still(spark):
    rng = random.Random(9)
    data = [(i, "ab"[i % 2], rng.random() + 4 * (i % 2)) for i in range(60)]
    df = spark.createDataFrame(data, "id int, c string, x double")
    metric = Metric("gower", ("c", "x"), ("c",), {"x": 5.0})
    centres, assigned, rounds = C.lloyd(df, metric, 2, seed=4)
    assert rounds < 100 and assigned.count() == 60 and centres.count() == 2
    again = C.assign_nearest(df, centres, metric, "first")
    assert rows(again.select("id", "centre_id")) == rows(assigned.select("id", "centre_id"))
