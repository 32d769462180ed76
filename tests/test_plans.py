import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pairloom.operators import models
from pairloom.operators.evaluate import auc
from pairloom.plans import match, payment, roi, segments
from pairloom.plans.match import MatchRoles
from pairloom.sources.tables import write_text
from pairloom.spec import DatasetSpec, Range, ResponseCodes

SPEC = DatasetSpec(
    fields=("memberid", "iszat", "sex", "birthday", "workcity", "marriage", "logincount"),
    categorical=("iszat", "sex", "marriage"),
    ignored=("workcity",),
    predictors=("sex", "birthday", "marriage", "logincount", "workcity"),
    target="iszat",
)


@pytest.fixture(scope="module")
def payments(spark):
    rng = random.Random(6)
    data = []
    for i in range(2000):
        logins = rng.randint(0, 30)
        paid = int(logins + rng.randint(-6, 6) > 18)
        data.append((i, paid, i % 2, f"{1960 + i % 40}-01-01", i % 5, None if i % 97 == 0 else i % 4, logins))
    return spark.createDataFrame(
        data, "memberid int, iszat int, sex int, birthday string, workcity int, marriage int, logincount int"
    )


@pytest.fixture(scope="module")
def logistic(payments):
    spec = payment.logistic_spec(SPEC, 200)
    split = payment.payment_split(payments, "2014-01-01")
    return spec, split, payment.payment_logistic(split, spec)


def test_logistic_separates(logistic):
    spec, split, (_, scored) = logistic
    report = payment.evaluate_scores(scored, spec.label)
    assert (spec.categorical, spec.numeric) == (("sex", "marriage"), ("birthday", "logincount"))
    assert report.auc.first().auc > 0.9
    assert report.confusion.agg(F.sum("cnt")).first()[0] == split.where("split = 'test'").count() == scored.count()
    assert report.entropy.count() >= 2


def test_coefficients_are_named(logistic):
    spec, split, (model, _) = logistic
    table = models.coefficient_table(model, split.where("split = 'train'"), spec)
    weights = {r.predictor: r.weight for r in table.collect()}
    assert weights["logincount"] > 0 and "(intercept)" in weights
    assert set(weights) <= {"logincount", "birthday", "(intercept)", *[f"sex={v}" for v in "01"],
                            *[f"marriage={v}" for v in "0123"]}


def test_scores_follow_from_the_weights(logistic, payments):
    """The named weights reproduce the model's own score."""
    spec, split, (model, scored) = logistic
    w = {r.predictor: r.weight for r in models.coefficient_table(model, split.where("split = 'train'"), spec).collect()}
    import math

    for r in scored.limit(20).collect():
        z = w["(intercept)"] + w.get("birthday", 0) * r.birthday + w.get("logincount", 0) * r.logincount
        z += w.get(f"sex={r.sex}", 0) + w.get(f"marriage={r.marriage}", 0)
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_propensity(logistic, payments, tmp_path, spark):
    spec, _, (model, _) = logistic
    got = payment.payment_predict(model, payments, spec, "2014-01-01")
    assert got.columns == ["memberid", "workcity", "sex", "iszat", "score", "likelihood", "predicted"]
    assert got.where("iszat = 1").count() == 0
    assert got.count() == payments.where("iszat = 0 and marriage is not null").count()
    assert got.where("predicted <> cast(score >= 0.5 as int)").count() == 0
    payment.write_predictions(got, str(tmp_path / "p"))
    assert {p.name for p in (tmp_path / "p").glob("predicted=*")} == {"predicted=pay", "predicted=nopay"}


def test_payment_forest(payments):
    _, confusion, acc = payment.payment_forest(payment.payment_split(payments, "2014-01-01"), SPEC)
    assert acc.first().accuracy > 0.8 and confusion.count() >= 2


def test_forest_regression(spark):
    df = spark.createDataFrame([(float(i % 10), i % 10) for i in range(200)], "y double, x int")
    model = models.train_forest(df, "y", ["x"], [], trees=3, regression=True)
    err = models.score_forest(model, df).select(F.max(F.abs(F.col("score") - F.col("y")))).first()[0]
    assert err < 3


def test_stop_rules(spark):
    """A split must gain a share of the root's variance; depth is a limit of its own."""
    noise = spark.createDataFrame([(float(i >= 32) * 100 + (i * 7) % 5, i) for i in range(64)], "y double, x int")
    depth = lambda **o: models.train_forest(noise, "y", ["x"], [], trees=1, regression=True, bootstrap=False, **o).stages[-1].trees[0].depth
    assert depth() == 1 and depth(min_variance_share=0.0) > 3 and depth(min_variance_share=0.0, max_depth=2) == 2
    coin = spark.createDataFrame([(i % 2, (i * 37) % 101, (i * 53) % 97) for i in range(400)], "y int, x int, z int")
    grown = models.train_forest(coin, "y", ["x", "z"], [], trees=1, bootstrap=False)
    cut = models.train_forest(coin, "y", ["x", "z"], [], trees=1, bootstrap=False, min_variance_share=0.2)
    assert grown.stages[-1].trees[0].depth > 5 > cut.stages[-1].trees[0].depth
    audit = models.leaf_audit(grown, coin, "y").agg(F.sum("rows"), F.sum("differing"), F.countDistinct("leaf")).first()
    assert tuple(audit)[:2] == (400, 0) and audit[2] == models.tree_nodes(grown).count() > 10
    # a tree that has seen a sample votes differently from what stands in its leaves
    sampled = models.train_forest(coin, "y", ["x", "z"], [], trees=1)
    assert models.leaf_audit(sampled, coin, "y").agg(F.sum("differing")).first()[0] > 0


def test_three_classes(spark):
    data = [("red" if x < 3 else "blue" if x < 6 else "green", x, "k" if x % 2 else None) for x in range(9) for _ in range(20)]
    df = spark.createDataFrame([*data, (None, 1, "k")], "colour string, x int, w string")
    spec = models.LogisticSpec("colour", ("w",), ("x",), 64)
    model = models.train_classes(df, spec, 300, 0.001, 1e-10)
    assert models.class_list(model) == ["blue", "green", "red"]
    known = df.where("colour is not null")
    scored = models.score_classes(model, known, spec)
    assert scored.where("predicted = colour").count() > 170
    assert scored.select(F.max(F.abs(F.aggregate(F.map_values("scores"), F.lit(0.0), lambda a, v: a + v) - 1))).first()[0] < 1e-9
    table = models.coefficient_table(model, known, spec)
    assert {r["class"] for r in table.collect()} == {"blue", "green", "red"}
    worst = models.optimality(model, df, spec, 0.001).agg(F.max("excess")).first()[0]
    early = models.train_classes(df, spec, 1, 0.001)
    assert worst < 1e-5 < models.optimality(early, df, spec, 0.001).agg(F.max("excess")).first()[0]


def test_match_pipeline(spark, tmp_path):
    rng = random.Random(11)
    people = [(i, i % 2, 170, 30, 1 + i % 3, rng.randint(0, 3)) for i in range(300)]
    profiles = spark.createDataFrame(people, "userid int, sex int, height int, age int, marriage int, k int")
    kind = {p[0]: p[5] for p in people}
    acts = []
    for _ in range(4000):
        a, b = rng.randint(0, 299), rng.randint(0, 305)
        acts.append((a, b, "1" if kind.get(a) == kind.get(b) else "2"))
    actions = spark.createDataFrame(acts, "aid int, bid int, resp string")
    roles = MatchRoles(("k",), ("k", "marriage"), ("k", "marriage"))
    codes = ResponseCodes(("1",), ("2",))
    model = match.train_match_model(actions, profiles, codes, roles, trees=5)
    confusion, acc = match.evaluate_match_model(model, actions, profiles, codes.positives, roles)
    assert acc.first().accuracy > 0.8
    assert rows(match.unmatched_totals(match.build_action_table(actions, codes), profiles, roles))[-2:] == rows(match.unmatched_totals(match.build_action_table(actions, codes).repartition(3), profiles, roles))[-2:]
    best = match.predict_matches(profiles, model, roles, top_n=3)
    checked = best.collect()
    assert sum(kind[r.user_id] == kind[r.other_id] for r in checked) > 0.8 * len(checked) > 0
    assert best.groupBy("user_id").count().agg(F.max("count")).first()[0] == 3

    spec = DatasetSpec(fields=tuple(profiles.columns))
    for part in (0, 1):
        write_text(profiles.where(F.col("userid") % 4 >= 2 * part).where(F.col("userid") % 4 < 2 * part + 2), str(tmp_path / f"user_{part}"))
    own = match.predict_matches_of_files(spark, str(tmp_path), spec, model, roles, top_n=3).collect()
    assert own and all(r.user_id % 4 // 2 == r.other_id % 4 // 2 for r in own)


def test_roi(spark):
    rng = random.Random(3)
    data = []
    for i in range(600):
        parts = [rng.random() * 10 for _ in range(2)]
        data.append((i, f"c{i % 3}", i % 12, *parts, sum(parts)))
    df = spark.createDataFrame(data, "id int, channel string, month int, income0 double, income1 double, total double")
    groups = roi.roi_groups(df, "id", ["channel", "month", "id"], ["income0", "income1", "total"])
    assert groups.where("split = 'test'").count() == 180
    linear = roi.roi_model(groups, ["channel", "month"], ["income0", "income1"], passes=50)
    assert linear.reports["regression"].first().corr > 0.99
    binary = roi.roi_model(groups, ["channel", "month"], ["income0", "income1"], cut=10.0, passes=50)
    assert binary.reports["auc"].first().auc > 0.95 and binary.reports["confusion"].count() >= 2


@pytest.fixture(scope="module")
def people(spark):
    data = [(i, i % 2, 20 + (i * 7) % 50, 1 + i % 5, None if i % 11 == 0 else i % 3, 150 + i % 60) for i in range(200)]
    return spark.createDataFrame(data, "userid int, sex int, age int, marriage int, k int, height int")


RANGES = (Range("age", 10, 100), Range("height", 100, 200))


def test_cluster_users(people):
    found = segments.cluster_users(people, ["age", "k"], ["k"], RANGES, k=3)
    assert set(found) == {"male", "female"}
    valid = people.where("height <= 200 and sex = 0").count()
    assert found["male"].items.count() == valid and found["male"].centres.count() == 3
    counted = found["male"].profile.where("attr = 'k'").agg(F.sum("cnt")).first()[0]
    assert counted == valid


def test_split_cluster_users(people):
    found = segments.split_cluster_users(people, ["age", "k"], ["k"], RANGES, k=3, delta=0.05, max_iter=4)
    centres, near = found["female"]
    assert centres.count() >= 3
    weights = near.select("age", "k", "n").distinct().agg(F.sum("n")).first()[0]
    assert weights == people.where("height <= 200 and sex = 1").count()
    assert auc(near.select(F.lit(1).alias("y"), F.lit(0.5).alias("p")), "y", "p").first().auc is None


def test_cluster_items_with_text_and_fractions(spark):
    rng = random.Random(5)
    data = [(i, rng.choice("ab"), rng.random() + 5 * (i % 2)) for i in range(60)]
    found = segments.cluster_items(spark.createDataFrame(data, "id int, c string, x double"), "id", ["c", "x"], ["c"], k=2)
    assert found.items.count() == 60 and found.profile.where("attr = 'c'").agg(F.sum("cnt")).first()[0] == 60
    metric = segments.profile_metric(spark.createDataFrame([(0.2,), (2.7,)], "x double"), ["x"], [])
    assert metric.ranges == {"x": 2.5}
