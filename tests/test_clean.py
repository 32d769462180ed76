import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pairloom.functions import scalars as S
from pairloom.operators import clean
from pairloom.spec import DatasetSpec, Range

PROFILE = "userid int, height int, age int, sex int, marriage int"
GOOD = (170, 30, 0, 3)


def profiles(spark, *variants):
    return spark.createDataFrame([(i, *v) for i, v in enumerate(variants)], PROFILE)


def test_valid_profile_edges(spark):
    df = profiles(
        spark, GOOD, (0, 30, 0, 3), (170, 0, 0, 3), (170, 100, 0, 3), (170, 99, 1, 9), (170, 30, 2, 3),
        (170, 30, 0, 0), (170, 30, 0, 10), (None, 30, 0, 3), (170, None, 0, 3), (170, 30, None, 3), (170, 30, 0, None),
    )
    assert [r.userid for r in clean.valid_profile(df).orderBy("userid").collect()] == [0, 4]


def test_ranges_treat_null_as_minus_one(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 11), (4, 10)], "id int, x int")

    def ids(*ranges):
        return [r.id for r in clean.in_ranges(df, ranges).orderBy("id").collect()]

    assert ids(Range("x", 5, 10)) == [1, 4]
    assert ids(Range("x", None, 10)) == [1, 2, 4]
    assert ids(Range("x", -1, None)) == [1, 2, 3, 4]
    assert ids(Range("x", 0, None)) == [1, 3, 4]
    assert ids() == ids(Range("x", None, None)) == [1, 2, 3, 4]


def test_range_reaches_the_scan(spark, tmp_path):
    spark.range(10).toDF("x").write.parquet(str(tmp_path / "p"))
    plan = clean.in_ranges(spark.read.parquet(str(tmp_path / "p")), [Range("x", 2, 5)])
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(x,2)" in text and "LessThanOrEqual(x,5)" in text


def test_age(spark):
    texts = ["1980-05-01", "1980-5-1", "42", "null", "19-x", "", None, "2001-13-01"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, b string")
    got = [r.a for r in df.select("i", S.age_years("b", "2014-04-18").alias("a")).orderBy("i").collect()]
    assert got == [34, 34, 42, 0, 0, 0, 0, 0]


def test_valid_payment(spark):
    df = spark.createDataFrame(
        [(1, "1980-01-01", 3), (2, "1980-01-01", None), (3, "bad", 3), (4, "99", 10), (5, "100", 0), (6, "50", 11)],
        "memberid int, birthday string, marriage int",
    )
    assert rows(clean.valid_payment(df, "2014-01-01")) == [(1, 34, 3), (4, 99, 10)]


def test_labels(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["1", "3", "4", "0", "9", None])], "i int, resp string")
    dropped = clean.label_response(df, "resp", ["1", "2", "3"], ["3", "4", "5"]).select("i", "label")
    assert rows(dropped) == [(0, 1), (1, 1), (2, 0)]
    kept = clean.label_response(df, "resp", ["1"], [], default=0).select("i", "label")
    assert [r[1] for r in rows(kept)] == [1, 0, 0, 0, 0, 0]


def test_sentinels_roles_and_ignored(spark):
    df = spark.createDataFrame([(1, None, 2.5), (2, 7, None)], "id int, a int, b double")
    assert rows(clean.null_to(df, -1)) == [(1, -1, 2.5), (2, 7, -1.0)]
    assert rows(clean.null_to(df, 0, ["a"])) == [(1, 0, 2.5), (2, 7, None)]
    role = clean.project_role(df, ["b", "a"], "m_", keep=["id"])
    assert role.columns == ["id", "m_b", "m_a"] and rows(role) == [(1, 2.5, -1), (2, -1.0, 7)]
    spec = DatasetSpec(fields=("id", "a", "b"), ignored=("b",))
    assert clean.drop_ignored(df, spec).columns == ["id", "a"]


def test_gender_frames(spark):
    df = spark.createDataFrame([(1, 5, 0, None), (2, 5, 1, 3), (3, 6, 2, 3)], "userid int, workcity int, sex int, x int")
    sides = clean.split_by_gender(df)
    assert rows(sides["male"]) == [(1, 5, -1)] and rows(sides["female"]) == [(2, 5, 3)]
    keyed = clean.key_by_gender_city(df).select("sex", "workcity", "userid", "features.x")
    assert rows(keyed) == [(0, 5, 1, -1), (1, 5, 2, 3), (2, 6, 3, 3)]


def test_stateless_operators_run_on_streams(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, 2, "1"), (3, 3, "1"), (4, 5, "9")], "aid int, bid int, resp string").write.parquet(str(src))
    stream = spark.readStream.schema("aid int, bid int, resp string").parquet(str(src))
    out = clean.label_response(clean.drop_self_pairs(stream), "resp", ["1"], ["2"])
    q = out.writeStream.format("memory").queryName("labelled").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("labelled")) == [(1, 2, "1", 1)]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(3.0, 1.0), (0.0, 0.0)], "a double, b double")
    got = df.select(S.share("a", "b"), S.per("a", "b"), S.max_scaled("a", F.lit(6.0)), S.mean_centred("a", F.lit(1.0)),
                    S.log_scaled("a")).collect()
    assert tuple(got[0]) == pytest.approx((0.75, 3.0, 0.5, 2.0, math.log(3)))
    assert tuple(got[1]) == (0.0, 0.0, 0.0, 0.0, None)


def test_log_likelihood(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.75), (1, 0.0), (1, 1.0), (0, 0.0), (1, None)], "y int, p double")
    got = [r[0] for r in df.select(S.log_likelihood("y", "p")).collect()]
    assert got[:5] == pytest.approx([math.log(0.5), math.log(0.25), -100.0, 0.0, 0.0]) and got[5] is None
