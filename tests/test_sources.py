from conftest import rows
from pyspark.sql import functions as F

from pairloom.operators.models import score_forest, train_forest
from pairloom.presets import MATCH_SPEC
from pairloom.sources import tables
from pairloom.spec import DatasetSpec

SPEC = DatasetSpec(fields=("id", "age", "city"), types={"city": "string"})


def test_text_nulls_short_rows_and_bad_numbers(spark, tmp_path):
    (tmp_path / "t.txt").write_text('1\tnull\ta\n2\tNULL\tNull\n3\t7\n4\tx\t"q\n')
    got = rows(tables.read_table(spark, str(tmp_path / "t.txt"), SPEC))
    assert got == [(1, None, "a"), (2, None, None), (3, 7, None), (4, None, '"q')]


def test_sample_profile_record(spark, tmp_path):
    line = "\t".join(str(v) for v in [900, 31, 44, 0, 2, 9, 3, 2, 1, 0, 3, 7, 181, 6, 1, 11, 5, 52, 8, 9, 4, 1, 12, 2, 3, 7, 66])
    (tmp_path / "u.txt").write_text(line + "\n")
    row = tables.read_table(spark, str(tmp_path / "u.txt"), MATCH_SPEC).first()
    assert (row.userid, row.sex, row.height, row.age, row.praise) == (900, 0, 181, 52, 66)


def test_many_files_are_tagged(spark, tmp_path):
    (tmp_path / "user_a.txt").write_text("1\t2\tx\n")
    (tmp_path / "user_b.txt").write_text("2\tnull\ty\n")
    (tmp_path / "other.txt").write_text("3\t3\tz\n")
    got = rows(tables.read_many(spark, str(tmp_path), SPEC).select("id", "age", "source_file"))
    assert got == [(1, 2, "user_a.txt"), (2, None, "user_b.txt")]


def test_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a b"), (2, 3, None)], "id int, age int, city string")
    tables.write_text(df, str(tmp_path / "out"))
    assert rows(tables.read_table(spark, str(tmp_path / "out"), SPEC)) == rows(df)


def test_split_directories(spark, tmp_path):
    df = spark.range(10).withColumn("sex", F.col("id") % 2)
    tables.write_split(df, "sex", str(tmp_path / "s"), {0: "male", 1: "female"})
    assert {p.name for p in (tmp_path / "s").glob("sex=*")} == {"sex=male", "sex=female"}
    assert tables.read_split(spark, str(tmp_path / "s"), "sex", "male").count() == 5


def test_summary_is_one_pass(spark):
    df = spark.range(10)
    got = tables.run_summary(df, {"total": F.lit(True), "even": F.col("id") % 2 == 0})
    assert rows(got) == [("even", 5), ("total", 10)]


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i % 2, i % 2, float(i)) for i in range(40)], "label int, kind int, x double")
    model = train_forest(df, "label", ["kind", "x"], ["kind"], trees=3)
    spec = DatasetSpec(fields=("label", "kind", "x"), categorical=("kind",))
    tables.save_model(model, str(tmp_path / "m"), spec)
    again, spec2 = tables.load_model(spark, str(tmp_path / "m"))
    assert spec2.categorical == ("kind",)
    assert rows(score_forest(again, df)) == rows(score_forest(model, df))
