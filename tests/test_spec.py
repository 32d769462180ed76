import pytest

from pairloom import presets
from pairloom.spec import DatasetSpec, Range, ResponseCodes, load_spec


def test_presets_carry_roles():
    spec = presets.MATCH_SPEC
    assert len(spec.fields) == 27
    assert spec.role("marriage") == "categorical" and spec.role("height") == "numeric"
    assert spec.responses["action1"] == ResponseCodes(("1", "2", "3"), ("3", "4", "5"), ("0",))
    assert spec.responses["action2"].pending == ()
    assert len(spec.groups["female_fields"]) == 11 and len(spec.groups["male_fields"]) == 14
    assert presets.PAYMENT_SPEC.ignored == ("workcity", "paydate", "regtime")
    assert len(presets.PAYMENT_SPEC.model_columns()) == 21
    assert presets.ROI_SPEC.target == "total"
    assert presets.CLUSTER_SPEC.groups["figure"] == ("age", "height", "praise", "body", "bloodtype")


def test_range_parsing():
    assert Range.parse("age, 10, 100") == Range("age", 10, 100)
    assert Range.parse("Body,*,4") == Range("body", None, 4)
    assert Range.parse("x, 1, *") == Range("x", 1, None)


def test_unknown_column_is_an_error():
    with pytest.raises(ValueError, match="not declared"):
        DatasetSpec(fields=("a",), predictors=("b",))


def test_json_round_trip():
    spec = presets.MATCH_SPEC
    again = DatasetSpec.from_json(spec.to_json())
    assert (again.fields, again.ranges, again.responses) == (spec.fields, spec.ranges, dict(spec.responses))


def test_yaml_config(spark, tmp_path):
    path = tmp_path / "app.yaml"
    path.write_text(
        "fields: Id, Sex,Total\nf_categories: Sex\nf_ignore: _ignore\ntarget:\n  name: Total\n"
        "ranges:\n  - sex, 0, 1\npositives:\n  a: 1,2\nnegetives:\n  a: 3\n"
    )
    spec = load_spec(spark, str(path), types={"total": "double"})
    assert spec.fields == ("id", "sex", "total") and spec.target == "total" and spec.ignored == ()
    assert spec.responses["a"].negatives == ("3",)
    assert spec.schema()["total"].dataType.simpleString() == "double"
