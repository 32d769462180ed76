"""Trees and thresholds of personal data come from every example, not from some of them."""

import random
import zlib

import numpy as np
import pytest

from pairloom.llm import pii


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(4500):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}"
        bad = f"9{rng.randint(10**8, 10**16 - 1)}"
        mail = f"a{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com" if i % 3 == 0 else "name(at)place"
        out.append((i if i % 50 else None, f"call {phone} or {phone[:-1]}7 now\nnumber {bad}, {mail}"))
    return out


def test_models_are_those_of_all_examples(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    models = pii.fit_spans(docs)
    found = [(i, *e) for i, t in rows for e in pii.examples(t, pii.base_spans(t), i)]
    assert sum(f[1] == "phone" for f in found) > 15_000
    for kind in ("email", "phone"):
        own = [f for f in found if f[1] == kind]
        x, y = np.array([f[4] for f in own], np.float32), np.array([f[3] for f in own], float)
        w = np.where(y == 1, 1.0, pii.CHANCE.get(kind, 1.0))
        held = np.array([zlib.crc32(str(f[0]).encode()) % 4 == 0 for f in own])
        want = pii.boost(x[~held], y[~held], w[~held])
        assert models[kind]["start"] == pytest.approx(want["start"], abs=1e-12)
        assert all(np.array_equal(a, b) for a, b in zip(models[kind]["cuts"], want["cuts"], strict=True))
        score = pii.boosted_score(models[kind], x)
        np.testing.assert_allclose(score, pii.boosted_score(want, x), atol=1e-4)
        assert len(models[kind]["trees"]) == pii.TREES
        assert models[kind]["threshold"] == pytest.approx(max(pii.LEAST_SCORE, pii.threshold_for(score[held], y[held], pii.PRECISION, w[held])), abs=1e-9)


def test_models_do_not_depend_on_how_rows_are_dealt(spark, rows, monkeypatch):
    monkeypatch.setattr(pii, "TREES", 3)
    docs = spark.createDataFrame(rows[:600], "doc_id long, text string")
    one, many = pii.fit_spans(docs.coalesce(1)), pii.fit_spans(docs.repartition(7, "text"))
    assert {k: (m["start"], m["trees"], m["threshold"]) for k, m in one.items()} == {k: (m["start"], m["trees"], m["threshold"]) for k, m in many.items()}


def test_tables_without_matches_have_no_models(spark):
    assert pii.fit_spans(spark.createDataFrame([(1, None), (2, "no 12 match"), (None, "")], "doc_id long, text string")) == {}
