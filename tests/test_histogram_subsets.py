"""Differing fields of all pairs over more than ten fields, without forming a pair."""

import itertools
import random
from collections import Counter

import pytest
from conftest import rows

from pairloom.operators import cluster as C

FIELDS = [f"f{i}" for i in range(12)]


@pytest.mark.parametrize("limit", [5, 60, 100_000])
def test_every_pair_counted(spark, monkeypatch, limit):
    """In one group, and with groups taken apart over and over."""
    r = random.Random(limit)
    data = [(r.choice([1, 1, 1, 2, None, 7]), *[r.choice([None, 0, 1, -5, 1 << 40][: 2 + i % 4]) for i in range(10)], r.choice(["a", "b", "", None]), r.choice([0.0, float("nan"), 2.5])) for _ in range(150)]
    data += data[:40]
    kinds = ", ".join([f"f{i} long" for i in range(10)] + ["f10 string", "f11 double"])
    df = spark.createDataFrame(data, f"g int, {kinds}").repartition(3)
    alike = lambda a, b: a == b or (a != a and b != b)
    want = Counter((a[0], sum(not alike(x, y) for x, y in zip(a[1:], b[1:]))) for a, b in itertools.combinations(data, 2) if a[0] == b[0])
    monkeypatch.setattr(C, "SUBSET_ROWS", limit)
    monkeypatch.setattr(C, "_block_histogram", None)  # no blocks are copied to each other
    got = {(g, d): int(p) for g, d, p in rows(C.distance_histogram(df, "g", FIELDS))}
    assert got == dict(want)


def test_very_many_equal_rows(spark):
    """Counts beyond 64 bits while sets are summed."""
    df = spark.createDataFrame([(1, *[0] * 12, 3_000_000_000), (1, *[1] * 12, 3_000_000_000)], ", ".join(["g int", *[f"{f} int" for f in FIELDS], "_n long"]))
    found = {k: int(v) for _, k, v in rows(C._exact_agreement(C._subset_agreement(df, "g", FIELDS), "g", 12).select("g", "distance", "pairs"))}
    n = 3_000_000_000
    assert found == {0: n * (n - 1), 12: n * n}
