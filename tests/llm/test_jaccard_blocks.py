"""Long lists of the n-gram join: blocks of bounded size, and the pairs of comparing every set with every other."""

import random

import numpy as np
import pandas as pd
import pytest

from pairloom.llm import jaccard

SHARE = (4, 5)


def a_list(spark, n, size, place, key=7):
    cols = [np.arange(1, n + 1, dtype=np.int64).tobytes(), np.asarray(size, np.uint32).tobytes(), np.asarray(place, np.uint32).tobytes()]
    return spark.createDataFrame(pd.DataFrame({"key": [key], "ents": [cols[0]], "sizes": [cols[1]], "places": [cols[2]]}))


@pytest.mark.parametrize("one", [0, 150])
def test_blocks_give_every_pair(spark, monkeypatch, one):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 32)
    rng = np.random.default_rng(5)
    n = 400
    size = rng.integers(20, 400, n)
    place = (size * rng.random(n) * 0.2).astype(int)
    lists = a_list(spark, n, size, place)
    roots = spark.createDataFrame([(i, 1) for i in range(2, one + 1)], "a long, b long")
    got = {(r.a, r.b): (r.na, r.nb) for r in jaccard._crossing(lists, roots, SHARE).collect()}
    comp = [1 if i < one else i + 1 for i in range(n)]
    want = {
        (i + 1, j + 1): (size[i], size[j])
        for i in range(n) for j in range(i + 1, n)
        if comp[i] != comp[j] and jaccard.can_link(size[i], place[i], size[j], place[j], SHARE)
    }
    assert got == want and want


def test_no_block_pair_holds_the_list(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 32)
    rows = [(7, i, 100, 2, i) for i in range(1, 601)] + [(7, i, 100, 2, 1) for i in range(601, 901)]
    members = spark.createDataFrame(rows, "key long, ent long, n long, place long, comp long")
    sizes = [r["count"] for r in jaccard._meeting(members, SHARE).groupBy(*jaccard.BLOCK).count().collect()]
    assert len(sizes) > 100 and max(sizes) < 4 * 32


def test_sets_that_share_a_late_shingle_do_not_meet(spark):
    members = spark.createDataFrame([(7, i, 100, 15, i) for i in range(1, 3001)], "key long, ent long, n long, place long, comp long")
    assert jaccard._meeting(members, SHARE).isEmpty()


def test_components_do_not_depend_on_the_block(spark, monkeypatch):
    rng = random.Random(1)
    template = [f"t{i}" for i in range(100)]
    texts = [" ".join([f"d{k}x{i}" for i in range(rng.choice((2, 6, 14, 20)))] + template) for k in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    for block in (8, 100_000):
        monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
        found.append({r.doc_id: r.component_id for r in jaccard.similar_components(docs).collect()})
    assert found[0] == found[1]
